"""Quality rules from tokeniser fertility (operator 7).

Words are encoded with two public vocabularies, each distinct word of a chunk once. A document's
characters per token, share of byte-fallback tokens, token entropy (bits per token, as a part of the
most that its number of tokens allows and of what good texts of that many tokens have) and tokens
of the first vocabulary per token of the second must lie in the band of its script. The script is
that of most of its letters, by the lead bytes of their UTF-8 form.

The bands of a script, and the usual entropy by size, are fitted when the operator runs, from good
labelled texts that pass the base rules: all of them, without those of the held-out part (crc32 of
the id, modulo FOLDS, 0), on which the rules can be judged. Means and quantiles are those of all these
texts, counted by Spark. A limit lies beyond the good texts' outermost thousandth by a part of the distance from
there to their median, more for few texts. Scripts with fewer than `LEAST_GOOD` good texts, and
callers without labels, get the wide bands. So the limits come from the rows and not from this code.

The base rules count symbols, repeated lines and words inside repeated three-word windows; they
reject what has fewer than 50 words or is half repetition.

Null, empty and blank texts have no words and are rejected by the base rules. Repeated rows and
null ids are judged like any other. Very long texts are measured whole. Extra columns are left out or
carried as they are; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import public_tokenizers
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.quantiles import quantiles
from tallystar.llm.tables import Scratch, id_type, ship
from tallystar.llm.text import (
    NOT_SPACE,
    SYMBOLS,
    Texts,
    Words,
    chunks,
    repeated_lines,
    repeated_words,
    span_hashes,
    sums,
    words,
)

VOCABULARY = public_tokenizers.path("piece_bpe_32k.model")
SECOND = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


class Band(NamedTuple):
    """Accepted characters per token, byte share at most, and part of the largest entropy.

    usual_least: part of the entropy that texts of as many tokens usually have;
    ratio_least: tokens of the first vocabulary per token of the second.
    """

    chars_least: float
    chars_most: float
    byte_share_most: float
    entropy_least: float
    usual_least: float = 0.0
    ratio_least: float = 0.0


#: By script. Real prose has 3 to 5 characters a token in Latin script and 1 to 2 in others, no
#: bytes but those of rare signs, and more than half of the largest entropy.
WIDE = {
    "latin": Band(1.3, 9.0, 0.10, 0.35),
    "cyrillic": Band(0.9, 6.0, 0.10, 0.35),
    "greek": Band(0.5, 4.0, 0.30, 0.30),
    "east_asian": Band(0.2, 3.0, 0.60, 0.30),
    "other": Band(0.2, 6.0, 0.80, 0.30),
}

class Rules(NamedTuple):
    """Bands by script, and the usual entropy at some sizes (log2 of tokens), by size."""

    bands: dict[str, Band] = WIDE
    usual: tuple[tuple[float, float], ...] = ()


FOLDS, HELD_OUT = 5, 0
#: Good texts of a script that its band needs, and of a size that a point of the entropy needs.
LEAST_GOOD, LEAST_POINT = 20, 5
#: A limit's distance from the outermost thousandth, as a part of that from there to the median.
MARGIN, SMALL_SAMPLE = 0.15, 2.0
SCRIPTS = list(WIDE)
#: Lead byte of a UTF-8 character to its script; 255: no letter.
_SCRIPT = np.full(256, 255, np.uint8)
_SCRIPT[0x41:0x5B] = _SCRIPT[0x61:0x7B] = _SCRIPT[0xC3:0xCA] = SCRIPTS.index("latin")
_SCRIPT[0xCD:0xD0] = SCRIPTS.index("greek")
_SCRIPT[0xD0:0xD4] = SCRIPTS.index("cyrillic")
_SCRIPT[0xD4:0xE3] = SCRIPTS.index("other")
_SCRIPT[0xE3:0xEE] = SCRIPTS.index("east_asian")

_encoders: dict[str, tuple[sentencepiece.SentencePieceProcessor, np.ndarray]] = {}


def _encoder(path: str) -> tuple[sentencepiece.SentencePieceProcessor, np.ndarray]:
    """The vocabulary, and which of its ids are bytes; read once in a worker."""
    if path not in _encoders:
        own = sentencepiece.SentencePieceProcessor(model_file=path)
        _encoders[path] = own, np.array([own.is_byte(i) for i in range(own.vocab_size())])
    return _encoders[path]


_seconds: dict[str, tiktoken.Encoding] = {}


def _second(path: str) -> tiktoken.Encoding:
    """The second vocabulary, a file of ranks; read once in a worker."""
    if path not in _seconds:
        with open(path, "rb") as file:
            pairs = [line.split() for line in file if line.strip()]
        ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        _seconds[path] = tiktoken.Encoding(
            path, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
    return _seconds[path]


def _tokens(
    texts_: Texts, found: Words, hashes: np.ndarray, path: str, second: str
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Tokens, byte tokens, entropy in bits a token, and tokens of the second vocabulary of each text.

    In the second vocabulary, a word is encoded as it stands after a blank.
    """
    own, is_byte = _encoder(path)
    other = _second(second)
    _, first, which = np.unique(hashes, return_index=True, return_inverse=True)
    data = texts_.data.tobytes()
    spans = zip(found.start[first].tolist(), found.end[first].tolist(), strict=True)
    each_word = [data[a:b].decode("utf-8", "replace") for a, b in spans]
    codes = own.encode(each_word, num_threads=1)
    others = np.fromiter((len(other.encode_ordinary(f" {w}")) for w in each_word), np.int64, len(codes))
    sizes = np.fromiter(map(len, codes), np.int64, len(codes))
    ids = np.fromiter((i for c in codes for i in c), np.int64, int(sizes.sum()))
    begins = np.cumsum(sizes) - sizes
    each = sizes[which]
    at = np.repeat(begins[which] - (np.cumsum(each) - each), each) + np.arange(each.sum())
    tokens = ids[at]
    bounds = np.concatenate([[0], np.cumsum(each)])[found.bounds]
    n = np.diff(bounds)
    text = np.repeat(np.arange(len(n)), n)
    key, many = np.unique(text * own.vocab_size() + tokens, return_counts=True)
    of = key // own.vocab_size()
    part = many / n[of]
    entropy = np.bincount(of, -part * np.log2(part), minlength=len(n))
    return n, sums(is_byte[tokens], bounds), entropy, sums(others[which], found.bounds)


def _script(texts_: Texts) -> np.ndarray:
    kind = _SCRIPT[texts_.data]
    counts = np.stack([sums(kind == i, texts_.offsets) for i in range(len(SCRIPTS))])
    return np.where(counts.max(0) > 0, counts.argmax(0), SCRIPTS.index("other"))


def _measured(path: str, second: str, text: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts_ in chunks(batches, text):
            found = words(texts_, NOT_SPACE)
            hashes = span_hashes(texts_, found.start, found.end)
            first_byte = (texts_.data & 0xC0) != 0x80
            tokens, bytes_, entropy, others = _tokens(texts_, found, hashes, path, second)
            chars = sums(first_byte & NOT_SPACE[texts_.data], texts_.offsets)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_words": pa.array(found.count, pa.int64()),
                    "word_chars": pa.array(chars, pa.int64()),
                    "n_symbols": pa.array(sums(SYMBOLS[texts_.data], texts_.offsets), pa.int64()),
                    "n_dup_lines": pa.array(repeated_lines(texts_, found), pa.int64()),
                    "n_repeat_words": pa.array(repeated_words(found, hashes), pa.int64()),
                    "n_tokens": pa.array(tokens, pa.int64()),
                    "n_byte_tokens": pa.array(bytes_, pa.int64()),
                    "entropy": pa.array(entropy, pa.float64()),
                    "n_second_tokens": pa.array(others, pa.int64()),
                    "script": pa.array(np.array(SCRIPTS)[_script(texts_)], pa.string()),
                    **{c: batch.column(c) for c in batch.schema.names if c.startswith("kept_")},
                }
            )

    return run


def measured(
    docs: DataFrame,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
    carried: tuple[str, ...] = (),
    second: str = SECOND,
) -> DataFrame:
    """Counts of each document; `carried` columns come along as kept_<name>."""
    ship(docs.sparkSession)
    own = [F.col(f"`{id_col}`").alias("doc_id")]
    own += [F.col(f"`{c}`").alias(f"kept_{c}") for c in carried]
    # A text that is carried anyway goes to Python once.
    on_board = text_col in carried and docs.schema[text_col].dataType.simpleString() == "string"
    if not on_board:
        own.append(F.col(f"`{text_col}`").cast("string").alias("text"))
    kinds = "".join(f", `kept_{c}` {docs.schema[c].dataType.simpleString()}" for c in carried)
    return docs.select(*own).mapInArrow(
        _measured(vocabulary, second, f"kept_{text_col}" if on_board else "text"),
        f"doc_id {id_type(docs, id_col).simpleString()}, n_words long, word_chars long, "
        "n_symbols long, n_dup_lines long, n_repeat_words long, n_tokens long, "
        f"n_byte_tokens long, entropy double, n_second_tokens long, script string{kinds}",
    )


def with_measures(rows: DataFrame, usual: tuple[tuple[float, float], ...] = ()) -> DataFrame:
    """Adds the measures and base_failed."""
    tokens = F.greatest("n_tokens", F.lit(1))
    most = F.log2(F.greatest("n_tokens", F.lit(2)).cast("double"))
    expected = most
    if usual:
        size = F.log2(tokens.cast("double"))
        # Below the first point, in proportion to the largest entropy; constant beyond the last.
        curve = F.when(size < usual[0][0], size * (usual[0][1] / usual[0][0]))
        for (x, y), (to_x, to_y) in zip(usual, usual[1:]):
            curve = curve.when(size < to_x, F.lit(y) + (size - x) * ((to_y - y) / (to_x - x)))
        expected = F.greatest(curve.otherwise(usual[-1][1]), F.lit(1.0))
    return rows.withColumns(
        {
            "chars_per_token": F.col("word_chars") / tokens,
            "byte_share": F.col("n_byte_tokens") / tokens,
            "entropy_share": F.col("entropy") / most,
            "usual_share": F.col("entropy") / expected,
            "token_ratio": F.col("n_tokens") / F.greatest("n_second_tokens", F.lit(1)),
            "base_failed": (F.col("n_words") < 50)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50),
        }
    )


def judged(rows: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Adds the measures, base_failed and kept."""
    low, high, share, least, usual_least, ratio_least = (
        F.element_at(
            F.create_map(*[F.lit(v) for s, b in rules.bands.items() for v in (s, float(b[i]))]),
            F.col("script"),
        )
        for i in range(len(Band._fields))
    )
    fits = (
        F.col("chars_per_token").between(low, high)
        & (F.col("byte_share") <= share)
        & (F.col("entropy_share") >= least)
        & (F.col("usual_share") >= usual_least)
        & (F.col("token_ratio") >= ratio_least)
    )
    rows = with_measures(rows, rules.usual)
    return rows.withColumn("kept", ~F.col("base_failed") & F.coalesce(fits, F.lit(False)))


def quality(docs: DataFrame, rules: Rules = Rules(), **options) -> DataFrame:
    """Measures and verdict of each document."""
    return judged(measured(docs, **options), rules)


# Fitting

#: Parts of a whole in which sizes and entropies are added up, so that the order of rows is no matter.
UNITS = 1 << 32
EDGES = {"chars_per_token": (0.001, 0.999), "usual_share": (0.001,), "token_ratio": (0.001,)}


def usual_entropy(good: DataFrame) -> tuple[tuple[float, float], ...]:
    """Mean size (log2) and entropy of good texts, by whole log2 of their tokens."""
    tokens = F.greatest("n_tokens", F.lit(1))

    def total(value: F.Column) -> F.Column:
        return F.sum(F.round(value * UNITS).cast("decimal(20,0)"))

    found = good.groupBy(F.length(F.bin(tokens)).alias("size")).agg(
        F.count("*").alias("n"), total(F.log2(tokens.cast("double"))).alias("x"), total(F.col("entropy")).alias("y")
    )
    # One row for each power of two that a text's tokens can reach.
    points = sorted(r for r in found.collect() if r["n"] >= LEAST_POINT)
    return tuple((float(r["x"]) / UNITS / r["n"], float(r["y"]) / UNITS / r["n"]) for r in points)


def fitted(good: DataFrame) -> Rules:
    """Rules from measured good texts that pass the base rules; reads them several times."""
    usual = usual_entropy(good)
    if not usual:
        return Rules()
    each = F.array(
        *[F.struct(F.concat("script", F.lit(f":{m}")).alias("name"), F.col(m).alias("x")) for m in EDGES]
    )
    values = with_measures(good, usual).select(F.explode(each).alias("v")).select("v.*")
    wanted = {f"{s}:{m}": [0.5, *q] for s in SCRIPTS for m, q in EDGES.items()}
    counts, found = quantiles(values, wanted)
    bands = dict(WIDE)
    for script, wide in WIDE.items():
        n = counts.get(f"{script}:chars_per_token", 0)
        if n < LEAST_GOOD:
            continue

        def beyond(measure: str, q: float) -> float:
            """The limit beyond a quantile, away from the median."""
            edge, middle = (found[f"{script}:{measure}", p].linear for p in (q, 0.5))
            return edge - (MARGIN + SMALL_SAMPLE / math.sqrt(n)) * (middle - edge)

        bands[script] = wide._replace(
            chars_least=max(wide.chars_least, beyond("chars_per_token", 0.001)),
            chars_most=min(wide.chars_most, beyond("chars_per_token", 0.999)),
            usual_least=beyond("usual_share", 0.001),
            ratio_least=beyond("token_ratio", 0.001),
        )
    return Rules(bands, usual)


def held_out(doc_id) -> F.Column:
    """Whether a labelled row belongs to the part that is not learnt from."""
    text = F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")
    return F.crc32(text) % FOLDS == HELD_OUT


def _good(rows: DataFrame, labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows whose ids `labels` (doc_id, quality) call good, without those of the held-out part."""
    ids = labels.select(F.col("doc_id").alias("labelled"), "quality").dropna()
    ids = ids.where(~held_out(F.col("labelled"))).where("quality = 1").select("labelled")
    return rows.join(ids, F.col(f"`{id_col}`") == F.col("labelled"), "left_semi")


def _fitted_once_saved(good: DataFrame, scratch: Scratch) -> Rules:
    names = ["script", "n_words", "n_repeat_words", "n_tokens", "n_byte_tokens", "word_chars", "entropy", "n_second_tokens"]
    saved = scratch.saved(with_measures(good).where("not base_failed").select(*names), "good")
    rules = fitted(saved)
    scratch.drop("good")
    return rules


def fitted_rules(docs: DataFrame, labels: DataFrame, **options) -> Rules:
    """Rules from the documents that `labels` (doc_id, quality) call good; see the module's head."""
    own = _good(docs, labels, options.get("id_col", "doc_id"))
    return _fitted_once_saved(measured(own, **options), Scratch(docs.sparkSession))


def fitted_quality(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """Measures and verdict of each document by the rules that `labels` teach.

    All documents are measured once, and their measures (with carried columns) written; the rules are
    fitted to them, joined to the labels as numbers, so no text is shuffled.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.saved(measured(docs, **options), "measured")
    return judged(rows, _fitted_once_saved(_good(rows, labels), scratch))
