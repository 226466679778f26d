"""Benchmark decontamination by winnowing (operator 9).

From every `window` consecutive words each text keeps fingerprints: the smallest hash of `gram`
words in each run of window - gram + 1 of them. The choice depends on those words alone, so a
shared span of `window` words has a fingerprint in common in both texts. Fingerprints are joined,
and each hit is extended to both sides over the words that stand around it, which travel with the
fingerprint; extended spans of at least `window` words are kept. Whatever span is that long is
found.

An item with fewer words than a window, but not none, is one window; documents are searched for
it by the hashes of all their runs of that many words.

A run that many items and documents have in different surroundings doesn't bring all of them
together: of a shared span, at least half of the words beside the run stand before it or behind it,
so fingerprints are joined with these words, once for each side.

Before the join, document fingerprints pass a bit table of the benchmark's, which has the same
size for any benchmark. What passes it by chance finds no partner in the join. Words are compared
by 64-bit hashes.

Null, empty and wordless texts have no words, hits or items. Items without an id still mark words,
but are not counted or listed. Repeated documents are judged each by itself, repeated items once.
An empty benchmark hits nothing; an empty table of documents gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallystar.llm.tables import Scratch, bit_table, id_type, passes, ship, texts, unused
from tallystar.llm.text import ALNUM, Texts, U, Words, chain, chunks, mix, span_hashes, words

_SPOTS = "array<struct<hash: bigint, pos: int, size: int, around: array<bigint>>>"
_SPOT = pa.struct(
    [("hash", pa.int64()), ("pos", pa.int32()), ("size", pa.int32()), ("around", pa.list_(pa.int64()))]
)


def _winnowed(hashes: np.ndarray, found: Words, gram: int, window: int) -> np.ndarray:
    """Places of the grams that winnowing keeps; only texts of `window` words or more have some."""
    span = window - gram + 1
    grams = chain(hashes, gram)
    n = len(grams) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    views = np.lib.stride_tricks.sliding_window_view(grams, span)
    place = np.arange(n) + (span - 1) - views[:, ::-1].argmin(1)  # the rightmost of equal ones
    text = found.text[:n]
    return np.unique(place[np.arange(n) + window <= found.bounds[1:][text]])


def _around(
    hashes: np.ndarray, found: Words, place: np.ndarray, size: int, side: int, blank: int
) -> np.ndarray:
    """Hashes of the words from `side` before to `side` after each run, blank beyond the text."""
    text = found.text[place]
    at = place[:, None] + np.arange(-side, size + side)[None, :]
    inside = (at >= found.bounds[:-1][text][:, None]) & (at < found.bounds[1:][text][:, None])
    out = np.full(at.shape, U(blank))
    out[inside] = hashes[at[inside]]
    return out


def _spots(
    texts_: Texts, gram: int, window: int, shorts: list[int] | None, blank: int, table=None
) -> tuple[Words, np.ndarray, list[tuple[np.ndarray, int, np.ndarray, np.ndarray]]]:
    """Words, and (place, size, hash, words around) of fingerprints.

    shorts: run lengths to search for everywhere; None: texts with fewer words than a window are
    such a run themselves.
    """
    found = words(texts_, ALNUM)
    hashes = span_hashes(texts_, found.start, found.end, lower=True)
    out = []
    for size in [gram, *(range(1, window) if shorts is None else shorts)]:
        short = not out
        if short:  # the first round: winnowed grams
            place = _winnowed(hashes, found, gram, window)
            key = chain(hashes, gram)[place] if len(place) else np.zeros(0, np.uint64)
        else:
            whole = chain(hashes, size)
            if shorts is None:
                of = np.flatnonzero(found.count == size)
                place = found.bounds[:-1][of]
            else:
                place = np.arange(len(whole))
                place = place[place + size <= found.bounds[1:][found.text[: len(whole)]]]
            key = mix(whole[place] + U(size))
        if table is not None:
            ok = passes(table, key)
            place, key = place[ok], key[ok]
        side = window - gram if short else 0
        out.append((place, 0 if short else size, key, _around(hashes, found, place, size, side, blank)))
    return found, hashes, out


def _rows(found: Words, spots: list, n: int) -> pa.Array:
    """A list of spots for each text."""
    text = np.concatenate([found.text[p] for p, *_ in spots])
    order = np.argsort(text, kind="stable")
    pos = np.concatenate([p - found.bounds[:-1][found.text[p]] for p, *_ in spots])
    size = np.concatenate([np.full(len(p), s) for p, s, *_ in spots])
    key = np.concatenate([k for _, _, k, _ in spots])
    width = np.concatenate([np.full(len(p), a.shape[1]) for p, _, _, a in spots])
    flat = np.concatenate([a.ravel() for *_, a in spots]).view(np.int64)
    around = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(width)]), pa.int32()), pa.array(flat)
    )
    rows = pa.StructArray.from_arrays(
        [
            pa.array(key.view(np.int64)),
            pa.array(pos, pa.int32()),
            pa.array(size, pa.int32()),
            around,
        ],
        fields=list(_SPOT),
    ).take(pa.array(order))
    ends = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=n))])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def _items(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts_ in chunks(batches):
            found, _, spots = _spots(texts_, gram, window, None, 1)
            yield pa.record_batch(
                {"item_id": batch.column("item_id"), "spots": _rows(found, spots, len(texts_))}
            )

    return run


def _documents(gram: int, window: int, shorts: list[int], table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts_ in chunks(batches):
            found, _, spots = _spots(texts_, gram, window, shorts, 2, table.value)
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id"),
                    "text_key": batch.column("text_key"),
                    "n_words": pa.array(found.count, pa.int64()),
                    "spots": _rows(found, spots, len(texts_)),
                }
            )

    return run


def _sided(rows: DataFrame, around: str, gram: int, side: int) -> DataFrame:
    """Rows once for the words before the run (1) and once for those behind it (2), as many as a
    shared span has on one side at least; runs that are whole items (0) have none."""
    half = (side + 1) // 2
    before = F.xxhash64(F.slice(around, side - half + 1, half))
    behind = F.xxhash64(F.slice(around, side + gram + 1, half))
    whole = F.array(F.struct(F.lit(0).alias("part"), F.lit(0).cast("long").alias("beside")))
    both = F.array(
        F.struct(F.lit(1).alias("part"), before.alias("beside")),
        F.struct(F.lit(2).alias("part"), behind.alias("beside")),
    )
    return rows.select("*", F.inline(F.when(F.col("size") > 0, whole).otherwise(both)))


class Winnowing:
    """Shared spans of documents and benchmark items."""

    def __init__(
        self,
        docs: DataFrame,
        benchmark: DataFrame,
        window: int = 10,
        gram: int = 5,
        id_col: str = "doc_id",
        text_col: str = "text",
    ) -> None:
        if not 0 < gram <= window:
            raise ValueError("gram must be from 1 to window")
        spark = docs.sparkSession
        ship(spark)
        scratch = Scratch(spark)
        self.id_col, self.text_col = id_col, text_col
        items = texts(benchmark, "item_id", "text").withColumnRenamed("doc_id", "item_id")
        item_name = id_type(benchmark, "item_id").simpleString()
        spots = scratch.saved(
            items.mapInArrow(_items(gram, window), f"item_id {item_name}, spots {_SPOTS}")
            .select("item_id", F.explode("spots").alias("s"))
            .select("item_id", "s.hash", "s.size", "s.around")
            .distinct(),
            "items",
        )
        # What many items share is one variant, which documents meet once.
        variants = scratch.saved(
            spots.select("hash", "size", "around").distinct()
            .withColumn("variant", F.monotonically_increasing_id()),
            "variants",
        )
        self.owners = scratch.saved(
            spots.where("item_id is not null").join(variants, ["hash", "size", "around"])
            .select("variant", "item_id").distinct(),
            "owners",
        )
        shorts = sorted(r[0] for r in variants.where("size > 0").select("size").distinct().collect())
        table = bit_table(variants, "hash")
        table = spark.sparkContext.broadcast(table)
        id_name = id_type(docs, id_col).simpleString()
        self.heads = scratch.saved(
            texts(docs, id_col, text_col).withColumn("text_key", F.xxhash64("text"))
            .mapInArrow(
                _documents(gram, window, shorts, table),
                f"doc_id {id_name}, text_key long, n_words long, spots {_SPOTS}",
            ),
            "documents",
        )
        side = window - gram
        places = (
            self.heads.where("size(spots) > 0")
            .select("doc_id", "text_key", F.explode("spots").alias("s"))
            .select("doc_id", "text_key", "s.hash", "s.pos", "s.size", F.col("s.around").alias("mine"))
        )
        met = _sided(places, "mine", gram, side).join(
            _sided(variants, "around", gram, side), ["hash", "size", "part", "beside"]
        )
        same = F.zip_with("mine", "around", lambda x, y: x == y)
        # Equal words next to the run, outwards: up to the first difference.
        left = F.coalesce(
            F.nullif(F.array_position(F.reverse(F.slice("same", 1, side)), F.lit(False)), F.lit(0)) - 1,
            F.lit(side),
        ) if side else F.lit(0)
        right = F.coalesce(
            F.nullif(F.array_position(F.slice("same", side + gram + 1, side), F.lit(False)), F.lit(0)) - 1,
            F.lit(side),
        ) if side else F.lit(0)
        core = F.when(F.col("size") > 0, F.col("same")).otherwise(F.slice("same", side + 1, gram))
        self.spans = scratch.saved(
            met.withColumn("same", same)
            .where(~F.array_contains(core, False))
            .withColumn("left", F.when(F.col("size") > 0, 0).otherwise(left))
            .withColumn("right", F.when(F.col("size") > 0, 0).otherwise(right))
            .withColumn("long", F.when(F.col("size") > 0, F.col("size")).otherwise(gram))
            .where((F.col("size") > 0) | (F.col("left") + F.col("right") + gram >= window))
            # What both sides brought together counts once.
            .where((F.col("part") < 2) | (F.col("left") < (side + 1) // 2))
            .select(
                "doc_id", "text_key", "variant",
                (F.col("pos") - F.col("left")).cast("long").alias("start"),
                (F.col("pos") + F.col("long") + F.col("right")).cast("long").alias("stop"),
            ),
            "spans",
        )

    def clean(self, docs: DataFrame) -> DataFrame:
        """The rows of the searched table without those that share a window with the benchmark."""
        digest, i, key = unused(docs.columns, "digest", "id", "key")
        found = self.spans.select(F.col("doc_id").alias(i), F.col("text_key").alias(key)).distinct()
        text = F.coalesce(F.col(f"`{self.text_col}`").cast("string"), F.lit(""))
        return (
            docs.withColumn(digest, F.xxhash64(text))
            .join(
                found,
                (F.col(digest) == F.col(key)) & F.col(f"`{self.id_col}`").eqNullSafe(F.col(i)),
                "left_anti",
            )
            .drop(digest)
        )

    def documents(self) -> DataFrame:
        """doc_id, n_words, n_hit, n_items, item_ids (sorted as strings), spans: a row per row."""
        key = ["doc_id", "text_key"]
        # Union of the spans: what each adds beyond the furthest end so far.
        covered = F.aggregate(
            "spans",
            F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("far")),
            lambda a, x: F.struct(
                (a.n + F.greatest(F.lit(0).cast("long"), x.stop - F.greatest(x.start, a.far))).alias("n"),
                F.greatest(a.far, x.stop).alias("far"),
            ),
            lambda a: a.n,
        )
        hit = (
            self.spans.select(*key, F.struct("start", "stop").alias("span")).distinct()
            .groupBy(*key).agg(F.array_sort(F.collect_list("span")).alias("spans"))
            .select(*key, "spans", covered.alias("n_hit"))
        )
        listed = (
            self.spans.select(*key, "variant").distinct().join(self.owners, "variant")
            .select(*key, F.col("item_id").cast("string").alias("item_id")).distinct()
            .groupBy(*key).agg(F.array_sort(F.collect_list("item_id")).alias("item_ids"))
        )
        h, x, y = self.heads.alias("h"), hit.alias("x"), listed.alias("y")
        on = lambda a: (F.col("h.text_key") == F.col(f"{a}.text_key")) & F.col(
            "h.doc_id"
        ).eqNullSafe(F.col(f"{a}.doc_id"))
        return (
            h.join(x, on("x"), "left").join(y, on("y"), "left")
            .select(
                "h.doc_id", "h.n_words",
                F.coalesce("x.n_hit", F.lit(0)).cast("long").alias("n_hit"),
                F.coalesce(F.size("y.item_ids"), F.lit(0)).cast("long").alias("n_items"),
                F.coalesce("y.item_ids", F.array().cast("array<string>")).alias("item_ids"),
                F.coalesce("x.spans", F.array().cast("array<struct<start:bigint,stop:bigint>>"))
                .alias("spans"),
            )
        )


def benchmark_overlap(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """Words, hit words and items of each document; contaminated if any word is hit."""
    return Winnowing(docs, benchmark, window).documents().withColumn(
        "contaminated", F.col("n_hit") > 0
    )
