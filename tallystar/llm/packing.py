"""Packing by minimum bin slack (operator 4).

Documents are cut into full windows and a rest. All that packing has to know of the pieces is how
many there are of each length, a table with as many rows as a window has tokens. Each step fills a
window around the longest length left: subset sums of the lengths left, each as often as it is
there, are kept as the bits of one number; the reachable sum closest to the capacity is traced
back to a count of each length. That filling is used as often as the lengths last, so the number
of steps depends on the window, not on the number of documents.

Each piece then finds its place from its rank among the pieces of its length. Ranks come from
numbered buckets of a hash, so pieces of a frequent length are not ranked in one task. A length has
as many buckets as its pieces need, so a bucket keeps its size and rare lengths have one.

The ids are those of the vocabulary file by its own pattern and merges, computed from the file's
vocabulary by the rank-based encoder, which gives the same ids as the file's library at a fifth of
the time; tests compare the two. An added token inside a text is its single id, as is the
library's default.

A null or empty text is the end id alone. Repeated rows and null ids are packed like any other.
An empty table gives no rows.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.merge_counts import VOCABULARY, byte_signs
from tallystar.llm.tables import Scratch, id_type, ship, texts
from tallystar.llm.text import chunks

#: Pieces of a bucket, about, and the most buckets whose first ranks are sent to every executor.
BUCKET_PIECES, BROADCAST_BUCKETS = 1 << 11, 1 << 17

_encoders: dict[str, tiktoken.Encoding] = {}


def encoder(path: str = VOCABULARY) -> tiktoken.Encoding:
    """An encoder with the ids of a byte-level vocabulary file; read once in a worker."""
    if path not in _encoders:
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        byte = {s: b for b, s in enumerate(byte_signs())}
        added = {t["content"]: t["id"] for t in model["added_tokens"]}
        ids = {t: i for t, i in model["model"]["vocab"].items() if t not in added}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["model"]["merges"]]
        made = [ids[a + b] for a, b in merges]
        if made != sorted(made):
            raise ValueError(f"{path}: ids of merged tokens are not in the order of the merges")
        _encoders[path] = tiktoken.Encoding(
            path,
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={bytes(byte[c] for c in t): i for t, i in ids.items()},
            special_tokens=added,
        )
    return _encoders[path]


def _pieces(path: str, window: int, end: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch, _ in chunks(batches):
            row, start, length, crc, size = [], [], [], [], []
            for r, text in enumerate(batch.column("text")):
                ids = own.encode_to_numpy(text.as_py(), allowed_special="all")
                ids = np.append(ids.astype("<u4"), np.uint32(end)).astype("<u4")
                data = memoryview(ids.tobytes())
                for a in range(0, len(ids), window):
                    row.append(r)
                    start.append(a)
                    length.append(min(window, len(ids) - a))
                    crc.append(zlib.crc32(data[4 * a : 4 * (a + window)]))
                    size.append(len(ids))
            yield pa.record_batch(
                {
                    "doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())),
                    "start": pa.array(start, pa.int64()),
                    "length": pa.array(length, pa.int64()),
                    "ids_crc32": pa.array(crc, pa.int64()),
                    "doc_tokens": pa.array(size, pa.int64()),
                }
            )

    return run


def closest_filling(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """Lengths and how often each, of those at hand, with the sum closest to the capacity."""
    reach, keep, steps = 1, (1 << (capacity + 1)) - 1, []
    for length in sorted((x for x in counts if x <= capacity and counts[x]), reverse=True):
        left, times = min(counts[length], capacity // length), 1
        while left:  # as often as it is there, by doubling
            times = min(times, left)
            steps.append((length, times, reach))
            reach |= (reach << (length * times)) & keep
            left, times = left - times, times * 2
        if reach >> capacity:
            break
    total, used = reach.bit_length() - 1, {}
    for length, times, before in reversed(steps):
        if not before >> total & 1:
            total -= length * times
            used[length] = used.get(length, 0) + times
    return used


def fillings(counts: dict[int, int], window: int) -> list[tuple[dict[int, int], int]]:
    """Fillings of a window, each with the number of windows that are filled so."""
    left, out = {x: n for x, n in counts.items() if n}, []
    while left:
        longest = max(left)
        rest = left | {longest: left[longest] - 1}
        used = closest_filling(rest, window - longest)
        used[longest] = used.get(longest, 0) + 1
        times = min(left[x] // n for x, n in used.items())
        out.append((used, times))
        left = {x: m for x in left if (m := left[x] - times * used.get(x, 0))}
    return out


def _places(plan: list[tuple[dict[int, int], int]]) -> dict[str, np.ndarray]:
    """By length and rank: first rank, pieces in a window, first window and offset there."""
    rows, seen, windows = [], {}, 0
    for used, times in plan:
        offset = 0
        for length, n in sorted(used.items(), reverse=True):
            rows.append((length, seen.get(length, 0), n, windows, offset))
            seen[length] = seen.get(length, 0) + n * times
            offset += n * length
        windows += times
    names = ("length", "first", "each", "window", "offset")
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(names, table.T, strict=True))


def _placed(places: dict[str, np.ndarray]):
    """Adds the sequence and the offset there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = np.empty(len(length), np.int64)
            for one in np.unique(length):
                own = slice(*np.searchsorted(places["length"], [one, one + 1]))
                of = length == one
                at[of] = own.start - 1 + np.searchsorted(places["first"][own], rank[of], "right")
            place, times = rank - places["first"][at], places["each"][at]
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns.pop("rank")
            columns["sequence_id"] = pa.array(places["window"][at] + place // times)
            columns["offset"] = pa.array(places["offset"][at] + place % times * length)
            yield pa.record_batch(columns)

    return run


def packed(
    docs: DataFrame,
    window: int = 1024,
    end: int = 0,
    vocabulary: str = VOCABULARY,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of each piece."""
    spark = docs.sparkSession
    ship(spark)
    scratch = Scratch(spark)
    head = (
        f"doc_id {id_type(docs, id_col).simpleString()}, start long, length long, "
        "ids_crc32 long, doc_tokens long"
    )
    pieces = scratch.saved(
        texts(docs, id_col, text_col).mapInArrow(_pieces(vocabulary, window, end), head),
        "pieces",
    )
    # One row for each length, at most `window`.
    lengths = scratch.saved(pieces.groupBy("length").agg(F.count("*").alias("n")), "lengths")
    counts = dict(lengths.collect())
    buckets = F.ceil(F.col("n") / BUCKET_PIECES)
    pieces = pieces.join(
        F.broadcast(lengths.select("length", buckets.alias("buckets"))), "length"
    ).withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.col("buckets")))
    sizes = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    sizes = scratch.saved(sizes, "sizes")
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = scratch.saved(
        sizes.select("length", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")),
        "firsts",
    )
    n_buckets = sum(-(-n // BUCKET_PIECES) for n in counts.values())
    firsts = F.broadcast(firsts) if n_buckets <= BROADCAST_BUCKETS else firsts.hint("merge")
    inside = Window.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32")
    ranked = pieces.withColumn("at", F.row_number().over(inside)).join(firsts, ["length", "bucket"])
    return ranked.select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens",
        (F.col("first") + F.col("at") - 1).alias("rank"),
    ).mapInArrow(_placed(_places(fillings(counts, window))), f"{head}, sequence_id long, offset long")
