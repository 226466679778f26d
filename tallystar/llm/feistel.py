"""Reproducible shuffle and sharding by a Feistel permutation (operator 8).

Rows get global numbers 0 .. n-1, and the permutation of these numbers is a keyed Feistel network
over the next even number of bits; a result of n or more is put through again until it is below n
(cycle walking), which takes less than four turns on average. Position p goes to shard p mod
`shards`, slot p div `shards`: shards have equal numbers of rows, or one more, and slots have no
gaps. Nothing is sorted by the shuffled order, and each row's place is computed by itself.

The number of a row is its place among the rows of a hash bucket, by id, checksum and size, plus
the rows of all buckets before. There are BUCKETS buckets, and more for inputs beyond BUCKET_ROWS rows a
bucket. Rows equal in all three are interchangeable. The same rows, seed and shards give the same places, whatever the files.

A null text has no bytes and checksum 0; a null id is an id like any other, repeated rows are rows
of their own. An empty table gives no rows. Equal texts need not share a shard under this law.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallystar.llm.tables import Scratch, ship
from tallystar.llm.text import U, mix

#: Hash buckets in which rows are numbered, at least, and the rows of one beyond which there are more.
#: Their counts are added up in one task, and sent to every executor up to so many.
BUCKETS, BUCKET_ROWS, BROADCAST_BUCKETS = 4096, 1 << 16, 1 << 17


def permuted(numbers: np.ndarray, n: int, seed: int = 0, rounds: int = 6) -> np.ndarray:
    """The permutation of 0 .. n-1 at `numbers`."""
    half = max(1, -(-max(n - 1, 1).bit_length() // 2))
    low = U((1 << half) - 1)
    keys = mix(np.arange(1, rounds + 1, dtype=np.uint64) + U(seed % (1 << 32)) * U(1 << 16))

    def once(x: np.ndarray) -> np.ndarray:
        a, b = x >> U(half), x & low
        for key in keys:
            a, b = b, a ^ (mix(b + key) & low)
        return (a << U(half)) | b

    out = once(numbers.astype(np.uint64))
    while True:
        beyond = np.flatnonzero(out >= U(n))
        if not len(beyond):
            return out.astype(np.int64)
        out[beyond] = once(out[beyond])


def _placed(n: int, shards: int, seed: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            place = permuted(batch.column("number").to_numpy(), n, seed)
            columns = dict(zip(batch.schema.names, batch.columns, strict=True))
            columns["position"] = pa.array(place)
            columns["shard"] = pa.array(place % shards, pa.int32())
            columns["slot"] = pa.array(place // shards, pa.int64())
            yield pa.record_batch(columns)

    return run


def numbered(rows: DataFrame, order: list[str], n: int) -> DataFrame:
    """Adds `number`, 0 .. n-1, to n rows, fixed by the values of the `order` columns."""
    scratch = Scratch(rows.sparkSession)
    buckets = max(BUCKETS, 1 << max(n // BUCKET_ROWS - 1, 0).bit_length())
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64(*order), F.lit(buckets)).cast("int"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    firsts = scratch.saved(
        rows.groupBy("bucket").agg(F.count("*").alias("n"))
        .select("bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")),
        "buckets",
    )
    inside = Window.partitionBy("bucket").orderBy(*order)
    firsts = F.broadcast(firsts) if buckets <= BROADCAST_BUCKETS else firsts
    return (
        rows.withColumn("at", F.row_number().over(inside))
        .join(firsts, "bucket")
        .withColumn("number", F.col("first") + F.col("at") - 1)
        .drop("bucket", "at", "first")
    )


def sharded(
    docs: DataFrame,
    shards: int = 16,
    seed: int = 0,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and position of each document."""
    if shards < 1:
        raise ValueError("at least one shard is needed")
    spark = docs.sparkSession
    ship(spark)
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    rows = Scratch(spark).saved(rows, "sizes")
    n = rows.count()
    ready = numbered(rows, ["doc_id", "text_crc32", "size"], n)
    kind = rows.schema["doc_id"].dataType.simpleString()
    return ready.mapInArrow(
        _placed(n, shards, seed),
        f"doc_id {kind}, size long, text_crc32 long, number long, position long, shard int, slot long",
    ).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "position",
    )
