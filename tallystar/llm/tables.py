"""Written intermediate tables, and what Python workers need to find this package."""

from __future__ import annotations

import os

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallystar.session import scratch_folder

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def ship(spark: SparkSession) -> None:
    """Let Python workers that start from now on import this package from where it lies.

    On a cluster the package comes with --py-files; this is for sessions on one machine that
    were started in another folder.
    """
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(":") if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = ":".join([*paths, ROOT])


def unused(columns: list[str], *names: str) -> list[str]:
    """The names, each made longer until no column has it."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def text_digest(text: F.Column) -> F.Column:
    """128 bits that stand for a text; a null text is an empty one."""
    return F.unhex(F.md5(F.coalesce(text, F.lit("")).cast("binary")))


#: With it, Spark removes the shuffle files of a query as soon as the query has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Scratch:
    """Tables of one run, written below the shared folder of spark.checkpoint.dir.

    A table that was written does not depend on the executors that made it, and numbers given
    to its rows stay as they are. So the shuffle files behind it go when it has been written, and
    it goes itself by `drop` when all that is read from it has been written.
    """

    def __init__(self, spark: SparkSession) -> None:
        self.spark = spark
        self.folder = scratch_folder(spark)
        self.names: list[str] = []

    def saved(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.folder}/{name}"
        before = self.spark.conf.get(CLEANUP)
        self.spark.conf.set(CLEANUP, "true")
        try:
            df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        finally:
            self.spark.conf.set(CLEANUP, before)
        if name not in self.names:
            self.names.append(name)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        """Remove tables that nothing reads any more."""
        for name in names:
            self.names.remove(name)
            path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/{name}")
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, *names: str) -> None:
        """Remove all tables but these."""
        self.drop(*[n for n in self.names if n not in names])


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Id and text under fixed names; a null text is an empty one. Other columns are left out."""
    return docs.select(
        F.col(f"`{id_col}`").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def id_type(docs: DataFrame, id_col: str = "doc_id") -> T.DataType:
    return docs.schema[id_col].dataType


#: Bits of a table of hashes: 1 MB on the driver and in each worker, for any number of hashes.
BITS = 1 << 23


def bit_table(rows: DataFrame, column: str) -> np.ndarray:
    """A bit for each slot that a hash of the column falls into, in 64-bit words.

    It lets through all rows whose hash is there, and by chance some others; a join follows.
    """
    slot = F.col(column).bitwiseAND(F.lit(BITS - 1))
    bits = (
        rows.groupBy(F.shiftright(slot, 6).alias("at"))
        .agg(F.bit_or(F.expr(f"shiftleft(1L, int(`{column}` & 63))")).alias("bits"))
        .toArrow()
    )
    table = np.zeros(BITS // 64, np.uint64)
    table[bits["at"].to_numpy()] = bits["bits"].to_numpy().view(np.uint64)
    return table


def passes(table: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which hashes have their bit in the table."""
    slot = hashes.view(np.uint64) & np.uint64(BITS - 1)
    word = table[(slot >> np.uint64(6)).astype(np.int64)]
    return (word >> (slot & np.uint64(63))) & np.uint64(1) == np.uint64(1)
