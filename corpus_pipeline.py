"""From raw documents to packed sequences, by five operators of tallystar.llm.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage before kept. All
but the last return the columns of the documents; run() writes each stage's result as Parquet
below the session's shared folder and reads it again for the next. Columns beyond those that a
stage uses are carried along as they are, whatever their names. Null and empty texts are rejected by
the first stage; of rows that repeat a text one stays after the second; very long texts are handled
whole; any stage accepts an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallystar.llm.disclosure import Sanitiser
from tallystar.llm.fertility import fitted_quality
from tallystar.llm.grouped_prefix_join import GroupedPrefixJoin
from tallystar.llm.packing import packed
from tallystar.llm.winnowing import Winnowing
from tallystar.session import scratch_folder


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules and the fertility rules accept (operator 7).

    The bands are fitted to all labelled training documents of the folder that are good.
    """
    labels = spark.read.parquet(f"{sf_dir.rstrip('/')}/labels.parquet")
    kept = fitted_quality(docs, labels, carried=tuple(docs.columns)).where("kept")
    return kept.select(*[F.col(f"`kept_{c}`").alias(c) for c in docs.columns])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of five-word similarity 0.8 or more (operator 10)."""
    join = GroupedPrefixJoin(docs, k=5, percent=80)
    kept = join.representatives(docs)
    join.release()
    return kept


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without ten consecutive words of a benchmark item (operator 9)."""
    benchmark = spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet")
    return Winnowing(docs, benchmark).clean(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with personal data and terms that disclose it taken out (operator 6)."""
    clean = Sanitiser(docs).sanitised(docs)
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        clean = clean.withColumn("n_chars", F.length("text").cast(kind))
    return clean


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 1024 tokens (operator 4)."""
    return packed(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("packing", packing),
]

#: SQL has neither the tokenisers nor the packing; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; the result is the last stage's."""
    folder = scratch_folder(spark)
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = f"{folder}/{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
