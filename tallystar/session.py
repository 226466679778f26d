"""Session settings the plans rely on, and the shared scratch folder."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    # Joins on a hot product are split at run time, and the written months are
    # cut to even files by the rebalance step; both need adaptive execution.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # A join whose partitions all turn out this small needs no sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
    # Columnar files are several times larger in memory; without this Spark would
    # broadcast tables by their compressed size.
    "spark.sql.sources.fileCompressionFactor": "5.0",
    # One task per 256 MB of input keeps files and tasks of a large load few.
    "spark.sql.files.maxPartitionBytes": "256m",
    # Size of a coalesced shuffle partition, and so of a written file.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.ui.enabled": "false",
}


def shuffle_partitions(shuffled_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Shuffle partitions that keep one near `target_bytes`, in whole waves of `cores`."""
    wanted = max(1, -(-shuffled_bytes // target_bytes))
    return cores * -(-wanted // cores)


def build_session(
    app: str = "tallystar", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the settings above; `settings` are extra Spark options with `_` for `.`."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in settings.items():
        builder = builder.config(key.replace("_", "."), value)
    return builder.getOrCreate()


def scratch_folder(spark: SparkSession) -> str:
    """A new path under the shared folder the cluster names in spark.checkpoint.dir.

    A session without that setting has to be local, all in one process. It gets the folder
    `checkpoints` in Spark's warehouse folder.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[[^,\]]*(,[^\]]*)?\])?", spark.conf.get("spark.master", "")):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return f"{base.rstrip('/')}/tallystar-{uuid.uuid4().hex}"
