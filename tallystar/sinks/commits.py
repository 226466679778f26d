"""Files that are created whole, or not at all if they exist."""

from __future__ import annotations

import os
import uuid

from pyspark.errors import PySparkException
from pyspark.sql import SparkSession


def create_new(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a small file; False, and nothing is changed, if there is one of that name.

    Of two writers at once one succeeds, and a reader sees the whole text or no file: the text
    goes to a file of another name, which then gets its name by a step that the file system does
    atomically and refuses if the name is taken. On a local or mounted file system that is a hard
    link, elsewhere Hadoop's rename without overwriting, as HDFS does it. An object store that
    renames by copying gives no such promise; there only one job may load at a time.
    """
    jvm = spark._jvm
    final = jvm.org.apache.hadoop.fs.Path(path)
    fs = final.getFileSystem(spark._jsc.hadoopConfiguration())
    final = fs.makeQualified(final)
    draft = f"_{final.getName()}.{uuid.uuid4().hex}"  # hidden from Spark's readers
    if final.toUri().getScheme() == "file":
        name = final.toUri().getPath()
        folder = os.path.dirname(name)
        os.makedirs(folder, exist_ok=True)
        with open(f"{folder}/{draft}", "w", encoding="utf-8") as out:
            out.write(text)
            out.flush()
            os.fsync(out.fileno())
        try:
            os.link(f"{folder}/{draft}", name)
        except FileExistsError:
            return False
        finally:
            os.unlink(f"{folder}/{draft}")
        return True
    fs.mkdirs(final.getParent())
    temporary = jvm.org.apache.hadoop.fs.Path(final.getParent(), draft)
    out = fs.create(temporary, False)
    try:
        out.write(text.encode())
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        final.toUri(), spark._jsc.hadoopConfiguration()
    )
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(temporary, final, none)
    except PySparkException:
        if not fs.exists(final):
            raise
        fs.delete(temporary, False)
        return False
    return True
