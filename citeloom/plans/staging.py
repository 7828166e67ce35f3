"""Cutting lineage through the folder that all executors share.

Iterative operators write each round to ``spark.checkpoint.dir`` and read it back, so a lost executor costs the
running round only. The folder is the session's; one is made here only where none is named and the master is local.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_OWN: list[str] = []


def _drop_own() -> None:
    for path in _OWN:
        shutil.rmtree(path, ignore_errors=True)


atexit.register(_drop_own)


def shared_folder(spark: SparkSession) -> str:
    """The session's shared checkpoint folder; raises on a cluster that names none."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext._jsc.sc().getCheckpointDir()
    if context.isDefined():
        return context.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    own = tempfile.mkdtemp(prefix="citeloom-")
    _OWN.append(own)
    spark.conf.set("spark.checkpoint.dir", "file://" + own)
    return "file://" + own


def staged(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` once as a table in the shared folder and return the reader of that table."""
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/citeloom/{name}-{uuid.uuid4().hex}.parquet"
    df.write.option("compression", "zstd").parquet(path)
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(at)  # when the driver ends
    return spark.read.schema(df.schema).parquet(path)
