"""Run checks as a stream: keyed last-wins upserts and windowed counts with late rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citeloom.operators.runlog import last_wins


def check_stream(spark: SparkSession, folder: str, schema, files_per_batch: int = 1) -> DataFrame:
    """New check files of a folder."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


#: Parts of the target table, by the hash of a check's key.
PARTS = 64


def _part() -> Column:
    key = F.struct("run_id", "phase", "check_id", F.get_json_object("detail", "$.section"))
    return F.pmod(F.xxhash64(key), F.lit(PARTS)).cast("int")


def upsert_stream(stream: DataFrame, target: str, checkpoint: str) -> None:
    """Keep the last row of each check in ``target``, micro-batch by micro-batch, and stop when the input is read.

    The target is cut into parts by the hash of the check's key. A batch reads and writes the parts that it touches,
    each as a file of its own generation (``part=../generation=..``); a part's greatest generation counts, so work
    follows the batch and not the table, and a batch that runs again after a failure writes the same folders again.
    """

    def merge(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        fresh = batch.withColumn("part", _part())
        touched = sorted(r["part"] for r in fresh.select("part").distinct().collect())  # at most PARTS numbers
        if not touched:
            return
        old = _latest(spark, target, batch.schema, touched, number)
        rows = batch if old is None else old.unionByName(batch)
        last_wins(rows).drop("section").withColumn("part", _part()).withColumn("generation", F.lit(number)).repartition("part").write.mode("overwrite").option(
            "partitionOverwriteMode", "dynamic"
        ).partitionBy("part", "generation").parquet(target)

    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def _latest(spark: SparkSession, target: str, schema: StructType, parts: list[int] | None = None, before: int | None = None) -> DataFrame | None:
    """The rows of the greatest generation of each part; only folders are listed, no data is read for it."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(target)
    files = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(root):
        return None
    found: dict[int, int] = {}
    for status in files.globStatus(context._jvm.org.apache.hadoop.fs.Path(f"{target}/part=*/generation=*")):
        part, generation = (int(x.rpartition("=")[2]) for x in (status.getPath().getParent().getName(), status.getPath().getName()))
        if (parts is None or part in parts) and (before is None or generation < before):
            found[part] = max(found.get(part, -1), generation)
    if not found:
        return None
    paths = [f"{target}/part={p}/generation={g}" for p, g in sorted(found.items())]
    return spark.read.schema(schema).parquet(*paths)


def latest_generation(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The table that ``upsert_stream`` keeps."""
    rows = _latest(spark, target, schema)
    return spark.createDataFrame([], schema) if rows is None else rows


def outcome_counts(stream: DataFrame, late: str = "7 days", window: str = "1 day") -> DataFrame:
    """Outcomes per day; rows that come later than ``late`` are left out."""
    return stream.withWatermark("created_at", late).groupBy(F.window("created_at", window), "outcome").agg(F.count("*").alias("n"))
