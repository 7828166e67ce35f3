"""Reading run folders: strict JSON documents, recorded calls, run records, named queries, prompts."""

from __future__ import annotations

import json
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citeloom.operators.calls import unknown_keys


class UnknownKeys(ValueError):
    """A JSON document has keys that its schema does not."""


def read_documents(spark: SparkSession, paths: str | list[str], schema: StructType, strict: bool = True) -> DataFrame:
    """One row per JSON document (file). ``from_json`` would drop unknown keys in silence; here they are an error."""
    raw = spark.read.text(paths, wholetext=True)
    if strict:
        extra = raw.select(F.explode(unknown_keys(F.col("value"), schema.fieldNames())).alias("key")).distinct().limit(5).collect()
        if extra:
            raise UnknownKeys(", ".join(sorted(r["key"] for r in extra)))
    return raw.select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def read_recorded_calls(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Recorded calls, one per request hash: that of the last file by name (an aggregation that combines before the
    shuffle)."""
    rows = spark.read.schema(schema).option("multiLine", True).json(pattern).select("*", F.col("_metadata.file_name").alias("file"))
    last = rows.groupBy("request_hash").agg(F.max_by(F.struct(*(c for c in rows.columns if c != "request_hash")), "file").alias("r"))
    return last.select(*(F.col(c) if c == "request_hash" else F.col(f"r.{c}").alias(c) for c in rows.columns))


def read_run_records(spark: SparkSession, pattern: str, schema: str) -> DataFrame:
    """Run-record lines of sibling runs; lines that cannot be read are left out."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(pattern)


_BLOCK_HEAD = re.compile(r"^[ \t]*--[ \t]*name:[ \t]*(\w+)[ \t]*$", re.M)
_COMMENT = re.compile(r"^[ \t]*--.*$\n?", re.M)


def named_queries(text: str) -> dict[str, str]:
    """The queries of a SQL file by the name in the comment above each; other comment lines and the text before the
    first name are left out."""
    _, *parts = _BLOCK_HEAD.split(text)
    return dict(zip(parts[::2], (_COMMENT.sub("", sql).strip().rstrip(";") for sql in parts[1::2])))


def run_named(spark: SparkSession, queries: dict[str, str], name: str, **params) -> DataFrame:
    """A named query with its ``:parameters``; a parameter that is not given is null."""
    wanted = set(re.findall(r"(?<!:):(\w+)", queries[name]))
    return spark.sql(queries[name], args={p: params.get(p) for p in wanted})


def _is_folder(spark: SparkSession, path: str) -> bool:
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return files.exists(at) and files.getFileStatus(at).isDirectory()


def resolve_run(spark: SparkSession, ref: str, roots: list[str]) -> str:
    """The folder of a recorded run, on any file system that Spark reads: ``ref`` as a path, else as a name under the
    roots, in their order. A run is a folder with recordings (``llm``) in it."""
    places = [ref] + [root.rstrip("/") + "/" + ref for root in roots]
    found = next((place for place in places if _is_folder(spark, place + "/llm")), None)
    if found is None:
        raise FileNotFoundError(f"no recorded run {ref!r}")
    return found


def load_prompt(folder: str, version: str, name: str) -> str:
    return (Path(folder) / version / f"{name}.md").read_text(encoding="utf-8")


def _closed(node: dict) -> dict:
    """An object schema that allows its own properties only, all of them required; any other node as it is."""
    own = node.get("properties")
    return {**node, "required": list(own), "additionalProperties": False} if node.get("type") == "object" and own is not None else node


def strict_schema(schema: dict) -> dict:
    """A JSON schema in which every object, at any depth, is closed. The JSON reader calls ``_closed`` on each object as
    it leaves it, innermost first."""
    return json.loads(json.dumps(schema), object_hook=_closed)


def write_documents(df: DataFrame, path: str) -> None:
    """One JSON line per row."""
    df.write.mode("overwrite").json(path)


def write_report(df: DataFrame, path: str) -> None:
    """The rows of a small result (a step's outcome, an evaluation) as one readable JSON document each, in one file."""
    df.select(F.to_json(F.struct(*df.columns), {"pretty": "true"}).alias("value")).coalesce(1).write.mode("overwrite").text(path)


def record_calls(calls: DataFrame, path: str) -> None:
    """Append calls to the recordings; a request that is recorded already keeps its recording."""
    spark = calls.sparkSession
    fresh = calls.dropDuplicates(["request_hash"])
    if _is_folder(spark, path):
        fresh = fresh.join(spark.read.schema(calls.schema).parquet(path).select("request_hash"), "request_hash", "left_anti").select(calls.columns)
    fresh.write.mode("append").parquet(path)


def append_invocation(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def run_summary(invocations: DataFrame, phases: list[str], main: str) -> DataFrame:
    """Per run: the facts of its latest invocation that ran the main phase, and all phases that ran, in their order."""
    ran = F.array_contains("phases", F.lit(main))
    return invocations.groupBy("run_id").agg(
        F.max_by("model", F.when(ran, F.col("started_at"))).alias("model"), F.max(F.when(ran, F.col("started_at"))).alias("started_at"),
        F.array_intersect(F.array(*[F.lit(p) for p in phases]), F.flatten(F.collect_set("phases"))).alias("phases"),
    )
