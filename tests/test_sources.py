import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from citeloom.plans.staging import shared_folder, staged
from citeloom.sources import documents as D
from citeloom.streaming import checks


def test_strict_documents(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"title": "t", "page": 3}))
    schema = StructType.fromDDL("title string, page int")
    assert [tuple(r) for r in D.read_documents(spark, str(tmp_path / "a.json"), schema).collect()] == [("t", 3)]
    (tmp_path / "b.json").write_text(json.dumps({"title": "t", "colour": 3}))
    with pytest.raises(D.UnknownKeys):
        D.read_documents(spark, str(tmp_path / "*.json"), schema)


def test_recordings_last_file_wins(spark, tmp_path):
    for name, reply in (("1", "old"), ("2", "new")):
        (tmp_path / f"{name}.json").write_text(json.dumps({"request_hash": "h", "reply": reply}))
    assert [r.reply for r in D.read_recorded_calls(spark, str(tmp_path / "*.json"), "request_hash string, reply string").collect()] == ["new"]
    (tmp_path / "log.jsonl").write_text('{"run_id": "a"}\nnot json\n')
    assert [r.run_id for r in D.read_run_records(spark, str(tmp_path / "log.jsonl"), "run_id string").collect()] == ["a"]


def test_named_queries(spark):
    found = D.named_queries("-- intro\n-- name: one\n-- says what\nSELECT id FROM range(5)\nWHERE (:n IS NULL OR id = :n);\n\n-- name: two\nSELECT 1")
    assert list(found) == ["one", "two"]
    assert D.run_named(spark, found, "one").count() == 5 and D.run_named(spark, found, "one", n=3).count() == 1


def test_runs_prompts_schemas(spark, tmp_path):
    (tmp_path / "runs" / "r1" / "llm").mkdir(parents=True)
    assert D.resolve_run(spark, "r1", [str(tmp_path / "x"), str(tmp_path / "runs")]) == str(tmp_path / "runs" / "r1")
    assert D.resolve_run(spark, str(tmp_path / "runs" / "r1"), []) == str(tmp_path / "runs" / "r1")
    with pytest.raises(FileNotFoundError):
        D.resolve_run(spark, "r2", [str(tmp_path)])
    (tmp_path / "v1").mkdir()
    (tmp_path / "v1" / "intent.md").write_text("prompt")
    assert D.load_prompt(str(tmp_path), "v1", "intent") == "prompt"
    inner = D.strict_schema({"type": "object", "properties": {"a": {"type": "object", "properties": {"b": {}}}}})
    assert inner["required"] == ["a"] and inner["properties"]["a"]["additionalProperties"] is False
    rows = [("r", ["transform"], "m1", 1), ("r", ["load"], "m2", 2), ("r", ["extract"], "m3", 0)]
    got = D.run_summary(spark.createDataFrame(rows, "run_id string, phases array<string>, model string, started_at int"), ["extract", "transform", "load"], "transform").first()
    assert (got.model, got.started_at, got.phases) == ("m1", 1, ["extract", "transform", "load"])


def test_reports_and_recordings(spark, tmp_path):
    D.write_report(spark.createDataFrame([("r", 0.9)], "run_id string, score double"), str(tmp_path / "report"))
    assert json.loads((next((tmp_path / "report").glob("part-*.txt"))).read_text()) == {"run_id": "r", "score": 0.9}
    for rows in ([("h1", "a"), ("h1", "a")], [("h1", "later"), ("h2", "b")]):
        D.record_calls(spark.createDataFrame(rows, "request_hash string, reply string"), str(tmp_path / "calls"))
    assert sorted(map(tuple, spark.read.parquet(str(tmp_path / "calls")).collect())) == [("h1", "a"), ("h2", "b")]
    D.write_documents(spark.range(3), str(tmp_path / "docs"))
    assert spark.read.json(str(tmp_path / "docs")).count() == 3
    for model in ("m1", "m2"):
        D.append_invocation(spark.createDataFrame([(model,)], "model string"), str(tmp_path / "runs"))
    assert spark.read.parquet(str(tmp_path / "runs")).count() == 2


def test_staging_keeps_rows_and_cuts_the_plan(spark):
    df = staged(spark.range(10).withColumn("x", F.col("id") * 2), "t")
    assert df.agg(F.sum("x")).first()[0] == 90 and "Range" not in df._jdf.queryExecution().toString()
    assert shared_folder(spark) == shared_folder(spark)


def test_stream_upserts(spark, tmp_path):
    schema = "run_id string, report_id string, phase string, check_id string, outcome string, count int, strategy string, detail string, created_at timestamp"
    src = str(tmp_path / "in")
    for i, outcome in enumerate(("error", "ok")):
        rows = spark.sql(f"SELECT 'r' AS run_id, 'x' AS report_id, 'p' AS phase, 'c{{}}' AS check_id, '{outcome}' AS outcome, {i} AS count, cast(null AS string) AS strategy, cast(null AS string) AS detail, timestamp'2025-01-0{i + 1} 00:00:00' AS created_at")
        rows.coalesce(1).write.mode("append").parquet(src)
    stream = checks.check_stream(spark, src, spark.read.parquet(src).schema)
    checks.upsert_stream(stream, str(tmp_path / "out"), str(tmp_path / "log"))
    assert [r.outcome for r in checks.latest_generation(spark, str(tmp_path / "out"), spark.read.parquet(src).schema).collect()] == ["ok"]
    counts = checks.outcome_counts(spark.readStream.schema(schema).parquet(src))
    query = counts.writeStream.format("memory").queryName("outcomes").outputMode("complete").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table("outcomes").agg(F.sum("n")).first()[0] == 2


def test_package_is_sent_once(spark):
    from citeloom.plans.shipping import ship_package

    ship_package(spark)
    sent = [f for f in spark.sparkContext._python_includes if f.startswith("citeloom")]
    ship_package(spark)
    assert sent and sent == [f for f in spark.sparkContext._python_includes if f.startswith("citeloom")]
