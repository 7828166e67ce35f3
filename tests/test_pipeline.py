"""The phases on the smallest tables, the command line, and answers of the read side."""

import pytest
from pyspark.sql import functions as F

from citeloom import pipeline
from citeloom.operators import evaluate as E
from citeloom.operators import runlog, serve
from citeloom.operators import warehouse as W


@pytest.fixture(scope="module")
def run(spark, data, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("run"))
    one = pipeline.Run(spark, data, out, "run1")
    return one, pipeline.run_phases(one, list(pipeline.PHASES), keep_going=True)


def test_phases_write_their_tables_and_log(spark, run, data):
    one, status = run
    log = spark.read.parquet(f"{one.out}/run_checks")
    assert {r.phase for r in log.select("phase").distinct().collect()} == {"extract", "transform", "load"} and status in ("warnings", "error")
    assert log.where("check_id = 'rows_written' AND outcome <> 'ok'").count() == 0 and log.where("check_id = 'pipeline_reproducibility' AND outcome <> 'ok'").count() == 0
    stored = W.stored(spark, f"{one.out}/store", "risk_instance")
    assert stored.count() == spark.read.parquet(f"{data}/risk_instance.parquet").count()
    assert spark.read.parquet(f"{one.out}/blocks").where("strategy = 'plain_text'").count() > 0
    assert serve.health(spark, f"{one.out}/store")["schema_version"] == W.SCHEMA_VERSION and serve.health(spark, f"{one.out}/none")["status"] == "error"
    assert serve.run_record(log, "run1", "load").select("detail").first()[0]


def test_broken_parser_is_logged(spark, data, tmp_path):
    one = pipeline.Run(spark, data, str(tmp_path), "run2", break_parser=True)
    log = one.extract()
    assert log.where("check_id = 'parser_override' AND outcome = 'warning'").count() > 0


def test_score(spark, data, tmp_path):
    ri = spark.read.parquet(f"{data}/risk_instance.parquet").where("canonical_risk_id IS NOT NULL")
    golden = F.struct(F.col("page"), F.col("section"), F.lit(None).cast("int").alias("also_on_page"), F.array().cast("array<string>").alias("key_phrases"), F.array("category").alias("acceptable_categories"), F.col("category"),
                      (F.coalesce("mitigation", F.lit("")) != "").alias("mitigation_stated"), F.lit(None).cast("array<string>").alias("mitigation_phrases"))
    ri.select("report_id", F.col("canonical_risk_id").alias("golden_id"), golden.alias("golden")).write.parquet(str(tmp_path / "golden"))
    passed = pipeline.score_run(spark, data, str(tmp_path / "golden"), str(tmp_path / "out"))
    assert passed is False or passed is True
    assert spark.read.text(str(tmp_path / "out" / "evaluators")).count() > 0 and spark.read.text(str(tmp_path / "out" / "identification")).count() > 0


def test_command_line(capsys):
    assert pipeline.main(["etl", "--list"]) == 0 and capsys.readouterr().out.split() == list(pipeline.PHASES)
    with pytest.raises(SystemExit):
        pipeline.main(["etl", "--grounding", "other"])


def test_answers(spark, data):
    t = serve.Tables.read(spark, data)
    answer = serve.risks(t, serve.Intent(categories=["cyber"]), 5)
    assert answer["count"] == len(answer["records"]) <= 5 and answer["sector_matched"] is None and all("citations" in r and "cyber" in r["categories"] for r in answer["records"])
    some = answer["records"][0]["id"]
    assert serve.risk(t, some)["id"] == some
    with pytest.raises(serve.NotFound):
        serve.risk(t, "no such id")
    assert serve.risks(t, serve.Intent(sector="no such sector"), 5)["sector_matched"] == []
    calls = spark.createDataFrame([("h", "c", '{"categories": ["cyber"]}', 1)], "request_hash string, call_id string, response_content string, created_at int")
    assert serve.ask(t, calls, "h", 3).count() <= 3


def test_golden_rows(spark):
    fields = "page int, section string, also_on_page int, key_phrases array<string>, acceptable_categories array<string>, category string, mitigation_stated boolean, mitigation_phrases array<string>"
    rec = "page int, section string, pages array<int>, sections array<string>, description string, mitigation string, category string, page_text string"
    good = (5, "rm", [5, 7], ["rm"], "Storms may stop work for 40m. Covers are short.", "We buy covers.", "climate", "storms 40m x")
    bad = (6, "cc", None, None, "Storms cost 35.", None, "cyber", "storms 350")
    want = (5, "rm", 7, ["storms"], ["climate"], "climate", True, ["covers"])
    df = spark.createDataFrame([("r", "g1", want, good), ("r", "g2", want, bad)], f"report_id string, golden_id string, golden struct<{fields.replace(' ', ':').replace(',:', ',')}>, record struct<{rec.replace(' ', ':').replace(',:', ',')}>")
    got = {(r.golden_id, r.evaluator): r.problems for r in E.match_problems(df, "report_id").collect()}
    assert all(not got["g1", e] for e in E.PER_MATCH)
    assert got["g2", "provenance"] == ["page:6!=5", "section:cc!=rm", "missing_citation_page:7"] and got["g2", "grounding"] == ["invented_number:35"]
    assert got["g2", "category"] == ["category:cyber!=climate"] and got["g2", "fields"] == ["sentences:1", "mitigation_present:false!=true"]
    scores = {r.evaluator: (r.score, r.passed, len(r.failures)) for r in E.evaluated(E.match_problems(df, "report_id"), "report_id").collect()}
    assert set(scores.values()) == {(0.5, False, 1)}
    a, b = spark.createDataFrame([("r", "x"), ("r", "y")], "g string, k string"), spark.createDataFrame([("r", "x"), ("r", "z")], "g string, k string")
    row = E.identification_passes(E.identification(a, b, ["k"], ["g"]), a, b, ["k"], "g").first()
    assert (row.passed, row.failures) == (False, ["extra:z", "missing:y"])
    sizes = E.label_sizes(spark.createDataFrame([("p", "a"), ("p", "a"), ("q", "a"), ("q", "b"), ("q", None)], "label string, v string"), "label", "v").collect()
    assert [tuple(r) for r in sizes] == [("q", 2, 2), ("p", 1, 2)]


def test_lines_show_single_details(spark):
    df = spark.createDataFrame([("r", "c", "warning", 2, "s", '{"b": 1, "list": [1], "a": "x"}'), ("r", "d", "ok", 1, None, None)], "run_id string, check_id string, outcome string, count int, strategy string, detail string")
    assert sorted(r.line for r in runlog.rendered(df).collect()) == ["! c 2 [s] a=x b=1", "+ d 1"]
