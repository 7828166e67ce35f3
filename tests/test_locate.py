"""Locating configured sections and writing the check log."""

import json

import pytest
from pyspark.sql import functions as F

from citeloom.operators import checks as K
from citeloom.operators import locate as L


@pytest.fixture(scope="module")
def specs(spark):
    rows = [("rm", 1, ["Risk management", "Risks"], 50, 51, True), ("iro", 2, ["Material impacts, risks, and opportunities"], 71, 74, True), ("wx", 3, ["Weather outlook"], 85, 92, False)]
    return spark.createDataFrame(rows, "section string, spec_no int, titles array<string>, first_page int, last_page int, required boolean")


def documents(spark):
    """``a`` has links; ``b`` none, and pages shifted by one; ``c`` nothing of use."""
    entries = [
        ("a", 1, "Risk management", 50, 49, 1), ("a", 2, "Material impacts, risks and opportunity", 71, 70, 1), ("a", 3, "Quarterly review", 75, 74, 1),
        ("b", 1, "Risk management and internal control", 50, None, 1), ("b", 2, "Material impacts, risks, and opportunities (cont.)", 72, None, 1), ("b", 3, "Weather outlook", 85, None, 2), ("c", 1, "Other", 9, None, 1),
    ]
    pages, footers = [], []
    for doc, shift in (("a", 0), ("b", 1), ("c", 0)):
        for printed in range(1, 96):
            text = {50: "Our RISK management", 71: "Material impacts, risks, and opportunities", 72: "material impacts, risks, and opportunities", 85: "outlook"}.get(printed, "x")
            pages.append((doc, printed - 1 + shift, text))
            if doc != "c" and printed != 49:
                footers.append((doc, printed - 1 + shift, printed))
    df = spark.createDataFrame
    return df(entries, "d string, entry_no int, title string, printed_page int, pdf_index int, page_index int"), df(pages, "d string, pdf_index int, text string"), df(footers, "d string, pdf_index int, number int")


def test_located(spark, specs):
    entries, pages, footers = documents(spark)
    rows = L.located(specs, entries, pages, footers, "d").collect()
    got = {(r.d, r.section): r for r in rows}
    rm = got["a", "rm"]
    assert (rm.match_grade, rm.first_page, rm.last_page, rm.pdf_index, rm.source, rm.outcome, rm.quality_flags) == ("exact", 50, 51, 49, "toc_link", "ok", [])
    iro = got["a", "iro"]
    assert (iro.match_grade, iro.last_page, iro.outcome) == ("similarity", 74, "warning") and iro.quality_flags[0].startswith("toc_title_similarity:0.9")
    assert (got["a", "wx"].match_grade, got["a", "wx"].source, got["a", "wx"].outcome, got["a", "wx"].first_page) == ("none", "config", "warning", 85)
    b = got["b", "rm"]
    assert (b.match_grade, b.pdf_index, b.page_offset, b.offset_source, b.source) == ("variant", 50, 1, "toc_footer", "toc_footer")
    # Another first page than configured: the configured end does not cap, and the flag says so.
    assert (got["b", "iro"].first_page, got["b", "iro"].last_page) == (72, 84) and "toc_page_differs_from_config:toc=72,config=71" in got["b", "iro"].quality_flags
    assert "heading_not_on_first_page:85" in got["b", "wx"].quality_flags and got["b", "wx"].outcome == "warning"
    c = got["c", "rm"]
    assert (c.page_offset, c.offset_source, c.outcome) == (0, "config", "error") and c.quality_flags == ["toc_title_not_found:Risk management", "printed_page_mismatch:footer=none,expected=50"]
    located = L.located(specs, entries, pages, footers, "d").withColumnRenamed("d", "report_id")
    log = {(r.report_id, r.check_id, json.loads(r.detail).get("section")): r for r in K.locate_checks(located, entries.withColumnRenamed("d", "report_id")).collect()}
    assert log["a", "toc_pages", None]["count"] == 3 and ("a", "page_offset", None) not in log
    assert log["b", "page_offset", None].outcome == "ok" and log["c", "page_offset", None].outcome == "warning"
    assert log["c", "section_match_grade", "rm"].outcome == "error" and log["c", "section_match_grade", "wx"].outcome == "warning" and log["a", "section_match_grade", "iro"].outcome == "warning"


def test_offset_needs_the_way_back(spark):
    sizes = spark.createDataFrame([("a", 20)], "d string, page_count int")
    probes = spark.createDataFrame([("a", 1, 5), ("a", 2, 10), ("a", 3, 15)], "d string, seq int, printed_page int")
    # 5 is found two pages on; at 10 the first number seen contradicts itself; 15 has none within six pages.
    footers = spark.createDataFrame([("a", 6, 5), ("a", 9, 3), ("a", 11, 10)], "d string, pdf_index int, number int")
    assert [(r.seq, r.page_offset) for r in L.measured_offsets(probes, footers, sizes, "d").collect()] == [(1, 2)]


def test_outcomes_and_links(spark):
    df = spark.createDataFrame([(True, True, False), (False, True, False), (True, False, False), (True, True, True)], "r boolean, f boolean, s boolean")
    assert [x[0] for x in df.select(L.outcome(df.r, df.f, df.s)).collect()] == ["error", "warning", "ok", "warning"]
    links = spark.createDataFrame([("GOTO", 3), ("NAMED", -1), ("URI", 2), ("named", 0)], "kind string, dest_index int")
    assert sorted(r.dest_index for r in L.internal_links(links).collect()) == [0, 3]


BLOCK = "report_id string, block_id string, section string, page int, strategy string, heading string, text string, fields map<string,string>, marker string, quality_flags array<string>"


def test_extract_checks(spark):
    erm = [("r", f"p51-erm-{i}", "rm", 51, "main_risks_table", f"T{i}", "alpha beta gamma", {"a": "x", "b": "y", "c": "z" if i else ""}, "risk", []) for i in range(3)]
    fin = [("r", "f1", "iro", 71, "esrs_table", "H", "delta epsilon zeta", {}, "risk", ["marker_icon_missing"]), ("r", "f1", "iro", 80, "esrs_table", "H", "unknown words here", {}, "opportunity", ["marker_disagreement:x"])]
    plain = [("q", "p1-text", "cc", 1, "plain_text", "", "never checked", {}, "none", None)]
    blocks = spark.createDataFrame(erm + fin + plain, BLOCK)
    sections = spark.createDataFrame([("r", "rm", True, "ok", 50, 51), ("r", "iro", True, "ok", 71, 74), ("r", "cc", False, "ok", 85, 92), ("r", "bad", True, "error", 1, 1), ("q", "cc", True, "ok", 1, 1)], "report_id string, section string, required boolean, outcome string, first_page int, last_page int")
    pages = spark.createDataFrame([("r", 51, "alpha beta gamma"), ("r", 71, "delta epsilon zeta eta"), ("r", 80, "other"), ("q", 1, "x")], "report_id string, page int, text string")
    words = spark.createDataFrame([("r", 71, w, 100.0) for w in ("H", "delta", "epsilon", "zeta")] + [("r", 71, "header", 10.0), ("r", 80, "lost", 90.0), ("q", 1, "x", 90.0)], "report_id string, page int, word string, top double")
    previous = spark.createDataFrame([("r", "51:risk", 3), ("r", "99:risk", 1)], "report_id string, key string, n long")
    log = {(r.report_id, r.check_id, json.loads(r.detail or "{}").get("section")): r for r in K.extract_checks(sections, blocks, pages, words, previous).collect()}
    assert (log["r", "blocks_per_section", "rm"].outcome, log["r", "blocks_per_section", "cc"].outcome, ("r", "blocks_per_section", "bad") in log) == ("ok", "warning", False)
    assert log["r", "main_risks_shape", None].outcome == "error" and json.loads(log["r", "main_risks_shape", None].detail)["empty"] == ["T0/c"]
    assert (log["r", "marker_missing", None]["count"], log["r", "marker_disagreement", None]["count"], log["q", "marker_missing", None].outcome) == (1, 1, "ok")
    assert (log["r", "text_not_on_page", None].outcome, log["r", "text_not_on_page", None]["count"], log["q", "text_not_on_page", None].outcome) == ("error", 1, "ok")
    assert (log["r", "page_coverage", None].outcome, log["r", "page_coverage", None]["count"]) == ("warning", 1)
    assert json.loads(log["r", "block_ids_and_ranges", None].detail)["outside"] == ["f1"] and log["r", "block_ids_and_ranges", None]["count"] == 2
    drift = {c["key"] for c in json.loads(log["r", "count_drift", None].detail)["changed"]}
    assert drift == {"71:risk", "80:opportunity", "99:risk"} and log["q", "count_drift", None].outcome == "ok"
    assert K.drift_check(K.marker_counts(blocks), None).where("outcome = 'ok'").count() == 2


def test_transform_and_load_checks(spark):
    df = spark.createDataFrame
    rows = lambda x: {(r.report_id, r.check_id): (r.outcome, r["count"]) for r in x.collect()}
    cand = df([("r", "erm_main_risk", 3), ("r", "esrs_financial_risk", 6), ("e", "erm_main_risk", 0)], "report_id string, source_register string, n int")
    agree = df([("r", 6, 9), ("e", 0, 0), ("g", 9, 9)], "report_id string, matched int, total int")
    got = rows(K.identify_checks(cand, agree))
    assert got[("r", "identify_register")] == ("ok", 9) and got[("e", "identify_register")] == ("error", 0)
    assert [got[(k, "identify_agreement")][0] for k in "reg"] == ["warning", "warning", "ok"]
    recs = df([("r", "c1", "a"), ("r", "c1", "b"), ("s", "c2", "c"), ("s", None, "d"), ("s", None, "e")], "report_id string, canonical_risk_id string, id string")
    want = df([("r", 3, 1), ("s", 4, 1)], "report_id string, candidates int, merges int")
    assert rows(K.set_checks(recs, want)) == {("r", "transform_set_checks"): ("error", 1), ("s", "transform_set_checks"): ("ok", 0)}
    assert rows(K.reproducibility(recs, recs, ["id"])) == {("r", "pipeline_reproducibility"): ("ok", 0), ("s", "pipeline_reproducibility"): ("ok", 0)}
    assert rows(K.reproducibility(recs, recs.where("id <> 'c'"), ["id"]))[("s", "pipeline_reproducibility")] == ("error", 1)
    checked = df([("r", str(i), ["x"] if i < 2 else [], i == 5) for i in range(9)], "report_id string, id string, problems array<string>, repaired boolean")
    assert rows(K.grounding_check(checked)) == {("r", "grounding_failures"): ("warning", 2)}
    scores = df([("r", "fields", 0.5, False), ("r", "category", 1.0, True)], "report_id string, evaluator string, score double, passed boolean")
    assert rows(K.eval_check(scores)) == {("r", "eval_scores"): ("error", 1)}
    assert rows(K.rows_check(recs, recs.where("id <> 'a'"))) == {("r", "rows_written"): ("error", 2), ("s", "rows_written"): ("ok", 3)}
    assert rows(K.counted(recs, "merge", F.col("canonical_risk_id").isNotNull(), F.col("id")))[("r", "merge")] == ("ok", 2)
    assert rows(K.questions_check({"top": recs, "new": recs.limit(0)}))[("r", "brief_queries")] == ("ok", 2)
    assert rows(K.intent_check(df([("r", 0.7, False, 9)], "report_id string, score double, passed boolean, questions int"))) == {("r", "intent_agreement"): ("warning", 9)}
    assert rows(K.parser_override(recs, "chunks"))[("s", "parser_override")] == ("warning", 1)
    log = df([("run1", "r", "count_drift", '{"counts": {"1:risk": 2}}'), ("run2", "r", "count_drift", '{"counts": {"1:risk": 5}}'), ("run3", "r", "count_drift", "{}"), ("run4", "r", "count_drift", '{"counts": {"1:risk": 9}}')], "run_id string, report_id string, check_id string, detail string")
    assert [tuple(r) for r in K.previous_counts(log, "run4").collect()] == [("r", "1:risk", 5)]
    stamp = spark.sql("SELECT timestamp'2026-01-02 03:04:05' AS t").select(K.run_id(F.col("t"))).first()[0]
    assert stamp == "20260102T030405Z" and K.stamped(K.eval_check(scores), "run9").columns[0] == "run_id"


def test_contents_pages_and_linked_entries(spark):
    from citeloom.operators import sections as S

    listed = "\n".join(f"{t} ........ {n}" for n, t in enumerate(["Strategy", "Risks", "Climate", "People", "Accounts"], 3))
    pages = spark.createDataFrame([("d", 2, listed), ("d", 3, "Strategy ..... 3\nprose"), ("d", 12, listed), ("d", 4, None)], "doc_id string, pdf_index int, text string")
    assert [r.pdf_index for r in S.contents_pages(pages).collect()] == [2]
    entries = spark.createDataFrame([("d", 1, "Strategy", 50.0, 100.0), ("d", 2, "Risks", 50.0, 130.0), ("d", 3, "People", 300.0, 160.0), ("e", 1, "Alone", 50.0, 100.0)], "doc_id string, entry_no int, title string, x0 double, y_mid double")
    links = [("d", 1, 40.0, 200.0, 95.0, 105.0, 9), ("d", 2, 40.0, 200.0, 95.0, 132.0, 11), ("d", 3, 303.0, 400.0, 162.0, 170.0, 20), ("d", 4, 53.5, 200.0, 125.0, 135.0, 30)]
    found = S.linked_entries(entries, spark.createDataFrame(links, "doc_id string, seq int, x0 double, x1 double, y0 double, y1 double, dest_index int"), ["doc_id"])
    # The first link wins; two points above and below and three to the left are allowed.
    assert {(r.doc_id, r.entry_no): r.pdf_index for r in found.collect()} == {("d", 1): 9, ("d", 2): 11, ("d", 3): 20, ("e", 1): None}
