"""Merged records, enrichment from topical pages, comparison of candidates, stored reports, words of a span."""

import pytest
from pyspark.sql import functions as F

from citeloom.operators import compare as X
from citeloom.operators import records as R
from citeloom.operators import warehouse as W
from citeloom.sources.pdf import span_words


def test_table_matches_and_type_lines(spark):
    page = "Intro\nType of impact: Negative\nold quote here\nType of impact: Risk, actual\nThe plant may flood when the river rises in spring."
    proposed = spark.createDataFrame(
        [("r", 1, 7, "Floods", "The plant may flood when the river rises"), ("r", 2, 7, "Cyber attack", "no such quote"), ("r", 3, 7, "Drought", "Intro"), ("r", 4, 7, "Cyber attack", "old quote here")],
        "report_id string, seq int, page int, title string, span string",
    )
    tables = spark.createDataFrame([("r", 1, "Weather", "River floods", "The plant may flood when the river rises in spring"), ("r", 2, "Cyber attacks", "Servers", None), ("r", 3, "Strikes", "Staff", None)], "report_id string, table_no int, title string, span string, impact string")
    pages = spark.createDataFrame([("r", 7, page)], "report_id string, page int, text string")
    blocks = spark.createDataFrame([("r", 7, "b2", "the plant may flood when the river rises in spring", "risk"), ("r", 7, "b1", "other", "impact")], "report_id string, page int, block_id string, text string, marker string")
    found = X.identified_all(proposed, tables, pages, blocks, "report_id")
    got = {r.seq: (r.table_no, r.matched_by, r.table_row, r.type_above) for r in found.collect()}
    assert got == {1: (1, "quote", "risk", "Risk, actual"), 3: (None, None, None, None), 4: (2, "title", None, "Negative")}
    row = X.identified_summary(proposed, found, tables, "report_id").first()
    assert (row.proposed, row.kept, row.dropped, row.table_risks, row.found, row.missed) == (4, 3, 1, 3, 2, ["Strikes"])


def test_merged_records(spark):
    cols = "report_id string, id string, company_id string, title string, verbatim_title string, source_taxonomy string, source_register string, section string, page int, prominence int, verbatim_span string, poor_fit boolean, poor_fit_reason string"
    rows = [("r", "a", "co", "Cyber", "Cyber attacks", None, "erm", "rm", 51, 1, "s1", False, None), ("r", "b", "co", "Cyber", "Cyber crime", "S4", "esrs", "iro", 73, 2, "s2", False, None), ("r", "c", "co", "Dust", "Dust", "E2", "esrs", "iro", 71, 2, "s3", True, "none fits"), ("r", "d", "co", "Hack", "Hackers", "S4", "esrs", "iro", 74, 2, "s4", None, None)]
    pairs = spark.createDataFrame([("r", "b", "a"), ("r", "d", "a")], "report_id string, merged_id string, anchor_id string")
    got = {r.record_no: r for r in R.merged_records(spark.createDataFrame(rows, cols), pairs, "report_id").collect()}
    assert set(got) == {"r01", "r02"} and (got["r01"].id, got["r02"].id) == ("a", "c")
    assert got["r01"].canonical_risk_id == "co-s4-cyber-crime" and [c.page for c in got["r01"].citations] == [51, 73, 74]
    assert got["r02"].canonical_risk_id == "co-e2-dust" and got["r02"].quality_flags == ["poor_fit:none fits"] and got["r01"].quality_flags == []


def test_enrichment_from_topical_pages(spark):
    recs = [("1", "r", "Own title", "Sea level", None, "esrs_financial_risk", ["x"]), ("2", "r", "Sea level", None, "", "erm_main_risk", None), ("3", "r", "Sea level", None, "has one", "esrs_financial_risk", None), ("4", "r", "Tides", None, None, "esrs_financial_risk", None)]
    recs = spark.createDataFrame(recs, "id string, report_id string, title string, verbatim_title string, mitigation string, source_register string, quality_flags array<string>")
    para = "Actions and resources\nWe build dykes."
    pages = [("r", 5, "Sea level rises.\n" + para, "early"), ("r", 8, "Sea-level.\nType of impact: risk", "cc"), ("r", 9, para, "cc2"), ("r", 10, "Sea level. Type of impact\n" + para, "late"), ("r", 11, "Tides: type of impact", "t")]
    got = R.enriched(recs, spark.createDataFrame(pages, "report_id string, page int, text string, section string")).collect()
    assert [(r.id, r.mitigation, r.mitigation_page, r.citation.section, r.citation.span, r.quality_flags) for r in got] == [("1", "We build dykes.", 9, "cc2", "We build dykes.", ["x", "mitigation_from_topical_section:p9"])]


def test_reports_are_loaded_as_a_unit(spark, tmp_path):
    folder = str(tmp_path)

    def tables(reports, title, citation=True):
        df = spark.createDataFrame
        out = {
            "company": df([("c", title)], "id string, name string"), "report": df([(r, "c", title) for r in reports], "id string, company_id string, file string"), "canonical_risk": df([("k", title)], "id string, canonical_title string"),
            "risk_instance": df([(f"{r}-{title}", r) for r in reports], "id string, report_id string"),
        }
        return out | ({"risk_citation": df([(f"{r}-{title}", r) for r in reports] * 2, "risk_instance_id string, report_id string")} if citation else {})

    W.load_reports(tables(["a", "b"], "first"), folder, "l1")
    W.load_reports(tables(["a"], "second"), folder, "l2")
    # A load that broke off wrote a table but no row of loads.
    tables(["b"], "broken")["risk_instance"].write.parquet(f"{folder}/risk_instance/load=l3")
    ids = sorted(r.id for r in W.stored(spark, folder, "risk_instance").collect())
    assert ids == ["a-second", "b-first"]
    assert sorted(r.risk_instance_id for r in W.stored(spark, folder, "risk_citation").collect()) == ["a-second"] * 2 + ["b-first"] * 2
    assert [r.name for r in W.stored(spark, folder, "company").collect()] == ["second"] and [r.canonical_title for r in W.stored(spark, folder, "canonical_risk").collect()] == ["first"]
    assert sorted((r.id, r.file) for r in W.stored(spark, folder, "report").collect()) == [("a", "second"), ("b", "first")]
    with pytest.raises(ValueError):
        W.load_reports({**tables(["a"], "x"), "other": spark.range(1)}, folder, "l4")


def test_words_of_a_span():
    text = "Own work\x07 force x"
    chars = [{"c": c, "bbox": (10 * i, 5 + (c == "k"), 10 * i + 9, 15)} for i, c in enumerate(text)]
    words = span_words({"font": "Inter-Semi-Medium", "size": 9, "chars": chars})
    assert [w[0] for w in words] == ["Own", "work", "force", "x"]
    assert words[1] == ("work", 40, 79, 5, 15, 9.0, "Medium") and span_words({"font": "F", "size": 1, "chars": []}) == []
