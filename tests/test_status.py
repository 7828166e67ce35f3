"""The two-year, two-company fixture and the year gaps."""

import pytest

from citeloom.operators import serve as V
from citeloom.operators import warehouse as W

INST = "id string, report_id string, canonical_risk_id string, title string, description string, category string, source_register string, section string, page int, prominence int, verbatim_span string, mitigation string"


@pytest.fixture(scope="module")
def tables(spark):
    company = spark.createDataFrame([("a", "Alpha SE", "Renewable energy", "DK"), ("b", "Beta plc", "utilities", "DE"), ("c", "Gap", None, None)], "id string, name string, sector string, country string")
    reports = [("a24", "a", 2024), ("a25", "a", 2025), ("b24", "b", 2024), ("c23", "c", 2023), ("c25", "c", 2025)]
    report = spark.createDataFrame([(i, c, y, ["Board", "Audit"], "every six months") for i, c, y in reports], "id string, company_id string, fiscal_year int, review_bodies array<string>, review_frequency string")
    rows = []
    for i in range(1, 10):
        rows.append((f"a25-r{i}", "a25", f"a-{i}", f"Risk {i}", "Cyber-attack text", "cyber" if i < 3 else "market", "erm_main_risk", "s", i, 1))
        if i < 9:
            rows.append((f"a24-r{i}", "a24", f"a-{i}", f"Risk {i}", "text", "cyber", "erm_main_risk", "s", i, 2 if i == 1 else 1))
    rows += [("a24-old", "a24", "a-old", "Old risk", "text", "climate", "erm_main_risk", "s", 9, 1), ("b24-r1", "b24", "b-1", "Beta risk", "text", "market", "erm_main_risk", "s", 1, 1)]
    rows += [("c23-r1", "c23", "c-1", "Gap risk", "text", "market", "erm_main_risk", "s", 1, 1), ("c25-r1", "c25", "c-1", "Gap risk", "text", "market", "erm_main_risk", "s", 1, 1)]
    instance = spark.createDataFrame([(*r, "span", None) for r in rows], INST)
    canonical = spark.createDataFrame([(i, i[0], t) for i, t in sorted({(r[2], r[3]) for r in rows})], "id string, company_id string, canonical_title string")
    citation = spark.createDataFrame([("a25-r1", "r", "s", 1, "x"), ("a25-r1", "r", "s", 1, "x"), ("a25-r1", "r", "s", 2, "y")], "risk_instance_id string, source_register string, section string, page int, span string")
    return V.Tables(company, report, canonical, instance, citation)


def test_status(tables):
    got = {(r[0], r[1]): r[2] for r in W.risk_status(tables.instance, tables.report, tables.canonical).collect()}
    assert got[("a-9", 2025)] == "new" and got[("a-1", 2025)] == "elevated" and got[("a-old", 2025)] == "removed"
    assert all(got[(f"a-{i}", 2025)] == "continuing" for i in range(2, 9))
    assert not any(k[0] == "b-1" for k in got)  # no later report of its company
    assert got.pop(("c-1", 2024)) == "removed" and not any(k[0] == "c-1" for k in got)  # 2025 is no "new": no report of 2024
    assert len([k for k in got if k[1] == 2025]) == 10


def test_one_report_has_no_status(tables):
    one = tables.instance.where("report_id = 'b24'")
    assert W.risk_status(one, tables.report.where("id = 'b24'"), tables.canonical).count() == 0


def test_filters(tables):
    ids = lambda **k: [r.id for r in V.records(tables, V.Intent(**k), 100).collect()]
    assert ids(status="removed", companies=["alpha"]) == ["a24-old"]
    assert ids(status="removed", years=[2025]) == ["a24-old"] and [i for i in ids(status="removed", years=[2024])] == ["c23-r1"]
    assert ids(categories=["cyber"], years=[2025]) == ["a25-r1", "a25-r2"]
    assert ids(sector="no such sector") == []
    assert len(ids(sector="renewables energy")) == 18
    assert ids(free_text='cyber "attack"', years=[2025])[:2] == ["a25-r1", "a25-r2"]
    assert ids(companies=["b%"]) == []
    with pytest.raises(ValueError):
        V.records(tables, V.Intent(status="gone"), 10)
    with pytest.raises(ValueError):
        V.records(tables, V.Intent(), 0)
    assert V.checked(V.Intent(), 5000, clamp=True) == 1000


def test_sector_cascade(tables):
    got = lambda s: [tuple(r) for r in V.sector_matches(tables.company, s).collect()]
    assert got("renewable-energy") == [("Renewable energy", 1)]
    assert got("Renewables") == [("Renewable energy", 2)]
    assert got("renewabel energy") == [("Renewable energy", 3)]
    assert got("shipping") == [] and got("") == []


def test_every_matching_sector_counts(spark, tables):
    """More sectors than any fixed number: each is matched, none is left out."""
    from dataclasses import replace

    names = [f"renewable energy {i}" for i in range(150)]
    company = spark.createDataFrame([(f"c{i}", f"Co {i}", n, None) for i, n in enumerate(names)], "id string, name string, sector string, country string")
    report = spark.createDataFrame([(f"r{i}", f"c{i}", 2024, None, None) for i in range(150)], "id string, company_id string, fiscal_year int, review_bodies array<string>, review_frequency string")
    rows = [(f"i{i}", f"r{i}", f"k{i}", f"t{i}", "d", "cyber", "erm_main_risk", 1, 1) for i in range(150)]
    instance = spark.createDataFrame(rows, "id string, report_id string, canonical_risk_id string, title string, description string, category string, source_register string, page int, prominence int")
    many = replace(tables, company=company, report=report, instance=instance)
    assert V.question_for_sectors(many, "companies_with_category", "renewable energy", category="cyber").count() == 150


def test_questions_and_citations(tables):
    assert V.question(tables, "newly_elevated_risks", company="a").count() == 2
    assert V.question(tables, "top_enterprise_risks", company="beta").count() == 1
    assert V.question(tables, "companies_with_category", category="cyber", sector="RENEW").count() == 10
    assert V.question_for_sectors(tables, "companies_with_category", "utilities", category="market").count() == 1
    assert V.question_for_sectors(tables, "companies_with_category", "shipping", category="market").count() == 0
    with pytest.raises(KeyError):
        V.question(tables, "other")
    row = V.record(tables, "a25-r1").first()
    assert [(c.page, c.span) for c in row.citations] == [(1, "x"), (2, "y")]
    assert V.record(tables, "none").count() == 0 and V.record(tables, "a25-r2").first().citations == []
    assert V.intent_of('{"categories": ["cyber"], "sector": null}') == V.Intent(categories=["cyber"])
    with pytest.raises(ValueError):
        V.intent_of('{"colour": 1}')


def test_replace_and_meta(spark, tables, tmp_path):
    path = str(tmp_path / "facts")
    W.write_reports(tables.instance, path)
    W.write_reports(tables.instance.where("id = 'a25-r1'"), path)
    back = spark.read.parquet(path)
    assert back.where("report_id = 'a25'").count() == 1 and back.count() == tables.instance.count() - 8
    assert W.replaced(tables.instance, tables.instance.where("id = 'a25-r1'")).count() == tables.instance.count() - 8
    W.write_meta(spark, str(tmp_path / "meta"))
    W.check_meta(spark, str(tmp_path / "meta"))
    spark.createDataFrame([("schema_version", "0")], "key string, value string").write.json(str(tmp_path / "old"))
    with pytest.raises(ValueError):
        W.check_meta(spark, str(tmp_path / "old"))
    up = W.upserted(tables.company, spark.createDataFrame([("a", "New", None, None)], tables.company.schema), "id")
    assert {r.id: r.name for r in up.collect()} == {"a": "New", "b": "Beta plc", "c": "Gap"}
