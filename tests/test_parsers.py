"""Layout parsers over positioned words laid out by hand."""

import pytest

from citeloom.operators import parsers as P

WORDS = "doc_id string, pdf_index int, seq int, text string, x0 double, x1 double, top double, bottom double, size double, font string"
PAGES = "doc_id string, pdf_index int, page int, section string, layout string, width double, height double, text string"


def put(rows, doc, page, text, x, top, size=9.0, font="Regular", gap=5.0):
    """Words of a line from ``x`` on, five points a character."""
    for w in text.split():
        rows.append((doc, page, len(rows), w, float(x), float(x) + 5 * len(w), float(top), float(top) + 10, float(size), font))
        x += 5 * len(w) + gap
    return rows


@pytest.fixture(scope="module")
def pages(spark):
    rows = []
    # Page 0: three risks in columns, three labelled rows; the middle title has two lines.
    for x, title in ((220, "Cyber attacks"), (400, "Project"), (600, "Weather")):
        put(rows, "d", 0, title, x, 60, 12)
    put(rows, "d", 0, "execution", 401, 75, 12)
    for top, label in ((100, "Description"), (200, "Potential impact"), (300, "How we manage it")):
        put(rows, "d", 0, label, 40, top, 12)
        for x, c in ((220, "a"), (400, "b"), (600, "c")):
            put(rows, "d", 0, f"{c} first {label.split()[0]}", x, top + 2)
            if label != "Potential impact" or c != "c":
                put(rows, "d", 0, f"{c} second", x - 3, top + 14.5)
    # Page 1: two topic tables; the first has an impact column and a financial one with icons.
    put(rows, "d", 1, "E1 Climate change", 40, 40, 18)
    for text, x in (("Sub-topic", 40), ("Impacts", 150), ("Financial risks", 480)):
        put(rows, "d", 1, text, x, 70, 11)
    put(rows, "d", 1, "Value chain", 420, 84)
    put(rows, "d", 1, "Value chain", 750, 84)
    put(rows, "d", 1, "Double materiality", 40, 102)
    put(rows, "d", 1, "Energy use", 40, 114)
    put(rows, "d", 1, "Emissions (own, actual)", 150, 102, font="Medium")
    put(rows, "d", 1, "Heat is lost", 150, 114)
    put(rows, "d", 1, "Upstream", 420, 102)
    put(rows, "d", 1, "Carbon price", 480, 102, font="Medium")
    put(rows, "d", 1, "A risk of cost", 480, 114)
    put(rows, "d", 1, "New markets", 480, 130, font="Medium")
    put(rows, "d", 1, "A chance of growth and opportunities", 480, 142)
    put(rows, "d", 1, "Own operations", 750, 102)
    put(rows, "d", 1, "Storms", 480, 172, font="Medium")
    put(rows, "d", 1, "A risk of damage", 480, 184)
    put(rows, "d", 1, "S1 Own workforce", 40, 220, 18)
    put(rows, "d", 1, "Sub-topic", 40, 250, 11)
    put(rows, "d", 1, "Safety", 40, 284)
    put(rows, "d", 1, "Accidents", 480, 284, font="Medium")
    put(rows, "d", 1, "Deemed immaterial", 480, 296)
    put(rows, "d", 1, "materiality", 40, 560)
    # Page 2 has a layout whose parser finds nothing; page 3 has none.
    put(rows, "d", 2, "only prose here", 40, 100)
    words = spark.createDataFrame(rows, WORDS)
    rules = spark.createDataFrame(
        [("d", 1, y, x, x + 300.0) for x, y in ((146.0, 98.0), (476.0, 98.0), (476.0, 168.0), (476.0, 98.04), (476.0, 280.0), (20.0, 130.0), (476.0, 30.0), (136.0, 280.0))],
        "doc_id string, pdf_index int, y double, x0 double, x1 double",
    )
    markers = spark.createDataFrame([("d", 1, 482.0, 104.0, "risk"), ("d", 1, 482.0, 132.0, "risk"), ("d", 1, 700.0, 175.0, "opportunity")], "doc_id string, pdf_index int, x double, y double, marker string")
    meta = [("d", 0, 51, "rm", "main_risks_table", 842.0, 595.0, "x"), ("d", 1, 71, "iro", "esrs_table", 842.0, 595.0, "y"), ("d", 2, 72, "iro", "esrs_table", 842.0, 595.0, "Head\n\n72 Second line\nbody  text"), ("d", 3, 85, "cc", None, 842.0, 595.0, None)]
    return P.Pages(spark.createDataFrame(meta, PAGES), words, rules, markers)


def test_columns_become_blocks(pages):
    got = {r.block_id: r for r in P.main_risks_table(pages.of("main_risks_table")).collect()}
    assert [got[f"p51-erm-{i}"].heading for i in (1, 2, 3)] == ["Cyber attacks", "Project execution", "Weather"]
    assert got["p51-erm-1"].fields == {"description": "a first Description a second", "potential_impact": "a first Potential a second", "how_we_manage_it": "a first How a second"}
    assert got["p51-erm-3"].fields["potential_impact"] == "c first Potential"
    assert got["p51-erm-2"].text == "b first Description b second b first Potential b second b first How b second"


def test_topic_tables(pages):
    got = {r.block_id: r for r in P.esrs_tables(pages.of("esrs_table")).collect()}
    assert set(got) == {"p71-E1-impact-1", "p71-E1-financial-1a", "p71-E1-financial-1b", "p71-E1-financial-2", "p71-S1-financial-1"}
    impact = got["p71-E1-impact-1"]
    assert (impact.marker, impact.source_register, impact.actual_or_potential, impact.value_chain, impact.sub_topic) == ("impact", None, "actual", "Upstream", "Energy use")
    assert impact.fields == {"name": "Emissions (own, actual)", "description": "Heat is lost", "topic": "Climate change", "materiality": "Double materiality"}
    a, b = got["p71-E1-financial-1a"], got["p71-E1-financial-1b"]
    assert (a.heading, a.marker, a.marker_source, a.source_register, a.quality_flags) == ("Carbon price", "risk", "icon+text", "esrs_financial_risk", [])
    assert (b.marker, b.marker_source, b.quality_flags) == ("risk", "icon", ["marker_disagreement:icon=risk,text=opportunity"])
    storms = got["p71-E1-financial-2"]
    # No icon beside it (the other one stands outside the column), and no sub-topic within its band: it is carried down.
    assert (storms.marker, storms.marker_source, storms.quality_flags, storms.sub_topic) == ("risk", "text", ["marker_icon_missing"], "Energy use")
    other = got["p71-S1-financial-1"]
    assert (other.source_taxonomy, other.marker, other.quality_flags, other.sub_topic, other.source_register) == ("S1", "immaterial", [], "Safety", None)


def test_anchors_and_content_end(pages):
    first, second = P.table_anchors(pages.of("esrs_table")).orderBy("table_no").collect()
    assert (first.imp_x, first.fin_x, first.imp_vc_x, first.fin_vc_x, first.table_end) == (150.0, 480.0, 420.0, 750.0, 218.0)
    # Columns without a header stand at the usual distances; the page ends above the legend.
    assert (second.imp_x, second.fin_x, second.imp_vc_x, second.fin_vc_x, second.table_end) == (140.0, 480.0, 420.0, 782.0, 556.0)


def test_fallback_and_registry(pages):
    got = {(r.pdf_index, r.block_id): r for r in P.parsed(pages).collect()}
    assert got[2, "p72-text"].quality_flags == ["layout_unreconstructed", "table_reconstruction_found_nothing"]
    assert (got[2, "p72-text"].heading, got[2, "p72-text"].text) == ("72 Second line", "Head 72 Second line body text")
    assert got[3, "p85-text"].quality_flags == ["layout_unreconstructed"] and got[3, "p85-text"].text == ""
    assert len(got) == 3 + 5 + 2
    broken = P.parsed(pages, {**P.PARSERS, "main_risks_table": lambda p: P.equal_chunks(p.pages)})
    assert {r.block_id for r in broken.where("pdf_index = 0").collect()} == {"p51-erm-1", "p51-erm-2", "p51-erm-3"}
    assert P.parsed(pages, {}).count() == 4


def test_small_pieces(spark):
    rows = [("Financial materiality Water",), ("Water",), ("",)]
    df = spark.createDataFrame(rows, "s string")
    assert [tuple(r) for r in df.select(*P.materiality_split(df.s)).collect()] == [("Financial materiality", "Water"), (None, "Water"), (None, "")]
    names = spark.createDataFrame([("Spills (short term, potential)",), ("Spills (actual)",), ("Spills (old)",)], "s string")
    assert [r[0] for r in names.select(P.actual_or_potential(names.s)).collect()] == ["potential", "actual", None]


def test_chunks(spark):
    pages = spark.createDataFrame([("d", 0, 51, "rm", None, 1.0, 1.0, " ".join(f"w{i}" for i in range(18)))], PAGES)
    got = P.equal_chunks(pages).orderBy("block_id").collect()
    assert got[1].fields == {"description": "w6 w7", "potential_impact": "w8 w9", "how_we_manage_it": "w10 w11"} and got[0].heading == "w0 w1 w2 w3"
