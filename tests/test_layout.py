import random

from pyspark.sql import functions as F

from citeloom.operators import layout as L

WORDS = "doc_id string, pdf_index int, seq int, text string, x0 double, x1 double, top double, bottom double, size double, font string"


def page(seed, n, doc="d", index=0):
    rnd = random.Random(seed)
    return [(doc, index, i, f"w{i}", round(rnd.uniform(0, 400), 1), 500.0, round(rnd.uniform(0, 60), 1), 0.0, 9.0, "Regular") for i in range(n)]


def brute_lines(words, tolerance=2.5):
    out, anchor, line = {}, None, 0
    for w in sorted(words, key=lambda w: (w[6], w[4], w[2])):
        if anchor is None or abs(anchor - w[6]) > tolerance:
            anchor, line = w[6], line + 1
        out[w[2]] = line
    return out


def test_lines_follow_the_first_word_of_each_line(spark):
    pages = {(f"d{i}", i): page(i, 60, f"d{i}", i) for i in range(6)}
    df = spark.createDataFrame([w for p in pages.values() for w in p], WORDS)
    got = {}
    for r in L.cluster_lines(df).collect():
        got.setdefault((r.doc_id, r.pdf_index), {})[r.seq] = r.line_no
    assert got == {k: brute_lines(p) for k, p in pages.items()}


def test_drifting_words_do_not_chain(spark):
    df = spark.createDataFrame([("d", 0, i, "w", 0.0, 1.0, 2.0 * i, 0.0, 9.0, "R") for i in range(4)], WORDS)
    assert [r.line_no for r in L.cluster_lines(df).orderBy("seq").collect()] == [1, 1, 2, 2]


def test_heads_cells_and_footer(spark):
    heads = [("d", 0, 1, "Risk", 50.0, 80.0), ("d", 0, 2, "name", 90.0, 120.0), ("d", 0, 3, "Impact", 200.0, 240.0), ("d", 0, 4, "under", 52.0, 70.0)]
    df = spark.createDataFrame([(*h, 10.0, 12.0, 12.0, "Medium") for h in heads], WORDS)
    cols = L.cluster_heads(df)
    assert sorted(tuple(r)[2:] for r in cols.collect()) == [(1, 50.0, 120.0), (2, 200.0, 240.0)]
    words = [("a", 40.0, 30.0), ("b", 60.0, 30.5), ("c", 205.0, 30.0), ("d", 41.0, 60.0), ("left", 10.0, 30.0), ("above", 60.0, 10.0)]
    df = spark.createDataFrame([("d", 0, i, t, x, x + 10, y, y + 9, 9.0, "R") for i, (t, x, y) in enumerate(words)], WORDS)
    tops = spark.createDataFrame([("d", 0, 32.0), ("d", 0, 61.0)], "doc_id string, pdf_index int, top double")
    got = {(r.row_no, r.col_no): r.text for r in L.cell_texts(L.cluster_lines(df), cols, tops).collect()}
    assert got == {(1, 1): "a b", (1, 2): "c", (2, 1): "d"}
    feet = spark.createDataFrame([("d", 0, 1, "12", 10.0, 20.0, 790.0, 800.0, 9.0, "R"), ("d", 0, 2, "51", 500.0, 510.0, 790.0, 800.0, 9.0, "R"), ("d", 0, 3, "7", 600.0, 610.0, 100.0, 110.0, 9.0, "R")], WORDS)
    assert [r.printed_page for r in L.footer_numbers(feet, 810.0).collect()] == [51]
    assert L.without_footer(feet, 810.0).count() == 1


def test_bands_icons_and_nearest(spark):
    rules = spark.createDataFrame([("d", 0, 10.04), ("d", 0, 10.0), ("d", 0, 50.0), ("d", 0, 95.0)], "doc_id string, pdf_index int, y double")
    ends = spark.createDataFrame([("d", 0, 90.0)], "doc_id string, pdf_index int, table_end double")
    bands = L.rule_bands(rules, ends)
    assert [tuple(r)[2:] for r in bands.orderBy("t0").collect()] == [(1, 10.0, 50.0), (2, 50.0, 90.0)]
    items = spark.createDataFrame([("d", 0, "x", 10.0), ("d", 0, "y", 50.0), ("d", 0, "z", 90.0)], "doc_id string, pdf_index int, n string, top double")
    assert sorted((r.n, r.band_no) for r in L.in_bands(items, bands).collect()) == [("x", 1), ("y", 2)]
    marks = spark.createDataFrame([("d", 0, 30.0, "risk"), ("d", 0, 20.0, "opportunity")], "doc_id string, pdf_index int, y double, marker string")
    assert {r.band_no: r.marker for r in L.icon_in_band(bands, marks).collect()} == {1: "opportunity", 2: None}
    heads = spark.createDataFrame([("d", 5.0, "A"), ("d", 40.0, "B")], "doc_id string, y double, topic string")
    got = L.nearest_above(items.select("doc_id", "n", "top"), heads, ["doc_id"], "top", "y", "topic")
    assert {r.n: r.topic for r in got.collect()} == {"x": "A", "y": "B", "z": "B"}


def test_entries_fill_suffix(spark):
    df = spark.createDataFrame([("d", 1, "intro", ""), ("d", 2, "Head", "t1"), ("d", 3, "more", ""), ("d", 4, "Head", None)], "doc_id string, n int, line string, topic string")
    out = L.numbered_entries(df, ["doc_id"], ["n"], F.col("line") == "Head")
    assert [r.entry_no for r in out.orderBy("n").collect()] == [0, 1, 1, 2]
    assert [r.topic for r in L.filled_down(df, ["doc_id"], ["n"], "topic").orderBy("n").collect()] == [None, "t1", "t1", "t1"]
    assert [r.suffix for r in L.with_suffixes(df, ["line"], ["n"]).orderBy("n").collect()] == ["", "a", "", "b"]


def test_rules_and_arrows(spark):
    lines = [("d", 0, "l", 0.0, 10.04, 200.0, 10.0), ("d", 0, "l", 0.0, 10.0, 50.0, 10.0), ("d", 0, "re", 0.0, 20.0, 300.0, 21.0), ("d", 0, "re", 0.0, 20.0, 300.0, 29.0)]
    df = spark.createDataFrame(lines, "doc_id string, pdf_index int, kind string, x0 double, y0 double, x1 double, y1 double")
    assert sorted(r.y for r in L.horizontal_rules(df).collect()) == [10.0, 20.0]
    back = spark.createDataFrame([("d", 0, "l", 200.0, 10.0, 0.0, 10.0)], df.schema)
    assert [(r.x0, r.x1) for r in L.horizontal_rules(back).collect()] == [(0.0, 200.0)]
    item = "array<struct<kind:string,x0:double,y0:double,x1:double,y1:double>>"
    arrow = lambda ys: [("l", 100.0 + i % 3, float(y), 0.0, 0.0) for i, y in enumerate(ys)]
    # The vertices that decide are 2 and 7, counted from 0: the apex of the arrow's head and the end of its shaft.
    rows = [("d", 0, arrow([5, 9, 1, 3, 4, 5, 1, 7, 8, 6])), ("d", 1, arrow([5, 1, 8, 3, 4, 5, 9, 2, 8, 6])), ("d", 2, arrow([1, 2]))]
    df = spark.createDataFrame(rows, f"doc_id string, pdf_index int, items {item}")
    assert {r.pdf_index: r.marker for r in L.arrow_markers(df, 90.0, 110.0).collect()} == {0: "opportunity", 1: "risk"}


def test_asof_by_array_and_by_ranges(spark, monkeypatch):
    import random

    rnd = random.Random(5)
    items = [(i, rnd.choice([None, *[x / 4 for x in range(-20, 900)]])) for i in range(400)]
    bounds = [(float(x), n) for n, x in enumerate(sorted(rnd.sample(range(200), 90)))]
    df, bd = spark.createDataFrame(items, "i int, at double"), spark.createDataFrame([*bounds, (None, 7)], "at double, n int")
    want = {i: None if at is None else max((n for x, n in bounds if x <= at), default=None) for i, at in items}
    for most in (1000, 10):
        monkeypatch.setattr(L, "MOST_BOUNDS", most)
        assert {r.i: r.n for r in L.asof(df, bd, "at", "n").collect()} == want
    assert L.asof(df, bd.limit(0), "at", "n").where("n IS NOT NULL").count() == 0
