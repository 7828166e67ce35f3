"""Positioned words to lines, columns, table bands and entries.

A page is the unit of work: its words are collected into one array (a page is bounded) and folded by ``aggregate``
inside the JVM. Everything else is equi joins on (document, page) with a range condition, or windows by page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PAGE = ("doc_id", "pdf_index")
FOOTER_BAND, LINE_TOLERANCE = 30.0, 2.5


def without_footer(words: DataFrame, height: float) -> DataFrame:
    """Words above the footer band of a page of ``height`` points."""
    return words.where(F.col("top") <= height - FOOTER_BAND)


def footer_numbers(words: DataFrame, height: float) -> DataFrame:
    """The printed number of each page: the right-most word of one to three digits in the footer band."""
    low = words.where((F.col("top") > height - FOOTER_BAND) & F.col("text").rlike("^[0-9]{1,3}$"))
    return low.groupBy(*PAGE).agg(F.max_by("text", F.struct("x1", "seq")).cast("int").alias("printed_page"))


def cluster_lines(words: DataFrame, tolerance: float = LINE_TOLERANCE, keys: tuple[str, ...] = PAGE) -> DataFrame:
    """``words`` with ``line_no``: words in the order of (top, x0); a line takes words until one lies further than
    ``tolerance`` from the line's *first* word. This is no gaps-and-islands: the anchor does not move along. ``keys`` may
    name a part of a page, such as a table cell, whose words then make lines of their own."""
    first = ["top", "x0", "seq"]
    fields = [*first, *(c for c in words.columns if c not in (*keys, *first))]
    page = words.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("ws"))
    start = F.struct(F.lit(None).cast("double").alias("anchor"), F.lit(0).alias("line"), F.expr("cast(array() as array<int>)").alias("lines"))

    def step(state: Column, w: Column) -> Column:
        fresh = state["anchor"].isNull() | (F.abs(state["anchor"] - w["top"]) > tolerance)
        line = F.when(fresh, state["line"] + 1).otherwise(state["line"])
        return F.struct(F.when(fresh, w["top"]).otherwise(state["anchor"]).alias("anchor"), line.alias("line"), F.concat(state["lines"], F.array(line)).alias("lines"))

    lines = page.select(*keys, "ws", F.aggregate("ws", start, step)["lines"].alias("lines"))
    rows = lines.select(*keys, F.explode(F.arrays_zip("ws", "lines")).alias("r"))
    return rows.select(*keys, *(F.col("r.ws")[f].alias(f) for f in fields), F.col("r.lines").alias("line_no"))


def line_text(lined: DataFrame, keys: tuple[str, ...] = PAGE) -> DataFrame:
    """One row per line: its words by x0 with one space between, its top, left end and largest size, and whether all of
    its words stand in the medium font."""
    return lined.groupBy(*keys, "line_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("x0", "seq", "text"))), lambda w: w["text"]), " ").alias("text"),
        F.min("top").alias("top"), F.max("bottom").alias("bottom"), F.min("x0").alias("x0"), F.max("size").alias("size"), F.bool_and(F.col("font") == "Medium").alias("medium"),
    )


def block_text(words: DataFrame, keys: tuple[str, ...]) -> DataFrame:
    """``keys, text``: the words of each key in lines of their own, one text."""
    lined = cluster_lines(words, keys=keys)
    return lined.groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "x0", "seq", "text"))), lambda w: w["text"]), " ").alias("text"))


def cluster_heads(heads: DataFrame, gap: float = 40.0, near: float = 5.0) -> DataFrame:
    """Column heads of each page from heading words: a word joins the last group if it starts within ``gap`` of the
    group's right end or within ``near`` of its left end. Gives ``col_no, left, right`` per group."""
    page = heads.groupBy(*PAGE).agg(F.array_sort(F.collect_list(F.struct("x0", "x1"))).alias("ws"))
    groups = "array<struct<left:double,right:double>>"

    def step(done: Column, w: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        joins = (w["x0"] - last["right"] < gap) | (F.abs(w["x0"] - last["left"]) < near)
        fresh = F.struct(w["x0"].alias("left"), w["x1"].alias("right"))
        grown = F.struct(F.least(last["left"], w["x0"]).alias("left"), F.greatest(last["right"], w["x1"]).alias("right"))
        kept = F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when((F.size(done) > 0) & joins, F.concat(kept, F.array(grown))).otherwise(F.concat(done, F.array(fresh)))

    cols = page.select(*PAGE, F.posexplode(F.aggregate("ws", F.expr(f"cast(array() as {groups})"), step)).alias("i", "g"))
    return cols.select(*PAGE, (F.col("i") + 1).alias("col_no"), "g.left", "g.right")


def band_index(value: Column, bounds: Column, slack: float = 0.0) -> Column:
    """As-of over a small sorted array: the 1-based index of the greatest bound not above ``value + slack``; 0 if none."""
    top = value + F.lit(slack) if slack else value
    return F.size(F.filter(bounds, lambda b: b <= top))


#: Bounds up to which an as-of join sends them to every task.
MOST_BOUNDS = 10_000


def asof(items: DataFrame, bounds: DataFrame, at: str, value: str) -> DataFrame:
    """Each item with the ``value`` of the greatest bound not above it; null where none is.

    Up to ``MOST_BOUNDS`` bounds go as one sorted array to every task (their number is checked), and each item looks
    itself up in it. More bounds are merged with the items in ranges, cut at quantiles of the bounds; what a range lacks
    at its start is carried over from the ranges before it, one value each.
    """
    rows = bounds.where(F.col(at).isNotNull()).select(F.col(at).alias("__at"), F.col(value).alias("__v"))
    if len(rows.limit(MOST_BOUNDS + 1).select(F.lit(1)).collect()) <= MOST_BOUNDS:
        one = rows.groupBy("__at").agg(F.max("__v").alias("__v")).agg(F.array_sort(F.collect_list(F.struct("__at", "__v"))).alias("__b"))
        found = F.element_at(F.filter("__b", lambda b: b["__at"] <= F.col(at)), -1)["__v"]
        return items.crossJoin(F.broadcast(one)).withColumn(value, F.when(F.size(F.filter("__b", lambda b: b["__at"] <= F.col(at))) > 0, found)).drop("__b")
    stamp = F.unix_micros("__at") if dict(rows.dtypes)["__at"].startswith("timestamp") else F.col("__at").cast("double")
    marks = rows.select(stamp.cast("double").alias("x")).approxQuantile("x", [i / 64 for i in range(1, 64)], 0.01)
    cut = F.array(*[F.lit(float(m)) for m in sorted(set(marks))])
    part = lambda df, c: df.withColumn("__p", F.size(F.filter(cut, lambda m: m <= (F.unix_micros(c) if dict(df.dtypes)[c].startswith("timestamp") else F.col(c)).cast("double"))))
    heads = part(rows, "__at")
    first = heads.groupBy("__p").agg(F.max_by("__v", F.struct("__at", "__v")).alias("__v")).orderBy("__p").collect()
    carried = {r["__p"]: r["__v"] for r in first}
    before = {p: next((carried[q] for q in sorted(carried, reverse=True) if q < p), None) for p in range(len(set(marks)) + 1)}
    done = nearest_above(part(items, at), heads, ["__p"], at, "__at", "__v")
    start = F.create_map(*(x for p, v in before.items() for x in (F.lit(p), F.lit(v))))
    return done.withColumn(value, F.coalesce("__v", F.element_at(start, F.col("__p")))).drop("__p", "__v")


def cell_texts(words: DataFrame, columns: DataFrame, row_tops: DataFrame, left_slack: float = 15.0, top_slack: float = 4.0) -> DataFrame:
    """Table cells: each word goes to the last column that begins at most ``left_slack`` right of it and the last row
    that begins at most ``top_slack`` below it; a cell's words stand in line and reading order."""
    cols = columns.groupBy(*PAGE).agg(F.array_sort(F.collect_list("left")).alias("lefts"))
    rows = row_tops.groupBy(*PAGE).agg(F.array_sort(F.collect_list("top")).alias("tops"))
    placed = words.join(cols, list(PAGE)).join(rows, list(PAGE)).select(
        *PAGE, "line_no", "x0", "seq", "text",
        band_index(F.col("x0"), F.col("lefts"), left_slack).alias("col_no"), band_index(F.col("top"), F.col("tops"), top_slack).alias("row_no"),
    )
    return placed.where("col_no > 0 AND row_no > 0").groupBy(*PAGE, "row_no", "col_no").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "x0", "seq", "text"))), lambda w: w["text"]), " ").alias("text")
    )


def rule_bands(rules: DataFrame, ends: DataFrame) -> DataFrame:
    """Half-open bands ``[t0, t1)`` between the distinct rules of a page, the last one closed by the table's end."""
    order = Window.partitionBy(*PAGE).orderBy("y")
    return (
        rules.select(*PAGE, F.round("y", 1).alias("y")).distinct().join(ends, list(PAGE)).where("y < table_end")
        .select(*PAGE, F.row_number().over(order).alias("band_no"), F.col("y").alias("t0"), F.coalesce(F.lead("y").over(order), "table_end").alias("t1"))
    )


def in_bands(items: DataFrame, bands: DataFrame, at: str = "top") -> DataFrame:
    """Items with the band of their page that holds them (an interval join under an equi key)."""
    joined = items.join(bands, list(PAGE))
    return joined.where((F.col(at) >= F.col("t0")) & (F.col(at) < F.col("t1")))


def nearest_above(items: DataFrame, heads: DataFrame, keys: list[str], at: str, head_at: str, value: str) -> DataFrame:
    """Each item with the ``value`` of the last head of its key at or above it (of several there, the greatest); null
    where none is. Items and heads go through one window in the order of their positions, so no pair of them is made."""
    kind = dict(items.dtypes)[at]
    rest = [c for c in items.columns if c not in (*keys, at)]
    a = items.select(*keys, F.col(at).alias("__at"), F.lit(1).alias("__item"), F.struct(*rest, F.lit(0).alias("__")).alias("__r"), F.lit(None).cast(dict(heads.dtypes)[value]).alias("__v"))
    b = heads.where(F.col(head_at).isNotNull()).select(*keys, F.col(head_at).cast(kind).alias("__at"), F.lit(0).alias("__item"), F.lit(None).cast(a.schema["__r"].dataType).alias("__r"), F.col(value).alias("__v"))
    before = Window.partitionBy(*keys).orderBy("__at", "__item", "__v").rowsBetween(Window.unboundedPreceding, 0)
    both = a.unionByName(b).withColumn("__best", F.when(F.col("__at").isNotNull(), F.last("__v", ignorenulls=True).over(before))).where("__item = 1")
    return both.select(*((F.col("__at") if c == at else F.col(c) if c in keys else F.col(f"__r.{c}")).alias(c) for c in items.columns), F.col("__best").alias(value))


def numbered_entries(lines: DataFrame, keys: list[str], order: list[str], is_head: Column) -> DataFrame:
    """Lines with ``entry_no``: a head starts a new entry, lines before the first head are entry 0."""
    span = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumn("entry_no", F.sum(F.when(is_head, 1).otherwise(0)).over(span).cast("int"))


def filled_down(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """``value`` carried down to rows that lack it."""
    span = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn(value, F.last(F.nullif(F.col(value), F.lit("")), ignorenulls=True).over(span))


def with_suffixes(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """``suffix`` a, b, c, ... for rows of a key with more than one row, else empty."""
    w = Window.partitionBy(*keys)
    letter = F.chr(F.lit(96) + F.row_number().over(w.orderBy(*order)))
    return rows.withColumn("suffix", F.when(F.count("*").over(w) > 1, letter).otherwise(""))


def arrow_markers(drawings: DataFrame, x_low: float = float("-inf"), x_high: float = float("inf")) -> DataFrame:
    """Arrow icons of a page: closed paths of ten line segments narrower than 8 points between two x positions; the
    arrow points up, an opportunity, if vertex 2 lies above vertex 7 (both counted from 0), else it is a risk.

    ``drawings`` has ``items array<struct<kind:string,x0:double,y0:double,x1:double,y1:double>>``."""
    xs = F.transform("items", lambda i: i["x0"])
    shape = (F.size("items") == 10) & F.forall("items", lambda i: i["kind"] == "l") & (F.array_max(xs) - F.array_min(xs) < 8)
    ys = F.transform("items", lambda i: i["y0"])
    return drawings.where(shape & F.array_min(xs).between(x_low, x_high)).select(
        *PAGE, F.array_min(xs).alias("x"), F.array_min(ys).alias("y"), F.when(ys[2] < ys[7], "opportunity").otherwise("risk").alias("marker")
    )


def horizontal_rules(drawings: DataFrame, width: float = 100.0) -> DataFrame:
    """Distinct horizontal rules: flat lines and thin boxes at least ``width`` wide, y to one decimal.

    ``drawings`` has ``kind`` (l or re) and ``x0, y0, x1, y1``."""
    flat = F.when(F.col("kind") == "l", F.abs(F.col("y1") - F.col("y0")) < 1).otherwise(F.abs(F.col("y1") - F.col("y0")) < 1.5)
    return drawings.where(flat & (F.abs(F.col("x1") - F.col("x0")) >= width)).select(
        *PAGE, F.bround("y0", 1).alias("y"), F.least("x0", "x1").alias("x0"), F.greatest("x0", "x1").alias("x1")
    ).distinct()


def icon_in_band(bands: DataFrame, markers: DataFrame) -> DataFrame:
    """Bands with the first (upper-most) marker whose y lies in them; null where none does."""
    near = bands.join(markers.select(*PAGE, F.col("y").alias("__y"), F.col("marker").alias("__m")), list(PAGE), "left")
    inside = F.when(F.col("__y").between(F.col("t0"), F.col("t1")), F.struct("__y", "__m"))
    return near.groupBy(*bands.columns).agg(F.min(inside).alias("__best")).select(*bands.columns, F.col("__best.__m").alias("marker"))
