"""Pages to blocks: the layout parsers, their registry and the plain fallback.

A parser takes the positioned words of pages and gives blocks; all work is by page, with equi joins on the page (and on
the table or band of it) and folds inside the JVM. ``PARSERS`` may be extended with further functions of this form.

Blocks have ``doc_id, pdf_index, page, section, block_id, source_register, source_taxonomy, sub_topic, heading, fields,
text, marker, marker_source, value_chain, actual_or_potential, strategy, quality_flags``.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.text import block_heading, lexical_marker, slug, squash
from citeloom.operators import layout as L
from citeloom.operators.layout import PAGE

# Fixed values of the layouts, in points.
HEAD_LEAST, HEAD_MOST, TOPIC_LEAST, TOPIC_MOST, BODY_BELOW, TABLE_HEAD = 11, 13, 17, 19, 10, 11
LABEL_LEFT_OF, HEADER_BAND, LEGEND_BELOW, CARRIED = 200, 24, 0.8, 40
IMPACTS_AFTER, FINANCIAL_AFTER, CHAIN_BEFORE = 100, 340, 60
CODE = "^[ESG][0-9]$"

BLOCK = (
    "doc_id string, pdf_index int, page int, section string, block_id string, source_register string, source_taxonomy string, sub_topic string, heading string, fields map<string,string>, "
    "text string, marker string, marker_source string, value_chain string, actual_or_potential string, strategy string, quality_flags array<string>"
)
_NAMES = [c.split()[0] for c in BLOCK.split(", ")]


@dataclass(frozen=True)
class Pages:
    """Pages to parse: ``pages`` (doc_id, pdf_index, page, section, layout, width, height, text), their positioned ``words``,
    ``rules`` (doc_id, pdf_index, y, x0, x1) and ``markers`` (doc_id, pdf_index, x, y, marker)."""

    pages: DataFrame
    words: DataFrame
    rules: DataFrame
    markers: DataFrame

    def of(self, layout: str) -> "Pages":
        """The pages of one layout."""
        pages = self.pages.where(F.col("layout") == layout)
        key = pages.select(*PAGE)
        return Pages(pages, *(t.join(key, list(PAGE), "left_semi") for t in (self.words, self.rules, self.markers)))


def _blocks(df: DataFrame, **values: Column) -> DataFrame:
    """The block columns of ``df``; those it lacks from ``values``, else null."""
    kinds = {c.split()[0]: c.split(" ", 1)[1] for c in BLOCK.split(", ")}
    return df.select(*((values[c] if c in values else F.col(c) if c in df.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in _NAMES))


def _sorted_map(entries: Column) -> Column:
    """A map of ``(order, key, value)`` structs; the first value of a key counts."""
    ordered = F.array_sort(entries)
    first = F.filter(ordered, lambda e, i: ~F.exists(F.slice(ordered, 1, i), lambda x: x["k"] == e["k"]))
    return F.map_from_entries(F.transform(first, lambda e: F.struct(e["k"], e["v"])))


def main_risks_table(p: Pages) -> DataFrame:
    """A table of risks in columns: the headings are words of 11 to 13 points, row labels left of 200 points and column
    titles right of it above the first label; words below 10 points fill the cells."""
    heads = p.words.where(F.col("size").between(HEAD_LEAST, HEAD_MOST))
    labels = L.line_text(L.cluster_lines(heads.where(F.col("x0") < LABEL_LEFT_OF)))
    rows = labels.select(*PAGE, "top", slug(F.col("text")).alias("name"), F.row_number().over(Window.partitionBy(*PAGE).orderBy("top", "line_no")).alias("row_no"))
    first = labels.groupBy(*PAGE).agg(F.min("top").alias("first_top"))
    titles = heads.where(F.col("x0") >= LABEL_LEFT_OF).join(first, list(PAGE)).where("top < first_top")
    cols = L.cluster_heads(titles)
    lefts = cols.groupBy(*PAGE).agg(F.array_sort(F.collect_list("left")).alias("lefts"))
    named = titles.join(lefts, list(PAGE)).withColumn("col_no", L.band_index(F.col("x0"), F.col("lefts"))).drop("lefts", "first_top")
    headings = L.block_text(named, (*PAGE, "col_no")).withColumnRenamed("text", "heading")
    tops = rows.groupBy(*PAGE).agg(F.array_sort(F.collect_list("top")).alias("tops"))
    body = p.words.where(F.col("size") < BODY_BELOW).join(lefts, list(PAGE)).join(tops, list(PAGE))
    placed = body.select(*p.words.columns, L.band_index(F.col("x0"), F.col("lefts"), 15.0).alias("col_no"), L.band_index(F.col("top"), F.col("tops"), 4.0).alias("row_no")).where("col_no > 0 AND row_no > 0")
    cells = L.block_text(placed, (*PAGE, "col_no", "row_no"))
    grid = headings.join(rows.select(*PAGE, "row_no", "name"), list(PAGE)).join(cells, [*PAGE, "col_no", "row_no"], "left")
    cell = F.struct("row_no", F.col("name").alias("k"), F.coalesce("text", F.lit("")).alias("v"))
    made = grid.groupBy(*PAGE, "col_no", "heading").agg(F.collect_list(cell).alias("cells")).join(p.pages.select(*PAGE, "page", "section"), list(PAGE))
    text = F.array_join(F.filter(F.transform(F.array_sort("cells"), lambda c: c["v"]), lambda v: v != ""), " ")
    return _blocks(
        made, block_id=F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("-erm-"), F.col("col_no").cast("string")), source_register=F.lit("erm_main_risk"), fields=_sorted_map(F.col("cells")), text=text,
        marker=F.lit("risk"), marker_source=F.lit("n/a"), strategy=F.lit("main_risks_table"), quality_flags=F.array().cast("array<string>"),
    )


def table_anchors(p: Pages) -> DataFrame:
    """The tables of each page that a header "Sub-topic" opens: where they begin and end, where their columns stand (with
    the usual distances for columns without a header), and the code and title of the topic above.

    The content of a page ends above a legend ("materiality") in its lowest fifth, else above the footer. A table ends
    above the next topic heading, else above the next table or at the content's end.
    """
    page = p.pages.select(*PAGE, "page", "section", "width", "height")
    ws = p.words.join(page, list(PAGE))
    legend = ws.where((F.col("text") == "materiality") & (F.col("top") > F.col("height") * LEGEND_BELOW)).groupBy(*PAGE).agg(F.min("top").alias("legend"))
    order = Window.partitionBy(*PAGE).orderBy("h_top")
    heads = p.words.where((F.col("text") == "Sub-topic") & (F.col("size") >= TABLE_HEAD)).select(*PAGE, F.bround("top", 1).alias("h_top")).distinct()
    heads = heads.select(*PAGE, "h_top", F.row_number().over(order).alias("table_no"), F.lead("h_top").over(order).alias("next_h"))
    near = ws.join(heads, list(PAGE))
    row = (F.abs(F.col("top") - F.col("h_top")) <= L.LINE_TOLERANCE) & (F.col("size") >= TABLE_HEAD)
    below = (F.col("top") > F.col("h_top")) & (F.col("top") <= F.col("h_top") + HEADER_BAND)
    x_of = lambda word: F.min(F.when(row & (F.col("text") == word), F.col("x0")))
    anchors = near.groupBy(*PAGE, "table_no", "h_top", "next_h", "width", "height", "page", "section").agg(
        x_of("Sub-topic").alias("sub_x"), x_of("Impacts").alias("__i"), x_of("Financial").alias("__f"),
        F.array_sort(F.collect_list(F.when(below & (F.col("text") == "Value"), F.col("x0")))).alias("chain"),
    )
    anchors = anchors.withColumn("imp_x", F.coalesce("__i", F.col("sub_x") + IMPACTS_AFTER)).withColumn("fin_x", F.coalesce("__f", F.col("imp_x") + FINANCIAL_AFTER))
    first = lambda test: F.try_element_at(F.filter("chain", test), F.lit(1))
    anchors = anchors.withColumn("imp_vc_x", F.coalesce(first(lambda x: (x > F.col("imp_x")) & (x < F.col("fin_x"))), F.col("fin_x") - CHAIN_BEFORE))
    anchors = anchors.withColumn("fin_vc_x", F.coalesce(first(lambda x: x > F.col("fin_x")), F.col("width") - CHAIN_BEFORE)).drop("__i", "__f", "chain")
    topics = L.cluster_lines(p.words.where(F.col("size").between(TOPIC_LEAST, TOPIC_MOST)))
    is_code = F.col("text").rlike(CODE)
    words_of = lambda keep: F.transform(F.array_sort(F.collect_list(F.when(keep, F.struct("x0", "seq", "text")))), lambda w: w["text"])
    lines = topics.groupBy(*PAGE, "line_no").agg(F.min("top").alias("line_top"), F.try_element_at(words_of(is_code), F.lit(1)).alias("code"), F.array_join(words_of(~is_code), " ").alias("topic"))
    at = anchors.select(*PAGE, "table_no", "h_top", "next_h").join(lines, list(PAGE))
    around = at.groupBy(*PAGE, "table_no").agg(
        F.min(F.when((F.col("line_top") > F.col("h_top")) & (F.col("line_top") < F.col("next_h")), F.col("line_top"))).alias("next_topic"),
        F.max(F.when(F.col("line_top") < F.col("h_top"), F.struct("line_top", "code", "topic"))).alias("above"),
    )
    out = anchors.join(around, [*PAGE, "table_no"], "left").join(legend, list(PAGE), "left")
    end = F.coalesce(F.col("legend") - 4, F.col("height") - L.FOOTER_BAND)
    return out.select(
        *PAGE, "page", "section", "width", "table_no", "h_top", F.when(F.col("next_h").isNull(), end).otherwise(F.coalesce("next_topic", "next_h") - 2).alias("table_end"),
        "imp_x", "fin_x", "imp_vc_x", "fin_vc_x", "above.code", "above.topic",
    )


def esrs_tables(p: Pages) -> DataFrame:
    """Topic tables: rules cut the impact and the financial column into bands, lines in the medium font begin an entry,
    the sub-topic of a band without one is carried down from up to 40 points above, an arrow icon beside a financial entry
    or its words tell risk from opportunity."""
    tables = table_anchors(p)
    table, side, band, entry = (*PAGE, "table_no"), (*PAGE, "table_no", "kind"), (*PAGE, "table_no", "kind", "band_no"), (*PAGE, "table_no", "kind", "band_no", "group_no")
    sides = F.explode(
        F.array(
            F.struct(F.lit("impact").alias("kind"), F.col("imp_x").alias("x_lo"), F.col("imp_vc_x").alias("vc_lo"), F.col("fin_x").alias("vc_hi")),
            F.struct(F.lit("financial").alias("kind"), F.col("fin_x").alias("x_lo"), F.col("fin_vc_x").alias("vc_lo"), F.col("width").alias("vc_hi")),
        )
    )
    halves = tables.select("*", sides.alias("s")).select(*tables.columns, "s.*")
    ruled = p.rules.select(*PAGE, F.bround("y", 1).alias("y"), F.col("x0").alias("rule_x")).join(halves, list(PAGE))
    ruled = ruled.where((F.abs(F.col("rule_x") - (F.col("x_lo") - 4)) < 6) & (F.col("y") > F.col("h_top")) & (F.col("y") < F.col("table_end"))).select(*halves.columns, "y").distinct()
    order = Window.partitionBy(*side).orderBy("y")
    bands = ruled.withColumn("band_no", F.row_number().over(order)).withColumn("t0", F.col("y")).withColumn("t1", F.coalesce(F.lead("y").over(order), "table_end")).drop("y")
    inside = p.words.join(tables.select(*table, "h_top", "table_end"), list(PAGE)).where((F.col("top") > F.col("h_top") + HEADER_BAND) & (F.col("top") < F.col("table_end"))).select(*p.words.columns, "table_no")
    banded = inside.join(bands.select(*band, "x_lo", "vc_lo", "vc_hi", "imp_x", "t0", "t1"), list(table))
    held = (F.col("top") >= F.col("t0")) & (F.col("top") < F.col("t1"))
    keep = [*p.words.columns, "table_no", "kind", "band_no"]
    cell = banded.where(held & (F.col("x0") >= F.col("x_lo") - 4) & (F.col("x0") < F.col("vc_lo") - 4)).select(*keep)
    lines = L.line_text(L.cluster_lines(cell, keys=band), band)
    grouped = lines.withColumn("n", F.sum(F.col("medium").cast("int")).over(Window.partitionBy(*band).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)))
    # Lines before the first name are a group of their own; groups count from 0 in either case.
    grouped = grouped.withColumn("group_no", (F.col("n") - F.min("n").over(Window.partitionBy(*band))).cast("int"))
    part = lambda which: F.array_join(F.transform(F.array_sort(F.collect_list(F.when(which, F.struct("line_no", "text")))), lambda x: x["text"]), " ")
    entries = grouped.groupBy(*entry).agg(part(F.col("medium")).alias("name"), part(~F.col("medium")).alias("desc"), (F.min("top") - 3).alias("g_top"), F.max("bottom").alias("g_bot"))
    left = banded.where(F.col("x0") < F.col("imp_x") - 4)
    last = left.where(F.col("top") < F.col("t0")).groupBy(*band).agg(F.max("top").alias("last_top"))
    own = left.where(held).select(*keep, F.lit(0).alias("away"))
    carried = left.where(F.col("top") < F.col("t0")).join(last, list(band)).where(F.col("top") >= F.col("last_top") - CARRIED).select(*keep, F.lit(1).alias("away"))
    subs = L.block_text(own.unionByName(carried), (*band, "away")).groupBy(*band).agg(F.min_by("text", "away").alias("sub_text"))
    chain = L.block_text(banded.where(held & (F.col("x0") >= F.col("vc_lo") - 4) & (F.col("x0") < F.col("vc_hi"))).select(*keep), band).withColumnRenamed("text", "chain")
    marks = p.markers.select(*PAGE, "x", "y", "marker").join(tables.select(*table, "fin_x"), list(PAGE)).where(F.col("x").between(F.col("fin_x") - 2, F.col("fin_x") + 12))
    icons = entries.where("kind = 'financial'").select(*entry, "g_top", "g_bot").join(marks.select(*table, "y", "marker"), list(table)).where("y BETWEEN g_top AND g_bot").groupBy(*entry).agg(F.min_by("marker", "y").alias("icon"))
    full = (
        entries.join(tables.select(*table, "page", "section", "code", "topic"), list(table)).join(subs, list(band), "left").join(chain, list(band), "left").join(icons, list(entry), "left")
        .withColumn("several", F.count("*").over(Window.partitionBy(*band)) > 1).withColumn("text", F.trim(F.concat_ws(" ", "name", "desc")))
    )
    return _entry_blocks(full)


def materiality_split(sub: Column) -> tuple[Column, Column]:
    """The materiality that a sub-topic begins with (null without one), and the rest."""
    pattern = r"(?s)^((?:Double|Impact|Financial) materiality)[ \t]*(.*)$"
    found = F.nullif(F.regexp_extract(sub, pattern, 1), F.lit(""))
    return found, F.when(found.isNotNull(), F.regexp_extract(sub, pattern, 2)).otherwise(sub)


def actual_or_potential(name: Column) -> Column:
    """``actual`` or ``potential`` as it ends a bracket of a name, else null."""
    return F.nullif(F.regexp_extract(name, r"\((?:[^()]*,[ \t]*)?(actual|potential)\)", 1), F.lit(""))


def _entry_blocks(full: DataFrame) -> DataFrame:
    financial, text, icon = F.col("kind") == "financial", F.col("text"), F.col("icon")
    # The lexical marker of a financial entry falls back to risk.
    lexical = F.coalesce(lexical_marker(text), F.lit("risk"))
    marker = F.when(financial, F.coalesce(icon, lexical)).when(F.contains(F.lower(text), F.lit("immaterial")), "immaterial").otherwise("impact")
    source = F.when(~financial, "n/a").when(icon.isNull(), "text").when(icon == lexical, "icon+text").otherwise("icon")
    differs = F.concat(F.lit("marker_disagreement:icon="), icon, F.lit(",text="), lexical)
    flags = F.array_compact(F.array(F.when(financial & icon.isNull() & (lexical != "immaterial"), "marker_icon_missing"), F.when(financial & icon.isNotNull() & (icon != lexical), differs)))
    materiality, sub_topic = materiality_split(F.coalesce("sub_text", F.lit("")))
    fields = F.map_filter(F.create_map(F.lit("name"), F.col("name"), F.lit("description"), F.col("desc"), F.lit("topic"), F.coalesce("topic", F.lit("")), F.lit("materiality"), F.coalesce(materiality, F.lit(""))), lambda k, v: v != "")
    suffix = F.when(F.col("several"), F.chr(F.lit(97) + F.col("group_no"))).otherwise("")
    name = F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("-"), F.coalesce("code", F.lit("x")), F.lit("-"), F.col("kind"), F.lit("-"), F.col("band_no").cast("string"), suffix)
    return _blocks(
        full, block_id=name, source_register=F.when(financial & (marker == "risk"), "esrs_financial_risk"), source_taxonomy=F.col("code"), sub_topic=F.nullif(sub_topic, F.lit("")),
        heading=F.coalesce(F.nullif(F.col("name"), F.lit("")), F.substring("desc", 1, 60)), fields=fields, marker=marker, marker_source=source, value_chain=F.nullif(F.col("chain"), F.lit("")),
        actual_or_potential=actual_or_potential(F.col("name")), strategy=F.lit("esrs_table"), quality_flags=flags,
    )


def plain_blocks(pages: DataFrame) -> DataFrame:
    """One block per page: its text with blanks collapsed, under its second line."""
    text = F.coalesce("text", F.lit(""))
    return _blocks(
        pages, block_id=F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("-text")), heading=F.coalesce(block_heading(text), F.lit("")), text=squash(text), marker=F.lit("none"), marker_source=F.lit("n/a"),
        strategy=F.lit("plain_text"), quality_flags=F.array(F.lit("layout_unreconstructed")),
    )


def equal_chunks(pages: DataFrame, chunks: int = 3) -> DataFrame:
    """A parser that ignores the layout, to seed faults: the page's words in equal chunks, each cut into equal thirds as
    description, impact and mitigation."""
    words = F.filter(F.split(squash(F.coalesce("text", F.lit(""))), " "), lambda w: w != "")
    each = pages.select("*", words.alias("ws")).withColumn("step", F.greatest(F.lit(1), F.floor(F.size("ws") / chunks)).cast("int"))
    parts = each.select("*", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("i")).withColumn("own", F.slice("ws", F.col("i") * F.col("step") + 1, F.col("step")))
    third = F.greatest(F.lit(1), F.floor(F.size("own") / 3)).cast("int")
    cut = lambda k: F.array_join(F.slice("own", third * k + 1, third), " ")
    fields = F.create_map(F.lit("description"), cut(0), F.lit("potential_impact"), cut(1), F.lit("how_we_manage_it"), cut(2))
    return _blocks(
        parts, block_id=F.concat(F.lit("p"), F.col("page").cast("string"), F.lit("-erm-"), (F.col("i") + 1).cast("string")), source_register=F.lit("erm_main_risk"), heading=F.array_join(F.slice("own", 1, 4), " "), fields=fields,
        text=F.array_join("own", " "), marker=F.lit("risk"), marker_source=F.lit("n/a"), strategy=F.lit("main_risks_table"), quality_flags=F.array().cast("array<string>"),
    )


PARSERS: dict[str, Callable[[Pages], DataFrame]] = {"main_risks_table": main_risks_table, "esrs_table": esrs_tables}


def parsed(p: Pages, parsers: dict[str, Callable[[Pages], DataFrame]] | None = None) -> DataFrame:
    """The blocks of all pages: of the parser that a page's layout names, and a plain block for a page without layout or
    on which its parser found nothing (which is flagged)."""
    known = PARSERS if parsers is None else parsers
    found = None
    for layout, parser in known.items():
        blocks = parser(p.of(layout))
        found = blocks if found is None else found.unionByName(blocks)
    if found is None:
        return plain_blocks(p.pages)
    rest = p.pages.join(found.select(*PAGE).distinct(), list(PAGE), "left_anti")
    plain = plain_blocks(rest).join(p.pages.select(*PAGE, F.col("layout").isin(list(known)).alias("__tried")), list(PAGE))
    flagged = plain.withColumn("quality_flags", F.when(F.coalesce("__tried", F.lit(False)), F.concat("quality_flags", F.array(F.lit("table_reconstruction_found_nothing")))).otherwise(F.col("quality_flags")))
    return found.unionByName(flagged.select(*_NAMES))
