"""Comparing candidates proposed from running text with the risks read from tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.similarity import letter_counts, scored_pairs
from citeloom.functions.text import norm_text
from citeloom.operators.records import SPAN_PREFIX

# Fixed values of the comparison.
QUOTE_PREFIX, TITLE_RATIO, LOOK_BACK, QUOTE_START = 60, 0.8, 1500, 40
TYPE_LINE = r"(?i)Type of impact:[ \t]*([^\n]+)"


def last_above(text: Column, quote: Column, pattern: str = TYPE_LINE, back: int = LOOK_BACK) -> Column:
    """The last match of ``pattern`` (its first group) in the ``back`` characters before a quote's first characters, up to
    and with the first of them; null where the quote is not in the text, begins it, or nothing matches."""
    at = F.instr(text, F.substring(quote, 1, QUOTE_START))
    window = F.substring(text, F.greatest(F.lit(1), at - back), F.least(at, F.lit(back + 1)))
    return F.when(at > 1, F.trim(F.try_element_at(F.regexp_extract_all(window, F.lit(pattern), F.lit(1)), F.lit(-1))))


def table_matches(proposed: DataFrame, tables: DataFrame, key: str) -> DataFrame:
    """``key, seq, table_no, matched_by`` of proposed candidates.

    The first table risk whose printed text (span, impact, title) holds the head of the candidate's span, or whose own
    head stands in that span, is a match by ``quote``; without one, the table risk with the most similar title is a match
    by ``title`` if its ratio reaches 0.8 (the first of equals). ``proposed`` has ``seq, title, span``, ``tables``
    ``table_no, title, span, impact``; only the pairs of a report are compared.
    """
    a = proposed.select(key, "seq", norm_text(F.col("span")).alias("sa"), norm_text(F.col("title")).alias("ta")).withColumn("ta_n", letter_counts(F.col("ta")))
    own = F.array_join(F.filter(F.array(*(F.coalesce(c, F.lit("")) for c in ("span", "impact", "title"))), lambda x: x != ""), " ")
    b = tables.select(key, "table_no", norm_text(own).alias("source"), norm_text(F.coalesce("span", F.lit(""))).alias("sb"), norm_text(F.col("title")).alias("tb")).withColumn("tb_n", letter_counts(F.col("tb")))
    pairs = a.join(b, key)
    quoted = pairs.where(F.contains("source", F.substring("sa", 1, QUOTE_PREFIX)) | F.contains("sa", F.substring("sb", 1, QUOTE_PREFIX))).groupBy(key, "seq").agg(F.min("table_no").alias("by_quote"))
    like = scored_pairs(pairs.select(key, "seq", "table_no", "tb", "ta", "tb_n", "ta_n"), "tb", "ta", TITLE_RATIO).groupBy(key, "seq").agg(F.max_by("table_no", F.struct("score", -F.col("table_no"))).alias("by_title"))
    both = a.select(key, "seq").join(quoted, [key, "seq"], "left").join(like, [key, "seq"], "left")
    return both.select(key, "seq", F.coalesce("by_quote", "by_title").alias("table_no"), F.when(F.col("by_quote").isNotNull(), "quote").when(F.col("by_title").isNotNull(), "title").alias("matched_by"))


def identified_all(proposed: DataFrame, tables: DataFrame, pages: DataFrame, blocks: DataFrame, key: str) -> DataFrame:
    """Proposed candidates whose span stands on their page, each with the table risk it matches, the marker of the table
    row that holds its span, and the type line above its quote.

    ``proposed`` has ``page`` besides; ``pages`` ``key, page, text``; ``blocks`` ``key, page, block_id, text, marker``.
    """
    text = pages.select(key, "page", F.col("text").alias("page_text"))
    kept = proposed.join(text, [key, "page"]).where(F.contains(norm_text(F.col("page_text")), F.substring(norm_text(F.col("span")), 1, SPAN_PREFIX)))
    row = blocks.select(key, "page", "block_id", "marker", norm_text(F.col("text")).alias("bt"))
    in_rows = kept.select(key, "seq", "page", norm_text(F.col("span")).alias("sn")).join(row, [key, "page"]).where(F.contains("bt", F.substring("sn", 1, QUOTE_PREFIX))).groupBy(key, "seq").agg(F.min_by("marker", "block_id").alias("table_row"))
    rows = kept.join(table_matches(kept, tables, key), [key, "seq"], "left").join(in_rows, [key, "seq"], "left")
    return rows.select(key, "seq", "page", "title", "table_no", "matched_by", "table_row", last_above(F.col("page_text"), F.col("span")).alias("type_above"))


def identified_summary(proposed: DataFrame, found: DataFrame, tables: DataFrame, key: str) -> DataFrame:
    """Per report: candidates proposed, kept and dropped (their quote is not on the page), table risks, and those found and
    missed."""
    a, b = proposed.groupBy(key).agg(F.count("*").alias("proposed")), found.groupBy(key).agg(F.count("*").alias("kept"))
    hit = found.where("table_no IS NOT NULL").select(key, "table_no").distinct().withColumn("hit", F.lit(True))
    t = tables.join(hit, [key, "table_no"], "left").groupBy(key).agg(
        F.count("*").alias("table_risks"), F.count("hit").alias("found"), F.array_sort(F.collect_list(F.when(F.col("hit").isNull(), F.col("title")))).alias("missed")
    )
    every = t.join(a, key, "full_outer").join(b, key, "left")
    n = lambda c: F.coalesce(c, F.lit(0).cast("long"))
    return every.select(key, n("proposed").alias("proposed"), n("kept").alias("kept"), (n("proposed") - n("kept")).alias("dropped"), n("table_risks").alias("table_risks"), n("found").alias("found"), "missed")
