"""Contents lists and section ranges: finding entries, grading titles, measuring page offsets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.similarity import letter_counts, scored_pairs
from citeloom.functions.text import norm_title

# Fixed values of the contents scan.
SCAN_PAGES, LEAST_ENTRIES, SIMILARITY_FLOOR = 12, 5, 0.85
#: A contents line: a title that starts with a capital letter or a number, a run of leader marks, a page number.
ENTRY = r"(?m)^[ \t]*((?:[0-9]+(?:\.[0-9]+)* )?[^\n.]{2,80}?)[ \t]*[.·…_]{3,}[ \t]*([0-9]{1,4})[ \t]*$"


def contents_entries(pages: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``key, entry_no, title, printed_page`` of the contents lines of each text."""
    found = F.arrays_zip(F.regexp_extract_all(text, F.lit(ENTRY), F.lit(1)).alias("title"), F.regexp_extract_all(text, F.lit(ENTRY), F.lit(2)).alias("page"))
    rows = pages.select(key, F.posexplode(found).alias("i", "e"))
    return rows.select(key, (F.col("i") + 1).alias("entry_no"), F.trim("e.title").alias("title"), F.col("e.page").cast("int").alias("printed_page"))


def contents_pages(pages: DataFrame, text: str = "text") -> DataFrame:
    """Pages among the first ``SCAN_PAGES`` (by ``pdf_index``) with at least ``LEAST_ENTRIES`` contents lines."""
    return pages.where((F.col("pdf_index") < SCAN_PAGES) & (F.size(F.regexp_extract_all(text, F.lit(ENTRY), F.lit(1))) >= LEAST_ENTRIES))


def linked_entries(entries: DataFrame, links: DataFrame, keys: list[str]) -> DataFrame:
    """Contents lines with the page their first internal link leads to: the line's middle within 2 points of the link's
    box and its title starting inside the box (3 points to the left allowed)."""
    near = entries.join(links.select(*keys, "seq", F.col("x0").alias("lx0"), F.col("x1").alias("lx1"), "y0", "y1", "dest_index"), keys, "left")
    hit = (F.col("y_mid").between(F.col("y0") - 2, F.col("y1") + 2)) & F.col("x0").between(F.col("lx0") - 3, F.col("lx1"))
    return near.groupBy(*entries.columns).agg(F.min(F.when(hit, F.struct("seq", "dest_index"))).alias("b")).select(*entries.columns, F.col("b.dest_index").alias("pdf_index"))


def best_title(wanted: DataFrame, offered: DataFrame, keys: list[str]) -> DataFrame:
    """Each wanted title with the offered title of its key that fits best: ``match_grade, match_score``.

    Exact (equal in normal form) scores 1, variant (one goes on after the other) 0.95, else the block ratio counts from
    ``SIMILARITY_FLOOR``. Ties go to the first offered title. Only pairs that can reach the floor go to Python.
    ``wanted`` has ``want_no, want_title``; ``offered`` has ``offer_no, title``.
    """
    # The forms are made below the join, once per title.
    left = wanted.withColumn("w", norm_title(F.col("want_title"))).where("w <> ''").withColumn("w_n", letter_counts(F.col("w")))
    right = offered.withColumn("o", norm_title(F.col("title"))).where("o <> ''").withColumn("o_n", letter_counts(F.col("o")))
    pairs = left.join(right, keys).select(*keys, "want_no", "want_title", "offer_no", "title", "w", "o", "w_n", "o_n")
    sure = F.when(F.col("w") == F.col("o"), 1.0).when(variant(F.col("w"), F.col("o")), 0.95)
    known = pairs.withColumn("sure", sure)
    like = scored_pairs(known.where("sure IS NULL"), "w", "o", SIMILARITY_FLOOR).select(*keys, "want_no", "offer_no", "title", "score")
    scored = known.where("sure IS NOT NULL").select(*keys, "want_no", "offer_no", "title", F.col("sure").alias("score")).unionByName(like)
    best = scored.groupBy(*keys, "want_no").agg(F.max_by(F.struct("title", "score", "offer_no"), F.struct("score", -F.col("offer_no"))).alias("b"))
    score = F.col("b.score")
    grade = F.when(score == 1.0, "exact").when(score == 0.95, "variant").when(score.isNotNull(), "similarity").otherwise("none")
    return wanted.join(best, [*keys, "want_no"], "left").select(
        *keys, "want_no", "want_title", F.col("b.title").alias("matched_title"), grade.alias("match_grade"), score.alias("match_score"), F.col("b.offer_no").alias("matched_no")
    )


def variant(a: Column, b: Column) -> Column:
    """Whether one of two normal forms goes on after the other at a word's end."""
    return F.startswith(a, F.concat(b, F.lit(" "))) | F.startswith(b, F.concat(a, F.lit(" ")))


def section_ranges(starts: DataFrame, key: str) -> DataFrame:
    """``key, section, first_page, last_page``: a section ends on the page before the next distinct start of its key;
    the last one has no end. ``starts`` has ``section, page``."""
    pages = starts.select(key, "page").distinct()
    ends = pages.withColumn("last_page", F.lead("page").over(Window.partitionBy(key).orderBy("page")) - 1)
    return starts.select(key, "section", "page").distinct().join(ends, [key, "page"]).select(key, "section", F.col("page").alias("first_page"), "last_page")


def page_offsets(probes: DataFrame, key: str) -> DataFrame:
    """The page offset of each key: the vote of ``pdf_index - printed_page``, the first seen winning ties."""
    votes = probes.where("printed_page IS NOT NULL").select(key, (F.col("pdf_index") - F.col("printed_page")).alias("page_offset"), "seq")
    return mode_first_seen(votes, [key], "page_offset", "seq")


def mode_first_seen(rows: DataFrame, keys: list[str], value: str, seq: str) -> DataFrame:
    """The most frequent value of each key; of equally frequent ones that which was seen first."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"), F.min(seq).alias("first"))
    # One row per key and value is left; the greatest count wins, then the least first position.
    ranked = Window.partitionBy(*keys).orderBy(F.desc("n"), "first", value)
    return counts.withColumn("rank", F.row_number().over(ranked)).where("rank = 1").select(*keys, value, F.col("n").alias("votes"))


def checked_range(ranges: DataFrame, pages: DataFrame, key: str) -> DataFrame:
    """Rows of ``pages`` whose page lies outside the range of their section (no range: outside)."""
    r = ranges.select(key, "section", "first_page", "last_page")
    inside = (F.col("page") >= F.col("first_page")) & (F.col("last_page").isNull() | (F.col("page") <= F.col("last_page")))
    return pages.join(r, [key, "section"], "left").where(~F.coalesce(inside, F.lit(False))).select(*pages.columns)


def located(specs: DataFrame, matches: DataFrame, ranges: DataFrame, key: str) -> DataFrame:
    """Configured sections with where they were found: the matched range, or the configured one where no title matched;
    flags say why a range is less sure, and ``outcome`` is error (a required section without title), warning or ok.

    ``specs`` has ``section, first_page, last_page, required``; ``matches`` has ``section, match_grade``; ``ranges`` as
    from :func:`section_ranges`.
    """
    found = ranges.select(key, "section", F.col("first_page").alias("f"), F.col("last_page").alias("l"))
    rows = specs.join(matches.select(key, "section", "match_grade"), [key, "section"], "left").join(found, [key, "section"], "left")
    grade = F.coalesce("match_grade", F.lit("none"))
    missing = grade == "none"
    differs = ~missing & ~F.col("f").eqNullSafe(F.col("first_page"))
    flags = F.array_compact(
        F.array(F.when(missing, "not_found"), F.when(grade.isin("variant", "similarity"), F.concat(F.lit("title_"), grade)), F.when(differs, "differs_from_configuration"))
    )
    # The configured end holds only where the configured start was found.
    last = F.when(missing, F.col("last_page")).when(differs, F.col("l")).otherwise(F.coalesce(F.least("l", "last_page"), "last_page"))
    outcome = F.when(missing & F.col("required"), "error").when(missing | (grade == "similarity"), "warning").otherwise("ok")
    return rows.select(key, "section", grade.alias("match_grade"), F.when(missing, F.col("first_page")).otherwise(F.col("f")).alias("first_page"), last.alias("last_page"), flags.alias("quality_flags"), outcome.alias("outcome"))
