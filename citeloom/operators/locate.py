"""Finding the configured sections of a document: contents entries, page offset, ranges, landing pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.text import norm_title
from citeloom.operators.sections import best_title, mode_first_seen

#: Pages looked at from the expected one on for a printed number.
MOST_PROBES = 6


def outcome(required: Column, failed: Column, soft: Column | None = None) -> Column:
    """ok unless ``failed``; then warning for a soft failure or an optional part, else error."""
    mild = ~required if soft is None else soft | ~required
    return F.when(~failed, "ok").when(mild, "warning").otherwise("error")


def internal_links(links: DataFrame) -> DataFrame:
    """Links that lead to a page of the same document."""
    return links.where(F.upper("kind").isin("GOTO", "NAMED") & (F.col("dest_index") >= 0))


def matched_sections(specs: DataFrame, entries: DataFrame, key: str) -> DataFrame:
    """Each configured section of each document with its best contents entry: the grade, the score and the entry's printed
    page and linked page.

    ``specs`` has ``section, spec_no, titles`` (accepted titles, the first one configured); ``entries`` has ``key,
    entry_no, title, printed_page, pdf_index``. The first entry with the best score wins, then the first accepted title.
    """
    titles = specs.select("spec_no", "section", F.posexplode("titles").alias("title_no", "want_title"))
    numbered = titles.withColumn("want_no", F.col("spec_no") * 1000 + F.col("title_no"))
    documents = entries.select(key).distinct()
    # The configured sections are a parameter list of a few rows: every document is compared with all of them.
    wanted = documents.withColumn("__w", F.explode(F.array(*[F.struct(F.lit(r["want_no"]).alias("want_no"), F.lit(r["want_title"]).alias("want_title"), F.lit(r["section"]).alias("section")) for r in numbered.collect()])))
    wanted = wanted.select(key, "__w.*")
    found = best_title(wanted.select(key, "want_no", "want_title"), entries.select(key, F.col("entry_no").alias("offer_no"), "title"), [key])
    ranked = found.join(wanted.select(key, "want_no", "section"), [key, "want_no"]).where("match_score IS NOT NULL")
    best = ranked.groupBy(key, "section").agg(F.max_by(F.struct("matched_no", "matched_title", "match_grade", "match_score"), F.struct("match_score", -F.col("matched_no"), -F.col("want_no"))).alias("b"))
    lines = entries.select(key, F.col("entry_no").alias("matched_no"), "printed_page", "pdf_index")
    return best.select(key, "section", "b.*").join(lines, [key, "matched_no"]).select(key, "section", "matched_title", "match_grade", "match_score", "printed_page", "pdf_index")


def measured_offsets(probes: DataFrame, footers: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """The offset of each printed page that can be measured: ``pdf_index - (printed - 1)``.

    From the expected page on up to ``MOST_PROBES`` pages are looked at until one has a printed number; the offset that
    it gives counts only if the page it leads to carries the wanted number. ``probes`` has ``key, seq, printed_page``,
    ``footers`` ``key, pdf_index, number`` and ``sizes`` ``key, page_count``.
    """
    tried = probes.select(key, "seq", "printed_page", F.explode(F.sequence(F.lit(0), F.lit(MOST_PROBES - 1))).alias("step")).withColumn("pdf_index", F.col("printed_page") - 1 + F.col("step"))
    inside = tried.join(sizes, key).where((F.col("pdf_index") >= 0) & (F.col("pdf_index") < F.col("page_count")))
    first = inside.join(footers.where("number IS NOT NULL"), [key, "pdf_index"]).groupBy(key, "seq", "printed_page", "page_count").agg(F.min_by(F.struct("pdf_index", "number"), "step").alias("f"))
    at = first.withColumn("page_offset", F.col("f.pdf_index") - (F.col("f.number") - 1)).withColumn("pdf_index", F.col("printed_page") - 1 + F.col("page_offset"))
    held = at.where((F.col("pdf_index") >= 0) & (F.col("pdf_index") < F.col("page_count"))).join(footers, [key, "pdf_index"])
    return held.where(F.col("number") == F.col("printed_page")).select(key, "seq", "printed_page", "page_offset")


def document_offsets(matches: DataFrame, specs: DataFrame, footers: DataFrame, sizes: DataFrame, key: str) -> DataFrame:
    """``key, page_offset, offset_source``: by vote of the matched entries' links, else of the offsets measured from
    printed numbers, else 0 (the configuration). Of equal votes the first section's wins."""
    order = specs.select("section", "spec_no", "first_page")
    rows = matches.join(F.broadcast(order), "section")  # the configured sections: a parameter list
    linked = rows.where("pdf_index IS NOT NULL").select(key, (F.col("pdf_index") - (F.col("printed_page") - 1)).alias("page_offset"), F.col("spec_no").alias("seq"))
    by_link = mode_first_seen(linked, [key], "page_offset", "seq").select(key, F.col("page_offset").alias("by_link"))
    probes = rows.select(key, F.col("spec_no").alias("seq"), "printed_page")
    config = F.array(*[F.struct(F.lit(r["spec_no"]).alias("seq"), F.lit(r["first_page"]).alias("printed_page")) for r in order.orderBy("spec_no").collect()])
    unmatched = sizes.join(matches.select(key).distinct(), key, "left_anti").select(key, F.explode(config).alias("p")).select(key, "p.seq", "p.printed_page")
    measured = measured_offsets(probes.unionByName(unmatched), footers, sizes, key)
    by_footer = mode_first_seen(measured, [key], "page_offset", "seq").select(key, F.col("page_offset").alias("by_footer"))
    every = sizes.select(key).join(by_link, key, "left").join(by_footer, key, "left")
    source = F.when(F.col("by_link").isNotNull(), "toc_link").when(F.col("by_footer").isNotNull(), "toc_footer").otherwise("config")
    return every.select(key, F.coalesce("by_link", "by_footer", F.lit(0)).cast("int").alias("page_offset"), source.alias("offset_source"))


def located(specs: DataFrame, entries: DataFrame, pages: DataFrame, footers: DataFrame, key: str) -> DataFrame:
    """One row per document and configured section: where it is, how sure that is and why not.

    ``specs`` has ``section, spec_no, titles, first_page, last_page, required``, ``entries`` as in
    ``matched_sections``, ``pages`` ``key, pdf_index, text`` and ``footers`` ``key, pdf_index, number``. A section ends on
    the page before the next printed page of the contents; the configured end caps it only where the configured start was
    found. Without an entry the configured range counts. The first page must show an accepted title and its number.
    """
    sizes = pages.groupBy(key).agg((F.max("pdf_index") + 1).alias("page_count"))
    matches = matched_sections(specs, entries, key)
    offsets = document_offsets(matches, specs, footers, sizes, key)
    plan = F.array(*[F.struct(*(F.lit(v).alias(c) if c != "titles" else F.array(*map(F.lit, v)).alias(c) for c, v in r.asDict().items())) for r in specs.orderBy("spec_no").collect()])
    rows = sizes.select(key, "page_count", F.explode(plan).alias("s")).select(key, "page_count", "s.*")
    rows = rows.join(matches, [key, "section"], "left").join(offsets, key)
    starts = entries.where("printed_page IS NOT NULL").select(key, "printed_page").distinct()
    ends = starts.withColumn("next_page", F.lead("printed_page").over(Window.partitionBy(key).orderBy("printed_page")))
    rows = rows.join(ends, [key, "printed_page"], "left")
    missing = F.col("match_grade").isNull()
    first = F.coalesce("printed_page", "first_page")
    by_contents = F.coalesce(F.col("next_page") - 1, "printed_page")
    last = F.when(missing, F.col("last_page")).when(F.col("printed_page") == F.col("first_page"), F.least(by_contents, "last_page")).otherwise(by_contents)
    index = F.coalesce("pdf_index", first - 1 + F.col("page_offset"))
    rows = rows.select(
        key, "section", "required", "page_count", "titles", F.col("first_page").alias("config_first"), "matched_title", F.coalesce("match_grade", F.lit("none")).alias("match_grade"), "match_score", first.alias("first_page"), last.alias("last_page"),
        index.cast("int").alias("pdf_index"), F.when(missing, "config").when(F.col("pdf_index").isNotNull(), "toc_link").otherwise(F.col("offset_source")).alias("source"), "page_offset", "offset_source",
    )
    landing = rows.join(pages.select(key, "pdf_index", norm_title(F.col("text")).alias("shown")), [key, "pdf_index"], "left").join(footers, [key, "pdf_index"], "left")
    title_ok = F.coalesce(F.exists("titles", lambda t: F.contains(F.col("shown"), norm_title(t))), F.lit(False))
    footer_ok = F.coalesce(F.col("number") == F.col("first_page"), F.lit(False))
    text = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    grade, lost = F.col("match_grade"), F.col("match_grade") == "none"
    differs = ~lost & (F.col("first_page") != F.col("config_first"))
    flags = F.array_compact(
        F.array(
            F.when(lost, F.concat(F.lit("toc_title_not_found:"), F.col("titles")[0])),
            F.when(grade == "variant", F.concat(F.lit("toc_title_variant:"), F.col("matched_title"))),
            F.when(grade == "similarity", F.concat(F.lit("toc_title_similarity:"), F.format_string("%.2f", "match_score"), F.lit(":"), F.col("matched_title"))),
            F.when(differs, F.concat(F.lit("toc_page_differs_from_config:toc="), text(F.col("first_page")), F.lit(",config="), text(F.col("config_first")))),
            F.when(~title_ok, F.concat(F.lit("heading_not_on_first_page:"), text(F.col("first_page")))),
            F.when(~footer_ok, F.concat(F.lit("printed_page_mismatch:footer="), text(F.col("number")), F.lit(",expected="), text(F.col("first_page")))),
        )
    )
    match_outcome = F.when(grade == "similarity", "warning").otherwise(outcome(F.col("required"), lost))
    landing_outcome = outcome(F.col("required"), ~(title_ok & footer_ok))
    worst = F.when((match_outcome == "error") | (landing_outcome == "error"), "error").when((match_outcome == "warning") | (landing_outcome == "warning"), "warning").otherwise("ok")
    return landing.select(
        key, "section", "required", "matched_title", "match_grade", F.round("match_score", 3).alias("match_score"), "first_page", "last_page", "pdf_index", "source", "page_offset", "offset_source",
        title_ok.alias("title_ok"), F.col("number").alias("footer"), match_outcome.alias("match_outcome"), landing_outcome.alias("landing_outcome"), worst.alias("outcome"), flags.alias("quality_flags"),
    )
