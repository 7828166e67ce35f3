"""The run log's check catalogue: one row per check (and section) with outcome, count and detail.

Every function gives rows ``report_id, phase, check_id, outcome, count, strategy, detail`` (detail as JSON), computed for
all reports at once; ``stamped`` adds the run and the time for the run log.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions.text import ngram_share, word_tokens
from citeloom.operators.grounding import PASS_LEAST, page_coverage

# Fixed values of the checks.
FIDELITY_LEAST, COVERAGE_LEAST, AGREEMENT_LEAST, HEADER_BAND = 0.95, 0.95, 0.7, 40.0
TABLE_COLUMNS, TABLE_ROWS = 3, 3


def check(rows: DataFrame, phase: str, check_id: str, result: Column, count: Column, strategy: Column | None = None, /, **detail: Column) -> DataFrame:
    """``rows`` (one per report or section) as check rows."""
    parts = F.to_json(F.struct(*(v.alias(k) for k, v in detail.items()))) if detail else F.lit(None).cast("string")
    return rows.select(
        "report_id", F.lit(phase).alias("phase"), F.lit(check_id).alias("check_id"), result.alias("outcome"), count.cast("long").alias("count"), (F.lit(None) if strategy is None else strategy).cast("string").alias("strategy"), parts.alias("detail")
    )


def union(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def stamped(checks: DataFrame, run_id: str, at: Column | None = None) -> DataFrame:
    """Check rows of a run, as the run log keeps them."""
    return checks.select(F.lit(run_id).alias("run_id"), "*", (F.current_timestamp() if at is None else at).alias("created_at"))


def run_id(at: Column | None = None) -> Column:
    """The name of a run: its time in UTC as ``yyyymmddThhmmssZ``."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp() if at is None else at, F.current_timezone()), "yyyyMMdd'T'HHmmss'Z'")


def _bad(n: Column, outcome: str) -> Column:
    return F.when(n > 0, outcome).otherwise("ok")


def _listed(test: Column, value: Column) -> Column:
    return F.array_sort(F.collect_list(F.when(test, value)))


def locate_checks(located: DataFrame, entries: DataFrame) -> DataFrame:
    """toc_pages, page_offset (only where no link gave it), section_match_grade and landing_page_ok. ``located`` as from
    ``locate.located`` and ``entries`` with ``page_index``, both keyed by ``report_id``."""
    reports = located.select("report_id").distinct()
    toc = reports.join(entries.groupBy("report_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("page_index")).alias("pages"), F.count("pdf_index").alias("links")), "report_id", "left")
    n = F.coalesce("n", F.lit(0))
    offsets = located.where("offset_source <> 'toc_link'").select("report_id", "page_offset", "offset_source").distinct()
    return union([
        check(toc, "extract", "toc_pages", F.when(n > 0, "ok").otherwise("warning"), n, pages=F.col("pages"), links=F.col("links")),
        check(offsets, "extract", "page_offset", F.when(F.col("offset_source") == "config", "warning").otherwise("ok"), F.lit(1), F.col("offset_source"), offset=F.col("page_offset")),
        check(located, "extract", "section_match_grade", F.col("match_outcome"), F.lit(1), F.col("match_grade"), section=F.col("section"), score=F.col("match_score"), matched=F.col("matched_title")),
        check(located, "extract", "landing_page_ok", F.col("landing_outcome"), F.lit(1), section=F.col("section"), page=F.col("first_page"), pdf_index=F.col("pdf_index"), title_ok=F.col("title_ok"), footer=F.col("footer")),
    ])


def parser_override(reports: DataFrame, name: str) -> DataFrame:
    """A run whose parser was replaced says so."""
    return check(reports.select("report_id").distinct(), "extract", "parser_override", F.lit("warning"), F.lit(1), F.lit(name))


def section_checks(sections: DataFrame, blocks: DataFrame) -> DataFrame:
    """blocks_per_section: a section that was located and has no block is an error if it is required."""
    n = blocks.groupBy("report_id", "section").agg(F.count("*").alias("n"))
    rows = sections.where("outcome <> 'error'").join(n, ["report_id", "section"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return check(rows, "extract", "blocks_per_section", F.when(F.col("n") > 0, "ok").when(F.col("required"), "error").otherwise("warning"), F.col("n"), section=F.col("section"))


def shape_check(blocks: DataFrame) -> DataFrame:
    """main_risks_shape: three columns by three rows without an empty cell; only reports with such blocks have it."""
    own = blocks.where("strategy = 'main_risks_table'")
    cells = own.select("report_id", "heading", F.explode_outer("fields").alias("k", "v"))
    rows = cells.where("v <> ''").groupBy("report_id").agg(F.array_sort(F.collect_set("k")).alias("rows"))
    empty = cells.groupBy("report_id").agg(_listed((F.col("v") == "") & F.col("k").isNotNull(), F.concat_ws("/", "heading", "k")).alias("empty"))
    both = own.groupBy("report_id").agg(F.count("*").alias("n")).join(rows, "report_id", "left").join(empty, "report_id", "left")
    sound = (F.col("n") == TABLE_COLUMNS) & (F.coalesce(F.size("rows"), F.lit(0)) == TABLE_ROWS) & (F.coalesce(F.size("empty"), F.lit(0)) == 0)
    return check(both, "extract", "main_risks_shape", F.when(sound, "ok").otherwise("error"), F.col("n"), rows=F.col("rows"), empty=F.col("empty"))


def marker_checks(blocks: DataFrame) -> DataFrame:
    """marker_missing and marker_disagreement over the financial entries of topic tables; every report with blocks has both."""
    judged = (F.col("strategy") == "esrs_table") & F.col("marker").isin("risk", "opportunity", "immaterial")
    missing, differs = judged & F.array_contains("quality_flags", "marker_icon_missing"), judged & F.exists("quality_flags", lambda f: F.startswith(f, F.lit("marker_disagreement")))
    rows = blocks.withColumn("quality_flags", F.coalesce("quality_flags", F.array().cast("array<string>"))).groupBy("report_id").agg(
        F.count_if(missing).alias("m"), _listed(missing, F.col("block_id")).alias("missing"), F.count_if(differs).alias("d"), _listed(differs, F.col("block_id")).alias("differ"),
        F.count_if(judged & (F.col("marker") == "risk")).alias("risks"), F.count_if(judged & (F.col("marker") == "opportunity")).alias("opportunities"),
    )
    return union([
        check(rows, "extract", "marker_missing", _bad(F.col("m"), "warning"), F.col("m"), blocks=F.col("missing")),
        check(rows, "extract", "marker_disagreement", _bad(F.col("d"), "warning"), F.col("d"), blocks=F.col("differ"), risks=F.col("risks"), opportunities=F.col("opportunities")),
    ])


def text_checks(blocks: DataFrame, pages: DataFrame, page_words: DataFrame) -> DataFrame:
    """text_not_on_page (a block whose word trigrams are not on its page) and page_coverage (a page of reconstructed blocks
    that lack its words). Plain blocks are whole by construction. ``pages`` has ``report_id, page, text`` and
    ``page_words`` ``report_id, page, word, top``."""
    plain = F.col("strategy") == "plain_text"
    own = blocks.where(~plain).join(pages.select("report_id", "page", F.col("text").alias("page_text")), ["report_id", "page"])
    fidelity = own.select("report_id", "block_id", ngram_share(F.col("text"), F.col("page_text")).alias("f"))
    reports = blocks.select("report_id").distinct()
    low = fidelity.groupBy("report_id").agg(F.count_if(F.col("f") < FIDELITY_LEAST).alias("n"), _listed(F.col("f") < FIDELITY_LEAST, F.struct("block_id", F.round("f", 3).alias("share"))).alias("blocks"))
    low = reports.join(low, "report_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    rebuilt = blocks.groupBy("report_id", "page").agg(F.bool_or(~plain).alias("rebuilt")).where("rebuilt").select("report_id", "page")
    words = blocks.select("report_id", "page", F.explode(word_tokens(F.concat_ws(" ", "heading", "text"))).alias("word"))
    tokens = page_words.select("report_id", "page", "top", F.explode(word_tokens(F.col("word"))).alias("word"))
    cover = page_coverage(tokens, words, ["report_id", "page"], HEADER_BAND).join(rebuilt, ["report_id", "page"])
    bare = cover.groupBy("report_id").agg(F.count_if(F.col("coverage") < COVERAGE_LEAST).alias("n"), _listed(F.col("coverage") < COVERAGE_LEAST, F.struct("page", F.round("coverage", 3).alias("share"))).alias("pages"))
    bare = reports.join(bare, "report_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return union([
        check(low, "extract", "text_not_on_page", _bad(F.col("n"), "error"), F.col("n"), blocks=F.col("blocks")),
        check(bare, "extract", "page_coverage", _bad(F.col("n"), "warning"), F.col("n"), pages=F.col("pages"), threshold=F.lit(COVERAGE_LEAST)),
    ])


def range_check(blocks: DataFrame, sections: DataFrame) -> DataFrame:
    """block_ids_and_ranges: names used twice, and blocks outside the pages of their section."""
    twice = blocks.groupBy("report_id", "block_id").agg(F.count("*").alias("n")).where("n > 1").groupBy("report_id").agg(F.array_sort(F.collect_list("block_id")).alias("duplicates"))
    placed = blocks.join(sections.select("report_id", "section", "first_page", "last_page"), ["report_id", "section"], "left")
    inside = F.coalesce(F.col("page").between(F.col("first_page"), F.col("last_page")), F.lit(False))
    outside = placed.groupBy("report_id").agg(_listed(~inside, F.col("block_id")).alias("outside"))
    rows = blocks.select("report_id").distinct().join(twice, "report_id", "left").join(outside, "report_id", "left")
    n = F.coalesce(F.size("duplicates"), F.lit(0)) + F.coalesce(F.size("outside"), F.lit(0))
    return check(rows, "extract", "block_ids_and_ranges", _bad(n, "error"), n, duplicates=F.col("duplicates"), outside=F.col("outside"))


def marker_counts(blocks: DataFrame) -> DataFrame:
    """Blocks by page and marker, under the name ``page:marker``."""
    return blocks.groupBy("report_id", F.concat_ws(":", F.col("page").cast("string"), "marker").alias("key")).agg(F.count("*").alias("n"))


def drift_check(counts: DataFrame, previous: DataFrame | None) -> DataFrame:
    """count_drift: counts by page and marker that differ from the report's previous run (``report_id, key, n``); a report
    without one is ok."""
    reports = counts.select("report_id").distinct()
    if previous is None:
        return check(reports, "extract", "count_drift", F.lit("ok"), F.lit(0))
    known = previous.select("report_id").distinct().withColumn("__known", F.lit(True))
    old = previous.join(reports, "report_id", "left_semi").select("report_id", "key", F.col("n").alias("previous"))
    both = counts.join(known, "report_id", "left_semi").select("report_id", "key", F.col("n").alias("current")).join(old, ["report_id", "key"], "full_outer").where(~F.col("previous").eqNullSafe(F.col("current")))
    changed = both.groupBy("report_id").agg(F.count("*").alias("n"), F.array_sort(F.collect_list(F.struct("key", "previous", "current"))).alias("changed"))
    rows = reports.join(changed, "report_id", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return check(rows, "extract", "count_drift", _bad(F.col("n"), "warning"), F.col("n"), changed=F.col("changed"))


def previous_counts(log: DataFrame, current_run: str) -> DataFrame:
    """``report_id, key, n`` of each report's last other run (by name) that has a count_drift row with its counts."""
    rows = log.where((F.col("check_id") == "count_drift") & (F.col("run_id") != current_run)).select("report_id", "run_id", F.from_json(F.get_json_object("detail", "$.counts"), "map<string,long>").alias("counts")).where("counts IS NOT NULL")
    return rows.groupBy("report_id").agg(F.max_by("counts", "run_id").alias("counts")).select("report_id", F.explode("counts").alias("key", "n"))


def extract_checks(sections: DataFrame, blocks: DataFrame, pages: DataFrame, page_words: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """The eight checks of extracted blocks (two of them on markers)."""
    return union([section_checks(sections, blocks), shape_check(blocks), marker_checks(blocks), text_checks(blocks, pages, page_words), range_check(blocks, sections), drift_check(marker_counts(blocks), previous)])


def identify_checks(candidates: DataFrame, agreement: DataFrame | None = None) -> DataFrame:
    """identify_register (none is an error) and identify_agreement (below 0.7, or nothing to compare, is a warning).
    ``candidates`` has ``report_id, source_register, n``; ``agreement`` ``report_id, matched, total``."""
    one = lambda r: F.sum(F.when(F.col("source_register") == r, F.col("n")).otherwise(0))
    rows = candidates.groupBy("report_id").agg(F.sum("n").alias("n"), one("erm_main_risk").alias("erm"), one("esrs_financial_risk").alias("esrs"))
    out = [check(rows, "transform", "identify_register", F.when(F.col("n") > 0, "ok").otherwise("error"), F.col("n"), erm=F.col("erm"), esrs=F.col("esrs"))]
    if agreement is not None:
        rate = F.try_divide(F.col("matched").cast("double"), F.col("total"))
        out.append(check(agreement, "transform", "identify_agreement", F.when(F.coalesce(rate < AGREEMENT_LEAST, F.lit(True)), "warning").otherwise("ok"), F.col("total"), rate=F.round(rate, 3)))
    return union(out)


def counted(rows: DataFrame, check_id: str, test: Column, value: Column) -> DataFrame:
    """A check that only counts (category_poor_fit, merge, mitigation_enriched): always ok."""
    found = rows.groupBy("report_id").agg(F.count_if(test).alias("n"), _listed(test, value).alias("ids"))
    return check(found, "transform", check_id, F.lit("ok"), F.col("n"), ids=F.col("ids"))


def grounding_check(checked: DataFrame) -> DataFrame:
    """grounding_failures: the share of records without problems is below 0.8. ``checked`` has ``report_id, id, problems, repaired``."""
    bad = F.size("problems") > 0
    rows = checked.groupBy("report_id").agg(F.count("*").alias("records"), F.count_if(bad).alias("n"), _listed(bad, F.struct("id", "problems")).alias("failures"), _listed(F.col("repaired"), F.col("id")).alias("repaired"))
    rate = 1 - F.col("n") / F.greatest(F.lit(1), F.col("records"))
    return check(rows, "transform", "grounding_failures", F.when(rate >= PASS_LEAST, "ok").otherwise("warning"), F.col("n"), failures=F.col("failures"), repaired=F.col("repaired"), pass_rate=F.round(rate, 3))


def set_checks(records: DataFrame, expected: DataFrame) -> DataFrame:
    """transform_set_checks: the number of records is not that of candidates less merges (``report_id, candidates,
    merges``), or a canonical id stands twice in a report."""
    n = records.groupBy("report_id").agg(F.count("*").alias("records"))
    twice = records.groupBy("report_id", "canonical_risk_id").agg(F.count("*").alias("k")).where("k > 1 AND canonical_risk_id IS NOT NULL").groupBy("report_id").agg(F.array_sort(F.collect_list("canonical_risk_id")).alias("twice"))
    rows = expected.join(n, "report_id", "left").join(twice, "report_id", "left").withColumn("records", F.coalesce("records", F.lit(0)))
    wrong = F.col("records") != F.col("candidates") - F.col("merges")
    problems = wrong.cast("int") + F.coalesce(F.size("twice"), F.lit(0))
    return check(rows, "transform", "transform_set_checks", _bad(problems, "error"), problems, records=F.col("records"), duplicates=F.col("twice"))


def reproducibility(records: DataFrame, replayed: DataFrame, columns: list[str]) -> DataFrame:
    """pipeline_reproducibility: records that only one of the two runs has, whole rows compared in one fixed form."""
    form = lambda df, side: df.select("report_id", F.sha2(F.to_json(F.struct(*columns)), 256).alias("h")).withColumn("side", F.lit(side))
    counts = form(records, 1).unionByName(form(replayed, -1)).groupBy("report_id", "h").agg(F.sum("side").alias("s"))
    rows = counts.groupBy("report_id").agg(F.sum(F.abs("s")).alias("n"))
    return check(rows, "transform", "pipeline_reproducibility", _bad(F.col("n"), "error"), F.col("n"))


def eval_check(scores: DataFrame) -> DataFrame:
    """eval_scores: any failing evaluator is an error. ``scores`` has ``report_id, evaluator, score, passed``."""
    rows = scores.groupBy("report_id").agg(F.count_if(~F.col("passed")).alias("n"), _listed(~F.col("passed"), F.col("evaluator")).alias("failed"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("evaluator", "score")))).alias("scores"))
    return check(rows, "transform", "eval_scores", _bad(F.col("n"), "error"), F.col("n"), failed=F.col("failed"), scores=F.col("scores"))


def intent_check(scores: DataFrame) -> DataFrame:
    """intent_agreement: below 0.8 is a warning. ``scores`` has ``report_id, score, passed, questions``."""
    return check(scores, "api", "intent_agreement", F.when(F.col("passed"), "ok").otherwise("warning"), F.col("questions"), score=F.col("score"))


def rows_check(written: DataFrame, expected: DataFrame) -> DataFrame:
    """rows_written: the rows stored for a report are not those that were to be stored. Both have ``report_id`` and may
    lack reports of the other."""
    a = written.groupBy("report_id").agg(F.count("*").alias("written"))
    b = expected.groupBy("report_id").agg(F.count("*").alias("expected"))
    both = a.join(b, "report_id", "full_outer").select("report_id", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("written", "expected")))
    return check(both, "load", "rows_written", F.when(F.col("written") == F.col("expected"), "ok").otherwise("error"), F.col("written"), expected=F.col("expected"))


def questions_check(answers: dict[str, DataFrame]) -> DataFrame:
    """brief_queries: the rows that each named question gives a report (``report_id``); always ok."""
    rows = union([df.groupBy("report_id").agg(F.count("*").alias("n")).withColumn("question", F.lit(name)) for name, df in answers.items()])
    found = rows.groupBy("report_id").agg(F.sum("n").alias("n"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("question", "n")))).alias("rows"))
    return check(found, "load", "brief_queries", F.lit("ok"), F.col("n"), rows=F.col("rows"))
