"""Scoring extracted records against a golden set."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.similarity import block_ratio, can_reach, letter_counts
from citeloom.functions.text import context_words, figures, norm_text, plain_sentences, problem_kind, stands_alone

# Fixed values of the golden match.
MATCH_FLOOR, PAGE_BONUS, SPAN_HITS, SPAN_WEIGHT = 0.6, 0.85, 0.66, 0.6
FEW, MANY = 2, 3


def assign(scores: DataFrame, key: str) -> DataFrame:
    """Greedy one-to-one assignment within each key: golden rows in order take the best record that is not taken yet
    (the first of equals), if its score is at least ``MATCH_FLOOR``.

    ``scores`` has ``golden_no, record_no, score``. A fold has no join form; a key (one report) is a bounded group.
    """

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        taken, rows = set(), []
        k = pdf[key].iloc[0]
        for golden, group in pdf.sort_values(["golden_no", "record_no"]).groupby("golden_no", sort=True):
            best = None
            for r, s in zip(group["record_no"], group["score"]):
                if r not in taken and s >= MATCH_FLOOR and (best is None or s > best[1]):
                    best = (r, s)
            if best:
                taken.add(best[0])
                rows.append((k, golden, best[0], best[1]))
        return pd.DataFrame(rows, columns=[key, "golden_no", "record_no", "score"])

    kinds = dict(scores.dtypes)
    return scores.groupBy(key).applyInPandas(fold, f"{key} {kinds[key]}, golden_no {kinds['golden_no']}, record_no {kinds['record_no']}, score double")


def match_score(title: Column, span_hits: Column, page_equal: Column) -> Column:
    """Title similarity, or a mix with the share of key phrases found; enough phrases on the right page score at least
    ``PAGE_BONUS``."""
    mixed = F.greatest(title, F.lit(SPAN_WEIGHT) * span_hits + F.lit(1 - SPAN_WEIGHT) * title)
    return F.when(page_equal & (span_hits >= SPAN_HITS), F.greatest(mixed, F.lit(PAGE_BONUS))).otherwise(mixed)


def golden_scores(golden: DataFrame, records: DataFrame, key: str) -> DataFrame:
    """``key, golden_no, record_no, score`` of the pairs of golden rows and records that can be assigned.

    A score mixes the best ratio of the record's title with the golden title and its aliases, the share of key phrases in
    the record's span, and the page (``match_score``). Only pairs that share a phrase, or whose titles can reach the floor,
    are scored. ``golden`` has ``golden_no, names, key_phrases, page``, ``records`` ``record_no, title, verbatim_span, page``.
    """
    names = golden.select(key, "golden_no", F.col("page").alias("g_page"), "key_phrases", F.explode("names").alias("name"))
    left = names.withColumn("a", norm_text(F.col("name"))).withColumn("a_n", letter_counts(F.col("a"))).drop("name")
    span = norm_text(F.coalesce("verbatim_span", F.lit("")))
    right = records.select(key, "record_no", F.col("page").alias("r_page"), norm_text(F.col("title")).alias("b"), span.alias("span")).withColumn("b_n", letter_counts(F.col("b")))
    phrases = F.coalesce("key_phrases", F.array().cast("array<string>"))
    hits = F.size(F.filter(phrases, lambda k: F.contains(F.col("span"), norm_text(k)))) / F.greatest(F.lit(1), F.size(phrases))
    pairs = left.join(right, key).withColumn("hits", hits)
    common = F.aggregate(F.zip_with("a_n", "b_n", lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)
    near = can_reach(F.col("a"), F.col("b"), MATCH_FLOOR) & (2.0 * common >= MATCH_FLOOR * (F.char_length("a") + F.char_length("b")))
    scored = pairs.where((F.col("hits") > 0) | near).withColumn("t", F.coalesce(block_ratio("a", "b"), F.lit(0.0)))
    best = scored.groupBy(key, "golden_no", "record_no").agg(F.max("t").alias("t"), F.first("hits").alias("hits"), F.first(F.coalesce(F.col("g_page") == F.col("r_page"), F.lit(False))).alias("same_page"))
    return best.select(key, "golden_no", "record_no", match_score(F.col("t"), F.col("hits"), F.col("same_page")).alias("score")).where(F.col("score") >= MATCH_FLOOR)


def identification(golden: DataFrame, found: DataFrame, keys: list[str], group: list[str]) -> DataFrame:
    """Precision, recall and F1 of found keys against golden keys, per group."""
    a = golden.select(*group, *keys).distinct().withColumn("in_golden", F.lit(1))
    b = found.select(*group, *keys).distinct().withColumn("in_found", F.lit(1))
    both = a.join(b, [*group, *keys], "full_outer")
    hit = F.sum(F.when(F.col("in_golden").isNotNull() & F.col("in_found").isNotNull(), 1).otherwise(0))
    counts = both.groupBy(*group).agg(hit.alias("matched"), F.sum(F.coalesce("in_golden", F.lit(0))).alias("golden"), F.sum(F.coalesce("in_found", F.lit(0))).alias("found"))
    p, r = F.col("matched") / F.greatest(F.col("found"), F.lit(1)), F.col("matched") / F.greatest(F.col("golden"), F.lit(1))
    f1 = F.when(F.col("matched") == 0, 0.0).otherwise(2 * p * r / (p + r))
    return counts.select(*group, "matched", "golden", "found", F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(f1, 6).alias("f1"))


def provenance(record: Column, golden: Column) -> Column:
    """The golden page is none of the record's or its citations' pages, its section is not theirs, or a second page that
    the golden row names is not cited. ``record`` has ``page, section, pages, sections``."""
    pages = F.array_union(F.coalesce(record["pages"], F.array().cast("array<int>")), F.array(record["page"]))
    sections = F.array_union(F.coalesce(record["sections"], F.array().cast("array<string>")), F.array(record["section"]))
    text = lambda c: F.coalesce(c.cast("string"), F.lit("none"))
    return F.array_compact(
        F.array(
            F.when(~F.array_contains(pages, golden["page"]), F.concat(F.lit("page:"), text(record["page"]), F.lit("!="), text(golden["page"]))),
            F.when(~F.array_contains(sections, golden["section"]), F.concat(F.lit("section:"), text(record["section"]), F.lit("!="), text(golden["section"]))),
            F.when(golden["also_on_page"].isNotNull() & ~F.array_contains(pages, golden["also_on_page"]), F.concat(F.lit("missing_citation_page:"), text(golden["also_on_page"]))),
        )
    )


def own_grounding(record: Column, golden: Column) -> Column:
    """Key phrases of the golden row that the record's own words (description and mitigation) lack, and figures of its
    description that stand in no text of its pages. ``record`` has ``page_text``, the text of all pages it cites."""
    own = norm_text(F.concat_ws(" ", record["description"], record["mitigation"]))
    lost = F.filter(F.coalesce(golden["key_phrases"], F.array().cast("array<string>")), lambda k: ~F.contains(own, norm_text(k)))
    cited = norm_text(F.coalesce(record["page_text"], F.lit("")))
    invented = F.filter(figures(F.coalesce(record["description"], F.lit(""))), lambda n: ~stands_alone(cited, norm_text(n)))
    return F.concat(
        F.transform(lost, lambda k: F.concat(F.lit("phrase_missing:"), k)),
        F.when(record["page_text"].isNull(), F.array().cast("array<string>")).otherwise(F.transform(invented, lambda n: F.concat(F.lit("invented_number:"), n))),
    )


def category(record: Column, golden: Column) -> Column:
    """The record's category is none that the golden row accepts."""
    accepted = F.coalesce(golden["acceptable_categories"], F.array(golden["category"]))
    wrong = ~F.coalesce(F.array_contains(accepted, record["category"]), F.lit(False))
    text = lambda c: F.coalesce(c, F.lit("none"))
    return F.array_compact(F.array(F.when(wrong, F.concat(F.lit("category:"), text(record["category"]), F.lit("!="), text(golden["category"])))))


def fields(record: Column, golden: Column) -> Column:
    """Too few or too many sentences, a mitigation where none is stated or the other way round, or one without any of
    the phrases the golden row expects."""
    n = F.size(plain_sentences(F.trim(F.coalesce(record["description"], F.lit("")))))
    has = F.coalesce(record["mitigation"], F.lit("")) != ""
    form = norm_text(F.coalesce(record["mitigation"], F.lit("")))
    phrases = F.coalesce(golden["mitigation_phrases"], F.array().cast("array<string>"))
    return F.array_compact(
        F.array(
            F.when(~n.between(FEW, MANY), F.concat(F.lit("sentences:"), n.cast("string"))),
            F.when(has != golden["mitigation_stated"], F.concat(F.lit("mitigation_present:"), has.cast("string"), F.lit("!="), golden["mitigation_stated"].cast("string"))),
            F.when(has & (F.size(phrases) > 0) & ~F.exists(phrases, lambda p: F.contains(form, norm_text(p))), "mitigation_phrases_missing"),
        )
    )


#: The evaluators that look at a golden row and its record, with the least score that passes.
PER_MATCH = {"provenance": (provenance, 0.9), "grounding": (own_grounding, 0.8), "category": (category, 0.8), "fields": (fields, 0.8)}
IDENTIFICATION_LEAST, INTENT_LEAST = 0.9, 0.8


def match_problems(matched: DataFrame, key: str) -> DataFrame:
    """``key, golden_id, evaluator, problems`` of every golden row with a record. ``matched`` has ``golden_id`` and the
    structs ``golden`` and ``record``."""
    each = F.array(*(F.struct(F.lit(name).alias("evaluator"), check(F.col("record"), F.col("golden")).alias("problems")) for name, (check, _) in PER_MATCH.items()))
    return matched.select(key, "golden_id", F.explode(each).alias("e")).select(key, "golden_id", "e.evaluator", "e.problems")


def evaluated(problems: DataFrame, key: str) -> DataFrame:
    """Score of each evaluator (share of matched rows without problems), whether it passes, and its failures."""
    least = F.element_at(F.create_map(*(x for name, (_, v) in PER_MATCH.items() for x in (F.lit(name), F.lit(v)))), F.col("evaluator"))
    failures = F.array_sort(F.collect_list(F.when(F.size("problems") > 0, F.struct("golden_id", "problems"))))
    score = F.avg((F.size("problems") == 0).cast("double"))
    return problems.groupBy(key, "evaluator").agg(F.count("*").alias("matched"), F.round(score, 3).alias("score"), score.alias("__s"), failures.alias("failures")).select(
        key, "evaluator", "matched", "score", (F.col("__s") >= least).alias("passed"), "failures"
    )


def identification_passes(scores: DataFrame, golden: DataFrame, found: DataFrame, keys: list[str], group: str) -> DataFrame:
    """``identification`` of one group column with the verdict and the missing and extra keys."""
    a, b = golden.select(group, *keys).distinct().withColumn("__g", F.lit(True)), found.select(group, *keys).distinct().withColumn("__f", F.lit(True))
    name = F.concat_ws("|", *keys)
    odd = a.join(b, [group, *keys], "full_outer").select(group, F.when(F.col("__f").isNull(), F.concat(F.lit("missing:"), name)).when(F.col("__g").isNull(), F.concat(F.lit("extra:"), name)).alias("failure"))
    failures = odd.groupBy(group).agg(F.array_sort(F.collect_list("failure")).alias("failures"))
    return scores.join(failures, group).withColumn("passed", (F.col("precision") >= IDENTIFICATION_LEAST) & (F.col("recall") >= IDENTIFICATION_LEAST))


def intent_problems(got: Column, expected: Column) -> Column:
    """Fields of a parsed intent that differ from the expected one: lists as sets, years sorted, names in lower case, sector
    and free text in normal form, empty and null alike."""
    bag = lambda c: F.array_sort(F.coalesce(c, F.array()))
    plain = lambda c: norm_text(F.coalesce(c, F.lit("")))
    words = lambda c: F.array_sort(context_words(plain(c)))
    lower = lambda c: F.array_sort(F.array_distinct(F.transform(F.coalesce(c, F.array().cast("array<string>")), F.lower)))
    same = {
        "categories": same_set(got["categories"], expected["categories"]),
        "source_register": F.nullif(got["source_register"], F.lit("")).eqNullSafe(F.nullif(expected["source_register"], F.lit(""))),
        "status": F.nullif(got["status"], F.lit("")).eqNullSafe(F.nullif(expected["status"], F.lit(""))),
        "sector": plain(got["sector"]) == plain(expected["sector"]),
        "years": bag(got["years"]) == bag(expected["years"]),
        "free_text": words(got["free_text"]) == words(expected["free_text"]),
        "companies": lower(got["companies"]) == lower(expected["companies"]),
    }
    return F.array_compact(F.array(*(F.when(~equal, name) for name, equal in same.items())))


def intent_scores(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Agreement of parsed intents with expected ones. ``pairs`` has ``keys``, ``id`` and the structs ``got`` and ``expected``."""
    checked = pairs.select(*keys, "id", intent_problems(F.col("got"), F.col("expected")).alias("problems"))
    score = F.avg((F.size("problems") == 0).cast("double"))
    return checked.groupBy(*keys).agg(
        F.count("*").alias("questions"), F.round(score, 3).alias("score"), (score >= INTENT_LEAST).alias("passed"),
        F.array_sort(F.collect_list(F.when(F.size("problems") > 0, F.struct("id", "problems")))).alias("failures"),
    )


def check_scores(results: DataFrame, group: list[str]) -> DataFrame:
    """Score of each check (share passed, 0 without any) and the ids that failed. ``results`` has ``check, id, ok``."""
    return results.groupBy(*group, "check").agg(
        F.count("*").alias("n"), F.round(F.avg(F.col("ok").cast("double")), 6).alias("score"), F.count_if(~F.col("ok")).alias("failed")
    )


def same_set(a: Column, b: Column) -> Column:
    """Equality of two arrays as sets; two nulls are equal, null and empty too."""
    order = lambda c: F.array_sort(F.array_distinct(F.coalesce(c, F.array())))
    return order(a).eqNullSafe(order(b))


def top_values(rows: DataFrame, label: str, value: str, n: int) -> DataFrame:
    """The ``n`` most frequent values of each label (ties by value), with their counts."""
    counts = rows.where(F.col(value).isNotNull()).groupBy(label, value).agg(F.count("*").alias("n"))
    order = Window.partitionBy(label).orderBy(F.desc("n"), value)
    return counts.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def label_sizes(rows: DataFrame, label: str, value: str) -> DataFrame:
    """Labels by the number of their different values, the largest first."""
    return rows.where(F.col(value).isNotNull()).groupBy(label).agg(F.count_distinct(value).alias("values"), F.count("*").alias("n")).orderBy(F.desc("values"), label)


def backends_compared(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Verdicts of two grounding backends on the same records: agreeing, both flagged, flagged by one only, and by one for a
    kind of problem that the other does not name."""
    of = lambda df, v, k: df.select(key, (F.size("problems") > 0).alias(v), F.array_distinct(F.transform("problems", problem_kind)).alias(k))
    x, y = of(a, "x", "kx"), of(b, "y", "ky")
    return x.join(y, key).agg(
        F.count("*").alias("records"), F.count_if(F.col("x") == F.col("y")).alias("agree"), F.count_if(F.col("x") & F.col("y")).alias("both_flagged"),
        F.count_if(F.col("x") & ~F.col("y")).alias("first_only"), F.count_if(~F.col("x") & F.col("y")).alias("second_only"),
        F.sum(F.size(F.array_except("kx", "ky"))).alias("first_kinds"), F.sum(F.size(F.array_except("ky", "kx"))).alias("second_kinds"),
    )


def seeded_faults(records: DataFrame, faults: list[tuple[str, str]]) -> DataFrame:
    """Records once per fault, with the fault's text appended to the description and its name in ``fault``."""
    kinds = F.explode(F.array(*[F.struct(F.lit(n).alias("fault"), F.lit(t).alias("__t")) for n, t in faults])).alias("__f")
    return records.select("*", kinds).withColumn("description", F.concat_ws(" ", "description", "__f.__t")).withColumn("fault", F.col("__f.fault")).drop("__f")
