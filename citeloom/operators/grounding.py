"""Checking records against the text they cite, and mending them from recorded repairs."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.functions import text as T
from citeloom.functions.text import bound, ngram_share, norm_text

# Fixed values of the checks.
SENTENCE_OVERLAP, MITIGATION_OVERLAP, SPAN_PREFIX, PASS_LEAST = 0.3, 0.5, 100, 0.8
FEW, MANY = 2, 3


@dataclass(frozen=True)
class Backend:
    """How a text is cut into what the checks compare: each part takes a text column and gives an array."""

    name: str
    sentences: Callable[[Column], Column]
    content_words: Callable[[Column], Column]
    context_words: Callable[[Column], Column]
    numbers: Callable[[Column], Column]
    names: Callable[[Column], Column]


def _stemmed(c: Column) -> Column:
    return F.array_distinct(F.transform(T.content_words(c), T.stem))


def _stems_and_forms(c: Column) -> Column:
    return bound(T.context_words(c), lambda w: F.array_union(w, F.transform(w, T.stem)))


#: ``plain`` compares words as they stand; ``stemmed`` compares stems, takes figures with units stuck to them, and takes a
#: run of capitalised words as one name, also at the start of a sentence. Both run inside the JVM.
BACKENDS = {
    "plain": Backend("plain", T.plain_sentences, T.content_words, T.context_words, T.numbers, T.names),
    "stemmed": Backend("stemmed", T.plain_sentences, _stemmed, _stems_and_forms, T.figures, T.name_runs),
}


def backend(name: str) -> Backend:
    if name not in BACKENDS:
        raise ValueError(f"no grounding backend {name!r}; there are {', '.join(BACKENDS)}")
    return BACKENDS[name]


def overlap(words: Column, context: Column) -> Column:
    """Share of a word set that the context has; 1 for an empty set."""
    return bound(words, lambda w: F.when(F.size(w) == 0, 1.0).otherwise(F.size(F.array_intersect(w, context)) / F.size(w)))


def problems(description: Column, span: Column, impact: Column, mitigation: Column, page: Column, cited: Column, cited_pages: Column, by: Backend) -> Column:
    """Problem names of one record.

    The head of the span is not on its page; the description has too few or too many sentences; a sentence shares too
    few content words with the record's own text (span, potential impact, cited spans); a number or a name, in normal
    form, stands neither there nor on the page; the mitigation shares too few with its page and the cited pages. Numbers
    and names are looked up as substrings, so 40 passes inside 2040.
    """
    plain = lambda c: F.coalesce(c, F.lit(""))
    own = F.array_join(F.filter(F.array(plain(span), plain(impact), plain(cited)), lambda x: x != ""), " ")
    base = F.struct(
        by.sentences(plain(description)).alias("sentences"), by.context_words(own).alias("context"), norm_text(own).alias("own"), norm_text(plain(page)).alias("page"),
        norm_text(plain(span)).alias("span"), plain(mitigation).alias("mitigation"), by.context_words(F.concat_ws(" ", plain(page), plain(cited_pages))).alias("pool"),
    )
    return bound(base, lambda t: _problems(t, by))


def _problems(t: Column, by: Backend) -> Column:
    off_page = F.when(~F.contains(t["page"], F.substring(t["span"], 1, SPAN_PREFIX)), "span_not_on_page")
    length = F.when(~F.size(t["sentences"]).between(FEW, MANY), F.concat(F.lit("sentence_count:"), F.size(t["sentences"]).cast("string")))

    def absent(items: Column, name: str) -> Column:
        known = F.transform(items, lambda n: F.struct(n.alias("n"), norm_text(n).alias("f")))
        lost = F.filter(known, lambda x: (x["f"] != "") & ~F.contains(t["own"], x["f"]) & ~F.contains(t["page"], x["f"]))
        return F.transform(lost, lambda x: F.concat(F.lit(name), x["n"]))

    per = F.transform(
        t["sentences"],
        lambda s, i: F.array_compact(
            F.concat(
                F.array(F.when(overlap(by.content_words(s), t["context"]) < SENTENCE_OVERLAP, F.concat(F.lit("sentence_"), (i + 1).cast("string"), F.lit("_ungrounded")))),
                absent(by.numbers(s), "number_not_in_text:"),
                absent(by.names(s), "name_not_in_text:"),
            )
        ),
    )
    weak = F.when((t["mitigation"] != "") & (overlap(by.content_words(t["mitigation"]), t["pool"]) < MITIGATION_OVERLAP), "mitigation_not_in_text")
    return F.array_compact(F.concat(F.array(off_page, length), F.flatten(per), F.array(weak)))


def page_texts(pages: DataFrame) -> DataFrame:
    """``report_id, page, page_text``: of repeated page rows the longest text stands for the page."""
    return pages.where("text IS NOT NULL").groupBy("report_id", "page").agg(F.max(F.struct(F.length("text"), "text"))["text"].alias("page_text"))


def _with_sources(records: DataFrame, pages: DataFrame, citations: DataFrame) -> DataFrame:
    """Records with the text of their page, of the spans they cite and of the pages they cite."""
    texts = page_texts(pages)
    spans = citations.where("span IS NOT NULL").select("risk_instance_id", "span").distinct().groupBy("risk_instance_id").agg(F.array_join(F.array_sort(F.collect_list("span")), " ").alias("cited"))
    at = citations.select(F.col("risk_instance_id").alias("id"), "page").distinct().join(records.select("id", "report_id").distinct(), "id").join(texts, ["report_id", "page"])
    elsewhere = at.groupBy("id").agg(F.array_join(F.array_sort(F.collect_list("page_text")), " ").alias("cited_pages"))
    return records.join(texts, ["report_id", "page"], "left").join(spans.withColumnRenamed("risk_instance_id", "id"), "id", "left").join(elsewhere, "id", "left")


def _checked(sources: DataFrame, by: Backend, **changed: Column) -> Column:
    of = lambda c: changed.get(c, F.col(c) if c in sources.columns else F.lit(None).cast("string"))
    return problems(of("description"), of("verbatim_span"), of("potential_impact"), of("mitigation"), F.col("page_text"), F.col("cited"), F.col("cited_pages"), by)


def grounded(records: DataFrame, pages: DataFrame, citations: DataFrame, by: str = "plain") -> DataFrame:
    """``id, report_id, problems``: records checked against their page, the spans and the pages they cite."""
    sources = _with_sources(records, pages, citations)
    return sources.select("id", "report_id", _checked(sources, backend(by)).alias("problems"))


def repaired(records: DataFrame, pages: DataFrame, citations: DataFrame, repairs: DataFrame, by: str = "plain") -> DataFrame:
    """Records after one try at mending those with problems.

    ``repairs`` holds one rewritten record per id (``id, title, description, mitigation``). It is taken only if nothing
    is left to flag, and its mitigation only where the record states one. Records that keep problems get a flag for each
    (``grounding:...``, also ``repair_not_recorded`` where there was no rewrite) and wait for review.
    """
    nlp = backend(by)
    fixed = repairs.select("id", F.struct("title", "description", "mitigation").alias("__fix"))
    sources = _with_sources(records, pages, citations).join(fixed, "id", "left")
    first = sources.withColumn("__before", _checked(sources, nlp))
    stated = F.coalesce("mitigation", F.lit("")) != ""
    new_mitigation = F.when(stated, F.col("__fix.mitigation")).otherwise(F.col("mitigation"))
    tried = (F.size("__before") > 0) & F.col("__fix").isNotNull()
    after = F.when(tried, _checked(sources, nlp, description=F.col("__fix.description"), mitigation=new_mitigation))
    both = first.withColumn("__after", after).withColumn("repaired", F.coalesce(F.size("__after") == 0, F.lit(False)))
    lost = F.when((F.size("__before") > 0) & F.col("__fix").isNull(), "repair_not_recorded")
    left = F.when(F.col("repaired"), F.array().cast("array<string>")).otherwise(F.array_compact(F.concat("__before", F.array(lost))))
    done = both.withColumn("problems", left)
    flags = F.concat(F.coalesce("quality_flags", F.array().cast("array<string>")), F.transform("problems", lambda p: F.concat(F.lit("grounding:"), p)))
    take = lambda c, v: F.when(F.col("repaired"), v).otherwise(F.col(c))
    new = {
        "title": take("title", F.col("__fix.title")), "description": take("description", F.col("__fix.description")), "mitigation": take("mitigation", new_mitigation),
        "quality_flags": flags, "review_state": F.when(F.size("problems") > 0, "pending_review").otherwise(F.col("review_state")),
    }
    return done.select(*(new[c].alias(c) if c in new else F.col(c) for c in records.columns), "problems", "repaired")


def pass_rate(checked: DataFrame, keys: list[str], least: float = PASS_LEAST) -> DataFrame:
    """Share of records of each key without problems, and ok or warning."""
    rate = F.avg(F.when(F.size("problems") == 0, 1.0).otherwise(0.0))
    return checked.groupBy(*keys).agg(F.count("*").alias("records"), F.count_if(F.size("problems") > 0).alias("failed"), F.round(rate, 6).alias("pass_rate")).withColumn(
        "outcome", F.when(F.col("pass_rate") < least, "warning").otherwise("ok")
    )


def span_fidelity(records: DataFrame, pages: DataFrame) -> DataFrame:
    """Share of each span's word trigrams that its page has."""
    return records.where("verbatim_span IS NOT NULL").join(page_texts(pages), ["report_id", "page"]).select("id", F.round(ngram_share(F.col("verbatim_span"), F.col("page_text")), 6).alias("fidelity"))


def page_coverage(page_words: DataFrame, block_words: DataFrame, keys: list[str], header: float | None = None) -> DataFrame:
    """Share of each page's word occurrences that the blocks of the page have too (a bag intersection). With ``header``,
    words whose ``top`` lies in the band of that height at the top of the page do not count."""
    kept = page_words if header is None else page_words.where(F.col("top") > header)
    a = kept.groupBy(*keys, "word").agg(F.count("*").alias("n_page"))
    b = block_words.groupBy(*keys, "word").agg(F.count("*").alias("n_block"))
    both = a.join(b, [*keys, "word"], "left")
    return both.groupBy(*keys).agg(
        F.sum("n_page").alias("page_words"), F.sum(F.least("n_page", F.coalesce("n_block", F.lit(0)))).alias("covered_words"),
        F.round(F.sum(F.least("n_page", F.coalesce("n_block", F.lit(0)))) / F.greatest(F.lit(1), F.sum("n_page")), 6).alias("coverage"),
    )
