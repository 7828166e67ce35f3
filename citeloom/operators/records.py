"""Candidates to records: agreement of two lists, descriptions by vote, merging across registers, numbering, enrichment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from citeloom.functions.similarity import block_ratio, can_reach
from citeloom.functions.text import canonical_key, norm_loose, norm_text, unhyphenate

# Fixed values of the matches.
AGREE_RATIO, AGREE_PREFIX, SPAN_PREFIX = 0.6, 60, 80
MERGE_RATIO, HINTS = 0.55, (("cyber",), ("corruption", "bribery"))
HEADING_LONGEST, PARAGRAPH_LONGEST, CITATION_LONGEST = 45, 700, 200


def span_on_page(page: Column, span: Column, prefix: int = SPAN_PREFIX) -> Column:
    """Whether the first characters of a span, in normal form, stand on the page."""
    return F.contains(norm_text(page), F.substring(norm_text(span), 1, prefix))


def on_their_page(candidates: DataFrame, pages: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates whose span stands on their page; the others are dropped."""
    text = pages.where("text IS NOT NULL").select(*keys, "text").distinct()
    hit = candidates.join(text, keys).where(span_on_page(F.col("text"), F.col("verbatim_span")))
    return hit.select(*candidates.columns).distinct()


def contained(a: Column, b: Column, prefix: int = AGREE_PREFIX) -> Column:
    """Whether the head of either span stands in the other."""
    x, y = norm_text(a), norm_text(b)
    return F.contains(y, F.substring(x, 1, prefix)) | F.contains(x, F.substring(y, 1, prefix))


def agreement(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """For each left candidate the first right candidate of its keys with a like title or a contained span.

    Both sides have ``seq, title, span``; the result has ``left_seq, right_seq`` (null where nothing agrees). The keys
    (report and page) bound the pairs; containment decides in the JVM, and only the rest that can reach the ratio
    goes to Python.
    """
    a = left.select(*keys, F.col("seq").alias("left_seq"), norm_text(F.col("title")).alias("ta"), F.col("span").alias("sa"))
    b = right.select(*keys, F.col("seq").alias("right_seq"), norm_text(F.col("title")).alias("tb"), F.col("span").alias("sb"))
    pairs = a.join(b, keys).withColumn("inside", F.coalesce(contained(F.col("sa"), F.col("sb")), F.lit(False)))
    sure = pairs.where("inside").select(*keys, "left_seq", "right_seq")
    like = pairs.where(~F.col("inside") & can_reach(F.col("ta"), F.col("tb"), AGREE_RATIO)).where(block_ratio("ta", "tb") >= AGREE_RATIO).select(*keys, "left_seq", "right_seq")
    first = sure.unionByName(like).groupBy(*keys, "left_seq").agg(F.min("right_seq").alias("right_seq"))
    return a.select(*keys, "left_seq").join(first, [*keys, "left_seq"], "left")


def hinted(a: Column, b: Column) -> Column:
    """Whether both titles hold all words of one hint set."""
    words = [F.split(norm_text(c), " ") for c in (a, b)]
    out = F.lit(False)
    for hint in HINTS:
        whole = F.lit(True)
        for w in words:
            for h in hint:
                whole = whole & F.array_contains(w, h)
        out = out | whole
    return out


def same_risk_pairs(first: DataFrame, second: DataFrame, keys: list[str]) -> DataFrame:
    """Each record of the second register with the first record (by rank) of the first register that is the same risk:
    like titles or shared hint words. The registers are apart, so one absorbs at most once and the earliest wins."""
    a = first.select(*keys, F.col("id").alias("anchor_id"), F.col("rank").alias("anchor_rank"), F.col("title").alias("ta"))
    b = second.select(*keys, F.col("id").alias("merged_id"), F.col("title").alias("tb"))
    x, y = norm_loose(F.col("ta")), norm_loose(F.col("tb"))
    pairs = a.join(b, keys).select(*keys, "anchor_id", "anchor_rank", "merged_id", x.alias("x"), y.alias("y"), hinted(F.col("ta"), F.col("tb")).alias("hint"))
    sure = pairs.where("hint").select(*keys, "anchor_id", "anchor_rank", "merged_id")
    like = pairs.where(~F.col("hint") & can_reach(F.col("x"), F.col("y"), MERGE_RATIO)).where(block_ratio("x", "y") >= MERGE_RATIO).select(*keys, "anchor_id", "anchor_rank", "merged_id")
    return sure.unionByName(like).groupBy(*keys, "merged_id").agg(F.min_by("anchor_id", F.struct("anchor_rank", "anchor_id")).alias("anchor_id"))


def numbered(records: DataFrame, key: str) -> DataFrame:
    """Records with ``record_no`` r01, r02, ... in the order of prominence, page and id (ids as strings)."""
    order = Window.partitionBy(key).orderBy("prominence", "page", "id")
    return records.withColumn("record_no", F.concat(F.lit("r"), F.lpad(F.row_number().over(order).cast("string"), 2, "0")))


def merged_citations(pairs: DataFrame, citations: DataFrame) -> DataFrame:
    """Citations of the kept records: their own and those of the records merged into them, each once."""
    own = citations.join(pairs.select(F.col("merged_id").alias("risk_instance_id"), "anchor_id"), "risk_instance_id", "left")
    return own.withColumn("risk_instance_id", F.coalesce("anchor_id", "risk_instance_id")).drop("anchor_id").distinct()


def merged_records(candidates: DataFrame, pairs: DataFrame, report: str) -> DataFrame:
    """The records that are left of described candidates after merging, numbered by prominence, page and name.

    A record keeps the facts of its candidate; its citations are its own and those of the candidates merged into it, in
    their order; its canonical id comes from the first of them (the topic register's twin keeps its id when a risk rises
    into the main register), else from itself. A poor fit is flagged with its reason. ``candidates`` has ``report, id,
    company_id, title, verbatim_title, source_taxonomy, source_register, section, page, prominence, verbatim_span,
    poor_fit, poor_fit_reason`` and any other columns; ``pairs`` as from ``same_risk_pairs``.
    """
    rank = F.struct("prominence", "page", "id")
    own = canonical_key(F.col("company_id"), F.col("source_taxonomy"), F.col("verbatim_title"))
    cite = F.struct("section", "page", "source_register", F.col("verbatim_span").alias("span"))
    joined = pairs.select(report, F.col("merged_id").alias("id"), "anchor_id").join(candidates, [report, "id"])
    absorbed = joined.groupBy(report, F.col("anchor_id").alias("id")).agg(F.array_sort(F.collect_list(F.struct(rank.alias("rank"), cite.alias("cite"), own.alias("key")))).alias("__m"))
    kept = candidates.join(pairs.select(report, F.col("merged_id").alias("id")), [report, "id"], "left_anti").join(absorbed, [report, "id"], "left")
    others = F.coalesce(F.transform("__m", lambda m: m["cite"]), F.array().cast("array<struct<section:string,page:int,source_register:string,span:string>>"))
    flags = F.when(F.coalesce("poor_fit", F.lit(False)), F.array(F.concat(F.lit("poor_fit:"), F.coalesce("poor_fit_reason", F.lit(""))))).otherwise(F.array().cast("array<string>"))
    rows = kept.select("*", F.coalesce(F.col("__m")[0]["key"], own).alias("canonical_risk_id"), F.concat(F.array(cite), others).alias("citations"), flags.alias("quality_flags")).drop("__m")
    return numbered(rows, report)


def paragraph_after(text: Column, heading: str) -> Column:
    """The paragraph below a heading line: lines until a short one without end mark that follows a finished sentence,
    joined across line ends and hyphens, cut at the last sentence end within ``PARAGRAPH_LONGEST``; null without it."""
    below = F.regexp_extract(text, rf"(?ms)^[ \t]*{heading}[ \t]*$\n(.*)", 1)
    lines = F.filter(F.transform(F.split(below, "\n"), lambda s: F.trim(s)), lambda x: x != "")
    start = F.struct(F.lit("").alias("kept"), F.lit(False).alias("over"))

    def step(s: Column, line: Column) -> Column:
        head = (F.length(line) < HEADING_LONGEST) & ~line.rlike(r"[.,;:!?]$") & F.endswith(s["kept"], F.lit("."))
        over = s["over"] | head | (F.length(s["kept"]) > PARAGRAPH_LONGEST)
        grown = F.when(s["kept"] == "", line).otherwise(F.concat(s["kept"], F.lit("\n"), line))
        return F.struct(F.when(over, s["kept"]).otherwise(grown).alias("kept"), over.alias("over"))

    whole = F.regexp_replace(unhyphenate(F.aggregate(lines, start, step)["kept"]), "\n", " ")
    head = F.regexp_extract(F.substring(whole, 1, PARAGRAPH_LONGEST), r"(?s)^(.*\.) ", 1)
    cut = F.when(F.length(whole) > PARAGRAPH_LONGEST, F.when(head != "", head).otherwise(F.substring(whole, 1, PARAGRAPH_LONGEST))).otherwise(whole)
    return F.nullif(cut, F.lit(""))


def enriched(records: DataFrame, pages: DataFrame, heading: str = "Actions and resources", phrase: str = "type of impact", register: str = "esrs_financial_risk") -> DataFrame:
    """The mitigation that the topical pages of a report give records of ``register`` without one: ``id, mitigation,
    mitigation_page, citation, quality_flags``.

    A record's page is the first one (in page order) that holds its printed title, else its title, in normal form and also
    ``phrase``; the paragraph below ``heading`` on that page, else on the next one, is its mitigation, cited with at most
    ``CITATION_LONGEST`` characters and flagged. ``pages`` has ``report_id, page, text, section``.
    """
    of = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    bare = records.where((F.coalesce("mitigation", F.lit("")) == "") & (F.col("source_register") == register))
    titles = bare.select("id", "report_id", norm_text(F.coalesce(of("verbatim_title"), F.lit(""))).alias("t1"), norm_text(F.coalesce(F.col("title"), F.lit(""))).alias("t2"))
    topical = pages.where("text IS NOT NULL").groupBy("report_id", "page").agg(F.max(F.struct("text", "section")).alias("p")).select("report_id", "page", "p.text", "p.section")
    shown = topical.select("report_id", "page", norm_text(F.col("text")).alias("shown")).where(F.contains("shown", F.lit(phrase)))
    has = lambda t: (F.col(t) != "") & F.contains("shown", F.col(t))
    found = titles.join(shown, "report_id").where(has("t1") | has("t2")).groupBy("id", "report_id").agg(F.min("page").alias("page"))
    para = topical.select("report_id", "page", "section", paragraph_after(F.col("text"), heading).alias("paragraph")).where("paragraph IS NOT NULL")
    here = found.join(para.withColumnsRenamed({"paragraph": "p0", "section": "s0"}), ["report_id", "page"], "left")
    after = para.select("report_id", (F.col("page") - 1).alias("page"), F.col("paragraph").alias("p1"), F.col("section").alias("s1"))
    both = here.join(after, ["report_id", "page"], "left").where("p0 IS NOT NULL OR p1 IS NOT NULL")
    first = F.col("p0").isNotNull()
    rows = both.select("id", F.coalesce("p0", "p1").alias("mitigation"), F.when(first, F.col("page")).otherwise(F.col("page") + 1).alias("mitigation_page"), F.when(first, F.col("s0")).otherwise(F.col("s1")).alias("section"))
    cite = F.struct("section", F.col("mitigation_page").alias("page"), F.lit(register).alias("source_register"), F.substring("mitigation", 1, CITATION_LONGEST).alias("span"))
    old = bare.select("id", F.coalesce(F.col("quality_flags"), F.array().cast("array<string>")).alias("old") if "quality_flags" in records.columns else F.array().cast("array<string>").alias("old"))
    flag = F.concat(F.lit("mitigation_from_topical_section:p"), F.col("mitigation_page").cast("string"))
    return rows.join(old, "id").select("id", "mitigation", "mitigation_page", cite.alias("citation"), F.concat("old", F.array(flag)).alias("quality_flags"))


def voted(samples: DataFrame, key: str, first_value: str, seq: str) -> DataFrame:
    """The vote over repeated samples of a key: the winning value (first seen on ties), its share of the votes, and
    whether it differs from the sample with the least ``seq``."""
    counts = samples.where(F.col(first_value).isNotNull()).groupBy(key, first_value).agg(F.count("*").alias("n"), F.min(seq).alias("seen"))
    return counts.groupBy(key).agg(
        F.max_by(first_value, F.struct("n", -F.col("seen"))).alias("winner"), F.round(F.max("n") / F.sum("n"), 6).alias("share"),
        (F.max_by(first_value, F.struct("n", -F.col("seen"))) != F.min_by(first_value, "seen")).alias("changed"),
    )


LOW_CONFIDENCE, VOTES = 0.6, 3


def described(samples: DataFrame, key: str, votes: int = VOTES, low: float = LOW_CONFIDENCE) -> DataFrame:
    """One description per key from its samples (``sample, category, confidence`` and any other columns).

    Sample 0 stands. Where it is less sure than ``low``, the first ``votes`` samples vote on the category (the one seen
    first wins a tie); a winner other than its own replaces it, with its share of the votes as confidence. ``votes`` maps
    each category to the votes it got.
    """
    rest = [c for c in samples.columns if c not in (key, "category", "confidence")]
    first = samples.where("sample = 0").groupBy(key).agg(F.min_by(F.struct(*rest, "category", "confidence"), F.struct("sample", *(F.col(c).cast("string") for c in rest[:1]))).alias("__r"))
    cast = samples.where((F.col("sample") < votes) & F.col("category").isNotNull()).groupBy(key, "category").agg(F.count("*").alias("n"), F.min("sample").alias("seen"))
    tally = cast.groupBy(key).agg(
        F.max_by(F.struct("category", "n"), F.struct("n", -F.col("seen"))).alias("__w"), F.map_from_entries(F.array_sort(F.collect_list(F.struct("category", "n")))).alias("__v")
    )
    both = first.join(tally, key, "left")
    unsure = F.coalesce(F.col("__r.confidence") < low, F.lit(False))
    changed = unsure & F.coalesce(F.col("__w.category") != F.col("__r.category"), F.lit(False))
    own = F.when(F.col("__r.category").isNotNull(), F.create_map(F.col("__r.category"), F.lit(1).cast("long")))
    return both.select(
        key, *(F.col(f"__r.{c}").alias(c) for c in rest), F.when(changed, F.col("__w.category")).otherwise(F.col("__r.category")).alias("category"),
        F.when(changed, F.round(F.col("__w.n") / F.lit(votes), 6)).otherwise(F.col("__r.confidence")).alias("confidence"), F.when(unsure, F.col("__v")).otherwise(own).alias("votes"), changed.alias("changed"),
    )


def prompt_text(c: dict[str, Column], priors: dict[str, list[str]] | None = None) -> Column:
    """The text sent with a candidate: where it stands, its title and what is printed of it, each part on its own line; a
    part without value is left out. ``c`` names the columns; ``priors`` gives the likely categories of a taxonomy code."""
    line = lambda label, v: F.when(F.coalesce(v, F.lit("")) != "", F.concat(F.lit(f"{label}: "), v))
    likely = F.lit(None).cast("string")
    if priors:
        table = F.create_map(*(x for k, v in priors.items() for x in (F.lit(k), F.lit(", ".join(v)))))
        likely = F.element_at(table, c["source_taxonomy"])
    return F.concat_ws(
        "\n", line("Register", F.concat(F.coalesce(c["source_register"], F.lit("none")), F.lit(", prominence "), c["prominence"].cast("string"))), line("Section", c["section"]), line("Page", c["page"].cast("string")),
        line("Title", c["title"]), line("Topic", c["source_taxonomy"]), line("Likely categories", F.when(F.coalesce(c["source_taxonomy"], F.lit("")) != "", likely)),
        line("Printed", c["verbatim_span"]), line("Impact", c["potential_impact"]), F.coalesce(line("Mitigation", c["mitigation"]), F.lit("No mitigation is printed.")),
    )


def register_candidates(blocks: DataFrame) -> DataFrame:
    """Risk blocks of a register as candidates: prominence 1 for the main register and 2 for the other, the text of the
    description field where the block has one, else its whole text, and the named fields that are not empty."""
    fields = F.map_filter("fields", lambda k, v: F.coalesce(v, F.lit("")) != "")
    body = F.coalesce(F.nullif(F.element_at(fields, "description"), F.lit("")), F.col("text"))
    return blocks.where("marker = 'risk' AND source_register IS NOT NULL").select(
        F.col("block_id").alias("candidate_id"), "source_register", "section", "page", F.col("heading").alias("title"), body.alias("verbatim_span"),
        F.element_at(fields, "potential_impact").alias("potential_impact"), F.when(F.col("source_register") == "erm_main_risk", 1).otherwise(2).alias("prominence"),
    )


def resolved_markers(blocks: DataFrame) -> DataFrame:
    """The marker of a block from its icon and its text: the icon wins; the text counts where there is none; both are
    named as the source where they agree, and a disagreement or a missing icon is flagged."""
    icon, text = F.col("icon_marker"), F.col("text_marker")
    agree = icon == text
    flags = F.array_compact(
        F.array(
            F.when(icon.isNotNull() & text.isNotNull() & ~agree, "marker_disagreement"),
            F.when(icon.isNull() & (F.coalesce(text, F.lit("")) != "immaterial"), "marker_without_icon"),
        )
    )
    return blocks.select(
        "*", F.coalesce(icon, text, F.lit("none")).alias("marker"), F.when(icon.isNull(), "text").when(agree, "icon+text").otherwise("icon").alias("marker_source"), flags.alias("quality_flags")
    )
