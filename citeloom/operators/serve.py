"""Read side: optional filters, named questions, sector resolution, record assembly."""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions.similarity import block_ratio
from citeloom.functions.text import matches_any, norm_text
from citeloom.operators.warehouse import SCHEMA_VERSION, categories, check_meta, risk_status

CATEGORIES = ("financial", "operational", "regulatory", "market", "climate", "cyber", "supply_chain")
REGISTERS = ("erm_main_risk", "esrs_financial_risk")
STATUSES = ("new", "elevated", "continuing", "removed")
#: Matched sectors that an answer names (the filter itself counts all).
MOST_NAMED = 1000
# Fixed values of the sector cascade.
STEM_LEAST, SECTOR_RATIO = 5, 0.8


@dataclass(frozen=True)
class Intent:
    """What a caller wants to see; empty parts do not filter."""

    categories: list[str] = field(default_factory=list)
    companies: list[str] = field(default_factory=list)
    years: list[int] = field(default_factory=list)
    source_register: str | None = None
    status: str | None = None
    sector: str | None = None
    free_text: str = ""


@dataclass(frozen=True)
class Tables:
    company: DataFrame
    report: DataFrame
    canonical: DataFrame
    instance: DataFrame
    citation: DataFrame

    @staticmethod
    def read(spark: SparkSession, folder: str) -> "Tables":
        names = ("company", "report", "canonical_risk", "risk_instance", "risk_citation")
        return Tables(*(spark.read.parquet(f"{folder}/{n}.parquet") for n in names))


def checked(intent: Intent, limit: int, clamp: bool = False) -> int:
    """Reject values that no row can have; the limit must be 1 to 1000, or is moved there."""
    for value, allowed in ((intent.source_register, REGISTERS), (intent.status, STATUSES), *((c, CATEGORIES) for c in intent.categories)):
        if value is not None and value not in allowed:
            raise ValueError(f"{value!r} is none of {', '.join(allowed)}")
    if clamp:
        return min(max(limit, 1), 1000)
    if not 1 <= limit <= 1000:
        raise ValueError("limit must be 1 to 1000")
    return limit


def star(t: Tables) -> DataFrame:
    """Instances with the facts of their report and company. The two dimension tables are far smaller than the facts;
    whether a side is broadcast is left to its measured size."""
    report = t.report.select(F.col("id").alias("report_id"), "company_id", "fiscal_year", "review_bodies", "review_frequency")
    company = t.company.select(F.col("id").alias("company_id"), F.col("name").alias("company"), "sector", "country")
    return t.instance.join(report, "report_id").join(company, "company_id")


def like(text: Column, part: str) -> Column:
    """Case-blind containment; signs of the LIKE language in ``part`` are plain characters here."""
    return F.contains(F.lower(text), F.lit(part.lower()))


def sector_matches(stored: DataFrame, wanted: str) -> DataFrame:
    """Stored sectors that a wanted one stands for, from the first tier that has any: the same words; every wanted word
    the same or with a common stem; a close spelling."""
    split = lambda c: F.filter(F.split(norm_text(c), " "), lambda w: w != "")
    rows = stored.select("sector").where("sector IS NOT NULL").distinct().select("sector", split(F.col("sector")).alias("have"), split(F.lit(wanted)).alias("want"))
    stem = lambda a, b: (F.length(a) >= STEM_LEAST) & (F.length(b) >= STEM_LEAST) & (F.startswith(a, b) | F.startswith(b, a))
    loose = (F.size("want") > 0) & F.forall("want", lambda w: F.exists("have", lambda h: (h == w) | stem(h, w)))
    close = block_ratio(F.array_join("want", " "), F.array_join("have", " ")) >= SECTOR_RATIO
    tiers = rows.select("sector", F.when(F.array_sort("have") == F.array_sort("want"), 1).when(loose, 2).when(close, 3).alias("tier")).where("tier IS NOT NULL")
    best = tiers.agg(F.min("tier").alias("tier"))
    return tiers.join(F.broadcast(best), "tier").select("sector", "tier")  # the broadcast side is one row


def records(t: Tables, intent: Intent, limit: int | None = 100) -> DataFrame:
    """Instances that meet every part of the intent, latest year first, then prominence, page and id."""
    df = star(t)
    if intent.categories:
        df = df.join(categories(t.instance).where(F.col("category").isin(intent.categories)).select(F.col("risk_instance_id").alias("id")).distinct(), "id", "left_semi")
    if intent.companies:
        hit = F.lit(False)
        for c in intent.companies:
            hit = hit | (F.col("company_id") == c.lower()) | like(F.col("company"), c)
        df = df.where(hit)
    if intent.source_register:
        df = df.where(F.col("source_register") == intent.source_register)
    if intent.sector is not None:
        df = df.join(sector_matches(t.company, intent.sector).select("sector"), "sector", "left_semi")
    if intent.years and intent.status != "removed":
        df = df.where(F.col("fiscal_year").isin(intent.years))
    if intent.status:
        status = risk_status(t.instance, t.report, t.canonical).where(F.col("status") == intent.status)
        # A removed risk shows its last instance, of the year before the one in which it is missing.
        shift = 1 if intent.status == "removed" else 0
        if intent.status == "removed" and intent.years:
            status = status.where(F.col("fiscal_year").isin(intent.years))
        df = df.join(status.select("canonical_risk_id", (F.col("fiscal_year") - shift).alias("fiscal_year")), ["canonical_risk_id", "fiscal_year"], "left_semi")
    if intent.free_text.strip():
        df = df.where(matches_any([F.col("title"), F.col("description")], intent.free_text))
    order = (F.desc("fiscal_year"), F.asc("prominence"), F.asc("page"), F.asc("id"))
    return df.orderBy(*order) if limit is None else df.orderBy(*order).limit(checked(intent, limit))


def with_citations(records: DataFrame, citations: DataFrame) -> DataFrame:
    """Records with their distinct citations as one array, sorted, in one aggregation instead of a lookup per record."""
    own = citations.join(records.select(F.col("id").alias("risk_instance_id")).distinct(), "risk_instance_id", "left_semi")
    nested = own.distinct().groupBy("risk_instance_id").agg(F.array_sort(F.collect_list(F.struct("page", "section", "source_register", "span"))).alias("citations"))
    return records.join(nested.withColumnRenamed("risk_instance_id", "id"), "id", "left").withColumn("citations", F.coalesce("citations", F.expr("cast(array() as array<struct<page:int,section:string,source_register:string,span:string>>)")))


def record(t: Tables, record_id: str) -> DataFrame:
    """One record with its citations; no row if there is none."""
    return with_citations(star(t).where(F.col("id") == record_id), t.citation)


def top_register_records(t: Tables, company: str | None = None, year: int | None = None) -> DataFrame:
    """The main-register risks with how often they are reviewed, latest year first."""
    df = star(t).where("source_register = 'erm_main_risk'")
    if company is not None:
        df = df.where((F.col("company_id") == company) | like(F.col("company"), company))
    if year is not None:
        df = df.where(F.col("fiscal_year") == year)
    return df.orderBy(F.desc("fiscal_year"), "prominence", "page", "id").select("company", "fiscal_year", "id", "title", "category", "page", "section", "review_frequency", F.array_join("review_bodies", "; ").alias("review_bodies"))


def newly_elevated(t: Tables, company: str | None = None, year: int | None = None) -> DataFrame:
    """Risks that are new or elevated, with their canonical titles."""
    status = risk_status(t.instance, t.report, t.canonical).where(F.col("status").isin("new", "elevated"))
    named = status.join(t.canonical.select(F.col("id").alias("canonical_risk_id"), "company_id", "canonical_title"), "canonical_risk_id")
    df = named.join(t.company.select(F.col("id").alias("company_id"), F.col("name").alias("company")), "company_id")
    if company is not None:
        df = df.where(F.col("company_id") == company)
    if year is not None:
        df = df.where(F.col("fiscal_year") == year)
    return df.select("company", "fiscal_year", "canonical_risk_id", "canonical_title", "status").orderBy(F.desc("fiscal_year"), "company", "canonical_title")


def companies_with_category(t: Tables, category: str, sector: str | None = None, year: int | None = None, sectors: DataFrame | None = None) -> DataFrame:
    """Companies that list a category: distinct rows, in the order of company, latest year and best prominence. ``sector``
    is a part of a stored sector, ``sectors`` a table of whole ones."""
    df = star(t).join(categories(t.instance).where(F.col("category") == category).select(F.col("risk_instance_id").alias("id")), "id", "left_semi")
    if sector is not None:
        df = df.where(like(F.col("sector"), sector))
    if sectors is not None:
        df = df.join(sectors.select("sector").distinct(), "sector", "left_semi")
    if year is not None:
        df = df.where(F.col("fiscal_year") == year)
    best = df.groupBy("company", "sector", "fiscal_year", "title", "source_register", "page").agg(F.min("prominence").alias("__p"))
    return best.orderBy("company", F.desc("fiscal_year"), "__p", "title").drop("__p")


QUESTIONS = {"top_enterprise_risks": top_register_records, "newly_elevated_risks": newly_elevated, "companies_with_category": companies_with_category}


def question(t: Tables, name: str, **params) -> DataFrame:
    """A named question with its parameters."""
    if name not in QUESTIONS:
        raise KeyError(f"no question {name!r}; there are {', '.join(QUESTIONS)}")
    return QUESTIONS[name](t, **params)


def question_for_sectors(t: Tables, name: str, sector: str, **params) -> DataFrame:
    """A named question for all stored sectors that the wanted one stands for, each row once and in the question's order;
    unknown sectors give no row. The matches stay a table, joined once."""
    return question(t, name, sectors=sector_matches(t.company, sector), **params)


def intent_of(reply: str | None) -> Intent:
    """The intent that a recorded reply spells out; unknown keys are an error."""
    import json

    value = json.loads(reply or "{}")
    unknown = set(value) - set(Intent.__dataclass_fields__)
    if unknown:
        raise ValueError(f"unknown parts of an intent: {', '.join(sorted(unknown))}")
    return Intent(**{k: v for k, v in value.items() if v is not None})


def ask(t: Tables, calls: DataFrame, request_hash: str, limit: int = 100) -> DataFrame:
    """Records for a question whose recorded reply is found by the hash of its request."""
    from citeloom.operators.calls import ReplayMiss, last_recorded

    row = last_recorded(calls.where(F.col("request_hash") == request_hash)).select("response_content").head()
    if row is None:
        raise ReplayMiss(request_hash)
    intent = intent_of(row["response_content"])
    return records(t, intent, checked(intent, limit, clamp=True))


def health(spark: SparkSession, folder: str) -> dict:
    """Whether the stored tables can be read, and their schema version."""
    try:
        check_meta(spark, f"{folder}/meta")
        return {"status": "ok", "schema_version": SCHEMA_VERSION, "spark": spark.version, "db": folder}
    except Exception as problem:  # any unreadable store is a state to report
        return {"status": "error", "problem": str(problem).split("\n")[0], "spark": spark.version, "db": folder}


def risks(t: Tables, intent: Intent, limit: int = 100) -> dict:
    """The answer to a filter: the intent, the stored sectors it matched, the number of records, and the records with their
    citations and categories in the order of ``records``."""
    rows = records(t, intent, checked(intent, limit))
    named = with_citations(rows, t.citation).join(
        categories(t.instance).groupBy(F.col("risk_instance_id").alias("id")).agg(F.array_sort(F.collect_set("category")).alias("categories")), "id", "left"
    )
    found = [r.asDict(recursive=True) for r in named.orderBy(F.desc("fiscal_year"), F.asc("prominence"), F.asc("page"), F.asc("id")).collect()]  # at most ``limit``, 1000
    matched = None if intent.sector is None else [r["sector"] for r in sector_matches(t.company, intent.sector).orderBy("sector").limit(MOST_NAMED).collect()]
    return {"intent": asdict(intent), "sector_matched": matched, "count": len(found), "records": found}


class NotFound(LookupError):
    """No record has the wanted id."""


def risk(t: Tables, record_id: str) -> dict:
    """One record with its citations; raises :class:`NotFound` without one."""
    row = record(t, record_id).head()
    if row is None:
        raise NotFound(record_id)
    return row.asDict(recursive=True)


def companies(t: Tables) -> DataFrame:
    return t.company.orderBy("name", "id")


def runs(checks: DataFrame) -> DataFrame:
    """Runs, the latest first."""
    return checks.groupBy("run_id").agg(F.min("created_at").alias("started_at"), F.count("*").alias("checks")).orderBy(F.desc("started_at"), "run_id")


def run_record(checks: DataFrame, run_id: str, phase: str | None = None) -> DataFrame:
    """The checks of a run (of one phase) in the order in which they were made; ``detail`` is decoded, null where it is no
    JSON object."""
    rows = checks.where(F.col("run_id") == run_id)
    rows = rows if phase is None else rows.where(F.col("phase") == phase)
    return rows.orderBy("created_at", "phase", "check_id").withColumn("detail", F.when(F.json_object_keys("detail").isNotNull(), F.from_json("detail", "map<string,string>")))
