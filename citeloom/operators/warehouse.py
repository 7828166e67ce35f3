"""Stored tables: replacing a report, upserts, the status view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SCHEMA_VERSION = "1"


def years_of(instances: DataFrame, reports: DataFrame) -> DataFrame:
    """Best (least) prominence of each canonical risk and fiscal year."""
    facts = instances.select("report_id", "canonical_risk_id", "prominence")
    return facts.join(reports.select(F.col("id").alias("report_id"), "fiscal_year"), "report_id").where("canonical_risk_id IS NOT NULL").groupBy("canonical_risk_id", "fiscal_year").agg(F.min("prominence").alias("prominence"))


def risk_status(instances: DataFrame, reports: DataFrame, canonical: DataFrame) -> DataFrame:
    """``canonical_risk_id, fiscal_year, status``: new, elevated, continuing; removed in the year after the last one.

    The year before means exactly that year: a risk that skips one is removed and, on return, new. New needs some
    report of the company in the year before, removed a report of the company in that year or later.

    One window over (canonical risk, year) gives the neighbours of a year; company years come from the small reports
    table. So the facts are shuffled once.
    """
    years = years_of(instances, reports).join(canonical.select(F.col("id").alias("canonical_risk_id"), "company_id"), "canonical_risk_id")
    line = Window.partitionBy("canonical_risk_id").orderBy("fiscal_year")
    near = years.select(
        "*", F.lag("fiscal_year").over(line).alias("last_year"), F.lag("prominence").over(line).alias("last_prominence"), F.lead("fiscal_year").over(line).alias("next_year")
    )
    filed = reports.where("company_id IS NOT NULL AND fiscal_year IS NOT NULL").select("company_id", "fiscal_year").distinct()
    latest = filed.groupBy("company_id").agg(F.max("fiscal_year").alias("latest"))
    before = F.when(F.col("last_year") == F.col("fiscal_year") - 1, F.col("last_prominence"))
    live = near.join(filed.select("company_id", (F.col("fiscal_year") + 1).alias("fiscal_year")), ["company_id", "fiscal_year"], "left_semi").select(
        "canonical_risk_id", "fiscal_year", F.when(before.isNull(), "new").when(F.col("prominence") < before, "elevated").otherwise("continuing").alias("status")
    )
    gone = (
        near.where(F.col("next_year").isNull() | (F.col("next_year") > F.col("fiscal_year") + 1)).join(latest, "company_id")
        .where(F.col("fiscal_year") + 1 <= F.col("latest")).select("canonical_risk_id", (F.col("fiscal_year") + 1).alias("fiscal_year"), F.lit("removed").alias("status"))
    )
    return live.unionByName(gone)


def replaced(stored: DataFrame, loaded: DataFrame, key: str = "report_id") -> DataFrame:
    """The table after a load: rows of the loaded keys are replaced, the others stay."""
    return stored.join(loaded.select(key).distinct(), key, "left_anti").unionByName(loaded)


def upserted(stored: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Stored rows, overwritten by loaded rows of the same key."""
    return replaced(stored, loaded, key)


def first_title_wins(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """One row per key, the first in order."""
    first = rows.groupBy(key).agg(F.min_by(F.struct(*(c for c in rows.columns if c != key)), F.struct(*order)).alias("__r"))
    return first.select(*(F.col(c) if c == key else F.col(f"__r.{c}").alias(c) for c in rows.columns))


def write_reports(loaded: DataFrame, path: str) -> None:
    """Replace the loaded reports in a table partitioned by ``report_id``; other reports keep their files."""
    loaded.repartition("report_id").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("report_id").parquet(path)


#: Stored tables: those with rows of a report, those whose rows are overwritten by id, and that of the first title.
OF_REPORTS, BY_ID = ("risk_instance", "risk_citation", "risk_category", "run_record"), ("company", "report", "run")


def load_reports(tables: dict[str, DataFrame], folder: str, load_id: str) -> None:
    """Store the tables of one or more reports as a unit.

    Every table is written under ``load=<load_id>``, beside the older loads; the last step is one small row per report in
    ``loads``, and readers count only what is named there, so a load that fails half-way is never seen. Tables of reports
    need ``report_id``; ``tables["report"]`` says which reports are loaded.
    """
    spark = tables["report"].sparkSession
    known = {*OF_REPORTS, *BY_ID, "canonical_risk"}
    if unknown := set(tables) - known:
        raise ValueError(f"no stored tables: {', '.join(sorted(unknown))}")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{folder}/{name}/load={load_id}")
    loads = tables["report"].select(F.col("id").alias("report_id"), F.lit(load_id).alias("load"), F.current_timestamp().alias("at"))
    loads.coalesce(1).write.mode("append").parquet(f"{folder}/loads")
    write_meta(spark, f"{folder}/meta")


def stored(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """A stored table: rows of a report from its last load only; by id the last load's row; of a canonical risk the title of
    its first load."""
    check_meta(spark, f"{folder}/meta")
    loads = spark.read.parquet(f"{folder}/loads")
    rows = spark.read.parquet(f"{folder}/{name}")
    plain = [c for c in rows.columns if c != "load"]
    rows = rows.withColumn("load", F.col("load").cast("string"))
    if name in OF_REPORTS:
        last = loads.groupBy("report_id").agg(F.max_by("load", F.struct("at", "load")).alias("load"))
        return rows.join(last, ["report_id", "load"], "left_semi").select(plain)
    seen = rows.join(loads.groupBy("load").agg(F.min("at").alias("__at")), "load")
    pick = F.min_by if name == "canonical_risk" else F.max_by
    one = seen.groupBy("id").agg(pick(F.struct(*plain), F.struct("__at", "load")).alias("__r"))
    return one.select(*(F.col(f"__r.{c}").alias(c) for c in plain))


def write_meta(spark: SparkSession, path: str) -> None:
    spark.createDataFrame([("schema_version", SCHEMA_VERSION)], "key string, value string").write.mode("overwrite").json(path)


def check_meta(spark: SparkSession, path: str) -> None:
    """Raise if the stored schema version is another one than this reader's."""
    row = spark.read.schema("key string, value string").json(path).where("key = 'schema_version'").head()
    if row is None or row["value"] != SCHEMA_VERSION:
        raise ValueError(f"stored schema version {row and row['value']}, this reader needs {SCHEMA_VERSION}")


def categories(instances: DataFrame) -> DataFrame:
    """``risk_instance_id, category, is_primary``: the category, and secondary ones where the table has them."""
    primary = instances.where("category IS NOT NULL").select(F.col("id").alias("risk_instance_id"), "category", F.lit(True).alias("is_primary"))
    if "secondary_categories" not in instances.columns:
        return primary.distinct()
    other = F.explode(F.array_except("secondary_categories", F.array("category")))
    return primary.unionByName(instances.select(F.col("id").alias("risk_instance_id"), other.alias("category"), F.lit(False).alias("is_primary"))).dropDuplicates(["risk_instance_id", "category"])
