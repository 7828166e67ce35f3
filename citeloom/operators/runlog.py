"""Run checks: last one wins, status, drift between runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEVERITY = ("ok", "warning", "error")


def last_wins(checks: DataFrame) -> DataFrame:
    """The last row of each check (run, phase, check and the section its detail names; null is a
    value), by time and then by content (an aggregation that combines before the shuffle, so a
    check that was made very often is no hot group)."""
    rest = ["created_at", *(c for c in checks.columns if c not in ("run_id", "phase", "check_id", "created_at"))]
    keyed = checks.withColumn("section", F.get_json_object("detail", "$.section"))
    last = keyed.groupBy("run_id", "phase", "check_id", "section").agg(F.max(F.struct(*rest)).alias("__r"))
    of = lambda c: F.col(c) if c in ("run_id", "phase", "check_id") else F.col(f"__r.{c}")
    return last.select(*(of(c).alias(c) for c in checks.columns), "section")


def severity(outcome: Column) -> Column:
    return F.array_position(F.array(*[F.lit(s) for s in SEVERITY]), outcome)


def status(checks: DataFrame, keys: list[str]) -> DataFrame:
    """The worst outcome of each key (ok, warnings, error) and counts of each."""
    worst = F.max(severity(F.col("outcome")))
    name = F.element_at(F.array(F.lit("ok"), F.lit("warnings"), F.lit("error")), F.greatest(worst, F.lit(1)).cast("int"))
    return checks.groupBy(*keys).agg(name.alias("status"), F.count("*").alias("checks"), *(F.count_if(F.col("outcome") == s).alias(f"n_{s}") for s in SEVERITY))


def count_drift(checks: DataFrame, check_key: list[str]) -> DataFrame:
    """Counts of each report's last run against the run before it (runs in the order of their ids), where they differ.
    A check that only one of the two runs has counts as a difference."""
    runs = checks.where("report_id IS NOT NULL").select("report_id", "run_id").distinct()
    order = Window.partitionBy("report_id").orderBy(F.desc("run_id"))
    ranked = runs.withColumn("age", F.row_number().over(order)).where("age <= 2")
    counts = checks.join(ranked, ["report_id", "run_id"]).groupBy("report_id", "age", *check_key).agg(F.sum("count").alias("n"))
    two = ranked.where("age = 2").select("report_id")
    now = counts.where("age = 1").join(two, "report_id", "left_semi").select("report_id", *check_key, F.col("n").alias("current"))
    renamed = {k: f"__{k}" for k in ("report_id", *check_key)}
    old = counts.where("age = 2").select(*(F.col(k).alias(v) for k, v in renamed.items()), F.col("n").alias("previous"))
    same = F.lit(True)
    for k, v in renamed.items():
        same = same & F.col(k).eqNullSafe(F.col(v))
    both = now.join(old, same, "full_outer").where(~F.col("current").eqNullSafe(F.col("previous")))
    return both.select(*(F.coalesce(k, v).alias(k) for k, v in renamed.items()), "previous", "current")


def rendered(checks: DataFrame) -> DataFrame:
    """One text line per check: mark, check, count, strategy, and the details that are single values."""
    mark = F.when(F.col("outcome") == "ok", "+").when(F.col("outcome") == "warning", "!").otherwise("x")
    details = F.map_entries(F.from_json("detail", "map<string,string>")) if "detail" in checks.columns else F.array()
    single = F.filter(details, lambda e: e["value"].isNotNull() & ~F.substring(e["value"], 1, 1).isin("{", "[")) if "detail" in checks.columns else F.array().cast("array<string>")
    shown = F.array_join(F.array_sort(F.transform(single, lambda e: F.concat(e["key"], F.lit("="), e["value"]))), " ") if "detail" in checks.columns else F.lit("")
    line = F.concat_ws(" ", mark, "check_id", F.col("count").cast("string"), F.concat(F.lit("["), F.col("strategy"), F.lit("]")), F.nullif(shown, F.lit("")))
    return checks.select("run_id", line.alias("line"))


def zero_filled(groups: DataFrame, items: DataFrame, keys: list[str]) -> DataFrame:
    """Items per group, 0 for groups without any."""
    counts = items.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.select(*keys).distinct().join(counts, keys, "left").select(*keys, F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that stand more than once."""
    return rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that one of two tables has and the other has not, counted with their repeats: empty if they are the same."""
    return a.exceptAll(b).withColumn("side", F.lit("left")).unionByName(b.exceptAll(a).withColumn("side", F.lit("right")))
