"""Problem 7: mixing sources to target weights.

Method: tokens are summed per source; the repetition rate of a source is its wanted tokens over its own tokens, at
most its cap; each document is emitted floor(rate) times plus one copy drawn with probability equal to the fraction,
by a hash of plan, document and seed, so a run can be repeated on any partitioning.

Wanted tokens of a source are ``budget_share`` times the tokens of all documents, times its share of the plan's
shares (they need not add up to 1). What a capped or missing source cannot give is not handed to others: the report
shows it. Sources compare in lower case without blanks at the ends.

The plan is a parameter table: up to ``MOST_RULES`` rows of it are broadcast, more are joined by shuffle. The size of
a source is pre-aggregated, and its documents are never brought together in one task.

Defined results: documents of a null, blank or unlisted source are not drawn but count in the total; null texts have
no tokens; several rows of one plan and source add their shares under the greatest cap; null shares and caps are 0.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.tokens import VOCABULARY, with_token_counts
from citeloom.plans.staging import staged

MOST_RULES, SEED = 10_000, 7


def _source():
    return F.lower(F.trim("source"))


def sized_documents(documents: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """(doc_id, source, n_tokens), counted once and kept in the shared folder for the two passes over it."""
    plain = documents.select("doc_id", F.nullif(_source(), F.lit("")).alias("source"), "text")
    return staged(with_token_counts(plain, "text", ["doc_id", "source"], vocabulary), "sized")


def rates(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """Per plan and source: wanted tokens, available tokens and the repetition rate."""
    rules = (
        targets.select("plan_id", _source().alias("source"), "target_share", "max_repeats", "budget_share")
        .groupBy("plan_id", "source")
        .agg(F.sum(F.coalesce("target_share", F.lit(0.0))).alias("share"), F.max(F.coalesce("max_repeats", F.lit(0))).alias("cap"), F.max("budget_share").alias("budget"))
    )
    plans = rules.groupBy("plan_id").agg(F.sum("share").alias("shares"), F.max("budget").alias("plan_budget"))
    per_source = sized.groupBy("source").agg(F.sum("n_tokens").alias("tokens"))
    total = per_source.agg(F.sum("tokens")).first()[0] or 0
    wanted = F.coalesce(F.lit(float(total)) * F.col("plan_budget") * F.try_divide("share", "shares"), F.lit(0.0))
    have = F.coalesce("tokens", F.lit(0))
    return rules.join(plans, "plan_id").join(per_source, "source", "left").select(
        "plan_id", "source", F.try_divide("share", "shares").alias("target_share"), wanted.alias("wanted_tokens"), have.alias("source_tokens"), F.col("cap").alias("max_repeats"),
        F.when(have > 0, F.least(wanted / have, F.col("cap").cast("double"))).otherwise(0.0).alias("rate"),
    )


def mixed(sized: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """The chosen documents of each plan: ``plan_id, doc_id, source, repeats, n_tokens`` (tokens of one copy)."""
    rate = rates(sized, targets).where("rate > 0").select("plan_id", "source", "rate")
    if len(targets.limit(MOST_RULES + 1).select("plan_id").collect()) <= MOST_RULES:
        rate = F.broadcast(rate)
    draw = F.pmod(F.xxhash64("plan_id", "doc_id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    whole = F.floor("rate")
    repeats = (whole + F.when(draw < F.col("rate") - whole, 1).otherwise(0)).cast("int")
    return sized.join(rate, "source").select("plan_id", "doc_id", "source", repeats.alias("repeats"), "n_tokens").where("repeats > 0")


def shares(sized: DataFrame, targets: DataFrame, seed: int = SEED) -> DataFrame:
    """Per plan and source: wanted and drawn tokens, target and actual share, and the share of the wanted total."""
    drawn = mixed(sized, targets, seed).groupBy("plan_id", "source").agg(F.sum(F.col("repeats") * F.col("n_tokens")).alias("drawn_tokens"), F.sum("repeats").alias("copies"))
    sums = drawn.groupBy("plan_id").agg(F.sum("drawn_tokens").alias("plan_tokens"))
    rule = rates(sized, targets)
    total = rule.groupBy("plan_id").agg(F.sum("wanted_tokens").alias("plan_wanted"))
    got = F.coalesce("drawn_tokens", F.lit(0))
    return rule.join(drawn, ["plan_id", "source"], "left").join(sums, "plan_id", "left").join(total, "plan_id").select(
        "plan_id", "source", F.round("target_share", 6).alias("target_share"), F.round(F.coalesce(F.try_divide(got, "plan_tokens"), F.lit(0.0)), 6).alias("actual_share"),
        F.round(F.coalesce(F.try_divide(got.cast("double"), "plan_wanted"), F.lit(0.0)), 6).alias("share_of_wanted_total"), F.round("rate", 6).alias("rate"), "max_repeats",
        F.coalesce("copies", F.lit(0).cast("long")).alias("copies"), got.alias("drawn_tokens"),
    )
