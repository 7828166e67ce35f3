"""Recorded model calls: hashing, replay as a join, usage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class ReplayMiss(LookupError):
    """A request was never recorded."""


def request_hash(*parts: Column) -> Column:
    """SHA-256 over the parts of a request in a fixed order; null differs from an empty part. What tells two requests
    apart: model, prompt version, sample, temperature, messages and schema."""
    sep, none = "\u0001", "\u0002"
    return F.sha2(F.concat_ws(sep, *(F.coalesce(p.cast("string"), F.lit(none)) for p in parts)), 256)


def message_text(messages: Column) -> Column:
    """Messages as one text, role and content of each."""
    return F.array_join(F.transform(messages, lambda m: F.concat(F.coalesce(m["role"], F.lit("")), F.lit("="), F.coalesce(m["content"], F.lit("")))), "\u0003")


def last_recorded(calls: DataFrame) -> DataFrame:
    """One recording per request hash: the last one, by time and then by content. It is an aggregation that combines
    before the shuffle: a request that was repeated very often is no hot group."""
    rest = [c for c in calls.columns if c != "request_hash"]
    last = calls.groupBy("request_hash").agg(F.max_by(F.struct(*rest), F.struct("created_at", "call_id", "response_content")).alias("__r"))
    return last.select(*(F.col(c) if c == "request_hash" else F.col(f"__r.{c}").alias(c) for c in calls.columns))


def replayed(requests: DataFrame, calls: DataFrame) -> DataFrame:
    """Requests with their recorded reply; ``recorded`` tells a null reply from a missing recording."""
    known = last_recorded(calls).select("request_hash", F.col("response_content").alias("reply"), F.lit(True).alias("recorded"))
    return requests.join(known, "request_hash", "left").withColumn("recorded", F.coalesce("recorded", F.lit(False)))


def misses(requests: DataFrame, calls: DataFrame) -> DataFrame:
    return requests.join(calls.select("request_hash"), "request_hash", "left_anti")


def replay_or_raise(requests: DataFrame, calls: DataFrame) -> DataFrame:
    """``replayed``, but a request without recording raises :class:`ReplayMiss` (one small action)."""
    lost = misses(requests, calls).select("request_hash").head(3)
    if lost:
        raise ReplayMiss(", ".join(r[0] or "null" for r in lost))
    return replayed(requests, calls)


def usage(calls: DataFrame) -> DataFrame:
    """Calls, tokens, seconds and models per step (the first part of the call id)."""
    return calls.groupBy(F.split_part("call_id", F.lit("-"), F.lit(1)).alias("step")).agg(
        F.count("*").alias("calls"), F.coalesce(F.sum("usage.prompt_tokens"), F.lit(0)).alias("tokens_in"), F.coalesce(F.sum("usage.completion_tokens"), F.lit(0)).alias("tokens_out"),
        F.round(F.sum("elapsed_s"), 3).alias("seconds"), F.count_distinct("served_model").alias("models"),
    )


def usage_with_totals(calls: DataFrame, pipeline_steps: list[str]) -> DataFrame:
    """``usage`` with one line for the pipeline's steps together and one for the rest."""
    steps = usage(calls)
    part = F.when(F.col("step").isin(pipeline_steps), "pipeline").otherwise("other")
    totals = steps.groupBy(part.alias("step")).agg(F.sum("calls").alias("calls"), F.sum("tokens_in").alias("tokens_in"), F.sum("tokens_out").alias("tokens_out"), F.round(F.sum("seconds"), 3).alias("seconds"), F.max("models").alias("models"))
    return steps.unionByName(totals)


def unknown_keys(payload: Column, allowed: list[str]) -> Column:
    """Keys of a JSON object that its model does not allow (``from_json`` drops them in silence)."""
    return F.array_sort(F.array_except(F.json_object_keys(payload), F.array(*[F.lit(k) for k in allowed])))


def missing_keys(payload: Column, wanted: list[str]) -> Column:
    return F.array_sort(F.array_except(F.array(*[F.lit(k) for k in wanted]), F.json_object_keys(payload)))
