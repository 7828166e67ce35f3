"""Title similarity by matching blocks (the ratio of twice the matched characters to the sum of lengths)."""

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


@F.pandas_udf(DoubleType())
def block_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    """Order of the arguments matters; texts of 200 characters and more leave out very frequent characters; null for null."""
    kept: dict[tuple[str, str], float] = {}
    out = []
    for x, y in zip(a, b):
        if x is None or y is None:
            out.append(None)
            continue
        if (x, y) not in kept:
            kept[x, y] = SequenceMatcher(None, x, y).ratio()
        out.append(kept[x, y])
    return pd.Series(out, dtype="float64")


def can_reach(a: Column, b: Column, least: float) -> Column:
    """Whether the ratio of two texts can reach ``least`` at all: at most the shorter length can match. Filter by this
    first, so that Python sees only pairs that may pass."""
    both = F.char_length(a) + F.char_length(b)
    return F.lit(2.0) * F.least(F.char_length(a), F.char_length(b)) >= F.lit(least) * both


def letter_counts(text: Column) -> Column:
    """How often each letter, digit and the blank stands in a text in normal form. Make it below the join, once per text."""
    letters = F.array(*[F.lit(c) for c in "abcdefghijklmnopqrstuvwxyz0123456789 "])
    return F.transform(letters, lambda c: F.char_length(text) - F.char_length(F.replace(text, c, F.lit(""))))


def scored_pairs(pairs: DataFrame, a: str, b: str, least: float) -> DataFrame:
    """``pairs`` with ``score``, the ratio of the texts ``a`` and ``b``, from ``least`` on.

    ``a_n`` and ``b_n`` hold their ``letter_counts``: of each character only as many can match as both have, so that
    few pairs are left for Python.
    """
    common = F.aggregate(F.zip_with(F.col(f"{a}_n"), F.col(f"{b}_n"), lambda x, y: F.least(x, y)), F.lit(0), lambda n, x: n + x)
    both = F.char_length(a) + F.char_length(b)
    may = pairs.where(can_reach(F.col(a), F.col(b), least)).where(F.lit(2.0) * common >= F.lit(least) * both).drop(f"{a}_n", f"{b}_n")
    return may.withColumn("score", block_ratio(a, b)).where(F.col("score") >= least)


def levels(score: Column, exact: Column, variant: Column, least: float = 0.85) -> Column:
    """Grade of a title match: exact, variant (one is the other with more words), similarity, none."""
    return F.when(exact, "exact").when(variant, "variant").when(score >= least, "similarity").otherwise("none")
