"""Problem 1: long exact spans shared between records.

Method: level-wise doubling. Windows of one length that stand in one record only cannot lie in a longer shared
stretch, so only stretches around windows repeated in two or more records are looked at with windows of twice that
length, until the wanted length (or, for ``longest_shared``, no candidate at all) is left.

To keep the short levels small, a level counts not every window but those that are the least hash of some run of
``min_len - length + 1`` neighbouring windows. The choice depends on the characters alone, and every stretch of
``min_len`` characters holds at least one chosen window, so two copies of a stretch always choose the same one and
nothing is lost. At the wanted length all remaining windows are counted, by 128-bit hash.

Identical texts are collapsed first (a boilerplate text used by a third of all records is one row with the least and
the greatest record), and windows are counted with partial aggregation, so no hot text or window reaches one task.

Defined results: null and empty texts and texts shorter than ``min_len`` share nothing; repeated citation rows count
once; the same stretch twice in one record only is not shared; extra columns are ignored; empty tables give no rows.
"""

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.plans.staging import staged

MIN_LEN = 120
#: Characters worked on at a time in a task (a longer text is taken whole).
CHARACTERS = 500_000
_B1, _B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_TOP = np.uint64(0xFFFFFFFFFFFFFFFF)


def text_units(instances: DataFrame, citations: DataFrame) -> DataFrame:
    """One row per text of a record: ``risk_instance_id, field, page, text``; duplicate citation rows once."""
    of = lambda col: instances.select(
        F.col("id").alias("risk_instance_id"), F.lit(col).alias("field"), F.col("page").cast("int").alias("page"), F.col(col).alias("text")
    )
    spans = (
        citations.select("risk_instance_id", F.col("page").cast("int").alias("page"), F.col("span").alias("text"))
        .distinct()
        .select("risk_instance_id", F.lit("span").alias("field"), "page", "text")
    )
    return of("description").unionByName(of("verbatim_span")).unionByName(spans)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _window_hashes(codes: np.ndarray, length: int, base: np.uint64) -> np.ndarray:
    """Hash of the window at each start of ``codes`` (polynomial modulo 2**64, then mixed)."""
    n = len(codes)
    inverse = np.uint64(pow(int(base), -1, 1 << 64))
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(n, base, np.uint64))
        back = np.cumprod(np.full(n, inverse, np.uint64))
        sums = np.concatenate(([np.uint64(0)], np.cumsum(_mix(codes.astype(np.uint64) + base) * power)))
        return _mix((sums[length:] - sums[:-length]) * back[: n - length + 1])


def _sliding(x: np.ndarray, width: int, op: np.ufunc) -> np.ndarray:
    """``op`` over each run of ``width`` values, by doubling."""
    have, out = 1, x
    while have * 2 <= width:
        out = op(out[:-have], out[have:])
        have *= 2
    rest = width - have
    return op(out[:-rest], out[rest:]) if rest else out


def _chosen(hashes: np.ndarray, starts_ok: np.ndarray, length: int, min_len: int) -> np.ndarray:
    """Positions of windows of ``length`` (by their ``hashes``) that are least in some allowed stretch of ``min_len``;
    ``starts_ok`` marks the allowed stretch starts, so stretches that run over the end of a text are never looked at."""
    width = min_len - length + 1
    keys = np.minimum(hashes, _TOP - np.uint64(1)) + np.uint64(1)
    least = np.where(starts_ok, _sliding(keys, width, np.minimum), np.uint64(0))
    padded = np.concatenate((np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)))
    return np.flatnonzero(_sliding(padded, width, np.maximum) == keys)


def _positions(codes: np.ndarray, sizes: np.ndarray, hits: list | None, length: int, previous: int, min_len: int) -> np.ndarray:
    """Starts of the windows of ``length`` to count in texts laid end to end, given the hits of the previous length."""
    ends = np.cumsum(sizes)
    begins = ends - sizes
    if hits is not None:
        own = np.array([len(h) for h in hits])
        at = np.concatenate(hits).astype(np.int64) + np.repeat(begins, own)
        if length > min_len:  # both halves are repeated
            return np.intersect1d(at, at - previous)
        low = np.maximum(at + previous - min_len, np.repeat(begins, own))
        high = np.minimum(at, np.repeat(ends, own) - min_len)
        low, high = low[low <= high], high[low <= high]
        steps = np.bincount(low, minlength=len(codes) + 1) - np.bincount(high + 1, minlength=len(codes) + 1)
        ok = np.cumsum(steps)[: len(codes) - min_len + 1] > 0
    else:
        ok = np.arange(len(codes) - min_len + 1) + min_len <= np.repeat(ends, sizes)[: len(codes) - min_len + 1]
    return _chosen(_window_hashes(codes, length, _B1), ok, length, min_len) if length < min_len else np.flatnonzero(ok)


def _level(length: int, previous: int, min_len: int):
    """Batches of (tkey, text, lo, hi, hits) to windows (h1, h2, tkey, pos, lo, hi) of ``length``.

    Texts are laid end to end, up to ``CHARACTERS`` at a time, so that each step is one array operation.
    """
    names = ["h1", "h2", "tkey", "pos", "lo", "hi"]

    def part(batch: pa.RecordBatch, rows: list[int], texts: list[str]) -> pa.RecordBatch:
        codes, sizes = _codes("".join(texts)), np.array([len(t) for t in texts])
        hits = [batch.column("hits")[r].values.to_numpy(zero_copy_only=False) for r in rows] if previous else None
        at = _positions(codes, sizes, hits, length, previous, min_len)
        h1 = _window_hashes(codes, length, _B1)[at]
        h2 = _window_hashes(codes, length, _B2)[at] if length >= min_len else h1
        text = np.searchsorted(np.cumsum(sizes), at, side="right")
        take = pa.array(np.array(rows)[text], pa.int64())
        pos = pa.array((at - (np.cumsum(sizes) - sizes)[text]).astype(np.int32))
        of = lambda c: batch.column(c).take(take)
        return pa.RecordBatch.from_arrays([pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), of("tkey"), pos, of("lo"), of("hi")], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, texts, size = [], [], 0
            for row, text in enumerate(batch.column("text").to_pylist()):
                if len(text) >= max(length, min_len):
                    rows.append(row), texts.append(text)
                    size += len(text)
                if size >= CHARACTERS:
                    yield part(batch, rows, texts)
                    rows, texts, size = [], [], 0
            if rows:
                yield part(batch, rows, texts)

    return run


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def distinct_texts(units: DataFrame, min_len: int) -> DataFrame:
    """Texts of at least ``min_len`` characters, each once, with the least and greatest record that holds it."""
    record = F.xxhash64("risk_instance_id")
    return (
        units.where(F.char_length("text") >= min_len)
        .select(F.unhex(F.md5(F.encode("text", "utf-8"))).alias("tkey"), "text", record.alias("lo"), record.alias("hi"))
        .groupBy("tkey")
        .agg(F.first("text").alias("text"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    )


def _windows(cand: DataFrame, length: int, previous: int, min_len: int) -> DataFrame:
    cols = ["tkey", "text", "lo", "hi"] + (["hits"] if previous else [])
    return cand.select(*cols).mapInArrow(_level(length, previous, min_len), "h1 long, h2 long, tkey binary, pos int, lo long, hi long")


def _repeated(windows: DataFrame) -> DataFrame:
    """(tkey, hits) of the windows that stand in two or more records."""
    keys = (
        windows.groupBy("h1", "h2")
        .agg(F.min("lo").alias("a"), F.max("hi").alias("b"))
        .where(F.col("a") < F.col("b"))
        .select("h1", "h2")
    )
    # The windows are far larger than the texts, by whose size the planner goes: no side may be broadcast.
    return windows.hint("merge").join(keys.hint("merge"), ["h1", "h2"], "left_semi").groupBy("tkey").agg(F.collect_list("pos").alias("hits"))


def repeated_windows(texts: DataFrame, min_len: int = MIN_LEN, first: int = 30) -> DataFrame:
    """(tkey, hits): starts of the windows of ``min_len`` characters that stand in two or more records.

    Lengths double from the least one of at least ``first`` characters that reaches ``min_len`` (30, 60, 120).
    """
    lengths = [min_len]
    while lengths[0] >= 2 * first:
        lengths.insert(0, lengths[0] // 2)
    cand, previous, hits = texts, 0, None
    for length in lengths:
        hits = _repeated(_windows(cand, length, previous, min_len))
        if length < min_len:
            hits = staged(hits, f"spans{length}")
            cand, previous = texts.hint("merge").join(hits.hint("merge"), "tkey"), length
    return hits


def _runs(min_len: int):
    @F.pandas_udf("array<struct<start_pos:int,end_pos:int>>")
    def runs(hits: pd.Series) -> pd.Series:
        out = []
        for h in hits:
            p = np.unique(np.asarray(h))
            cut = np.flatnonzero(np.diff(p) > min_len) + 1
            starts, ends = p[np.r_[0, cut]], p[np.r_[cut - 1, len(p) - 1]] + min_len
            out.append([{"start_pos": int(a), "end_pos": int(b)} for a, b in zip(starts, ends)])
        return pd.Series(out)

    return runs


def shared_spans(instances: DataFrame, citations: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """Maximal runs of positions that lie in a stretch of ``min_len`` characters found in another record's text."""
    units = text_units(instances, citations)
    texts = staged(distinct_texts(units, min_len), "spantexts")
    runs = repeated_windows(texts, min_len).select("tkey", F.explode(_runs(min_len)("hits")).alias("r"))
    keyed = units.where(F.char_length("text") >= min_len).select(
        "risk_instance_id", "field", "page", F.unhex(F.md5(F.encode("text", "utf-8"))).alias("tkey")
    )
    return keyed.hint("merge").join(runs.hint("merge"), "tkey").select("risk_instance_id", "field", "page", "r.start_pos", "r.end_pos")


def shared_report(instances: DataFrame, citations: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """Per record: characters in all its texts, characters shared elsewhere and their share of the whole."""
    sizes = text_units(instances, citations).groupBy("risk_instance_id").agg(
        F.sum(F.coalesce(F.char_length("text"), F.lit(0))).cast("long").alias("n_chars")
    )
    shared = (
        shared_spans(instances, citations, min_len)
        .groupBy("risk_instance_id")
        .agg(F.sum(F.col("end_pos") - F.col("start_pos")).cast("long").alias("shared_chars"), F.count("*").alias("n_runs"))
    )
    full = sizes.join(shared, "risk_instance_id", "left")
    done = F.coalesce("shared_chars", F.lit(0).cast("long"))
    return full.select(
        "risk_instance_id", "n_chars", done.alias("shared_chars"), F.coalesce("n_runs", F.lit(0).cast("long")).alias("n_runs"),
        F.round(F.when(F.col("n_chars") > 0, done / F.col("n_chars")).otherwise(0.0), 6).alias("shared_share"),
    )


def longest_shared(instances: DataFrame, citations: DataFrame, min_len: int = MIN_LEN) -> DataFrame:
    """The doubling carried on past ``min_len`` until no candidate is left: per record the greatest level
    (``min_len``, twice it, four times it, ...) at which one of its windows still stands in another record."""
    units = text_units(instances, citations)
    texts = staged(distinct_texts(units, min_len), "spantexts")
    hits = staged(repeated_windows(texts, min_len), "spanlevel")
    length, levels = min_len, []
    while hits.take(1):
        levels.append(hits.select("tkey", F.lit(length).alias("level")))
        cand = texts.hint("merge").join(hits.hint("merge"), "tkey").where(F.char_length("text") >= 2 * length)
        hits = staged(_repeated(_windows(cand, 2 * length, length, min_len)), "spanlevel")
        length *= 2
    if not levels:
        return units.select("risk_instance_id", F.lit(0).alias("longest_level")).where("false")
    every = levels[0]
    for one in levels[1:]:
        every = every.unionByName(one)
    keyed = units.select("risk_instance_id", F.unhex(F.md5(F.encode("text", "utf-8"))).alias("tkey"))
    return keyed.join(every, "tkey").groupBy("risk_instance_id").agg(F.max("level").alias("longest_level"))
