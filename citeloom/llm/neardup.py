"""Problem 3: near-duplicate records with small edits.

Method: Order MinHash. Each distinct text is cut into k-mers labelled with their occurrence number; every sketch keeps
the ``SMALLEST`` k-mers of least hash in the order they stand in the text, so two texts share a sketch when they share
those k-mers in that order. Texts that share any of ``SKETCHES`` sketches are candidates; each sketch row carries a
one-bit minwise signature, and candidates whose signatures disagree far beyond chance (more than five standard
deviations below the threshold) are dropped inside the join, before any text is moved.

Candidates are verified by banded alignment (Levenshtein distance within a band, in the JVM) of their words, each word
(a long one in pieces, each character of a script without blanks) one letter of a code. The band follows from the
threshold: texts of which ``threshold`` of the k-mers are common and in order differ in at most (1 - t) / (1 + t) of
both lengths. Where parts changed places the words are aligned in sorted order, in a band half as wide again, as a
changed word may move there. A candidate outside both bands is rejected. For ``found_pairs`` the exact share of
distinct k-mers follows, on what the alignment leaves.

A pair at the threshold of 0.7 shares one sketch with a probability of about 0.34 when the order is kept, 0.09 when
two halves are swapped and 0.04 when three parts are turned round. With 112 sketches it is practically never missed
when the order is kept, about once in 24,000 for swapped halves and once in 100 for three parts turned round. Sketches
of two k-mers would lose fewer of such pairs, but join several times as many pairs of texts made from one template.

Identical texts are one class from the start: sketches, joins and checks run over classes, and only the result of
``found_pairs`` spells out the pairs of records, a class of many copies in parts; ``linked_classes`` gives the pairs of
classes and ``classes`` their members. A hot sketch is a hot key of an equi join, which adaptive execution splits. The
sketches are many times the size of the texts, which the planner cannot know, so no join here may be a broadcast.

Defined results: a null title or description counts as empty; texts of fewer than ``K`` characters have no k-mers and
are in no pair; repeated rows of one id count once; empty tables give no rows; extra columns are ignored.
"""

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citeloom.plans.staging import staged

K, SMALLEST, SKETCHES, THRESHOLD = 5, 3, 112, 0.7
SIGNATURE_BITS, DEVIATIONS = 320, 5.0
#: How much wider the band is for words in sorted order; letters of one piece of a word.
SORTED_BAND, PIECE = 1.5, 8
_DENSE = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff"
_PIECES = re.compile(rf"[{_DENSE}]|[^\s{_DENSE}]{{1,{PIECE}}}")
#: Letters of the word code.
_CODE_FIRST, _CODE_SIZE = 0x3400, 0xD7FF - 0x3400
_WORDS = SIGNATURE_BITS // 64
_M1, _M2, _B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), np.uint64(0x9E3779B97F4A7C15)
_TOP = np.uint32(0xFFFFFFFF)
#: Copies of one text that are joined in one task.
PART = 500
#: Cells of one hash matrix; longer texts are hashed in blocks of columns.
_CELLS = 4_000_000
#: Characters of the texts that are sketched together.
_CHARACTERS = 200_000


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def kmers(texts: list[str], k: int = K) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the k-mers of texts laid end to end, and how many each text has."""
    sizes = np.array([len(t) for t in texts], np.int64)
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    n = max(0, len(codes) - k + 1)
    out = np.zeros(n, np.uint64)
    for i in range(k):
        out = out * _B + codes[i : i + n] + np.uint64(1)
    # K-mers that run over the end of a text are none.
    room = np.repeat(np.cumsum(sizes), sizes)[:n] - np.arange(n)
    return _mix(out[room >= k]), np.maximum(0, sizes - k + 1)


def _labelled(grams: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """K-mers with the number of their occurrence in their own text mixed in."""
    own = grams ^ _mix(np.repeat(np.arange(1, len(counts) + 1, dtype=np.uint64), counts))
    order = np.argsort(own, kind="stable")
    ranked = own[order]
    first = np.concatenate(([True], ranked[1:] != ranked[:-1]))
    nth = np.arange(len(grams)) - np.maximum.accumulate(np.where(first, np.arange(len(grams)), 0))
    out = np.empty_like(grams)
    out[order] = grams[order] + nth.astype(np.uint64) * _B
    return _mix(out)


_KEYS = _mix(np.arange(1, SKETCHES + 1, dtype=np.uint64) * _B)
#: Odd factors that order the hashes anew for each sketch and each bit; 32 bits are enough to find the least ones.
_SEEDS = ((_KEYS >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]
_FACTORS = ((_mix(np.arange(1001, 1001 + SIGNATURE_BITS, dtype=np.uint64) * _B) >> np.uint64(32)).astype(np.uint32) | np.uint32(1))[:, None]


def _least(short: np.ndarray) -> np.ndarray:
    """The positions of the ``SMALLEST`` least hashes of each sketch, in text order."""
    rows, step = np.arange(SKETCHES), max(1, _CELLS // SIGNATURE_BITS)
    values, places = [], []
    for at in range(0, len(short), step):
        h = short[None, at : at + step] * _SEEDS
        for _ in range(min(SMALLEST, h.shape[1])):
            p = h.argmin(axis=1)
            values.append(h[rows, p]), places.append(p + at)
            h[rows, p] = _TOP
    out = np.stack(places, 1)
    if len(places) > SMALLEST:
        out = np.take_along_axis(out, np.argsort(np.stack(values, 1), axis=1, kind="stable")[:, :SMALLEST], 1)
    out.sort(axis=1)
    return out


def _signature(short: np.ndarray) -> np.ndarray:
    """The least hash of each bit's order."""
    step = max(1, _CELLS // SIGNATURE_BITS)
    return np.minimum.reduce([(short[None, at : at + step] * _FACTORS).min(axis=1) for at in range(0, len(short), step)])


def sketches(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The numbers of the texts that have k-mers, their Order MinHash keys, and their signatures in 64-bit words."""
    grams, counts = kmers(texts)
    rows = np.flatnonzero(counts)
    if not len(rows):
        return rows, np.zeros((0, SKETCHES), np.uint64), np.zeros((0, _WORDS), np.uint64)
    x = _labelled(grams, counts)
    high, plain = (x >> np.uint64(32)).astype(np.uint32), (grams >> np.uint64(32)).astype(np.uint32)
    ends = np.cumsum(counts)
    key, least = np.tile(_KEYS, (len(rows), 1)), np.empty((len(rows), SIGNATURE_BITS), np.uint32)
    places: dict[int, list] = {}
    for n, row in enumerate(rows):
        a, b = ends[row] - counts[row], ends[row]
        least[n] = _signature(plain[a:b])
        found = _least(high[a:b]) + a
        places.setdefault(found.shape[1], []).append((n, found))
    for width, some in places.items():  # shorter texts have fewer k-mers than a sketch holds
        who, at = [n for n, _ in some], np.stack([found for _, found in some])
        own = key[who]
        for i in range(width):
            own = _mix(own * _B + x[at[:, :, i]])
        key[who] = own
    bits = (_mix(least.astype(np.uint64)) >> np.uint64(40)) & np.uint64(1)
    words = (bits.reshape(len(rows), -1, 64) << np.arange(64, dtype=np.uint64)).sum(axis=2, dtype=np.uint64)
    return rows, key, words


def _sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["key", "tkey", *(f"b{i}" for i in range(_WORDS))]
    for batch in batches:
        tkeys, texts = batch.column("tkey"), batch.column("text").to_pylist()
        edges = np.flatnonzero(np.diff(np.cumsum([0, *map(len, texts)]) // _CHARACTERS)) + 1
        for a, b in zip([0, *edges], [*edges, len(texts)]):
            rows, keys, words = sketches(texts[a:b])
            take = np.repeat(rows + a, SKETCHES)
            wide = np.repeat(words, SKETCHES, axis=0).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.reshape(-1).view(np.int64)), tkeys.take(pa.array(take)), *(pa.array(wide[:, i].copy()) for i in range(_WORDS))], names=names
            )


def record_texts(instances: DataFrame) -> DataFrame:
    """(id, text): lower-cased title, a blank and the description, runs of blanks as one, none at the ends."""
    whole = F.concat_ws(" ", F.lower(F.coalesce("title", F.lit(""))), F.lower(F.coalesce("description", F.lit(""))))
    return instances.select("id", F.trim(F.regexp_replace(whole, r"[ \t\r\n]+", " ")).alias("text")).where(F.col("id").isNotNull())


def _overlap(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    grams = lambda t: {t[i : i + K] for i in range(len(t) - K + 1)}
    for pdf in batches:
        kept: dict[bytes, set] = {}
        share = []
        for ka, a, kb, b in zip(pdf["tkey_a"], pdf["text_a"], pdf["tkey_b"], pdf["text_b"]):
            if len(kept) > 2000:
                kept.clear()
            x = kept.setdefault(ka, None) or kept.__setitem__(ka, grams(a)) or kept[ka]
            y = kept.setdefault(kb, None) or kept.__setitem__(kb, grams(b)) or kept[kb]
            both = len(x & y)
            share.append(both / (len(x) + len(y) - both))
        yield pdf.assign(jaccard=share)


def word_code(text: str) -> str:
    """The text with each word (or piece of one) as one letter."""
    return "".join([chr(_CODE_FIRST + zlib.crc32(w.encode("utf-8", "surrogatepass")) % _CODE_SIZE) for w in _PIECES.findall(text)])


def _with_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        codes = pa.array([word_code(t) for t in batch.column("text").to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, codes], names=[*batch.schema.names, "words"])


def _aligned(threshold: float) -> Column:
    """Whether the words of ``words_a`` and ``words_b`` align within the band of ``threshold``, as they stand or sorted."""
    both = "char_length(words_a) + char_length(words_b)"
    band = f"cast(ceil({(1 - threshold) / (1 + threshold)} * ({both})) as int)"
    wide = f"cast(ceil({SORTED_BAND * (1 - threshold) / (1 + threshold)} * ({both})) as int)"
    ordered = lambda c: f"array_join(array_sort(split({c}, '')), '')"
    return F.expr(f"levenshtein(words_a, words_b, {band}) >= 0 OR levenshtein({ordered('words_a')}, {ordered('words_b')}, {wide}) >= 0")


def candidates(texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of distinct texts that share a sketch and whose signatures agree well enough: ``tkey_a, tkey_b``."""
    sketches = texts.select("tkey", "text").mapInArrow(_sketches, "key long, tkey binary, " + ", ".join(f"b{i} long" for i in range(_WORDS)))
    a, b = (sketches.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("tkey", *(f"b{i}" for i in range(_WORDS))))).hint("merge") for s in "ab")
    p = (1 + threshold) / 2
    least = int(SIGNATURE_BITS * (p - DEVIATIONS * (p * (1 - p) / SIGNATURE_BITS) ** 0.5))
    apart = sum((F.bit_count(F.col(f"b{i}_a").bitwiseXOR(F.col(f"b{i}_b"))) for i in range(_WORDS)), F.lit(0))
    return a.join(b, "key").where((F.col("tkey_a") < F.col("tkey_b")) & (apart <= SIGNATURE_BITS - least)).select("tkey_a", "tkey_b").distinct()


def _with_both(pairs: DataFrame, texts: DataFrame, column: str) -> DataFrame:
    """Pairs of classes with a column of both texts."""
    for side in "ab":
        pairs = pairs.hint("merge").join(texts.select(F.col("tkey").alias(f"tkey_{side}"), F.col(column).alias(f"{column}_{side}")).hint("merge"), f"tkey_{side}")
    return pairs


def class_pairs(texts: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Verified pairs of distinct texts ``(tkey, text, words)``: ``tkey_a, tkey_b, jaccard``."""
    close = _with_both(candidates(texts, threshold), texts, "words").where(_aligned(threshold)).select("tkey_a", "tkey_b")
    measured = _with_both(close, texts, "text").mapInPandas(_overlap, "tkey_b binary, tkey_a binary, text_a string, text_b string, jaccard double")
    return measured.where(F.col("jaccard") >= threshold).select("tkey_a", "tkey_b", "jaccard")


def _classes(instances: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The members of each class (``id, tkey, part, parts``) and the distinct texts (``tkey, text, first_id, n, words``).

    A class of many copies is cut into ``parts`` of about ``PART`` members, so that no class is one task.
    """
    own = record_texts(instances).select("id", F.unhex(F.md5(F.encode("text", "utf-8"))).alias("tkey"), "text").where(F.char_length("text") >= K)
    # One row per id and text, so that repeated rows of an id count once.
    once = own.groupBy("id", "tkey").agg(F.first("text").alias("text"))
    texts = once.groupBy("tkey").agg(F.first("text").alias("text"), F.min("id").alias("first_id"), F.count("*").alias("n"))
    texts = staged(texts.mapInArrow(_with_codes, "tkey binary, text string, first_id string, n long, words string"), "neartexts")
    parts = texts.select("tkey", F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    members = own.select("id", "tkey").distinct().hint("merge").join(parts.hint("merge"), "tkey")
    return staged(members.withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")), "nearmembers"), texts


def _with_members(left: DataFrame, key: str, members: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """``left`` joined with the members of the class in ``key``: its rows are repeated for each part of the class."""
    parts = texts.select(F.col("tkey").alias(key), F.ceil(F.col("n") / PART).cast("int").alias("parts"))
    spread = left.hint("merge").join(parts.hint("merge"), key).withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts")
    right = members.select(F.col("tkey").alias(key), "part", F.col("id").alias(name))
    return spread.hint("merge").join(right.hint("merge"), [key, "part"]).drop("part")


def found_pairs(instances: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of records whose sets of distinct k-mers share at least ``threshold`` of their union, smaller id first."""
    members, texts = _classes(instances)
    pairs = class_pairs(texts, threshold).select("tkey_a", "tkey_b")
    apart = _with_members(_with_members(pairs, "tkey_a", members, texts, "x"), "tkey_b", members, texts, "y").select("x", "y")
    several = members.hint("merge").join(texts.where("n > 1").select("tkey").hint("merge"), "tkey", "left_semi")
    same = _with_members(several.select(F.col("id").alias("x"), F.col("tkey").alias("tkey_a")), "tkey_a", several, texts, "y").where("x < y").select("x", "y")
    return apart.unionByName(same).select(F.least("x", "y").alias("id_a"), F.greatest("x", "y").alias("id_b"))


def linked_classes(instances: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Pairs of different texts, each by its least record: ``id_a, id_b, jaccard``. With ``classes`` it holds what
    ``found_pairs`` does, copies not expanded."""
    _, texts = _classes(instances)
    pairs = _with_both(class_pairs(texts, threshold), texts, "first_id")
    return pairs.select(F.least("first_id_a", "first_id_b").alias("id_a"), F.greatest("first_id_a", "first_id_b").alias("id_b"), F.round("jaccard", 6).alias("jaccard"))


def classes(instances: DataFrame) -> DataFrame:
    """``id, class_id, n_copies``: the class of equal texts of each record, named by its least record. A record too short
    to have k-mers is a class of its own."""
    members, texts = _classes(instances)
    known = members.select("id", "tkey").hint("merge").join(texts.select("tkey", "first_id", "n").hint("merge"), "tkey").select("id", F.col("first_id").alias("class_id"), F.col("n").alias("n_copies"))
    rest = record_texts(instances).where(F.char_length("text") < K).select("id", F.col("id").alias("class_id"), F.lit(1).cast("long").alias("n_copies")).distinct()
    return known.unionByName(rest)


def components(edges: DataFrame) -> DataFrame:
    """(node, component): the least node that each node of the undirected edges ``(u, v)`` is linked with.

    Alternating large-star and small-star rounds, each written to the shared folder, until the edges stand still.
    """
    now = staged(edges.select("u", "v").where("u <> v").distinct(), "edges")
    before = None
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
        now = staged(small.where("u <> v").distinct(), "edges")
        state = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
                now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            )
        before = state


def groups(instances: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per record: ``id``, ``group_id`` (the least id linked with it) and ``n_links`` (its pairs to other texts'
    classes plus its copies)."""
    members, texts = _classes(instances)
    edges = staged(_with_both(class_pairs(texts, threshold), texts, "first_id").select(F.col("first_id_a").alias("u"), F.col("first_id_b").alias("v")), "nearpairs")
    comp = components(edges).select(F.col("node").alias("first_id"), "component")
    degree = edges.select("u").unionAll(edges.select("v")).groupBy(F.col("u").alias("first_id")).agg(F.count("*").alias("links"))
    named = texts.select("tkey", "first_id", "n").hint("merge").join(comp.hint("merge"), "first_id", "left").hint("merge").join(degree.hint("merge"), "first_id", "left").select(
        "tkey", F.coalesce("component", "first_id").alias("group_id"), (F.coalesce("links", F.lit(0)) + F.col("n") - 1).cast("long").alias("n_links")
    )
    known = members.select("id", "tkey").hint("merge").join(named.hint("merge"), "tkey").select("id", "group_id", "n_links")
    rest = record_texts(instances).where(F.char_length("text") < K).select("id", F.col("id").alias("group_id"), F.lit(0).cast("long").alias("n_links")).distinct()
    return known.unionByName(rest)
