"""Problem 6: filling containers of fixed capacity.

Method: first-fit decreasing with a tournament tree of the room left in each container (the leftmost container with
enough room is found and updated in a logarithmic number of steps), independently in randomised groups of documents.
A document goes to a group by the hash of its id, so groups are alike in size whatever company or source is hot, and
each is one bounded task; one shuffle of ids and sizes serves all capacities.

A document larger than the capacity is cut: full pieces fill a container each, the last piece is packed like any other
item. Nothing else is ever split.

Defined results: null and empty texts have size 0 and go into the first container of their group; ties are broken by
id; capacities that are null or below 1 are ignored; no documents give no rows. Ids are expected to be unique.
"""

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.tokens import VOCABULARY, with_token_counts

#: Documents in a group on average, and the most capacities in one call.
GROUP_DOCUMENTS, MOST_SPECS = 8_000, 1_000
MOST_TASKS = 10_000


def first_fit_decreasing(sizes: list[int], capacity: int) -> list[int]:
    """The container of each item; ``sizes`` must not increase and not exceed ``capacity``."""
    leaves = 1
    while leaves < len(sizes):
        leaves *= 2
    room = [capacity] * (2 * leaves)
    out = []
    for size in sizes:
        at = 1
        while at < leaves:
            at *= 2
            if room[at] < size:
                at += 1
        out.append(at - leaves)
        room[at] -= size
        at //= 2
        while at:
            best = max(room[2 * at], room[2 * at + 1])
            if room[at] == best:
                break
            room[at] = best
            at //= 2
    return out


def _pack(pdf: pd.DataFrame, specs: list[tuple[str, int]]) -> pd.DataFrame:
    group = int(pdf["bin_group"].iloc[0])
    docs = sorted(zip(pdf["n_tokens"].tolist(), pdf["doc_id"].tolist()), key=lambda x: (-x[0], x[1]))
    rows = []
    for spec, capacity in specs:
        full, items = [], []
        for size, doc in docs:
            whole = size // capacity if size > capacity else 0
            full += [(doc, p, p * capacity, (p + 1) * capacity) for p in range(whole)]
            if size > whole * capacity or not whole:
                items.append((size - whole * capacity, doc, whole, whole * capacity, size))
        items.sort(key=lambda x: (-x[0], x[1]))
        bins = first_fit_decreasing([x[0] for x in items], capacity)
        used = max(bins, default=-1) + 1
        base = group << 32
        rows += [(spec, base + b, doc, p, a, z, z - a) for b, (_, doc, p, a, z) in zip(bins, items)]
        rows += [(spec, base + used + i, doc, p, a, z, z - a) for i, (doc, p, a, z) in enumerate(full)]
    return pd.DataFrame(rows, columns=["spec_id", "container_id", "doc_id", "piece", "start_token", "end_token", "n_tokens"])


def packed(documents: DataFrame, specs: DataFrame, vocabulary: str = VOCABULARY, group_documents: int = GROUP_DOCUMENTS) -> DataFrame:
    """One row per document (per piece of an oversized one) and spec:
    ``spec_id, container_id, doc_id, piece, start_token, end_token, n_tokens``."""
    wanted = specs.where("capacity_tokens >= 1").select("spec_id", "capacity_tokens").distinct().limit(MOST_SPECS + 1).collect()
    if len(wanted) > MOST_SPECS:
        raise ValueError(f"more than {MOST_SPECS} capacities in one call")
    sizes = [(r[0], r[1]) for r in sorted(wanted)]
    groups = max(1, -(-documents.count() // group_documents))
    counted = with_token_counts(documents, "text", ["doc_id"], vocabulary)
    kind = dict(documents.dtypes)["doc_id"]
    return (
        counted.withColumn("bin_group", F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(groups)).cast("int"))
        # Ids and sizes are few bytes and packing is work: left to sizes, the groups would be merged into one task.
        .repartition(min(groups, MOST_TASKS), "bin_group")
        .groupBy("bin_group")
        .applyInPandas(lambda pdf: _pack(pdf, sizes), f"spec_id string, container_id long, doc_id {kind}, piece int, start_token long, end_token long, n_tokens long")
    )


def fill_report(assignment: DataFrame, specs: DataFrame) -> DataFrame:
    """Per spec: containers, tokens in them and the share of their room that is filled."""
    used = assignment.groupBy("spec_id").agg(F.countDistinct("container_id").alias("containers"), F.sum("n_tokens").alias("n_tokens"), F.count("*").alias("pieces"))
    return used.join(specs.select("spec_id", "capacity_tokens").distinct(), "spec_id").select(
        "spec_id", "containers", "pieces", "n_tokens", F.round(F.col("n_tokens") / (F.col("containers") * F.col("capacity_tokens")), 6).alias("filled_share")
    )
