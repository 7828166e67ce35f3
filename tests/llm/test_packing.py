import random
from collections import defaultdict

import pytest

from citeloom.llm.packing import fill_report, first_fit_decreasing, packed
from citeloom.llm.tokens import VOCABULARY, encoder

DOC = "doc_id long, text string, lang string, n_tokens long, bin_group string"


def slow(sizes, capacity):
    rooms, out = [], []
    for s in sizes:
        at = next((i for i, r in enumerate(rooms) if r >= s), len(rooms))
        if at == len(rooms):
            rooms.append(capacity)
        rooms[at] -= s
        out.append(at)
    return out


def test_tree_equals_plain_first_fit():
    rnd = random.Random(1)
    for n in (0, 1, 2, 7, 200):
        sizes = sorted((rnd.randint(0, 50) for _ in range(n)), reverse=True)
        assert first_fit_decreasing(sizes, 50) == slow(sizes, 50)


def test_every_token_once_and_no_container_too_full(spark):
    rnd = random.Random(2)
    texts = [None, "", "one word", "long text " * 400] + ["some words of a text " * rnd.randint(1, 20) for _ in range(120)]
    docs = spark.createDataFrame([(i, t, "en", 5, "clash") for i, t in enumerate(texts)], DOC)
    specs = spark.createDataFrame([("a", 64), ("b", 256), ("none", None), ("zero", 0)], "spec_id string, capacity_tokens int")
    rows = packed(docs, specs, group_documents=40).collect()
    size = [len(encoder(VOCABULARY).encode_ordinary(t)) if t else 0 for t in texts]
    for spec, capacity in (("a", 64), ("b", 256)):
        room, spans = defaultdict(int), defaultdict(list)
        for r in rows:
            if r.spec_id == spec:
                room[r.container_id] += r.n_tokens
                spans[r.doc_id].append((r.start_token, r.end_token))
        assert max(room.values()) <= capacity
        assert set(spans) == set(range(len(texts)))
        for doc, parts in spans.items():
            parts.sort()
            assert parts[0][0] == 0 and parts[-1][1] == size[doc] and all(a[1] == b[0] for a, b in zip(parts, parts[1:]))
            assert len(parts) == max(1, -(-size[doc] // capacity))
    assert {r.spec_id for r in rows} == {"a", "b"}
    assert all(0.7 < r.filled_share <= 1 for r in fill_report(packed(docs, specs), specs).collect())


def test_no_documents(spark):
    specs = spark.createDataFrame([("a", 64)], "spec_id string, capacity_tokens int")
    assert packed(spark.createDataFrame([], DOC), specs).count() == 0
    with pytest.raises(FileNotFoundError):
        encoder("/nowhere")
