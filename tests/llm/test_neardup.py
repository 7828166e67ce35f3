import random

from citeloom.llm.neardup import K, _aligned, classes, components, found_pairs, groups, linked_classes, word_code

SCHEMA = "id string, title string, description string, text string"


def grams(t):
    return {t[i : i + K] for i in range(len(t) - K + 1)}


def brute(rows, threshold=0.7):
    texts = {r[0]: grams(" ".join(((r[1] or "") + " " + (r[2] or "")).lower().split())) for r in rows if r[0] is not None}
    ids = sorted(texts)
    return {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if texts[a] | texts[b] and len(texts[a] & texts[b]) >= threshold * len(texts[a] | texts[b])}


def rows(seed, n):
    rnd = random.Random(seed)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyzéи") for _ in range(rnd.randint(3, 9))) for _ in range(400)]
    out, base = [], []
    for i in range(n):
        if base and rnd.random() < 0.6:
            w = list(rnd.choice(base))
            for _ in range(rnd.randint(0, 6)):
                k = rnd.randrange(len(w))
                rnd.choice([lambda: w.insert(k, rnd.choice(words)), lambda: w.__setitem__(k, rnd.choice(words)), lambda: w.pop(k)])()
            if rnd.random() < 0.2:
                k = len(w) // 2
                w = w[k:] + w[:k]
        else:
            w = [rnd.choice(words) for _ in range(40)]
        base.append(w)
        out.append((f"r{i:03d}", rnd.choice([None, "", "Kop"]), " ".join(w).replace(" ", "\n ", 2), "clash"))
    return out + [("n1", None, None, None), ("n2", "", "", None), ("n3", "abc", None, None), (None, "t", "some text here", None), ("lng", "x", "lang " * 20000, None), ("lng2", "x", "lang " * 20000, None), out[0]]


def test_pairs_equal_brute_force_and_groups_follow(spark):
    data = rows(3, 150)
    df = spark.createDataFrame(data, SCHEMA)
    want = brute(data)
    got = [tuple(r) for r in found_pairs(df).collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 50
    parent = {r[0]: r[0] for r in data if r[0]}
    find = lambda x: x if parent[x] == x else find(parent[x])
    for a, b in want:
        x, y = sorted((find(a), find(b)))
        parent[y] = x
    assert {r["id"]: r["group_id"] for r in groups(df).collect()} == {i: find(i) for i in parent}


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert found_pairs(empty).count() == 0 and groups(empty).count() == 0


def test_components_of_a_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(0, 20)] + [(50, 40), (40, 45), (7, 7)], "u int, v int")
    got = {r["node"]: r["component"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(21)}, 40: 40, 45: 40, 50: 40}


def test_many_copies_are_joined_in_parts(spark, monkeypatch):
    import citeloom.llm.neardup as neardup

    monkeypatch.setattr(neardup, "PART", 7)
    text = "the same words stand in all of these records"
    rows = [(f"a{i:02d}", "t", text, None) for i in range(40)] + [(f"b{i:02d}", "t", text + " x", None) for i in range(20)]
    got = [tuple(r) for r in found_pairs(spark.createDataFrame(rows, SCHEMA)).collect()]
    assert len(got) == len(set(got)) == 60 * 59 // 2


def plan_of(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_alignment_is_in_the_plan_and_no_join_is_broadcast(spark):
    df = spark.createDataFrame(rows(5, 40), SCHEMA)
    optimized, physical = plan_of(found_pairs(df))
    assert "levenshtein" in optimized and "Broadcast" not in physical


def test_alignment_keeps_edits_and_moves_and_rejects_other_texts(spark):
    rnd = random.Random(9)
    words = ["".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rnd.randint(2, 12))) for _ in range(300)]
    base = [rnd.choice(words) for _ in range(90)]
    parts = [base[i : i + 9] for i in range(0, 90, 9)]
    edited = [w if i % 12 else w[::-1] for i, w in enumerate(base)]
    turned = [w for p in reversed(parts) for w in p]
    other = [rnd.choice(words) for _ in range(90)]
    dense = "保险只覆盖树脂须自行承担其余损失董事会认为钢材价格上涨可能影响利润率和现金流" * 3
    cases = [(edited, base, True), (turned, base, True), (turned, edited, True), (other, base, False)]
    data = [(word_code(" ".join(a)), word_code(" ".join(b)), want) for a, b, want in cases] + [(word_code(dense), word_code(dense[40:] + dense[:40]), True), (word_code(""), word_code(""), True)]
    got = spark.createDataFrame(data, "words_a string, words_b string, want boolean").select(_aligned(0.7).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


def test_classes_and_their_links_hold_the_pairs(spark):
    df = spark.createDataFrame(rows(8, 120), SCHEMA)
    member = {r["id"]: r["class_id"] for r in classes(df).collect()}
    links = {(r["id_a"], r["id_b"]) for r in linked_classes(df).collect()}
    ids = sorted(member)
    spelled = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if member[a] == member[b] or tuple(sorted((member[a], member[b]))) in links}
    assert spelled == {tuple(r) for r in found_pairs(df).collect()}
    sizes = {r["id"]: r["n_copies"] for r in classes(df).collect()}
    assert all(sizes[i] == sum(member[j] == member[i] for j in ids) for i in ids)
