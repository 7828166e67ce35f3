import random

from citeloom.llm.spans import longest_shared, shared_report, shared_spans

INST = "id string, description string, verbatim_span string, page int, note string"
CITE = "risk_instance_id string, page int, span string, field string"


def brute(units, min_len):
    out = set()
    for rid, field, page, text in units:
        if text is None:
            continue
        covered = [False] * len(text)
        for p in range(len(text) - min_len + 1):
            w = text[p : p + min_len]
            if any(o != rid and t is not None and w in t for o, _, _, t in units):
                covered[p : p + min_len] = [True] * min_len
        p = 0
        while p < len(text):
            if covered[p]:
                q = p
                while q < len(text) and covered[q]:
                    q += 1
                out.add((rid, field, page, p, q))
                p = q
            p += 1
    return out


def random_case(seed, n=40):
    rnd = random.Random(seed)
    word = lambda k: "".join(rnd.choice("abcdeé漢 ") for _ in range(k))
    pool = [word(rnd.randint(100, 260)) for _ in range(8)] + ["ab" * 90, "a" * 200]
    text = lambda: rnd.choice([None, "", word(50), word(rnd.randint(0, 90)) + rnd.choice(pool)[rnd.randint(0, 40) :] + word(rnd.randint(0, 90)), rnd.choice(pool)])
    inst = [(f"r{i:02d}", text(), text(), rnd.choice([None, 1, 2]), "x") for i in range(n)]
    cite = [(f"r{rnd.randrange(n):02d}", rnd.choice([1, 2, None]), text(), "clash") for _ in range(n // 2)]
    return inst, cite + cite[:5]


def test_matches_brute_force(spark):
    for seed in (1, 2):
        inst, cite = random_case(seed)
        got = shared_spans(spark.createDataFrame(inst, INST), spark.createDataFrame(cite, CITE)).collect()
        units = [(r[0], "description", r[3], r[1]) for r in inst] + [(r[0], "verbatim_span", r[3], r[2]) for r in inst]
        units += [(c[0], "span", c[1], c[2]) for c in dict.fromkeys(cite)]
        want = brute(units, 120)
        assert want and sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_empty_tables_and_own_repeats(spark):
    inst, cite = spark.createDataFrame([], INST), spark.createDataFrame([], CITE)
    assert shared_spans(inst, cite).count() == 0
    assert longest_shared(inst, cite).count() == 0
    one = spark.createDataFrame([("a", "x" * 300, "x" * 300, 1, None)], INST)
    assert shared_spans(one, cite).count() == 0
    assert [tuple(r) for r in shared_report(one, cite).collect()] == [("a", 600, 0, 0, 0.0)]


def test_levels_double_until_nothing_is_left(spark):
    rnd = random.Random(5)
    long = "".join(rnd.choice("abcdefgh") for _ in range(500))
    inst = spark.createDataFrame([("a", long, None, 1, None), ("b", "q" + long[:300], None, 1, None), ("c", long[400:], None, 1, None)], INST)
    got = {r[0]: r[1] for r in longest_shared(inst, spark.createDataFrame([], CITE), 50).collect()}
    assert got == {"a": 200, "b": 200, "c": 100}
