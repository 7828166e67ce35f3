from citeloom.llm.mixing import mixed, rates, shares, sized_documents

DOC = "doc_id long, text string, source string, rate string"
PLAN = "plan_id string, source string, target_share double, max_repeats int, budget_share double"


def test_shares_and_caps(spark):
    docs = [(i, "ten words are here to be counted one by one " * 4, " Big " if i % 2 else "big", "x") for i in range(2000)]
    docs += [(10_000 + i, "ten words are here to be counted one by one " * 4, "small", "x") for i in range(50)]
    docs += [(20_000, None, "small", "x"), (20_001, "text", None, "x"), (20_002, "text", "", "x")]
    df = spark.createDataFrame(docs, DOC)
    plan = spark.createDataFrame(
        [("p", "big", 0.3, 1, 0.4), ("p", "small", 0.1, 3, 0.4), ("p", "absent", 0.1, 5, 0.4), ("q", "SMALL", 0.5, 2, 0.01), ("q", "big", None, None, 0.01)], PLAN
    )
    sized = sized_documents(df)
    rate = {(r.plan_id, r.source): r for r in rates(sized, plan).collect()}
    assert rate["p", "small"].rate == 3.0 and rate["p", "absent"].rate == 0.0 and rate["q", "big"].rate == 0.0
    rows = mixed(sized, plan).collect()
    assert all(r.repeats <= {"big": 1, "small": 3}[r.source] for r in rows)
    assert {r.repeats for r in rows if r.plan_id == "p" and r.source == "small"} == {3}
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mixed(sized.repartition(7), plan).collect()))
    got = {(r.plan_id, r.source): r for r in shares(sized, plan).collect()}
    assert abs(got["p", "big"].share_of_wanted_total - 0.6) < 0.06
    assert got["p", "absent"].drawn_tokens == 0 and got["q", "small"].actual_share == 1.0
    assert len(got) == 5


def test_empty(spark):
    sized = sized_documents(spark.createDataFrame([], DOC))
    plan = spark.createDataFrame([("p", "big", 0.3, 1, 0.2)], PLAN)
    assert mixed(sized, plan).count() == 0
    assert shares(sized, plan).first().actual_share == 0.0
    assert shares(sized, spark.createDataFrame([], PLAN)).count() == 0
