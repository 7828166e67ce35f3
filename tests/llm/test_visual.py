from citeloom.llm.visual import fold_columns, found_when_folded

INST = "id string, report_id string, page int, verbatim_span string, text string"
PAGE = "report_id string, page int, text string, id string"


def test_folding(spark):
    cases = {
        "Ｗｉｎｄ １１９": "Wind 119",
        "ﬁn a­b​c﻿": "fin abc",
        "é é ポ": "é é ポ",
        "хіоа ορ Κ": "xioa oρ K",
        "a  b\t\nc ": "a b c",
        "⾦属": "金属",
        "é ü ² ½ ①": "é ü ² ½ ①",
        "กำ น้ำ": "กำ น้ำ",
        "": "",
    }
    df = spark.createDataFrame([(k, "x") for k in cases] + [(None, "x")], "t string, t_extra string")
    got = {r["t"]: r["t_folded"] for r in fold_columns(df, ["t"]).collect()}
    assert got == {**cases, None: None}


def test_found(spark):
    inst = [
        ("same", "r", 1, "plain  words", "x"),
        ("wide", "r", 1, " ｐｌａｉｎ words ", "x"),
        ("accent", "r", 1, "pláin words", "x"),
        ("digit", "r", 1, "costs 17", "x"),
        ("page", "r", 2, "ｐｌａｉｎ words", "x"),
        ("null", "r", 1, None, "x"),
        ("blank", "r", 1, " ​", "x"),
        ("nopage", "r", None, "ｐｌａｉｎ", "x"),
        ("cyr", "r", 1, "соsts 18", "x"),
    ]
    pages = [("r", 1, "some plain\nwords, costs 18", "c"), ("r", 1, "some plain\nwords, costs 18", "c"), ("r", 2, None, "c"), (None, None, "ｐｌａｉｎ", "c")]
    got = found_when_folded(spark.createDataFrame(inst, INST), spark.createDataFrame(pages, PAGE)).collect()
    assert sorted(r[0] for r in got) == ["cyr", "wide"]
    assert found_when_folded(spark.createDataFrame([], INST), spark.createDataFrame([], PAGE)).count() == 0
