import json

import numpy as np
import pytest

from citeloom.llm import replies as module
from citeloom.llm.replies import ChainField, clauses, defects, language, unwrap, wanted_language

SCHEMA = "call_id string, messages array<struct<role:string,content:string>>, response_content string, created_at timestamp, kind string"
ASK = "\n\nGive a short title and describe the risk in two or three sentences."
PRINTED = [
    "The group depends on Kalnixor for resin, while Bomtexal supplies only 5% of it.",
    "Weather losses at Zerhomut reached 20 mn euros in 2024 and were not insured.",
    "Under the permit the Tolvanik plant must limit gravel, which is not easy.",
    "If model error persists beyond 2025, Rutnalpo may have to extend its contract.",
    "Costs of bolts rose by 12% and Munterax passed them on to Sillervo.",
]
GERMAN = "Die Rückstellung von Raknutgur deckt den Schaden nicht ab. Das Werk muss die Prüfung bis 2027 nachholen und kann nicht liefern."


def row(call, reply, user="Heading: X\n" + PRINTED[0] + ASK, kind="describe", when="2025-01-01 00:00:00"):
    import datetime

    return (f"{kind}-{call}", [("system", "s"), ("user", user)], reply, datetime.datetime.fromisoformat(when), "clash")


def answer(text):
    return json.dumps({"title": "t", "description": text}, ensure_ascii=False)


@pytest.fixture(scope="module")
def found(spark):
    rows = []
    for i in range(60):
        a, b = PRINTED[1 + i % 4], PRINTED[1 + (i + 1 + i // 4) % 4]
        a, b = (s.replace("al", f"a{'bcdfgh'[i % 6]}").replace("ut", f"u{'klmnpr'[i // 10]}") for s in (a, b))
        rows.append(row(f"ok{i}", answer(f"{a} {b}")))
    rows += [row(f"de{i}", answer(GERMAN), "Heading: X\nDatenverlust kann die Marge mindern und das Werk belasten." + "\n\nGib einen kurzen Titel an und beschreibe das Risiko in zwei Sätzen.") for i in range(8)]
    cases = {
        "null": None, "blank": " \n", "braces": "{}", "jnull": "null", "zw": answer("​"), "na": answer("N/A"), "fence": "```json\n\n```", "nodesc": json.dumps({"title": "t"}),
        "cutjson": '{"title": "t", "description": "Weather losses at', "cut": answer(PRINTED[1] + " Under the permit the Tolvanik plant must"), "nostop": answer(PRINTED[1] + " " + PRINTED[2].rstrip(".")),
        "refuse": "I’m sorry, but I can’t help with describing this risk.", "refuse_fr": answer("Je suis désolé, je ne peux pas répondre à cette demande."),
        "copy": answer(PRINTED[0].upper()), "copyall": "“Heading: X\n" + PRINTED[0] + ASK + "”", "quoting": answer(PRINTED[0] + " " + PRINTED[1] + " " + PRINTED[2]), "german": answer(GERMAN),
        "fenced": "```json\n" + answer(PRINTED[3] + " " + PRINTED[4]) + "\n```",
    }
    rows += [row(k, v) for k, v in cases.items()]
    rows += [row("twice", answer("-")), row("twice", answer("-"), when="2025-02-01 00:00:00"), (None, [("user", "x")], "x", None, None), ("describe-nomsg", None, "x y", None, None)]
    question = "What is new for Kalnixor on bolts?"
    rows += [row("q1", '{"companies": []}', question, "intent"), row("q2", '{"companies": [', question, "intent"), row("q3", question.upper(), question, "intent"), row("q4", "No puedo ayudar con eso.", question, "intent")]
    return {r[0].partition("-")[2] if not r[0].startswith("intent") else r[0]: r[1] for r in defects(spark.createDataFrame(rows, SCHEMA)).collect()}


def test_defects(found):
    want = {k: "empty" for k in ("null", "blank", "braces", "jnull", "zw", "na", "fence", "nodesc", "twice")}
    want |= {"cutjson": "truncated", "cut": "truncated", "refuse": "refusal", "refuse_fr": "refusal", "copy": "copy", "copyall": "copy", "german": "language"}
    want |= {"intent-q2": "truncated", "intent-q3": "copy", "intent-q4": "refusal"}
    assert {k: v for k, v in found.items() if k != "nomsg"} == want


def test_every_user_message_is_read(spark):
    """A later user message may be copied, and may ask for another language."""
    rows = [row(f"ok{i}", answer(f"{PRINTED[1 + i % 4]} {PRINTED[1 + (i + 1) % 4]}")) for i in range(40)]
    first, draft = "Heading: X\n" + PRINTED[0] + ASK, ("assistant", PRINTED[1])
    late = "The draft is too short. Write the whole description again, please."
    rows += [
        ("repair-copy", [("system", "s"), ("user", first), draft, ("user", late)], answer(late.upper()), None, None),
        ("repair-ask", [("user", first), draft, ("user", "Heading: Y\n\nAnswer in German.\n\nKeep it short.")], answer(GERMAN), None, None),
        ("repair-not", [("user", first), draft, ("user", late)], answer(GERMAN), None, None),
    ]
    got = {r[0]: r[1] for r in defects(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {"repair-copy": "copy", "repair-not": "language"}


def test_declining_and_languages_on_sentences_held_out():
    """Half of the refusals are scored by weights that have not seen them, next to ordinary sentences."""
    pairs = [([f"{PRINTED[i % 5]}" + ASK], f"{PRINTED[(i + 1) % 5]} {PRINTED[(i + 2) % 5]}") for i in range(10)]
    ngrams, halves = module.fit_ngrams(pairs)
    right = [x > 0 for some, model in halves for x in model.scores(some)]
    assert len(right) == len(module._all_refusals()) and np.mean(right) > 0.75
    assert np.mean(ngrams.scores(PRINTED) < 0) == 1
    assert ngrams.languages([GERMAN, PRINTED[0], "Le présent rapport décrit les risques de la société.", "x"]) == ["de", "en", "fr", None]


def test_no_calls(spark):
    assert defects(spark.createDataFrame([], SCHEMA)).count() == 0


def test_language_and_instruction():
    assert language("保险只覆盖Posfemdür的树脂，须自行承担其余。") == "zh"
    assert language("Kekbensixがポンプの供給を止めた場合") == "ja"
    assert wanted_language("Текст\n\nWrite the reply in English, whatever the language of the text.") == "en"
    assert wanted_language("Some text of the page\n\nDonne un titre court et décris le risque en deux ou trois phrases.") == "fr"
    assert unwrap('{"a": "}', "describe") == ('{"a": "}', True)
    assert clauses("One. Two! 三。四。") == ["One.", "Two!", "三。", "四。"]


def test_chain_field_learns_emissions_and_moves():
    rnd = np.random.default_rng(0)
    data = []
    for _ in range(300):
        y = [0]
        while len(y) < 6:
            y.append(y[-1] if rnd.random() < 0.9 else 1 - y[-1])
        y = np.array(y)
        seen = np.where(rnd.random(6) < 0.75, y, 1 - y)
        data.append((np.stack([np.ones(6), seen], 1).astype(float), y))
    field = ChainField.fit(data[:200], 2)
    right = np.mean([np.mean(np.array(field.tag(x)) == y) for x, y in data[200:]])
    assert right > 0.85  # above the 0.75 of the emissions alone


def test_rare_shapes_count_in_a_large_table(spark, data, monkeypatch):
    calls = spark.read.parquet(f"{data}/calls.parquet")
    judged = module.judged_calls(calls)
    fields, found = [], []
    for share in (0.0, 1e-3, 9.0):
        monkeypatch.setattr(module, "MIN_SHARE", share)  # as on ever larger data
        counts, rare = module.corpus_counts(judged)
        fields.append(module.train(judged, counts, rare=rare))
        found.append(sorted(map(tuple, module.defects(calls).collect())))
    assert found[0] == found[1] == found[2] and found[0]
    assert all((f.emit == fields[0][0].emit).all() and (f.move == fields[0][0].move).all() for f, _ in fields)
