import pytest

from citeloom.llm import sentences as module
from citeloom.llm.sentences import corpus_evidence, evidence, record_sentences, sentences

CORPUS: dict = {}
for text in [
    "Dr. Fimmokjol expects delay, approx. 5% in 2027, and the board agrees.",
    "A default of Rurlonlox Inc. would hurt. Weather losses rose. See p. 12 for more, e.g. bolts.",
    "It depends on Rurlonlox Inc.",
    "Stop! Weather is bad! Where is it? Where! Weather! The end.",
] * 40:
    for (kind, word), n in evidence(text).items():
        CORPUS[kind, word] = CORPUS.get((kind, word), 0) + n

CASES = {
    "": [],
    " \n ": [],
    "One sentence without a stop": ["One sentence without a stop"],
    "Dr. Kalnix left. Where is Dr. Bomtex now?": ["Dr. Kalnix left.", "Where is Dr. Bomtex now?"],
    "It sits with Dénpordal Inc. Weather losses rose by 3.5% (see p. 12), i.e. more.": ["It sits with Dénpordal Inc.", "Weather losses rose by 3.5% (see p. 12), i.e. more."],
    "The auditor wrote “Stocks are low. Lead times are long.” about it. He left.": ["The auditor wrote “Stocks are low. Lead times are long.” about it.", "He left."],
    "She said “Stop. Now.” Then we left…": ["She said “Stop. Now.”", "Then we left…"],
    "Costs rose… and fell! Good": ["Costs rose… and fell!", "Good"],
    "Lost blank.Where to go?": ["Lost blank.", "Where to go?"],
    "Two\nlines of one. Next\n- first item. With more\n- second one\nEnd of it.": ["Two\nlines of one.", "Next", "- first item. With more", "- second one\nEnd of it."],
    "Two:\n1. first.\n2. second.\nThe end.": ["Two:", "1. first.", "2. second.", "The end."],
    "管理层表示：“利率上升，必须应对。”审计人员写道：“库存偏低。”，而对此没有回应。": ["管理层表示：“利率上升，必须应对。”", "审计人员写道：“库存偏低。”，而对此没有回应。"],
    "監査人は「少ない。長い。」と記した。次の文？": ["監査人は「少ない。長い。」と記した。", "次の文？"],
    "डॉ. Ralgat के अनुसार रु. 5 करोड़। क्या हाँ?": ["डॉ. Ralgat के अनुसार रु. 5 करोड़।", "क्या हाँ?"],
    "หาก Nok หยุดส่งให้ Mol โครงการจะล่าช้ามาก ภัยแล้งที่ Rim ลดลง 5.5% และกระทบ Fen ด้วย": ["หาก Nok หยุดส่งให้ Mol โครงการจะล่าช้ามาก", "ภัยแล้งที่ Rim ลดลง 5.5% และกระทบ Fen ด้วย"],
    "يرى د. Rim أن التأمين يغطي! ماذا يحدث إذا توقفت؟ نعم.": ["يرى د. Rim أن التأمين يغطي!", "ماذا يحدث إذا توقفت؟", "نعم."],
    "« La hausse s’aggrave. Il faut agir », a écrit Nok. Que se passe-t-il si Mol ferme ?": ["« La hausse s’aggrave. Il faut agir », a écrit Nok.", "Que se passe-t-il si Mol ferme ?"],
    "​One.​ Two​.": ["One.", "Two​."],
}


@pytest.mark.parametrize("text", CASES)
def test_rules(text):
    assert [text[a:b] for a, b in sentences(text, CORPUS)] == CASES[text]


def test_document_comes_first():
    text = "The Abt. of tests and Abt. Kalnix met."
    assert len(sentences(text)) == 1
    assert len(sentences("We met the Abt. Kalnix met.")) == 2


def test_long_text_is_linear_and_whole():
    text = "A short sentence of words. " * 4000
    assert len(sentences(text, CORPUS)) == 4000


def test_tables(spark):
    schema = "id string, description string, verbatim_span string, field string, start_pos int"
    rows = [("a", "One. Two.", None, "x", 1), ("b", None, "", "x", 1), ("a", "One. Two.", " Three ", "x", 1)]
    got = sorted(map(tuple, record_sentences(spark.createDataFrame(rows, schema)).collect()))
    assert got == [("a", "description", 0, 4), ("a", "description", 0, 4), ("a", "description", 5, 9), ("a", "description", 5, 9), ("a", "verbatim_span", 1, 6)]
    empty = spark.createDataFrame([], schema)
    assert record_sentences(empty).count() == 0 and corpus_evidence(empty, "description") == {}


PARTS = ["Kabel", "Lager", "Harze", "Pumpen", "Rotoren"]


def test_rate_of_ends_is_the_same_at_any_size(spark):
    names = [f"Kal{k}" for k in "abcdefghijklmnopqrstuvwxyzabcdefghijklmnopqrstuvwxyz"]
    pairs = [(f"Es fehlen {PARTS[i % 5]} bzw. {PARTS[i % 4]} bei {n} wochenlang.", f"Die Reserve von {n} deckt das nicht.") for i, n in enumerate(names)]
    pairs += [(f"Der Bericht von {n} nennt “Lager sind leer. Fristen sind lang.” zum Anlass.", "Er ging danach.") for n in names]
    texts = [" ".join(p[:: (-1) ** (i // 3)]) for i, p in enumerate(pairs)]
    texts.append("Es fehlen Gussteile bzw.\nKabel bei Nok wochenlang. Die Reserve deckt das nicht.")
    texts.append("Die Lager sind leer. Kalnix ging.")
    for copies in (1, 10):
        rows = [(f"{i}-{c}", t, None) for c in range(copies) for i, t in enumerate(texts)]
        got: dict = {}
        for r in record_sentences(spark.createDataFrame(rows, "id string, description string, verbatim_span string")).collect():
            got.setdefault(r[0], []).append(r)
        for i, t in enumerate(texts):
            for c in range(copies):
                assert len(got[f"{i}-{c}"]) == 2, (copies, t)


def test_rare_words_count_in_a_large_corpus(spark, monkeypatch):
    texts = ["We met Abt. " + n + " and left. Weather losses rose." for n in ("Kal", "Bom", "Nok")] + ["See the Abt. of tests. It is open."] * 4
    texts += ["Stop! Weather is bad! Where is Prof. Kal.Where is it? “Stop.” Then we left. \n- one\nWhere now", "Costs rose. Prices fell."] * 30
    df = spark.createDataFrame([(str(i), t, None) for i, t in enumerate(texts)], "id string, description string, verbatim_span string")
    got = {}
    for share in (0.0, 2e-5, 0.06, 9.0):
        monkeypatch.setattr(module, "MIN_SHARE", share)  # as on ever larger data
        got[share] = sorted(map(tuple, record_sentences(df).collect()))
    assert len([r for r in got[0.0] if r[0] == "0"]) == 2
    assert got[0.0] == got[2e-5] == got[0.06] == got[9.0]


@pytest.mark.parametrize("marks", ["“”", "„“", "«»", "「」", "()", '""'])
def test_long_quotations_and_stray_marks(marks):
    quoted = marks[0] + "Stocks are low. Lead times are long. " * 60 + "So it is." + marks[1]
    text = f"The auditor wrote {quoted} about it. He left."
    assert [text[a:b] for a, b in sentences(text)] == [text[:-9], "He left."]
    stray = f"The auditor wrote {marks[0]} about it. " + "Stocks are low. " * 60
    assert len(sentences(stray, CORPUS)) == 61
    if marks[0] != marks[1]:
        assert len(sentences(stray + f"He wrote {marks[0]}One. Two.{marks[1]} to us.", CORPUS)) == 62


def test_no_length_changes_a_decision():
    """Long runs of blanks, long words and long quotations are read like short ones."""
    from citeloom.llm.sentences import sentences

    def cut(text):
        return [text[a:b] for a, b in sentences(text)]

    word = "Donaudampfschifffahrtselektrizitätenhauptbetriebswerkbauunterbeamtengesellschaft"
    assert cut(f"It fell by 3{' ' * 200}and stayed. Then it rose.") == [f"It fell by 3{' ' * 200}and stayed.", "Then it rose."]
    assert cut(f"Costs rose, approx.{' ' * 300}by half. Then they fell.") == [f"Costs rose, approx.{' ' * 300}by half.", "Then they fell."]
    assert cut(f"Das ist die {word}. Sie endet hier.") == [f"Das ist die {word}.", "Sie endet hier."]
    inner = "Stocks are low. Lead times are long. " * 60
    assert len(cut(f"The auditor of Fürwunfol wrote “{inner}” about Somdaxtel. That was all.")) == 2
    assert len(cut("a." * 100_000 + " End.")) >= 1
    many = "He (as said) left. " * 5_000
    assert len(cut(many)) == 5_000
