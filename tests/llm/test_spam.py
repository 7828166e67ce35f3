import random

from citeloom.llm.spam import _spam, covered, page_scores, repeated_lengths, score, spam_pages, unordered

PROSE = "The group depends on Kalnixor for resin, while Bomtexal supplies only 5%. Weather losses at Zerhomut reached 20 mn euros in 2024 and were not insured."
WORDS = ["cheap hull insurance", "best esg rating", "free audit template", "used crane", "low cost resin"]


def keywords(n, sep, seed=1):
    rnd = random.Random(seed)
    return sep.join(rnd.choice(WORDS) + rnd.choice(["", " 2024"]) for _ in range(n))


SPAM = {
    "pipes": keywords(40, " | "),
    "blanks": keywords(40, " "),
    "tags": "\n".join("Tags: " + keywords(7, ", ", i) for i in range(6)),
    "hash": " ".join("#" + random.Random(i).choice(WORDS).replace(" ", "") for i in range(40)),
    "links": "\n".join(f"[{WORDS[i % 5]}](https://shop.x{i}.example/p/{i})" for i in range(20)),
    "bare": "\n".join(f"Kalnixor{i} used crane -> shop.x{i}.test/a" for i in range(20)),
    "products": "\n".join(f"{WORDS[i % 5]} Kalnixor{i} A{i} – 2{i},50 € – in stock" for i in range(20)),
    "menu": "Home » Login » Cart » Home » Offers » Blog » Login » Home » Cart\nhttps://a.example/x",
    "zh": " / ".join(["审计模板", "快速贷款", "低价保险 2024"] * 12),
    "mostly": PROSE + "\n" + keywords(40, "; "),
}
FINE = {
    "prose": PROSE * 5,
    "twice": "\n".join([PROSE] * 30),
    "contents": "\n".join(f"{i}.{j} Weak demand for retrofits ............ {i + j}" for i in range(1, 6) for j in range(1, 6)) + "\n" + PROSE * 4,
    "references": PROSE * 5 + "\n" + "\n".join(f"[{i}] Kalnixor, http://www.x{i}.test/p/{i}" for i in range(8)),
    "tags": PROSE * 3 + "\nTags: supplier failure, credit tightening, shipping delay, price pressure",
    "short": "Strike",
    "thai": "หาก Nok หยุดส่งเซ็นเซอร์ให้ Mol โครงการจะล่าช้ามาก หาก Rim หยุดส่งเซ็นเซอร์ให้ Fen โครงการจะล่าช้ามาก",
    "list": "Risks:\n" + "\n".join(f"- Costs of bolts rose by {i}% and Munterax passed them on to Sillervo" for i in range(9)),
    "blank": " \n ",
}


def test_repeats_equal_brute_force():
    rnd = random.Random(4)
    for n in (0, 1, 2, 30, 120):
        w = [rnd.choice("abc") for _ in range(n)]
        s = "".join(w)
        want = []
        for i in range(n):
            best = 0
            for k in range(1, i + 2):
                part = s[i - k + 1 : i + 1]
                if sum(s.startswith(part, p) for p in range(n)) >= 2:
                    best = k
            want.append(best)
        assert repeated_lengths(w) == want
    assert covered("a b c x a b y") == [(0, 1), (2, 3), (8, 9), (10, 11)]


def test_shortcut_changes_nothing():
    for text in [*SPAM.values(), *FINE.values()]:
        a, b = score(text), score(text, True)
        assert (a[1] > 0.5 * a[0]) == (b[1] > 0.5 * b[0])


def test_pages(spark):
    rows = [(f"spam {k}", t, "x") for k, t in SPAM.items()] + [(f"fine {k}", t, "x") for k, t in FINE.items()] + [("fine null", None, None), ("fine empty", "", "x"), ("fine long", PROSE * 3000, "x")]
    df = spark.createDataFrame(rows, "doc_id string, text string, n_chars string")
    assert sorted(r[0] for r in spam_pages(df).collect()) == sorted(f"spam {k}" for k in SPAM)
    assert page_scores(df).count() == len(rows)
    assert spam_pages(df.limit(0)).count() == 0


def dressed(form, n=30, words=WORDS, seed=3):
    """Keywords written with stops: in phrases of a sales text, or as runs cut into sentences."""
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        a, b = rnd.choice(words), rnd.choice(words)
        if form == "phrases":
            out.append(rnd.choice([f"Need {a}? {b}! {a} and {b}.", f"Top {a}, {b}, {a} today.", f"The {a}, your {b}: {a}."]))
        else:
            run = " ".join(rnd.choice([*words, words[0] + " 2023"]) for _ in range(4))
            out.append(run[0].upper() + run[1:] + ".")
    return " ".join(out)


ZH = ["审计模板", "快速贷款", "低价保险", "合规培训"]
FRAMES = ["Near {}, {} may call into question bid volumes in 20{}.", "Within {}, {} may narrow the warranty reserve in 20{}.", "La filial de {} en EE. UU. perdió {} mill. de euros por la salida de {}."]


def test_keywords_with_stops(spark):
    spam = [dressed(f, n, w) for f in ("phrases", "runs") for n in (8, 30, 300) for w in (WORDS, ZH)]
    spam += [dressed("runs").replace(". ", ".\n"), PROSE + "\n" + dressed("phrases"), dressed("runs") + "\n" + PROSE]
    names = [f"Kal{a}{b}" for a in "nixor" for b in "bomtexalu"]
    same = [" ".join(f.format(names[i], ["price pressure", "shipping delay", "model error"][i % 3], i + 10) for i in range(40)) for f in FRAMES]
    fine = [*same, "\n".join([PROSE, FINE["list"]] * 20), PROSE * 5 + "\n" + dressed("phrases", 5), "".join(f"监査人{n}は「在庫が少ない。納期が長い。」と{n}の報告書に記した。" for n in names)]
    rows = [(i, t) for i, t in enumerate(spam + fine)]
    got = sorted(r[0] for r in spam_pages(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == list(range(len(spam)))
    for _, t in rows:
        a, b = score(t), score(t, True)
        assert b[2] > 0 and (a[1] > 0.5 * a[0]) == (b[1] > 0.5 * b[0])


FR = ["assurance pas chère", "modèle d’audit", "crédit rapide", "pièces d’éolienne", "rapport de risques gratuit"]
DE = ["günstige versicherung", "kredit ohne schufa", "ersatzteile turbine", "vorlage prüfung", "gebrauchter kran"]
BOILERPLATE = {
    "en": "This report has been prepared by {} solely for information. No reliance may be placed on it for any purpose, and {} accepts no liability for its contents. The figures of {} are unaudited and may change without notice.",
    "fr": "Le présent rapport a été établi par {} à titre d’information. Aucune garantie n’est donnée par {} quant à son contenu. Les chiffres de {} ne sont pas audités et peuvent changer sans préavis.",
    "de": "Dieser Bericht wurde von {} nur zur Information erstellt. Für den Inhalt übernimmt {} keine Haftung. Die Zahlen von {} sind ungeprüft und können sich ohne Ankündigung ändern.",
}


def test_coverage_decides_every_line():
    """Links, prices and stops alone make no spam: what is not repeated is not covered."""
    assert score("https://a.example/b\nKalnixor", True)[1] == 0
    assert score("Kalnixor pump 2,50 €", True)[1] == 0
    for words in (FR, DE):
        for form in ("phrases", "runs"):
            size, spam, inside = score(dressed(form, 30, words))
            assert spam > 0.5 * size and inside > 0.5 * size
    names = [f"Kal{a}{b}" for a in "nixor" for b in "bomtexalu"]
    for text in BOILERPLATE.values():
        long = " ".join(text.format(names[i], names[i + 1], names[i + 2]) for i in range(40))
        size, spam, inside = score(long, True)
        assert spam == 0 and inside > 0.5 * size  # covered, yet prose
    assert _spam([None, " ", dressed("runs"), PROSE]) == [False, False, True, False]


def test_unordered():
    assert unordered([]) == [] and unordered([""]) == [0.0]
    assert unordered(["a b", "b a"]) == [1.0, 1.0] and unordered(["a b c d e f.", "a b c d e f."]) == [0.0, 0.0]
