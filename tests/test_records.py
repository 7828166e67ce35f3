import random

import pytest
from pyspark.sql import functions as F

from citeloom.operators import calls as C
from citeloom.operators import evaluate as E
from citeloom.operators import grounding as G
from citeloom.operators import records as R
from citeloom.operators import runlog as RL
from citeloom.operators import sections as S


def test_grounding_finds_seeded_faults(spark):
    text = "The plant in Kolding depends on one supplier of bearings. A strike would delay output by 20% in 2024."
    rows = {
        "good": "The plant depends on one supplier of bearings. A strike would delay output by 20% in 2024.",
        "number": "The plant depends on one supplier of bearings. A strike would delay output by 35% in 2024.",
        "name": "The plant in Ruritania depends on one supplier. A strike would delay output of bearings.",
        "topic": "The plant depends on one supplier of bearings. Elephants love sunny gardens everywhere.",
        "short": "The plant depends on one supplier of bearings.",
    }
    recs = spark.createDataFrame([(k, "r", 1, v, text[:60], None) for k, v in rows.items()] + [("span", "r", 1, rows["good"], "not on the page at all", "something else entirely"), ("null", "r", 1, None, None, None)],
                                 "id string, report_id string, page int, description string, verbatim_span string, mitigation string")
    pages = spark.createDataFrame([("r", 1, text), ("r", 1, text), ("r", 1, None)], "report_id string, page int, text string")
    cites = spark.createDataFrame([(k, text, 1) for k in [*rows, "span"]] * 2, "risk_instance_id string, span string, page int")
    got = {r.id: r.problems for r in G.grounded(recs, pages, cites).collect()}
    assert got["good"] == []
    assert got["number"] == ["number_not_in_text:35"]
    assert got["name"] == ["name_not_in_text:Ruritania"]
    assert got["topic"] == ["sentence_2_ungrounded"]
    assert got["short"] == ["sentence_count:1"]
    assert got["span"] == ["span_not_on_page", "mitigation_not_in_text"]
    assert got["null"] == ["sentence_count:0"]
    rate = G.pass_rate(G.grounded(recs, pages, cites), ["report_id"]).first()
    assert (rate.records, rate.failed, rate.outcome) == (7, 6, "warning")


def test_grounding_pools(spark):
    """Sentences count against span, impact and cited spans; numbers in normal form; the mitigation against the pages."""
    page1, page2 = "Dredging permits in Esbjerg may lapse. Costs of 1,250 tonnes rose.", "We insure vessels against storms and renew covers yearly."
    recs = spark.createDataFrame(
        [("impact", "r", 1, "Vessels may idle for weeks. Dredging permits may lapse.", "Dredging permits in Esbjerg", "Vessels idle for weeks.", "We insure vessels against storms."),
         ("far", "r", 1, "Dredging permits may lapse. Costs of 1.250 tonnes rose in Esbjerg.", "Dredging permits in Esbjerg may lapse. Costs", None, "Helicopters patrol the desert at night.")],
        "id string, report_id string, page int, description string, verbatim_span string, potential_impact string, mitigation string",
    )
    pages = spark.createDataFrame([("r", 1, page1), ("r", 2, page2)], "report_id string, page int, text string")
    cites = spark.createDataFrame([("impact", "Dredging", 2), ("far", None, 1)], "risk_instance_id string, span string, page int")
    got = {r.id: r.problems for r in G.grounded(recs, pages, cites).collect()}
    assert got == {"impact": [], "far": ["mitigation_not_in_text"]}
    stems = {r.id: r.problems for r in G.grounded(recs, pages, cites, "stemmed").collect()}
    assert stems == got
    with pytest.raises(ValueError):
        G.grounded(recs, pages, cites, "other")


def test_repair_is_taken_only_whole(spark):
    text = "The plant in Kolding depends on one supplier of bearings. A strike would delay output by 20% in 2024."
    good, bad = text, "The plant depends on one supplier of bearings. A strike would delay output by 35%."
    recs = [(k, "r", 1, "t", bad if k != "fine" else good, text[:60], None, ["old"], "auto_accepted") for k in ("fine", "mended", "still", "lost")]
    recs = spark.createDataFrame(recs, "id string, report_id string, page int, title string, description string, verbatim_span string, mitigation string, quality_flags array<string>, review_state string")
    pages = spark.createDataFrame([("r", 1, text)], "report_id string, page int, text string")
    cites = spark.createDataFrame([(k, text, 1) for k in ("fine", "mended", "still", "lost")], "risk_instance_id string, span string, page int")
    fixes = spark.createDataFrame([("mended", "new", good, "invented"), ("still", "new", bad, None), ("fine", "new", "never used", None)], "id string, title string, description string, mitigation string")
    got = {r.id: r for r in G.repaired(recs, pages, cites, fixes).collect()}
    assert got["fine"].title == "t" and got["fine"].problems == [] and not got["fine"].repaired
    assert (got["mended"].title, got["mended"].description, got["mended"].mitigation, got["mended"].repaired) == ("new", good, None, True)
    assert (got["still"].title, got["still"].quality_flags, got["still"].review_state) == ("t", ["old", "grounding:number_not_in_text:35"], "pending_review")
    assert got["lost"].problems == ["number_not_in_text:35", "repair_not_recorded"] and got["mended"].review_state == "auto_accepted"


def test_coverage_counts_bags(spark):
    page = spark.createDataFrame([("p", w) for w in "a a b c".split()], "k string, word string")
    block = spark.createDataFrame([("p", w) for w in "a c c d".split()], "k string, word string")
    row = G.page_coverage(page, block, ["k"]).first()
    assert (row.page_words, row.covered_words, row.coverage) == (4, 2, 0.5)


def test_agreement_takes_the_first(spark):
    cols = "k string, seq int, title string, span string"
    left = spark.createDataFrame([("p", 1, "Cyber attacks", "one two three"), ("p", 2, "Drought", "x"), ("p", 3, "Strike", None), ("q", 4, "Cyber attacks", "z")], cols)
    right = spark.createDataFrame([("p", 7, "Cyber attack", "no"), ("p", 5, "Other", "zero one two three four"), ("p", 6, "Stricter rules", "y")], cols)
    got = {r.left_seq: r.right_seq for r in R.agreement(left, right, ["k"]).collect()}
    assert got == {1: 5, 2: None, 3: None, 4: None}


def brute_merge(first, second, same):
    taken = {}
    for a in first:
        for b in second:
            if b not in taken and same(a, b):
                taken[b] = a
    return taken


def test_merge_equals_the_greedy_loop(spark):
    rnd = random.Random(9)
    titles = ["Cyber attacks on plants", "Cyber security", "Corruption and bribery", "Bribery and corruption risk", "Drought", "Droughts", "Flood damage"]
    first = [(f"a{i}", rnd.choice(titles), i) for i in range(8)]
    second = [(f"b{i}", rnd.choice(titles), 0) for i in range(8)]
    from difflib import SequenceMatcher

    import re

    norm = lambda t: re.sub("[^a-z0-9 ]+", " ", t.lower())

    def same(a, b):
        x, y = norm(a[1]), norm(b[1])
        return SequenceMatcher(None, x, y).ratio() >= 0.55 or any(all(w in t.split() for w in h for t in (x, y)) for h in R.HINTS)

    want = {b[0]: a[0] for b, a in brute_merge(first, second, same).items()}
    df = lambda rows: spark.createDataFrame([("k", *r) for r in rows], "k string, id string, title string, rank int")
    assert {r.merged_id: r.anchor_id for r in R.same_risk_pairs(df(first), df(second), ["k"]).collect()} == want and want


def test_numbers_citations_votes(spark):
    recs = spark.createDataFrame([("x", 2, 5, "b"), ("x", 1, 9, "c"), ("x", 2, 5, "a")], "report_id string, prominence int, page int, id string")
    assert [r.record_no for r in R.numbered(recs, "report_id").orderBy("id").collect()] == ["r02", "r03", "r01"]
    pairs = spark.createDataFrame([("b", "a")], "merged_id string, anchor_id string")
    cites = spark.createDataFrame([("a", 1), ("b", 1), ("b", 2), ("c", 1)], "risk_instance_id string, page int")
    assert sorted(map(tuple, R.merged_citations(pairs, cites).collect())) == [("a", 1), ("a", 2), ("c", 1)]
    votes = spark.createDataFrame([("k", "x", 1), ("k", "y", 2), ("k", "y", 3), ("t", "p", 1), ("t", "q", 2), ("n", None, 1)], "k string, v string, seq int")
    got = {r.k: (r.winner, r.share, r.changed) for r in R.voted(votes, "k", "v", "seq").collect()}
    assert got == {"k": ("y", 0.666667, True), "t": ("p", 0.5, False)}


def test_paragraph_after(spark):
    text = "Top\n Actions \nWe reduce the exposure of our sup-\npliers step by step.\nNext heading\nother text."
    long = "Actions\n" + "\n".join(["This is a full sentence of some length that goes on."] * 20)
    df = spark.createDataFrame([(text,), (long,), ("no heading here",), (None,), ("Actions\n",)], "t string")
    a, b, c, d, e = (r[0] for r in df.select(R.paragraph_after(F.col("t"), "Actions")).collect())
    assert a == "We reduce the exposure of our suppliers step by step."
    assert len(b) <= 700 and b.endswith("goes on.")
    assert c is None and d is None and e is None


def test_calls(spark):
    cols = "call_id string, request_hash string, response_content string, created_at string"
    calls = spark.createDataFrame([("c1", "h1", "old", "1"), ("c1", "h1", "new", "2"), ("c2", "h2", None, "1")], cols)
    asked = spark.createDataFrame([("h1",), ("h2",), ("h3",)], "request_hash string")
    got = {r.request_hash: (r.reply, r.recorded) for r in C.replayed(asked, calls).collect()}
    assert got == {"h1": ("new", True), "h2": (None, True), "h3": (None, False)}
    with pytest.raises(C.ReplayMiss):
        C.replay_or_raise(asked, calls)
    assert C.replay_or_raise(asked.where("request_hash <> 'h3'"), calls).count() == 2
    df = spark.createDataFrame([("a", None), ("a", ""), (None, "a")], "x string, y string")
    assert df.select(C.request_hash(F.col("x"), F.col("y"))).distinct().count() == 3
    js = spark.createDataFrame([('{"b": 1, "z": 2, "a": 3}',)], "j string").select(C.unknown_keys(F.col("j"), ["a", "c"]), C.missing_keys(F.col("j"), ["a", "c"])).first()
    assert tuple(js) == (["b", "z"], ["c"])


def test_run_log(spark):
    cols = "run_id string, report_id string, phase string, check_id string, outcome string, count int, strategy string, detail string, created_at int"
    rows = [("r1", "x", "e", "c", "error", 1, None, '{"section": "s"}', 1), ("r1", "x", "e", "c", "ok", 2, None, '{"section": "s"}', 2), ("r1", "x", "e", "c", "warning", 3, "m", None, 1), ("r1", "x", "e", "c", "ok", 3, "m", "{broken", 0),
            ("r2", "x", "e", "c", "ok", 2, None, None, 3), ("r2", "x", "e", "new", "ok", 1, None, None, 3), ("r0", "x", "e", "c", "ok", 99, None, None, 0)]
    df = spark.createDataFrame(rows, cols)
    last = RL.last_wins(df)
    assert sorted((r.run_id, r.check_id, r.section or "", r.outcome) for r in last.collect()) == [("r0", "c", "", "ok"), ("r1", "c", "", "warning"), ("r1", "c", "s", "ok"), ("r2", "c", "", "ok"), ("r2", "new", "", "ok")]
    assert {r.run_id: r.status for r in RL.status(df, ["run_id"]).collect()} == {"r0": "ok", "r1": "error", "r2": "ok"}
    assert sorted((r.check_id, r.previous, r.current) for r in RL.count_drift(df, ["check_id"]).collect()) == [("c", 9, 2), ("new", None, 1)]
    assert [r.line for r in RL.rendered(df.where("outcome = 'warning'")).collect()] == ["! c 3 [m]"]
    a = spark.createDataFrame([(1,), (1,), (2,)], "v int")
    assert [tuple(r) for r in RL.same_rows(a, a.distinct()).collect()] == [(1, "left")] and RL.same_rows(a, a).count() == 0


def test_golden_scores_equal_brute_force(spark):
    from difflib import SequenceMatcher

    rnd = random.Random(2)
    vocabulary = ["cyber", "attacks", "river", "floods", "strike", "steel", "prices", "permit", "delay", "loss"]
    some = lambda n: " ".join(rnd.choice(vocabulary) for _ in range(n))
    golden = [("r", i, [some(2) for _ in range(rnd.randint(1, 3))], [some(1) for _ in range(rnd.randint(0, 3))], rnd.randint(1, 3)) for i in range(12)]
    records = [("r", i, some(2), rnd.choice([None, some(6)]), rnd.randint(1, 3)) for i in range(12)]
    want = {}
    for _, g, names, phrases, page in golden:
        for _, n, title, span, at in records:
            t = max(SequenceMatcher(None, x, title).ratio() for x in names)
            h = sum(k in (span or "") for k in phrases) / max(1, len(phrases))
            score = max(t, 0.6 * h + 0.4 * t)
            score = max(score, 0.85) if page == at and h >= 0.66 else score
            if score >= 0.6:
                want[g, n] = round(score, 9)
    g = spark.createDataFrame(golden, "k string, golden_no int, names array<string>, key_phrases array<string>, page int")
    r = spark.createDataFrame(records, "k string, record_no int, title string, verbatim_span string, page int")
    assert {(x.golden_no, x.record_no): round(x.score, 9) for x in E.golden_scores(g, r, "k").collect()} == want and len(want) > 10


def test_assignment_is_greedy_and_one_to_one(spark):
    rows = [("k", 1, 1, 0.9), ("k", 1, 2, 0.9), ("k", 2, 1, 0.95), ("k", 2, 2, 0.7), ("k", 3, 3, 0.5)]
    df = spark.createDataFrame(rows, "k string, golden_no int, record_no int, score double")
    assert sorted(tuple(r) for r in E.assign(df, "k").collect()) == [("k", 1, 1, 0.9), ("k", 2, 2, 0.7)]
    one = spark.createDataFrame([(["b", "a", "a"], ["a", "b"]), (None, []), (["a"], None)], "x array<string>, y array<string>")
    assert [r[0] for r in one.select(E.same_set(F.col("x"), F.col("y"))).collect()] == [True, True, False]
    s = spark.createDataFrame([(0.4, 0.7, True), (0.4, 0.7, False), (0.9, 0.0, True)], "t double, h double, p boolean")
    assert [round(r[0], 3) for r in s.select(E.match_score(F.col("t"), F.col("h"), F.col("p"))).collect()] == [0.85, 0.58, 0.9]


def test_sections(spark):
    text = "Contents\n1.1 Weak demand ........ 12\nBoard of directors … … … 7\nNo entry 5\n4 Drought ____ 120 "
    df = spark.createDataFrame([("d", text)], "doc string, text string")
    assert [(r.title, r.printed_page) for r in S.contents_entries(df, "doc").collect()][0] == ("1.1 Weak demand", 12)
    starts = spark.createDataFrame([("r", "a", 3), ("r", "b", 3), ("r", "c", 9)], "k string, section string, page int")
    assert sorted(tuple(r) for r in S.section_ranges(starts, "k").collect()) == [("r", "a", 3, 8), ("r", "b", 3, 8), ("r", "c", 9, None)]
    probes = spark.createDataFrame([("d", 10, 8, 1), ("d", 11, 8, 2), ("d", 12, 10, 3), ("d", 14, 11, 4), ("d", 15, None, 5)], "doc string, pdf_index int, printed_page int, seq int")
    assert [tuple(r) for r in S.page_offsets(probes, "doc").collect()] == [("d", 2, 2)]
    want = spark.createDataFrame([("k", 1, "Enterprise Risks"), ("k", 2, "Enterprise Risks overview"), ("k", 3, "Enterprice risk"), ("k", 4, "Weather"), ("k", 5, None)], "k string, want_no int, want_title string")
    offer = spark.createDataFrame([("k", 1, "Enterprise risks (p. 5)"), ("k", 2, "Other things")], "k string, offer_no int, title string")
    got = {r.want_no: r.match_grade for r in S.best_title(want, offer, ["k"]).collect()}
    assert got == {1: "exact", 2: "variant", 3: "similarity", 4: "none", 5: "none"}


def test_candidates_and_markers(spark):
    schema = "block_id string, marker string, source_register string, section string, page int, heading string, text string, fields map<string,string>"
    rows = [("b1", "risk", "erm_main_risk", "s", 1, "H", "whole", {"description": "part", "potential_impact": ""}), ("b2", "risk", "esrs_financial_risk", "s", 2, "H", "whole", {}), ("b3", "opportunity", "erm_main_risk", "s", 1, "H", "x", None), ("b4", "risk", None, "s", 1, "H", "x", None)]
    got = {r.candidate_id: (r.verbatim_span, r.prominence, r.potential_impact) for r in R.register_candidates(spark.createDataFrame(rows, schema)).collect()}
    assert got == {"b1": ("part", 1, None), "b2": ("whole", 2, None)}
    marks = [("1", "risk", "risk"), ("2", "risk", "opportunity"), ("3", None, "risk"), ("4", None, "immaterial"), ("5", "risk", None), ("6", None, None)]
    got = {r.id: (r.marker, r.marker_source, r.quality_flags) for r in R.resolved_markers(spark.createDataFrame(marks, "id string, icon_marker string, text_marker string")).collect()}
    assert got == {
        "1": ("risk", "icon+text", []), "2": ("risk", "icon", ["marker_disagreement"]), "3": ("risk", "text", ["marker_without_icon"]),
        "4": ("immaterial", "text", []), "5": ("risk", "icon", []), "6": ("none", "text", ["marker_without_icon"]),
    }


def test_located_sections(spark):
    specs = spark.createDataFrame([("r", s, a, b, q) for s, a, b, q in [("a", 10, 12, True), ("b", 20, 25, True), ("c", 30, 35, True), ("d", 40, 44, False)]], "k string, section string, first_page int, last_page int, required boolean")
    matches = spark.createDataFrame([("r", "a", "exact"), ("r", "b", "similarity"), ("r", "c", "none")], "k string, section string, match_grade string")
    ranges = spark.createDataFrame([("r", "a", 10, 20), ("r", "b", 21, 30)], "k string, section string, first_page int, last_page int")
    got = {r.section: (r.first_page, r.last_page, r.quality_flags, r.outcome) for r in S.located(specs, matches, ranges, "k").collect()}
    assert got == {
        "a": (10, 12, [], "ok"), "b": (21, 30, ["title_similarity", "differs_from_configuration"], "warning"),
        "c": (30, 35, ["not_found"], "error"), "d": (40, 44, ["not_found"], "warning"),
    }


def test_backends_and_seeded_faults(spark):
    flags = lambda rows: spark.createDataFrame(rows, "id string, problems array<string>")
    row = E.backends_compared(flags([("a", []), ("b", ["x"]), ("c", ["x"])]), flags([("a", []), ("b", ["y"]), ("c", [])]), "id").first()
    assert tuple(row) == (3, 2, 1, 1, 0, 2, 1)  # the last two: kinds that only one of them names
    recs = spark.createDataFrame([("a", "Text."), ("b", None)], "id string, description string")
    got = {(r.id, r.fault): r.description for r in E.seeded_faults(recs, [("number", "It was 77."), ("name", "Ask Ruritania.")]).collect()}
    assert got[("a", "number")] == "Text. It was 77." and got[("b", "name")] == "Ask Ruritania." and len(got) == 4
