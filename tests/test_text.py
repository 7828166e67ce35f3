import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from citeloom.functions import text as T
from citeloom.functions.similarity import block_ratio, can_reach


def one(spark, value, *cols, kind="string"):
    return tuple(spark.createDataFrame([(value,)], f"t {kind}").select(*cols).first())


def test_normal_forms(spark):
    t = F.col("t")
    got = one(spark, "  Supply–Chain (EU) Risk’s  ", T.norm_title(t), T.norm_text(t), T.norm_loose(t), T.slug(t), T.slug(t, "-"), T.canonical_key(F.lit("abc"), F.lit("E1"), t), T.canonical_key(F.lit("abc"), F.lit(""), t))
    assert got == ("supply chain risk s", "supply chain eu risk s", "  supply chain  eu  risk s  ", "supply_chain_eu_risk_s", "supply-chain-eu-risk-s", "abc-e1-supply-chain-eu-risks", "abc-erm-supply-chain-eu-risks")


def test_null_and_empty(spark):
    t = F.col("t")
    cols = [T.norm_title(t), T.slug(t), F.size(T.word_tokens(t)), F.size(T.content_words(t)), F.size(T.plain_sentences(t)), F.size(T.numbers(t)), F.size(T.names(t)), F.size(T.ngrams(T.word_tokens(t)))]
    assert one(spark, "", *cols) == ("", "", 0, 0, 0, 0, 0, 0)
    assert all(v in (None, -1) for v in one(spark, None, *cols))


def test_words_numbers_names(spark):
    t = F.col("t")
    s = "The Board of Ruritania's sub-fund lost 40m, 3.5% and 1,200 in 2019. But Nokbán (Ltd.) did not! ok"
    tokens, content, sentences, numbers, figures, names = one(spark, s, T.word_tokens(t), T.content_words(t), T.plain_sentences(t), T.numbers(t), T.figures(t), T.names(t))
    assert tokens[:5] == ["the", "board", "of", "ruritania's", "sub-fund"]
    assert "the" not in content and "board" in content and "of" not in content
    assert sentences == ["The Board of Ruritania's sub-fund lost 40m, 3.5% and 1,200 in 2019.", "But Nokbán (Ltd.) did not! ok"]
    assert numbers == re.findall(r"\b\d[\d.,%]*\b", s)
    assert figures == ["40", "3.5", "1,200", "2019"]
    assert names == ["Board", "Ruritania's", "But", "Nokbán", "Ltd"]


def test_ngram_share(spark):
    df = spark.createDataFrame([("a b c d", "x a b c y b c d"), ("a b c d", "a b c"), ("a b", "a b c"), ("a c", "a b c"), ("", "a")], "p string, w string")
    assert [r[0] for r in df.select(T.ngram_share(F.col("p"), F.col("w"))).collect()] == [1.0, 0.5, 1.0, 0.0, 1.0]


def test_small_functions(spark):
    t = F.col("t")
    assert one(spark, "exam-\nple, a-\nB", T.unhyphenate(t)) == ("example, a-\nB",)
    assert one(spark, "sentence_2_low:x", T.problem_kind(t)) == ("sentence_low",)
    assert one(spark, " \nfirst\n\n second \nthird", T.block_heading(t)) == ("second",)
    assert one(spark, "only", T.block_heading(t)) == ("only",)
    assert one(spark, "An opportunity to grow", T.lexical_marker(t)) == ("opportunity",)
    assert one(spark, "a risk as well as an opportunity", T.lexical_marker(t)) == ("risk",)
    assert one(spark, "Immaterial risk", T.lexical_marker(t)) == ("immaterial",)
    assert one(spark, "reviewed every six months.", T.review_every(t)) == ("every six months",)
    assert one(spark, "in 2040", T.stands_alone(t, F.lit("40")), T.stands_alone(t, F.lit("2040"))) == (False, True)


def test_full_text(spark):
    rows = [("Élan vital", "cyber-attack"), ("attack of cyber", None), ("", "")]
    df = spark.createDataFrame(rows, "a string, b string")
    hit = lambda q: [r[0] for r in df.select(T.matches_any([F.col("a"), F.col("b")], q)).collect()]
    assert hit("elan") == [True, False, False]
    assert hit("cyber-attack") == [True, False, False]
    assert hit('cyber "') == [True, True, False]
    assert hit('" -') == [False, False, False]


def test_block_ratio_and_bound(spark):
    rows = [("tide", "diet"), ("diet", "tide"), ("abc", "abc"), ("", ""), (None, "a")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = [tuple(r) for r in df.select(block_ratio("a", "b"), can_reach(F.col("a"), F.col("b"), 0.6)).collect()]
    assert [g[0] for g in got] == [0.25, 0.5, 1.0, 1.0, None]
    assert got[0][1] is True


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(alphabet="abcXYé’–( ).,0 7\n", max_size=30), min_size=1, max_size=8))
def test_norm_text_like_plain_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(T.norm_text(F.col("t"))).collect()]
    assert got == [re.sub(" +", " ", re.sub("[^a-z0-9 ]+", " ", t.lower().replace("–", "-").replace("’", "'"))).strip(" ") for t in texts]
