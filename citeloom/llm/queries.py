"""Queries of the training-data operators over whole tables, with SQL where it can express them."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.llm import mixing, neardup, packing, replies, sentences, spam, spans, visual
from citeloom.sources import read_table

QUERIES = {}
ORACLES: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def p1_found(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_spans(read_table(spark, d, "risk_instance"), read_table(spark, d, "risk_citation"))


@query
def p1_shared_report(spark: SparkSession, d: str) -> DataFrame:
    return spans.shared_report(read_table(spark, d, "risk_instance"), read_table(spark, d, "risk_citation"))


@query
def p1_longest_level(spark: SparkSession, d: str) -> DataFrame:
    return spans.longest_shared(read_table(spark, d, "risk_instance"), read_table(spark, d, "risk_citation"))


@query
def p3_found(spark: SparkSession, d: str) -> DataFrame:
    return neardup.found_pairs(read_table(spark, d, "risk_instance"))


@query
def p3_groups(spark: SparkSession, d: str) -> DataFrame:
    return neardup.groups(read_table(spark, d, "risk_instance"))


@query
def p3_classes(spark: SparkSession, d: str) -> DataFrame:
    """Membership of the classes of equal texts; with ``p3_linked_classes`` the pairs of ``p3_found``, not expanded."""
    return neardup.classes(read_table(spark, d, "risk_instance"))


@query
def p3_linked_classes(spark: SparkSession, d: str) -> DataFrame:
    return neardup.linked_classes(read_table(spark, d, "risk_instance"))


@query
def p5_found(spark: SparkSession, d: str) -> DataFrame:
    return visual.found_when_folded(read_table(spark, d, "risk_instance"), read_table(spark, d, "page_text"))


@query
def p5_folded_spans(spark: SparkSession, d: str) -> DataFrame:
    spans_ = read_table(spark, d, "risk_instance").selectExpr("id", "verbatim_span")
    return visual.fold_columns(spans_, ["verbatim_span"]).select("id", "verbatim_span_folded")


@query
def p6_packed(spark: SparkSession, d: str) -> DataFrame:
    return packing.packed(read_table(spark, d, "documents"), read_table(spark, d, "pack_spec"))


@query
def p6_fill(spark: SparkSession, d: str) -> DataFrame:
    specs = read_table(spark, d, "pack_spec")
    return packing.fill_report(packing.packed(read_table(spark, d, "documents"), specs), specs)


@query
def p6_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per capacity: documents that are placed, and breaches: documents not covered from their first to their last token
    exactly once, containers above the capacity, documents cut though they fit, and more than half of the room unused."""
    specs = read_table(spark, d, "pack_spec")
    rows = packing.packed(read_table(spark, d, "documents"), specs)
    docs = rows.groupBy("spec_id", "doc_id").agg(F.count("*").alias("pieces"), F.min("start_token").alias("a"), F.max("end_token").alias("z"), F.sum("n_tokens").alias("n"))
    docs = docs.join(specs.select("spec_id", "capacity_tokens"), "spec_id").groupBy("spec_id").agg(
        F.count("*").alias("documents"), F.count_if((F.col("a") != 0) | (F.col("z") != F.col("n"))).alias("gaps"), F.count_if((F.col("pieces") > 1) & (F.col("n") <= F.col("capacity_tokens"))).alias("needless_cuts")
    )
    full = rows.groupBy("spec_id", "container_id").agg(F.sum("n_tokens").alias("n")).join(specs.select("spec_id", "capacity_tokens"), "spec_id").groupBy("spec_id").agg(
        F.count_if(F.col("n") > F.col("capacity_tokens")).alias("overfull"), (F.sum("n") < 0.5 * F.sum("capacity_tokens")).cast("long").alias("wasteful")
    )
    return docs.join(full, "spec_id").select("spec_id", "documents", "gaps", "needless_cuts", "overfull", "wasteful")


@query
def p7_mixed(spark: SparkSession, d: str) -> DataFrame:
    return mixing.mixed(mixing.sized_documents(read_table(spark, d, "documents")), read_table(spark, d, "mix_target"))


@query
def p7_shares(spark: SparkSession, d: str) -> DataFrame:
    return mixing.shares(mixing.sized_documents(read_table(spark, d, "documents")), read_table(spark, d, "mix_target"))


@query
def p7_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per plan: sources listed, and breaches: documents drawn more often than allowed, drawn for a source that is not
    theirs or twice, and sources whose drawn tokens are more than six standard deviations from rate times size."""
    documents, targets = read_table(spark, d, "documents"), read_table(spark, d, "mix_target")
    sized = mixing.sized_documents(documents)
    drawn, rates = mixing.mixed(sized, targets), mixing.rates(sized, targets)
    per_doc = drawn.join(rates.select("plan_id", "source", "max_repeats"), ["plan_id", "source"], "left").join(sized.select("doc_id", F.col("source").alias("own")), "doc_id")
    per_doc = per_doc.groupBy("plan_id").agg(
        F.count_if(F.coalesce(F.col("repeats") > F.col("max_repeats"), F.lit(True))).alias("too_often"), F.count_if(~F.col("source").eqNullSafe(F.col("own"))).alias("foreign_source"), (F.count("*") - F.count_distinct("doc_id")).alias("twice")
    )
    part = F.col("rate") - F.floor("rate")
    spread = sized.join(rates.select("plan_id", "source", "rate"), "source").groupBy("plan_id", "source").agg(F.sum(F.col("rate") * F.col("n_tokens")).alias("want"), F.sum(part * (1 - part) * F.col("n_tokens") * F.col("n_tokens")).alias("var"))
    got = drawn.groupBy("plan_id", "source").agg(F.sum(F.col("repeats") * F.col("n_tokens")).alias("got"))
    off = spread.join(got, ["plan_id", "source"], "left").groupBy("plan_id").agg(F.count_if(F.abs(F.coalesce("got", F.lit(0)) - F.col("want")) > 6 * F.sqrt("var") + 1).alias("off_rate"))
    listed = rates.groupBy("plan_id").agg(F.count("*").alias("sources"))
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return listed.join(per_doc, "plan_id", "left").join(off, "plan_id", "left").select("plan_id", "sources", *map(zero, ("too_often", "foreign_source", "twice", "off_rate")))


@query
def p4_invariants(spark: SparkSession, d: str) -> DataFrame:
    """Per field: texts with sentences, and breaches: sentences that overlap, begin or end with a blank, or leave visible
    characters between them."""
    ri = read_table(spark, d, "risk_instance")
    units = sentences.record_sentences(ri)
    long = ri.select(F.col("id").alias("risk_instance_id"), F.explode(F.array(*(F.struct(F.lit(c).alias("field"), F.col(c).alias("text")) for c in ("description", "verbatim_span")))).alias("t")).select("risk_instance_id", "t.*")
    spans = units.groupBy("risk_instance_id", "field").agg(F.array_sort(F.collect_list(F.struct("start_pos", "end_pos"))).alias("u"))
    rows = long.join(spans, ["risk_instance_id", "field"])
    piece = lambda a, z: F.substring(F.col("text"), a + 1, z - a)
    cut = F.transform("u", lambda x: piece(x["start_pos"], x["end_pos"]))
    gaps = F.transform("u", lambda x, i: piece(F.when(i == 0, 0).otherwise(F.try_element_at("u", i)["end_pos"]), x["start_pos"]))
    tail = F.substring(F.col("text"), F.try_element_at("u", F.lit(-1))["end_pos"] + 1, F.char_length("text"))
    seen = lambda c: F.regexp_replace(c, r"[\s\p{Z}\p{Cf}\u180e]+", "") != ""
    overlap = F.exists(F.transform("u", lambda x, i: (i > 0) & (x["start_pos"] < F.try_element_at("u", i)["end_pos"])), lambda x: x)
    return rows.groupBy("field").agg(
        F.count("*").alias("texts"), F.count_if(overlap).alias("overlaps"), F.count_if(F.exists(cut, lambda c: c.rlike(r"^\s|\s$"))).alias("blank_ends"), F.count_if(F.exists(gaps, seen) | seen(tail)).alias("left_out")
    )


@query
def p4_found(spark: SparkSession, d: str) -> DataFrame:
    return sentences.record_sentences(read_table(spark, d, "risk_instance"))


@query
def p4_lengths(spark: SparkSession, d: str) -> DataFrame:
    """Sentences and their length per record and field."""
    units = sentences.record_sentences(read_table(spark, d, "risk_instance"))
    size = F.col("end_pos") - F.col("start_pos")
    return units.groupBy("risk_instance_id", "field").agg(F.count("*").alias("sentences"), F.max(size).alias("longest"), F.sum(size).alias("chars"))


@query
def p2_found(spark: SparkSession, d: str) -> DataFrame:
    return replies.defects(read_table(spark, d, "calls"))


@query
def p2_defect_counts(spark: SparkSession, d: str) -> DataFrame:
    found = replies.defects(read_table(spark, d, "calls"))
    kind = F.split_part("call_id", F.lit("-"), F.lit(1))
    return found.groupBy(kind.alias("kind"), "defect").agg(F.count("*").alias("n_calls"))


@query
def p8_found(spark: SparkSession, d: str) -> DataFrame:
    return spam.spam_pages(read_table(spark, d, "documents"))


@query
def p8_scores(spark: SparkSession, d: str) -> DataFrame:
    return spam.page_scores(read_table(spark, d, "documents"))


# --- SQL that checks whole results ----------------------------------------------------------------------------------

ORACLES["p1_found"] = """WITH u AS (
  SELECT id AS r, 'description' AS field, page, description AS t FROM risk_instance UNION ALL SELECT id, 'verbatim_span', page, verbatim_span FROM risk_instance
  UNION ALL SELECT risk_instance_id, 'span', page, span FROM (SELECT DISTINCT risk_instance_id, page, span FROM risk_citation)),
n AS (SELECT *, row_number() OVER () AS k FROM u WHERE length(t) >= 120),
w AS (SELECT k, r, p, substr(t, p + 1, 120) AS s FROM (SELECT k, r, t, unnest(range(0, length(t) - 119)) AS p FROM n)),
h AS (SELECT s FROM w GROUP BY s HAVING min(r) < max(r)),
x AS (SELECT k, p, CASE WHEN p - lag(p) OVER (PARTITION BY k ORDER BY p) <= 120 THEN 0 ELSE 1 END AS fresh FROM w WHERE s IN (FROM h)),
g AS (SELECT k, p, sum(fresh) OVER (PARTITION BY k ORDER BY p) AS run FROM x)
SELECT r AS risk_instance_id, field, page, CAST(min(p) AS INT) AS start_pos, CAST(max(p) + 120 AS INT) AS end_pos FROM g JOIN n USING (k) GROUP BY k, run, r, field, page"""

_UNITS = """SELECT id AS r, 'description' AS field, page, description AS t FROM risk_instance UNION ALL SELECT id, 'verbatim_span', page, verbatim_span FROM risk_instance
  UNION ALL SELECT risk_instance_id, 'span', page, span FROM (SELECT DISTINCT risk_instance_id, page, span FROM risk_citation)"""
ORACLES["p1_shared_report"] = f"""WITH f AS ({ORACLES['p1_found']}), z AS (SELECT r, coalesce(sum(length(t)), 0) AS n FROM ({_UNITS}) GROUP BY r), g AS (SELECT risk_instance_id AS r, sum(end_pos - start_pos) AS s, count(*) AS k FROM f GROUP BY 1)
SELECT z.r AS risk_instance_id, CAST(n AS BIGINT) AS n_chars, CAST(coalesce(s, 0) AS BIGINT) AS shared_chars, coalesce(k, 0) AS n_runs, CASE WHEN n > 0 THEN round(coalesce(s, 0) / n, 6) ELSE 0.0 END AS shared_share FROM z LEFT JOIN g USING (r)"""
ORACLES["p1_longest_level"] = f"""WITH n AS (SELECT *, row_number() OVER () AS k FROM ({_UNITS})), v AS (SELECT unnest([120, 240, 480, 960, 1920, 3840, 7680]) AS level),
w AS (SELECT level, r, substr(t, p + 1, level) AS s FROM (SELECT level, r, t, unnest(range(0, length(t) - level + 1)) AS p FROM n JOIN v ON length(t) >= level)),
h AS (SELECT level, s FROM w GROUP BY ALL HAVING min(r) < max(r)) SELECT r AS risk_instance_id, CAST(max(level) AS INT) AS longest_level FROM w JOIN h USING (level, s) GROUP BY r"""
ORACLES["p6_invariants"] = "SELECT spec_id, (SELECT count(*) FROM documents) AS documents, 0 AS gaps, 0 AS needless_cuts, 0 AS overfull, 0 AS wasteful FROM pack_spec WHERE capacity_tokens >= 1"
ORACLES["p7_invariants"] = "SELECT plan_id, count(DISTINCT lower(trim(source))) AS sources, 0 AS too_often, 0 AS foreign_source, 0 AS twice, 0 AS off_rate FROM mix_target GROUP BY 1"
ORACLES["p4_invariants"] = """SELECT field, count_if(regexp_replace(t, '[\\s\\p{Z}\\p{Cf}]+', '', 'g') <> '') AS texts, 0 AS overlaps, 0 AS blank_ends, 0 AS left_out
FROM (SELECT 'description' AS field, description AS t FROM risk_instance UNION ALL SELECT 'verbatim_span', verbatim_span FROM risk_instance) GROUP BY 1"""
_GRAMS = """t AS (SELECT id, trim(regexp_replace(lower(coalesce(title, '')) || ' ' || lower(coalesce(description, '')), '[ \\t\\r\\n]+', ' ', 'g')) AS t FROM (SELECT DISTINCT id, title, description FROM risk_instance)),
g AS (SELECT DISTINCT id, substr(t, p, 5) AS s FROM (SELECT id, t, unnest(range(1, length(t) - 3)) AS p FROM t)), n AS (SELECT id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT a.id AS x, b.id AS y, count(*) AS k FROM g a JOIN g b ON a.s = b.s AND a.id < b.id GROUP BY ALL),
f AS (SELECT x, y, k / (a.n + b.n - k) AS j FROM c JOIN n a ON a.id = x JOIN n b ON b.id = y WHERE k >= 0.7 * (a.n + b.n - k))"""
ORACLES["p3_found"] = f"WITH {_GRAMS} SELECT x AS id_a, y AS id_b FROM f"
ORACLES["p3_classes"] = f"""WITH {_GRAMS} SELECT id, CASE WHEN length(t) >= 5 THEN min(id) OVER w ELSE id END AS class_id, CASE WHEN length(t) >= 5 THEN count(*) OVER w ELSE 1 END AS n_copies FROM t WINDOW w AS (PARTITION BY t)"""
ORACLES["p3_linked_classes"] = f"""WITH {_GRAMS}, m AS (SELECT id, t, min(id) OVER (PARTITION BY t) AS k FROM t)
SELECT DISTINCT least(a.k, b.k) AS id_a, greatest(a.k, b.k) AS id_b, round(j, 6) AS jaccard FROM f JOIN m a ON a.id = x JOIN m b ON b.id = y WHERE a.k <> b.k"""
ORACLES["p3_groups"] = f"""WITH RECURSIVE {_GRAMS}, m AS (SELECT id, t, min(id) OVER (PARTITION BY t) AS k FROM t), e AS (SELECT x AS a, y AS b FROM f UNION ALL SELECT y, x FROM f),
r AS (SELECT id AS a, id AS b FROM t UNION SELECT r.a, e.b FROM r JOIN e ON e.a = r.b),
l AS (SELECT a.id, b.k FROM m a JOIN e ON e.a = a.id JOIN m b ON b.id = e.b WHERE a.k <> b.k UNION SELECT a.id, b.id || chr(1) FROM m a JOIN e ON e.a = a.id JOIN m b ON b.id = e.b WHERE a.k = b.k)
SELECT a AS id, min(b) AS group_id, (SELECT count(*) FROM l WHERE l.id = r.a) AS n_links FROM r GROUP BY a"""

_BLANKS = "trim(regexp_replace({}, '[ \\t\\r\\n]+', ' ', 'g'), ' ')"
#: A fold written on its own: full-width forms by their distance to ASCII, format characters and blanks by their category,
#: ligatures and letters of other scripts by name of the Latin letter they look like.
_ALIKE = {"a": "аα", "b": "", "c": "сϲ", "d": "ԁ", "e": "е", "h": "һ", "i": "іı", "j": "јϳ", "l": "ӏ", "o": "оο", "p": "р", "q": "ԛ", "s": "ѕ", "v": "ν", "w": "ԝ", "x": "х", "y": "у",
          "A": "АΑ", "B": "ВΒ", "C": "СϹ", "E": "ЕΕ", "H": "НΗҺ", "I": "ІΙ", "J": "Ј", "K": "КΚ", "M": "МΜ", "N": "Ν", "O": "ОΟ", "P": "РΡ", "S": "Ѕ", "T": "ТΤ", "W": "Ԝ", "X": "ХΧ", "Y": "ҮΥ", "Z": "Ζ", "-": "‐‑‒"}


def _own_fold(x: str) -> str:
    pairs = [(c, latin) for latin, all_ in _ALIKE.items() for c in all_]
    pairs += [(chr(c), unicodedata.normalize("NFKC", chr(c))) for c in range(0x2F00, 0x2FD6)]  # radicals drawn like the ideograph
    each = """CASE WHEN unicode(c) BETWEEN 65281 AND 65374 THEN chr(unicode(c) - 65248) WHEN regexp_matches(c, '^[\\p{Cf}\\x{034F}\\x{180B}-\\x{180F}\\x{FE00}-\\x{FE0F}]$') THEN '' WHEN regexp_matches(c, '^[\\p{Z}\\s\\x{0085}]$') THEN ' '
      WHEN c = 'ﬁ' THEN 'fi' WHEN c = 'ﬂ' THEN 'fl' WHEN c = 'ﬀ' THEN 'ff' WHEN c = 'ﬃ' THEN 'ffi' WHEN c = 'ﬄ' THEN 'ffl' WHEN c = '…' THEN '...' ELSE c END"""
    plain = f"array_to_string(list_transform(string_split(nfc_normalize({x}), ''), lambda c: {each}), '')"
    return f"trim(regexp_replace(translate(nfc_normalize({plain}), '{''.join(c for c, _ in pairs)}', '{''.join(l for _, l in pairs)}'), ' +', ' ', 'g'), ' ')"


ORACLES["p5_found"] = f"""WITH j AS (SELECT DISTINCT id, {_BLANKS.format('verbatim_span')} AS s, {_BLANKS.format('text')} AS t FROM risk_instance r JOIN page_text p ON p.report_id = r.report_id AND p.page = r.page)
SELECT DISTINCT id AS risk_instance_id FROM (SELECT id, {_own_fold('s')} AS a, {_own_fold('t')} AS b FROM j WHERE s <> '' AND NOT contains(t, s)) WHERE a <> '' AND contains(b, a)"""
ORACLES["p5_folded_spans"] = f"SELECT id, {visual.fold_sql('verbatim_span')} AS verbatim_span_folded FROM risk_instance"
