"""Queries of the core operators over the test tables, each with the SQL that checks it.

The SQL is written on its own, in DuckDB's dialect; queries without it use similarity by matching blocks or a fold
over positioned words, and are tested against brute force.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.functions import text as T
from citeloom.functions.similarity import letter_counts, scored_pairs
from citeloom.operators import calls as C
from citeloom.operators import checks as K
from citeloom.operators import compare as X
from citeloom.operators import evaluate as E
from citeloom.operators import grounding as G
from citeloom.operators import layout as L
from citeloom.operators import locate as LO
from citeloom.operators import records as R
from citeloom.operators import runlog as RL
from citeloom.operators import sections as S
from citeloom.operators import serve as V
from citeloom.operators import warehouse as W
from citeloom.plans.staging import shared_folder
from citeloom.sources import read_table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


# --- SQL pieces -----------------------------------------------------------------------------------------------------


def _loose(x: str) -> str:
    return f"regexp_replace(translate(lower({x}), '–’', '-'''), '[^a-z0-9 ]+', ' ', 'g')"


def _norm(x: str) -> str:
    return f"trim(regexp_replace({_loose(x)}, ' +', ' ', 'g'))"


def _title(x: str) -> str:
    return _norm(f"regexp_replace({x}, '\\([^)]*\\)', ' ', 'g')")


def _slug(x: str, mark: str) -> str:
    return f"trim(regexp_replace(lower({x}), '[^a-z0-9]+', '{mark}', 'g'), '{mark}')"


def _words(x: str) -> str:
    return f"list_filter(string_split({_norm(x)}, ' '), lambda w: w <> '')"


def _tokens(x: str) -> str:
    return f"list_transform(regexp_extract_all({x}, '[A-Za-z0-9][A-Za-z0-9''’-]*'), lambda w: lower(w))"


_STOP = "[" + ", ".join(f"'{w}'" for w in T.STOP_WORDS) + "]"


def _content(x: str) -> str:
    return f"list_filter(list_distinct({_words(x)}), lambda w: length(w) > 2 AND NOT list_contains({_STOP}, w))"


def _sentences(x: str) -> str:
    return f"list_filter(string_split(regexp_replace({x}, '([.!?])[ \\t\\r\\n]+([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda s: trim(s) <> '')"


def _numbers(x: str) -> str:
    return f"regexp_extract_all(regexp_replace({x}, '\\p{{L}}', 'x', 'g'), '\\b[0-9][0-9.,%]*\\b')"


def _names(x: str) -> str:
    return (
        f"list_filter(list_transform(list_filter(regexp_split_to_array({x}, '[ \\t\\r\\n\\x0B\\f]+'), lambda w: w <> '')[2:], "
        "lambda w: regexp_replace(regexp_replace(w, '^[,.;:()]+', ''), '[,.;:()]+$', '')), lambda w: length(w) > 2 AND regexp_matches(w, '^\\p{Lu}'))"
    )


_PAGES = "pages AS (SELECT report_id, page, max(struct_pack(n := length(text), t := text)).t AS page_text FROM page_text WHERE text IS NOT NULL GROUP BY ALL)"
_STAR = "star AS (SELECT ri.*, r.company_id, r.fiscal_year, r.review_bodies, r.review_frequency, c.name AS company, c.sector FROM risk_instance ri JOIN report r ON r.id = ri.report_id JOIN company c ON c.id = r.company_id)"
_STATUS = """best AS (
  SELECT ri.canonical_risk_id AS risk, r.fiscal_year AS y, min(ri.prominence) AS p, any_value(k.company_id) AS company_id
  FROM risk_instance ri JOIN report r ON r.id = ri.report_id JOIN canonical_risk k ON k.id = ri.canonical_risk_id GROUP BY 1, 2),
filed AS (SELECT DISTINCT company_id, fiscal_year AS y FROM report),
status AS (
  SELECT b.risk, b.y, CASE WHEN a.risk IS NULL OR a.p IS NULL THEN 'new' WHEN b.p < a.p THEN 'elevated' ELSE 'continuing' END AS status
  FROM best b LEFT JOIN best a ON a.risk = b.risk AND a.y + 1 = b.y
  WHERE (b.company_id, b.y - 1) IN (SELECT company_id, y FROM filed)
  UNION ALL
  SELECT b.risk, b.y + 1, 'removed' FROM best b
  WHERE NOT EXISTS (FROM best n WHERE n.risk = b.risk AND n.y = b.y + 1) AND EXISTS (FROM filed f WHERE f.company_id = b.company_id AND f.y > b.y))"""


# --- Status, serving ------------------------------------------------------------------------------------------------


@query(f"WITH {_STATUS} SELECT risk AS canonical_risk_id, CAST(y AS INT) AS fiscal_year, status FROM status")
def status_year_over_year(spark: SparkSession, d: str) -> DataFrame:
    return W.risk_status(*(read_table(spark, d, t) for t in ("risk_instance", "report", "canonical_risk")))


@query(
    f"WITH {_STATUS} SELECT c.name AS company, CAST(y AS INT) AS fiscal_year, k.id AS canonical_risk_id, k.canonical_title, status FROM status "
    "JOIN canonical_risk k ON k.id = risk JOIN company c ON c.id = k.company_id WHERE status IN ('new', 'elevated')"
)
def newly_elevated(spark, d):
    return V.newly_elevated(V.Tables.read(spark, d))


@query(
    f"WITH {_STAR} SELECT company, fiscal_year, id, title, category, page, section, review_frequency, array_to_string(review_bodies, '; ') AS review_bodies "
    "FROM star WHERE source_register = 'erm_main_risk' AND fiscal_year = 2023"
)
def top_register_records(spark, d):
    return V.top_register_records(V.Tables.read(spark, d), year=2023)


@query(f"WITH {_STAR} SELECT DISTINCT company, sector, fiscal_year, title, source_register, page FROM star WHERE category = 'cyber'")
def companies_with_category(spark, d):
    return V.companies_with_category(V.Tables.read(spark, d), "cyber")


_TOP = "id, company, fiscal_year, title, category, page, prominence"


@query(f"WITH {_STAR} SELECT {_TOP} FROM star WHERE category IN ('cyber', 'climate') AND source_register = 'esrs_financial_risk' ORDER BY fiscal_year DESC, prominence NULLS FIRST, page NULLS FIRST, id LIMIT 100")
def filtered_records(spark, d):
    intent = V.Intent(categories=["cyber", "climate"], source_register="esrs_financial_risk")
    return V.records(V.Tables.read(spark, d), intent, 100).selectExpr(*_TOP.split(", "))


@query(f"WITH {_STAR} SELECT {_TOP} FROM star WHERE false")
def filtered_unknown_sector(spark, d):
    return V.records(V.Tables.read(spark, d), V.Intent(sector="no such sector at all"), 100).selectExpr(*_TOP.split(", "))


@query(f"WITH {_STATUS}, {_STAR} SELECT {_TOP} FROM star WHERE (canonical_risk_id, fiscal_year + 1) IN (SELECT risk, y FROM status WHERE status = 'removed')")
def filtered_removed(spark, d):
    return V.records(V.Tables.read(spark, d), V.Intent(status="removed"), None).selectExpr(*_TOP.split(", "))


@query(f"WITH {_STATUS}, {_STAR} SELECT {_TOP} FROM star WHERE (canonical_risk_id, fiscal_year) IN (SELECT risk, y FROM status WHERE status = 'elevated') AND fiscal_year IN (2022, 2023)")
def filtered_elevated_years(spark, d):
    return V.records(V.Tables.read(spark, d), V.Intent(status="elevated", years=[2022, 2023]), None).selectExpr(*_TOP.split(", "))


@query("""WITH c AS (SELECT DISTINCT * FROM risk_citation)
SELECT ri.id, CAST(count(c.risk_instance_id) AS BIGINT) AS n_citations, coalesce(string_agg(c.section || ':' || c.page, ',' ORDER BY c.page, c.section, c.span), '') AS places
FROM risk_instance ri LEFT JOIN c ON c.risk_instance_id = ri.id GROUP BY ri.id""")
def record_with_citations(spark, d):
    rows = V.with_citations(read_table(spark, d, "risk_instance"), read_table(spark, d, "risk_citation"))
    places = F.array_join(F.transform(F.array_sort(F.transform("citations", lambda c: F.struct(c["page"], c["section"], c["span"]))), lambda c: F.concat(c["section"], F.lit(":"), c["page"].cast("string"))), ",")
    return rows.select("id", F.size("citations").cast("long").alias("n_citations"), places.alias("places"))


_SEARCH = "' ' || trim(regexp_replace(strip_accents(lower(coalesce({}, ''))), '[^\\p{{L}}\\p{{N}}]+', ' ', 'g')) || ' '"


@query(
    f"SELECT id FROM risk_instance WHERE {_SEARCH.format('title')} LIKE '% drought %' OR {_SEARCH.format('description')} LIKE '% drought %' "
    f"OR {_SEARCH.format('title')} LIKE '% re tender %' OR {_SEARCH.format('description')} LIKE '% re tender %'"
)
def fulltext_match(spark, d):
    hit = T.matches_any([F.col("title"), F.col("description")], 'drought re-tender "')
    return read_table(spark, d, "risk_instance").where(hit).select("id")


@query(f"""WITH s AS (SELECT DISTINCT sector FROM company WHERE sector IS NOT NULL), w AS (SELECT sector, {_words('sector')} AS have, ['energy'] AS want FROM s)
SELECT sector FROM w WHERE list_sort(have) = list_sort(want)
  OR NOT EXISTS (FROM w WHERE list_sort(have) = list_sort(want)) AND len(list_filter(have, lambda h: h = 'energy' OR length(h) >= 5 AND (starts_with(h, 'energy') OR starts_with('energy', h)))) > 0""")
def sector_resolution(spark, d):
    return V.sector_matches(read_table(spark, d, "company"), "energy").where("tier <= 2").select("sector")


@query()
def sector_spelling(spark, d):
    return V.sector_matches(read_table(spark, d, "company"), "utilites")


# --- Text -----------------------------------------------------------------------------------------------------------


@query(f"SELECT id, {_title('canonical_title')} AS title_form, {_norm('canonical_title')} AS text_form, {_loose('canonical_title')} AS loose_form FROM canonical_risk")
def normalize_text(spark, d):
    c = F.col("canonical_title")
    return read_table(spark, d, "canonical_risk").select("id", T.norm_title(c).alias("title_form"), T.norm_text(c).alias("text_form"), T.norm_loose(c).alias("loose_form"))


_PLAIN_TITLE = "regexp_replace(canonical_title, '[''’]', '', 'g')"


@query(f"SELECT id, {_slug('canonical_title', '_')} AS slug, company_id || '-erm-' || {_slug(_PLAIN_TITLE, '-')} AS canonical_key FROM canonical_risk")
def slugify(spark, d):
    c = F.col("canonical_title")
    return read_table(spark, d, "canonical_risk").select("id", T.slug(c).alias("slug"), T.canonical_key(F.col("company_id"), F.lit(None).cast("string"), c).alias("canonical_key"))


@query(f"SELECT doc_id, CAST(len({_tokens('text')}) AS INT) AS n_tokens, CAST(len({_content('text')}) AS INT) AS n_content, CAST(len(list_distinct({_words('text')})) AS INT) AS n_context FROM documents")
def token_counts(spark, d):
    c = F.col("text")
    return read_table(spark, d, "documents").select("doc_id", F.size(T.word_tokens(c)).alias("n_tokens"), F.size(T.content_words(c)).alias("n_content"), F.size(T.context_words(c)).alias("n_context"))


@query(f"SELECT doc_id, CAST(len({_sentences('text')}) AS INT) AS n_sentences, CAST(len({_numbers('text')}) AS INT) AS n_numbers, CAST(len(regexp_extract_all(text, '[0-9]+(?:[.,][0-9]+)*')) AS INT) AS n_figures, array_to_string({_names('text')}, ' ') AS names FROM documents")
def sentence_facts(spark, d):
    c = F.col("text")
    return read_table(spark, d, "documents").select(
        "doc_id", F.size(T.plain_sentences(c)).alias("n_sentences"), F.size(T.numbers(c)).alias("n_numbers"), F.size(T.figures(c)).alias("n_figures"), F.array_join(T.names(c), " ").alias("names")
    )


@query("""SELECT id, CASE WHEN contains(lower(description), 'immaterial') THEN 'immaterial'
  WHEN contains(lower(description), 'opportunit') AND NOT contains(right(string_split(lower(description), 'opportunit')[1], 40), 'risk') THEN 'opportunity'
  WHEN contains(lower(description), 'risk') THEN 'risk' END AS marker,
  regexp_replace(NORM, '\\b([a-z]{4,}[^su])s\\b', '\\1', 'g') AS singular_title, substr(regexp_replace(lower(title), '[^a-z0-9]+', '', 'g'), 1, 40) AS title_key FROM risk_instance""".replace("NORM", _norm("title")))
def markers_and_keys(spark, d):
    return read_table(spark, d, "risk_instance").select(
        "id", T.lexical_marker(F.col("description")).alias("marker"), T.singular(T.norm_text(F.col("title"))).alias("singular_title"), T.question_key(F.col("title")).alias("title_key")
    )


@query("""SELECT report_id, page, md5(text) AS key, substr(coalesce(l[2], l[1]), 1, 80) AS heading FROM (
  SELECT report_id, page, text, list_filter(list_transform(string_split(text, chr(10)), lambda x: trim(x)), lambda x: x <> '') AS l FROM (SELECT DISTINCT report_id, page, text FROM page_text WHERE text IS NOT NULL))""")
def block_headings(spark, d):
    pages = read_table(spark, d, "page_text").where("text IS NOT NULL").select("report_id", "page", "text").distinct()
    return pages.select("report_id", "page", F.md5("text").alias("key"), T.block_heading(F.col("text")).alias("heading"))


@query("SELECT id, nullif(regexp_extract(review_frequency, 'every ([A-Za-z0-9]+) months', 0), '') AS every, to_json(review_bodies) AS bodies, CAST(len(review_bodies) AS INT) AS n FROM report")
def review_facts(spark, d):
    return read_table(spark, d, "report").select("id", T.review_every(F.col("review_frequency")).alias("every"), F.to_json("review_bodies").alias("bodies"), F.nullif(F.size("review_bodies"), F.lit(-1)).alias("n"))


# --- Grounding ------------------------------------------------------------------------------------------------------

_TRIGRAMS = "list_transform(range(1, greatest(len({0}) - 1, 1)), lambda i: array_to_string({0}[i:i + 2], ' '))"


@query(f"""WITH {_PAGES}, t AS (SELECT id, {_tokens('verbatim_span')} AS a, {_tokens('page_text')} AS b FROM risk_instance JOIN pages USING (report_id, page) WHERE verbatim_span IS NOT NULL),
g AS (SELECT id, a, b, {_TRIGRAMS.format('a')} AS ga, list_distinct({_TRIGRAMS.format('b')}) AS gb FROM t)
SELECT id, round(CASE WHEN len(a) < 3 THEN CAST(contains(array_to_string(b, ' '), array_to_string(a, ' ')) AS DOUBLE) ELSE len(list_filter(ga, lambda x: list_contains(gb, x))) / len(ga) END, 6) AS fidelity FROM g""")
def ngram_fidelity(spark, d):
    return G.span_fidelity(read_table(spark, d, "risk_instance"), read_table(spark, d, "page_text"))


@query(f"""WITH p AS (SELECT DISTINCT report_id, page, text FROM page_text WHERE text IS NOT NULL), a AS (SELECT report_id, page, unnest({_tokens('text')}) AS word FROM p),
b AS (SELECT report_id, page, unnest({_tokens('verbatim_span')}) AS word FROM risk_instance WHERE verbatim_span IS NOT NULL),
x AS (SELECT report_id, page, word, count(*) AS n FROM a GROUP BY ALL), y AS (SELECT report_id, page, word, count(*) AS n FROM b GROUP BY ALL)
SELECT report_id, page, CAST(sum(x.n) AS BIGINT) AS page_words, CAST(sum(least(x.n, coalesce(y.n, 0))) AS BIGINT) AS covered_words, round(sum(least(x.n, coalesce(y.n, 0))) / sum(x.n), 6) AS coverage
FROM x LEFT JOIN y USING (report_id, page, word) GROUP BY ALL""")
def page_coverage(spark, d):
    words = lambda df, c: df.select("report_id", "page", F.explode(T.word_tokens(F.col(c))).alias("word"))
    pages = read_table(spark, d, "page_text").where("text IS NOT NULL").select("report_id", "page", "text").distinct()
    return G.page_coverage(words(pages, "text"), words(read_table(spark, d, "risk_instance"), "verbatim_span"), ["report_id", "page"])


@query(f"SELECT DISTINCT ri.id FROM risk_instance ri JOIN page_text p ON p.report_id = ri.report_id AND p.page = ri.page WHERE contains({_norm('p.text')}, substr({_norm('verbatim_span')}, 1, 80))")
def span_on_page(spark, d):
    cand = read_table(spark, d, "risk_instance").select("id", "report_id", "page", "verbatim_span")
    return R.on_their_page(cand, read_table(spark, d, "page_text"), ["report_id", "page"]).select("id").distinct()


_TEXTS = """sp AS (SELECT risk_instance_id, string_agg(span, ' ' ORDER BY span) AS cited FROM (SELECT DISTINCT risk_instance_id, span FROM risk_citation WHERE span IS NOT NULL) GROUP BY 1),
cp AS (SELECT id, string_agg(page_text, ' ' ORDER BY page_text) AS cited_pages FROM (SELECT DISTINCT ri.id, ri.report_id, c.page FROM risk_citation c JOIN risk_instance ri ON ri.id = c.risk_instance_id) JOIN pages USING (report_id, page) GROUP BY 1),
src AS (SELECT ri.*, coalesce(page_text, '') AS page_text, coalesce(cited, '') AS cited, coalesce(cited_pages, '') AS cited_pages FROM risk_instance ri LEFT JOIN pages USING (report_id, page) LEFT JOIN sp ON sp.risk_instance_id = ri.id LEFT JOIN cp ON cp.id = ri.id)"""


def _checked_sql(source: str, name: str) -> str:
    """Tables that check the rows of ``source`` (id, description, verbatim_span, potential_impact, mitigation and the texts
    of ``_TEXTS``); the last one, ``name``, has the number of problems of each kind."""
    return f"""{name}_o AS (SELECT id, coalesce(description, '') AS description, {_norm("coalesce(verbatim_span, '')")} AS span, coalesce(mitigation, '') AS mitigation, {_norm('page_text')} AS page,
  list_distinct({_words("page_text || ' ' || cited_pages")}) AS pool, concat_ws(' ', nullif(verbatim_span, ''), nullif(potential_impact, ''), nullif(cited, '')) AS own FROM {source}),
{name}_k AS (SELECT *, {_norm('own')} AS own_norm, list_distinct({_words('own')}) AS context, {_sentences('description')} AS s FROM {name}_o),
{name}_one AS (SELECT id, own_norm, page, context, unnest(s) AS t FROM {name}_k),
{name}_per AS (SELECT id, CAST(len(w) > 0 AND len(list_intersect(w, context)) / len(w) < 0.3 AS INT) AS low, nums, nms FROM (SELECT id, context, {_content('t')} AS w,
  len(list_filter({_numbers('t')}, lambda n: {_norm('n')} <> '' AND NOT contains(own_norm, {_norm('n')}) AND NOT contains(page, {_norm('n')}))) AS nums,
  len(list_filter({_names('t')}, lambda n: {_norm('n')} <> '' AND NOT contains(own_norm, {_norm('n')}) AND NOT contains(page, {_norm('n')}))) AS nms FROM {name}_one)),
{name}_sum AS (SELECT id, sum(low) AS low, sum(nums) AS nums, sum(nms) AS nms FROM {name}_per GROUP BY id),
{name} AS (SELECT k.id, NOT contains(page, substr(span, 1, 100)) AS span_not_on_page, len(s) NOT BETWEEN 2 AND 3 AS sentence_count, CAST(coalesce(low, 0) AS INT) AS low_overlap, CAST(coalesce(nums, 0) AS INT) AS numbers_missing,
  CAST(coalesce(nms, 0) AS INT) AS names_missing, mitigation <> '' AND len({_content('mitigation')}) > 0 AND len(list_intersect({_content('mitigation')}, pool)) / len({_content('mitigation')}) < 0.5 AS weak_mitigation
  FROM {name}_k k LEFT JOIN {name}_sum USING (id))"""


_FLAGGED = "CAST(span_not_on_page AS INT) + CAST(sentence_count AS INT) + low_overlap + numbers_missing + names_missing + CAST(weak_mitigation AS INT)"


@query(f"WITH {_PAGES}, {_TEXTS}, {_checked_sql('src', 'k')} SELECT * FROM k")
def grounding_flags(spark, d):
    rows = G.grounded(*(read_table(spark, d, t) for t in ("risk_instance", "page_text", "risk_citation")))
    of = lambda part: F.size(F.filter("problems", lambda p: F.contains(p, F.lit(part))))
    return rows.select(
        "id", (of("span_not_on_page") > 0).alias("span_not_on_page"), (of("sentence_count") > 0).alias("sentence_count"), of("_ungrounded").cast("int").alias("low_overlap"),
        of("number_not").alias("numbers_missing"), of("name_not").alias("names_missing"), (of("mitigation_not") > 0).alias("weak_mitigation"),
    )


_REPLY = "struct<title:string,description:string,mitigation:string,category:string,confidence:double,poor_fit:boolean>"


def _replies(spark, d, kind: str) -> DataFrame:
    """The last recorded reply of each call of a kind, by record and sample."""
    calls = read_table(spark, d, "calls").where((F.split_part("call_id", F.lit("-"), F.lit(1)) == kind) & F.expr("try_parse_json(response_content)").isNotNull() & F.json_object_keys("response_content").isNotNull())
    last = calls.groupBy("call_id").agg(F.max_by(F.struct("sample", "response_content"), F.struct("created_at", "response_content")).alias("r"))
    return last.select(F.regexp_extract("call_id", "^[a-z]+-(.*)-[^-]+$", 1).alias("id"), "call_id", "r.sample", F.from_json("r.response_content", _REPLY).alias("reply"))


_REPLIES = """j AS (SELECT call_id, sample, response_content AS r FROM (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY created_at DESC NULLS LAST, response_content DESC) AS n FROM calls
  WHERE split_part(call_id, '-', 1) = '{kind}' AND json_valid(response_content) AND json_type(response_content) = 'OBJECT') WHERE n = 1),
v AS (SELECT regexp_extract(call_id, '^[a-z]+-(.*)-[^-]+$', 1) AS id, call_id, sample, r->>'$.title' AS title, r->>'$.description' AS description, r->>'$.mitigation' AS mitigation, r->>'$.category' AS category,
  TRY_CAST(r->>'$.confidence' AS DOUBLE) AS confidence FROM j)"""


@query(f"""WITH {_PAGES}, {_TEXTS}, {_REPLIES.format(kind='repair')}, fix AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY call_id) AS n FROM v) WHERE n = 1),
{_checked_sql('src', 'a')}, tried AS (SELECT src.* REPLACE (fix.description AS description, CASE WHEN coalesce(src.mitigation, '') <> '' THEN fix.mitigation ELSE src.mitigation END AS mitigation) FROM src JOIN fix USING (id)),
{_checked_sql('tried', 'b')}, n AS (SELECT id, a.n AS before, b.n AS after FROM (SELECT id, {_FLAGGED} AS n FROM a) a LEFT JOIN (SELECT id, {_FLAGGED} AS n FROM b) b USING (id))
SELECT n.id, before > 0 AND coalesce(after = 0, false) AS repaired, CAST(CASE WHEN before > 0 AND after = 0 THEN 0 WHEN before > 0 AND after IS NULL THEN before + 1 ELSE before END AS INT) AS problems,
CASE WHEN before > 0 AND coalesce(after > 0, true) THEN 'pending_review' ELSE review_state END AS review_state, md5(CASE WHEN before > 0 AND after = 0 THEN fix.description ELSE ri.description END) AS text
FROM n JOIN risk_instance ri USING (id) LEFT JOIN fix USING (id)""")
def grounding_repair(spark, d):
    fixes = _replies(spark, d, "repair").groupBy("id").agg(F.min_by("reply", "call_id").alias("reply")).select("id", "reply.title", "reply.description", "reply.mitigation")
    rows = G.repaired(*(read_table(spark, d, t) for t in ("risk_instance", "page_text", "risk_citation")), fixes)
    return rows.select("id", "repaired", F.size("problems").alias("problems"), "review_state", F.md5("description").alias("text"))


@query()
def grounding_stemmed(spark, d):
    """The check by the other backend."""
    rows = G.grounded(*(read_table(spark, d, t) for t in ("risk_instance", "page_text", "risk_citation")), "stemmed")
    return rows.select("id", F.array_join("problems", ",").alias("problems"))


@query(f"""WITH {_PAGES} SELECT section, CAST(count(*) AS BIGINT) AS records, CAST(count_if(bad) AS BIGINT) AS failed, round(avg(CASE WHEN bad THEN 0 ELSE 1 END), 6) AS pass_rate, CASE WHEN round(avg(CASE WHEN bad THEN 0 ELSE 1 END), 6) < 0.8 THEN 'warning' ELSE 'ok' END AS outcome
FROM (SELECT section, NOT contains({_norm("coalesce(page_text, '')")}, substr({_norm("coalesce(verbatim_span, '')")}, 1, 100)) AS bad FROM risk_instance LEFT JOIN pages USING (report_id, page)) GROUP BY section""")
def grounding_pass_rate(spark, d):
    records = read_table(spark, d, "risk_instance")
    rows = G.grounded(records, read_table(spark, d, "page_text"), read_table(spark, d, "risk_citation")).withColumn("problems", F.filter("problems", lambda p: p == "span_not_on_page"))
    return G.pass_rate(rows.join(records.select("id", "section"), "id"), ["section"])


# --- Descriptions ---------------------------------------------------------------------------------------------------


@query(f"""WITH {_REPLIES.format(kind='describe')}, f AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY call_id) AS n FROM v WHERE sample = 0) WHERE n = 1),
c AS (SELECT id, category, count(*) AS n, min(sample) AS seen FROM v WHERE sample < 3 AND category IS NOT NULL GROUP BY ALL), w AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, seen, category DESC) AS k FROM c) WHERE k = 1)
SELECT f.id, f.call_id, CASE WHEN confidence < 0.6 AND w.category <> f.category THEN w.category ELSE f.category END AS category,
CASE WHEN confidence < 0.6 AND w.category <> f.category THEN round(w.n / 3, 6) ELSE confidence END AS confidence, coalesce(confidence < 0.6 AND w.category <> f.category, false) AS changed FROM f LEFT JOIN w USING (id)""")
def described_votes(spark, d):
    rows = _replies(spark, d, "describe").select("id", "call_id", "sample", "reply.category", "reply.confidence")
    return R.described(rows, "id").select("id", "call_id", "category", "confidence", "changed")


_PRIORS = {"E1": ["climate"], "E2": ["regulatory", "operational"], "S1": ["operational"], "G1": ["regulatory"]}
_PRIOR_SQL = "CASE source_taxonomy " + " ".join(f"WHEN '{k}' THEN '{', '.join(v)}'" for k, v in _PRIORS.items()) + " END"


@query(f"""SELECT id, md5(concat_ws(chr(10), 'Register: ' || coalesce(source_register, 'none') || ', prominence ' || prominence, 'Section: ' || nullif(section, ''), 'Page: ' || page, 'Title: ' || nullif(title, ''), 'Topic: ' || nullif(source_taxonomy, ''),
'Likely categories: ' || {_PRIOR_SQL}, 'Printed: ' || nullif(verbatim_span, ''), 'Impact: ' || nullif(potential_impact, ''), coalesce('Mitigation: ' || nullif(mitigation, ''), 'No mitigation is printed.'))) AS prompt FROM risk_instance""")
def describe_prompts(spark, d):
    rows = read_table(spark, d, "risk_instance")
    return rows.select("id", F.md5(R.prompt_text({c: F.col(c) for c in rows.columns}, _PRIORS)).alias("prompt"))


# --- Matching -------------------------------------------------------------------------------------------------------


def _titles(spark, d):
    wanted = read_table(spark, d, "risk_instance").join(read_table(spark, d, "report").select(F.col("id").alias("report_id"), "company_id"), "report_id")
    wanted = wanted.select("company_id", F.col("id").alias("want_no"), F.col("title").alias("want_title")).where("company_id IS NOT NULL")
    offered = read_table(spark, d, "canonical_risk").select("company_id", F.dense_rank().over(S.Window.partitionBy("company_id").orderBy("id")).alias("offer_no"), F.col("canonical_title").alias("title"))
    return wanted, offered


@query(f"""WITH w AS (SELECT r.company_id, ri.id AS want_no, {_title('ri.title')} AS a FROM risk_instance ri JOIN report r ON r.id = ri.report_id),
o AS (SELECT company_id, id, {_title('canonical_title')} AS b FROM canonical_risk),
m AS (SELECT want_no, max(CASE WHEN a = b THEN 2 WHEN starts_with(a, b || ' ') OR starts_with(b, a || ' ') THEN 1 END) AS g FROM w JOIN o USING (company_id) WHERE a <> '' AND b <> '' GROUP BY 1)
SELECT want_no AS id, CASE g WHEN 2 THEN 'exact' ELSE 'variant' END AS match_grade FROM m WHERE g IS NOT NULL""")
def title_grades(spark, d):
    return S.best_title(*_titles(spark, d), ["company_id"]).where("match_score >= 0.95 AND match_grade IN ('exact', 'variant')").select(F.col("want_no").alias("id"), "match_grade")


@query()
def title_similarity(spark, d):
    return S.best_title(*_titles(spark, d), ["company_id"]).select(F.col("want_no").alias("id"), "matched_title", "match_grade", F.round("match_score", 6).alias("match_score"))


def _sides(spark, d):
    rows = read_table(spark, d, "risk_instance").select("id", "report_id", "page", "title", F.col("verbatim_span").alias("span"), "source_register", "prominence")
    return rows.where("source_register = 'erm_main_risk'"), rows.where("source_register = 'esrs_financial_risk'")


@query()
def candidate_agreement(spark, d):
    a, b = (s.select("report_id", F.col("id").alias("seq"), "title", "span") for s in _sides(spark, d))
    return R.agreement(a, b, ["report_id"])


@query(f"""WITH r AS (SELECT id, report_id, source_register AS s, string_split({_norm("coalesce(title, '') || ' ' || category")}, ' ') AS w, prominence, page FROM risk_instance WHERE category IS NOT NULL),
h AS (SELECT *, list_contains(w, 'cyber') AS h1, list_has_all(w, ['corruption', 'bribery']) AS h2 FROM r)
SELECT b.id AS merged_id, arg_min(a.id, struct_pack(p := a.prominence, g := a.page, i := a.id)) AS anchor_id FROM h a JOIN h b USING (report_id)
WHERE a.s = 'erm_main_risk' AND b.s = 'esrs_financial_risk' AND (a.h1 AND b.h1 OR a.h2 AND b.h2) GROUP BY b.id""")
def hinted_pairs(spark, d):
    """Pairs by hint words alone, sought in the title with the category behind it."""
    named = read_table(spark, d, "risk_instance").where("category IS NOT NULL").select("id", F.concat_ws(" ", F.coalesce("title", F.lit("")), "category").alias("named"))
    a, b = (side.join(named, "id") for side in _sides(spark, d))
    pairs = a.select("report_id", F.col("id").alias("anchor_id"), F.col("named").alias("ta"), F.struct("prominence", "page", "id").alias("r")).join(b.select("report_id", F.col("id").alias("merged_id"), F.col("named").alias("tb")), "report_id")
    return pairs.where(R.hinted(F.col("ta"), F.col("tb"))).groupBy("merged_id").agg(F.min_by("anchor_id", "r").alias("anchor_id"))


@query()
def merge_pairs(spark, d):
    a, b = _sides(spark, d)
    ranked = a.withColumn("rank", F.struct("prominence", "page"))
    return R.same_risk_pairs(ranked, b, ["report_id"]).select("report_id", "merged_id", "anchor_id")


@query("""SELECT id, 'r' || lpad(CAST(row_number() OVER (PARTITION BY report_id ORDER BY prominence NULLS FIRST, page NULLS FIRST, id) AS VARCHAR), 2, '0') AS record_no FROM risk_instance""")
def record_numbers(spark, d):
    return R.numbered(read_table(spark, d, "risk_instance"), "report_id").select("id", "record_no")


@query()
def golden_assignment(spark, d):
    wanted, offered = _titles(spark, d)
    reports = read_table(spark, d, "risk_instance").select(F.col("id").alias("want_no"), "report_id")
    left, right = wanted.withColumn("a", T.norm_title(F.col("want_title"))), offered.withColumn("b", T.norm_title(F.col("title")))
    left, right = left.withColumn("a_n", letter_counts(F.col("a"))), right.withColumn("b_n", letter_counts(F.col("b")))
    pairs = left.join(reports, "want_no").join(right, "company_id").select("report_id", F.col("offer_no").alias("golden_no"), F.col("want_no").alias("record_no"), "a", "b", "a_n", "b_n")
    scores = scored_pairs(pairs, "b", "a", E.MATCH_FLOOR).select("report_id", "golden_no", "record_no", "score")
    return E.assign(scores, "report_id")


# --- Layout ---------------------------------------------------------------------------------------------------------


def _page_words(spark, d) -> DataFrame:
    """Positioned words of the page texts: six points a character, twelve points a line, lines slightly uneven."""
    pages = read_table(spark, d, "page_text").where("text IS NOT NULL").select(F.col("report_id").alias("doc_id"), F.col("page").alias("pdf_index"), "text").groupBy("doc_id", "pdf_index").agg(F.max("text").alias("text"))
    lines = pages.select("doc_id", "pdf_index", F.posexplode(F.split("text", "\n")).alias("ln", "line"))
    words = lines.select("doc_id", "pdf_index", "ln", F.posexplode(F.filter(F.split("line", " "), lambda w: w != "")).alias("i", "text"))
    jitter = F.pmod(F.xxhash64("doc_id", "ln", "i"), F.lit(20)) / 10.0
    return words.select(
        "doc_id", "pdf_index", (F.col("ln") * 1000 + F.col("i")).cast("int").alias("seq"), "text", (F.col("i") * 40.0).alias("x0"), (F.col("i") * 40.0 + 6.0 * F.length("text")).alias("x1"),
        (F.col("ln") * 12.0 + jitter).alias("top"), (F.col("ln") * 12.0 + jitter + 10.0).alias("bottom"), F.when(F.col("ln") == 1, 12.0).otherwise(9.0).alias("size"), F.lit("Regular").alias("font"),
    )


@query("""WITH p AS (SELECT report_id, page, max(text) AS text FROM page_text WHERE text IS NOT NULL GROUP BY ALL), l AS (SELECT report_id, page, unnest(string_split(text, chr(10))) AS line FROM p)
SELECT report_id AS doc_id, page AS pdf_index, CAST(count(*) AS BIGINT) AS lines FROM l WHERE trim(line, ' ') <> '' GROUP BY ALL""")
def line_clusters(spark, d):
    return L.cluster_lines(_page_words(spark, d)).groupBy("doc_id", "pdf_index").agg(F.count_distinct("line_no").alias("lines"))


@query("""WITH p AS (SELECT report_id, page, max(text) AS text FROM page_text WHERE text IS NOT NULL GROUP BY ALL), l AS (SELECT report_id, page, i, array_to_string(list_filter(string_split(s[i], ' '), lambda w: w <> ''), ' ') AS line FROM (SELECT report_id, page, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT report_id, page, string_split(text, chr(10)) AS s FROM p)))
SELECT report_id AS doc_id, page AS pdf_index, CAST(row_number() OVER (PARTITION BY report_id, page ORDER BY i) AS INT) AS line_no, line AS text FROM l WHERE line <> ''""")
def page_lines(spark, d):
    return L.line_text(L.cluster_lines(_page_words(spark, d))).select("doc_id", "pdf_index", "line_no", "text")


_CODE_KEY = _slug("regexp_replace(title, '[''’]', '', 'g')", "-")


@query(f"SELECT id, report_id || '-' || coalesce(nullif(lower(source_taxonomy), ''), 'erm') || CASE WHEN {_CODE_KEY} IS NULL THEN '' ELSE '-' || {_CODE_KEY} END AS canonical_key FROM risk_instance")
def canonical_keys(spark, d):
    return read_table(spark, d, "risk_instance").select("id", T.canonical_key(F.col("report_id"), F.col("source_taxonomy"), F.col("title")).alias("canonical_key"))


_HOURS = "h AS (SELECT ts, row_number() OVER (ORDER BY ts) AS n FROM (SELECT DISTINCT date_trunc('day', ts) AS ts FROM events WHERE ts IS NOT NULL))"


@query(f"WITH {_HOURS} SELECT e.event_id, CAST(h.n AS INT) AS band_no FROM events e ASOF JOIN h ON e.ts >= h.ts")
def band_asof(spark, d):
    events = read_table(spark, d, "events").where("ts IS NOT NULL").select("event_id", "ts")
    days = events.select(F.date_trunc("day", "ts").alias("ts")).distinct().withColumn("band_no", F.row_number().over(S.Window.orderBy("ts")))
    return L.asof(events, days, "ts", "band_no").select("event_id", "band_no")


@query("""WITH a AS (SELECT report_id, page, row_number() OVER w AS band_no, lead(page) OVER w AS nxt FROM (SELECT DISTINCT report_id, page FROM page_text) WINDOW w AS (PARTITION BY report_id ORDER BY page))
SELECT ri.id, CAST(a.band_no AS INT) AS band_no FROM risk_instance ri JOIN a ON a.report_id = ri.report_id AND ri.page >= a.page AND ri.page < coalesce(a.nxt, 1000)""")
def interval_rows(spark, d):
    rules = read_table(spark, d, "page_text").select(F.col("report_id").alias("doc_id"), F.lit(0).alias("pdf_index"), F.col("page").cast("double").alias("y"))
    ends = rules.select("doc_id", "pdf_index").distinct().withColumn("table_end", F.lit(1000.0))
    items = read_table(spark, d, "risk_instance").select("id", F.col("report_id").alias("doc_id"), F.lit(0).alias("pdf_index"), F.col("page").cast("double").alias("top"))
    return L.in_bands(items, L.rule_bands(rules, ends)).select("id", "band_no")


@query("""SELECT ri.id, max(p.page) AS page_above FROM risk_instance ri LEFT JOIN page_text p ON p.report_id = ri.report_id AND p.page <= ri.page AND p.text IS NOT NULL GROUP BY ri.id""")
def nearest_above(spark, d):
    heads = read_table(spark, d, "page_text").where("text IS NOT NULL").select("report_id", "page", F.col("page").alias("page_above")).distinct()
    return L.nearest_above(read_table(spark, d, "risk_instance").select("id", "report_id", "page"), heads, ["report_id"], "page", "page", "page_above").select("id", "page_above")


@query("""WITH l AS (SELECT report_id, page, i, trim(s[i]) AS line FROM (SELECT report_id, page, s, unnest(range(1, len(s) + 1)) AS i FROM (SELECT report_id, page, string_split(max(text), chr(10)) AS s FROM page_text WHERE text IS NOT NULL GROUP BY ALL)) WHERE trim(s[i]) <> ''),
e AS (SELECT report_id, page, sum(CASE WHEN contains(line, ' – ') AND length(line) < 80 THEN 1 ELSE 0 END) OVER (PARTITION BY report_id, page ORDER BY i ROWS UNBOUNDED PRECEDING) AS entry_no FROM l)
SELECT report_id, page, CAST(entry_no AS INT) AS entry_no, CAST(count(*) AS BIGINT) AS lines FROM e GROUP BY ALL""")
def entry_groups(spark, d):
    pages = read_table(spark, d, "page_text").where("text IS NOT NULL").groupBy("report_id", "page").agg(F.max("text").alias("text"))
    lines = pages.select("report_id", "page", F.posexplode(F.split("text", "\n")).alias("i", "line")).withColumn("line", F.trim("line")).where("line <> ''")
    head = F.contains("line", F.lit(" – ")) & (F.length("line") < 80)
    return L.numbered_entries(lines, ["report_id", "page"], ["i"], head).groupBy("report_id", "page", "entry_no").agg(F.count("*").alias("lines"))


@query("""SELECT id, last_value(nullif(source_taxonomy, '') IGNORE NULLS) OVER (PARTITION BY report_id ORDER BY page NULLS FIRST, id ROWS UNBOUNDED PRECEDING) AS source_taxonomy,
CASE WHEN count(*) OVER (PARTITION BY report_id, page) > 1 THEN chr(CAST(96 + row_number() OVER (PARTITION BY report_id, page ORDER BY id) AS INT)) ELSE '' END AS suffix FROM risk_instance""")
def filled_and_suffixed(spark, d):
    rows = read_table(spark, d, "risk_instance").select("id", "report_id", "page", "source_taxonomy")
    return L.with_suffixes(L.filled_down(rows, ["report_id"], ["page", "id"], "source_taxonomy"), ["report_id", "page"], ["id"]).select("id", "source_taxonomy", "suffix")


# --- Sections -------------------------------------------------------------------------------------------------------


@query("""WITH l AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?m)^[ \\t]*((?:[0-9]+(?:\\.[0-9]+)* )?[^\\n.]{2,80}?)[ \\t]*[.·…_]{3,}[ \\t]*([0-9]{1,4})[ \\t]*$', 0)) AS line FROM documents)
SELECT doc_id, trim(regexp_extract(line, '((?:[0-9]+(?:\\.[0-9]+)* )?[^\\n.]{2,80}?)[ \\t]*[.·…_]{3,}[ \\t]*([0-9]{1,4})[ \\t]*$', 1)) AS title, CAST(regexp_extract(line, '([0-9]{1,4})[ \\t]*$', 1) AS INT) AS printed_page FROM l""")
def contents_entries(spark, d):
    return S.contents_entries(read_table(spark, d, "documents"), "doc_id").select("doc_id", "title", "printed_page")


@query("""WITH s AS (SELECT report_id, section, min(page) AS page FROM risk_instance WHERE section IS NOT NULL GROUP BY ALL), p AS (SELECT report_id, page, lead(page) OVER (PARTITION BY report_id ORDER BY page) - 1 AS last_page FROM (SELECT DISTINCT report_id, page FROM s))
SELECT report_id, section, page AS first_page, last_page FROM s JOIN p USING (report_id, page)""")
def section_ranges(spark, d):
    starts = read_table(spark, d, "risk_instance").where("section IS NOT NULL").groupBy("report_id", "section").agg(F.min("page").alias("page"))
    return S.section_ranges(starts, "report_id")


@query("""WITH s AS (SELECT report_id, section, min(page) AS a, max(page) AS b FROM risk_instance GROUP BY ALL)
SELECT c.risk_instance_id, c.section, c.page FROM (SELECT DISTINCT risk_instance_id, section, page FROM risk_citation) c JOIN risk_instance ri ON ri.id = c.risk_instance_id
LEFT JOIN s ON s.report_id = ri.report_id AND s.section = c.section WHERE coalesce(NOT c.page BETWEEN a AND b, true)""")
def citations_out_of_range(spark, d):
    ri = read_table(spark, d, "risk_instance")
    ranges = ri.groupBy("report_id", "section").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page"))
    cited = read_table(spark, d, "risk_citation").select("risk_instance_id", "section", "page").distinct().join(ri.select(F.col("id").alias("risk_instance_id"), "report_id"), "risk_instance_id")
    return S.checked_range(ranges, cited, "report_id").select("risk_instance_id", "section", "page")


@query("""WITH n AS (SELECT report_id, outcome, count(*) AS n, min(created_at) AS t FROM run_checks WHERE outcome IS NOT NULL GROUP BY ALL)
SELECT report_id, outcome, CAST(n AS BIGINT) AS votes FROM (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY n DESC, t NULLS FIRST, outcome) AS r FROM n) WHERE r = 1""")
def mode_first_seen(spark, d):
    return S.mode_first_seen(read_table(spark, d, "run_checks"), ["report_id"], "outcome", "created_at")


# --- Calls ----------------------------------------------------------------------------------------------------------


@query("""SELECT DISTINCT call_id, sha256(concat_ws(chr(1), coalesce(model, chr(2)), coalesce(prompt_version, chr(2)), coalesce(CAST(sample AS VARCHAR), chr(2)), coalesce(printf('%.3f', temperature), chr(2)),
  coalesce(array_to_string(list_transform(messages, lambda m: coalesce(m.role, '') || '=' || coalesce(m.content, '')), chr(3)), chr(2)), coalesce(schema, chr(2)))) AS hash FROM calls""")
def request_hashes(spark, d):
    c = read_table(spark, d, "calls")
    return c.select("call_id", C.request_hash(F.col("model"), F.col("prompt_version"), F.col("sample"), F.format_string("%.3f", "temperature"), C.message_text(F.col("messages")), F.col("schema")).alias("hash")).distinct()


_LAST = "last AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY request_hash ORDER BY created_at DESC NULLS LAST, call_id DESC NULLS LAST, response_content DESC NULLS LAST) AS n FROM calls) WHERE n = 1)"


@query(f"WITH {_LAST}, q AS (SELECT DISTINCT request_hash, call_id FROM calls WHERE split_part(call_id, '-', 1) = 'repair') SELECT q.call_id, md5(last.response_content) AS reply FROM q JOIN last USING (request_hash)")
def replay_join(spark, d):
    calls = read_table(spark, d, "calls")
    wanted = calls.where(F.split_part("call_id", F.lit("-"), F.lit(1)) == "repair").select("request_hash", "call_id").distinct()
    return C.replayed(wanted, calls).where("recorded").select("call_id", F.md5("reply").alias("reply"))


@query("SELECT DISTINCT request_hash FROM calls WHERE request_hash NOT IN (SELECT request_hash FROM calls WHERE split_part(call_id, '-', 1) = 'describe')")
def replay_misses(spark, d):
    calls = read_table(spark, d, "calls")
    recorded = calls.where(F.split_part("call_id", F.lit("-"), F.lit(1)) == "describe")
    return C.misses(calls.select("request_hash").distinct(), recorded)


@query("""WITH u AS (SELECT split_part(call_id, '-', 1) AS step, count(*) AS calls, coalesce(sum(usage.prompt_tokens), 0) AS ti, coalesce(sum(usage.completion_tokens), 0) AS tout, round(sum(elapsed_s), 3) AS s, count(DISTINCT served_model) AS m FROM calls GROUP BY 1)
SELECT step, CAST(calls AS BIGINT) AS calls, CAST(ti AS BIGINT) AS tokens_in, CAST(tout AS BIGINT) AS tokens_out, s AS seconds, CAST(m AS BIGINT) AS models FROM u
UNION ALL SELECT CASE WHEN step IN ('describe', 'repair') THEN 'pipeline' ELSE 'other' END, CAST(sum(calls) AS BIGINT), CAST(sum(ti) AS BIGINT), CAST(sum(tout) AS BIGINT), round(sum(s), 3), CAST(max(m) AS BIGINT) FROM u GROUP BY 1""")
def call_usage(spark, d):
    return C.usage_with_totals(read_table(spark, d, "calls"), ["describe", "repair"])


_KEYS = "['title', 'description', 'category', 'confidence', 'poor_fit']"


@query(f"""WITH j AS (SELECT DISTINCT call_id, response_content AS r FROM calls WHERE json_valid(response_content) AND json_type(response_content) = 'OBJECT')
SELECT call_id, array_to_string(list_sort(list_filter(list_distinct(json_keys(r)), lambda k: NOT list_contains({_KEYS}, k))), ',') AS unknown, array_to_string(list_sort(list_filter({_KEYS}, lambda k: NOT list_contains(json_keys(r), k))), ',') AS missing FROM j""")
def schema_violations(spark, d):
    allowed = ["title", "description", "category", "confidence", "poor_fit"]
    r = F.col("response_content")
    rows = read_table(spark, d, "calls").select("call_id", "response_content").distinct()
    # json_object_keys is null for what is no object; only whole documents count.
    return rows.where(F.json_object_keys(r).isNotNull() & F.expr("try_parse_json(response_content)").isNotNull()).select(
        "call_id", F.array_join(C.unknown_keys(r, allowed), ",").alias("unknown"), F.array_join(C.missing_keys(r, allowed), ",").alias("missing")
    )


@query("""WITH j AS (SELECT call_id, response_content AS r FROM calls WHERE split_part(call_id, '-', 1) = 'intent' AND json_valid(response_content) AND json_type(response_content) = 'OBJECT'),
s AS (SELECT call_id, list_sort(list_distinct(CAST(coalesce(r->'$.categories', '[]') AS VARCHAR[]))) AS c FROM j)
SELECT DISTINCT call_id, array_to_string(c, ',') AS categories, c = ['climate'] AS only_climate FROM s""")
def intent_sets(spark, d):
    rows = read_table(spark, d, "calls").where((F.split_part("call_id", F.lit("-"), F.lit(1)) == "intent") & F.expr("try_parse_json(response_content)").isNotNull() & F.json_object_keys("response_content").isNotNull())
    cats = F.coalesce(F.from_json(F.get_json_object("response_content", "$.categories"), "array<string>"), F.array().cast("array<string>"))
    return rows.select("call_id", F.array_join(F.array_sort(F.array_distinct(cats)), ",").alias("categories"), E.same_set(cats, F.array(F.lit("climate"))).alias("only_climate")).distinct()


# --- Run log --------------------------------------------------------------------------------------------------------

_CHECKS = "k AS (SELECT *, CASE WHEN json_valid(detail) THEN detail->>'$.section' END AS section FROM run_checks)"
_WINS = f"{_CHECKS}, l AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY run_id, phase, check_id, section ORDER BY created_at DESC NULLS LAST, report_id DESC NULLS LAST, outcome DESC NULLS LAST, count DESC NULLS LAST, strategy DESC NULLS LAST, detail DESC NULLS LAST) AS n FROM k) WHERE n = 1)"


@query(f"WITH {_WINS} SELECT run_id, report_id, phase, check_id, section, outcome, count FROM l")
def runlog_last_wins(spark, d):
    return RL.last_wins(read_table(spark, d, "run_checks")).select("run_id", "report_id", "phase", "check_id", "section", "outcome", "count")


@query(f"""WITH {_WINS} SELECT run_id, phase, CASE WHEN count_if(outcome = 'error') > 0 THEN 'error' WHEN count_if(outcome = 'warning') > 0 THEN 'warnings' ELSE 'ok' END AS status, CAST(count(*) AS BIGINT) AS checks,
CAST(count_if(outcome = 'ok') AS BIGINT) AS n_ok, CAST(count_if(outcome = 'warning') AS BIGINT) AS n_warning, CAST(count_if(outcome = 'error') AS BIGINT) AS n_error FROM l GROUP BY run_id, phase""")
def runlog_status(spark, d):
    return RL.status(RL.last_wins(read_table(spark, d, "run_checks")), ["run_id", "phase"])


@query("""WITH r AS (SELECT report_id, run_id, row_number() OVER (PARTITION BY report_id ORDER BY run_id DESC NULLS LAST) AS age FROM (SELECT DISTINCT report_id, run_id FROM run_checks WHERE report_id IS NOT NULL)),
c AS (SELECT report_id, age, phase, check_id, sum(count) AS n FROM run_checks JOIN r USING (report_id, run_id) WHERE age <= 2 GROUP BY ALL), two AS (SELECT report_id FROM r WHERE age = 2),
a AS (SELECT * FROM c WHERE age = 1 AND report_id IN (FROM two)), b AS (SELECT * FROM c WHERE age = 2)
SELECT coalesce(a.report_id, b.report_id) AS report_id, coalesce(a.phase, b.phase) AS phase, coalesce(a.check_id, b.check_id) AS check_id, CAST(b.n AS BIGINT) AS previous, CAST(a.n AS BIGINT) AS current
FROM a FULL JOIN b ON a.report_id = b.report_id AND a.phase IS NOT DISTINCT FROM b.phase AND a.check_id IS NOT DISTINCT FROM b.check_id WHERE a.n IS DISTINCT FROM b.n""")
def count_drift(spark, d):
    return RL.count_drift(read_table(spark, d, "run_checks"), ["phase", "check_id"])


@query("""WITH g AS (SELECT DISTINCT r.id AS report_id, s.section FROM report r, (SELECT DISTINCT section FROM risk_instance WHERE section IS NOT NULL) s)
SELECT g.report_id, g.section, CAST(count(ri.id) AS BIGINT) AS n FROM g LEFT JOIN risk_instance ri ON ri.report_id = g.report_id AND ri.section = g.section GROUP BY ALL""")
def blocks_per_section(spark, d):
    ri = read_table(spark, d, "risk_instance")
    sections = ri.select("section").where("section IS NOT NULL").distinct()
    groups = read_table(spark, d, "report").select(F.col("id").alias("report_id")).crossJoin(sections)
    return RL.zero_filled(groups, ri, ["report_id", "section"])


@query("SELECT risk_instance_id, page, CAST(count(*) AS BIGINT) AS n FROM risk_citation GROUP BY ALL HAVING count(*) > 1")
def repeated_citations(spark, d):
    return RL.repeated(read_table(spark, d, "risk_citation"), ["risk_instance_id", "page"])


@query("""SELECT report_id, CAST(count_if(source_register = 'erm_main_risk') AS BIGINT) AS erm, CAST(count_if(poor_fit) AS BIGINT) AS poor_fit, CAST(count_if(len(list_filter(quality_flags, lambda f: starts_with(f, 'grounding'))) > 0) AS BIGINT) AS grounding_flags,
CAST(count_if(len(quality_flags) > 0) AS BIGINT) AS flagged FROM risk_instance GROUP BY report_id""")
def conditional_counts(spark, d):
    flag = F.exists("quality_flags", lambda f: F.startswith(f, F.lit("grounding")))
    return read_table(spark, d, "risk_instance").groupBy("report_id").agg(
        F.count_if(F.col("source_register") == "erm_main_risk").alias("erm"), F.count_if("poor_fit").alias("poor_fit"), F.count_if(flag).alias("grounding_flags"), F.count_if(F.size("quality_flags") > 0).alias("flagged")
    )


# --- Warehouse, evaluation ------------------------------------------------------------------------------------------


@query("""WITH n AS (SELECT * FROM risk_instance WHERE report_id IN (SELECT id FROM report WHERE fiscal_year = 2022) AND prominence = 1)
SELECT id, report_id, prominence FROM risk_instance WHERE report_id NOT IN (SELECT report_id FROM n) UNION ALL SELECT id, report_id, prominence FROM n""")
def replace_load(spark, d):
    stored = read_table(spark, d, "risk_instance").select("id", "report_id", "prominence")
    reports = read_table(spark, d, "report").where("fiscal_year = 2022").select(F.col("id").alias("report_id"))
    return W.replaced(stored, stored.where("prominence = 1").join(reports, "report_id", "left_semi").select(stored.columns)).select("id", "report_id", "prominence")


@query("SELECT canonical_risk_id, title FROM (SELECT canonical_risk_id, title, row_number() OVER (PARTITION BY canonical_risk_id ORDER BY report_id, id) AS n FROM risk_instance) WHERE n = 1")
def first_title_wins(spark, d):
    return W.first_title_wins(read_table(spark, d, "risk_instance").select("canonical_risk_id", "title", "report_id", "id"), "canonical_risk_id", ["report_id", "id"]).select("canonical_risk_id", "title")


@query("""WITH g AS (SELECT DISTINCT source_register, risk_instance_id AS id, page FROM risk_citation), f AS (SELECT DISTINCT source_register, id, page FROM risk_instance),
m AS (SELECT source_register, count_if(g.id IS NOT NULL AND f.id IS NOT NULL) AS hit, count_if(g.id IS NOT NULL) AS golden, count_if(f.id IS NOT NULL) AS found FROM g FULL JOIN f USING (source_register, id, page) GROUP BY 1)
SELECT source_register, CAST(hit AS BIGINT) AS matched, CAST(golden AS BIGINT) AS golden, CAST(found AS BIGINT) AS found, round(hit / greatest(found, 1), 6) AS precision, round(hit / greatest(golden, 1), 6) AS recall,
round(CASE WHEN hit = 0 THEN 0 ELSE 2.0 * (hit / greatest(found, 1)) * (hit / greatest(golden, 1)) / (hit / greatest(found, 1) + hit / greatest(golden, 1)) END, 6) AS f1 FROM m""")
def evaluator_scores(spark, d):
    golden = read_table(spark, d, "risk_citation").select("source_register", F.col("risk_instance_id").alias("id"), "page")
    return E.identification(golden, read_table(spark, d, "risk_instance").select("source_register", "id", "page"), ["id", "page"], ["source_register"])


_GOLDEN = f"""k AS (SELECT canonical_risk_id, any_value(company_id) AS company_id, min(category) AS category, list_sort(list(DISTINCT category) FILTER (category IS NOT NULL)) AS cats, bool_or(coalesce(mitigation, '') <> '') AS stated
  FROM risk_instance ri JOIN report r ON r.id = ri.report_id WHERE canonical_risk_id IS NOT NULL GROUP BY 1),
g AS (SELECT k.*, [split_part(canonical_title, ' ', 1)] AS phrases FROM k JOIN canonical_risk c ON c.id = k.canonical_risk_id),
w AS (SELECT report_id, canonical_risk_id, min(page) AS page, min(section) AS section FROM risk_instance WHERE canonical_risk_id IS NOT NULL GROUP BY ALL),
ct AS (SELECT risk_instance_id, list(DISTINCT page) FILTER (page IS NOT NULL) AS pages, list(DISTINCT section) FILTER (section IS NOT NULL) AS sections FROM risk_citation GROUP BY 1),
m AS (SELECT ri.*, g.canonical_risk_id AS golden_id, g.category AS g_category, g.cats, g.stated, g.phrases, w.page AS g_page, w.section AS g_section, coalesce(pages, []) || [ri.page] AS pages, coalesce(sections, []) || [ri.section] AS sections, src.page_text || ' ' || src.cited_pages AS cited_text
  FROM risk_instance ri JOIN src USING (id) JOIN g ON g.canonical_risk_id = ri.canonical_risk_id JOIN w ON w.report_id = ri.report_id AND w.canonical_risk_id = ri.canonical_risk_id LEFT JOIN ct ON ct.risk_instance_id = ri.id),
n AS (SELECT *, {_norm("concat_ws(' ', description, mitigation)")} AS own, ' ' || {_norm('cited_text')} || ' ' AS cited_norm, len({_sentences("trim(coalesce(description, ''))")}) AS sents FROM m),
p AS (SELECT report_id, golden_id, id, 'provenance' AS evaluator, CAST(NOT coalesce(list_contains(pages, g_page), false) AS INT) + CAST(NOT coalesce(list_contains(sections, g_section), false) AS INT) AS problems FROM n
 UNION ALL SELECT report_id, golden_id, id, 'grounding', len(list_filter(phrases, lambda x: NOT contains(own, {_norm('x')}))) + len(list_filter(regexp_extract_all(coalesce(description, ''), '[0-9]+(?:[.,][0-9]+)*'), lambda x: NOT regexp_matches(cited_norm, '[^0-9]' || {_norm('x')} || '[^0-9]'))) FROM n
 UNION ALL SELECT report_id, golden_id, id, 'category', CAST(NOT coalesce(list_contains(cats[1:2], category), false) AS INT) FROM n
 UNION ALL SELECT report_id, golden_id, id, 'fields', CAST(sents NOT BETWEEN 2 AND 3 AS INT) + CAST((coalesce(mitigation, '') <> '') <> stated AS INT) FROM n)"""


def _matched(spark, d) -> DataFrame:
    """Records with a golden row made of the other records of their canonical risk: its first two categories are accepted,
    the first word of its title is a key phrase, its least page and section of the report are the right ones."""
    ri, canonical = read_table(spark, d, "risk_instance").where("canonical_risk_id IS NOT NULL"), read_table(spark, d, "canonical_risk")
    facts = ri.join(read_table(spark, d, "report").select(F.col("id").alias("report_id")), "report_id").groupBy("canonical_risk_id").agg(
        F.min("category").alias("category"), F.array_sort(F.collect_set("category")).alias("cats"), F.bool_or(F.coalesce("mitigation", F.lit("")) != "").alias("stated")
    )
    place = ri.groupBy("report_id", "canonical_risk_id").agg(F.min("page").alias("g_page"), F.min("section").alias("g_section"))
    cited = read_table(spark, d, "risk_citation").groupBy(F.col("risk_instance_id").alias("id")).agg(F.collect_set("page").alias("pages"), F.collect_set("section").alias("sections"))
    texts = G._with_sources(ri.select("id", "report_id", "page"), read_table(spark, d, "page_text"), read_table(spark, d, "risk_citation")).select("id", F.concat_ws(" ", F.coalesce("page_text", F.lit("")), F.coalesce("cited_pages", F.lit(""))).alias("page_text"))
    rows = ri.join(facts.withColumnsRenamed({"category": "g_category"}), "canonical_risk_id").join(canonical.select(F.col("id").alias("canonical_risk_id"), "canonical_title"), "canonical_risk_id")
    rows = rows.join(place, ["report_id", "canonical_risk_id"]).join(cited, "id", "left").join(texts, "id")
    golden = F.struct(
        F.col("g_page").alias("page"), F.col("g_section").alias("section"), F.lit(None).cast("int").alias("also_on_page"), F.array(F.split_part("canonical_title", F.lit(" "), F.lit(1))).alias("key_phrases"),
        F.slice("cats", 1, 2).alias("acceptable_categories"), F.col("g_category").alias("category"), F.col("stated").alias("mitigation_stated"), F.lit(None).cast("array<string>").alias("mitigation_phrases"),
    )
    return rows.select("report_id", F.col("canonical_risk_id").alias("golden_id"), "id", golden.alias("golden"), F.struct("page", "section", "pages", "sections", "description", "mitigation", "category", "page_text").alias("record"))


@query(f"WITH {_PAGES}, {_TEXTS}, {_GOLDEN} SELECT golden_id, evaluator, CAST(sum(problems) AS BIGINT) AS problems FROM p GROUP BY ALL")
def evaluator_problems(spark, d):
    return E.match_problems(_matched(spark, d), "report_id").groupBy("golden_id", "evaluator").agg(F.sum(F.size("problems")).alias("problems"))


@query(f"""WITH {_PAGES}, {_TEXTS}, {_GOLDEN} SELECT report_id, evaluator, CAST(count(*) AS BIGINT) AS matched, round(avg(CASE WHEN problems = 0 THEN 1.0 ELSE 0.0 END), 3) AS score,
avg(CASE WHEN problems = 0 THEN 1.0 ELSE 0.0 END) >= CASE evaluator WHEN 'provenance' THEN 0.9 ELSE 0.8 END AS passed, CAST(count_if(problems > 0) AS INT) AS failures FROM p GROUP BY report_id, evaluator""")
def evaluators(spark, d):
    return E.evaluated(E.match_problems(_matched(spark, d), "report_id"), "report_id").withColumn("failures", F.size("failures"))


_PARTS = "struct<categories:array<string>,companies:array<string>,years:array<int>,source_register:string,status:string,sector:string,free_text:string>"


@query(f"""WITH c AS (SELECT DISTINCT call_id, model, response_content AS r FROM calls WHERE split_part(call_id, '-', 1) = 'intent' AND json_valid(response_content) AND json_type(response_content) = 'OBJECT'),
f AS (SELECT call_id, model, list_sort(list_distinct(CAST(coalesce(r->'$.categories', '[]') AS VARCHAR[]))) AS categories, list_sort(list_distinct(list_transform(CAST(coalesce(r->'$.companies', '[]') AS VARCHAR[]), lambda x: lower(x)))) AS companies,
  list_sort(CAST(coalesce(r->'$.years', '[]') AS INT[])) AS years, coalesce(r->>'$.source_register', '') AS reg, coalesce(r->>'$.status', '') AS status, {_norm("coalesce(r->>'$.sector', '')")} AS sector, list_sort(list_distinct({_words("coalesce(r->>'$.free_text', '')")})) AS free FROM c),
p AS (SELECT *, lag(categories) OVER w AS categories2, lag(companies) OVER w AS companies2, lag(years) OVER w AS years2, lag(reg) OVER w AS reg2, lag(status) OVER w AS status2, lag(sector) OVER w AS sector2, lag(free) OVER w AS free2, lag(call_id) OVER w AS other FROM f WINDOW w AS (PARTITION BY model ORDER BY call_id)),
e AS (SELECT model, CAST(categories <> categories2 AS INT) + CAST(companies <> companies2 AS INT) + CAST(years <> years2 AS INT) + CAST(reg <> reg2 AS INT) + CAST(status <> status2 AS INT) + CAST(sector <> sector2 AS INT) + CAST(free <> free2 AS INT) AS n FROM p WHERE other IS NOT NULL)
SELECT model, CAST(count(*) AS BIGINT) AS questions, round(avg(CASE WHEN n = 0 THEN 1.0 ELSE 0.0 END), 3) AS score, avg(CASE WHEN n = 0 THEN 1.0 ELSE 0.0 END) >= 0.8 AS passed, CAST(sum(n) AS BIGINT) AS parts_differ FROM e GROUP BY model""")
def intent_agreement(spark, d):
    """Each intent against that of the call before it (by id) of the same model, as if the earlier one were expected."""
    rows = read_table(spark, d, "calls").where((F.split_part("call_id", F.lit("-"), F.lit(1)) == "intent") & F.expr("try_parse_json(response_content)").isNotNull() & F.json_object_keys("response_content").isNotNull())
    rows = rows.select("call_id", "model", "response_content").distinct().select(F.col("call_id").alias("id"), "model", F.from_json("response_content", _PARTS).alias("got"))
    pairs = rows.withColumn("expected", F.lag("got").over(S.Window.partitionBy("model").orderBy("id"))).where("expected IS NOT NULL")
    differ = F.aggregate("failures", F.lit(0).cast("long"), lambda a, x: a + F.size(x["problems"]))
    return E.intent_scores(pairs, ["model"]).withColumn("parts_differ", differ).drop("failures")


@query("""WITH r AS (SELECT section, 'title_length' AS "check", length(title) <= 80 AS ok FROM risk_instance WHERE title IS NOT NULL UNION ALL SELECT section, 'mitigation', coalesce(mitigation, '') <> '' FROM risk_instance)
SELECT section, "check", CAST(count(*) AS BIGINT) AS n, round(avg(CAST(ok AS INT)), 6) AS score, CAST(count_if(NOT ok) AS BIGINT) AS failed FROM r GROUP BY ALL""")
def check_scores(spark, d):
    ri = read_table(spark, d, "risk_instance")
    a = ri.where("title IS NOT NULL").select("section", F.lit("title_length").alias("check"), "id", (F.length("title") <= 80).alias("ok"))
    b = ri.select("section", F.lit("mitigation").alias("check"), "id", (F.coalesce("mitigation", F.lit("")) != "").alias("ok"))
    return E.check_scores(a.unionByName(b), ["section"])


@query("""WITH c AS (SELECT report_id, category, count(*) AS n FROM risk_instance WHERE category IS NOT NULL GROUP BY ALL)
SELECT report_id, category, CAST(n AS BIGINT) AS n, CAST(r AS INT) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY n DESC, category) AS r FROM c) WHERE r <= 3""")
def top_categories(spark, d):
    return E.top_values(read_table(spark, d, "risk_instance"), "report_id", "category", 3)


@query("SELECT * FROM (SELECT id, title FROM risk_instance WHERE prominence = 1 EXCEPT ALL SELECT id, title FROM risk_instance WHERE page > 100)")
def set_difference(spark, d):
    rows = read_table(spark, d, "risk_instance")
    return rows.where("prominence = 1").select("id", "title").exceptAll(rows.where("page > 100").select("id", "title"))


# --- Check catalogue, locating --------------------------------------------------------------------------------------


def _blocks(spark, d) -> DataFrame:
    """Records as blocks of their report: the span as text, three named fields, the marker that the description gives."""
    field = lambda c: F.coalesce(c, F.lit(""))
    fields = F.create_map(F.lit("description"), field("description"), F.lit("potential_impact"), field("potential_impact"), F.lit("how_we_manage_it"), field("mitigation"))
    return read_table(spark, d, "risk_instance").select(
        "report_id", F.col("id").alias("block_id"), "section", "page", F.when(F.col("source_register") == "erm_main_risk", "main_risks_table").otherwise("esrs_table").alias("strategy"), F.col("title").alias("heading"),
        F.col("verbatim_span").alias("text"), fields.alias("fields"), F.coalesce(T.lexical_marker(F.col("description")), F.lit("none")).alias("marker"), "quality_flags", "prominence",
    )


_LEXICAL = """coalesce(CASE WHEN contains(lower(description), 'immaterial') THEN 'immaterial' WHEN contains(lower(description), 'opportunit') AND NOT contains(right(string_split(lower(description), 'opportunit')[1], 40), 'risk') THEN 'opportunity'
  WHEN contains(lower(description), 'risk') THEN 'risk' END, 'none')"""


@query(f"""WITH {_PAGES}, b AS (SELECT *, {_LEXICAL} AS marker, source_register = 'erm_main_risk' AS erm FROM risk_instance), reps AS (SELECT DISTINCT report_id FROM b),
rng AS (SELECT ri.report_id, c.section, min(c.page) AS lo, max(c.page) AS hi FROM risk_citation c JOIN risk_instance ri ON ri.id = c.risk_instance_id WHERE c.section IS NOT NULL GROUP BY ALL),
c1 AS (SELECT report_id, 'blocks_per_section' AS check_id, rng.section, count(b.id) AS n, CASE WHEN count(b.id) > 0 THEN 'ok' WHEN rng.section = 'material_iros' THEN 'error' ELSE 'warning' END AS outcome FROM rng LEFT JOIN b USING (report_id, section) GROUP BY report_id, rng.section),
sh AS (SELECT report_id, count(*) AS n, max(CASE WHEN coalesce(description, '') <> '' THEN 1 ELSE 0 END) + max(CASE WHEN coalesce(potential_impact, '') <> '' THEN 1 ELSE 0 END) + max(CASE WHEN coalesce(mitigation, '') <> '' THEN 1 ELSE 0 END) AS names,
  count_if(coalesce(description, '') = '' OR coalesce(potential_impact, '') = '' OR coalesce(mitigation, '') = '') AS gaps FROM b WHERE erm GROUP BY 1),
c2 AS (SELECT report_id, 'main_risks_shape', NULL, n, CASE WHEN n = 3 AND names = 3 AND gaps = 0 THEN 'ok' ELSE 'error' END FROM sh),
c3 AS (SELECT report_id, 'marker_missing', NULL, count_if(NOT erm AND marker <> 'none' AND list_contains(coalesce(quality_flags, []), 'marker_icon_missing')) AS n, 'ok' FROM b GROUP BY 1),
t AS (SELECT report_id, id, {_tokens('verbatim_span')} AS a, {_tokens('page_text')} AS p FROM b JOIN pages USING (report_id, page) WHERE verbatim_span IS NOT NULL),
g AS (SELECT report_id, id, a, p, {_TRIGRAMS.format('a')} AS ga, list_distinct({_TRIGRAMS.format('p')}) AS gp FROM t),
f AS (SELECT report_id, CASE WHEN len(a) < 3 THEN CAST(contains(array_to_string(p, ' '), array_to_string(a, ' ')) AS DOUBLE) ELSE len(list_filter(ga, lambda x: list_contains(gp, x))) / len(ga) END AS share FROM g),
c5 AS (SELECT report_id, 'text_not_on_page', NULL, count_if(share < 0.95) AS n, CASE WHEN count_if(share < 0.95) > 0 THEN 'error' ELSE 'ok' END FROM reps LEFT JOIN f USING (report_id) GROUP BY report_id),
pw AS (SELECT report_id, page, unnest({_tokens('page_text')}) AS word FROM pages), bw AS (SELECT report_id, page, unnest({_tokens("concat_ws(' ', title, verbatim_span)")}) AS word FROM b),
x AS (SELECT report_id, page, word, count(*) AS n FROM pw GROUP BY ALL), y AS (SELECT report_id, page, word, count(*) AS n FROM bw GROUP BY ALL), own AS (SELECT DISTINCT report_id, page FROM b),
cov AS (SELECT report_id, page, round(sum(least(x.n, coalesce(y.n, 0))) / sum(x.n), 6) AS share FROM x JOIN own USING (report_id, page) LEFT JOIN y USING (report_id, page, word) GROUP BY ALL),
c6 AS (SELECT report_id, 'page_coverage', NULL, count_if(share < 0.95) AS n, CASE WHEN count_if(share < 0.95) > 0 THEN 'warning' ELSE 'ok' END FROM reps LEFT JOIN cov USING (report_id) GROUP BY report_id),
c7 AS (SELECT report_id, 'block_ids_and_ranges', NULL, count_if(NOT coalesce(page BETWEEN lo AND hi, false)) AS n, CASE WHEN count_if(NOT coalesce(page BETWEEN lo AND hi, false)) > 0 THEN 'error' ELSE 'ok' END FROM b LEFT JOIN rng USING (report_id, section) GROUP BY report_id),
now_ AS (SELECT report_id, concat_ws(':', page, marker) AS k, count(*) AS n FROM b GROUP BY ALL), old AS (SELECT report_id, concat_ws(':', page, marker) AS k, count(*) AS n FROM b WHERE prominence = 1 GROUP BY ALL),
dr AS (SELECT coalesce(a.report_id, o.report_id) AS report_id, count(*) AS n FROM (SELECT * FROM now_ WHERE report_id IN (SELECT report_id FROM old)) a FULL JOIN old o ON a.report_id = o.report_id AND a.k = o.k WHERE a.n IS DISTINCT FROM o.n GROUP BY 1),
c8 AS (SELECT report_id, 'count_drift', NULL, coalesce(n, 0) AS n, CASE WHEN coalesce(n, 0) > 0 THEN 'warning' ELSE 'ok' END FROM reps LEFT JOIN dr USING (report_id))
SELECT report_id, check_id, section, CAST(n AS BIGINT) AS n, outcome FROM (FROM c1 UNION ALL FROM c2 UNION ALL FROM c3 UNION ALL (SELECT report_id, 'marker_disagreement', NULL, 0, 'ok' FROM reps) UNION ALL FROM c5 UNION ALL FROM c6 UNION ALL FROM c7 UNION ALL FROM c8)""")
def extract_check_log(spark, d):
    """The checks of extraction over the records as blocks; a section's pages are those cited for it, and the run before
    had the most prominent records only."""
    blocks, ri = _blocks(spark, d), read_table(spark, d, "risk_instance")
    cited = read_table(spark, d, "risk_citation").where("section IS NOT NULL").select(F.col("risk_instance_id").alias("id"), "section", "page").join(ri.select("id", "report_id"), "id")
    sections = cited.groupBy("report_id", "section").agg(F.min("page").alias("first_page"), F.max("page").alias("last_page")).withColumn("required", F.col("section") == "material_iros").withColumn("outcome", F.lit("ok"))
    pages = G.page_texts(read_table(spark, d, "page_text")).withColumnRenamed("page_text", "text")
    words = pages.select("report_id", "page", F.col("text").alias("word"), F.lit(100.0).alias("top"))
    log = K.extract_checks(sections, blocks, pages, words, K.marker_counts(blocks.where("prominence = 1")))
    return log.select("report_id", "check_id", F.get_json_object("detail", "$.section").alias("section"), F.col("count").alias("n"), "outcome")


@query(f"""WITH {_PAGES}, {_TEXTS}, {_GOLDEN}, {_checked_sql('src', 'gk')}, reps AS (SELECT DISTINCT report_id FROM risk_instance),
c1 AS (SELECT report_id, 'identify_register' AS check_id, count(*) AS n, 'ok' AS outcome FROM risk_instance WHERE source_register IS NOT NULL GROUP BY 1),
c2 AS (SELECT report_id, 'category_poor_fit', count_if(poor_fit), 'ok' FROM risk_instance GROUP BY 1),
bad AS (SELECT report_id, count(*) AS n, count_if(({_FLAGGED}) > 0) AS bad FROM gk JOIN risk_instance USING (id) GROUP BY 1), c3 AS (SELECT report_id, 'grounding_failures', bad, CASE WHEN 1 - bad / n >= 0.8 THEN 'ok' ELSE 'warning' END FROM bad),
tw AS (SELECT report_id, count(*) AS n FROM (SELECT report_id, canonical_risk_id FROM risk_instance WHERE canonical_risk_id IS NOT NULL GROUP BY ALL HAVING count(*) > 1) GROUP BY 1),
c4 AS (SELECT report_id, 'transform_set_checks', coalesce(n, 0), CASE WHEN coalesce(n, 0) > 0 THEN 'error' ELSE 'ok' END FROM reps LEFT JOIN tw USING (report_id)),
sc AS (SELECT report_id, evaluator, avg(CASE WHEN problems = 0 THEN 1.0 ELSE 0.0 END) >= CASE evaluator WHEN 'provenance' THEN 0.9 ELSE 0.8 END AS passed FROM p GROUP BY report_id, evaluator),
c5 AS (SELECT report_id, 'eval_scores', count_if(NOT passed), CASE WHEN count_if(NOT passed) > 0 THEN 'error' ELSE 'ok' END FROM sc GROUP BY 1),
wr AS (SELECT ri.report_id, count(*) AS e, count(DISTINCT (c.risk_instance_id, c.page, c.section, c.source_register, c.span)) AS n FROM risk_citation c JOIN risk_instance ri ON ri.id = c.risk_instance_id GROUP BY 1),
c6 AS (SELECT report_id, 'rows_written', n, CASE WHEN n = e THEN 'ok' ELSE 'error' END FROM wr)
SELECT report_id, check_id, CAST(n AS BIGINT) AS n, outcome FROM (FROM c1 UNION ALL FROM c2 UNION ALL FROM c3 UNION ALL FROM c4 UNION ALL FROM c5 UNION ALL FROM c6)""")
def transform_check_log(spark, d):
    """The checks of transformation and load over the records; the citations count as stored once each."""
    ri, cites = read_table(spark, d, "risk_instance"), read_table(spark, d, "risk_citation")
    found = G.grounded(ri, read_table(spark, d, "page_text"), cites).withColumn("repaired", F.lit(False))
    candidates = ri.where("source_register IS NOT NULL").groupBy("report_id", "source_register").agg(F.count("*").alias("n"))
    whole = ri.groupBy("report_id").agg(F.count("*").alias("candidates")).withColumn("merges", F.lit(0))
    placed = cites.join(ri.select(F.col("id").alias("risk_instance_id"), "report_id"), "risk_instance_id")
    log = K.union([
        K.identify_checks(candidates), K.counted(ri, "category_poor_fit", F.coalesce("poor_fit", F.lit(False)), F.col("id")), K.grounding_check(found), K.set_checks(ri, whole),
        K.eval_check(E.evaluated(E.match_problems(_matched(spark, d), "report_id"), "report_id")), K.rows_check(placed.distinct(), placed),
    ])
    return log.select("report_id", "check_id", F.col("count").alias("n"), "outcome")


@query("""WITH rp AS (SELECT DISTINCT p.report_id, p.page, p.page - 1 + r.page_offset AS i FROM page_text p JOIN report r ON r.id = p.report_id WHERE r.page_offset IS NOT NULL), sz AS (SELECT report_id, max(i) + 1 AS pages FROM rp GROUP BY 1),
pr AS (SELECT report_id, section, min(page) AS printed FROM risk_instance WHERE section IS NOT NULL GROUP BY ALL), st AS (SELECT report_id, section, printed, pages, unnest(range(0, 6)) AS step FROM pr JOIN sz USING (report_id)),
f AS (SELECT st.report_id, section, printed, pages, arg_min(rp.i - (rp.page - 1), step) AS o FROM st JOIN rp ON rp.report_id = st.report_id AND rp.i = printed - 1 + step GROUP BY ALL),
v AS (SELECT f.report_id, section, o FROM f JOIN rp ON rp.report_id = f.report_id AND rp.i = printed - 1 + o WHERE rp.page = printed),
m AS (SELECT report_id, o, count(*) AS n, min(section) AS s FROM v GROUP BY ALL)
SELECT report_id, CAST(o AS INT) AS page_offset, CAST(n AS BIGINT) AS votes FROM (SELECT *, row_number() OVER (PARTITION BY report_id ORDER BY n DESC, s) AS k FROM m) WHERE k = 1""")
def page_offsets(spark, d):
    """The offset of each report's pages, measured from the numbers printed on those that are known."""
    offset = read_table(spark, d, "report").where("page_offset IS NOT NULL").select(F.col("id").alias("report_id"), "page_offset")
    known = read_table(spark, d, "page_text").select("report_id", "page").distinct().join(offset, "report_id").select("report_id", (F.col("page") - 1 + F.col("page_offset")).alias("pdf_index"), F.col("page").alias("number"))
    sizes = known.groupBy("report_id").agg((F.max("pdf_index") + 1).alias("page_count"))
    probes = read_table(spark, d, "risk_instance").where("section IS NOT NULL").groupBy("report_id", "section").agg(F.min("page").alias("printed_page")).withColumnRenamed("section", "seq")
    return S.mode_first_seen(LO.measured_offsets(probes, known, sizes, "report_id"), ["report_id"], "page_offset", "seq")


# --- Streams, enrichment --------------------------------------------------------------------------------------------


@query(f"WITH {_WINS} SELECT run_id, report_id, phase, check_id, outcome, count FROM l")
def streamed_last_wins(spark, d):
    """The check log read as a stream and merged micro-batch by micro-batch ends as the batch result."""
    import uuid

    from citeloom.streaming import checks

    base = f"{shared_folder(spark).rstrip('/')}/citeloom/stream-{uuid.uuid4().hex}"
    schema = read_table(spark, d, "run_checks").schema
    stream = spark.readStream.schema(schema).parquet(f"{d}/run_checks.parquet*")
    checks.upsert_stream(stream, f"{base}/table", f"{base}/log")
    return checks.latest_generation(spark, f"{base}/table", schema).select("run_id", "report_id", "phase", "check_id", "outcome", "count")


@query()
def mitigation_paragraphs(spark, d):
    """The paragraph below a report's running head, on the first page that shows a record's title or the next one."""
    pages = read_table(spark, d, "page_text").where("text IS NOT NULL").select("report_id", "page", "text", F.lit("pages").alias("section"))
    return R.enriched(read_table(spark, d, "risk_instance"), pages, "[^\\n]+[Rr]eport[^\\n]*", "").select("id", "mitigation", "mitigation_page", F.col("citation.span").alias("citation"))


@query()
def identified_all(spark, d):
    """Topic-register records as proposed candidates against the main register's as table risks."""
    a, b = _sides(spark, d)
    tables = a.select("report_id", F.dense_rank().over(S.Window.partitionBy("report_id").orderBy("id")).alias("table_no"), "title", "span", F.lit(None).cast("string").alias("impact"))
    pages = G.page_texts(read_table(spark, d, "page_text")).withColumnRenamed("page_text", "text")
    found = X.identified_all(b.select("report_id", F.col("id").alias("seq"), "page", "title", "span"), tables, pages, _blocks(spark, d), "report_id")
    return found.select("seq", "table_no", "matched_by", "table_row", "type_above")
