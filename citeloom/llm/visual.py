"""Problem 5: one form for texts that look the same and differ in their characters.

Method: DuckDB inside the Arrow partitions. Each batch is a relation of an in-memory connection, and one SQL
expression folds it: ``regexp_replace`` drops invisible characters and turns blanks into a space, ``translate`` and
``replace`` map compatibility forms (full width, ligatures, radicals, presentation forms) and look-alike letters, and
``nfc_normalize`` composes accents. Both texts of a comparison go through the same expression.

Only forms that look the same are folded. Digits, words, letters and accents that look different stay different: no
case folding, no accent stripping, no superscripts, fractions, circled or squared forms.

Defined results: null stays null; an empty text stays empty; blanks at the ends are cut. A span that is null or blank
is found on no page. Repeated page rows count once. Extra columns are ignored.
"""

import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Kinds of compatibility decomposition whose result looks like the character itself.
SAME_LOOK = ("<wide>", "<narrow>", "<compat>", "<noBreak>", "<initial>", "<medial>", "<final>", "<isolated>", "<font>")

#: Letters of other scripts drawn like a Latin letter, and the Latin letters.
LOOK_ALIKES = (
    "АВЕЅІЈКМНОРСТУХаеѕіјорсухҮԁԛԜԝһҺ"  # Cyrillic
    "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧονϳϲϹ"  # Greek
    "ıӏ‐‑‒",
    "ABESIJKMHOPCTYXaesijopcyxYdqWwhH"
    "ABEZHIKMNOPTYXovjcC"
    "il---",
)

#: Format characters without a shape of their own.
INVISIBLE = r"[\x{00AD}\x{034F}\x{061C}\x{115F}\x{1160}\x{17B4}\x{17B5}\x{180B}-\x{180F}\x{200B}-\x{200F}\x{202A}-\x{202E}\x{2060}-\x{206F}\x{FE00}-\x{FE0F}\x{FEFF}\x{FFF9}-\x{FFFB}]"
BLANKS = r"[\t\n\x{000B}\f\r\x{0085} \x{00A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]+"


@lru_cache(1)
def compatibility_forms() -> tuple[dict[str, str], dict[str, str]]:
    """Characters of the basic plane and the letter-like symbols whose compatibility form looks the same: those with
    one replacing character, and those with more (ligatures, the ellipsis)."""
    one, more = {}, {}
    for code in (*range(0xA0, 0xD800), *range(0xF900, 0xFFFF), *range(0x1D400, 0x1D800)):
        ch = chr(code)
        kind = unicodedata.decomposition(ch).partition(" ")[0]
        folded = unicodedata.normalize("NFKC", ch)
        if kind in SAME_LOOK and folded != ch and not ch.isspace() and not folded[0].isspace() and not unicodedata.name(ch, "").startswith("PARENTHESIZED"):
            if kind == "<compat>" and (any(c.isdigit() for c in folded) or "ROMAN NUMERAL" in unicodedata.name(ch, "") or unicodedata.name(ch, "").startswith("THAI")):
                continue
            (one if len(folded) == 1 else more)[ch] = folded
    return one, more


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def fold_sql(column: str) -> str:
    """The DuckDB expression that folds ``column``."""
    one, more = compatibility_forms()
    source, target = "".join(one), "".join(one.values())
    sql = f"regexp_replace(regexp_replace({column}, '{INVISIBLE}', '', 'g'), '{BLANKS}', ' ', 'g')"
    sql = f"translate({sql}, {_quoted(source)}, {_quoted(target)})"
    # Sequences are rare: only texts that hold one of their characters pay for the replacements.
    each = "x"
    for ch, folded in more.items():
        each = f"replace({each}, {_quoted(ch)}, {_quoted(folded)})" if ch in _LIGATURES else each
    sql = f"list_transform([{sql}], lambda x: {each})[1]"
    sql = f"translate(nfc_normalize({sql}), {_quoted(LOOK_ALIKES[0])}, {_quoted(LOOK_ALIKES[1])})"
    return f"trim(regexp_replace(nfc_normalize({sql}), ' +', ' ', 'g'), ' ')"


#: Characters standing for several: Latin and Armenian ligatures, digraph letters, dot leaders.
_LIGATURES = {*"ĲĳŉǄǅǆǇǈǉǊǋǌǱǲǳ‥…‼⁇⁈⁉", *map(chr, range(0xFB00, 0xFB07)), *map(chr, range(0xFB13, 0xFB18)), *map(chr, range(0xFEF5, 0xFEFD))}


def _connection():
    import duckdb

    con = duckdb.connect(config={"threads": 1, "memory_limit": "400MB"})
    con.execute("SET enable_progress_bar = false")
    return con


def _folding(out: T.StructType, sql: str):
    from pyspark.sql.pandas.types import to_arrow_schema

    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        con = _connection()
        for batch in batches:
            con.register("batch", pa.Table.from_batches([batch]))
            table = con.sql(sql).to_arrow_table()
            con.unregister("batch")
            yield from table.cast(schema).to_batches()

    return run


def fold_columns(df: DataFrame, columns: list[str], suffix: str = "_folded") -> DataFrame:
    """``df`` with a folded copy of each text column of ``columns``, in the same partitions."""
    out = T.StructType([*df.schema.fields, *(T.StructField(c + suffix, T.StringType()) for c in columns)])
    sql = "SELECT *, " + ", ".join(f'{fold_sql(chr(34) + c + chr(34))} AS "{c}{suffix}"' for c in columns) + " FROM batch"
    return df.mapInArrow(_folding(out, sql), out)


def _plain(c):
    return F.trim(F.regexp_replace(c, r"[ \t\r\n]+", " "))


def found_when_folded(instances: DataFrame, pages: DataFrame) -> DataFrame:
    """Records whose page does not contain their span as it is and does once both are read as they look.

    The plain test runs in the join, so that only the pairs that fail it reach DuckDB.
    """
    spans = instances.select(F.col("id").alias("risk_instance_id"), "report_id", "page", _plain(F.col("verbatim_span")).alias("span")).where("span <> ''")
    texts = pages.where("text IS NOT NULL").select("report_id", "page", _plain(F.col("text")).alias("page_text")).distinct()
    pairs = spans.join(texts, ["report_id", "page"]).where(~F.contains("page_text", "span")).select("risk_instance_id", "span", "page_text")
    out = T.StructType([T.StructField("risk_instance_id", T.StringType())])
    sql = f"SELECT risk_instance_id FROM (SELECT risk_instance_id, {fold_sql('span')} AS s, {fold_sql('page_text')} AS t FROM batch) WHERE s <> '' AND contains(t, s)"
    return pairs.mapInArrow(_folding(out, sql), out).distinct()
