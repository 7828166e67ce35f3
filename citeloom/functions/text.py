"""Text functions as Column expressions, so that they stay inside whole-stage code generation.

Character classes are written out: the JVM's ``\\w`` and ``\\s`` know ASCII only, and other engines differ.
All functions give null for null.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The words that carry no content when a sentence is compared with the text it cites.
STOP_WORDS = (
    "the a an and or of to in on for with by as at from that this these those is are be may can could might our we its it "
    "their they which such also than more not no into over across"
).split()

BLANKS = r"[ \t\r\n\x0B\f]+"


def squash(c: Column) -> Column:
    """Runs of blanks as one space, none at the ends."""
    return F.trim(F.regexp_replace(c, BLANKS, " "))


def _plain_marks(c: Column) -> Column:
    return F.translate(F.lower(c), "–’", "-'")


def norm_loose(c: Column) -> Column:
    """Lower case, everything but letters a-z, digits and spaces as one space a run; not collapsed, not trimmed."""
    return F.regexp_replace(_plain_marks(c), "[^a-z0-9 ]+", " ")


def norm_text(c: Column) -> Column:
    """``norm_loose`` with runs of spaces as one and none at the ends: the form for containment tests."""
    return F.trim(F.regexp_replace(norm_loose(c), " +", " "))


def norm_title(c: Column) -> Column:
    """``norm_text`` after parenthesised parts are dropped: the form in which titles are compared."""
    return norm_text(F.regexp_replace(c, r"\([^)]*\)", " "))


def slug(c: Column, mark: str = "_") -> Column:
    """Lower-case letters and digits joined by ``mark``."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", mark), f"^{mark}+|{mark}+$", "")


def canonical_key(company: Column, code: Column, title: Column) -> Column:
    """``company-code-title`` in slugs; records without a code take ``erm``, apostrophes vanish."""
    return F.concat_ws("-", company, F.coalesce(F.lower(F.nullif(code, F.lit(""))), F.lit("erm")), slug(F.regexp_replace(title, "['’]", ""), "-"))


def word_tokens(c: Column) -> Column:
    """Words with inner apostrophes and hyphens, in lower case, repeated as they stand."""
    return F.transform(F.regexp_extract_all(c, F.lit("[A-Za-z0-9][A-Za-z0-9'’-]*"), F.lit(0)), F.lower)


def _words(c: Column) -> Column:
    return F.filter(F.split(norm_text(c), " "), lambda w: w != "")


def context_words(c: Column) -> Column:
    """The set of words of the cited text."""
    return F.array_distinct(_words(c))


def content_words(c: Column) -> Column:
    """The set of words of a sentence that carry content: longer than two letters and no stop words."""
    stop = F.array(*[F.lit(w) for w in STOP_WORDS])
    return F.array_except(F.filter(_words(c), lambda w: F.length(w) > 2), stop)


def plain_sentences(c: Column) -> Column:
    """Sentences by the plain rule: a stop, blanks, a capital letter A-Z."""
    return F.filter(F.split(c, r"(?<=[.!?])[ \t\r\n]+(?=[A-Z])"), lambda s: F.trim(s) != "")


def numbers(c: Column) -> Column:
    """Figures standing as words of their own (a unit stuck to a figure hides it)."""
    edge = r"(?:(?<=[0-9])(?![\p{L}\p{N}_])|(?<=[.,%])(?=[\p{L}\p{N}_]))"
    return F.regexp_extract_all(c, F.lit(r"(?<![\p{L}\p{N}_])[0-9][0-9.,%]*" + edge), F.lit(0))


def figures(c: Column) -> Column:
    """Figures wherever they stand, without a trailing mark."""
    return F.regexp_extract_all(c, F.lit("[0-9]+(?:[.,][0-9]+)*"), F.lit(0))


def names(c: Column) -> Column:
    """Capitalised words of a sentence but its first, without marks around them, longer than two characters."""
    words = F.filter(F.split(c, BLANKS), lambda w: w != "")

    def after_first(w: Column) -> Column:
        return F.when(F.size(w) > 1, F.slice(w, 2, F.greatest(F.size(w) - 1, F.lit(1)))).otherwise(F.slice(w, 1, 0))

    bare = F.transform(bound(words, after_first), lambda w: F.regexp_replace(w, r"^[,.;:()]+|[,.;:()]+$", ""))
    return F.filter(bare, lambda w: (F.length(w) > 2) & w.rlike(r"^\p{Lu}"))


def name_runs(c: Column) -> Column:
    """Runs of two and more capitalised words, wherever they stand in a sentence, and single ones after its first word."""
    runs = F.regexp_extract_all(c, F.lit(r"\p{Lu}[\p{L}\p{N}'’-]+(?: \p{Lu}[\p{L}\p{N}'’-]+)+"), F.lit(0))
    return F.array_union(runs, F.filter(names(c), lambda w: ~F.exists(runs, lambda r: F.contains(r, w))))


def stem(word: Column) -> Column:
    """A word without its plain English endings, as far as three letters are left."""
    return F.regexp_replace(F.regexp_replace(word, "(?<=[a-z]{3})(?:ies|ied|y)$", "i"), "(?<=[a-z]{3})(?:ings?|edly|ed|es|s|e|ly)$", "")


def ngrams(words: Column, n: int = 3) -> Column:
    """Runs of ``n`` words; empty for shorter arrays (an unguarded ``sequence`` would count down)."""
    return F.when(
        F.size(words) >= n, F.transform(F.sequence(F.lit(1), F.size(words) - (n - 1)), lambda i: F.array_join(F.slice(words, i, n), " "))
    ).otherwise(F.slice(words, 1, 0))


def ngram_share(part: Column, whole: Column, n: int = 3) -> Column:
    """Share of the n-grams of ``part`` (each time it occurs) that ``whole`` has; texts shorter than ``n`` words
    count 1 if they are contained as they are and 0 if not."""
    a, b = word_tokens(part), word_tokens(whole)

    def share(t: Column) -> Column:
        hits = F.size(F.filter(t["grams"], lambda g: F.array_contains(t["have"], g)))
        short = F.contains(F.array_join(t["b"], " "), F.array_join(t["a"], " ")).cast("double")
        return F.when(F.size(t["a"]) < n, short).otherwise(F.try_divide(hits.cast("double"), F.size(t["grams"])))

    # Bound as lambda variables, so that each array is made once per row and not once per element.
    def with_grams(t: Column) -> Column:
        grams = F.struct(t["a"].alias("a"), t["b"].alias("b"), ngrams(t["a"], n).alias("grams"), F.array_distinct(ngrams(t["b"], n)).alias("have"))
        return bound(grams, share)

    return bound(F.struct(a.alias("a"), b.alias("b")), with_grams)


def bound(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once per row, also where ``use`` reads it inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def unhyphenate(c: Column) -> Column:
    """Words broken at a line end joined again."""
    return F.regexp_replace(c, r"(?<=[a-z])-\n(?=[a-z])", "")


def singular(c: Column) -> Column:
    """Words of five letters and more without a plural s."""
    return F.regexp_replace(c, r"\b([a-z]{4,}[^su])s\b", "$1")


def problem_kind(c: Column) -> Column:
    """A problem name without the number of its sentence and without its detail."""
    return F.regexp_replace(F.substring_index(c, ":", 1), r"^sentence_[0-9]+_", "sentence_")


def question_key(c: Column) -> Column:
    """Letters and digits of a question in lower case, the first forty."""
    return F.substring(F.regexp_replace(F.lower(c), "[^a-z0-9]+", ""), 1, 40)


def block_heading(c: Column) -> Column:
    """The second line of a block that is not blank (the first where it has no second), at most 80 characters."""
    lines = F.filter(F.transform(F.split(c, "\n"), lambda s: F.trim(s)), lambda s: s != "")
    return F.substring(F.coalesce(F.try_element_at(lines, F.lit(2)), F.try_element_at(lines, F.lit(1))), 1, 80)


def lexical_marker(c: Column) -> Column:
    """What a text without icon says of itself: immaterial, opportunity (unless it speaks of risk shortly before), risk."""
    low = F.lower(c)
    before = F.right(F.substring_index(low, "opportunit", 1), F.lit(40))
    return (
        F.when(F.contains(low, F.lit("immaterial")), "immaterial")
        .when(F.contains(low, F.lit("opportunit")) & ~F.contains(before, F.lit("risk")), "opportunity")
        .when(F.contains(low, F.lit("risk")), "risk")
    )


def stands_alone(text: Column, figure: Column) -> Column:
    """Whether a figure stands in a text without a digit on either side."""
    return F.regexp_like(text, F.concat(F.lit("(?<![0-9])\\Q"), figure, F.lit("\\E(?![0-9])")))


def review_every(c: Column) -> Column:
    """``every N months`` from a text that says ``(reviewed) every N months``, else null."""
    word = F.regexp_extract(c, r"every ([A-Za-z0-9]+) months", 1)
    return F.when(word != "", F.concat(F.lit("every "), word, F.lit(" months")))


def search_text(c: Column) -> Column:
    """Letters and digits in lower case without accents, blanks between words and at both ends, for phrase search."""
    accented = "àáâãäåāçćčèéêëēěìíîïīñńòóôõöøōőšśùúûüūűýÿžźż"
    plain = "aaaaaaa" + "ccc" + "eeeeee" + "iiiii" + "nn" + "oooooooo" + "ss" + "uuuuuu" + "yy" + "zzz"
    folded = F.translate(F.lower(c), accented, plain)
    return F.concat(F.lit(" "), F.trim(F.regexp_replace(folded, r"[^\p{L}\p{N}]+", " ")), F.lit(" "))


def matches_any(columns: list[Column], query: str) -> Column:
    """Full-text predicate: any blank-separated word of ``query`` stands in any of the columns; a word with inner
    marks is a phrase, a word without letters and digits is left out, no word left matches nothing."""
    terms = [F.lit(w) for w in query.split() if any(ch.isalnum() for ch in w)]
    hits = [F.contains(search_text(F.coalesce(c, F.lit(""))), search_text(t)) for c in columns for t in terms]
    out = F.lit(False)
    for h in hits:
        out = out | h
    return out
