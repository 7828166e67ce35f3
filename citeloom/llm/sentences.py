"""Problem 4: sentence boundaries across languages and scripts.

Method: document-centred disambiguation. A word before a period is an abbreviation if it stands elsewhere in the same
document where the period cannot end a sentence (a small letter, a digit or a comma follows); the word after the
period is a proper name or a sentence starter by its unambiguous occurrences in the document. Where the document is
silent, the counts of the whole corpus decide, gathered in one pass with partial aggregation. Scripts have their own
terminators: danda, ideographic and Arabic marks; Thai ends a sentence by a blank between two Thai letters; a period
after a Devanagari or Thai letter ends nothing.

Units run from the first to the last non-blank character, closing quotes and brackets included. A quotation inside a
sentence does not end it; a sentence that ends with its quotation ends there. A list item is one unit with its mark;
a line break ends a complete item and the line before a list, and nothing else.

Every word with at least ``MIN_COUNT`` occurrences counts, whatever the size of the corpus. Up to 2 / MIN_SHARE such words
are broadcast (their number is checked); of more, those that make up at least ``MIN_SHARE`` of all periods counted, which
cannot be more than that, and the rarer ones stay in a table that is joined to the words of the texts.

Defined results: null, empty and blank texts have no sentences; zero-width characters belong to the text around them
and are never a first or last character; extra columns are ignored; texts of any length are read whole.
"""

import re
import unicodedata
from collections import ChainMap, Counter
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citeloom.llm.visual import LOOK_ALIKES
from citeloom.plans.staging import staged

MIN_COUNT, MIN_SHARE = 3, 2e-5
#: A word takes the period as part of itself where its rate of texts' ends, at the upper bound of the confidence that so
#: many normal deviations give, is below this share of the rate of ordinary words.
DEVIATIONS, SELDOM_LAST = 1.645, 1 / 3

_INVISIBLE = re.compile("[­͏؜᠎​-‏‪-‮⁠-⁤⁦-⁯︀-️﻿]")
_OPEN = "“«„‚「『《〈（([{【〔＜｢"
_CLOSE = "”»」』》〉）)]}】〕＞｣’‘\"'“"
#: Closing marks of each opening quote; German quotes close with the mark that opens English ones.
_PAIRS = {"“": "”", "«": "»", "„": "“”", "「": "」", "『": "』", "《": "》", "〈": "〉", "（": "）)", "(": ")）", "[": "]", "{": "}", "【": "】", "〔": "〕", "｢": "｣", "»": "«", "‚": "‘’"}
_BRACKETS = set("（([{【〔")
_FULL = "。｡！？"  # end a sentence without a blank after them
_HARD = "!?؟।॥۔！？‼⁇⁈⁉"
_ENDS = set(".…．" + _FULL + _HARD)
_MARK = re.compile(r"[ \t]*(?:[-–—*•·▪◦‣●○■□►▶]|(\d{1,2}|[a-zA-Z])[.)]|\((?:\d{1,2}|[a-zA-Z])\))[ \t  ]+(?=\S)")
_BREAKS = frozenset("“”«»„‚「」『』（）()[]{}\"'’‘,;:!?¡¿…—–/")
_BLANK = re.compile(r"\s*")
_LEAD = re.compile(r"\s*[" + re.escape(_OPEN) + "\"'¿¡]*")
_OPENERS = re.compile("[" + re.escape(_OPEN) + "¿¡]*")
_FIRST_WORD = re.compile(r"[^\W\d_][\w’'-]*")
_GLUED = re.compile(r"[^\W\d_]{2,}|[^\W\d_](?=\s)")
_QUOTED_WORD = re.compile(r"[“«„¿¡(]*([^\W\d_][\w’'-]*)")
_TWO_WORDS = re.compile(r"\W*[\w’'-]+(?:\W+[\w’'-]+)?")
_INITIALS = re.compile(r"(?:[^\W\d_]\.)*[^\W\d_]")
_INNER_PERIOD = re.compile(r"[^\W\d_]\.")
#: Characters without a blank or mark between them from which a run is no word.
LONGEST_WORD = 200
_CJK = re.compile("[぀-ヿ㐀-鿿豈-﫿]")


_LOOKS = str.maketrans(*LOOK_ALIKES)
#: Kinds of counts, see ``evidence``.
_KINDS = "anpsieou"
#: Numbers of one or two digits before a period count as one word.
_NUMBER, _ORDINAL = "#", re.compile(r"\d{1,2}")


def _thai(c: str) -> bool:
    return "ก" <= c <= "๎" and c != "฿"


def _devanagari(c: str) -> bool:
    return "ऀ" <= c <= "ॣ" or "॰" <= c <= "ॿ"


@lru_cache(1 << 16)
def _key(word: str) -> str:
    """The form under which a word is counted: case, compatibility forms and look-alikes folded."""
    k = unicodedata.normalize("NFKC", word).translate(_LOOKS).casefold()
    return _NUMBER if _ORDINAL.fullmatch(k) else k


def _visible(text: str) -> tuple[str, Sequence[int]]:
    """The text without zero-width characters, and the position of each of its characters."""
    if not _INVISIBLE.search(text):
        return text, range(len(text))
    kept = [(c, i) for i, c in enumerate(text) if not _INVISIBLE.match(c)]
    return "".join(c for c, _ in kept), [i for _, i in kept]


_PERIOD = re.compile(r"(?<=\S)\.(?=[\s“”«»„」』（）()\"'’,;:]|$)")


def _word_before(s: str, at: int) -> str:
    """The word before the period at ``at``; of two that lost the blank between them, the second. A run of more than
    ``LONGEST_WORD`` characters is none."""
    i, low = at, max(0, at - LONGEST_WORD)
    while i > low and s[i - 1] not in _BREAKS and not s[i - 1].isspace():
        i -= 1
    if i and i == low and s[i - 1] not in _BREAKS and not s[i - 1].isspace():
        return ""
    word = s[i:at]
    if "." not in word:
        return word
    head, _, tail = word.rpartition(".")
    return tail if len(head.rpartition(".")[2]) >= 3 and tail and not tail[0].isdigit() else word


def _next(s: str, at: int, stop: int | None = None) -> str:
    """The first character from ``at`` on that is no blank, or nothing."""
    j = (_BLANK.match(s, at) if stop is None else _BLANK.match(s, at, stop)).end()
    return s[j : j + 1] if stop is None or j < stop else ""


def _last(s: str, end: int) -> int:
    """The position of the last character before ``end`` that is no blank, or -1."""
    while end and s[end - 1].isspace():
        end -= 1
    return end - 1


def _context(s: str, at: int) -> tuple[str, str, str]:
    """The word before the period at ``at``, the kind of what follows and the next word.

    Kinds: ``cont`` (the period ends no sentence), ``start`` (a capitalised word, ambiguous), ``other``, ``end``.
    """
    word = _word_before(s, at)
    if s[at + 1 : at + 2] and s[at + 1] in ",;:":
        return word, "cont", ""
    j = _LEAD.match(s, at + 1).end()
    if j == len(s):
        return word, "end", ""
    c = s[j]
    if c.islower():
        after = _FIRST_WORD.match(s, j)
        return word, "cont", after[0] if after else ""
    if c.isdigit():
        return word, "digit", ""
    if c.isupper() or c.istitle():
        after = _FIRST_WORD.match(s, j)
        return word, "start", after[0] if after else ""
    return word, "other", ""


_MARKS = re.compile("[" + re.escape("".join(dict.fromkeys([*_PAIRS, *"".join(_PAIRS.values()), '"']))) + "]")
_PARAGRAPH = re.compile(r"[ \t\r]*\n(?=[ \t\r]*\n|" + _MARK.pattern + ")")
_STARTS = re.compile(r"(?:^|[!?…]\s+|[!?]”\s+)[“«„¿¡(]*([^\W\d_][\w’'-]*)")
_INNER = re.compile(r"(?<=[\w,;:] )[“«„(]?([^\W\d_a-zа-яß-öø-ÿ][\w’'-]*)")
_EVENT = re.compile("[" + re.escape("".join(dict.fromkeys([*_PAIRS, *"".join(_PAIRS.values()), '"', *sorted(_ENDS)]))) + r"]|(?<=[ก-๎])\s")


def _pairs(s: str, start: int, stop: int) -> dict[int, int]:
    """Positions of opening quotes and brackets with those of their closing marks; a stray mark has none.

    One pass: a closing mark takes the last open one of its kind, and what was opened after that is stray.
    """
    found: dict[int, int] = {}
    stack: list[tuple[int, str]] = []
    waiting: Counter = Counter()
    for m in _MARKS.finditer(s, start, stop):
        i, c = m.start(), m[0]
        if waiting[c]:
            while True:
                at, closers = stack.pop()
                waiting.subtract(closers)
                if c in closers:
                    found[at] = i
                    break
        elif c in _PAIRS or c == '"':
            stack.append((i, _PAIRS.get(c, c)))
            waiting.update(stack[-1][1])
    return found


def evidence(text: str) -> Counter:
    """Counts of one text: ``("a", word)`` before a period that ends no sentence, ``("p", word)`` before any period,
    ``("u", word)`` before one outside quotes and brackets, ``("e", word)`` before such a one at the end of a text or
    before an empty line or a list (a line break in running text ends nothing), ``("n", word)`` before a period and a digit,
    ``("o", word)`` where a short word would be a whole sentence, ``("s", word)`` first word after a sure end, ``("i", word)`` capitalised inside a sentence."""
    s, _ = _visible(text)
    out: Counter = Counter()
    pairs, inner = sorted(_pairs(s, 0, len(s)).items(), reverse=True), -1
    for m in _PERIOD.finditer(s):
        while pairs and pairs[-1][0] < m.start():
            inner = max(inner, pairs.pop()[1])
        word, kind, _ = _context(s, m.start())
        if word and (any(c.isalpha() for c in word) or _ORDINAL.fullmatch(word)):
            k = _key(word)
            first = m.start() - len(word)
            at = first
            while at and s[at - 1] == " ":
                at -= 1
            lead = s[at - 1 : at]
            if k == _NUMBER and lead in ("", "\n"):
                continue  # the mark of a list
            out["p", k] += 1
            if m.start() > inner:
                out["u", k] += 1
                if kind == "end" or _PARAGRAPH.match(s, m.end()):
                    out["e", k] += 1
            if kind == "cont":
                out["a", k] += 1
            elif kind == "start" and len(word) <= 5 and word[0].isupper() and (not lead or lead in "!?…\n"):
                out["o", k] += 1
            elif kind == "digit":
                out["n", k] += 1
    for m in _STARTS.finditer(s):
        if m[1][0].isupper():
            out["s", _key(m[1])] += 1
    for m in _INNER.finditer(s):
        if m[1][0].isupper():
            out["i", _key(m[1])] += 1
    return out


def _count_words(column: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total: Counter = Counter()
            for text in batch.column(column).to_pylist():
                total.update(evidence(text))
            if total:
                yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in total]), pa.array([w for _, w in total]), pa.array(total.values(), pa.int64())], names=["kind", "word", "n"])

    return run


def corpus_evidence(texts: DataFrame, column: str = "text") -> dict[tuple[str, str], int]:
    """Counts of the whole corpus for its frequent words."""
    return _corpus(texts, column)[0]


def _corpus(texts: DataFrame, column: str = "text") -> tuple[dict[tuple[str, str], int], DataFrame | None]:
    """The counts of ``corpus_evidence``, and a table of those of the rarer words where there are any."""
    counts = texts.where(F.col(column).isNotNull()).select(column).mapInArrow(_count_words(column), "kind string, word string, n long").groupBy("kind", "word").agg(F.sum("n").alias("n"))
    words = staged(counts.groupBy("word").agg(*(F.sum(F.when(F.col("kind") == k, F.col("n")).otherwise(0)).alias(k) for k in _KINDS)), "words")
    ordinary = (F.length("word") > 1) & (F.col("a") + F.col("n") < 0.3 * F.col("p"))
    sums = words.agg(F.sum("p"), F.sum("s"), *(F.sum(F.when(ordinary, F.col(k))) for k in "ue")).first()
    least_p, least_s = max(MIN_COUNT, MIN_SHARE * (sums[0] or 0)), max(MIN_COUNT, MIN_SHARE * (sums[1] or 0))
    counted, frequent = (F.col("p") >= MIN_COUNT) | (F.col("s") >= MIN_COUNT), (F.col("p") >= least_p) | (F.col("s") >= least_s)
    few = words.where(counted).limit(int(2 / MIN_SHARE) + 1).count() <= 2 / MIN_SHARE if MIN_SHARE else True
    kept = words.where(counted if few else frequent).collect()
    rare = None if few else words.where(~frequent & counted)
    total = {("u", ""): sums[2], ("e", ""): sums[3]} if sums[3] else {}  # of ordinary words
    return {(k, r["word"]): r[k] for r in kept for k in _KINDS if r[k]} | total, rare


def _seldom_last(k: str, corpus: dict) -> bool:
    """Whether texts end with the word far less often than with ordinary words, beyond chance."""
    u, e = corpus.get(("u", k), 0), corpus.get(("e", k), 0)
    all_u, all_e = corpus.get(("u", ""), 0), corpus.get(("e", ""), 0)
    if not u or not all_u:
        return False
    z, rate = DEVIATIONS, e / u
    upper = (rate + z * z / (2 * u) + z * (rate * (1 - rate) / u + z * z / (4 * u * u)) ** 0.5) / (1 + z * z / u)
    return upper <= SELDOM_LAST * all_e / all_u


def _is_abbreviation(word: str, kind: str, here: Counter, corpus: dict) -> bool:
    """Whether ``word`` with its period is an abbreviation, by the document first and the corpus second."""
    if not word:
        return False
    if (len(word) == 1 or "." in word) and _INITIALS.fullmatch(word):
        return True  # initials and single letters: J., U.S., i.e., z., B.
    k = _key(word)
    if here["a", k]:
        return True
    a, n, p, o = (corpus.get((c, k), 0) for c in "anpo")
    a += o
    return p >= MIN_COUNT and (a >= 0.3 * p and a >= 2 or a + n >= 0.85 * p) or _seldom_last(k, corpus)


def _starts_sentence(nxt: str, here: Counter, corpus: dict) -> bool:
    """Whether a capitalised word after an abbreviation starts a sentence: it does where it is known as a first word
    and seldom stands capitalised inside a sentence."""
    k = _key(nxt)
    s, i = corpus.get(("s", k), 0) + 2 * here["s", k], corpus.get(("i", k), 0) + 2 * here["i", k]
    return s >= MIN_COUNT and s >= i


def _closes_with(word: str, here: Counter, corpus: dict) -> bool:
    """Whether an abbreviation also ends sentences (as Inc. does): not one that needs what follows."""
    k = _key(word)
    u, e = corpus.get(("u", k), 0), corpus.get(("e", k), 0)
    return not u or e >= 0.02 * u


def _ends_at(s: str, at: int, here: Counter, corpus: dict) -> bool:
    """Whether the run of terminators whose last character is ``at`` (no closers after it) ends a sentence."""
    c, near = s[at], s[at + 1 : at + 2]
    if c in _FULL or c in "।॥":
        return True
    if c in _HARD:
        if near and not near.isspace() and not _CJK.match(near):
            return near.isupper() or near in _OPEN + "¿¡"
        nxt = _next(s, at + 1)
        return not nxt or not (nxt.islower() or nxt in ",;:，、；：")
    if c == "…":
        nxt = _next(s, at + 1)
        return not nxt or (nxt.isupper() or nxt in _OPEN + "¿¡" or bool(_CJK.match(nxt))) and nxt not in ",;"
    before = s[at - 1] if at else ""
    if before == "." or before == "…":
        nxt = _next(s, at + 1)
        return not nxt or nxt.isupper()
    if before and (_thai(before) or _devanagari(before)):
        return False
    if near and not near.isspace() and near not in _CLOSE:
        # No blank after the period: a lost blank between two sentences, or a figure, an initial, an address.
        word = _word_before(s, at)
        first = _OPENERS.match(s, at + 1).end()
        if near in _OPEN + "¿¡" or near.isupper():
            if len(word) < 2 or _INNER_PERIOD.search(word):
                return False
            if _is_abbreviation(word, "", here, corpus):
                after = _FIRST_WORD.match(s, first)
                return bool(after) and _starts_sentence(after[0], here, corpus) and _closes_with(word, here, corpus)
            return bool(_GLUED.match(s, first) or near in _OPEN)
        return bool(_CJK.match(near))
    word, kind, nxt = _context(s, at)
    if kind == "cont":
        return False
    if kind == "end":
        return True
    if not _is_abbreviation(word, kind, here, corpus):
        return True
    if kind == "digit":
        return False
    if kind == "start":
        return _starts_sentence(nxt, here, corpus) and _closes_with(word, here, corpus)
    return not _devanagari(before) and not (len(word) == 1 or "." in word) and _closes_with(word, here, corpus) and _next(s, at + 1) not in "—–-("


def _blocks(s: str, here: Counter, corpus: dict) -> list[tuple[int, int, bool]]:
    """Stretches of lines that belong together: (start, end, is a list item).

    An item that breaks off in mid-sentence at the end of its line goes on in the next one: it is a wrapped line.
    """
    lines, at = [], 0
    for line in s.split("\n"):
        lines.append((at, at + len(line)))
        at += len(line) + 1
    out, run, number = [], None, None
    for a, b in lines:
        m = _MARK.match(s, a, b)
        mark = m is not None
        if mark and m[1] is not None:
            value = int(m[1]) if m[1].isdigit() else ord(m[1].lower()) - 96
            mark = value == 1 or number is not None and value == number + 1
            number = value if mark else None
        elif not mark and s[a:b].strip():
            number = None
        if mark:
            if run:
                out.append((*run, False))
            out.append((a, b, True))
            run = None
        elif run is None and out and out[-1][2] and out[-1][1] + 1 == a and s[a:b].strip() and not _item_over(s, out[-1][1], a, here, corpus):
            out[-1] = (out[-1][0], b, True)
        else:
            run = (run[0], b) if run else (a, b)
    if run:
        out.append((*run, False))
    return out


def sentences(text: str, corpus: dict | None = None) -> list[tuple[int, int]]:
    """Spans of the sentences of ``text``."""
    if not text or not text.strip():
        return []
    corpus = corpus or {}
    s, where = _visible(text.replace("\r", " "))
    here = _Here(text)
    out: list[tuple[int, int]] = []

    def add(a: int, b: int) -> None:
        while a < b and s[a].isspace():
            a += 1
        while b > a and s[b - 1].isspace():
            b -= 1
        if b > a:
            out.append((where[a], where[b - 1] + 1))

    for start, stop, item in _blocks(s, here, corpus):
        if item:
            add(start, stop)
            continue
        begin, resume, stack, pairs = start, start, [], _pairs(s, start, stop)
        for m in _EVENT.finditer(s, start, stop):
            i = m.start()
            if i < resume:
                continue
            c = s[i]
            if stack and i == stack[-1][0]:
                opened = stack.pop()[1]
                # A sentence that ends with its quotation: ended inside, and nothing of it goes on after the close.
                if not stack and s[i - 1] in _ENDS and _after_quote(s, i, stop, here, corpus, opened):
                    resume = _swallow(s, i + 1, stop)
                    add(begin, resume)
                    begin = resume
            elif i in pairs:
                stack.append((pairs[i], i))
            elif c in _ENDS and not stack:
                j = i
                while j + 1 < stop and s[j + 1] in _ENDS:
                    j += 1
                # French and others put a blank before the mark; it belongs to the sentence either way.
                if _ends_at(s, j, here, corpus):
                    resume = _swallow(s, j + 1, stop)
                    add(begin, resume)
                    begin = resume
                else:
                    resume = j + 1
            elif c.isspace() and not stack and i > start and _thai(s[i - 1]):
                j = _BLANK.match(s, i, stop).end()
                if j < stop and _thai(s[j]):
                    add(begin, i)
                    begin = j
                resume = j
        add(begin, stop)
    return out


class _Here:
    """The counts of one text, made when first asked for."""

    def __init__(self, text: str):
        self.text, self.counts = text, None

    def __getitem__(self, key: tuple[str, str]) -> int:
        if self.counts is None:
            self.counts = evidence(self.text)
        return self.counts[key]


def _swallow(s: str, i: int, stop: int) -> int:
    """The end of the closing marks at ``i``."""
    while i < stop and s[i] in "”»」』》〉）)]}】〕｣’\"'":
        i += 1
    return i


def _after_quote(s: str, i: int, stop: int, here: Counter, corpus: dict, opened: int | None = None) -> bool:
    """Whether the sentence ends with the quotation closed at ``i`` (opened at ``opened``)."""
    if s[i] in ")）]}】〕":
        lead = _last(s, max(s.rfind(o, 0, i) for o in "(（[{【〔") if opened is None else opened)
        if lead >= 0 and s[lead] not in _ENDS:
            return False  # a parenthesis inside a sentence
        if s[i - 1] == "." and _is_abbreviation(_context(s, i - 1)[0], "", here, corpus):
            return False
    j = i + 1
    k = _BLANK.match(s, j, stop).end()
    if k >= stop:
        return True
    c = s[k]
    if c in ",;:,，、；：.。—–-" or c in _ENDS or c.islower():
        return False
    if c.isdigit():
        return k > j
    if "぀" <= c <= "ゟ":
        return False  # a particle goes on with the sentence
    if c.isupper() or c in _OPEN + "¿¡" or _CJK.match(c):
        word = _QUOTED_WORD.match(s, k, stop)
        if word and word[1].isupper() and (len(word[1]) > 1 or _TWO_WORDS.match(s, k, stop)[0].isupper()):  # in capitals, case tells nothing
            return _starts_sentence(word[1], here, corpus)
        return True
    return not _thai(c)


def _item_over(s: str, end: int, begin: int, here: Counter, corpus: dict) -> bool:
    """Whether the list item that reaches the line end ``end`` is complete before the line at ``begin``."""
    last = end - 1
    while last >= 0 and (s[last].isspace() or s[last] in "”»」』》〉）)]}】〕｣\"'“"):
        last -= 1
    if last >= 0 and s[last] in _ENDS:
        return _ends_at(s, last, here, corpus) if last == _last(s, end) else _after_quote(s, last + 1, len(s), here, corpus)
    word = _QUOTED_WORD.match(s, _BLANK.match(s, begin).end())
    return bool(word and word[1][0].isupper() and _starts_sentence(word[1], here, corpus))


def _asked(text: str) -> set[str]:
    """The forms of all words that ``sentences`` may look up for ``text``."""
    s, _ = _visible(text.replace("\r", " "))
    before = {_word_before(s, m.start()) for m in re.finditer(r"[.．]", s)}
    return {_key(w) for w in before | {w for w in re.findall(r"[^\W\d_][\w’'-]*", s) if not w[0].islower()} if w}


def _with_rare(long: DataFrame, rare: DataFrame) -> DataFrame:
    """``long`` with the counts of the rare words of each text in ``rare``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(k, w) for k, t in zip(batch.column("__key").to_pylist(), batch.column("text").to_pylist()) for w in _asked(t)]
            yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in found], pa.string()), pa.array([w for _, w in found], pa.string())], names=["__key", "word"])

    keyed = long.withColumn("__key", F.sha2("text", 256))
    words = keyed.groupBy("__key").agg(F.first("text").alias("text")).mapInArrow(run, "__key string, word string")
    counts = words.join(rare, "word").groupBy("__key").agg(F.collect_list(F.struct("word", *_KINDS)).alias("rare"))
    return keyed.join(counts, "__key", "left").drop("__key")


def split_columns(df: DataFrame, id_column: str, columns: list[str], corpus: dict, rare: DataFrame | None = None) -> DataFrame:
    """(id, field, start_pos, end_pos) of every sentence of the text columns."""
    long = None
    for c in columns:
        one = df.select(F.col(id_column).alias("__id"), F.lit(c).alias("field"), F.col(c).alias("text")).where(F.col(c).isNotNull())
        long = one if long is None else long.unionByName(one)
    long = long.withColumn("rare", F.lit(None)) if rare is None else _with_rare(long, rare)
    shared = df.sparkSession.sparkContext.broadcast(corpus)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.value
        for batch in batches:
            rows, starts, ends = [], [], []
            for row, (text, own) in enumerate(zip(batch.column("text").to_pylist(), batch.column("rare").to_pylist())):
                extra = {(k, r["word"]): r[k] for r in own or () for k in _KINDS if r[k]}
                for a, b in sentences(text, ChainMap(extra, known) if extra else known):
                    rows.append(row), starts.append(a), ends.append(b)
            take = pa.array(rows, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("__id").take(take), batch.column("field").take(take), pa.array(starts, pa.int32()), pa.array(ends, pa.int32())], names=[id_column, "field", "start_pos", "end_pos"])

    kind = dict(df.dtypes)[id_column]
    return long.mapInArrow(run, f"`{id_column}` {kind}, field string, start_pos int, end_pos int")


def record_sentences(instances: DataFrame) -> DataFrame:
    """Sentences of ``description`` and ``verbatim_span`` of every record."""
    texts = instances.select(F.col("description").alias("text")).unionByName(instances.select(F.col("verbatim_span").alias("text")))
    corpus, rare = _corpus(texts)
    return split_columns(instances.withColumnRenamed("id", "risk_instance_id"), "risk_instance_id", ["description", "verbatim_span"], corpus, rare)
