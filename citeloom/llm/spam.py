"""Problem 8: keyword-stuffed and link-list pages.

Method: the suffix automaton of a page's tokens gives, for each token, the longest repeated substring that ends there;
those that weigh at least ``LEAST_WEIGHT`` (two words, a word with its separator, four characters of a script without
blanks) mark the characters covered by repeated maximal substrings. Links and hash tags, prices and article numbers are one
symbol each, whatever they spell, so a list of links repeats itself. A line counts as spam where that coverage fills it and it has no clause
structure; a page is spam if such lines hold more than half of its characters. No line is spam without the coverage.

A line lacks clause structure if most of it does not stand in phrases of several words (or of a long run in scripts
without blanks) between separators and links, or if it is a long run without any end of a sentence. Marks alone make no
clause, as keywords may be dressed with stops: a line that looks like clauses lacks their structure where many pairs of
near words stand in both orders within sentences (``unordered``). Prose repeats words as well, but in the order of its
clauses; a sentence said again is counted once, so repeated prose stays prose. Contents lines, numbered references,
headings and lists of sentences are no spam lines.

Only a pair of tokens that stands twice, or a heavy token that does, can be covered, which bounds a line's coverage.
``spam_pages`` goes on where the lines that pass this bound hold more than half of the page, and builds the automaton
where those of them that lack clause structure do; elsewhere it cannot change the answer. ``page_scores`` does all of it
for every page, and a test compares them.

A page is one row; its work grows in proportion to its length, and no page meets another, so nothing is shuffled.

Defined results: null, empty and blank texts are no spam; repeated texts are judged alike; other columns are ignored.
"""

import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

_DENSE_CHARS = "一-鿿぀-ヿ"
_SEPARATORS = r"[,;|/»«•·#>\[\]()（）、，；：:]"
_PLAIN = rf"[{_DENSE_CHARS}]|[^\W\d_{_DENSE_CHARS}]+|\d+|{_SEPARATORS}"
_WORD = re.compile(_PLAIN)
_LINK = re.compile(r"(?:https?://|www\.)\S+|(?<![\w@.])[\w-]+(?:\.[\w-]+)+/\S*|(?<![\w@.])(?:[a-zA-ZÀ-ɏ\d-]{2,}\.)+[a-zA-Z]{3,10}(?![\w.])")
_PRICE = re.compile(r"(?:[€$£¥₽]\s?\d|\d\s?(?:[€$£¥₽]|EUR\b|USD\b|руб))")
#: The same tokens, where a line may hold links, hash tags, prices or article numbers: each of those is one.
_SYMBOL = re.compile(rf"{_LINK.pattern}|#\w+|[€$£¥₽]\s?\d[\d.,]*|\d[\d.,]*\s?(?:[€$£¥₽]|EUR\b|USD\b|руб)|\b[A-Za-z]{{1,3}}\d+\b|{_PLAIN}")
_DOTTED = re.compile(r"\.[a-zA-Z]{3}")
_PRICED, _CODE = re.compile(r"\d.*[€$£¥₽DRб]|[€$£¥₽].*\d"), re.compile(r"[A-Za-z]+\d+")
_SPLIT = re.compile(r"[,;|/»«•·#>\[\]()（）、，；：:]+|\s[–—-]\s|\s->\s|[.!?。！？।؟…]+(?:\s|$|(?=[^\d\s]))")
_ENDS = re.compile(r"[.!?…。！？।॥؟｡](?:[\s”»」』)\]\"’“]|$)")
_CONTENTS = re.compile(r"(?:\.\s?){4,}\s*\d+\s*$|^\s*\d+(?:\.\d+)*\.?\s+\S.*\s\d{1,4}\s*$")
_REFERENCE = re.compile(r"^\s*(?:\[\d+\]|\(\d+\)|\d+\.|[*†‡]|[⁰¹²³⁴-⁹]+)\s+\S.*,.*")
_DENSE = re.compile("[一-鿿぀-ヿก-๛]")
_TOKEN = re.compile(r"[^\s.!?…,;:()\[\]{}|/<>=+*#•·\"“”«»„‚「」『』（）、，；：。！？।॥؟،؛]+")
_STOP = re.compile(r"[.!?…]+(?=\s|$)|[。！？।॥؟]|(?<=[ก-๎])\s+(?=[ก-๎])")
_HAN = re.compile("[一-鿿぀-ヿ]")
#: Words (or characters of a script without blanks) from which a phrase counts as a clause.
CLAUSE_WORDS, CLAUSE_DENSE = 6, 12
#: Words from which a line without any end of a sentence may be a run of keywords, hash tags that make a tag line, and
#: arrows that make a menu.
RUN_WORDS, HASH_TAGS, MENU_MARKS = 20, 8, 5
#: Weight from which a repeated substring covers: a word counts 2 (from ``LONG_WORD`` letters on 4), a separator 2, a
#: character of a script without blanks 1, a link, a hash tag or a price 4.
LEAST_WEIGHT, LONG_WORD = 4, 12
#: Covered share of a line from which it is made of repetitions, the same of a line of links or prices, which has the
#: least clause structure, and share of a page's characters from which it is spam.
REPEATED, LISTED, SPAM = 0.5, 0.35, 0.5
#: Words of a unit whose order is looked at, distance up to which two words are a pair, share of the rarer order from
#: which a pair has no fixed order, and share of such pairs from which a line is stuffed.
UNIT_WORDS, NEAR, EITHER, UNORDERED = 6, 8, 0.2, 0.34
#: Characters of the pages whose tokens are counted at once.
BATCH_CHARS = 1_000_000


def repeated_lengths(words: list) -> list[int]:
    """For each position the length of the longest substring that ends there and stands elsewhere too.

    The suffix automaton of the sequence; a state's occurrences are summed along its suffix links. No repeated substring
    holds a word that stands once, so such a word cuts the sequence: the automaton goes on at its root.
    """
    times = Counter(words)
    moves: list[dict] = [{}]
    link, length, count = [-1], [0], [0]
    last, prefix = 0, []
    for w in words:
        if times[w] == 1:
            last = 0
            prefix.append(0)
            continue
        q = moves[last].get(w, 0)
        if q:  # after a cut the automaton may know the way
            if length[q] == length[last] + 1:
                cur = q
            else:
                cur = len(moves)
                moves.append(moves[q].copy())
                length.append(length[last] + 1)
                link.append(link[q])
                count.append(0)
                p = last
                while p != -1 and moves[p].get(w) == q:
                    moves[p][w] = cur
                    p = link[p]
                link[q] = cur
            count[cur] += 1
            last = cur
            prefix.append(cur)
            continue
        cur = len(moves)
        moves.append({})
        length.append(length[last] + 1)
        link.append(0)
        count.append(1)
        p = last
        while p != -1 and w not in moves[p]:
            moves[p][w] = cur
            p = link[p]
        if p != -1:
            q = moves[p][w]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                clone = len(moves)
                moves.append(moves[q].copy())
                length.append(length[p] + 1)
                link.append(link[q])
                count.append(0)
                while p != -1 and moves[p].get(w) == q:
                    moves[p][w] = clone
                    p = link[p]
                link[q] = link[cur] = clone
        last = cur
        prefix.append(cur)
    order = sorted(range(1, len(moves)), key=length.__getitem__)
    for s in reversed(order):
        count[link[s]] += count[s]
    longest = [0] * len(moves)
    for s in order:
        longest[s] = length[s] if count[s] >= 2 else longest[link[s]]
    return [longest[s] for s in prefix]


def _weight(token: str) -> int:
    """What a token weighs in a repeated substring."""
    if len(token) == 1:
        return 1 if _HAN.match(token) else 2
    return 4 if len(token) >= LONG_WORD or token[0] == "\0" else 2


def _symbol(token: str) -> str:
    """The form in which a token is compared: case folded; links and hash tags, prices, article numbers as one symbol each."""
    if token.isalpha() or token.isdigit() or len(token) == 1:
        return token.casefold()
    return "\0price" if _PRICED.fullmatch(token) else "\0code" if _CODE.fullmatch(token) else "\0link"


def _tokens(line: str, symbols: bool) -> tuple[list[str], list[int]]:
    """The tokens of a line in the form in which they are compared, and their sizes."""
    found = _SYMBOL.findall(line) if symbols else _WORD.findall(line.casefold())
    return [_symbol(t) for t in found] if symbols else found, list(map(len, found))


def _codes(tokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The number of each token's form, and the weight of each form."""
    found = pa.array(tokens, pa.large_string()).dictionary_encode()
    weight = np.fromiter(map(_weight, found.dictionary.to_pylist()), np.int64, len(found.dictionary))
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), weight


def _covered(codes: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Whether each token is covered by a repeated maximal substring of enough weight."""
    at = np.arange(len(codes))
    first = at - np.array(repeated_lengths(codes.tolist()), np.int64) + 1
    total = np.concatenate(([0], np.cumsum(weight[codes])))
    first = np.where(total[1:] - total[first] >= LEAST_WEIGHT, first, at + 1)
    return np.minimum.accumulate(first[::-1])[::-1] <= at


def covered(text: str) -> list[tuple[int, int]]:
    """Stretches of ``text`` covered by repeated maximal substrings, in whole tokens."""
    found = list(_SYMBOL.finditer(text))
    return [m.span() for m, inside in zip(found, _covered(*_codes([_symbol(m[0]) for m in found]))) if inside]


def _units(line: str) -> Iterator[tuple[str, ...]]:
    """The words of a line by sentence; sentences of a few words go with the next."""
    unit: list[str] = []
    for part in _STOP.split(line):
        unit += _TOKEN.findall(part.casefold())
        if len(unit) >= UNIT_WORDS or unit and (sum(map(len, _HAN.findall(" ".join(unit)))) >= CLAUSE_DENSE or len(unit) >= 3 and _DENSE.search(unit[-1])):
            yield tuple(unit)
            unit = []
    if unit:
        yield tuple(unit)


def unordered(lines: list[str]) -> list[float]:
    """For each line the share of its pairs of near words that stand in both orders in the units of all lines.

    Equal units count once.
    """
    units: dict[tuple[str, ...], int] = {}
    parts = [[units.setdefault(u, len(units)) for u in _units(line)] for line in lines]
    code: dict[str, int] = {}
    words = np.array([code.setdefault(w, len(code)) for u in units for w in u], np.int64)
    of = np.repeat(np.arange(len(units)), [len(u) for u in units])
    pairs, owner = [words[:0]], [of[:0]]
    for d in range(1, NEAR + 1):
        same = of[:-d] == of[d:]
        pairs.append((words[:-d] * len(code) + words[d:])[same])
        owner.append(of[:-d][same])
    kinds, at, n = np.unique(np.concatenate(pairs), return_inverse=True, return_counts=True)
    turned = kinds % max(1, len(code)) * len(code) + kinds // max(1, len(code))
    there = np.minimum(np.searchsorted(kinds, turned), max(0, len(kinds) - 1))
    back = np.where(kinds[there] == turned, n[there], 0) if len(kinds) else n
    either = np.minimum(n, back) >= EITHER * (n + back)
    units_of = np.concatenate(owner)
    loose = np.bincount(units_of, either[at], len(units))
    every = np.bincount(units_of, minlength=len(units))
    return [float(loose[p].sum() / max(1, every[p].sum())) if p else 0.0 for p in parts]


def _visible(s: str) -> int:
    return len(s) - s.count(" ") - s.count("\t") - s.count("\r")


def line_kinds(text: str) -> list[tuple[int, int, str]]:
    """(start, visible characters, kind) of each line: ``clause``, ``list`` (contents, references, nothing to judge),
    ``link`` (also lines of hash tags and menus), ``price``, ``items`` (several short phrases), ``run`` (long, without an end) or ``short``."""
    out, at = [], 0
    for line in text.split("\n"):
        size = _visible(line)
        if size:
            out.append((at, size, _kind(line, size)))
        at += len(line) + 1
    return out


def _kind(line: str, size: int) -> str:
    words, ends = line.count(" ") + 1, len(_ENDS.findall(line))
    sentences = ends * 25 >= words
    linked = "://" in line or "www." in line or "/" in line or _DOTTED.search(line) is not None and _LINK.search(line) is not None
    if sentences and ends and not linked and "#" not in line:
        return "clause"
    links = _LINK.findall(line) if linked else []
    joined = sum(map(len, links))
    plain = _LINK.sub(" ; ", line) if links else line
    if line.rstrip()[-1:].isdigit() and _CONTENTS.search(line):
        return "list"
    phrases = [p for p in _SPLIT.split(plain) if p.strip()]
    if _REFERENCE.match(plain) and len(phrases) < 8 and not _PRICE.search(line):
        return "list"
    if not ends and words <= 16 and _PRICE.search(line):
        return "price"
    clause = sum(len(p) - p.count(" ") for p in phrases if len(p.split()) >= CLAUSE_WORDS or len(_DENSE.findall(p)) >= CLAUSE_DENSE)
    if joined < 0.5 * size and (clause >= 0.5 * (size - joined) or sentences and ends):
        return "clause" if ends or words < RUN_WORDS or _DENSE.search(line) else "run"
    if links or line.count("#") >= HASH_TAGS or "«" not in line and line.count(" » ") >= MENU_MARKS:
        return "link"
    return "items" if len(phrases) >= 4 else "clause" if ends else "short"


class _Page(NamedTuple):
    """A page cut into lines and tokens."""

    text: str
    cuts: list[int]
    visible: list[int]
    kinds: list[str]
    counts: list[int]
    tokens: list[str]
    sizes: list[int]


def _page(text: str) -> _Page:
    lines = line_kinds(text)
    cuts = [*(start for start, _, _ in lines), len(text)]
    tokens: list[str] = []
    sizes: list[int] = []
    counts = []
    for a, b, (_, _, kind) in zip(cuts, cuts[1:], lines):
        forms, lengths = _tokens(text[a:b], kind != "clause")
        tokens += forms
        sizes += lengths
        counts.append(len(forms))
    return _Page(text, cuts, [n for _, n, _ in lines], [k for _, _, k in lines], counts, tokens, sizes)


def _by_line(values: np.ndarray, counts: list[int]) -> np.ndarray:
    """Sums of token values by line."""
    return np.diff(np.concatenate(([0], np.cumsum(values)))[np.cumsum([0, *counts])])


def _wanted(kinds: list[str], sizes: np.ndarray, counts: list[int]) -> np.ndarray:
    """Covered characters from which each line is made of repetitions."""
    return np.array([np.inf if k == "list" else LISTED if k in ("link", "price") else REPEATED for k in kinds]) * np.maximum(1, _by_line(sizes, counts))


def _may_be_spam(pages: list[_Page]) -> np.ndarray:
    """Whether the lines of each page that a bound of the coverage lets pass hold more than half of it.

    A repeated substring of enough weight holds a pair of tokens that stands twice in the page, or a heavy token that
    does: all other tokens are not covered. All pages of a batch are counted at once.
    """
    codes, weight = _codes(list(chain.from_iterable(p.tokens for p in pages)))
    of, forms = np.repeat(np.arange(len(pages)), [len(p.tokens) for p in pages]), max(1, len(weight))
    _, at, n = np.unique(of * forms + codes, return_inverse=True, return_counts=True)
    out = (n[at] > 1) & (weight[codes] >= LEAST_WEIGHT)
    _, at, n = np.unique((of[:-1] * forms + codes[:-1]) * forms + codes[1:], return_inverse=True, return_counts=True)
    pair = (n[at] > 1) & (of[:-1] == of[1:])
    out[:-1] |= pair
    out[1:] |= pair
    counts, kinds = list(chain.from_iterable(p.counts for p in pages)), list(chain.from_iterable(p.kinds for p in pages))
    sizes, visible = np.fromiter(chain.from_iterable(p.sizes for p in pages), np.int64), np.fromiter(chain.from_iterable(p.visible for p in pages), np.int64)
    passed = visible * (_by_line(sizes * out, counts) >= _wanted(kinds, sizes, counts))
    lines = [len(p.kinds) for p in pages]
    return _by_line(passed, lines) > SPAM * _by_line(visible, lines)


def _judged(page: _Page, always: bool) -> tuple[int, int, int]:
    """(visible characters, spam characters, covered characters) of a page."""
    sizes, visible = np.array(page.sizes, np.int64), np.array(page.visible)
    prose = np.array([k == "clause" for k in page.kinds])
    size, loose = int(visible.sum()), np.ones(len(prose), bool)
    if prose.any():
        loose[prose] = np.array(unordered([page.text[a:b] for a, b, k in zip(page.cuts, page.cuts[1:], prose) if k])) >= UNORDERED
    if not always and visible[loose].sum() <= SPAM * size:
        return size, 0, 0
    inside = _by_line(sizes * _covered(*_codes(page.tokens)), page.counts)
    return size, int(visible[loose & (inside >= _wanted(page.kinds, sizes, page.counts))].sum()), int(inside.sum())


def score(text: str | None, always: bool = False) -> tuple[int, int, int]:
    """(visible characters, spam characters, covered characters) of a page. Without ``always`` the order of words is
    looked at and the automaton built only where they can decide whether the page is spam."""
    if not text or not text.strip():
        return 0, 0, 0
    page = _page(text)
    if not always and not _may_be_spam([page])[0]:
        return sum(page.visible), 0, 0
    return _judged(page, always)


def _spam(texts: list[str | None]) -> list[bool]:
    """Whether each text is spam."""
    out, pages, held = [False] * len(texts), {}, 0
    for n, text in enumerate(texts):
        if text and text.strip():
            pages[n] = _page(text)
            held += len(text)
        if pages and (held >= BATCH_CHARS or n == len(texts) - 1):
            for (k, page), may in zip(pages.items(), _may_be_spam(list(pages.values()))):
                if may:
                    size, spam, _ = _judged(page, False)
                    out[k] = spam > SPAM * size
            pages, held = {}, 0
    return out


def page_scores(documents: DataFrame) -> DataFrame:
    """``doc_id, n_chars, spam_chars, covered_chars`` of every page, blanks not counted."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [score(t, True) for t in batch.column("text").to_pylist()]
            cols = [pa.array([r[k] for r in rows], pa.int64()) for k in range(3)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *cols], names=["doc_id", "n_chars", "spam_chars", "covered_chars"])

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, n_chars long, spam_chars long, covered_chars long")


def spam_pages(documents: DataFrame) -> DataFrame:
    """``doc_id`` of the pages more than half of whose characters stand in spam lines."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.select(["doc_id"]).filter(pa.array(_spam(batch.column("text").to_pylist()), pa.bool_()))

    kind = dict(documents.dtypes)["doc_id"]
    return documents.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}")
