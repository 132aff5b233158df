"""Several values packed in one field: one row per value with its position.

Two grammars share one PEG kernel, and in both an item is an ordered choice of quoted,
bracketed and bare. A quoted or bracketed item must be followed by a separator or the end;
otherwise the parser backtracks to its beginning and takes it as bare text, with the flag
``quote`` where a quote is malformed.

``labelled_list``  label, then values between commas, semicolons (also wide ones),
                   bars, slashes with blanks, bullets, tabs or line ends
``reference_list`` whole references one after another; a separator only counts
                   where the text before it is a whole reference (it is dated, by a
                   year or by words such as *in press*, and has come to its own end)
                   and the text after it is dated too, so that separators inside a
                   reference do not split it

Both are candidates of a JVM-side filter first (``rlike``), so that the Python
worker sees only texts that can hold a list.

Defined cases: null, empty or blank text and texts with fewer than two values give
no rows; empty pieces are skipped and take no position; a text is handled whole
whatever its length; equal rows give equal output rows; further columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions.peg import Parser, ahead, apply, check, choice, end, many, maybe, seq, some, term, unless
from paperloom.session import in_arrow

# Names of keyword, subject-term and abbreviation lists.
LIST_LABELS = (
    "keywords?", "key[ -]words?(?: and phrases)?", "index(?:ing)? terms", "subject (?:headings?|terms?|index)", "subjects?",
    "descriptors", "abbreviations?", "list of abbreviations", "abbreviations used", "acronyms",
    "schlagw[oö]rter?", "schlagworte", "schlüsselw[oö]rter?", "stichw[oö]rter?", "stichworte", "abkürzungen", "abkürzungsverzeichnis",
    "mots?[ -]cl(?:és|efs|és|e)", "termes d['’]indexation", "abréviations", "descripteurs",
    "palabras?[ -]claves?", "términos (?:clave|de indexación)", "descriptores", "abreviaturas", "siglas",
    "palavras?[ -]chaves?", "termos de indexação", "descritores", "abreviações", "abreviaturas",
    "关键词", "关键字", "关键詞", "主题词", "缩略语", "缩写", "缩略词", "缩写词",
)
_LABEL = "(?:" + "|".join(LIST_LABELS) + ")"
#: A label with its sign, or in capitals without one.
LABEL_RE = (
    rf"\s*[*_#]*\s*(?:(?i:{_LABEL})[*_]*\s*(?:[:：=—–]|-(?=\s)|\.(?=\s))[*_]*"
    r"|(?:KEYWORDS?|KEY WORDS|INDEX TERMS|SUBJECT (?:HEADINGS|TERMS)|ABBREVIATIONS)[*_]*(?=\s))"
)

_SEP = r"(?:\s*(?:[,，;；、|·•‣▪¦¶\n\t\r]|\|\|)\s*|\s+[/／]\s+|\s+[–—]\s+)"
_QUOTES = {'"': '"', "“": "”", "”": "”", "„": "“”", "'": "'", "‘": "’", "«": "»", "「": "」", "『": "』", "＂": "＂"}


def _quoted(sep: str) -> Parser:
    """A quoted item whose quote ends before a separator or the text's end."""
    after = ahead(choice(term(sep), seq(term(r"\s*[.。;；]?\s*"), end)))
    forms = []
    for q, closers in _QUOTES.items():
        c = re.escape(closers) if len(closers) == 1 else f"[{closers}]"
        body = rf"(?:[^{closers}]|{c}{c}|(?<=\w){c}(?=\w))*" if closers in ("'", "’") else rf"(?:[^{closers}]|{c}{c})*"
        undouble = (lambda s, k=closers[0]: s.replace(k + k, k)) if len(closers) == 1 else (lambda s: s)
        forms.append(apply(seq(term(re.escape(q)), term(body), term(c), after), lambda v, f=undouble: (f(v[1]), None)))
    return choice(*forms)


_PAIRS = ("()", "[]", "{}", "（）")


@lru_cache(maxsize=2)
def _closers(text: str) -> dict[int, int]:
    """Place of the closing bracket of each balanced bracket; none spans lines or crosses another."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    waiting: Counter = Counter()
    for k, c in enumerate(text):
        if c == "\n":
            stack.clear()
            waiting.clear()
        elif c in _CLOSER_OF:
            stack.append((_CLOSER_OF[c], k))
            waiting[_CLOSER_OF[c]] += 1
        elif waiting[c]:
            while True:  # openings of another kind within stay open
                kind, place = stack.pop()
                waiting[kind] -= 1
                if kind == c:
                    out[place] = k
                    break
    return out


_CLOSER_OF = {a: b for a, b in _PAIRS}


def _GROUP(text: str, at: int):
    """A balanced bracket with whatever it holds, brackets within it included."""
    if at < len(text) and text[at] in _CLOSER_OF and (end_ := _closers(text).get(at)) is not None:
        return text[at : end_ + 1], end_ + 1
    return None


def _bracketed(sep: str) -> Parser:
    """An item that is one bracket, up to a separator or the text's end; it keeps its brackets."""
    after = ahead(choice(term(sep), seq(term(r"\s*[.。;；]?\s*"), end)))
    return apply(seq(_GROUP, after), lambda v: (v[0], None))


def _bare(sep: str) -> Parser:
    """Bare text up to a separator; brackets shield the separators within them."""
    piece = choice(_GROUP, apply(seq(unless(term(sep)), term(r"(?s).")), lambda v: v[1]))
    return apply(many(piece), lambda v: ("".join(v), "quote" if re.match(r"\s*[\"“„«]", "".join(v)) else None))


def _list_grammar() -> Parser:
    item = choice(_quoted(_SEP), _bracketed(_SEP), _bare(_SEP))
    ws = term(r"\s*")
    more = apply(seq(term(_SEP), ws, item), lambda v: v[2])
    return apply(seq(term(LABEL_RE), ws, item, many(more)), lambda v: [v[2], *v[3]])


_LIST = _list_grammar()
_CLOSING = re.compile(r"[\s.。;；,，、]+$")
_ITEM_MARK = re.compile(r"^\s*(?:\(?(?:\d{1,3}|[a-z])\)|\[\d{1,4}\]|\d{1,3}\.(?=\s))\s*(?=\S)")


def labelled_list(text: str | None) -> list[tuple[int, str, str | None]]:
    """(pos, value, flag) of a text that opens with a list's label."""
    r = _LIST(text or "", 0)
    if r is None:
        return []
    items = list(r[0])
    out = []
    for k, (v, flag) in enumerate(items):
        v = _ITEM_MARK.sub("", v.strip())
        if k == len(items) - 1 or not any(x[0].strip(" .。") for x in items[k + 1 :]):
            v = _CLOSING.sub("", v)
        if v.strip():
            out.append((v.strip(), flag))
    return [(n, v, f) for n, (v, f) in enumerate(out, 1)] if len(out) > 1 else []


# How a reference without a year says so.
_UNDATED = r"n\.\s?d\.|[Ii]n press|[Ff]orthcoming|[Aa]ccepted for publication|[Ii]m Druck|[Ss]ous presse|[Ee]n prensa|[Nn]o prelo|待刊|出版中"
DATE = rf"(?<!\d)(?:1[89]|20)\d\d(?!\d)|(?<!\w)(?:{_UNDATED})"
_DATE = re.compile(DATE)
_MARKS = (
    ("bracket", re.compile(r"\[(\d{1,5})\]\s*")),
    ("round", re.compile(r"\((\d{1,5})\)\s*")),
    ("letter", re.compile(r"\(?([a-z])\)\s*")),
    ("dot", re.compile(r"(\d{1,5})[.)](?=\s)\s*")),
    ("bullet", re.compile(r"([•·▪‣*–-])\s+")),
)
#: Where one reference may stop: a sign of its own, or blanks before the next mark.
_STOP = re.compile(r"\s*(?:[;；]|\|\|?|¶|•|·|\t|\r?\n|\s/\s)\s*|\s+(?=\[\d{1,5}\]\s|\(?[a-z]\)\s|\(\d{1,5}\)\s|\d{1,5}\.\s)|\s{2,}")
#: A reference has come to its end: a number or date with a full stop, or a closing quote.
_DONE = re.compile(rf"(?:(?:\d|{_UNDATED})[\])]?\s*[.。]|n\.\s?d\.[\])]?|[.。][”\"’'»]|\d[”\"’'»]\.?)$")
#: Most signs, blanks aside, that _DONE looks at: the longest date in words with its marks.
_DONE_SIGNS = 32
_LINK = re.compile(r"doi|arxiv|https?", re.I)


def _mark(text: str, at: int) -> tuple[str, str, int] | None:
    for kind, rx in _MARKS:
        if m := rx.match(text, at):
            return kind, m.group(1), m.end()
    return None


def _follows(a: tuple[str, str, int] | None, b: tuple[str, str, int] | None) -> bool:
    """Mark ``b`` is the successor of mark ``a``."""
    if a is None or b is None or a[0] != b[0]:
        return False
    if a[1].isdigit():
        return int(b[1]) == int(a[1]) + 1
    return a[0] == "bullet" or ord(b[1]) == ord(a[1]) + 1


def _dated(value: str) -> bool:
    return _DATE.search(value) is not None


_BREAK = term(r"\s*[,;|]?\s*")
_QUOTED_ENTRY = apply(
    seq(term(r'\s*"'), term(r'(?:[^"]|"")*'), term('"'), ahead(choice(seq(_BREAK, term('"(?!")')), seq(term(r"\s*"), end)))),
    lambda v: (v[1].replace('""', '"'), None),
)
#: Quoted references, quotes inside doubled; every one is dated.
_QUOTED_LIST = apply(seq(check(_QUOTED_ENTRY, lambda v: _dated(v[0])), some(apply(seq(_BREAK, check(_QUOTED_ENTRY, lambda v: _dated(v[0]))), lambda v: v[1])), term(r"\s*"), end), lambda v: [v[0], *v[1]])
_LABELLED = maybe(term(r"\s*(?i:references?|bibliography|literatur|see also)\s*:\s*"))


class _Places:
    """Where a text has dates, links and blanks, found once, so that each stop is judged in logarithmic time."""

    def __init__(self, text: str):
        self.text = text
        self.dates = [m.span() for m in _DATE.finditer(text)]
        self.starts = [a for a, _ in self.dates]
        self.links = [m.start() for m in _LINK.finditer(text)]
        self.blanks = [m.start() for m in re.finditer(r"\s", text)]

    def dated(self, begin: int, stop: int) -> bool:
        k = bisect_left(self.starts, begin)
        return k < len(self.dates) and self.dates[k][1] <= stop

    def dated_after(self, at: int) -> bool:
        return bool(self.dates) and self.starts[-1] >= at

    def ended(self, begin: int, stop: int) -> bool:
        """The text from ``begin`` has come to an end at ``stop``: a sign of its end, or its last token is a link."""
        text = self.text
        while stop > begin and text[stop - 1].isspace():
            stop -= 1
        k = bisect_left(self.blanks, stop) - 1
        token = max(begin, self.blanks[k] + 1 if k >= 0 else begin)
        n = bisect_left(self.links, token)
        if n < len(self.links) and self.links[n] < stop:
            return True
        near, signs = stop, 0
        while near > begin and signs < _DONE_SIGNS:  # blanks may stand between, they do not count
            near -= 1
            signs += not text[near].isspace()
        return _DONE.search(text, near, stop) is not None


def _bare_entry(at_places: _Places) -> Parser:
    """A reference up to the first stop whose both sides are whole, or up to the text's end."""

    def run(text: str, at: int):
        if at >= len(text):
            return None
        mark, scan = _mark(text, at), at
        while m := _STOP.search(text, scan):
            stop, go = m.span()
            nxt = _mark(text, go)
            sign = m.group(0).strip() or "\n" in m.group(0) or "\t" in m.group(0)
            if at_places.dated(at, stop) and at_places.dated_after(go) and at_places.ended(at, stop):
                if sign or _follows(mark, nxt) or (go - stop > 1 and nxt is None):
                    return text[at:stop], go
            scan = go if go > stop else go + 1
        return text[at:], len(text)

    return run


def _unmarked(piece: str) -> tuple[str, str | None]:
    piece = piece.strip()
    if k := _mark(piece, 0):
        piece = piece[k[2] :].strip()
    return piece.rstrip(";；|¶• \t\n"), "quote" if piece.startswith('"') else None


def _references(text: str) -> Parser:
    """The grammar of packed references over one text."""
    bracketed = apply(check(seq(_GROUP, choice(apply(_STOP_TERM, lambda v: v), seq(term(r"\s*"), end))), lambda v: _dated(v[0]) and len(v[0]) > 12), lambda v: (v[0], None))
    bare = apply(_bare_entry(_Places(text)), _unmarked)
    return apply(seq(_LABELLED, choice(_QUOTED_LIST, many(choice(bracketed, bare)))), lambda v: v[1])


_STOP_TERM = term(_STOP.pattern)


def reference_list(raw: str | None) -> list[tuple[int, str, str | None]]:
    """(pos, value, flag) of a raw entry that holds two or more whole references."""
    if not raw or not raw.strip():
        return []
    text = raw.strip()
    r = _references(text)(text, 0)
    found = [(v, f) for v, f in (r[0] if r else ()) if v]
    return [(n, v, f) for n, (v, f) in enumerate(found, 1)] if len(found) > 1 else []


_GRAMMARS = {"list": labelled_list, "references": reference_list}
_OUT = pa.schema([("row_id", pa.int64()), ("pos", pa.int32()), ("value", pa.string()), ("flag", pa.string())])


def split_packed(df: DataFrame, id_col: str, text_col: str, grammar: str, prefilter: Column | None = None) -> DataFrame:
    """Rows (row_id, pos, value, flag) of the packed values of ``text_col``."""
    parse = _GRAMMARS[grammar]

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            rows = [(i, *v) for i, t in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for v in parse(t)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_OUT), _OUT)], schema=_OUT
            )

    narrow = df.select(F.col(id_col).cast("bigint").alias("row_id"), F.col(text_col).alias("text"))
    keep = F.col("text").isNotNull() if prefilter is None else prefilter
    return narrow.where(keep).transform(in_arrow, batches, "row_id bigint, pos int, value string, flag string")


def labelled_lists(df: DataFrame, id_col: str = "block_id", text_col: str = "text") -> DataFrame:
    """Keyword, subject-term and abbreviation lists of ``text_col``."""
    opens = "(?iu)^[\\s*_#]*(" + "|".join(x.replace("(?:", "(") for x in LIST_LABELS) + ")"
    return split_packed(df, id_col, text_col, "list", F.col("text").rlike(opens))


def packed_references(df: DataFrame, id_col: str = "ref_id", text_col: str = "raw") -> DataFrame:
    """Raw entries that hold several references; two dates are the least a pair can have."""
    date = rf"((1[89]|20)\d\d|{_UNDATED})"
    return split_packed(df, id_col, text_col, "references", F.col("text").rlike(f"(?s){date}.+{date}"))
