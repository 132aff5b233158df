"""Page furniture: running headers and footers, page numbers, prose typed as either.

Evidence. Running headers and footers of a paper are known from its typed blocks: their text
without page number; the number of a page from the offset between printed number and page
index that most of the paper's numbers share. Running lines are gathered per bucket of
``PAGE_BUCKET`` pages and hold for the neighbouring buckets; lines that stand in more than
two buckets hold for the whole paper. Both are aggregates, joined back by paper and bucket.

Decision. An averaged perceptron weighs page position, form, the kind of block and the
matches with the evidence. It scores every candidate: a block that is a bare number, a
running line found in a block with what stands before it, and a typed header, footer or page
number. Its sign alone decides. It is trained on a bounded sample of blocks (``TRAIN_BLOCKS``):
typed furniture as it stands, furniture put into text, against text, numbers that are not
those of their page, numbers in brackets and running lines that a reference cites.

Defined cases: a block without paper_id or page has no furniture evidence; a paper without
numbers accepts any bare page number form; lines of any length are compared whole.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.scan_words import Perceptron
from paperloom.session import in_arrow

TRAIN_BLOCKS = 6_000
#: Pages that share their evidence of running lines, with the pages of the neighbouring buckets.
PAGE_BUCKET = 64
#: Least letters and digits of a running line.
MIN_LINE = 8
FURNITURE = ("header", "footer", "page_number")
LISTED = ("ref_text", "list", "page_footnote")
_PAGE = re.compile(r"\s*(?:[-–—·•|]\s*)?(?:(?:p|pp|S|Page|Seite|Pág|Página|第)\.?\s*)?(\d{1,5})\s*(?:页)?(?:\s*[-–—·•|])?\s*", re.I)
#: Most signs, blanks aside, of a text that is nothing but a page number.
_PAGE_SIGNS = 20
_LINE_NO = re.compile(r"^\s*\d{1,5}\s{2,}|\s{2,}\d{1,5}\s*$")


def plain(text: str) -> str:
    """Letters and digits only, case ignored: what two prints of a running line share."""
    return re.sub(r"[\W_]+", "", text).casefold()


def places(text: str) -> tuple[str, list[int]]:
    """``plain`` with each sign's place in the text."""
    out, at = [], []
    for k, c in enumerate(text):
        if c.isalnum():
            for x in c.casefold():
                out.append(x)
                at.append(k)
    return "".join(out), at


def page_number(text: str | None) -> int | None:
    m = _PAGE.fullmatch(text or "")
    return int(m.group(1)) if m else None


def sentences_in(text: str) -> int:
    """Sentence ends that no abbreviation explains."""
    return len(re.findall(r"(?:[^\W\d_A-Z][^\W_]{2,}|[\])\d])[.!?](?=\s+[^\W\d_a-z]|\s*$)|[。！？]", text))


def is_prose(text: str) -> bool:
    cjk = len(re.findall(r"[一-鿿]", text))
    return sentences_in(text) >= 2 and (len(text) >= 90 or cjk >= 25)


def running_line(text: str | None) -> str | None:
    """The shared part of a typed header or footer, without its page number."""
    t = (text or "").strip()
    if not t or is_prose(t) or page_number(t) is not None:
        return None
    line = plain(_LINE_NO.sub("", t))
    return line if len(line) >= MIN_LINE and not line.isdigit() else None


def bucket() -> Column:
    return F.floor(F.coalesce("page_idx", F.lit(0)) / PAGE_BUCKET).cast("int")


_STATS = pa.schema([("paper_id", pa.string()), ("bucket", pa.int32()), ("line", pa.string()), ("offset", pa.int64())])


def evidence_rows(blocks: DataFrame) -> DataFrame:
    """(paper_id, bucket, line, offset): what typed furniture and bare numbers say of running lines and page numbers."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = []
            for p, at, kind, page, text in zip(*(c.to_pylist() for c in b.columns)):
                if kind in ("header", "footer") and (line := running_line(text)):
                    rows.append((p, at, line, None))
                n = page_number(text)
                if n is not None and page is not None and not re.match(r"\s*[(\[]", text):
                    rows.append((p, at, None, n - page))
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_STATS)], schema=_STATS)

    short = F.col("text").rlike(rf"^(\s*\S){{1,{_PAGE_SIGNS}}}\s*$")
    may = F.col("paper_id").isNotNull() & (F.coalesce(F.col("type"), F.lit("")).isin("header", "footer") | short)
    return blocks.where(may).select("paper_id", bucket().alias("bucket"), "type", "page_idx", "text").transform(
        in_arrow, batches, "paper_id string, bucket int, line string, offset bigint"
    )


def paper_evidence(blocks: DataFrame, rows: DataFrame) -> DataFrame:
    """(paper_id, bucket, lines, offset): what a page's surroundings tell of furniture; ``rows``: the evidence rows."""
    lines = rows.where(F.col("line").isNotNull()).groupBy("paper_id", "line").agg(F.collect_set("bucket").alias("at"))
    seen = blocks.where(F.col("paper_id").isNotNull()).select("paper_id", bucket().alias("bucket")).distinct()
    near = lines.select("paper_id", "line", F.explode(F.array_distinct(F.flatten(F.transform("at", lambda k: F.array(k - 1, k, k + 1))))).alias("bucket"))
    wide = lines.where(F.size("at") > 2).select("paper_id", "line").join(seen, "paper_id").select("paper_id", "line", "bucket")
    own = near.unionByName(wide).groupBy("paper_id", "bucket").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    counted = rows.where(F.col("offset").isNotNull()).groupBy("paper_id", "offset").agg(F.count("*").alias("n"))
    best = counted.groupBy("paper_id").agg(F.max(F.struct("n", (-F.col("offset")).alias("o"))).alias("b"))
    offsets = best.select("paper_id", (-F.col("b.o")).alias("offset"))
    return seen.join(own, ["paper_id", "bucket"], "left").join(offsets, "paper_id", "left")


def _position(top: float | None, first: bool) -> list[str]:
    y = -1 if top is None else top
    return [f"top={0 <= y < 120}", f"low={y > 850}", f"first={first}"]


def number_features(kind: str, page: int | None, text: str, top: float | None, offset: int | None, first: bool) -> list[str]:
    """Features of a block that is a bare number."""
    n = page_number(text)
    fits = "unknown" if offset is None or page is None else n is not None and n - page == offset
    paren = text.lstrip()[:1] in ("(", "[")
    return ["number", f"fits={fits}", f"paren={paren}", *(f"number {x}" for x in _position(top, first))]


def line_features(kind: str, text: str, whole: bool, before: str, top: float | None, first: bool) -> list[str]:
    """Features of a running line in a block; ``before``: the last sign before it, '' at the start of a line."""
    listed = kind in LISTED
    return ["line", f"whole={whole}", f"listed={listed}/{before == ','}/{whole}", f"before={before if not before.isalnum() else 'a'}/{listed}", *(f"line {x}" for x in _position(top, first))]


def typed_features(kind: str, text: str, lines: list, top: float | None, first: bool) -> list[str]:
    """Features of a block typed header, footer or page number."""
    n, shared = sentences_in(text), plain(_LINE_NO.sub("", text)) in lines
    cjk = len(re.findall(r"[一-鿿]", text))
    long = len(text) >= 90 or cjk >= 25
    return ["typed", f"sentences={min(n, 2)}/{long}", f"known={shared}", f"kind={kind}/{min(n, 2)}", f"bare={page_number(text) is not None}"]


def running(text: str, lines: list, p: str | None = None) -> Iterator[tuple[int, int, bool, str]]:
    """(start, end, whole, sign before) of the running lines that a block holds; ``p``: its plain form if known."""
    if not lines:
        return
    p = plain(text) if p is None else p
    held = [line for line in lines if line in p]
    if not held:
        return
    p, at = places(text)
    for line in held:
        k = p.find(line)
        if k < 0:
            continue
        start, end = at[k], at[k + len(line) - 1] + 1
        head = text[:start]
        before = "" if not head.strip() or head.rstrip(" \t").endswith("\n") else head.rstrip()[-1]
        yield start, end, len(p) <= len(line) + 6, "," if head.rstrip().endswith(",") else before


def train(rows: list) -> Perceptron:
    """The furniture perceptron from a sample of blocks with their evidence."""
    rng, data = random.Random(17), []
    texts = [r["text"] for r in rows if r["type"] == "text" and r["text"] and is_prose(r["text"])]
    for r in rows:
        text, kind, lines, offset, page = r["text"] or "", r["type"] or "", r["lines"] or [], r["offset"], r["page_idx"]
        first, top = r["seq"] in (0, 1), r["top"]
        if not text:
            continue
        if kind in FURNITURE:
            data.append((typed_features(kind, text, lines, top, first), not is_prose(text)))
            if texts:  # prose that a wrong type makes furniture
                data.append((typed_features(kind, rng.choice(texts), lines, top, first), False))
            n = page_number(text)
            if n is not None and kind == "page_number":
                data.append((number_features("text", page, text, top, offset, first), True))
                data.append((number_features("text", page, text, top, None, first), True))
                data.append((number_features("text", page, f"({n})", top, offset, first), False))
                if offset is not None and page is not None:
                    other = page + offset + rng.choice((-1, 1)) * rng.randint(1, 60)
                    data.append((number_features("text", page, str(max(0, other)), top, offset, first), other == n))
            elif (line := running_line(text)) and line in lines:
                data.append((line_features("text", text, True, "", top, first), True))
                for into in ("text", rng.choice(LISTED)):
                    data.append((line_features(into, text, False, rng.choice(("", ".", "a", ")")), top, first), True))
                data.append((line_features("text", text, False, ",", top, first), True))
                data.append((line_features(rng.choice(LISTED), text, False, ",", top, first), False))
                data.append((line_features(rng.choice(LISTED), text, True, ",", top, first), True))
    if not data:
        return Perceptron({"number": 1.0, "line": 1.0, "typed": 1.0, "fits=False": -2.0, "paren=True": -2.0, "sentences=2/True": -2.0, "listed=True/True/False": -2.0})
    return Perceptron().fit(data)


def furniture_kinds(kind: str, page: int | None, text: str, top: float | None, lines: list, offset: int | None, first: bool, furniture: Perceptron, p: str | None = None) -> list[str]:
    """What a block is or holds of page furniture, and prose typed as such: for the report and the repair alike."""
    out = []
    if kind in FURNITURE:
        if furniture.score(typed_features(kind, text, lines, top, first)) <= 0:
            out.append("body")
        if kind != "page_number":
            return out
    elif page_number(text) is not None and furniture.score(number_features(kind, page, text, top, offset, first)) > 0:
        out.append("page_no")
    if next(lines_held(kind, text, top, lines, first, furniture, p), None):
        out.append("running")
    return out


def lines_held(kind: str, text: str, top: float | None, lines: list, first: bool, furniture: Perceptron, p: str | None = None) -> Iterator[tuple[int, int, bool]]:
    """(start, end, whole) of the running lines that are furniture."""
    for start, end, whole, before in running(text, lines, p):
        if furniture.score(line_features(kind, text, whole, before, top, first)) > 0:
            yield start, end, whole
