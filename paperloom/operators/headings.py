"""Headings: classes, levels, numbering, gaps; paragraph fragments and legends."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.session import in_arrow

_ROMAN_LEAD = r"^([IVX]+)\.\s+\S"
_DOTTED_LEAD = r"^(\d+(?:\.\d+)*)\.?\s+\S"
_LETTER_LEAD = r"^[A-Z]\.\s+\S"
_PAREN_LEAD = r"^[（(]\d+[）)]\.?\s+\S"


#: Places of a paper that are looked at together; a window over rows never holds more.
SEQ_BUCKET = 1_000


def beside(rows: DataFrame, col: str, before: str, after: str) -> DataFrame:
    """``rows`` with the value of ``col`` in the row before and after, in reading order of the paper.

    Windows hold SEQ_BUCKET places; what stands at the borders of the buckets comes from a
    window over one row a bucket, so that a paper with any share of the rows is spread.
    """
    b = rows.withColumn("_bucket", F.floor(F.col("seq") / SEQ_BUCKET))
    own = Window.partitionBy("paper_id", "_bucket").orderBy("seq", "sub")
    ends = b.groupBy("paper_id", "_bucket").agg(
        F.min(F.struct("seq", "sub", F.col(col).alias("v"))).alias("lo"), F.max(F.struct("seq", "sub", F.col(col).alias("v"))).alias("hi")
    )
    over = Window.partitionBy("paper_id").orderBy("_bucket")
    borders = ends.select(F.col("paper_id").alias("_p"), F.col("_bucket").alias("_b"), F.lag("hi.v").over(over).alias("_before"), F.lead("lo.v").over(over).alias("_after"))
    joined = b.join(borders, b["paper_id"].eqNullSafe(borders["_p"]) & (b["_bucket"] == borders["_b"]))
    first, last = F.row_number().over(own) == 1, F.lead(F.lit(1)).over(own).isNull()
    out = joined.withColumn(before, F.when(first, F.col("_before")).otherwise(F.lag(col).over(own)))
    return out.withColumn(after, F.when(last, F.col("_after")).otherwise(F.lead(col).over(own))).drop("_bucket", "_p", "_b", "_before", "_after")


def classify(rows: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper_id, seq, content, class): noise, title again, caption, subtitle or section."""
    looked = beside(rows.where(F.col("kind") != "page_anchor").select("paper_id", "seq", "sub", "kind", "content"), "kind", "prev_kind", "next_kind")
    heads = looked.where(F.col("kind") == "heading").join(papers.select("paper_id", "title"), "paper_id", "left")
    h = T.heading_norm(F.col("content"))
    nth = F.row_number().over(Window.partitionBy("paper_id").orderBy("seq"))
    again = F.coalesce(h == T.heading_norm(F.col("title")), F.lit(False)) & (nth > 1)
    figure = F.col("content").rlike(r"(?i)^(fig(ure)?\.?|table|scheme)\s*\d")
    kind = (
        F.when(T.heading_noise(F.col("content")), "noise")
        .when(again, "title again")
        .when(figure, "caption")
        .when((nth == 2) & ~T.looks_like_section(F.col("content")) & (F.col("prev_kind") == "heading"), "subtitle")
        .otherwise("section")
    )
    return heads.select("paper_id", "seq", "content", kind.alias("class"))


def levels(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, content, level): level by numbering, fixed names, body anchors, else by the last depth."""
    heads = rows.where(F.col("kind") == "heading").select("paper_id", "seq", "content", F.col("level").alias("given"))
    w = Window.partitionBy("paper_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    h = T.heading_norm(F.col("content"))
    dotted = F.nullif(F.regexp_extract("content", _DOTTED_LEAD, 1), F.lit(""))
    depth = F.size(F.split(dotted, r"\."))
    numbered = F.when(dotted.isNotNull(), F.least(depth, F.lit(6)))
    anchor = h.isin(*T.BODY_ANCHORS)
    own = (
        F.when(h.isin(*T.FIXED_SECTIONS), 1)
        .when(F.col("content").rlike(_ROMAN_LEAD), 1)
        .when(F.col("content").rlike(_LETTER_LEAD), 2)
        .when(numbered.isNotNull(), numbered)
        .when(anchor, 1)
    )
    step = heads.withColumn("own", own).withColumn("anchored", F.max(anchor.cast("int")).over(w)).withColumn(
        "last_own", F.last("own", ignorenulls=True).over(w)
    )
    nested = F.when(F.col("content").rlike(_PAREN_LEAD), F.least(F.coalesce("last_own", F.lit(1)) + 1, F.lit(6)))
    rest = F.when(F.coalesce("anchored", F.lit(0)) == 1, 2).otherwise(F.greatest(F.lit(1), F.col("given")))
    return step.select("paper_id", "seq", "content", F.coalesce("own", nested, rest).cast("int").alias("level"))


def numbered_papers(leveled: DataFrame) -> DataFrame:
    """(paper_id, numbered): two headings and a fifth of all are numbered, or two are Roman."""
    c = leveled.groupBy("paper_id").agg(
        F.count("*").alias("n"),
        F.sum(T.has_number_prefix(F.col("content")).cast("int")).alias("num"),
        F.sum(F.col("content").rlike(_ROMAN_LEAD).cast("int")).alias("roman"),
    )
    return c.select("paper_id", ((F.col("num") >= F.greatest(F.lit(2), F.ceil(F.col("n") * 0.2))) | (F.col("roman") >= 2)).alias("numbered"))


def add_numbers(leveled: DataFrame) -> DataFrame:
    """(paper_id, seq, number, content): top sections of unnumbered papers get running numbers."""
    fixed = T.heading_norm(F.col("content")).isin(*T.FIXED_SECTIONS)
    w = Window.partitionBy("paper_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    counts = (F.col("level") == 1) & ~fixed & ~F.col("numbered")
    ready = leveled.join(numbered_papers(leveled), "paper_id")
    n = F.when(counts, F.sum(counts.cast("int")).over(w))
    return ready.select("paper_id", "seq", n.alias("number"), F.when(counts, F.concat(n.cast("string"), F.lit(". "), F.col("content"))).otherwise(F.col("content")).alias("content"))


def hierarchical_numbers(leveled: DataFrame, depth: int = 6) -> DataFrame:
    """(paper_id, seq, number): dotted numbers of all levels.

    The counter of a level runs within the counters above it and starts again with them;
    a level that was skipped counts as 1.
    """
    out, within = leveled.select("paper_id", "seq", "level"), ["paper_id"]
    for k in range(1, depth + 1):
        w = Window.partitionBy(*within).orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
        out = out.withColumn(f"n{k}", F.sum((F.col("level") == k).cast("int")).over(w))
        within = [*within, f"n{k}"]
    parts = F.array(*[F.greatest(F.col(f"n{k}"), F.lit(1)).cast("string") for k in range(1, depth + 1)])
    return out.select("paper_id", "seq", F.array_join(F.slice(parts, F.lit(1), F.least("level", F.lit(depth))), ".").alias("number"))


def roman_gaps(leveled: DataFrame) -> DataFrame:
    """(paper_id, missing): Roman section numbers that a paper with three or more skips."""
    r = leveled.select("paper_id", T.roman_to_int(F.regexp_extract("content", _ROMAN_LEAD, 1)).alias("n")).where(F.col("n").isNotNull())
    seen = r.groupBy("paper_id").agg(F.collect_set("n").alias("have"), F.max("n").alias("hi"), F.min("n").alias("lo"), F.count("*").alias("c"))
    gaps = seen.where(F.col("c") >= 3).select("paper_id", F.array_except(F.sequence("lo", "hi"), "have").alias("gaps"))
    return gaps.where(F.size("gaps").between(1, 3)).select("paper_id", F.explode("gaps").alias("missing"))


def rescue_headings(leveled: DataFrame, noise: DataFrame) -> DataFrame:
    """(paper_id, missing, content, page_idx): dropped noise rows that carry a missing Roman number."""
    cand = noise.select(
        "paper_id", "page_idx", F.col("text").alias("content"), T.roman_to_int(F.regexp_extract("text", _ROMAN_LEAD, 1)).alias("missing")
    ).where(F.col("missing").isNotNull())
    best = cand.groupBy("paper_id", "missing").agg(F.min(F.struct("page_idx", "content")).alias("b"))
    return best.join(roman_gaps(leveled), ["paper_id", "missing"]).select("paper_id", "missing", "b.content", "b.page_idx")


_TERMINAL = re.compile(r"[.!?。！？:：;；][\"”’')\]]*$")
_SIGNAL = re.compile(r"(?:,|-|\b(?:of|the|and|or|to|in|for|with|by|a|an|that|which|from|on|as|is|are|was|were))$")


def ends_terminal(text: Column) -> Column:
    return F.rtrim(text).rlike(r"[.!?。！？:：;；][\"”’')\]]*$")


def is_byline(text: Column) -> Column:
    return (F.length(text) < 300) & ((F.regexp_count(text, F.lit(r"\$\^\{")) >= 2) | text.rlike(r"^By\s"))


_MERGED = pa.schema([("paper_id", pa.string()), ("seq", pa.int64()), ("sub", pa.int32()), ("parts", pa.int32()), ("content", pa.string())])


def runs_on(text: str, after: str, short: int, long: int) -> bool:
    """The paragraph ``after`` continues ``text``: no terminal end, and short or with a sign of going on."""
    end = text.rstrip()
    if not end or _TERMINAL.search(end) or (end[-1].isdigit() and after[:1].isdigit()):
        return False
    return len(text) < short or (len(text) < long and bool(_SIGNAL.search(end) or after[:1].islower()))


def merge_fragments(rows: DataFrame, short: int = 200, long: int = 4000) -> DataFrame:
    """(paper_id, seq, sub, parts, content): paragraphs of a page whose text runs on in the next one.

    Whether the next piece joins depends on the text merged so far, so the fold is
    sequential: rows are partitioned and sorted by page, and each task folds its pages in
    one stream that holds no more than the paragraph in hand.
    """

    def fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        page, held = None, None
        for b in it:
            out: list[list] = []
            for paper, page_idx, seq, sub, kind, content in zip(*(c.to_pylist() for c in b.columns)):
                text = content or ""
                same = page == (paper, page_idx)
                if held and same and kind == "paragraph" and runs_on(held[4], text, short, long):
                    held[3] += 1
                    held[4] = f"{held[4].rstrip()} {text.lstrip()}"
                    continue
                if held:
                    out.append(held)
                page, held = (paper, page_idx), [paper, seq, sub, 1, text] if kind == "paragraph" else None
            yield _merged_batch(out)
        yield _merged_batch([held] if held else [])

    pages = rows.where(F.col("kind") != "page_anchor").select("paper_id", "page_idx", "seq", "sub", "kind", "content")
    ordered = pages.repartition("paper_id", "page_idx").sortWithinPartitions("paper_id", "page_idx", "seq", "sub")
    return ordered.transform(in_arrow, fold, "paper_id string, seq bigint, sub int, parts int, content string")


def _merged_batch(rows: list[list]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_MERGED)], schema=_MERGED)


def split_legends(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, number, content): paragraphs that open with a figure's legend."""
    p = rows.where(F.col("kind") == "paragraph")
    n = F.regexp_extract("content", r"^(?:Fig(?:ure)?\.?|FIG\.?)\s*(\d+(?:\.\d+)*)\s*[.:]\s", 1)
    return p.where((n != "") & (F.length("content") > 40)).select("paper_id", "seq", n.alias("number"), "content")


def stray_paragraphs(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, new_seq): prose between numbered references, to be moved before their heading."""
    ref = rows.where((F.col("kind") == "heading") & T.is_reference_heading(F.col("content"))).groupBy("paper_id").agg(F.min("seq").alias("ref_seq"))
    num = F.col("content").rlike(r"^\s*(\[\d{1,4}\]|\d{1,4}[.)]\s)")
    late = rows.where(F.col("kind") != "page_anchor").join(ref, "paper_id").where(F.col("seq") > F.col("ref_seq"))
    around = beside(late.withColumn("is_num", num), "is_num", "before", "after")
    words = F.size(F.split(F.trim("content"), r"\s+"))
    stray = ~F.col("is_num") & F.col("after") & (F.coalesce("before", F.lit(True))) & (F.length("content") >= 100) & (words >= 10)
    return around.where(stray).select("paper_id", "seq", (F.col("ref_seq") - 0.5).alias("new_seq"))
