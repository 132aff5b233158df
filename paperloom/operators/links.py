"""Cross-links: anchors, citation and mention resolution, spatial and interval joins, injection.

Joins between links and blocks are equi joins on paper and page (a page band is exploded
into equal keys) with the geometric or interval condition on top; no pair of unrelated
pages ever meets.
"""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import bibliography as B
from paperloom.functions import text as T
from paperloom.functions.latex import skeleton

# Tolerances of neighbouring pieces, in points.
LINE_TOLERANCE, MAX_GAP, MAX_OVERLAP = 2.5, 10.0, 6.0


def anchor(kind: Column, content: Column, caption: Column) -> Column:
    """Anchor of a row: ``ref-12``, ``fig-3``, ``tab-2``, ``eq-A2``, ``sec-…``; null if it has none."""
    fig = F.nullif(F.regexp_extract(caption, r"(?i)^\s*(?:Figure|Fig\.?)\s*(\d+(?:\.\d+)*)", 1), F.lit(""))
    tag = F.nullif(F.regexp_extract(content, r"\\tag\*?\s*\{([^{}]*)\}", 1), F.lit(""))
    return (
        F.when(kind == "heading", F.concat(F.lit("sec-"), F.nullif(T.anchor_slug(content), F.lit(""))))
        .when(kind == "reference", F.concat(F.lit("ref-"), B.entry_number(content)))
        .when(kind == "image", F.concat(F.lit("fig-"), fig))
        .when(kind == "table", F.concat(F.lit("tab-"), T.table_number(caption)))
        .when(kind == "equation", F.concat(F.lit("eq-"), F.trim(tag)))
    )


def anchors(rows: DataFrame) -> DataFrame:
    """(paper_id, anchor, seq): the first row of each anchor."""
    a = rows.select("paper_id", "seq", anchor(F.col("kind"), F.col("content"), F.col("caption")).alias("anchor"))
    return a.where(F.col("anchor").isNotNull()).groupBy("paper_id", "anchor").agg(F.min("seq").alias("seq"))


def mentions(rows: DataFrame, ranges: bool = False) -> DataFrame:
    """(paper_id, seq, sub, category, number): what paragraphs cite: references, figures, tables, equations.

    With ``ranges`` the ends of ``[1-3]`` count as cited too.
    """
    p = rows.where(F.col("kind") == "paragraph").select("paper_id", "seq", "sub", "content")
    sign = "[,;–-]" if ranges else "[,;]"
    bracket = F.flatten(F.transform(F.regexp_extract_all("content", F.lit(rf"\[(\d{{1,4}}(?:\s*{sign}\s*\d{{1,4}})*)\]"), 1), lambda s: F.split(s, rf"\s*{sign}\s*")))
    of = lambda p_: F.regexp_extract_all("content", F.lit(p_), 1)
    def tagged(category: str, numbers: Column) -> Column:
        return F.transform(numbers, lambda n: F.struct(F.lit(category).alias("category"), n.alias("number")))

    found = F.flatten(F.array(*[
        tagged(c, v)
        for c, v in (("ref", bracket), ("fig", of(r"(?:Figure|Fig\.)\s*(\d+)")), ("tab", of(r"Table\s*(\d+)")), ("eq", of(r"Eq\.\s*\((\d+)\)")))
    ]))
    return p.select("paper_id", "seq", "sub", F.explode(F.array_distinct(found)).alias("m")).select("paper_id", "seq", "sub", "m.category", "m.number")


def resolve(mentioned: DataFrame, targets: DataFrame) -> DataFrame:
    """(…, target_seq): mentions joined with the target of their category and number, if exactly one exists."""
    one = targets.groupBy("paper_id", "category", "number").agg(F.count("*").alias("c"), F.min("seq").alias("target_seq")).where(F.col("c") == 1)
    return mentioned.join(one.drop("c"), ["paper_id", "category", "number"], "left")


def targets_of(rows: DataFrame) -> DataFrame:
    """(paper_id, category, number, seq) of every row that can be linked to."""
    a = rows.select("paper_id", "seq", anchor(F.col("kind"), F.col("content"), F.col("caption")).alias("a")).where(~F.col("a").startswith("sec-"))
    return a.select("paper_id", F.substring_index("a", "-", 1).alias("category"), F.regexp_replace("a", "^[a-z]+-", "").alias("number"), "seq")


def link_stats(resolved: DataFrame) -> DataFrame:
    """(category, ok, dropped)."""
    return resolved.groupBy("category").agg(
        F.count("target_seq").alias("ok"), F.sum(F.col("target_seq").isNull().cast("bigint")).alias("dropped")
    )


def unique_citations(rows: DataFrame) -> DataFrame:
    """(paper_id, page_idx, number, seq): bracketed citations that stand once on their page and the page before."""
    p = rows.where(F.col("kind").isin("paragraph", "footnote", "heading"))
    nums = F.regexp_extract_all("content", F.lit(r"\[(\d{1,4})\]"), 1)
    c = p.select("paper_id", "page_idx", "seq", F.explode(nums).alias("number"))
    seen = c.select("paper_id", F.explode(F.array("page_idx", F.col("page_idx") + 1)).alias("page_idx"), "number", "seq")
    one = seen.groupBy("paper_id", "page_idx", "number").agg(F.count("*").alias("n"), F.min("seq").alias("seq")).where(F.col("n") == 1)
    return one.select("paper_id", "page_idx", "number", "seq")


def covering_blocks(points: DataFrame, blocks: DataFrame) -> DataFrame:
    """(link_id, block_id): the block whose box holds a point, else the nearest of the page by (dy, dx).

    points: link_id, paper_id, page_idx, x, y.
    """
    at = lambda i: F.get("bbox", F.lit(i))
    b = blocks.where(F.size("bbox") == 4).select("paper_id", "page_idx", "block_id", at(0).alias("x0"), at(1).alias("y0"), at(2).alias("x1"), at(3).alias("y1"))
    j = points.join(b, ["paper_id", "page_idx"])
    dy = F.greatest(F.lit(0.0), F.col("y0") - F.col("y"), F.col("y") - F.col("y1"))
    dx = F.greatest(F.lit(0.0), F.col("x0") - F.col("x"), F.col("x") - F.col("x1"))
    best = j.groupBy("link_id").agg(F.min(F.struct(dy.alias("dy"), dx.alias("dx"), "block_id")).alias("b"))
    return best.select("link_id", "b.block_id", (F.col("b.dy") + F.col("b.dx") == 0).alias("inside"))


def span_in_rectangle(chars: DataFrame, links: DataFrame) -> DataFrame:
    """(link_id, c0, c1): the span of the characters whose centres lie in a link's rectangle."""
    cx, cy = (F.col("cx0") + F.col("cx1")) / 2, (F.col("cy0") + F.col("cy1")) / 2
    c = chars.select("paper_id", "page", "ci", F.col("x0").alias("cx0"), F.col("y0").alias("cy0"), F.col("x1").alias("cx1"), F.col("y1").alias("cy1"))
    j = c.join(links, ["paper_id", "page"]).where(cx.between(F.col("x0"), F.col("x1")) & cy.between(F.col("y0"), F.col("y1")))
    return j.groupBy("link_id").agg(F.min("ci").alias("c0"), (F.max("ci") + 1).alias("c1"))


def spans_within(inner: DataFrame, segments: DataFrame) -> DataFrame:
    """Interval containment: each span with the equal segment of its page that holds it."""
    j = inner.join(segments, ["paper_id", "page"])
    return j.where((F.col("s0") <= F.col("c0")) & (F.col("c1") <= F.col("s1")))


def overlap(a0: Column, a1: Column, b0: Column, b1: Column) -> Column:
    return F.greatest(F.lit(0), F.least(a1, b1) - F.greatest(a0, b0))


def citation_clusters(parts: DataFrame) -> DataFrame:
    """(paper_id, page, cluster, text, n): neighbouring pieces of one line whose joined text is a citation."""
    w = Window.partitionBy("paper_id", "page").orderBy((F.col("y0") + F.col("y1")) / 2, "x0")
    gap = F.col("x0") - F.lag("x1").over(w)
    apart = F.coalesce(
        (F.abs((F.col("y0") + F.col("y1")) / 2 - F.lag((F.col("y0") + F.col("y1")) / 2).over(w)) > LINE_TOLERANCE) | (gap > MAX_GAP) | (gap < -MAX_OVERLAP),
        F.lit(True),
    )
    c = parts.withColumn("cluster", F.sum(apart.cast("int")).over(w))
    g = c.groupBy("paper_id", "page", "cluster").agg(F.sort_array(F.collect_list(F.struct("x0", "text"))).alias("p"))
    text = F.array_join(F.transform("p", lambda s: s["text"]), "")
    return g.select("paper_id", "page", "cluster", text.alias("text"), F.size("p").alias("n")).where(
        F.col("text").rlike(r"^\[\d+(?:\s*[,–—-]\s*\d+)*\]$")
    )


def equal_segments(page_text: str, block_text: str, least: int = 4) -> list[tuple[int, int, int]]:
    """(page offset, block offset, size) of the equal stretches of two folded texts, in original offsets."""
    a, at_a = skeleton(page_text)
    b, at_b = skeleton(block_text)
    m = difflib.SequenceMatcher(None, a, b, autojunk=False)
    return [(at_a[x], at_b[y], n) for x, y, n in m.get_matching_blocks() if n >= least]


def alignments(pages: DataFrame, blocks: DataFrame) -> DataFrame:
    """(block_id, p0, b0, size): equal segments between a block and its page's text (equi join on paper and page)."""

    @F.pandas_udf("array<struct<p0:int,b0:int,size:int>>")
    def run(page: pd.Series, block: pd.Series) -> pd.Series:
        return pd.Series([[{"p0": p, "b0": q, "size": n} for p, q, n in equal_segments(x or "", y or "")] for x, y in zip(page, block)])

    j = pages.join(blocks.select("paper_id", F.col("page_idx").alias("page"), "block_id", "text"), ["paper_id", "page"])
    return j.select("block_id", F.explode(run("page_text", "text")).alias("s")).select("block_id", "s.p0", "s.b0", "s.size")


def inject(text: str, links: list[tuple[int, int, str]]) -> str:
    """Markdown links set into a text, from the back so that offsets hold; spans in math are left alone."""
    math = [m.span() for m in re.finditer(r"\$\$.+?\$\$|\$[^$\n]+?\$", text, re.S)]
    for a, b, target in sorted(set(links), reverse=True):
        if 0 <= a < b <= len(text) and not any(x < b and a < y for x, y in math):
            text = f"{text[:a]}[{text[a:b]}]({target}){text[b:]}"
    return text


MATH = r"(?s)\$\$.+?\$\$|\$[^$\n]+?\$"
_LINKABLE = r"\[\d{1,4}(?:\s*[,;–-]\s*\d{1,4})*\]|(?:Figure|Fig\.)\s*\d+|Table\s*\d+|Eq\.\s*\(\d+\)"


def with_links(content: Column, known: Column) -> Column:
    """``content`` with links to the anchors in ``known`` (``ref-1``, ``fig-2``, ...); formulas stay as they are.

    A bracket of several numbers is linked if all of them are known.
    """
    pieces, math = F.split(content, MATH), F.regexp_extract_all(content, F.lit(MATH), 0)

    def linked(c: Column) -> Column:
        numbers = F.regexp_extract_all(c, F.lit(r"(\d+)"), 1)
        signs = F.regexp_extract_all(c, F.lit(r"\d\s*([,;–-]\s*)(?=\d)"), 1)
        parts = F.transform(numbers, lambda n: F.concat(F.lit("[["), n, F.lit("]](#ref-"), n, F.lit(")")))
        bracket = F.array_join(F.zip_with(parts, signs, lambda x, y: F.concat(x, F.coalesce(y, F.lit("")))), "")
        kind = F.when(c.startswith("Fig"), "fig").when(c.startswith("Tab"), "tab").when(c.startswith("Eq"), "eq")
        anchor_ = F.concat(kind, F.lit("-"), F.get(numbers, F.lit(0)))
        refs = F.transform(numbers, lambda n: F.concat(F.lit("ref-"), n))
        return (
            F.when(c.startswith("[") & (F.size(F.array_except(refs, known)) == 0), bracket)
            .when(F.array_contains(known, anchor_), F.concat(F.lit("["), c, F.lit("](#"), anchor_, F.lit(")")))
            .otherwise(c)
        )

    def piece(t: Column) -> Column:
        found, rest = F.regexp_extract_all(t, F.lit(_LINKABLE), 0), F.split(t, _LINKABLE)
        return F.array_join(F.zip_with(rest, F.transform(found, linked), lambda x, y: F.concat(F.coalesce(x, F.lit("")), F.coalesce(y, F.lit("")))), "")

    return F.array_join(F.zip_with(F.transform(pieces, piece), math, lambda x, y: F.concat(F.coalesce(x, F.lit("")), F.coalesce(y, F.lit("")))), "")


def link_rows(rows: DataFrame) -> DataFrame:
    """``rows`` whose paragraphs link to the rows they cite, where exactly one row has the anchor; cited rows begin with it."""
    hits = resolve(mentions(rows, ranges=True), targets_of(rows)).where(F.col("target_seq").isNotNull())
    hits = hits.select("paper_id", "seq", "sub", F.concat_ws("-", "category", "number").alias("anchor"), "target_seq")
    known = hits.groupBy("paper_id", "seq", "sub").agg(F.collect_set("anchor").alias("known"))
    marks = hits.groupBy("paper_id", F.col("target_seq").alias("seq")).agg(F.min("anchor").alias("mark"))
    out = rows.join(known, ["paper_id", "seq", "sub"], "left").join(marks, ["paper_id", "seq"], "left")
    text = F.when(F.col("known").isNotNull() & (F.col("kind") == "paragraph"), with_links(F.col("content"), F.col("known"))).otherwise(F.col("content"))
    first = F.col("mark").isNotNull() & (F.col("kind") != "page_anchor") & (F.col("sub") <= 1)
    return out.withColumn("content", text).withColumn("mark", F.when(first, F.col("mark"))).drop("known")


def linked_citations(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, sub, linked): paragraphs with their bracketed citations linked to ``#ref-N``, math untouched."""
    plain = rows.where((F.col("kind") == "paragraph") & F.col("content").rlike(r"\[\d{1,4}\]") & ~F.col("content").contains("$"))
    return plain.select("paper_id", "seq", "sub", F.regexp_replace("content", r"\[(\d{1,4})\]", "[[$1]](#ref-$1)").alias("linked"))
