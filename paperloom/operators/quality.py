"""Quality findings as one long table (paper_id, rule, severity, detail)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.session import in_arrow

# Thresholds of degenerate loops.
MIN_LINE, MIN_SIGNATURE, MIN_SPAN, MIN_REPEATS, MIN_PERIOD, MAX_PERIOD = 200, 500, 300, 10, 4, 50


def loop_in(sig: str) -> tuple[int, int, int] | None:
    """(start, period, repeats) of the first degenerate loop of a signature, of those with one start the shortest period.

    A stretch has period p where every sign equals the one p places on; the lengths of these
    stretches come from one pass a period.
    """
    if len(sig) < MIN_SIGNATURE:
        return None
    a = np.frombuffer(sig.encode("utf-32-le"), np.uint32)
    best = None
    for p in range(MIN_PERIOD, MAX_PERIOD + 1):
        least = max(MIN_REPEATS, -(-MIN_SPAN // p))
        breaks = np.flatnonzero(a[:-p] != a[p:])
        starts = np.append(0, breaks + 1)
        lengths = np.append(breaks, len(a) - p) - starts
        hit = np.flatnonzero(lengths >= (least - 1) * p)
        if len(hit) and (best is None or starts[hit[0]] < best[0]):
            k = hit[0]
            best = int(starts[k]), p, int(lengths[k] // p) + 1
    return best


def degenerate_lines(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, line_no, period, repeats): long lines whose signature repeats one unit; short ones stay in the JVM."""
    schema = pa.schema([("id", pa.int64()), ("line_no", pa.int32()), ("period", pa.int32()), ("repeats", pa.int32())])

    def walk(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = [(i, n, f[1], f[2]) for i, n, sig in zip(*(c.to_pylist() for c in b.columns)) if (f := loop_in(sig))]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)

    long = df.where(F.length(text_col) >= MIN_SIGNATURE)
    lines = long.select(F.col(id_col).cast("bigint").alias("id"), F.posexplode(F.split(F.col(text_col), "\n")).alias("p", "line"))
    sig = lines.where(F.length("line") >= MIN_LINE).select("id", (F.col("p") + 1).alias("line_no"), T.signature(F.col("line")).alias("sig"))
    return sig.where(F.length("sig") >= MIN_SIGNATURE).transform(in_arrow, walk, "id bigint, line_no int, period int, repeats int")


def page_completeness(pages: DataFrame, ratio: float = 0.6) -> DataFrame:
    """(paper_id, markers, pages): papers of three pages or more whose page marks reach no more than ``ratio``."""
    low = (F.col("pages") >= 3) & (F.col("markers") > 0) & (F.col("markers") <= F.floor(F.col("pages") * ratio))
    return pages.where(low).select("paper_id", "markers", "pages")


_FIG = r"(?m)^!\[(?:Figure|Fig\.?)\s*(\d+)"


def missing_numbers(actual: Column, mentioned: Column) -> Column:
    """Numbers between the least and the greatest known that are not present."""
    known = F.array_union(actual, mentioned)
    return F.when(F.size(known) > 0, F.array_except(F.sequence(F.array_min(known), F.array_max(known)), actual)).otherwise(F.array().cast("array<int>"))


_ONE = r"(?:Fig(?:ure)?\.?|Table)\s*\d+"
#: A mention with those that *or* and *and* tie to it.
_TIED = rf"{_ONE}(?:[^\n]{{0,38}}?\b(?:or|and)\s+{_ONE})*"
#: Mentions that belong to another work: after *whose* or its number, or followed by *of* or *in* and its number.
OUTER_BEFORE = rf"(?:\b[Ww]hose\s+|\bRefs?\.?\s*\[+\d+(?:[,–-]\s*\d+)*\]*(?:\]\([^)]*\))?\s*[,;:]?\s*){_TIED}"
OUTER_AFTER = rf"\b{_ONE}\s*(?:of|in)\s+(?:[Rr]efs?\b|\[+\d)(?:[^\n]{{0,38}}?\b(?:or|and)\s+{_ONE})*"


def mentions(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, figures, tables) of every text with a mention: the numbers that it mentions as its own work's.

    Mentions of other works are cut out first, with those that *or* and *and* tie to them.
    """
    some = df.where(F.col(text_col).rlike(r"\b(Fig|Table)"))
    own = F.regexp_replace(F.regexp_replace(F.col(text_col), OUTER_BEFORE, " "), OUTER_AFTER, " ")
    number = lambda p: F.array_sort(F.array_distinct(F.transform(F.regexp_extract_all(own, F.lit(p), 1), lambda n: n.cast("int"))))
    return some.select(F.col(id_col).alias("id"), number(r"\bFig(?:ure)?\.?\s*(\d{1,9})").alias("figures"), number(r"\bTable\s*(\d{1,9})").alias("tables"))


def references_misplaced(rows: DataFrame) -> DataFrame:
    """(paper_id, rule): reference rows before any paragraph, or headings after the list that are no fixed section."""
    p = rows.groupBy("paper_id").agg(
        F.min(F.when(F.col("kind") == "reference", F.col("seq"))).alias("ref"),
        F.min(F.when(F.col("kind") == "paragraph", F.col("seq"))).alias("para"),
        F.max(F.when((F.col("kind") == "heading") & ~T.heading_norm(F.col("content")).isin(*T.FIXED_SECTIONS), F.col("seq"))).alias("head"),
    )
    rule = F.when(F.col("ref") < F.col("para"), "references before text").when(F.col("head") > F.col("ref"), "heading after references")
    return p.select("paper_id", rule.alias("rule")).where(F.col("rule").isNotNull())


def packed_reference_paragraphs(refs: DataFrame) -> DataFrame:
    """(ref_id, marks): raw entries in which two or more numbered entries stand."""
    marks = F.regexp_count("raw", F.lit(r"\[\d{1,4}\]\s+[A-Z]"))
    return refs.select("ref_id", marks.alias("marks")).where(F.col("marks") >= 2)


def empty_reference_sections(blocks: DataFrame) -> DataFrame:
    """(paper_id): papers with a reference heading and nothing after it."""
    from paperloom.operators.blocks import reference_starts

    starts = reference_starts(blocks)
    after = blocks.join(starts, "paper_id").where((F.col("seq") > F.col("ref_seq")) & ~F.col("type").isin(*T.NOISE_TYPES) & (F.trim(F.coalesce("text", F.lit(""))) != ""))
    return starts.join(after, "paper_id", "left_anti").select("paper_id")


def equation_faults(blocks: DataFrame) -> DataFrame:
    """(block_id, fault): equations with uneven braces, environments, delimiters, or an empty fraction."""
    count = lambda p: F.regexp_count("text", F.lit(p))
    faults = F.array(
        F.when(count(r"\{") - count(r"\\\{") != count(r"\}") - count(r"\\\}"), "braces"),
        F.when(count(r"\\begin\{") != count(r"\\end\{"), "environments"),
        F.when(count(r"\\left\b") != count(r"\\right\b"), "delimiters"),
        F.when(F.col("text").rlike(r"\\(d|t|c)?frac\s*(\\end|\\begin|$)"), "fraction"),
    )
    eq = blocks.where((F.col("type") == "equation") & F.col("text").isNotNull())
    return eq.select("block_id", F.explode(F.array_compact(faults)).alias("fault"))


def findings(**tables: DataFrame) -> DataFrame:
    """Union of named finding tables as (rule, subject, detail)."""
    out = None
    for rule, t in tables.items():
        key, *rest = t.columns
        detail = F.concat_ws(" ", *[F.col(c).cast("string") for c in rest]) if rest else F.lit("")
        row = t.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("subject"), detail.alias("detail"))
        out = row if out is None else out.unionByName(row)
    return out


def strip_front_matter(col: Column) -> Column:
    """A document without its leading YAML record."""
    return F.regexp_replace(col, r"(?s)^---\n.*?\n---\n", "")


def front_matter_fields(col: Column) -> Column:
    """The ``key: value`` lines of a document's leading record as a map; of repeated keys the first counts."""
    head = F.regexp_extract(col, r"(?s)^---\n(.*?)\n---\n", 1)
    keys = F.regexp_extract_all(head, F.lit(r"(?m)^([\w-]+):\s*(.*)$"), 1)
    values = F.regexp_extract_all(head, F.lit(r"(?m)^([\w-]+):\s*(.*)$"), 2)
    pairs = F.arrays_zip(keys.alias("k"), values.alias("v"))
    once = F.filter(pairs, lambda x, i: F.array_position(keys, x["k"]) == i + 1)
    return F.map_from_entries(F.transform(once, lambda x: F.struct(x["k"], F.btrim(x["v"], F.lit('" ')))))


def describe(line_no: Column, period: Column, repeats: Column) -> Column:
    """Message of a degenerate loop."""
    return F.format_string("line %d: a unit of %d signs stands %d times in a row", line_no, period, repeats)


def block_texts(blocks: DataFrame) -> DataFrame:
    """(paper_id, seq, text): every text, table body and caption of a block list, one row each."""
    none = F.array().cast("array<string>")
    parts = F.concat(F.array("text", "table_body"), *[F.coalesce(c, none) for c in ("image_caption", "chart_caption", "table_caption")])
    return blocks.select("paper_id", "seq", F.explode(F.array_compact(parts)).alias("text")).where(F.col("text") != "")
