"""HTML tables: rows, cells, columns, continuation over pages, prose in cells."""

from __future__ import annotations

import html as _html
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import text as T


def rows_of(body: Column) -> Column:
    """All ``<tr>`` elements of a table."""
    return F.regexp_extract_all(body, F.lit(r"(?is)<tr[^>]*>.*?</tr>"), 0)


def cells_of(row: Column) -> Column:
    """Cells of a row: text without tags and column span."""
    cells = F.regexp_extract_all(row, F.lit(r"(?is)<t[dh][^>]*>.*?</t[dh]>"), 0)
    return F.transform(
        cells,
        lambda c: F.struct(
            T.strip_tags(c).alias("text"),
            F.coalesce(F.nullif(F.regexp_extract(c, r"(?i)^<t[dh][^>]*colspan\s*=\s*[\"']?(\d+)", 1), F.lit("")).try_cast("int"), F.lit(1)).alias("span"),
        ),
    )


def column_count(body: Column) -> Column:
    """Widest row of a table by its spans; 0 without rows."""
    widths = F.transform(rows_of(body), lambda r: F.aggregate(cells_of(r), F.lit(0), lambda acc, c: acc + c["span"]))
    return F.coalesce(F.array_max(widths), F.lit(0))


def header_cells(body: Column) -> Column:
    """Different cell texts of the first row."""
    return F.array_distinct(F.transform(cells_of(F.coalesce(F.try_element_at(rows_of(body), F.lit(1)), F.lit(""))), lambda c: c["text"]))


def shape(blocks: DataFrame) -> DataFrame:
    """(block_id, n_rows, n_cols, n_cells) of every HTML table."""
    body = F.col("table_body")
    rows = rows_of(body)
    return blocks.where((F.col("type") == "table") & body.rlike(r"(?i)<tr")).select(
        "block_id", F.size(rows).alias("n_rows"), column_count(body).alias("n_cols"),
        F.aggregate(rows, F.lit(0), lambda acc, r: acc + F.size(cells_of(r))).alias("n_cells"),
    )


def cell_rows(blocks: DataFrame) -> DataFrame:
    """(block_id, row_no, col_no, cell, span): one row per cell."""
    r = blocks.where(F.col("type") == "table").select("block_id", F.posexplode(rows_of(F.col("table_body"))).alias("r", "row"))
    return r.select("block_id", (F.col("r") + 1).alias("row_no"), F.posexplode(cells_of(F.col("row"))).alias("c", "cell")).select(
        "block_id", "row_no", (F.col("c") + 1).alias("col_no"), F.col("cell.text").alias("cell"), F.col("cell.span").alias("span")
    )


def continuations(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, group_seq): tables and the table each continues.

    A table continues the one before if it begins on a later page, no prose of its own
    stands between, its caption is missing, says so, or names the same number, and the
    column counts agree where both are known. Prose between two tables is a count over
    the rows between, taken from a running count; the windows run over tables, which are
    few in a paper; prose is counted within each page and over whole pages before it.
    """
    prose = (F.col("kind").isin("paragraph", "heading", "equation", "image", "reference")) & (F.length(F.coalesce("content", F.lit(""))) > 40)
    marked = rows.withColumn("prose", prose.cast("int"))
    on_page = Window.partitionBy("paper_id", "page_idx").orderBy("seq", "sub").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("paper_id").orderBy("page_idx").rowsBetween(Window.unboundedPreceding, -1)
    per_page = marked.groupBy("paper_id", "page_idx").agg(F.sum("prose").alias("n"))
    per_page = per_page.select("paper_id", "page_idx", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("earlier"))
    here = marked.withColumn("here", F.sum("prose").over(on_page)).where(F.col("kind") == "table")
    w = Window.partitionBy("paper_id").orderBy("seq", "sub")
    tables = here.join(per_page, ["paper_id", "page_idx"]).select(
        "paper_id", "seq", "sub", "page_idx", "caption", (F.col("earlier") + F.col("here")).alias("prose"), column_count(F.col("content")).alias("cols")
    )
    prev = lambda c: F.lag(c).over(w)
    num = T.table_number(F.col("caption"))
    said = F.col("caption").rlike(r"(?i)(continued|contd|cont\.|续表|续上表)")
    bare = F.coalesce("caption", F.lit("")) == ""
    goes_on = (
        (F.col("page_idx") > prev("page_idx")) & (F.col("prose") == prev("prose"))
        & (bare | said | num.eqNullSafe(prev_number(w))) & ((F.col("cols") == prev("cols")) | (F.col("cols") == 0) | (prev("cols") == 0))
    )
    started = tables.withColumn("start", F.when(F.coalesce(goes_on, F.lit(False)), None).otherwise(F.col("seq")))
    return started.select("paper_id", "seq", F.last("start", ignorenulls=True).over(w).alias("group_seq"))


def prev_number(w) -> Column:
    return F.lag(T.table_number(F.col("caption"))).over(w)


def merged(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, parts, content): continued tables as one, their repeated header rows dropped."""
    parts = rows.where(F.col("kind") == "table").join(continuations(rows), ["paper_id", "seq"])
    own = F.struct("seq", rows_of(F.col("content")).alias("rows"))
    grouped = parts.groupBy("paper_id", F.col("group_seq").alias("seq")).agg(F.sort_array(F.collect_list(own)).alias("p"))
    head = F.try_element_at(F.col("p")[0]["rows"], F.lit(1))
    tail = F.flatten(F.transform(F.slice("p", 2, 1_000_000), lambda t: F.filter(t["rows"], lambda r: ~(T.strip_tags(r) == T.strip_tags(F.coalesce(head, F.lit("\x00")))))))
    body = F.concat(F.lit("<table>"), F.array_join(F.concat(F.col("p")[0]["rows"], tail), ""), F.lit("</table>"))
    return grouped.select("paper_id", "seq", F.size("p").alias("parts"), body.alias("content"))


def number_tables(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, number): unnumbered tables take the cited numbers that no table has, in order."""
    cited = rows.where(F.col("kind") == "paragraph").select(
        "paper_id", F.explode(F.regexp_extract_all("content", F.lit(r"Table\s*(\d+)"), 1)).alias("n")
    )
    tables = rows.where(F.col("kind") == "table").withColumn("n", T.table_number(F.col("caption")))
    used = tables.where(F.col("n").isNotNull()).select("paper_id", "n")
    pool = cited.select("paper_id", "n").distinct().join(used, ["paper_id", "n"], "left_anti")
    pool = pool.withColumn("rank", F.row_number().over(Window.partitionBy("paper_id").orderBy(F.col("n").cast("int"))))
    free = tables.where(F.col("n").isNull()).select("paper_id", "seq")
    free = free.withColumn("rank", F.row_number().over(Window.partitionBy("paper_id").orderBy("seq")))
    return free.join(pool, ["paper_id", "rank"]).select("paper_id", "seq", F.col("n").cast("int").alias("number"))


_CELL = re.compile(r"<t([dh])([^>]*)>(.*?)</t\1>", re.I | re.S)


def rescue_prose(body: str, least: int = 200) -> list[dict]:
    """Cells of a table that hold whole sentences, as paragraphs; short numbered spans as headings."""
    out = []
    for m in _CELL.finditer(body or ""):
        t = re.sub(r"\s+", " ", _html.unescape(re.sub(r"<[^>]*>", " ", m.group(3)))).strip()
        span = re.search(r"colspan\s*=\s*[\"']?(\d+)", m.group(2), re.I)
        if len(t) >= least and len(re.findall(r"[a-z]{2,}[.;,] [A-Za-z]", t)) >= 2:
            out.append({"kind": "paragraph", "content": t})
        elif span and int(span.group(1)) >= 2 and len(t) <= 80 and re.match(r"\d+(\.\d+)*\.?\s+[A-Z]", t):
            out.append({"kind": "heading", "content": t})
    return out


def rescued_cells(blocks: DataFrame) -> DataFrame:
    """(block_id, pos, kind, content) of the prose inside table cells."""

    @F.pandas_udf("array<struct<kind:string,content:string>>")
    def cells(values: pd.Series) -> pd.Series:
        return values.map(rescue_prose)

    t = blocks.where((F.col("type") == "table") & F.col("table_body").rlike("(?i)<t[dh]"))
    return t.select("block_id", F.posexplode(cells("table_body")).alias("p", "c")).select(
        "block_id", (F.col("p") + 1).alias("pos"), "c.kind", "c.content"
    )
