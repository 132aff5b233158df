"""Figures: proximity runs, split figures, numbers and file names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import text as T

# Limits of figure runs.
MAX_INTERRUPT, MAX_HEIGHT, MAX_AREA = 20, 0.75, 0.9


def proximity_runs(rows: DataFrame) -> DataFrame:
    """(paper_id, page_idx, seq, run): images of one page that belong together.

    Longer rows between two images, or a second real caption, break a run; runs of one
    image are left out. Windows hold one page.
    """
    page = Window.partitionBy("paper_id", "page_idx").orderBy("seq", "sub")
    caption = F.coalesce(F.col("caption").rlike(r"(?i)^\s*(Figure|Fig\.?)\s*\d+(\.\d+)*\s*[.:]"), F.lit(False))
    r = rows.where(F.col("kind") != "page_anchor").withColumn("captioned", caption & (F.col("kind") == "image"))
    wall = (F.col("kind") != "image") & (F.length(F.coalesce("content", F.lit(""))) > MAX_INTERRUPT)
    closes = F.coalesce(F.lag("captioned").over(page), F.lit(False))
    r = r.withColumn("run", F.sum((wall | closes).cast("int")).over(page))
    images = r.where(F.col("kind") == "image").select("paper_id", "page_idx", "seq", "run")
    sized = images.withColumn("n", F.count("*").over(Window.partitionBy("paper_id", "page_idx", "run")))
    return sized.where(F.col("n") >= 2).drop("n")


def union_boxes(runs: DataFrame, boxes: DataFrame, height: float = 1000.0, width: float = 1000.0) -> DataFrame:
    """(paper_id, page_idx, run, n, x0, y0, x1, y1): the box around each run, without runs that fill the page."""
    b = runs.join(boxes.select("paper_id", "seq", "bbox"), ["paper_id", "seq"]).where(F.size("bbox") == 4)
    u = b.groupBy("paper_id", "page_idx", "run").agg(
        F.count("*").alias("n"), F.min(F.get("bbox", F.lit(0))).alias("x0"), F.min(F.get("bbox", F.lit(1))).alias("y0"),
        F.max(F.get("bbox", F.lit(2))).alias("x1"), F.max(F.get("bbox", F.lit(3))).alias("y1"),
    )
    tall = (F.col("y1") - F.col("y0")) > MAX_HEIGHT * height
    large = (F.col("y1") - F.col("y0")) * (F.col("x1") - F.col("x0")) > MAX_AREA * width * height
    return u.where((F.col("n") >= 2) & ~tall & ~large)


def number_figures(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, number, panel): images grouped by the numbered caption that closes each group.

    A group ends with an image that carries a figure number, or where the page gap
    exceeds one; images of a group take its number, in panels a, b, …
    """
    w = Window.partitionBy("paper_id").orderBy("seq")
    images = rows.where(F.col("kind") == "image").withColumn("own", T.figure_number(F.col("caption")))
    gap = F.coalesce(F.col("page_idx") - F.lag("page_idx").over(w) > 1, F.lit(False))
    closed = F.coalesce(F.lag("own").over(w).isNotNull(), F.lit(False))
    g = images.withColumn("grp", F.sum((gap | closed).cast("int")).over(w))
    by = Window.partitionBy("paper_id", "grp")
    g = g.withColumn("number", F.max("own").over(by)).withColumn("k", F.row_number().over(by.orderBy("seq"))).withColumn("n", F.count("*").over(by))
    panel = F.when((F.col("n") > 1) & (F.col("k") <= 26), F.substring(F.lit("abcdefghijklmnopqrstuvwxyz"), F.col("k"), F.lit(1))).otherwise(F.lit(""))
    return g.select("paper_id", "seq", "number", F.when(F.col("number").isNotNull(), panel).alias("panel"))


def figure_names(numbered: DataFrame) -> DataFrame:
    """(paper_id, seq, name): ``fig12-4b``; a name met again gets -2, -3."""
    stem = F.concat(F.lit("fig"), F.replace("number", F.lit("."), F.lit("-")), F.col("panel"))
    nth = F.row_number().over(Window.partitionBy("paper_id", "stem").orderBy("seq"))
    named = numbered.where(F.col("number").isNotNull()).withColumn("stem", stem)
    return named.select("paper_id", "seq", unique_name(F.col("stem"), nth).alias("name"))


def unique_name(stem: Column, nth: Column) -> Column:
    return F.when(nth == 1, stem).otherwise(F.concat(stem, F.lit("-"), nth.cast("string")))


def figure_gaps(rows: DataFrame) -> DataFrame:
    """(paper_id, missing): figure numbers between the first and last that no image has."""
    have = rows.where(F.col("kind") == "image").select("paper_id", T.figure_number(F.col("caption")).try_cast("int").alias("n"))
    seen = have.where(F.col("n").isNotNull()).groupBy("paper_id").agg(F.collect_set("n").alias("have"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    return seen.select("paper_id", F.explode(F.array_except(F.sequence("lo", "hi"), "have")).alias("missing"))
