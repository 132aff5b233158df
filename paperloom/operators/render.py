"""Rendering: Markdown bodies, front matter, reference documents, progress events."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# The span of the whole that each stage takes, in per cent.
STAGE_SPAN = {1: (0, 70), 2: (70, 80), 3: (80, 90), 4: (90, 100)}


def line(kind: Column, content: Column, level: Column, caption: Column, image: Column | None = None, mark: Column | None = None) -> Column:
    """Markdown of one row; ``image``: name of its image file, ``mark``: anchor that stands before it."""
    c = F.coalesce(content, F.lit(""))
    name = F.lit("") if image is None else F.coalesce(image, F.lit(""))
    text = (
        F.when(kind == "heading", F.concat(F.repeat(F.lit("#"), F.greatest(F.lit(1), F.least(level, F.lit(6)))), F.lit(" "), c))
        .when(kind == "page_anchor", F.concat(F.lit("<!-- page: "), c, F.lit(" -->")))
        .when(kind == "image", F.concat(F.lit("!["), F.coalesce(caption, F.lit("")), F.lit("]("), name, F.lit(")")))
        .when(kind == "table", F.concat_ws("\n\n", F.nullif(caption, F.lit("")), c))
        .when(kind == "footnote", F.concat(F.lit("> "), c))
        .otherwise(c)
    )
    return text if mark is None else F.concat(F.when(mark.isNotNull(), F.concat(F.lit('<a id="'), mark, F.lit('"></a>'))).otherwise(F.lit("")), text)


def rendered_lines(rows: DataFrame) -> DataFrame:
    """(paper_id, seq, sub, gap, line): a blank line between rows unless two references follow each other."""
    w = Window.partitionBy("paper_id", "page_idx").orderBy("seq", "sub")
    same = (F.lag("kind").over(w) == "reference") & (F.col("kind") == "reference")
    more = [F.col(c) if c in rows.columns else None for c in ("image", "mark")]
    text = line(F.col("kind"), F.col("content"), F.col("level"), F.col("caption"), *more)
    return rows.select("paper_id", "page_idx", "seq", "sub", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1).alias("gap"), text.alias("line"))


def page_bodies(rows: DataFrame) -> DataFrame:
    """(paper_id, page_idx, body): the Markdown of each page; a page is a bounded group."""
    r = rendered_lines(rows)
    own = F.struct("seq", "sub", F.concat(F.repeat(F.lit("\n"), F.col("gap")), F.col("line")).alias("t"))
    return r.groupBy("paper_id", "page_idx").agg(
        F.ltrim(F.array_join(F.transform(F.sort_array(F.collect_list(own)), lambda x: x["t"]), "\n"), F.lit("\n")).alias("body")
    )


def _quoted(col: Column) -> Column:
    return F.concat(F.lit('"'), F.replace(F.replace(col, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))


def front_matter(papers: DataFrame) -> DataFrame:
    """(paper_id, yaml): the ordered record of a paper; empty fields are left out, the language comes last.

    The abstract is folded. ``type``, ``url``, ``issn``, ``publisher`` and ``arxiv`` are taken where the records have them.
    """
    field = lambda name, col: F.when(F.nullif(F.trim(col), F.lit("")).isNotNull(), F.concat(F.lit(f"{name}: "), _quoted(F.trim(col))))
    authors = F.transform(F.coalesce("author", F.array().cast("array<struct<name:string,affiliation:string>>")), lambda a: F.concat(F.lit("  - "), _quoted(F.coalesce(a["name"], F.lit("")))))
    words = F.array_join(F.transform(F.coalesce("keywords", F.array().cast("array<string>")), _quoted), ", ")
    folded = F.when(F.nullif(F.trim("abstract"), F.lit("")).isNotNull(), F.concat(F.lit("abstract: >-\n  "), F.trim(F.regexp_replace("abstract", r"\s+", " "))))
    extra = [field(name, F.col(c)) for name, c in (("type", "type"), ("URL", "url"), ("ISSN", "issn"), ("publisher", "publisher"), ("arxiv", "arxiv")) if c in papers.columns]
    parts = F.array_compact(F.array(
        field("title", F.col("title")),
        F.when(F.size(authors) > 0, F.concat(F.lit("author:\n"), F.array_join(authors, "\n"))),
        field("date", F.col("date")), folded, field("doi", F.col("doi")), field("container-title", F.col("container_title")),
        F.when(words != "", F.concat(F.lit("keywords: ["), words, F.lit("]"))),
        field("volume", F.col("volume")), field("issue", F.col("issue")), field("page", F.col("page")), *extra,
        F.concat(F.lit("lang: "), _quoted(F.coalesce(F.nullif(F.col("lang"), F.lit("")), F.lit("en")))),
    ))
    return papers.select("paper_id", F.concat(F.lit("---\n"), F.array_join(parts, "\n"), F.lit("\n---\n")).alias("yaml"))


def documents(bodies: DataFrame, matter: DataFrame) -> DataFrame:
    """(paper_id, part, text): the pieces of each paper's document in order: its front matter, then its pages."""
    head = matter.select("paper_id", F.lit(-1).alias("part"), F.col("yaml").alias("text"))
    return head.unionByName(bodies.select("paper_id", F.col("page_idx").alias("part"), F.concat(F.col("body"), F.lit("\n")).alias("text")))


def write_documents(bodies: DataFrame, matter: DataFrame, slugs: DataFrame, path: str) -> None:
    """Writes one Markdown document per paper into a folder of its slug (paper_id, slug); reruns overwrite.

    A task writes its papers one after another in page order, holding one page at a time.
    """
    named = documents(bodies, matter).join(slugs.select("paper_id", "slug"), "paper_id")
    ordered = named.repartition("slug").sortWithinPartitions("slug", "part")
    ordered.select("slug", "text").write.mode("overwrite").partitionBy("slug").text(path)


def progress(events: DataFrame) -> DataFrame:
    """(run_id, seq, percent): percent of a run by stage and fraction, never falling."""
    lo = F.create_map(*[F.lit(x) for k, v in STAGE_SPAN.items() for x in (k, v[0])])
    hi = F.create_map(*[F.lit(x) for k, v in STAGE_SPAN.items() for x in (k, v[1])])
    s = F.col("stage")
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.coalesce("fraction", F.lit(0.0))))
    raw = F.round(lo[s] + (hi[s] - lo[s]) * part).cast("int")
    w = Window.partitionBy("run_id").orderBy("seq").rowsBetween(Window.unboundedPreceding, 0)
    return events.select("run_id", "seq", F.max(raw).over(w).alias("percent"))


def best_attempts(attempts: DataFrame) -> DataFrame:
    """(paper_id, attempt): fewest severe findings, then most figures and tables, then most page marks; the earliest of equals."""
    w = Window.partitionBy("paper_id").orderBy("severe", -F.col("objects"), -F.col("markers"), "attempt")
    return attempts.withColumn("k", F.row_number().over(w)).where("k = 1").select("paper_id", "attempt")


def event_lines(events: DataFrame) -> DataFrame:
    """(run_id, seq, value): events as one JSON document each, fields without a value left out."""
    rest = [c for c in events.columns if c not in ("run_id", "seq")]
    return events.select("run_id", "seq", F.to_json(F.struct(*rest)).alias("value"))


def wanted_anchors(anchors: DataFrame, asked: DataFrame) -> DataFrame:
    """(paper_id, seq, line): an anchor element before the first row of each anchor that something links to."""
    hit = anchors.join(asked.select("paper_id", "anchor").distinct(), ["paper_id", "anchor"], "left_semi")
    return hit.select("paper_id", "seq", F.concat(F.lit('<a id="'), F.col("anchor"), F.lit('"></a>')).alias("line"))
