"""Block lists as relations: layout labels, the intermediate rows, pages, captions.

Order is never physical: every relation carries ``paper_id``, ``seq`` and a minor order
``sub``. What a sequential reader would keep as running state (which page, whether the
reference list has begun) is an aggregate per paper joined back, so that a paper of any
size is spread over tasks; only rows that are few per paper go through windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import text as T

# Layout labels of recognition services and the block types they mean.
LABEL_TYPES = {
    "header": "header", "footer": "footer", "number": "page_number", "page_number": "page_number", "aside_text": "aside_text",
    "header_image": "header", "footnote": "page_footnote", "page_footnote": "page_footnote", "image": "image", "chart": "image",
    "table_image": "image", "seal": "image", "formula": "equation", "equation": "equation", "interline_formula": "equation",
    "display_formula": "equation", "figure_title": "fig_caption", "table_title": "table_caption", "table": "table",
    "reference_content": "ref_text", "text": "text", "abstract": "text", "doc_title": "text", "paragraph_title": "text",
}
HEADING_LABELS = ("doc_title", "paragraph_title")


def label_type(label: Column) -> Column:
    """Block type of a layout label; unknown labels are text."""
    known = F.create_map(*[F.lit(x) for p in LABEL_TYPES.items() for x in p])
    return F.coalesce(F.try_element_at(known, label), F.lit("text"))


def convert_layout(raw: DataFrame) -> DataFrame:
    """Rows (…, label, content) as blocks: typed, cleaned, panels and empty ones dropped."""
    clean = T.clean_layout_text(F.coalesce("content", F.lit("")))
    kind = F.when(T.is_url(F.col("content")), F.lit("image")).otherwise(label_type(F.col("label")))
    panel = F.col("text").rlike(r"^[（(]?[A-Za-z0-9]{1,2}[)）]?$")
    numbered = F.col("text").rlike(r"(?i)^Fig(?:ure|\.)?\s*\d")
    out = raw.withColumn("type", kind).withColumn("text", F.when(F.col("label") == "header_image", F.lit("")).otherwise(clean))
    plain = F.col("type") == "text"
    out = out.withColumn("text", F.when(plain, F.regexp_replace("text", r"^#{1,6}\s+", "")).otherwise(F.col("text")))
    out = out.withColumn("type", F.when((F.col("type") == "fig_caption") & ~numbered, F.lit("text")).otherwise(F.col("type")))
    keep = F.col("type").isin(*T.NOISE_TYPES, "page_footnote", "image") | ((F.col("text") != "") & ~(F.col("label").isin("figure_title", "table_title") & panel))
    level = F.when((F.col("type") == "text") & F.col("label").isin(*HEADING_LABELS), F.lit(1))
    return out.where(keep).withColumn("text_level", level)


def one_per_position(blocks: DataFrame) -> DataFrame:
    """Blocks delivered twice count once: the least block_id of each (paper_id, seq)."""
    first = blocks.groupBy("paper_id", "seq").agg(F.min("block_id").alias("block_id"))
    return blocks.join(first, ["paper_id", "seq", "block_id"])


def reference_starts(blocks: DataFrame) -> DataFrame:
    """(paper_id, ref_seq): the first heading that opens a reference list."""
    heads = blocks.where((F.col("type") == "text") & (F.coalesce("text_level", F.lit(0)) > 0) & T.is_reference_heading(F.col("text")))
    return heads.groupBy("paper_id").agg(F.min("seq").alias("ref_seq"))


def page_anchors(blocks: DataFrame) -> DataFrame:
    """(paper_id, page_idx, seq): one anchor before the first block of each page."""
    real = blocks.where(~F.col("type").isin(*T.NOISE_TYPES))
    return real.groupBy("paper_id", F.coalesce("page_idx", F.lit(0)).alias("page_idx")).agg(F.min("seq").alias("seq"))


def intermediate(blocks: DataFrame) -> DataFrame:
    """(paper_id, seq, sub, kind, content, level, page_idx): blocks as typed rows.

    Noise is dropped; a list gives one row per item; text after the reference heading is
    a reference; a page anchor precedes the first row of each page.
    """
    b = blocks.where(~F.col("type").isin(*T.NOISE_TYPES)).join(reference_starts(blocks), "paper_id", "left")
    after = F.coalesce(F.col("seq") > F.col("ref_seq"), F.lit(False))
    level = F.coalesce("text_level", F.lit(0))
    kind = (
        F.when((F.col("type") == "text") & (level > 0), F.lit("heading"))
        .when(F.col("type") == "ref_text", F.lit("reference"))
        .when(F.col("type").isin("text", "list") & after, F.lit("reference"))
        .when(F.col("type").isin("text", "list"), F.lit("paragraph"))
        .when(F.col("type") == "page_footnote", F.lit("footnote"))
        .when(F.col("type").isin("image", "chart"), F.lit("image"))
        .otherwise(F.col("type"))
    )
    caption = F.when(F.col("type").isin("image", "chart"), T.caption(F.col("chart_caption"), F.col("image_caption"))).when(
        F.col("type") == "table", T.table_caption(F.col("table_caption"))
    )
    content = F.when(F.col("type") == "table", F.col("table_body")).otherwise(F.col("text"))
    items = F.when((F.col("type") == "list") & (F.size("list_items") > 0), F.col("list_items")).otherwise(F.array(content))
    rows = b.select(
        "paper_id", "seq", kind.alias("kind"), level.alias("level"), F.coalesce("page_idx", F.lit(0)).alias("page_idx"),
        caption.alias("caption"), F.posexplode(items).alias("item", "content"),
    ).withColumn("sub", F.col("item") + 1).drop("item")
    full = rows.where((F.trim(F.coalesce("content", F.lit(""))) != "") | F.col("kind").isin("image", "table"))
    anchors = page_anchors(blocks).select(
        "paper_id", "seq", F.lit("page_anchor").alias("kind"), F.lit(0).alias("level"), "page_idx",
        F.lit(None).cast("string").alias("caption"), F.col("page_idx").cast("string").alias("content"), F.lit(0).alias("sub"),
    )
    return full.unionByName(anchors)


def bind_captions(items: DataFrame) -> DataFrame:
    """Free captions with the seq of the block they belong to.

    A figure caption goes to the last image of the run right after it, else to the image
    right before it if that has none; a table caption to the next table of its page, else
    the one before. Input: paper_id, page_idx, seq, type, has_caption. Windows hold one
    page each.
    """
    page = Window.partitionBy("paper_id", "page_idx").orderBy("seq")
    ahead = page.rowsBetween(1, Window.unboundedFollowing)
    back = page.rowsBetween(Window.unboundedPreceding, -1)
    is_image, is_table = F.col("type") == "image", F.col("type") == "table"
    breaks = F.min(F.when(~is_image, F.col("seq"))).over(ahead)
    out = (
        items.withColumn("next_break", breaks)
        .withColumn("next_type", F.lead("type").over(page))
        .withColumn("prev_type", F.lag("type").over(page))
        .withColumn("prev_free", ~F.coalesce(F.lag("has_caption").over(page), F.lit(False)))
        .withColumn("prev_seq", F.lag("seq").over(page))
        .withColumn("images", F.collect_list(F.when(is_image, F.col("seq"))).over(ahead))
        .withColumn("next_table", F.min(F.when(is_table, F.col("seq"))).over(ahead))
        .withColumn("prev_table", F.max(F.when(is_table, F.col("seq"))).over(back))
    )
    run_end = F.array_max(F.filter("images", lambda s: F.col("next_break").isNull() | (s < F.col("next_break"))))
    figure = F.when(F.col("next_type") == "image", run_end).when((F.col("prev_type") == "image") & F.col("prev_free"), F.col("prev_seq"))
    target = F.when(F.col("type") == "fig_caption", figure).when(F.col("type") == "table_caption", F.coalesce("next_table", "prev_table"))
    return out.where(F.col("type").isin("fig_caption", "table_caption")).select(
        "paper_id", "page_idx", "seq", "type", target.alias("target_seq")
    )


def coordinate_space(blocks: DataFrame) -> DataFrame:
    """(paper_id, space): boxes beyond 1001 are pixels, other boxes normalised; null without boxes."""
    top = blocks.groupBy("paper_id").agg(F.max(F.array_max("bbox")).alias("top"))
    return top.select(
        "paper_id", F.when(F.col("top") > 1001, F.lit("paddleocr")).when(F.col("top") > 0, F.lit("mineru")).alias("space")
    )


def rectangle(bbox: Column, space: Column, width: Column, height: Column, pad: float = 5.0) -> Column:
    """A box in page points: scaled by its space, padded and clipped to the page."""
    norm = space == "mineru"
    at = lambda i, size: F.when(norm, F.get(bbox, i) * size / 1000).otherwise(F.get(bbox, i) * 0.5)
    clip = lambda v, size: F.greatest(F.lit(0.0), F.least(v, size))
    return F.struct(
        clip(at(0, width) - pad, width).alias("x0"), clip(at(1, height) - pad, height).alias("y0"),
        clip(at(2, width) + pad, width).alias("x1"), clip(at(3, height) + pad, height).alias("y1"),
    )


def ensure_reference_heading(rows: DataFrame) -> DataFrame:
    """Adds a ``References`` heading before the first reference of papers that have references and no such heading."""
    heads = rows.where((F.col("kind") == "heading") & T.is_reference_heading(F.col("content"))).select("paper_id").distinct()
    first = rows.where(F.col("kind") == "reference").groupBy("paper_id").agg(F.min(F.struct("seq", "page_idx")).alias("f"))
    lack = first.join(heads, "paper_id", "left_anti")
    new = lack.select("paper_id", F.col("f.seq").alias("seq"), F.lit("heading").alias("kind"), F.lit(1).alias("level"), F.col("f.page_idx").alias("page_idx"), F.lit(None).cast("string").alias("caption"), F.lit("References").alias("content"), F.lit(-1).alias("sub"))
    return rows.unionByName(new)


def tidy_anchors(rows: DataFrame) -> DataFrame:
    """Page anchors that something follows on their page; the others mark nothing."""
    real = rows.where(F.col("kind") != "page_anchor").select("paper_id", "page_idx").distinct()
    anchors = rows.where(F.col("kind") == "page_anchor")
    return rows.where(F.col("kind") != "page_anchor").unionByName(anchors.join(real, ["paper_id", "page_idx"], "left_semi").select(rows.columns))


def page_counts(blocks: DataFrame) -> DataFrame:
    """(paper_id, pages): pages that a paper's blocks reach."""
    return blocks.groupBy("paper_id").agg((F.max(F.coalesce("page_idx", F.lit(0))) + 1).alias("pages"))


def page_frames(pages: DataFrame) -> DataFrame:
    """(paper_id, page, text, split): each page's text with the next page's after it, and where that begins."""
    nxt = pages.select("paper_id", (F.col("page") - 1).alias("page"), F.col("text").alias("next"))
    j = pages.join(nxt, ["paper_id", "page"], "left")
    return j.select("paper_id", "page", F.concat(F.col("text"), F.coalesce("next", F.lit(""))).alias("text"), F.when(F.col("next").isNotNull(), F.length("text")).alias("split"))


def resolve_images(blocks: DataFrame, images: DataFrame) -> DataFrame:
    """Blocks whose image exists in a listing (paper_id, path), by its bare name; links are left out."""
    name = F.regexp_extract("img_path", r"([^/]+)$", 1)
    have = images.select("paper_id", F.regexp_extract("path", r"([^/]+)$", 1).alias("name")).distinct()
    local = blocks.where(F.col("img_path").isNotNull() & ~T.is_url(F.col("img_path"))).withColumn("name", name)
    return local.join(have, ["paper_id", "name"], "left_semi")
