"""Sources and sinks: block lists as JSON, layout pages as JSON lines, XML documents, text bodies."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = (
    "type string, text string, text_level int, page_idx int, img_path string, image_caption array<string>, "
    "chart_caption array<string>, table_body string, table_caption array<string>, table_footnote array<string>, "
    "list_items array<string>, sub_type string, bbox array<double>"
)
LAYOUT_PAGE = (
    "layoutParsingResults array<struct<prunedResult:struct<parsing_res_list:array<struct<block_label:string,"
    "block_content:string,block_bbox:array<double>>>>,markdown:struct<images:map<string,string>>>>"
)


def within_pages(blocks: DataFrame, max_pages: int) -> DataFrame:
    """``blocks`` without the papers of more than ``max_pages`` pages; 0 sets no limit."""
    if max_pages <= 0:
        return blocks
    long = blocks.groupBy("paper_id").agg(F.max("page_idx").alias("p")).where(F.col("p") + 1 > max_pages)
    return blocks.join(long.select("paper_id"), "paper_id", "left_anti")


def read_block_lists(spark: SparkSession, glob: str) -> DataFrame:
    """Block-list files, one JSON array each, as rows with paper_id (the file's folder) and seq.

    Malformed files give rows with ``_corrupt``; papers of any number of pages are read.
    """
    raw = spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    arr = F.from_json("value", f"array<struct<{BLOCK.replace(' string', ':string').replace(' int', ':int').replace(' array', ':array')}>>")
    b = raw.select(F.element_at(F.split("path", "/"), -2).alias("paper_id"), F.posexplode_outer(arr).alias("seq", "b"))
    return b.select("paper_id", F.col("seq").cast("bigint"), "b.*")


def read_layout_pages(spark: SparkSession, path: str) -> DataFrame:
    """Layout results (JSON lines, an array of pages each) as (page_idx, seq, label, content, bbox, image_url).

    An image's link is the first entry of the page's image map whose key holds the box.
    """
    j = spark.read.schema(LAYOUT_PAGE).option("mode", "PERMISSIVE").json(path)
    p = j.select(F.posexplode("layoutParsingResults").alias("page_idx", "p"))
    b = p.select("page_idx", F.col("p.markdown.images").alias("images"), F.posexplode("p.prunedResult.parsing_res_list").alias("seq", "b"))
    key = F.concat(F.lit("box_"), F.array_join(F.transform("b.block_bbox", lambda v: F.round(v).cast("int").cast("string")), "_"))
    hit = F.try_element_at(F.filter(F.map_keys("images"), lambda k: F.contains(k, key)), F.lit(1))
    return b.select("page_idx", "seq", F.col("b.block_label").alias("label"), F.col("b.block_content").alias("content"), F.col("b.block_bbox").alias("bbox"), F.try_element_at("images", hit).alias("image_url"))


def image_name(page, index):
    """Name of a page's image without one of its own."""
    return F.format_string("img_p%03d_%02d.png", page, index)


def read_xml(spark: SparkSession, glob: str) -> DataFrame:
    """XML files as (paper_id, path, xml): UTF-8, else Latin-1."""
    b = spark.read.format("binaryFile").load(glob)
    utf8 = F.try_validate_utf8(F.decode("content", "UTF-8")) if hasattr(F, "try_validate_utf8") else F.decode("content", "UTF-8")
    bad = F.contains(utf8, F.lit("\ufffd"))
    text = F.when(bad, F.decode("content", "ISO-8859-1")).otherwise(utf8)
    return b.select(F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("paper_id"), "path", text.alias("xml"))


def flavor(xml):
    """Dialect of a document: ``jats``, else ``elsevier`` by its own elements, else ``jats``."""
    return (
        F.when(xml.rlike(r"<(\w+:)?(article-meta|ref-list)\b"), "jats")
        .when(xml.rlike(r"<(\w+:)?iteminfo\b") | (xml.rlike(r"<(\w+:)?sections\b") & xml.rlike(r"<(\w+:)?section-title\b")), "elsevier")
        .otherwise("jats")
    )


def staging_name(path, content):
    """Folder of a staged document: stem, cut to 24 signs if longer than 40, and six digits of its hash."""
    stem = F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)
    return F.concat(F.when(F.length(stem) > 40, F.substring(stem, 1, 24)).otherwise(stem), F.lit("-"), F.substring(F.md5(content), 1, 6))


class Providers:
    """Registry of block sources by name; a registered one shadows a built-in of its name."""

    def __init__(self) -> None:
        self._made: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.builtin: dict[str, Callable[[SparkSession, str], DataFrame]] = {"blocks": read_block_lists, "layout": read_layout_pages, "xml": read_xml}

    def register(self, name: str, factory: Callable[[SparkSession, str], DataFrame]) -> None:
        self._made[name] = factory

    def names(self) -> list[str]:
        return sorted({*self.builtin, *self._made})

    def get(self, name: str = "blocks") -> Callable[[SparkSession, str], DataFrame]:
        try:
            return self._made.get(name) or self.builtin[name]
        except KeyError:
            raise ValueError(f"unknown source {name!r}; known: {', '.join(self.names())}") from None


PROVIDERS = Providers()


def write_references(payload: DataFrame, path: str) -> None:
    """One JSON document per paper, as text lines partitioned by paper."""
    payload.select("paper_id", F.col("json").alias("value")).write.mode("overwrite").partitionBy("paper_id").text(path)
