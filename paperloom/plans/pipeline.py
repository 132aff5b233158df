"""The whole conversion of a corpus as one plan, and its acceptance scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import bibliography as B
from paperloom.functions import latex as L
from paperloom.functions import text as T
from paperloom.operators import blocks as BL
from paperloom.operators import figures as FG
from paperloom.operators import headings as HD
from paperloom.operators import links as LK
from paperloom.operators import metadata as MD
from paperloom.operators import pages as PG
from paperloom.operators import references as RF
from paperloom.operators import render as RD
from paperloom.operators import tables as TB
from paperloom.operators import xmldoc as XD
from paperloom.registry import Registry
from paperloom.session import cut_lineage, table
from paperloom.settings import Settings
from paperloom.sources.staging import within_pages

PIPELINE = Registry()


_MATH_SIGNS = r"[$\\\\{]|[" + "".join((*L.SUBSCRIPTS, *L.SUPERSCRIPTS)) + "]"


def repaired_math(rows: DataFrame) -> DataFrame:
    """Rows with their broken formulas repaired; only rows that can hold any leave the JVM."""
    may = F.coalesce(F.col("content").rlike(_MATH_SIGNS), F.lit(False)) & F.col("kind").isin("paragraph", "heading", "equation", "footnote", "reference")
    fix = L.single_tag_col(L.repair_scripts_col(L.tidy_math_col(F.col("content"))))
    with_math = rows.where(may).withColumn("content", fix)
    heads = with_math.where("kind = 'heading'").withColumn("content", L.heading_math_col(F.col("content")))
    prose = with_math.where("kind in ('paragraph', 'footnote')").withColumn("content", L.scripts_outside_math_col(F.col("content")))
    other = with_math.where("kind in ('equation', 'reference')")
    return rows.where(~may).unionByName(heads).unionByName(prose).unionByName(other)


def cleaned(rows: DataFrame) -> DataFrame:
    """Rows with clean text: inline markup to one notation, stamps of downloads and publisher noise gone."""
    para = F.col("kind") == "paragraph"
    kept = rows.where(~F.col("kind").isin("paragraph", "heading", "footnote"))
    text = rows.where(F.col("kind").isin("paragraph", "heading", "footnote"))

    def tidy(t):
        return F.when(para, T.clean_paragraph(t)).when(F.col("kind") == "heading", T.spaced_heading(t)).otherwise(t)

    text = text.withColumn("content", T.let(T.strip_watermark(T.normalize_inline(F.col("content"))), tidy))
    return kept.unionByName(text.where(~para | F.col("content").isNotNull()))


def joined_parts(rows: DataFrame) -> DataFrame:
    """Rows in which continued tables and paragraphs that run on are one row each, where they begin."""
    tables = TB.merged(rows).select("paper_id", "seq", F.col("content").alias("whole"), F.lit(0).alias("sub"))
    prose = HD.merge_fragments(rows).select("paper_id", "seq", F.col("content").alias("whole"), "sub")
    is_table = F.col("kind") == "table"
    t = rows.where(is_table).join(tables.drop("sub"), ["paper_id", "seq"]).withColumn("content", F.when(F.col("content").rlike("(?i)<tr"), F.col("whole")).otherwise(F.col("content"))).drop("whole")
    p = rows.where(F.col("kind") == "paragraph").join(prose, ["paper_id", "seq", "sub"]).withColumn("content", F.col("whole")).drop("whole")
    return rows.where(~is_table & (F.col("kind") != "paragraph")).unionByName(t.select(rows.columns)).unionByName(p.select(rows.columns))


def converted_rows(blocks: DataFrame, papers: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The rows of each paper's document, ready for rendering.

    Covers are left out by an anti join, rows become typed, the article is cut to its
    boundaries, texts are cleaned and formulas repaired, tables and paragraphs that go on are
    joined, headings get their levels and numbers, images their names, a reference list its
    heading, and citations their links, where exactly one row is their target. A paper may
    have any number of pages, unless ``max_pages`` sets a limit.
    """
    s = settings or Settings()
    b = BL.one_per_position(within_pages(blocks, s.max_pages))
    covers = PG.cover_pages(b, papers).where("is_cover").select("paper_id", F.lit(0).alias("page_idx"))
    rows = BL.intermediate(b.join(covers, ["paper_id", "page_idx"], "left_anti"))
    if s.article_boundary:
        rows = PG.within_article(cut_lineage(rows), papers)
    rows = cut_lineage(repaired_math(cut_lineage(cleaned(rows))))
    rows = cut_lineage(BL.ensure_reference_heading(joined_parts(rows)))
    levels = HD.levels(rows)
    numbered = HD.add_numbers(levels).select("paper_id", "seq", F.col("content").alias("numbered"))
    heads = levels.select("paper_id", "seq", F.col("level").alias("real")).join(numbered, ["paper_id", "seq"])
    names = FG.figure_names(FG.number_figures(rows)).select("paper_id", "seq", F.concat(F.lit("images/"), F.col("name"), F.lit(".png")).alias("image"))
    head = F.col("kind") == "heading"
    rows = rows.join(heads.dropDuplicates(["paper_id", "seq"]), ["paper_id", "seq"], "left").join(names.dropDuplicates(["paper_id", "seq"]), ["paper_id", "seq"], "left")
    rows = rows.withColumn("content", F.when(head, F.coalesce("numbered", "content")).otherwise(F.col("content")))
    rows = rows.withColumn("level", F.when(head, F.coalesce("real", "level")).otherwise(F.col("level"))).drop("numbered", "real")
    rows = rows.withColumn("image", F.when(F.col("kind") == "image", F.col("image")))
    return LK.link_rows(cut_lineage(rows)) if s.inject_links else rows


def convert(blocks: DataFrame, papers: DataFrame, settings: Settings | None = None) -> DataFrame:
    """(paper_id, page_idx, body): blocks and records of a corpus as Markdown pages, each rendered on its own."""
    return RD.page_bodies(converted_rows(blocks, papers, settings))


def write_corpus(blocks: DataFrame, papers: DataFrame, path: str, settings: Settings | None = None) -> None:
    """Writes one Markdown document and one reference list per paper, in folders of its slug."""
    s = settings or Settings()
    rows = cut_lineage(converted_rows(blocks, papers, s))
    papers = MD.completed(papers, MD.rule_metadata(BL.one_per_position(blocks), s.max_year, s.early_pages))
    slugs = MD.unique_slugs(papers)
    RD.write_documents(RD.page_bodies(rows), RD.front_matter(papers), slugs, f"{path}/documents")
    entries = RF.split_entries(rows)
    refs = entries.select("paper_id", F.col("pos").alias("ref_id"), "n", "raw", F.lit(None).cast("string").alias("title"), F.lit(None).cast("array<string>").alias("authors"), F.lit(None).cast("int").alias("year"),
                          F.lit(None).cast("string").alias("venue"), B.doi(F.col("raw")).alias("doi"), B.arxiv(F.col("raw")).alias("arxiv_id"))
    RF.payload(refs).join(slugs, "paper_id").repartition("slug").select("slug", F.col("json").alias("value")).write.mode("overwrite").partitionBy("slug").text(f"{path}/references")


@PIPELINE.add("converted_pages")
def converted_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown pages of the whole corpus."""
    return convert(table(spark, sf_dir, "blocks"), MD.latest(table(spark, sf_dir, "papers")))


@PIPELINE.add("xml_blocks")
def xml_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks of every XML record."""
    return XD.xml_blocks(table(spark, sf_dir, "xml_docs", "xml_id", "xml"))


@PIPELINE.add("xml_metadata")
def xml_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of every XML record."""
    return XD.xml_metadata(table(spark, sf_dir, "xml_docs", "xml_id", "xml"))


@PIPELINE.add("scan_table_groups")
def scan_table_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logical tables of each paper, continuations counted once."""
    rows = BL.intermediate(BL.one_per_position(table(spark, sf_dir, "blocks")))
    return TB.continuations(rows).groupBy("paper_id").agg(F.count_distinct("group_seq").alias("tables"))


@PIPELINE.add("scan_image_names", "select paper_id, img_path, count(*) as n from blocks where img_path is not null group by 1, 2 having count(*) > 1")
def scan_image_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image names that a paper uses more than once."""
    b = table(spark, sf_dir, "blocks", "paper_id", "img_path").where(F.col("img_path").isNotNull())
    return b.groupBy("paper_id", "img_path").agg(F.count("*").alias("n")).where("n > 1")


@PIPELINE.add(
    "scan_top_headings",
    "select p.paper_id, coalesce(h.n, 0) as n from (select distinct paper_id from papers) p left join (select paper_id, count(*) as n from blocks where type = 'text' and text_level = 1 group by 1) h using (paper_id) where coalesce(h.n, 0) = 0 or h.n > 12",
)
def scan_top_headings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers with no top heading or with more than twelve."""
    h = table(spark, sf_dir, "blocks", "paper_id", "type", "text_level").where("type = 'text' and text_level = 1").groupBy("paper_id").agg(F.count("*").alias("n"))
    p = table(spark, sf_dir, "papers", "paper_id").distinct().join(h, "paper_id", "left")
    return p.select("paper_id", F.coalesce("n", F.lit(0)).alias("n")).where("n = 0 or n > 12")


@PIPELINE.add(
    "scan_tables_kept",
    "with s as (select paper_id, count(*) as source from blocks where type = 'table' group by 1), k as (select paper_id, count(*) as kept from blocks where type = 'table' and regexp_matches(table_body, '(?i)<table[\\s>]') group by 1) select s.paper_id, source, coalesce(kept, 0) as kept from s left join k using (paper_id) where coalesce(kept, 0) < source",
)
def scan_tables_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers in which fewer tables are HTML than the source has."""
    t = table(spark, sf_dir, "blocks", "paper_id", "type", "table_body").where("type = 'table'")
    html = F.coalesce(F.col("table_body").rlike(r"(?i)<table[\s>]"), F.lit(False)).cast("bigint")
    return t.groupBy("paper_id").agg(F.count("*").alias("source"), F.sum(html).alias("kept")).where("kept < source")


@PIPELINE.add("anchored_rows")
def anchored_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors that some paragraph links to, once each (semi join)."""
    rows = BL.intermediate(BL.one_per_position(table(spark, sf_dir, "blocks")))
    asked = LK.mentions(rows).select("paper_id", F.concat_ws("-", "category", "number").alias("anchor")).distinct()
    return LK.anchors(rows).join(asked, ["paper_id", "anchor"], "left_semi")
