"""Queries of the two general problems: nested records and packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.operators import packed, shred
from paperloom.registry import Registry
from paperloom.session import table

GENERAL = Registry()


@GENERAL.add("p3_found")
def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each node of the article entities with its number and its parent."""
    docs = table(spark, sf_dir, "xml_docs", "xml_id", "xml")
    return shred.article_nodes(docs).select(
        F.col("id").alias("xml_id"), "kind", "pos", "parent_kind", "parent_pos"
    ).distinct()


_ENTITY_LABELS = (
    *shred.ARTICLE_LABELS, "@contrib-type", "surname", "given-names", "given-name", "title", "section-title",
    "article-title", "source", "year", "label", "pub-id", "textref", "mixed-citation", "doi", "article-id", "text", "volume",
    "issue", "pubdate", "pub-date", "journal-title", "country", "institution", "textfn", "p", "surname", "article",
)


def _adjacency(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "xml_docs", "xml_id", "xml")
    return shred.shred(docs, "xml_id", "xml", _ENTITY_LABELS, shred.ARTICLE_ROLES)


def _entity(spark: SparkSession, sf_dir: str, kind: str, columns: dict, steps: tuple[str, ...]) -> DataFrame:
    adj = _adjacency(spark, sf_dir)
    objs = shred.article_objects(adj)
    return shred.entity_table(adj, objs, kind, columns, steps).select(
        F.col("id").alias("xml_id"), "pos", "parent_kind", "parent_pos", *columns
    )


@GENERAL.add("p3_sections")
def p3_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sections with their titles, each tied to the section around it."""
    return _entity(spark, sf_dir, "sec", {"title": F.col("label").isin("title", "section-title")}, ("sec", "section"))


@GENERAL.add("p3_refs")
def p3_refs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bibliography entries with their scalars in columns."""
    label = F.col("label")
    in_ref = shred.has_step("ref", "bib-reference")
    columns = {
        "label": (label == "label") & in_ref,
        "title": (label.isin("article-title", "title")) & in_ref,
        "source": (label == "source") & in_ref,
        "year": (label == "year") & in_ref,
        "doi": (label == "pub-id") & in_ref,
        "raw": label.isin("textref", "mixed-citation") & in_ref,
    }
    return _entity(spark, sf_dir, "ref", columns, ("ref", "bib-reference"))


@GENERAL.add("p3_authors")
def p3_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of the paper with their name parts in columns."""
    label = F.col("label")
    columns = {
        "surname": label == "surname",
        "given": label.isin("given-names", "given-name"),
        "collab": label == "collab",
    }
    return _entity(spark, sf_dir, "author", columns, ("contrib", "author"))


@GENERAL.add("p3_affiliations")
def p3_affiliations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Affiliations, tied to the author around them."""
    label, inner = F.col("label"), shred.has_step("aff", "affiliation")
    columns = {"name": label.isin("aff", "institution", "textfn"), "country": (label == "country") & inner, "label": (label == "label") & inner}
    return _entity(spark, sf_dir, "aff", columns, ("aff", "affiliation"))


@GENERAL.add("p3_keywords")
def p3_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keywords of the paper."""
    label = F.col("label")
    return _entity(spark, sf_dir, "kwd", {"keyword": (label == "kwd") | ((label == "text") & shred.has_step("keyword"))}, ("kwd", "keyword"))


def _captioned(spark: SparkSession, sf_dir: str, kind: str, steps: tuple[str, ...]) -> DataFrame:
    label, inner = F.col("label"), shred.has_step(*steps)
    columns = {"label": (label == "label") & inner, "caption": ((label == "caption") | (label.isin("p", "title") & shred.has_step("caption"))) & inner}
    return _entity(spark, sf_dir, kind, columns, steps)


@GENERAL.add("p3_figures")
def p3_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captioned figures, tied to their section."""
    return _captioned(spark, sf_dir, "fig", ("fig", "figure"))


@GENERAL.add("p3_tables")
def p3_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captioned tables, tied to their section."""
    return _captioned(spark, sf_dir, "table", ("table-wrap", "table"))


@GENERAL.add("p3_ref_authors")
def p3_ref_authors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Authors of the bibliography entries, tied to their entry."""
    label = F.col("label")
    columns = {"surname": label == "surname", "given": label.isin("given-names", "given-name"), "name": label.isin("collab", "name", "string-name")}
    return _entity(spark, sf_dir, "ref_author", columns, ("name", "string-name", "collab", "author"))


@GENERAL.add("p3_articles")
def p3_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per record with its own scalars."""
    label, path = F.col("label"), F.col("path")
    outside = ~shred.has_step("ref", "bib-reference", "abstract", "sec", "section")
    columns = {
        "title": (label == "article-title") | ((label == "title") & (F.size(path) <= 3)),
        "doi": label.isin("doi", "article-id"), "journal": label == "journal-title", "volume": label == "volume", "year": label.isin("year", "pubdate"),
    }
    name = F.coalesce(*[F.when(c & outside, F.lit(n)) for n, c in columns.items()])
    pick = [F.min(F.when(F.col("name") == n, F.struct("node", F.trim("scalar").alias("v")))).getField("v").alias(n) for n in columns]
    adj = _adjacency(spark, sf_dir).withColumn("name", name).where(F.col("id").isNotNull())
    return adj.groupBy("id", "rec").agg(F.count_distinct("node").alias("nodes"), *pick).select(F.col("id").alias("xml_id"), "nodes", *columns)


@GENERAL.add("p5_found")
def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Packed references and labelled lists, one row per value."""
    refs = packed.packed_references(table(spark, sf_dir, "refs", "ref_id", "raw"))
    lists = packed.labelled_lists(table(spark, sf_dir, "blocks", "block_id", "text"))
    return (
        refs.select(F.lit("refs").alias("src"), "row_id", "pos", "value")
        .unionByName(lists.select(F.lit("blocks").alias("src"), "row_id", "pos", "value"))
        .distinct()
    )


@GENERAL.add("p5_flags")
def p5_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many values of each source came from a malformed quote."""
    refs = packed.packed_references(table(spark, sf_dir, "refs", "ref_id", "raw"))
    lists = packed.labelled_lists(table(spark, sf_dir, "blocks", "block_id", "text"))
    both = refs.select(F.lit("refs").alias("src"), "flag").unionByName(lists.select(F.lit("blocks").alias("src"), "flag"))
    return both.groupBy("src", F.coalesce("flag", F.lit("none")).alias("flag")).agg(F.count("*").alias("n"))
