"""Queries of the problems on training-data text."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.llm import bpe, languages, leaks, lookalike, markup, names, repetition, scans
from paperloom.registry import Registry
from paperloom.session import cut_lineage, table

LLM = Registry()


@LLM.add("p10_found")
def p10_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that look alike and differ in code points."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lookalike.pairs(docs).select(F.col("id_a").alias("doc_id_a"), F.col("id_b").alias("doc_id_b"))


@LLM.add("p10_canonical")
def p10_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical text of each document, its own where nothing looks alike."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lookalike.canonical_members(docs).withColumnRenamed("id", "doc_id")


@LLM.add("p10_classes")
def p10_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that have look-alikes with their class and number of links."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lookalike.classes(docs).withColumnRenamed("id", "doc_id")


@LLM.add("p8_ids")
def p8_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document by byte_bpe_50k, without special tokens."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return bpe.encode_corpus(docs).withColumnRenamed("id", "doc_id")


@LLM.add("p8_round_trip")
def p8_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many documents come back from their ids as they were, with the tokens in all."""
    docs = table(spark, sf_dir, "documents", "text")
    return bpe.round_trip(docs)


@LLM.add("p9_found")
def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with passages of evaluation items."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return leaks.leaked(docs, table(spark, sf_dir, "eval_items", "item_id", "text"))


_P2_SQL = r"""with t as (select block_id, regexp_extract_all(regexp_replace(text, '([㐀-䶿一-鿿豈-﫿])', ' \1 ', 'g'), '[\p{L}\p{No}\p{Nl}]+|\p{Nd}+(?:[.,]\p{Nd}+)*') as words from blocks),
u as (select block_id, generate_subscripts(words, 1) as i, unnest(words) as raw from t where len(words) >= 20),
w as (select block_id, i, case when regexp_matches(raw, '^\p{Nd}') then '0' else lower(raw) end as w from u),
g as (select *, lead(w, 1) over p as w1, lead(w, 2) over p as w2, lead(w, 3) over p as w3 from w window p as (partition by block_id order by i)),
h as (select *, case when w3 is not null and row_number() over (partition by block_id, w, w1, w2, w3 order by i) > 1 then 1 else 0 end as again from g),
c as (select block_id, max(again) over (partition by block_id order by i rows between 3 preceding and current row) as repeated from h)
select block_id from c group by 1 having sum(repeated) >= 0.4 * count(*)"""


@LLM.add("p2_found", _P2_SQL)
def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks that repeat at least two fifths of their words."""
    blocks = table(spark, sf_dir, "blocks", "block_id", "text")
    return repetition.degenerate(blocks).withColumnRenamed("id", "block_id")


@LLM.add("p2_shares")
def p2_shares(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Content share and repeated share of every block."""
    return repetition.shares(table(spark, sf_dir, "blocks", "block_id", "text")).withColumnRenamed("id", "block_id")


@LLM.add("p4_found")
def p4_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of markup in the fields of every block."""
    return markup.found(table(spark, sf_dir, "blocks", "block_id", "paper_id", "text", "table_body"))


def _sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "papers", "paper_id", F.col("container_title").alias("site"))


@LLM.add("p4_clean")
def p4_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fields of every block as clean text."""
    return markup.clean(table(spark, sf_dir, "blocks", "block_id", "paper_id", "text", "table_body"), _sites(spark, sf_dir))


@LLM.add("p4_style_tree")
def p4_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Importance of every style node of every journal."""
    nodes = markup.presentation_nodes(table(spark, sf_dir, "blocks", "block_id", "paper_id", "text", "table_body"))
    return markup.style_tree(cut_lineage(markup.on_sites(nodes, _sites(spark, sf_dir))))


@LLM.add("p4_removed")
def p4_removed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Branches that the style tree removes."""
    nodes = markup.presentation_nodes(table(spark, sf_dir, "blocks", "block_id", "paper_id", "text", "table_body"))
    return markup.low_branches(cut_lineage(markup.on_sites(nodes, _sites(spark, sf_dir))))


def _name_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return names.author_strings(table(spark, sf_dir, "refs", "authors"), table(spark, sf_dir, "papers", "author"))


@LLM.add("p7_found")
def p7_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of name strings that denote one person or group."""
    return names.linked(_name_strings(spark, sf_dir))


@LLM.add("p7_entities")
def p7_entities(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every name string with the smallest string of its entity and its number of links."""
    return names.entities(_name_strings(spark, sf_dir))


_PAPER_COLUMNS = ("paper_id", "title", "abstract", "lang", "ingested_at")


@LLM.add("p1_found")
def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of a paper that its label does not name."""
    papers = table(spark, sf_dir, "papers", *_PAPER_COLUMNS)
    return languages.unnamed(papers, table(spark, sf_dir, "lang_samples", "lang", "text"))


@LLM.add("p1_segments")
def p1_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language and confidence of each title and each sentence of an abstract."""
    papers = table(spark, sf_dir, "papers", *_PAPER_COLUMNS)
    return languages.segments(papers, table(spark, sf_dir, "lang_samples", "lang", "text"))


@LLM.add("p1_mixtures")
def p1_mixtures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language proportions of every paper."""
    papers = table(spark, sf_dir, "papers", *_PAPER_COLUMNS)
    return languages.mixtures(papers, table(spark, sf_dir, "lang_samples", "lang", "text"))


_SCAN_COLUMNS = ("block_id", "paper_id", "seq", "type", "text", "page_idx", "bbox")


@LLM.add("p6_found")
def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kinds of scan noise of every block."""
    return scans.found(table(spark, sf_dir, "blocks", *_SCAN_COLUMNS))


@LLM.add("p6_repaired")
def p6_repaired(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every block's text repaired, with its type set right."""
    return scans.repaired(table(spark, sf_dir, "blocks", *_SCAN_COLUMNS))


@LLM.add("p6_paragraphs")
def p6_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Continuous paragraphs of every paper, also over page breaks."""
    return scans.paragraphs(table(spark, sf_dir, "blocks", *_SCAN_COLUMNS, "text_level"))
