"""Which pages and rows belong to an article: covers, article boundaries, digests."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import text as T

# Lines of repository cover pages and their thresholds.
COVER_MARKERS = (
    "university of technology", "citation (apa)", "document version", "important note", "takedown policy",
    "downloaded from", "for technical reasons",
)
MIN_MARKERS, PROSE_VETO, LONG_BLOCK_VETO, ANCHORED_BELOW = 3, 1500, 300, 5
# Limits and sections of article boundaries.
LEAD_MIN_CHARS, MIN_TITLE = 400, 20
TAIL_SECTIONS = (
    "abstract", "摘要", "acknowledgments", "acknowledgements", "acknowledgement", "funding", "author contributions",
    "competing interests", "conflict of interest", "conflicts of interest", "data availability", "code availability",
    "materials availability", "supplementary materials", "supplementary material", "supplemental information",
    "supporting information", "additional information", "author information", "appendix", "appendices", "glossary",
    "one sentence summary",
)


def cover_features(blocks: DataFrame, page: int = 0) -> DataFrame:
    """Per paper, of one page: markers, prose characters, longest block, rich blocks, numbered headings, text."""
    t = F.trim(F.coalesce("text", F.lit("")))
    real = blocks.where((F.coalesce("page_idx", F.lit(0)) == page) & ~F.col("type").isin(*T.NOISE_TYPES))
    marks = [F.max(F.contains(F.lower(t), F.lit(m)).cast("int")) for m in COVER_MARKERS]
    counted = real.groupBy("paper_id").agg(
        sum(marks[1:], marks[0]).alias("markers"),
        F.sum(F.length(t)).alias("prose"),
        F.max(F.length(t)).alias("longest"),
        F.max(F.col("type").isin(*T.RICH_TYPES)).alias("rich"),
        F.max(t.rlike(r"^\s*\d+(\.\d+)?\.?\s+[A-Z]\w") & (F.length(t) < 80)).alias("numbered"),
    )
    return counted


def cover_pages(blocks: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper_id, is_cover) of the first page: enough markers and no sign of an article on it."""
    f = cover_features(blocks)
    t = F.trim(F.coalesce("text", F.lit("")))
    first = blocks.where((F.coalesce("page_idx", F.lit(0)) == 0) & ~F.col("type").isin(*T.NOISE_TYPES))
    known = first.join(papers.select("paper_id", "title", "doi"), "paper_id")
    anchored = known.groupBy("paper_id").agg(
        F.max(T.title_matches(t, F.col("title")) | F.coalesce(F.contains(F.lower(t), F.lower("doi")), F.lit(False))).alias("anchored")
    )
    weak = (F.col("markers") < ANCHORED_BELOW) & F.coalesce("anchored", F.lit(False))
    cover = (
        (F.col("markers") >= MIN_MARKERS) & ~F.col("rich") & (F.col("prose") <= PROSE_VETO)
        & (F.col("longest") <= LONG_BLOCK_VETO) & ~F.col("numbered") & ~weak
    )
    return f.join(anchored, "paper_id", "left").select("paper_id", cover.alias("is_cover"))


def legacy_cover_pages(blocks: DataFrame) -> DataFrame:
    """(paper_id, page_idx) by the older rule: two markers on page 0 or 1."""
    t = F.lower(F.coalesce("text", F.lit("")))
    marks = [F.max(F.contains(t, F.lit(m)).cast("int")) for m in COVER_MARKERS]
    counted = blocks.where(F.coalesce("page_idx", F.lit(0)) <= 1).groupBy("paper_id", "page_idx").agg(sum(marks[1:], marks[0]).alias("m"))
    return counted.where(F.col("m") >= 2).select("paper_id", "page_idx")


def compare_covers(new: DataFrame, old: DataFrame) -> DataFrame:
    """Full outer comparison of two rules: same, only the new, only the old."""
    n = new.where("is_cover").select("paper_id", F.lit(1).alias("n"))
    o = old.select("paper_id", F.lit(1).alias("o")).distinct()
    diff = F.when(F.col("n").isNotNull() & F.col("o").isNotNull(), "same").when(F.col("n").isNotNull(), "new only").otherwise("old only")
    return n.join(o, "paper_id", "full_outer").select("paper_id", diff.alias("diff"))


def arbitrate(rule_cover, is_cover, confidence):
    """Cover by rule and by a second opinion: the opinion adds only with high confidence and can always withdraw."""
    return F.coalesce(is_cover, F.lit(False)) & (rule_cover | (F.lower(confidence) == "high"))


def page_digest(blocks: DataFrame, pages: int = 2, cut: int = 200, budget: int = 3500) -> DataFrame:
    """(paper_id, seq, line): typed lines of the first pages up to a running budget of characters."""
    line = F.concat(F.lit("["), F.col("type"), F.lit("] "), F.substring(F.trim("text"), 1, cut))
    rows = blocks.where((F.coalesce("page_idx", F.lit(0)) < pages) & ~F.col("type").isin(*T.NOISE_TYPES) & (F.trim("text") != ""))
    w = Window.partitionBy("paper_id").orderBy("seq", "block_id").rowsBetween(Window.unboundedPreceding, 0)
    return (
        rows.select("paper_id", "seq", "block_id", line.alias("line"))
        .withColumn("used", F.sum(F.length("line") + 1).over(w))
        .where(F.col("used") <= budget)
        .select("paper_id", "seq", "block_id", "line")
    )


def lead_cut(rows: DataFrame, papers: DataFrame) -> DataFrame:
    """(paper_id, lead_seq): rows before it belong to the article before.

    The first heading or paragraph that holds the title, if at least LEAD_MIN_CHARS of
    prose stand before it.
    """
    titled = rows.join(papers.select("paper_id", "title"), "paper_id").where(F.length(T.heading_norm(F.col("title"))) >= MIN_TITLE)
    hit = F.col("kind").isin("heading", "paragraph") & T.title_matches(F.col("content"), F.col("title"), MIN_TITLE)
    anchor = titled.where(hit).groupBy("paper_id").agg(F.min("seq").alias("lead_seq"))
    before = rows.join(anchor, "paper_id").where((F.col("seq") < F.col("lead_seq")) & (F.col("kind") == "paragraph"))
    prose = before.groupBy("paper_id", "lead_seq").agg(F.sum(F.length("content")).alias("prose"))
    return prose.where(F.col("prose") >= LEAD_MIN_CHARS).select("paper_id", "lead_seq")


def tail_cut(rows: DataFrame) -> DataFrame:
    """(paper_id, tail_seq): rows from it on belong to the next article.

    The first heading after the reference heading, unless it is a section that may stand
    there.
    """
    heads = rows.where(F.col("kind") == "heading").withColumn("h", T.heading_norm(F.col("content")))
    ref = heads.where(F.col("h").isin(*T.REFERENCE_HEADINGS)).groupBy("paper_id").agg(F.min("seq").alias("ref_seq"))
    nxt = (
        heads.join(ref, "paper_id")
        .where(F.col("seq") > F.col("ref_seq"))
        .groupBy("paper_id")
        .agg(F.min(F.struct("seq", "h")).alias("n"))
    )
    return nxt.where(~F.col("n.h").isin(*TAIL_SECTIONS)).select("paper_id", F.col("n.seq").alias("tail_seq"))


def within_article(rows: DataFrame, papers: DataFrame) -> DataFrame:
    """Rows of the article itself; page anchors always stay."""
    cut = rows.join(lead_cut(rows, papers), "paper_id", "left").join(tail_cut(rows), "paper_id", "left")
    inside = (F.col("seq") >= F.coalesce("lead_seq", F.lit(-1))) & (F.col("seq") < F.coalesce("tail_seq", F.lit(2**62)))
    return cut.where(inside | (F.col("kind") == "page_anchor")).drop("lead_seq", "tail_seq")
