"""Paper metadata: rules over early blocks, arbitration of years, fill-in priorities, slugs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import bibliography as B
from paperloom.functions import text as T

# Fixed value: pages that count as early.
EARLY_PAGES = 4
# What a year may stand beside, in the order of trust.
YEAR_SOURCES = ("citation", "copyright", "published", "accepted", "received")
#: A year, and how many signs before it tell what it is.
YEAR, YEAR_LEAD = r"(?:19|20)\d{2}", 30


def publication_year(text: Column, max_year: int) -> Column:
    """Struct (year, source): the first plausible year of the most trusted source.

    Every year is judged by what stands around it: the last word before it that tells a
    source (copyright, published, accepted, received), else the form of a citation (in
    brackets after a number or at the end, or between commas).
    """
    years, between = F.regexp_extract_all(text, F.lit(f"({YEAR})"), 1), F.split(text, YEAR, -1)
    found = F.transform(years, lambda y, i: F.struct(
        F.regexp_extract(F.right(F.get(between, i), F.lit(YEAR_LEAD)), r"([^\n]*)$", 1).alias("lead"), y.alias("year"),
        F.regexp_extract(F.get(between, i + 1), r"^([^\w\n]{0,3})", 1).alias("tail"),
    ))

    def judged(x: Column, at: Column) -> Column:
        lead, tail = F.lower(x["lead"]), x["tail"]
        word = F.regexp_extract(lead, r"(?s).*(©|\(c\)|copyright|published|accepted|received)", 1)
        cited = (lead.rlike(r"\d[\s,]*\($") & tail.startswith(")")) | (lead.rlike(r",\s*$") & tail.rlike(r"^\s*,")) | (lead.endswith("(") & tail.rlike(r"^\)[\s.;,]*$"))
        source = F.when(word.isin("©", "(c)", "copyright"), "copyright").when(word != "", word).when(cited, "citation")
        rank = F.array_position(F.array(*[F.lit(n) for n in YEAR_SOURCES]), source)
        usable = source.isNotNull() & ~x["lead"].rlike(r"\d$") & T.plausible_year(x["year"], max_year)
        return F.when(usable, F.struct(rank.alias("rank"), at.alias("at"), x["year"].cast("int").alias("year"), source.alias("source")))

    best = F.array_min(F.array_compact(F.transform(found, judged)))
    dated = text.rlike(r"(19|20)\d{2}")
    return F.when(dated, T.let(best, lambda b: F.when(b.isNotNull(), F.struct(b["year"].alias("year"), b["source"].alias("source")))))


def early(blocks: DataFrame, pages: int = EARLY_PAGES) -> DataFrame:
    """Blocks of the first pages that are no noise."""
    return blocks.where((F.coalesce("page_idx", F.lit(0)) <= pages) & ~F.col("type").isin(*T.NOISE_TYPES))


def rule_metadata(blocks: DataFrame, max_year: int, pages: int = EARLY_PAGES) -> DataFrame:
    """(paper_id, title, doi, abstract, keywords, year): what the early blocks say.

    Each field is the first block in reading order that fulfils its rule, taken as a
    minimum over (seq, value); no window and no sort of a paper is needed.
    """
    e = early(blocks, pages)
    text = T.collapse(F.col("text"))
    head = (F.col("type") == "text") & (F.coalesce("text_level", F.lit(0)) == 1) & (F.length("t") > 10)
    abstract = F.regexp_extract("t", r"(?is)^(?:abstract|summary|zusammenfassung|résumé|resumen|resumo|摘要)\s*[:.：—-]?\s*(.{50,})$", 1)
    keywords = F.regexp_extract("t", r"(?is)^(?:key ?words|index terms|palabras clave|mots-clés|schlüsselwörter|关键词)\s*[:：—-]?\s*(.+)$", 1)
    # each rule is computed once a block, then the first that holds is picked
    found = (
        e.where(F.col("text").isNotNull())
        .withColumn("t", text)
        .select(
            "paper_id", "seq", F.when(head, T.clean_title(F.col("t"))).alias("title"), B.doi(F.col("text")).alias("doi"), F.nullif(abstract, F.lit("")).alias("abstract"),
            F.nullif(keywords, F.lit("")).alias("keywords_raw"), publication_year(F.col("text"), max_year)["year"].alias("year"),
        )
    )
    first = lambda c: F.min(F.when(F.col(c).isNotNull(), F.struct("seq", F.col(c).alias("v"))))["v"].alias(c)
    return found.groupBy("paper_id").agg(*[first(c) for c in ("title", "doi", "abstract", "keywords_raw", "year")])


def keyword_list(col: Column, most: int = 10, longest: int = 60) -> Column:
    """The first ``most`` keywords of at most ``longest`` characters; longer ones are sentences."""
    parts = F.transform(F.split(col, r"[;,，；·|•\n]"), lambda k: F.trim(k))
    return F.slice(F.filter(parts, lambda k: (k != "") & (F.length(k) <= longest)), 1, most)


def fallback_abstract(rows: DataFrame) -> DataFrame:
    """(paper_id, abstract): the first paragraph of 150 characters between the title and the first section."""
    heads = rows.where(F.col("kind") == "heading")
    w = Window.partitionBy("paper_id").orderBy("seq")
    bounds = heads.withColumn("k", F.row_number().over(w)).where(F.col("k") <= 2)
    b = bounds.groupBy("paper_id").agg(F.min("seq").alias("lo"), F.max(F.when(F.col("k") == 2, F.col("seq"))).alias("hi"))
    p = rows.where((F.col("kind") == "paragraph") & (F.length("content") >= 150)).join(b, "paper_id")
    p = p.where((F.col("seq") > F.col("lo")) & (F.col("seq") < F.coalesce("hi", F.lit(2**62))))
    return p.groupBy("paper_id").agg(F.min(F.struct("seq", "sub", "content")).alias("a")).select("paper_id", F.col("a.content").alias("abstract"))


def first_filled(*cols: Column) -> Column:
    """The first value that is neither null nor empty."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def prioritised(sources: list[tuple[str, DataFrame]], fields: list[str]) -> DataFrame:
    """One row per paper_id; each field from the first source that fills it, and that source's name."""
    base = reduce(lambda a, b: a.union(b), [s.select("paper_id") for _, s in sources]).distinct()
    for name, s in sources:
        base = base.join(s.select("paper_id", *[F.col(f).alias(f"{name}__{f}") for f in fields]), "paper_id", "left")
    out = [first_filled(*[F.col(f"{n}__{f}") for n, _ in sources]).alias(f) for f in fields]
    tag = [F.coalesce(*[F.when(F.nullif(F.col(f"{n}__{f}"), F.lit("")).isNotNull(), F.lit(n)) for n, _ in sources]).alias(f"{f}_source") for f in fields]
    return base.select("paper_id", *out, *tag)


def language(title: Column, abstract: Column) -> Column:
    """``zh`` if title or abstract hold Chinese signs, else ``en``: the plain rule of metadata records."""
    return F.when(T.has_cjk(F.concat(F.coalesce(title, F.lit("")), F.coalesce(abstract, F.lit("")))), "zh").otherwise("en")


def unique_slugs(papers: DataFrame) -> DataFrame:
    """(paper_id, slug): a slug taken by an earlier paper gets a hash of the title."""
    s = T.slug(F.col("citekey"), F.get("author", F.lit(0))["name"], F.col("date"), F.col("title"))
    w = Window.partitionBy("slug").orderBy("paper_id")
    n = papers.withColumn("slug", s).withColumn("k", F.row_number().over(w))
    other = F.concat("slug", F.lit("-"), F.substring(F.md5(F.concat_ws("|", "title", "paper_id")), 1, 6))
    return n.select("paper_id", F.when(F.col("k") == 1, F.col("slug")).otherwise(other).alias("slug"))


def csl_record(item: DataFrame) -> DataFrame:
    """Bibliographic items (key, title, author, issued, …) as metadata records.

    Authors are literal names or given and family joined; the year is the first date part;
    the citation key falls back to the id unless that is a link or a bare key.
    """
    name = F.transform("author", lambda a: F.struct(F.coalesce(F.nullif(a["literal"], F.lit("")), F.trim(F.concat_ws(" ", a["given"], a["family"]))).alias("name")))
    key = F.when(~F.col("id").rlike(r"^(https?:|\d+/)"), F.col("id"))
    return item.select(
        "key", "title", F.filter(name, lambda a: a["name"] != "").alias("author"),
        F.col("issued")["date_parts"][0][0].cast("string").alias("date"), F.col("container_title"), F.col("DOI").alias("doi"),
        first_filled(F.col("citation_key"), key).alias("citekey"),
    )


def latest(papers: DataFrame) -> DataFrame:
    """Each paper's latest row."""
    cols = [c for c in papers.columns if c not in ("paper_id", "ingested_at")]
    newest = papers.groupBy("paper_id").agg(F.max(F.struct("ingested_at", *cols)).alias("r"))
    return newest.select("paper_id", *[F.col(f"r.{c}").alias(c) for c in cols], F.col("r.ingested_at").alias("ingested_at"))


def completed(papers: DataFrame, rule: DataFrame) -> DataFrame:
    """Records whose empty title, DOI, abstract, date or keywords come from the paper's own text (``rule_metadata``)."""
    r = rule.select("paper_id", *[F.col(c).alias(f"_{c}") for c in ("title", "doi", "abstract", "year", "keywords_raw")])
    out = papers.join(r, "paper_id", "left")
    for c, own in (("title", "_title"), ("doi", "_doi"), ("abstract", "_abstract"), ("date", "_year")):
        out = out.withColumn(c, first_filled(F.col(c), F.col(own).cast("string")))
    none = F.size(F.coalesce("keywords", F.array().cast("array<string>"))) == 0
    return out.withColumn("keywords", F.when(none, keyword_list(F.col("_keywords_raw"))).otherwise(F.col("keywords"))).select(papers.columns)
