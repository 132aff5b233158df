"""Queries over the corpus tables, with SQL that states the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
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
from paperloom.operators import quality as QL
from paperloom.operators import references as RF
from paperloom.operators import render as RD
from paperloom.operators import tables as TB
from paperloom.registry import Registry
from paperloom.session import table
from paperloom.sources import staging as ST

CORPUS = Registry()
MAX_YEAR = 2027


def _blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BL.one_per_position(table(spark, sf_dir, "blocks"))


def _papers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return MD.latest(table(spark, sf_dir, "papers"))


def _rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BL.intermediate(_blocks(spark, sf_dir))


def _sql_list(values: tuple[str, ...]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def _norm(x: str) -> str:
    return f"trim(lower(trim(regexp_replace({x}, '\\s+', ' ', 'g'))), ':.：。 ')"


NOISE = _sql_list(T.NOISE_TYPES)
_B = "b as (select * from blocks qualify block_id = min(block_id) over (partition by paper_id, seq))"
_P = "p as (select * from papers qualify row_number() over (partition by paper_id order by ingested_at desc) = 1)"
_CAP = """list_filter(coalesce(case when len(chart_caption) > 0 then chart_caption end, image_caption), lambda x: not regexp_matches(trim(x), '^[(（]?[A-Za-z]{1,2}[)）]?$'))"""
_TCAP = r"""array_to_string(list_filter(list_transform(table_caption, lambda x: trim(regexp_replace(x, '(?i)\(?\s*(continued|contd\.?|cont\.?|cont''d|续表|续上表|接续)\s*\)?\s*$', ''))), lambda x: x <> '' and length(x) <= 200 and not regexp_matches(x, '(?i)^(published|downloaded|received|accepted)\b|^https?://|^view (article|this) |^doi\b')), ' ')"""
_IR = f"""{_B},
rs as (select paper_id, min(seq) as ref_seq from b where type = 'text' and coalesce(text_level, 0) > 0 and {_norm('text')} in {_sql_list(T.REFERENCE_HEADINGS)} group by 1),
k as (select b.*, coalesce(b.seq > rs.ref_seq, false) as after_ref from b left join rs using (paper_id) where type not in {NOISE}),
k2 as (select paper_id, seq,
  case when type = 'text' and coalesce(text_level, 0) > 0 then 'heading' when type = 'ref_text' then 'reference'
       when type in ('text', 'list') and after_ref then 'reference' when type in ('text', 'list') then 'paragraph'
       when type = 'page_footnote' then 'footnote' when type in ('image', 'chart') then 'image' else type end as kind,
  coalesce(text_level, 0) as level, coalesce(page_idx, 0) as page_idx,
  case when type in ('image', 'chart') then
    array_to_string(case when len(list_filter({_CAP}, lambda x: regexp_matches(x, '(?i)^(Fig(ure)?\\.?)\\s*\\d+'))) = 1
      then list_concat(list_filter({_CAP}, lambda x: regexp_matches(x, '(?i)^(Fig(ure)?\\.?)\\s*\\d+')), list_filter({_CAP}, lambda x: not regexp_matches(x, '(?i)^(Fig(ure)?\\.?)\\s*\\d+')))
      else {_CAP} end, ' ')
    when type = 'table' then {_TCAP} end as caption,
  case when type = 'list' and len(list_items) > 0 then list_items else [case when type = 'table' then table_body else text end] end as items from k),
k3 as (select paper_id, seq, kind, level, page_idx, caption, unnest(items) as content, generate_subscripts(items, 1) as sub from k2),
ir as (select paper_id, seq, kind, level, page_idx, caption, content, sub from k3 where trim(coalesce(content, '')) <> '' or kind in ('image', 'table')
  union all select paper_id, min(seq), 'page_anchor', 0, coalesce(page_idx, 0), null, cast(coalesce(page_idx, 0) as varchar), 0 from b where type not in {NOISE} group by paper_id, coalesce(page_idx, 0))"""


@CORPUS.add("ir_rows", f"with {_IR} select paper_id, seq, sub, kind, level, page_idx, caption, length(content) as chars from ir")
def ir_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The intermediate rows of every paper."""
    return _rows(spark, sf_dir).select("paper_id", "seq", "sub", "kind", "level", "page_idx", "caption", F.length("content").alias("chars"))


@CORPUS.add("ir_kinds", f"with {_IR} select paper_id, kind, count(*) as n from ir group by 1, 2")
def ir_kinds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per paper and kind."""
    return _rows(spark, sf_dir).groupBy("paper_id", "kind").agg(F.count("*").alias("n"))


@CORPUS.add(
    "layout_types",
    """with r as (select block_id, type as label, coalesce(text, '') as content from blocks),
    t as (select block_id, label, case when content like 'http://%' or content like 'https://%' then 'image'
      when label in ('image', 'chart') then 'image' when label in ('header', 'footer', 'page_number', 'aside_text', 'page_footnote', 'equation', 'table') then label else 'text' end as type,
      trim(replace(regexp_replace(regexp_replace(content, '</?div[^>]*>', '', 'g'), '\\$ +([^$]+?) +\\$', '$\\1$', 'g'), '\\n', ' ')) as txt from r),
    u as (select *, case when type = 'text' then regexp_replace(txt, '^#{1,6}\\s+', '') else txt end as txt2 from t)
    select type, count(*) as n, cast(sum(length(txt2)) as bigint) as chars from u where type in ('header', 'footer', 'page_number', 'aside_text', 'page_footnote', 'image') or txt2 <> '' group by 1""",
)
def layout_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks by the type their layout label means, with the characters that cleaning leaves."""
    raw = table(spark, sf_dir, "blocks", "block_id", "type", "text").select("block_id", F.col("type").alias("label"), F.coalesce("text", F.lit("")).alias("content"))
    return BL.convert_layout(raw).groupBy("type").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@CORPUS.add("coordinate_space", "select paper_id, case when max(list_max(bbox)) > 1001 then 'paddleocr' when max(list_max(bbox)) > 0 then 'mineru' end as space from blocks group by 1")
def coordinate_space(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit of each paper's boxes."""
    return BL.coordinate_space(table(spark, sf_dir, "blocks", "paper_id", "bbox"))


@CORPUS.add(
    "page_rectangles",
    """select block_id, cast(floor(greatest(0, least(case when coord_space = 'mineru' then bbox[1] * 595 / 1000 else bbox[1] * 0.5 end - 5, 595))) as int) as x0,
    cast(floor(greatest(0, least(case when coord_space = 'mineru' then bbox[4] * 842 / 1000 else bbox[4] * 0.5 end + 5, 842))) as int) as y1 from blocks where len(bbox) = 4""",
)
def page_rectangles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes of blocks in page points."""
    b = table(spark, sf_dir, "blocks", "block_id", "bbox", "coord_space").where(F.size("bbox") == 4)
    r = BL.rectangle(F.col("bbox"), F.col("coord_space"), F.lit(595.0), F.lit(842.0))
    return b.select("block_id", r.alias("r")).select("block_id", F.floor("r.x0").cast("int").alias("x0"), F.floor("r.y1").cast("int").alias("y1"))


@CORPUS.add("caption_targets")
def caption_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free figure captions among text blocks with the image they belong to."""
    b = _blocks(spark, sf_dir)
    kind = F.when(F.col("text").rlike(r"(?i)^Fig(ure|\.)?\s*\d"), "fig_caption").when(F.col("type").isin("image", "chart"), "image").otherwise(F.col("type"))
    has = (F.size(F.coalesce("image_caption", F.array().cast("array<string>"))) + F.size(F.coalesce("chart_caption", F.array().cast("array<string>")))) > 0
    return BL.bind_captions(b.select("paper_id", "page_idx", "seq", kind.alias("type"), has.alias("has_caption")))


# ---- tables


_CELLS = r"(?is)<t[dh][^>]*>.*?</t[dh]>"
_TROWS = r"(?is)<tr[^>]*>.*?</tr>"
_CELL_SQL = f"""r as (select block_id, unnest(regexp_extract_all(table_body, '{_TROWS}')) as tr, generate_subscripts(regexp_extract_all(table_body, '{_TROWS}'), 1) as row_no from blocks where type = 'table'),
c as (select block_id, row_no, unnest(regexp_extract_all(tr, '{_CELLS}')) as td, generate_subscripts(regexp_extract_all(tr, '{_CELLS}'), 1) as col_no from r),
d as (select block_id, row_no, col_no, trim(regexp_replace(regexp_replace(td, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) as cell,
  coalesce(try_cast(nullif(regexp_extract(td, '(?i)^<t[dh][^>]*colspan\\s*=\\s*["'']?(\\d+)', 1), '') as int), 1) as span from c)"""


@CORPUS.add("table_cells", f"with {_CELL_SQL} select block_id, row_no, col_no, cell, span from d")
def table_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every cell of every HTML table."""
    return TB.cell_rows(table(spark, sf_dir, "blocks", "block_id", "type", "table_body"))


@CORPUS.add(
    "table_shape",
    f"""with {_CELL_SQL}, w as (select block_id, row_no, sum(span) as width, count(*) as cells from d group by 1, 2),
    n as (select block_id, count(*) as n_rows from r group by 1)
    select n.block_id, n.n_rows, cast(coalesce(max(w.width), 0) as int) as n_cols, cast(coalesce(sum(w.cells), 0) as int) as n_cells from n left join w using (block_id) group by 1, 2""",
)
def table_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows, columns and cells of every HTML table."""
    return TB.shape(table(spark, sf_dir, "blocks", "block_id", "type", "table_body")).where("n_rows > 0")


@CORPUS.add("tables_merged")
def tables_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables with the pages they continue on, as one."""
    return TB.merged(_rows(spark, sf_dir)).select("paper_id", "seq", "parts", F.length("content").alias("chars"))


_TNUM = "nullif(regexp_extract(caption, '(?i)(?:table|tab\\.|exhibit|表)\\s*(\\d+)', 1), '')"


@CORPUS.add(
    "table_numbers",
    f"""with {_IR}, c as (select distinct paper_id, unnest(regexp_extract_all(content, 'Table\\s*(\\d+)', 1)) as n from ir where kind = 'paragraph'),
    t as (select paper_id, seq, {_TNUM} as n from ir where kind = 'table'),
    pool as (select paper_id, n, row_number() over (partition by paper_id order by cast(n as int)) as rank from c where not exists (select 1 from t where t.paper_id = c.paper_id and t.n = c.n)),
    free as (select paper_id, seq, row_number() over (partition by paper_id order by seq) as rank from t where n is null)
    select paper_id, seq, cast(n as int) as number from free join pool using (paper_id, rank)""",
)
def table_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cited numbers given to unnumbered tables in order."""
    return TB.number_tables(_rows(spark, sf_dir))


@CORPUS.add("table_prose")
def table_prose(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sentences and headings that stand in table cells."""
    return TB.rescued_cells(table(spark, sf_dir, "blocks", "block_id", "type", "table_body"))


# ---- pages and article boundaries


def _mark(m: str) -> str:
    return "max(case when contains(lower(t), '" + m.replace("'", "''") + "') then 1 else 0 end)"


_FEATURES = f"""f as (select paper_id, {' + '.join(_mark(m) for m in PG.COVER_MARKERS)} as markers, cast(sum(length(t)) as bigint) as prose, max(length(t)) as longest,
  max(type in ('image', 'equation', 'table')) as rich, max(regexp_matches(t, '^\\s*\\d+(\\.\\d+)?\\.?\\s+[A-Z]\\w') and length(t) < 80) as numbered
  from (select *, trim(coalesce(text, '')) as t from b where coalesce(page_idx, 0) = 0 and type not in {NOISE}) group by 1)"""


@CORPUS.add("cover_features", f"with {_B}, {_FEATURES} select * from f")
def cover_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the first page of every paper looks like."""
    return PG.cover_features(_blocks(spark, sf_dir))


@CORPUS.add(
    "cover_pages",
    f"""with {_B}, {_P}, {_FEATURES}, a as (select b.paper_id, max(coalesce(length({_norm('p.title')}) >= 15 and contains(lower(trim(regexp_replace(trim(coalesce(text, '')), '\\s+', ' ', 'g'))), lower(trim(regexp_replace(p.title, '\\s+', ' ', 'g')))), false)
      or coalesce(contains(lower(trim(coalesce(text, ''))), lower(p.doi)), false)) as anchored from b join p using (paper_id) where coalesce(page_idx, 0) = 0 and type not in {NOISE} group by 1)
    select f.paper_id, markers >= 3 and not rich and prose <= 1500 and longest <= 300 and not numbered and not (markers < 5 and coalesce(anchored, false)) as is_cover from f left join a using (paper_id)""",
)
def cover_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether the first page is a repository's cover."""
    return PG.cover_pages(_blocks(spark, sf_dir), _papers(spark, sf_dir))


@CORPUS.add("cover_rules_compared")
def cover_rules_compared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers by whether the present and the older cover rule agree."""
    b = _blocks(spark, sf_dir)
    return PG.compare_covers(PG.cover_pages(b, _papers(spark, sf_dir)), PG.legacy_cover_pages(b))


@CORPUS.add(
    "page_digest",
    f"""with {_B}, r as (select paper_id, seq, block_id, '[' || type || '] ' || substr(trim(text), 1, 200) as line from b where coalesce(page_idx, 0) < 2 and type not in {NOISE} and trim(text) <> ''),
    u as (select *, sum(length(line) + 1) over (partition by paper_id order by seq, block_id rows unbounded preceding) as used from r)
    select paper_id, seq, block_id, line from u where used <= 3500""",
)
def page_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed lines of the first two pages up to a budget of characters."""
    return PG.page_digest(_blocks(spark, sf_dir))


@CORPUS.add(
    "article_tail",
    f"""with {_IR}, h as (select paper_id, seq, {_norm('content')} as h from ir where kind = 'heading'),
    r as (select paper_id, min(seq) as ref_seq from h where h in {_sql_list(T.REFERENCE_HEADINGS)} group by 1),
    n as (select h.paper_id, arg_min(h.h, h.seq) as h, min(h.seq) as tail_seq from h join r using (paper_id) where h.seq > r.ref_seq group by 1)
    select paper_id, tail_seq from n where h not in {_sql_list(PG.TAIL_SECTIONS)}""",
)
def article_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where the next article begins after a reference list."""
    return PG.tail_cut(_rows(spark, sf_dir))


@CORPUS.add("article_rows")
def article_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per paper and kind inside the article's boundaries."""
    return PG.within_article(_rows(spark, sf_dir), _papers(spark, sf_dir)).groupBy("paper_id", "kind").agg(F.count("*").alias("n"))


# ---- headings


_HEADS = "h as (select paper_id, seq, content, level as given from ir where kind = 'heading')"
_FIX, _ANC = _sql_list(T.FIXED_SECTIONS), _sql_list(T.BODY_ANCHORS)
_LEVELS = f"""{_HEADS}, h1 as (select *, {_norm('content')} as n, nullif(regexp_extract(content, '^(\\d+(?:\\.\\d+)*)\\.?\\s+\\S', 1), '') as dotted from h),
h2 as (select *, case when n in {_FIX} then 1 when regexp_matches(content, '^([IVX]+)\\.\\s+\\S') then 1 when regexp_matches(content, '^[A-Z]\\.\\s+\\S') then 2
  when dotted is not null then least(len(string_split(dotted, '.')), 6) when n in {_ANC} then 1 end as own from h1),
h3 as (select *, max(case when n in {_ANC} then 1 else 0 end) over w as anchored, last_value(own ignore nulls) over w as last_own from h2 window w as (partition by paper_id order by seq rows between unbounded preceding and 1 preceding)),
lv as (select paper_id, seq, content, coalesce(own, case when regexp_matches(content, '^[（(]\\d+[）)]\\.?\\s+\\S') then least(coalesce(last_own, 1) + 1, 6) end,
  case when coalesce(anchored, 0) = 1 then 2 else greatest(1, given) end) as level from h3)"""


@CORPUS.add("heading_levels", f"with {_IR}, {_LEVELS} select paper_id, seq, content, level from lv")
def heading_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Level of every heading."""
    return HD.levels(_rows(spark, sf_dir))


_PREFIX = "(regexp_matches(content, '^\\d+(\\.\\d+)*\\.?\\s+\\S') or regexp_matches(content, '^[IVXLC]+\\.\\s+\\S') or regexp_matches(content, '^[A-Z]\\.\\s+\\S'))"


@CORPUS.add(
    "heading_numbers",
    f"""with {_IR}, {_LEVELS}, np as (select paper_id, (count(*) filter (where {_PREFIX}) >= greatest(2, ceil(count(*) * 0.2))) or (count(*) filter (where regexp_matches(content, '^([IVX]+)\\.\\s+\\S')) >= 2) as numbered from lv group by 1),
    c as (select lv.*, level = 1 and {_norm('content')} not in {_FIX} and not numbered as counts from lv join np using (paper_id))
    select paper_id, seq, cast(case when counts then sum(case when counts then 1 else 0 end) over (partition by paper_id order by seq rows unbounded preceding) end as bigint) as number,
    case when counts then cast(sum(case when counts then 1 else 0 end) over (partition by paper_id order by seq rows unbounded preceding) as varchar) || '. ' || content else content end as content from c""",
)
def heading_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Running numbers for the top sections of papers that have none."""
    return HD.add_numbers(HD.levels(_rows(spark, sf_dir)))


_LOWC = "trim(regexp_replace(lower(content), '\\s+', ' ', 'g'))"
_HEADING_NOISE = f"""(coalesce(regexp_extract({_LOWC}, '^([a-z]+)', 1) in {_sql_list(T.HEADING_LABELS)}, false)
  or (regexp_matches({_LOWC}, '^\\d') and (contains({_LOWC}, 'permissions') or contains({_LOWC}, 'terms of service') or contains({_LOWC}, 'view the article')))
  or regexp_matches(trim(content), '^[A-Z][a-z]+ \\d+ ?\\('))"""


@CORPUS.add(
    "heading_classes",
    f"""with {_IR}, {_P}, l as (select paper_id, seq, kind, content, lag(kind) over (partition by paper_id order by seq, sub) as prev_kind from ir where kind <> 'page_anchor'),
    q as (select l.*, {_norm('content')} as hn, {_norm('p.title')} as tn, row_number() over (partition by l.paper_id order by seq) as nth from l left join p using (paper_id) where kind = 'heading')
    select paper_id, seq, content, case when {_HEADING_NOISE} then 'noise'
      when coalesce(hn = tn, false) and nth > 1 then 'title again' when regexp_matches(content, '(?i)^(fig(ure)?\\.?|table|scheme)\\s*\\d') then 'caption'
      when nth = 2 and not ({_PREFIX} or hn in {_sql_list(T.SECTION_WORDS)}) and prev_kind = 'heading' then 'subtitle' else 'section' end as class from q""",
)
def heading_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Headings by class."""
    return HD.classify(_rows(spark, sf_dir), _papers(spark, sf_dir))


@CORPUS.add("heading_hierarchy")
def heading_hierarchy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dotted numbers of all headings."""
    return HD.hierarchical_numbers(HD.levels(_rows(spark, sf_dir)))


@CORPUS.add("paragraphs_merged")
def paragraphs_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs joined with the pieces they run on in."""
    m = HD.merge_fragments(_rows(spark, sf_dir))
    return m.select("paper_id", "seq", "sub", "parts", F.length("content").alias("chars"))


@CORPUS.add(
    "figure_legends",
    f"""with {_IR} select paper_id, seq, regexp_extract(content, '^(?:Fig(?:ure)?\\.?|FIG\\.?)\\s*(\\d+(?:\\.\\d+)*)\\s*[.:]\\s', 1) as number, content from ir
    where kind = 'paragraph' and regexp_extract(content, '^(?:Fig(?:ure)?\\.?|FIG\\.?)\\s*(\\d+(?:\\.\\d+)*)\\s*[.:]\\s', 1) <> '' and length(content) > 40""",
)
def figure_legends(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs that are a figure's legend."""
    return HD.split_legends(_rows(spark, sf_dir))


@CORPUS.add("stray_paragraphs")
def stray_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prose among numbered references with the place it moves to."""
    return HD.stray_paragraphs(_rows(spark, sf_dir))


# ---- figures


_FNUM = "nullif(regexp_extract(caption, '(?i)\\bFig(?:ure|\\.)?\\s*(\\d+(?:\\.\\d+)*)', 1), '')"
_FIGS = f"""i as (select paper_id, seq, page_idx, {_FNUM} as own from ir where kind = 'image'),
i2 as (select *, case when coalesce(page_idx - lag(page_idx) over w > 1, false) or lag(own) over w is not null then 1 else 0 end as brk from i window w as (partition by paper_id order by seq)),
g as (select *, sum(brk) over (partition by paper_id order by seq rows unbounded preceding) as grp from i2),
fn as (select paper_id, seq, max(own) over (partition by paper_id, grp) as number, row_number() over (partition by paper_id, grp order by seq) as k, count(*) over (partition by paper_id, grp) as n from g),
fp as (select paper_id, seq, number, case when number is not null then case when n > 1 and k <= 26 then substr('abcdefghijklmnopqrstuvwxyz', k, 1) else '' end end as panel from fn)"""


@CORPUS.add("figure_numbers", f"with {_IR}, {_FIGS} select paper_id, seq, number, panel from fp")
def figure_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figure number and panel of every image."""
    return FG.number_figures(_rows(spark, sf_dir))


@CORPUS.add(
    "figure_names",
    f"""with {_IR}, {_FIGS}, s as (select paper_id, seq, 'fig' || replace(number, '.', '-') || panel as stem from fp where number is not null),
    r as (select *, row_number() over (partition by paper_id, stem order by seq) as nth from s) select paper_id, seq, case when nth = 1 then stem else stem || '-' || nth end as name from r""",
)
def figure_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """File names of the images."""
    return FG.figure_names(FG.number_figures(_rows(spark, sf_dir)))


@CORPUS.add(
    "figure_gaps",
    f"""with {_IR}, h as (select paper_id, try_cast({_FNUM} as int) as n from ir where kind = 'image'), s as (select paper_id, list(distinct n) as have, min(n) as lo, max(n) as hi from h where n is not null group by 1),
    u as (select paper_id, have, unnest(generate_series(lo, hi)) as missing from s) select paper_id, cast(missing as int) as missing from u where not list_contains(have, missing)""",
)
def figure_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figure numbers that a paper skips."""
    return FG.figure_gaps(_rows(spark, sf_dir))


@CORPUS.add("figure_runs")
def figure_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boxes around images that belong together."""
    rows = _rows(spark, sf_dir)
    u = FG.union_boxes(FG.proximity_runs(rows), _blocks(spark, sf_dir).select("paper_id", "seq", "bbox"))
    return u.select("paper_id", "page_idx", "run", "n", *[F.round(c, 3).alias(c) for c in ("x0", "y0", "x1", "y1")])


# ---- bibliography


_DOI = r"rtrim(regexp_extract(raw, '(10\.\d{4,9}/[^\s\"''<>\[\]]+)', 1), '.,;:')"
_DOI_SQL = f"""nullif(substr({_DOI}, 1, length({_DOI}) - greatest(0, least(length(regexp_extract({_DOI}, '(\\)*)$', 1)), length({_DOI}) - length(replace({_DOI}, ')', '')) - (length({_DOI}) - length(replace({_DOI}, '(', '')))))), '')"""


@CORPUS.add(
    "reference_identifiers",
    f"""select ref_id, {_DOI_SQL} as doi_found,
    coalesce(nullif(regexp_extract(raw, '(?i)arXiv:\\s*(\\d{{4}}\\.\\d{{4,5}})(?:v\\d+)?', 1), ''), nullif(regexp_extract(raw, '(?i)arXiv:\\s*([a-z\\-]+(?:\\.[A-Z]{{2}})?/\\d{{7}})(?:v\\d+)?', 1), '')) as arxiv_found,
    try_cast(regexp_extract(raw, '(?:^|[^\\d./])((?:19|20)\\d{{2}})(?:[^\\d]|$)', 1) as int) as year_found,
    coalesce(nullif(regexp_extract(raw, '^\\s*\\[(\\d{{1,4}})\\]', 1), ''), nullif(regexp_extract(raw, '^\\s*(\\d{{1,4}})[.\\)]\\s', 1), ''), nullif(regexp_extract(raw, '^\\s*(\\d{{1,4}})\\s+[A-Z]', 1), '')) as number_found from refs""",
)
def reference_identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DOI, arXiv id, year and number of every raw entry."""
    return RF.identifiers(table(spark, sf_dir, "refs", "ref_id", "raw")).drop("raw")


@CORPUS.add("reference_entries")
def reference_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries split out of the reference rows of every paper."""
    return RF.split_entries(_rows(spark, sf_dir))


@CORPUS.add(
    "reference_bracket_entries",
    f"""with {_IR}, r as (select paper_id, unnest(string_split(regexp_replace(content, '(\\[\\d{{1,4}}\\]\\s+[A-Z"''(])', chr(1) || '\\1', 'g'), chr(1))) as x from ir where kind = 'reference')
    select distinct paper_id, cast(regexp_extract(trim(x), '^\\[(\\d{{1,4}})\\]', 1) as int) as n, trim(x) as raw from r where regexp_extract(trim(x), '^\\[(\\d{{1,4}})\\]', 1) <> '' and length(trim(x)) >= 6""",
)
def reference_bracket_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Entries of bracketed lists, split by expressions alone."""
    return RF.bracket_entries(_rows(spark, sf_dir))


@CORPUS.add("reference_join")
def reference_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw entries joined with parsed fields, the raw text's DOI first."""
    refs = table(spark, sf_dir, "refs", "ref_id", "paper_id", "n", "raw", "title", "authors", "year", "venue", "doi")
    w = Window.partitionBy("paper_id").orderBy("ref_id")
    entries = refs.select("paper_id", F.row_number().over(w).alias("pos"), "n", "raw")
    items = refs.select("paper_id", F.row_number().over(w).alias("item_pos"), "n", "title", "authors", "year", "venue", "doi")
    return RF.join_items(entries, items).select("paper_id", "pos", "n", "source", "title", F.size("authors").alias("n_authors"), "year", "venue", "doi", "arxiv_id")


@CORPUS.add("reference_payload")
def reference_payload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The reference list of each paper as one document."""
    return RF.payload(table(spark, sf_dir, "refs"))


@CORPUS.add("reference_share", "select paper_id, count(*) as entries, cast(sum(length(text)) as bigint) as chars from blocks where type = 'ref_text' and length(trim(regexp_replace(text, '\\s+', ' ', 'g'))) > 0 group by 1")
def reference_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bibliography rows and characters per paper."""
    return RF.reference_text_share(table(spark, sf_dir, "blocks", "paper_id", "type", "text"))


@CORPUS.add("packed_references", r"select ref_id, len(regexp_extract_all(raw, '\[\d{1,4}\]\s+[A-Z]')) as marks from refs where len(regexp_extract_all(raw, '\[\d{1,4}\]\s+[A-Z]')) >= 2")
def packed_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw entries that hold several numbered entries."""
    return QL.packed_reference_paragraphs(table(spark, sf_dir, "refs", "ref_id", "raw"))


# ---- metadata


@CORPUS.add("rule_metadata")
def rule_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata that the early blocks of every paper state."""
    return MD.rule_metadata(_blocks(spark, sf_dir), MAX_YEAR)


@CORPUS.add("metadata_priority")
def metadata_priority(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and DOI from the authority record, else from the text."""
    auth = _papers(spark, sf_dir).select("paper_id", "title", "doi", "abstract")
    rule = MD.rule_metadata(_blocks(spark, sf_dir), MAX_YEAR).select("paper_id", "title", "doi", "abstract")
    return MD.prioritised([("authority", auth), ("text", rule)], ["title", "doi", "abstract"])


@CORPUS.add(
    "metadata_filled",
    f"""with {_P} select paper_id, nullif(title, '') as title, coalesce(nullif(container_title, ''), 'unknown') as container, coalesce(nullif(doi, ''), 'none') as doi,
    case when regexp_matches(coalesce(title, '') || coalesce(abstract, ''), '[一-鿿]') then 'zh' else 'en' end as plain_lang from p""",
)
def metadata_filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest records with empty values replaced."""
    return _papers(spark, sf_dir).select(
        "paper_id", F.nullif("title", F.lit("")).alias("title"), MD.first_filled(F.col("container_title"), F.lit("unknown")).alias("container"),
        MD.first_filled(F.col("doi"), F.lit("none")).alias("doi"), MD.language(F.col("title"), F.col("abstract")).alias("plain_lang"),
    )


@CORPUS.add(
    "paper_slugs",
    f"""with {_P}, s as (select paper_id, title, case when trim(regexp_replace(coalesce(citekey, ''), '[<>:"/\\\\|?*\\x00-\\x1f]', '', 'g')) <> '' then trim(regexp_replace(coalesce(citekey, ''), '[<>:"/\\\\|?*\\x00-\\x1f]', '', 'g')) else 'x' end as slug from p),
    n as (select *, row_number() over (partition by slug order by paper_id) as k from s)
    select paper_id, case when k = 1 then slug else slug || '-' || substr(md5(concat_ws('|', title, paper_id)), 1, 6) end as slug from n""",
)
def paper_slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A unique slug for every paper."""
    return MD.unique_slugs(_papers(spark, sf_dir))


@CORPUS.add(
    "fallback_abstracts",
    f"""with {_IR}, hd as (select paper_id, seq, row_number() over (partition by paper_id order by seq) as k from ir where kind = 'heading'),
    bo as (select paper_id, min(seq) as lo, max(case when k = 2 then seq end) as hi from hd where k <= 2 group by 1)
    select ir.paper_id, ir.content as abstract from ir join bo using (paper_id) where kind = 'paragraph' and length(content) >= 150 and seq > lo and seq < coalesce(hi, 9223372036854775807)
    qualify row_number() over (partition by ir.paper_id order by seq, sub, content) = 1""",
)
def fallback_abstracts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First long paragraph between title and first section."""
    return MD.fallback_abstract(_rows(spark, sf_dir))


_YEARS = """x0 as (select ref_id, raw, regexp_extract_all(raw, '({c})', 1) as years, regexp_split_to_array(raw, '{c}') as betw from refs),
x1 as (select ref_id, betw, generate_subscripts(years, 1) as k, unnest(years) as yr from x0),
x as (select ref_id, k, yr, regexp_extract(right(betw[k], {l}), '([^\\n]*)$', 1) as ld, regexp_extract(betw[k + 1], '^([^\\w\\n]{0,3})', 1) as tl from x1),
y as (select *, regexp_extract(lower(ld), '(?s).*(©|\\(c\\)|copyright|published|accepted|received)', 1) as word,
  (regexp_matches(lower(ld), '\\d[\\s,]*\\($') and tl like ')%') or (regexp_matches(ld, ',\\s*$') and regexp_matches(tl, '^\\s*,')) or (ld like '%(' and regexp_matches(tl, '^\\)[\\s.;,]*$')) as cited from x),
z as (select ref_id, k, cast(yr as int) as year, case when word in ('©', '(c)', 'copyright') then 'copyright' when word <> '' then word when cited then 'citation' end as source from y
  where not regexp_matches(ld, '\\d$') and cast(yr as int) between 1900 and {m}),
w as (select *, list_position(['citation', 'copyright', 'published', 'accepted', 'received'], source) as rank from z where source is not null)""".replace("{c}", MD.YEAR).replace("{l}", str(MD.YEAR_LEAD)).replace("{m}", str(MAX_YEAR))


@CORPUS.add("reference_years", f"with {_YEARS}, b as (select * from w qualify row_number() over (partition by ref_id order by rank, k) = 1) select r.ref_id, b.year, b.source from refs r left join b using (ref_id)")
def reference_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Year and its source of every raw entry by the arbitration of publication years."""
    y = MD.publication_year(F.col("raw"), MAX_YEAR)
    return table(spark, sf_dir, "refs", "ref_id", "raw").select("ref_id", y.alias("y")).select("ref_id", "y.year", "y.source")


@CORPUS.add("author_lines")
def author_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names parsed from each paper's author line."""
    line = F.array_join(F.transform("author", lambda a: F.coalesce(a["name"], F.lit(""))), "; ")
    return _papers(spark, sf_dir).select("paper_id", F.posexplode(T.parse_authors(line)).alias("pos", "name"))


# ---- links


_ANCHOR = """case when kind = 'heading' then 'sec-' || nullif(substr(trim(regexp_replace(lower(content), '[^\\p{L}\\p{N}]+', '-', 'g'), '-'), 1, 80), '')
 when kind = 'reference' then 'ref-' || coalesce(nullif(regexp_extract(content, '^\\s*\\[(\\d{1,4})\\]', 1), ''), nullif(regexp_extract(content, '^\\s*(\\d{1,4})[.\\)]\\s', 1), ''), nullif(regexp_extract(content, '^\\s*(\\d{1,4})\\s+[A-Z]', 1), ''))
 when kind = 'image' then 'fig-' || nullif(regexp_extract(caption, '(?i)^\\s*(?:Figure|Fig\\.?)\\s*(\\d+(?:\\.\\d+)*)', 1), '')
 when kind = 'table' then 'tab-' || nullif(regexp_extract(caption, '(?i)(?:table|tab\\.|exhibit|表)\\s*(\\d+)', 1), '')
 when kind = 'equation' then 'eq-' || trim(nullif(regexp_extract(content, '\\\\tag\\*?\\s*\\{([^{}]*)\\}', 1), '')) end"""


@CORPUS.add("anchors", f"with {_IR}, a as (select paper_id, seq, {_ANCHOR} as anchor from ir) select paper_id, anchor, min(seq) as seq from a where anchor is not null group by 1, 2")
def anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row of every anchor."""
    return LK.anchors(_rows(spark, sf_dir))


_MENTIONS = r"""m as (select distinct paper_id, seq, sub, category, number from (
 select paper_id, seq, sub, 'ref' as category, unnest(regexp_split_to_array(g, '\s*[,;]\s*')) as number from (select paper_id, seq, sub, unnest(regexp_extract_all(content, '\[(\d{1,4}(?:\s*[,;]\s*\d{1,4})*)\]', 1)) as g from ir where kind = 'paragraph')
 union all select paper_id, seq, sub, 'fig', unnest(regexp_extract_all(content, '(?:Figure|Fig\.)\s*(\d+)', 1)) from ir where kind = 'paragraph'
 union all select paper_id, seq, sub, 'tab', unnest(regexp_extract_all(content, 'Table\s*(\d+)', 1)) from ir where kind = 'paragraph'
 union all select paper_id, seq, sub, 'eq', unnest(regexp_extract_all(content, 'Eq\.\s*\((\d+)\)', 1)) from ir where kind = 'paragraph'))"""
_TARGETS = f"""t0 as (select paper_id, seq, {_ANCHOR} as a from ir), t as (select paper_id, string_split(a, '-')[1] as category, regexp_replace(a, '^[a-z]+-', '') as number, seq from t0 where a not like 'sec-%'),
one as (select paper_id, category, number, min(seq) as target_seq from t group by 1, 2, 3 having count(*) = 1)"""


@CORPUS.add("links_resolved", f"with {_IR}, {_MENTIONS}, {_TARGETS} select m.*, one.target_seq from m left join one using (paper_id, category, number)")
def links_resolved(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations of references, figures, tables and equations with their targets, where unique."""
    rows = _rows(spark, sf_dir)
    return LK.resolve(LK.mentions(rows), LK.targets_of(rows)).select("paper_id", "seq", "sub", "category", "number", "target_seq")


@CORPUS.add("link_stats", f"with {_IR}, {_MENTIONS}, {_TARGETS} select category, count(target_seq) as ok, cast(sum(case when target_seq is null then 1 else 0 end) as bigint) as dropped from m left join one using (paper_id, category, number) group by 1")
def link_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolved and dropped links per category."""
    rows = _rows(spark, sf_dir)
    return LK.link_stats(LK.resolve(LK.mentions(rows), LK.targets_of(rows)))


@CORPUS.add(
    "unique_citations",
    f"""with {_IR}, c as (select paper_id, page_idx, seq, unnest(regexp_extract_all(content, '\\[(\\d{{1,4}})\\]', 1)) as number from ir where kind in ('paragraph', 'footnote', 'heading')),
    s as (select paper_id, page_idx, number, seq from c union all select paper_id, page_idx + 1, number, seq from c) select paper_id, page_idx, number, min(seq) as seq from s group by 1, 2, 3 having count(*) = 1""",
)
def unique_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Citations that stand once on their page and the one before."""
    return LK.unique_citations(_rows(spark, sf_dir))


@CORPUS.add(
    "linked_citations",
    f"""with {_IR} select paper_id, seq, sub, regexp_replace(content, '\\[(\\d{{1,4}})\\]', '[[\\1]](#ref-\\1)', 'g') as linked from ir where kind = 'paragraph' and regexp_matches(content, '\\[\\d{{1,4}}\\]') and not contains(content, '$')""",
)
def linked_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs with linked citations."""
    return LK.linked_citations(_rows(spark, sf_dir))


_PTS = "pt as (select block_id as link_id, paper_id, page_idx, (bbox[1] + bbox[3]) / 2 as x, bbox[4] + 4 as y from b where type in ('image', 'chart') and len(bbox) = 4)"


@CORPUS.add(
    "covering_blocks",
    f"""with {_B}, {_PTS}, j as (select pt.link_id, b.block_id, greatest(0, b.bbox[2] - y, y - b.bbox[4]) as dy, greatest(0, b.bbox[1] - x, x - b.bbox[3]) as dx from pt join b using (paper_id, page_idx) where len(b.bbox) = 4)
    select link_id, block_id, dy + dx = 0 as inside from j qualify row_number() over (partition by link_id order by dy, dx, block_id) = 1""",
)
def covering_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The block under or nearest to the point just below each image."""
    b = _blocks(spark, sf_dir)
    at = lambda i: F.get("bbox", F.lit(i))
    pts = b.where(F.col("type").isin("image", "chart") & (F.size("bbox") == 4)).select(
        F.col("block_id").alias("link_id"), "paper_id", "page_idx", ((at(0) + at(2)) / 2).alias("x"), (at(3) + 4).alias("y")
    )
    return LK.covering_blocks(pts, b)


# ---- quality


@CORPUS.add("degenerate_lines")
def degenerate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long lines of blocks that repeat one unit."""
    return QL.degenerate_lines(table(spark, sf_dir, "blocks", "block_id", "text"), "block_id", "text").withColumnRenamed("id", "block_id")


@CORPUS.add(
    "equation_faults",
    r"""with e as (select block_id, text as t from blocks where type = 'equation' and text is not null),
    n as (select *, len(regexp_extract_all(t, '\{')) - len(regexp_extract_all(t, '\\\{')) as o, len(regexp_extract_all(t, '\}')) - len(regexp_extract_all(t, '\\\}')) as c from e)
    select block_id, 'braces' as fault from n where o <> c
    union all select block_id, 'environments' from e where len(regexp_extract_all(t, '\\begin\{')) <> len(regexp_extract_all(t, '\\end\{'))
    union all select block_id, 'delimiters' from e where len(regexp_extract_all(t, '\\left\b')) <> len(regexp_extract_all(t, '\\right\b'))
    union all select block_id, 'fraction' from e where regexp_matches(t, '\\(d|t|c)?frac\s*(\\end|\\begin|$)')""",
)
def equation_faults(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of equations."""
    return QL.equation_faults(table(spark, sf_dir, "blocks", "block_id", "type", "text"))


@CORPUS.add(
    "empty_reference_sections",
    f"""with {_B}, rs as (select paper_id, min(seq) as ref_seq from b where type = 'text' and coalesce(text_level, 0) > 0 and {_norm('text')} in {_sql_list(T.REFERENCE_HEADINGS)} group by 1)
    select paper_id from rs where not exists (select 1 from b where b.paper_id = rs.paper_id and b.seq > rs.ref_seq and type not in {NOISE} and trim(coalesce(text, '')) <> '')""",
)
def empty_reference_sections(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose reference heading has nothing after it."""
    return QL.empty_reference_sections(_blocks(spark, sf_dir))


@CORPUS.add(
    "misplaced_references",
    f"""with {_IR}, g as (select paper_id, min(case when kind = 'reference' then seq end) as ref, min(case when kind = 'paragraph' then seq end) as para,
    max(case when kind = 'heading' and {_norm('content')} not in {_FIX} then seq end) as head from ir group by 1)
    select paper_id, case when ref < para then 'references before text' when head > ref then 'heading after references' end as rule from g where ref < para or head > ref""",
)
def misplaced_references(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Papers whose references and text are out of order."""
    return QL.references_misplaced(_rows(spark, sf_dir))


_OWN = f"regexp_replace(regexp_replace(text, '{QL.OUTER_BEFORE}', ' ', 'g'), '{QL.OUTER_AFTER}', ' ', 'g')"
_NUMBERS = "array_to_string(list_sort(list_distinct(list_transform(regexp_extract_all({o}, '{p}', 1), lambda n: cast(n as int)))), ',')"


@CORPUS.add(
    "own_mentions",
    f"""select block_id, {_NUMBERS.format(o=_OWN, p=r'\bFig(?:ure)?\.?\s*(\d{1,9})')} as figures, {_NUMBERS.format(o=_OWN, p=r'\bTable\s*(\d{1,9})')} as tables
    from blocks where regexp_matches(text, '\\b(Fig|Table)')""",
)
def own_mentions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and tables that each block mentions as its paper's own."""
    m = QL.mentions(table(spark, sf_dir, "blocks", "block_id", "text"), "block_id", "text")
    return m.select(F.col("id").alias("block_id"), F.array_join("figures", ",").alias("figures"), F.array_join("tables", ",").alias("tables"))


@CORPUS.add("findings_by_rule")
def findings_by_rule(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number of findings of each rule."""
    all_ = QL.findings(
        equation=equation_faults(spark, sf_dir), figure_gap=figure_gaps(spark, sf_dir), loop=degenerate_lines(spark, sf_dir),
        packed=packed_references(spark, sf_dir), empty_references=empty_reference_sections(spark, sf_dir), order=misplaced_references(spark, sf_dir),
    )
    return all_.groupBy("rule").agg(F.count("*").alias("n"))


@CORPUS.add(
    "required_fields",
    f"""with {_P} select paper_id, 'abstract' as field from p where coalesce(abstract, '') = '' union all select paper_id, 'date' from p where coalesce(date, '') = '' union all select paper_id, 'container_title' from p where coalesce(container_title, '') = ''""",
)
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required fields that a paper's record lacks."""
    names = ("abstract", "date", "container_title")
    lack = F.array_compact(F.array(*[F.when(F.coalesce(F.col(c), F.lit("")) == "", c) for c in names]))
    return _papers(spark, sf_dir).select("paper_id", F.explode(lack).alias("field"))


@CORPUS.add(
    "leftover_signs",
    "select block_id, case when contains(lower(text), '<sup') or contains(lower(text), '<sub') then 'script tag' when contains(text, chr(13)) then 'carriage return' end as rule from blocks where contains(lower(text), '<sup') or contains(lower(text), '<sub') or contains(text, chr(13))",
)
def leftover_signs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocks with script tags or carriage returns left."""
    low = F.lower("text")
    rule = F.when(F.contains(low, F.lit("<sup")) | F.contains(low, F.lit("<sub")), "script tag").when(F.contains(F.col("text"), F.lit("\r")), "carriage return")
    return table(spark, sf_dir, "blocks", "block_id", "text").select("block_id", rule.alias("rule")).where(F.col("rule").isNotNull())


# ---- rendering


@CORPUS.add(
    "rendered_lines",
    f"""with {_IR} select paper_id, page_idx, seq, sub, case when lag(kind) over (partition by paper_id, page_idx order by seq, sub) = 'reference' and kind = 'reference' then 0 else 1 end as gap,
    case when kind = 'heading' then repeat('#', greatest(1, least(level, 6))) || ' ' || coalesce(content, '') when kind = 'page_anchor' then '<!-- page: ' || content || ' -->'
     when kind = 'image' then '![' || coalesce(caption, '') || ']()' when kind = 'table' then concat_ws(chr(10) || chr(10), nullif(caption, ''), coalesce(content, '')) when kind = 'footnote' then '> ' || coalesce(content, '') else coalesce(content, '') end as line from ir""",
)
def rendered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown of every row."""
    return RD.rendered_lines(_rows(spark, sf_dir))


@CORPUS.add(
    "page_bodies",
    f"""with {_IR}, ln as (select paper_id, page_idx, seq, sub, case when lag(kind) over (partition by paper_id, page_idx order by seq, sub) = 'reference' and kind = 'reference' then 0 else 1 end as gap,
    case when kind = 'heading' then repeat('#', greatest(1, least(level, 6))) || ' ' || coalesce(content, '') when kind = 'page_anchor' then '<!-- page: ' || content || ' -->'
     when kind = 'image' then '![' || coalesce(caption, '') || ']()' when kind = 'table' then concat_ws(chr(10) || chr(10), nullif(caption, ''), coalesce(content, '')) when kind = 'footnote' then '> ' || coalesce(content, '') else coalesce(content, '') end as line from ir)
    select paper_id, page_idx, ltrim(string_agg(repeat(chr(10), gap) || line, chr(10) order by seq, sub, repeat(chr(10), gap) || line), chr(10)) as body from ln group by 1, 2""",
)
def page_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown of every page."""
    return RD.page_bodies(_rows(spark, sf_dir))


@CORPUS.add("front_matter")
def front_matter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """YAML record of every paper."""
    return RD.front_matter(_papers(spark, sf_dir))


# ---- sources


@CORPUS.add(
    "xml_flavor",
    r"""select xml_id, case when regexp_matches(xml, '<(\w+:)?(article-meta|ref-list)\b') then 'jats' when regexp_matches(xml, '<(\w+:)?iteminfo\b') or (regexp_matches(xml, '<(\w+:)?sections\b') and regexp_matches(xml, '<(\w+:)?section-title\b')) then 'elsevier' else 'jats' end as flavor from xml_docs""",
)
def xml_flavor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dialect of every XML record."""
    return table(spark, sf_dir, "xml_docs", "xml_id", "xml").select("xml_id", ST.flavor(F.col("xml")).alias("flavor"))


@CORPUS.add("staging_names", "select xml_id, case when length(s) > 40 then substr(s, 1, 24) else s end || '-' || substr(md5(xml), 1, 6) as folder from (select xml_id, xml, regexp_extract(path, '([^/]+?)(\\.[^./]*)?$', 1) as s from xml_docs)")
def staging_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Folder names of staged documents."""
    return table(spark, sf_dir, "xml_docs", "xml_id", "path", "xml").select("xml_id", ST.staging_name(F.col("path"), F.col("xml")).alias("folder"))


# ---- scalar text functions over blocks


def _scalar(name: str, sql: str | None, column: str, f) -> None:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return table(spark, sf_dir, "blocks", "block_id", column).where(F.col(column).isNotNull()).select("block_id", f(F.col(column)).alias("value"))

    q.__doc__ = f"Text function {name} over every block."
    CORPUS.add(name, f"select block_id, {sql} as value from blocks where {column} is not null" if sql else None)(q)


_scalar("text_collapsed", r"trim(regexp_replace(text, '\s+', ' ', 'g'))", "text", T.collapse)
_scalar("text_signature", r"regexp_replace(regexp_replace(regexp_replace(text, '\p{L}', 'a', 'g'), '\p{Nd}', '0', 'g'), '\s+', ' ', 'g')", "text", T.signature)
_scalar("text_norm", _norm("text"), "text", T.heading_norm)
_scalar("text_has_cjk", "regexp_matches(text, '[一-鿿]')", "text", T.has_cjk)
_scalar("text_is_section", f"({_PREFIX.replace('content', 'text')} or {_norm('text')} in {_sql_list(T.SECTION_WORDS)})", "text", T.looks_like_section)
_scalar("text_figure_number", r"nullif(regexp_extract(text, '(?i)\bFig(?:ure|\.)?\s*(\d+(?:\.\d+)*)', 1), '')", "text", T.figure_number)
_scalar("text_title_clean", r"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim(text), '\s*\$\^[^$]*\$\s*$', ''), '(\\?[*†‡§¶])+\s*$', ''), '^\s*(\\?[*†‡§¶])+', ''), '\s{2,}', ' ', 'g'))", "text", T.clean_title)
_scalar("text_citations", r"regexp_replace(text, '\$\^\{\[((?:\d[\w,;\s–—-]*|[A-Z]))\]\}\s*\$', '[\1]', 'g')", "text", T.citation_superscripts)
_scalar("text_footnote_number", r"try_cast(coalesce(nullif(regexp_extract(text, '^\s*\$\^\{?(\d+)\}?\$', 1), ''), nullif(regexp_extract(text, '^\s*(\d{1,3})\s*[A-Z]', 1), '')) as int)", "text", T.footnote_number)
_scalar("text_authors_like", r"(contains(text, '$^{') or len(regexp_extract_all(text, '[A-Z][a-z]+(?:\s+[A-Z]\.?)?')) >= 3)", "text", T.looks_like_authors)
_scalar("text_slug_word", r"regexp_replace(lower(strip_accents(text)), '[^a-z0-9]', '', 'g')", "text", T.slug_word)
_scalar("text_tags_stripped", r"trim(regexp_replace(regexp_replace(table_body, '<[^>]*>', ' ', 'g'), '\s+', ' ', 'g'))", "table_body", T.strip_tags)
_scalar("text_paragraph_clean", None, "text", T.clean_paragraph)
_scalar("text_inline", None, "text", T.normalize_inline)
_scalar("text_watermark_free", None, "text", T.strip_watermark)
_scalar("text_balanced", None, "text", T.brackets_balanced)
_scalar("latex_repaired", None, "text", L.repair_scripts_col)
_scalar("latex_single_tag", None, "text", L.single_tag_col)
_scalar("latex_tidy", None, "text", L.tidy_math_col)
_scalar("latex_scripts", None, "text", L.scripts_outside_math_col)
_scalar("latex_heading", None, "text", L.heading_math_col)
_scalar("text_skeleton", None, "text", lambda c: L.skeleton_col(c)["skel"])


@CORPUS.add("title_hygiene", None)
def title_hygiene(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed titles without numbers and arXiv tails."""
    return table(spark, sf_dir, "refs", "ref_id", "title", "raw").select("ref_id", B.title(F.col("title"), F.col("raw")).alias("title"))


def _typed(sql: str, casts: dict[str, str]) -> str:
    """The statement with columns in the types that the engine gives them."""
    return f"select * replace ({', '.join(f'cast({c} as {t}) as {c}' for c, t in casts.items())}) from ({sql})"


for _name, _casts in {
    "ir_rows": {"sub": "int", "chars": "int"}, "table_cells": {"row_no": "int", "col_no": "int"}, "table_shape": {"n_rows": "int"},
    "cover_features": {"longest": "int"}, "heading_levels": {"level": "int"}, "packed_references": {"marks": "int"},
    "links_resolved": {"sub": "int"}, "linked_citations": {"sub": "int"}, "rendered_lines": {"sub": "int"},
}.items():
    CORPUS.sql[_name] = _typed(CORPUS.sql[_name], _casts)
