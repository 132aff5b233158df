"""SQL statements of corpus queries that need more than one step; each states what its query gives."""

from __future__ import annotations

from paperloom.functions import text as T
from paperloom.operators import metadata as MD
from paperloom.operators import pages as PG
from paperloom.operators import quality as QL
from paperloom.plans import corpus as C
from paperloom.plans.pipeline import PIPELINE

S = C.CORPUS.sql
_IR, _B, _P, NOISE = C._IR, C._B, C._P, C.NOISE
_REFS, _norm, _list = C._sql_list(T.REFERENCE_HEADINGS), C._norm, C._sql_list


def _collapsed(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


# ---- captions, headings, references in rows

S["caption_targets"] = f"""with {_B}, i as (select paper_id, page_idx, seq, coalesce(len(image_caption), 0) + coalesce(len(chart_caption), 0) > 0 as has,
  case when regexp_matches(text, '(?i)^Fig(ure|\\.)?\\s*\\d') then 'fig_caption' when type in ('image', 'chart') then 'image' else type end as k from b),
w as (select *, lead(k) over p as nk, lag(k) over p as pk, coalesce(lag(has) over p, false) as ph, lag(seq) over p as ps,
  min(case when k <> 'image' then seq end) over (partition by paper_id, page_idx order by seq rows between 1 following and unbounded following) as brk
  from i window p as (partition by paper_id, page_idx order by seq)),
e as (select c.paper_id, c.page_idx, c.seq, max(x.seq) as run_end from w c join w x on x.paper_id is not distinct from c.paper_id and x.page_idx is not distinct from c.page_idx
  and x.k = 'image' and x.seq > c.seq and (c.brk is null or x.seq < c.brk) where c.k = 'fig_caption' group by all)
select w.paper_id, w.page_idx, w.seq, k as type, case when nk = 'image' then run_end when pk = 'image' and not ph then ps end as target_seq
from w left join e on e.paper_id is not distinct from w.paper_id and e.page_idx is not distinct from w.page_idx and e.seq = w.seq where k in ('fig_caption', 'table_caption')"""

S["stray_paragraphs"] = f"""with {_IR}, r as (select paper_id, min(seq) as ref_seq from ir where kind = 'heading' and {_norm('content')} in {_REFS} group by 1),
l as (select ir.*, ref_seq, regexp_matches(content, '^\\s*(\\[\\d{{1,4}}\\]|\\d{{1,4}}[.)]\\s)') as num from ir join r using (paper_id) where kind <> 'page_anchor' and seq > ref_seq),
n as (select *, lag(num) over w as before, lead(num) over w as after from l window w as (partition by paper_id order by seq, sub))
select paper_id, seq, cast(ref_seq - 0.5 as double) as new_seq from n where not num and after and coalesce(before, true) and length(content) >= 100 and len(regexp_split_to_array(trim(content), '\\s+')) >= 10"""


def _hierarchy() -> str:
    steps, within, last = [], "paper_id", "lv"
    for k in range(1, 7):
        steps.append(f"h{k}_ as (select *, sum(case when level = {k} then 1 else 0 end) over (partition by {within} order by seq rows unbounded preceding) as n{k} from {last})")
        within, last = f"{within}, n{k}", f"h{k}_"
    parts = ", ".join(f"cast(greatest(n{k}, 1) as varchar)" for k in range(1, 7))
    return f"with {_IR}, {C._LEVELS}, {', '.join(steps)} select paper_id, seq, array_to_string(list_slice([{parts}], 1, least(level, 6)), '.') as number from h6_"


S["heading_hierarchy"] = _hierarchy()

S["figure_runs"] = f"""with {_IR}, r as (select *, kind = 'image' and coalesce(regexp_matches(caption, '(?i)^\\s*(Figure|Fig\\.?)\\s*\\d+(\\.\\d+)*\\s*[.:]'), false) as captioned from ir where kind <> 'page_anchor'),
w as (select *, (kind <> 'image' and length(coalesce(content, '')) > 20) or coalesce(lag(captioned) over (partition by paper_id, page_idx order by seq, sub), false) as brk from r),
g as (select *, sum(case when brk then 1 else 0 end) over (partition by paper_id, page_idx order by seq, sub rows unbounded preceding) as run from w),
i as (select paper_id, page_idx, seq, run, count(*) over (partition by paper_id, page_idx, run) as c from g where kind = 'image'),
u as (select i.paper_id, i.page_idx, run, count(*) as n, min(bbox[1]) as x0, min(bbox[2]) as y0, max(bbox[3]) as x1, max(bbox[4]) as y1 from i join b on b.paper_id = i.paper_id and b.seq = i.seq where c >= 2 and len(bbox) = 4 group by 1, 2, 3)
select paper_id, page_idx, cast(run as bigint) as run, n, round(x0, 3) as x0, round(y0, 3) as y0, round(x1, 3) as x1, round(y1, 3) as y1 from u where n >= 2 and not (y1 - y0 > 750) and not ((y1 - y0) * (x1 - x0) > 900000)"""

PIPELINE.sql["anchored_rows"] = f"""with {_IR}, {C._MENTIONS}, a as (select paper_id, seq, {C._ANCHOR} as anchor from ir), f as (select paper_id, anchor, min(seq) as seq from a where anchor is not null group by 1, 2)
select f.* from f where exists (select 1 from m where m.paper_id = f.paper_id and m.category || '-' || m.number = f.anchor)"""

_MARKS = " + ".join(f"max(case when contains(lower(coalesce(text, '')), '{m}') then 1 else 0 end)" for m in PG.COVER_MARKERS)
S["cover_rules_compared"] = f"""with n as (select paper_id from ({S['cover_pages']}) where is_cover),
o as (select distinct paper_id from (select paper_id, page_idx from (select * from blocks qualify block_id = min(block_id) over (partition by paper_id, seq)) where coalesce(page_idx, 0) <= 1 group by 1, 2 having {_MARKS} >= 2))
select coalesce(n.paper_id, o.paper_id) as paper_id, case when n.paper_id is not null and o.paper_id is not null then 'same' when n.paper_id is not null then 'new only' else 'old only' end as diff from n full outer join o on n.paper_id = o.paper_id"""

S["article_rows"] = f"""with {_IR}, {_P}, t as (select ir.paper_id, min(seq) as lead_seq from ir join p using (paper_id) where length({_norm('title')}) >= {PG.MIN_TITLE} and kind in ('heading', 'paragraph')
  and length(lower({_collapsed('title')})) >= {PG.MIN_TITLE} and contains(lower({_collapsed('content')}), lower({_collapsed('title')})) group by 1),
ld as (select t.paper_id, lead_seq from t join ir on ir.paper_id = t.paper_id and ir.seq < t.lead_seq and kind = 'paragraph' group by 1, 2 having sum(length(content)) >= {PG.LEAD_MIN_CHARS}),
h as (select paper_id, seq, {_norm('content')} as h from ir where kind = 'heading'), rf as (select paper_id, min(seq) as ref_seq from h where h in {_REFS} group by 1),
nx as (select h.paper_id, arg_min(h.h, h.seq) as h, min(h.seq) as tail_seq from h join rf using (paper_id) where h.seq > rf.ref_seq group by 1), tl as (select paper_id, tail_seq from nx where h not in {_list(PG.TAIL_SECTIONS)})
select ir.paper_id, kind, count(*) as n from ir left join ld using (paper_id) left join tl using (paper_id) where kind = 'page_anchor' or (seq >= coalesce(lead_seq, -1) and seq < coalesce(tail_seq, 4611686018427387904)) group by 1, 2"""

# ---- tables

_COLS = f"""tb as (select paper_id, seq, regexp_extract_all(table_body, '{C._TROWS}') as trs from b where type = 'table'),
tr as (select paper_id, seq, generate_subscripts(trs, 1) as row_no, unnest(trs) as tr from tb),
td as (select paper_id, seq, row_no, unnest(regexp_extract_all(tr, '{C._CELLS}')) as td from tr),
wd as (select paper_id, seq, row_no, sum(coalesce(try_cast(nullif(regexp_extract(td, '(?i)^<t[dh][^>]*colspan\\s*=\\s*["'']?(\\d+)', 1), '') as int), 1)) as width from td group by 1, 2, 3),
cl as (select tb.paper_id, tb.seq, coalesce(max(width), 0) as cols from tb left join wd on wd.paper_id is not distinct from tb.paper_id and wd.seq = tb.seq group by 1, 2)"""
_GROUPS = f"""pr as (select *, sum(case when kind in ('paragraph', 'heading', 'equation', 'image', 'reference') and length(coalesce(content, '')) > 40 then 1 else 0 end) over (partition by paper_id order by page_idx, seq, sub rows unbounded preceding) as prose from ir),
tt as (select pr.paper_id, pr.seq, sub, page_idx, caption, prose, cols, {C._TNUM} as num from pr join cl on cl.paper_id is not distinct from pr.paper_id and cl.seq = pr.seq where kind = 'table'),
go as (select *, coalesce(page_idx > lag(page_idx) over w and prose = lag(prose) over w and (coalesce(caption, '') = '' or regexp_matches(caption, '(?i)(continued|contd|cont\\.|续表|续上表)') or num is not distinct from lag(num) over w)
  and (cols = lag(cols) over w or cols = 0 or lag(cols) over w = 0), false) as goes from tt window w as (partition by paper_id order by seq, sub)),
gr as (select paper_id, seq, last_value(case when goes then null else seq end ignore nulls) over (partition by paper_id order by seq, sub rows unbounded preceding) as group_seq from go)"""
PIPELINE.sql["scan_table_groups"] = f"with {_IR}, {_COLS}, {_GROUPS} select paper_id, count(distinct group_seq) as tables from gr group by 1"
_STRIPPED = "trim(regexp_replace(regexp_replace({}, '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"
S["tables_merged"] = f"""with {_IR}, {_COLS}, {_GROUPS}, ro as (select gr.paper_id, group_seq, gr.seq, row_no, tr from gr join tr on tr.paper_id is not distinct from gr.paper_id and tr.seq = gr.seq),
hd as (select paper_id, group_seq, arg_min(tr, row_no) as head from ro where seq = group_seq group by 1, 2),
ke as (select ro.paper_id, ro.group_seq, sum(length(tr)) as chars from ro left join hd on hd.paper_id is not distinct from ro.paper_id and hd.group_seq = ro.group_seq
  where ro.seq = ro.group_seq or {_STRIPPED.format('tr')} <> {_STRIPPED.format("coalesce(head, chr(0))")} group by 1, 2),
pa as (select paper_id, group_seq, count(*) as parts from gr group by 1, 2)
select pa.paper_id, pa.group_seq as seq, cast(parts as int) as parts, cast(15 + coalesce(chars, 0) as int) as chars from pa left join ke on ke.paper_id is not distinct from pa.paper_id and ke.group_seq = pa.group_seq"""

# ---- metadata

_TITLE = "trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(trim({x}), '\\s*\\$\\^[^$]*\\$\\s*$', ''), '(\\\\?[*†‡§¶])+\\s*$', ''), '^\\s*(\\\\?[*†‡§¶])+', ''), '\\s{{2,}}', ' ', 'g'))"
_TEXT_DOI = C._DOI_SQL.replace("raw", "text")
_EARLY = f"""e as (select paper_id, seq, block_id, type, text_level, text, {_collapsed('text')} as t from b where coalesce(page_idx, 0) <= {MD.EARLY_PAGES} and type not in {NOISE} and text is not null),
f as (select *, case when type = 'text' and coalesce(text_level, 0) = 1 and length(t) > 10 then {_TITLE.format(x='t')} end as title, {_TEXT_DOI} as doi,
  nullif(regexp_extract(t, '(?is)^(?:abstract|summary|zusammenfassung|résumé|resumen|resumo|摘要)\\s*[:.：—-]?\\s*(.{{50,}})$', 1), '') as abstract,
  nullif(regexp_extract(t, '(?is)^(?:key ?words|index terms|palabras clave|mots-clés|schlüsselwörter|关键词)\\s*[:：—-]?\\s*(.+)$', 1), '') as keywords_raw from e),
yy as ({C._YEARS.replace('from refs', 'from (select block_id as ref_id, text as raw from e)').replace('x0 as', 'with x0 as', 1)} select ref_id, year from w qualify row_number() over (partition by ref_id order by rank, k) = 1),
rm as (select paper_id, arg_min(title, seq) filter (title is not null) as title, arg_min(doi, seq) filter (doi is not null) as doi, arg_min(abstract, seq) filter (abstract is not null) as abstract,
  arg_min(keywords_raw, seq) filter (keywords_raw is not null) as keywords_raw, arg_min(year, seq) filter (year is not null) as year from f left join yy on yy.ref_id = f.block_id group by 1)"""
S["rule_metadata"] = f"with {_B}, {_EARLY} select * from rm"
S["metadata_priority"] = f"""with {_B}, {_P}, {_EARLY}, k as (select distinct paper_id from (select paper_id from p union all select paper_id from rm))
select k.paper_id, {', '.join(f"coalesce(nullif(p.{c}, ''), nullif(rm.{c}, '')) as {c}, case when nullif(p.{c}, '') is not null then 'authority' when nullif(rm.{c}, '') is not null then 'text' end as {c}_source" for c in ('title', 'doi', 'abstract'))}
from k left join p using (paper_id) left join rm using (paper_id)"""

_LINE = "array_to_string(list_transform(author, lambda a: coalesce(a.name, '')), '; ')"
_X = f"trim(replace(regexp_replace(regexp_replace({_LINE}, '\\$\\^?\\{{[^}}]*\\}}', '', 'g'), '[☒☑✓✉†‡§¶#*]+', '', 'g'), '$', ''))"
_TIDY = "trim(regexp_replace(regexp_replace({}, '\\d+', ' ', 'g'), '\\s+', ' ', 'g'))"
S["author_lines"] = f"""with {_P}, x as (select paper_id, {_X} as x from p),
c as (select *, list_filter(regexp_split_to_array(regexp_replace(x, '[（(][^）)]*[）)]', '', 'g'), '[\\s,，、]+'), lambda t: t <> '') as toks from x),
d as (select *, list_filter(toks, lambda t: regexp_matches(t, '^[一-鿿]{{2,4}}$')) as cjk from c),
n as (select paper_id, case when regexp_matches(x, '[一-鿿]') and len(cjk) >= 2 and len(cjk) * 2 >= len(toks) then cjk
  when len(regexp_extract_all(x, ';')) >= 2 then list_transform(list_filter(list_transform(string_split(x, ';'), lambda t: {_TIDY.format('t')}), lambda t: length(t) > 2 and not contains(lower(t), 'more author')),
    lambda t: case when regexp_matches(t, '^[^,]+,\\s*\\S') then trim(regexp_replace(t, '^[^,]*,', '')) || ' ' || trim(string_split(t, ',')[1]) else t end)
  else list_filter(list_transform(string_split(regexp_replace(regexp_replace(x, ',?\\s+and\\s+', ', ', 'g'), '(?i)^By\\s+', ''), ','), lambda t: {_TIDY.format('t')}), lambda t: length(t) > 2 and not contains(lower(t), 'more author')) end as names from d)
select paper_id, cast(generate_subscripts(names, 1) - 1 as int) as pos, unnest(names) as name from n"""

_Q = "'\"' || replace(replace({}, '\\', '\\\\'), '\"', '\\\"') || '\"'"


def _field(name: str, column: str) -> str:
    return f"case when nullif(trim({column}), '') is not null then '{name}: ' || {_Q.format(f'trim({column})')} end"


S["front_matter"] = f"""with {_P}, y as (select paper_id, [{_field('title', 'title')}, case when len(author) > 0 then 'author:' || chr(10) || array_to_string(list_transform(author, lambda a: '  - ' || {_Q.format("coalesce(a.name, '')")}), chr(10)) end,
 {_field('date', 'date')}, case when nullif(trim(abstract), '') is not null then 'abstract: >-' || chr(10) || '  ' || trim(regexp_replace(abstract, '\\s+', ' ', 'g')) end, {_field('doi', 'doi')}, {_field('container-title', 'container_title')},
 case when len(list_filter(keywords, lambda k: k is not null)) > 0 then 'keywords: [' || array_to_string(list_transform(list_filter(keywords, lambda k: k is not null), lambda k: {_Q.format('k')}), ', ') || ']' end,
 {_field('volume', 'volume')}, {_field('issue', 'issue')}, {_field('page', 'page')}, 'lang: ' || {_Q.format("coalesce(nullif(lang, ''), 'en')")}] as parts from p)
select paper_id, '---' || chr(10) || array_to_string(list_filter(parts, lambda x: x is not null), chr(10)) || chr(10) || '---' || chr(10) as yaml from y"""

# ---- bibliography

_CLEAN = "rtrim(trim(trim(regexp_replace(regexp_replace({}, '^\\s*(\\[\\d{{1,4}}\\]|\\d{{1,4}}[.\\)])\\s+', ''), '(?is)\\[\\s*arXiv\\s*:.*$', '')), '\" '), '.,;:[]() ' || chr(9) || '\"''')"
_BARE_TITLE, _BARE_RAW = _CLEAN.format(_collapsed("title")), _CLEAN.format(_collapsed("raw"))
_TITLE_SQL = f"case when length({_BARE_TITLE}) >= 4 and {_BARE_TITLE} is distinct from {_BARE_RAW} then {_BARE_TITLE} end"
S["title_hygiene"] = f"select ref_id, {_TITLE_SQL} as title from refs"
_ARXIV = "coalesce(nullif(regexp_extract(raw, '(?i)arXiv:\\s*(\\d{4}\\.\\d{4,5})(?:v\\d+)?', 1), ''), nullif(regexp_extract(raw, '(?i)arXiv:\\s*([a-z\\-]+(?:\\.[A-Z]{2})?/\\d{7})(?:v\\d+)?', 1), ''))"
S["reference_join"] = f"""with e as (select *, row_number() over (partition by paper_id order by ref_id) as pos, count(n) over (partition by paper_id) as numbered from refs),
f as (select paper_id, n, arg_min(title, pos) as title0, min(pos) as pos1 from e where n is not null group by 1, 2),
i as (select f.paper_id, f.n, e.title, e.authors, e.year, e.venue, e.doi from f join e on e.paper_id = f.paper_id and e.pos = f.pos1),
j as (select e.paper_id, e.pos, e.n, e.raw, i.n is not null or e.numbered = 0 and e.paper_id is not null as hit, case when i.n is not null then i.title when e.numbered = 0 then e.title end as title,
  coalesce(i.authors, case when e.numbered = 0 then e.authors end) as authors, coalesce(i.year, case when e.numbered = 0 then e.year end) as year,
  coalesce(i.venue, case when e.numbered = 0 then e.venue end) as venue, coalesce(i.doi, case when e.numbered = 0 then e.doi end) as doi from e left join i on i.paper_id = e.paper_id and i.n = e.n)
select paper_id, cast(pos as int) as pos, n, case when hit then 'item' else 'rule' end as source, {_TITLE_SQL} as title, cast(len(list_slice(list_filter(list_transform(authors, lambda a: trim(a)), lambda a: a <> ''), 1, 30)) as int) as n_authors,
 case when year between 1900 and 2099 then year end as year, venue, coalesce({C._DOI_SQL}, doi) as doi, {_ARXIV} as arxiv_id from j"""

# ---- loops

S["degenerate_lines"] = f"""with l as (select block_id, generate_subscripts(string_split(text, chr(10)), 1) as line_no, unnest(string_split(text, chr(10))) as line from blocks where length(text) >= {QL.MIN_SIGNATURE}),
s as (select block_id, line_no, regexp_replace(regexp_replace(regexp_replace(line, '\\p{{L}}', 'a', 'g'), '\\p{{Nd}}', '0', 'g'), '\\s+', ' ', 'g') as sig from l where length(line) >= {QL.MIN_LINE}),
q as (select s.*, p.p, greatest({QL.MIN_REPEATS}, cast(ceil({QL.MIN_SPAN} / p.p) as int)) as least from s, (select unnest(range({QL.MIN_PERIOD}, {QL.MAX_PERIOD + 1})) as p) p where length(sig) >= {QL.MIN_SIGNATURE}),
t as (select *, array_to_string(list_transform(range(1, length(sig) - p + 1), lambda i: case when sig[i] = sig[i + p] then '1' else '0' end), '') as bits from q),
u as (select *, instr(bits, repeat('1', cast((least - 1) * p as int))) as start from t), v as (select * from u where start > 0 qualify row_number() over (partition by block_id, line_no order by start, p) = 1)
select block_id, cast(line_no as int) as line_no, cast(p as int) as period, cast(length(regexp_extract(substr(bits, start), '^1+')) // p + 1 as int) as repeats from v"""

_FINDINGS = {"equation": "equation_faults", "figure_gap": "figure_gaps", "loop": "degenerate_lines", "packed": "packed_references", "empty_references": "empty_reference_sections", "order": "misplaced_references"}
S["findings_by_rule"] = "select rule, count(*) as n from (" + " union all ".join(f"select '{rule}' as rule from ({S[q]})" for rule, q in _FINDINGS.items()) + ") group by 1"

# ---- texts


def _chain(x: str, *steps: tuple[str, str]) -> str:
    for pattern, into in steps:
        x = f"regexp_replace({x}, '{pattern}', '{into}', 'g')"
    return x


_INLINE = _chain(
    "text", ("(?i)<su[pb]>\\s*</su[pb]>", ""), ("(?i)<su[pb]>([*†‡§¶#]+)</su[pb]>", "\\1"), ("(?i)<sup>([^<]*)</sup>", "$^{\\1}$"), ("(?i)<sub>([^<]*)</sub>", "$_{\\1}$"),
    ("(?i)</?(b|i|em|strong|u|span)(\\s[^>]*)?>", ""), ("\\$\\^\\{\\[((?:\\d[\\w,;\\s–—-]*|[A-Z]))\\]\\}\\s*\\$", "[\\1]"), ("\\$\\s*(\\[\\d+(?:\\s*[,–—;-]\\s*\\d+)*\\])\\s*\\$", "\\1"),
)
S["text_inline"] = f"select block_id, replace({_INLINE}, chr(160), ' ') as value from blocks where text is not null"
_STAMPS = " or ".join(f"regexp_matches(x, '{p}')" for p in T.WATERMARK_LINES)
S["text_watermark_free"] = f"""select block_id, array_to_string(list_filter(list_transform(list_filter(string_split(text, chr(10)), lambda x: not ({_STAMPS})), lambda x: regexp_replace(x, '(?i)\\s*Downloaded\\s+(by|from|on)\\b.*$', '')), lambda x: trim(x) <> ''), chr(10)) as value
from blocks where text is not null"""
S["text_balanced"] = """with s as (select block_id, regexp_replace(text, '[^()]', '', 'g') as s from blocks where text is not null)
select block_id, length(replace(s, '(', '')) * 2 = length(s) and len(list_filter(range(1, length(s) + 1), lambda i: length(replace(substr(s, 1, i), '(', '')) * 2 > i)) = 0 as value from s"""

_FOLLOW = "|".join(T.HISTORY_FOLLOWERS)
_NOISY = " or ".join(
    [f"starts_with(lw, '{x}')" for x in T.NOISE_OPENERS] + [f"contains(lw, '{x}')" for x in T.NOISE_PHRASES]
    + ["regexp_matches(lw, '^(https?://|www\\.|10\\.\\d{4,}/)\\S+$')", "regexp_matches(lw, '^\\S+\\.(org|de|li)/\\S*$')",
       "(regexp_matches(lw, '^(article )?https?://doi\\.org/\\S+( (received|accepted|published|\\d{4}))?') and (regexp_matches(lw, '^article ') or regexp_matches(lw, '\\S (received|accepted|published|\\d{4})')))",
       f"lw in {_list(T.NOISE_BUTTONS)}", f"regexp_matches(lw, '^({'|'.join(T.HISTORY_WORDS)}) ?[:,]? ?(\\d|{_FOLLOW})')", "regexp_matches(t, '^(RECEIVED|ACCEPTED|PUBLISHED)\\b')",
       "regexp_matches(lw, '^table \\d+[^()]*\\((contd\\.?|continued|cont\\.?|cont''d)\\)$')"]
)
_PARA = _chain(
    "trim(text)", ("^((Published|Downloaded) on\\s+[^.]*\\.\\s*)+", ""), ("\\bView (Article Online|Journal|Issue)\\b", ""), ("(?i)\\bCrossMark\\s*←?\\s*click for updates\\b", ""),
    ("(?m)^Cite this:.*$", ""), ("^DOI:\\s*\\S+\\s+", ""), ("\\s{2,}", " "),
)
S["text_paragraph_clean"] = f"""with a as (select block_id, trim(trim({_PARA}, ' |')) as t from blocks where text is not null),
b as (select *, regexp_replace(t, '(?s)^.{{0,249}}?\\bCheck for updates\\s+', '') as after, trim(regexp_replace(lower(t), '\\s+', ' ', 'g')) as lw, lower({_collapsed("regexp_replace(t, '[^a-zA-Z ]', ' ', 'g')")}) as label from a),
c as (select *, {_NOISY} as noise, length(t) < 60 and (label in {_list(T.ARTICLE_LABELS)} or {C._HEADING_NOISE.replace('content', 't')}) as label_only,
  trim(regexp_replace(regexp_replace(t, '^Article\\s+https?://doi\\.org/\\S+\\s+', ''), '(?s)^.{{0,249}}?\\bCheck for updates\\s+', '')) as bare from b)
select block_id, case when t = '' then null when noise and length(after) < length(t) and length(trim(after)) > 150 then trim(after) when noise or label_only then null else nullif(bare, '') end as value from c"""

_FOLDED = "regexp_replace(text, '[\\s\\x{0b}\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]+', ' ', 'g')"
for _a, _b in (("ﬀ", "ff"), ("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"), ("ﬅ", "st"), ("ﬆ", "st")):
    _FOLDED = f"replace({_FOLDED}, '{_a}', '{_b}')"
S["text_skeleton"] = f"select block_id, replace(replace(replace(lower(translate({_FOLDED}, '’‘ʼ“”–—‐‑−', '''''''\"\"-----')), 'ß', 'ss'), 'ς', 'σ'), chr(181), chr(956)) as value from blocks where text is not null"
