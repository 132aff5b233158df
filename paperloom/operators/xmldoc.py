"""Publisher XML as the engine's own relations: blocks, metadata and references.

One pass per record inside an Arrow batch walks the tree; the rows leave the worker typed
and ordered, and everything after is relational. Two dialects are read by their element
names, namespaces do not matter.

Defined cases: null, empty and not well-formed records give no rows; a record without a
body gives its metadata only; named HTML entities are replaced before parsing, unknown
ones by their bare name; texts are kept whole.
"""

from __future__ import annotations

import html
import re
import xml.etree.ElementTree as ET
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.functions.mathml import convert
from paperloom.session import in_arrow

_KEPT = ("amp", "lt", "gt", "quot", "apos")
_ENTITY = re.compile(r"&([a-zA-Z][a-zA-Z0-9]*);")


def guard_entities(xml: str) -> str:
    """Named HTML entities as characters; the five of XML stay, unknown names lose their signs."""

    def one(m: re.Match) -> str:
        if m.group(1) in _KEPT:
            return m.group(0)
        char = html.unescape(m.group(0))
        return m.group(1) if char == m.group(0) else html.escape(char, quote=False)

    return _ENTITY.sub(one, xml)


def load(xml: str | None) -> ET.Element | None:
    """The tree of a record with bare element names; None if it is not well-formed."""
    if not xml or not xml.strip():
        return None
    try:
        root = ET.fromstring(guard_entities(xml))
    except ET.ParseError:
        return None
    for e in root.iter():
        if isinstance(e.tag, str):
            e.tag = e.tag.rpartition("}")[2]
    return root


def squeeze(s: str) -> str:
    return re.sub(r"\s+", " ", s).strip()


def first(e: ET.Element | None, *names: str) -> ET.Element | None:
    """First descendant with one of the names."""
    return next((x for x in e.iter() if x.tag in names and x is not e), None) if e is not None else None


def words(e: ET.Element | None) -> str:
    return squeeze("".join(e.itertext())) if e is not None else ""


def formula(e: ET.Element) -> str | None:
    """LaTeX of a formula element: its TeX, else its MathML."""
    tex = first(e, "tex-math")
    if tex is not None and words(tex):
        return words(tex).strip("$")
    m = e if e.tag == "math" else first(e, "math")
    return re.sub(r" {2,}", " ", convert(m)).strip() or None if m is not None else None


def inline(e: ET.Element) -> str:
    """Text of an element: formulas as inline math, scripts as tags, cross references as links."""
    out = [e.text or ""]
    for c in e:
        match c.tag:
            case "inline-formula" | "math":
                tex = formula(c)
                out.append(f"${tex}$" if tex else words(c))
            case "sub" | "inf":
                out.append(f"<sub>{inline(c)}</sub>")
            case "sup":
                out.append(f"<sup>{inline(c)}</sup>")
            case "xref" | "cross-ref":
                label, target = words(c), re.sub(r"\D+", "", c.get("rid", c.get("refid", "")))
                kind = {"bibr": "ref", "fig": "fig", "table": "tab"}.get(c.get("ref-type", ""), "")
                out.append(f"[{label}](#{kind}-{target})" if kind and target and label else label)
            case "break":
                out.append(" ")
            case "fig" | "table-wrap" | "disp-formula" | "figure" | "graphic":
                pass
            case _:
                out.append(inline(c))
        out.append(c.tail or "")
    return "".join(out)


def table_html(e: ET.Element) -> str:
    return squeeze(ET.tostring(e, encoding="unicode", short_empty_elements=False))


def _caption(e: ET.Element) -> str:
    label, cap = words(next((c for c in e if c.tag == "label"), None)), next((c for c in e if c.tag == "caption"), None)
    ps = [words(p) for p in cap if p.tag == "p"] if cap is not None else []
    return squeeze(f"{label}. {' '.join(ps) or words(cap)}" if label else " ".join(ps) or words(cap))


_BLOCKS = ("fig", "figure", "table-wrap", "disp-formula")


def _body(e: ET.Element, depth: int, out: list[dict]) -> None:
    for c in e:
        match c.tag:
            case "sec" | "section":
                _body(c, depth + 1, out)
            case "title" | "section-title":
                if (t := words(c)) and e.tag in ("sec", "section"):
                    out.append({"type": "text", "text": t, "text_level": min(depth, 3)})
            case "p" | "para" | "disp-quote" | "boxed-text":
                if t := squeeze(inline(c)):
                    out.append({"type": "text", "text": t})
                for x in c.iter():
                    if x.tag in _BLOCKS:
                        _block(x, out)
            case "list":
                items = [squeeze(inline(i)) for i in c.iter() if i.tag == "list-item"]
                out.append({"type": "list", "list_items": [i for i in items if i]})
            case "fn":
                if t := words(c):
                    out.append({"type": "page_footnote", "text": t})
            case "table" if e.tag not in ("table-wrap", "table"):
                _block(c, out)
            case x if x in _BLOCKS:
                _block(c, out)
            case _:
                pass


def _block(e: ET.Element, out: list[dict]) -> None:
    if e.tag == "disp-formula":
        label = words(next((c for c in e if c.tag == "label"), None)).strip("()")
        if tex := formula(e):
            out.append({"type": "equation", "text": tex if not label or "\\tag" in tex else f"{tex} \\tag{{{label}}}"})
        elif t := words(e):
            out.append({"type": "text", "text": t})
    elif e.tag in ("fig", "figure"):
        g = first(e, "graphic", "link")
        href = next((v for k, v in (g.attrib if g is not None else {}).items() if k.rpartition("}")[2] == "href"), None)
        out.append({"type": "image", "image_caption": [_caption(e)] if _caption(e) else [], "img_path": href})
    else:
        t = next((x for x in e.iter() if x.tag == "table" and x is not e), None)
        out.append({"type": "table", "table_caption": [_caption(e)] if _caption(e) else [], "table_body": table_html(t) if t is not None else None})


def body_blocks(root: ET.Element) -> list[dict]:
    """Blocks of a record in reading order: body, footnotes, appendices, references."""
    out: list[dict] = []
    for part in (first(root, "body"), first(root, "sections")):
        if part is not None:
            _body(part, 0 if part.tag == "body" else 0, out)
    back = first(root, "back")
    for e in back.iter() if back is not None else ():
        if e.tag in ("app", "fn-group"):
            _body(e, 2, out)
    refs = [citation(r) for r in root.iter() if r.tag in ("ref", "bib-reference")]
    if refs:
        out.append({"type": "text", "text": "References", "text_level": 1})
        out += [{"type": "ref_text", "text": f"[{n}] {raw}"} for n, raw in enumerate(refs, 1) if raw]
    return out


def citation(ref: ET.Element) -> str:
    """Readable text of a bibliography entry, the structured citation first."""
    cit = next((c for tag in ("element-citation", "citation", "nlm-citation", "mixed-citation", "reference", "other-ref") for c in ref if c.tag == tag), ref)
    if cit.tag == "mixed-citation":
        return words(cit)
    names = []
    for p in cit.iter():
        if p.tag in ("name", "string-name", "author"):
            family, given = words(first(p, "surname")), words(first(p, "given-names", "given-name"))
            names.append(f"{family}{given}" if re.search("[一-鿿]", family) else squeeze(f"{given} {family}"))
        elif p.tag == "collab":
            names.append(words(p))
    rest = [words(first(cit, *t)) for t in (("article-title", "title", "textref"), ("source",), ("year",), ("pub-id",))]
    return ", ".join(x for x in [", ".join(n for n in names if n), *rest] if x) or words(cit)


def metadata(root: ET.Element) -> dict:
    """Metadata of a record: title, authors, date, abstract, identifiers, keywords."""
    head = first(root, "article-meta")
    head = root if head is None else head
    date = first(head, "pub-date")
    if date is not None:
        y, m, d = (words(first(date, t)) for t in ("year", "month", "day"))
        when = "-".join(x.zfill(2) for x in (y, m, d) if x)
    else:
        when = next((m.group(0) for t in ("pubdate", "date", "year") if (m := re.search(r"\d{4}(-\d\d)*", words(first(root, t))))), "")
    authors = []
    for c in head.iter():
        if c.tag == "contrib" and c.get("contrib-type", "author") == "author" or c.tag == "author" and c.find("surname") is not None:
            name = words(first(c, "collab")) or squeeze(f"{words(first(c, 'given-names', 'given-name'))} {words(first(c, 'surname'))}")
            aff = words(first(c, "aff", "affiliation"))
            authors.append({"name": name, "affiliation": aff[:120] or None})
        elif c.tag in ("ref", "body", "sections", "bibliography"):
            break
    doi = next((words(i) for i in head.iter() if i.tag == "article-id" and i.get("pub-id-type") == "doi"), "") or words(first(root, "doi"))
    abstract = next((a for a in head.iter() if a.tag == "abstract" and a.get("abstract-type") not in ("graphical", "toc")), None)
    pages = "-".join(x for x in (words(first(head, "fpage")), words(first(head, "lpage"))) if x) or words(first(head, "elocation-id"))
    return {
        "title": words(first(head, "article-title", "title")), "author": authors, "date": when or None, "abstract": words(abstract) or None, "doi": doi or None,
        "container_title": words(first(root, "journal-title")) or None, "volume": words(first(head, "volume")) or None,
        "issue": words(first(head, "issue")) or None, "page": pages or None,
        "keywords": [k for k in (words(x) for x in head.iter() if x.tag in ("kwd", "keyword")) if k][:15],
    }


_BLOCK_ROW = pa.schema(
    [("xml_id", pa.int64()), ("seq", pa.int64()), ("type", pa.string()), ("text", pa.string()), ("text_level", pa.int32()), ("img_path", pa.string()),
     ("image_caption", pa.list_(pa.string())), ("table_body", pa.string()), ("table_caption", pa.list_(pa.string())), ("list_items", pa.list_(pa.string()))]
)
_META_ROW = pa.schema(
    [("xml_id", pa.int64()), ("title", pa.string()), ("author", pa.list_(pa.struct([("name", pa.string()), ("affiliation", pa.string())]))),
     ("date", pa.string()), ("abstract", pa.string()), ("doi", pa.string()), ("container_title", pa.string()), ("volume", pa.string()),
     ("issue", pa.string()), ("page", pa.string()), ("keywords", pa.list_(pa.string()))]
)


def _records(docs: DataFrame, id_col: str, xml_col: str, schema: pa.Schema, ddl: str, rows) -> DataFrame:
    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = [r for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if (root := load(x)) is not None for r in rows(i, root)]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(f.name) for r in out], f.type) for f in schema], schema=schema)

    return docs.select(F.col(id_col).cast("bigint").alias("xml_id"), F.col(xml_col).alias("xml")).where(F.col("xml").isNotNull()).transform(in_arrow, batches, ddl)


def xml_blocks(docs: DataFrame, id_col: str = "xml_id", xml_col: str = "xml") -> DataFrame:
    """The blocks of every record, in order."""
    ddl = "xml_id bigint, seq bigint, type string, text string, text_level int, img_path string, image_caption array<string>, table_body string, table_caption array<string>, list_items array<string>"
    return _records(docs, id_col, xml_col, _BLOCK_ROW, ddl, lambda i, root: [{"xml_id": i, "seq": n, **b} for n, b in enumerate(body_blocks(root))])


def xml_metadata(docs: DataFrame, id_col: str = "xml_id", xml_col: str = "xml") -> DataFrame:
    """One metadata record per well-formed record."""
    ddl = "xml_id bigint, title string, author array<struct<name:string,affiliation:string>>, date string, abstract string, doi string, container_title string, volume string, issue string, page string, keywords array<string>"
    return _records(docs, id_col, xml_col, _META_ROW, ddl, lambda i, root: [{"xml_id": i, **metadata(root)}])
