"""Markup residue: a site style tree over the blocks of a journal, and clean text.

A block's field is parsed into a small DOM. Its presentation nodes carry the kind of
markup they are written in (html, markdown, wiki, latex), a style (name and class)
and the path from the root. The DOMs of one host (the journal that a paper came from, else
the paper) are merged in a style tree: all nodes of one path are one style node with its presentation variants and its
contents. Importance is entropy-based:

presentation  -sum p log_m p over the style variants under a node, m pages; 1 if m = 1
content       the same over the contents of a leaf: what every page repeats tells nothing

The importance of a branch is the larger of both, weighted as inner nodes are by their
children (``DECAY``). Branches below ``LOW`` on hosts with at least ``MIN_PAGES`` pages
are removed; the rest is rendered as text in which headings, lists, code, tables and
formulas keep a mark.

Parsing is a narrow map. The tree is built by aggregating (host, path, style, content)
with map-side combining; a host with a third of all rows thus meets in few rows. Removed
nodes come back by a join on the block, without collecting a host anywhere.

Defined cases: null and empty fields have no nodes and render as null and ''; blocks
with a null paper_id form a host of their own kind each (no merging); equal blocks are
judged alike; fields of any length are parsed whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut_lineage, in_arrow

# Element names of HTML that occur in text.
HTML_TAGS = (
    "a abbr address article aside b big blockquote body br caption center cite code col colgroup dd del dfn div dl dt em "
    "figcaption figure font footer form h1 h2 h3 h4 h5 h6 head header hr html i img input ins kbd label li link main mark "
    "math meta nav ol p pre q s samp script section small span strike strong style sub summary sup table tbody td tfoot th "
    "thead title tr tt u ul var video wbr"
).split()
_TAG = r"<(?P<close>/?)(?P<tag>" + "|".join(sorted(HTML_TAGS, key=len, reverse=True)) + r")(?P<attrs>(?:\s[^<>]*)?)/?>"
_ENTITY = r"&(?:[A-Za-z][A-Za-z0-9]{1,30}|#\d{1,7}|#[xX][0-9A-Fa-f]{1,6});"
_ESCAPED = re.compile(r"&(?:amp;)*lt;\s*/?\s*(?:" + "|".join(HTML_TAGS) + r")\b", re.I)

#: (kind, name, pattern); the first that matches at a position is the node there.
_RULES: list[tuple[str, str, str]] = [
    ("markdown", "fence", r"(?m:^[ ]{0,3}(?:```|~~~)[^\n`]*$)(?s:.*?)(?m:^[ ]{0,3}(?:```|~~~)[ ]*$|\Z)"),
    ("html", "comment", r"<!--(?s:.*?)-->"),
    ("html", "tag", _TAG),
    ("html", "entity", _ENTITY),
    ("", "path", r"\b[A-Za-z]:\\[^\s]*|\\\\\w[^\s]*|(?:https?://|www\.)[^\s<>\[\]{}|]+"),
    ("latex", "display", r"\$\$(?s:.+?)\$\$"),
    ("latex", "environment", r"\\begin\{(?P<env>[a-zA-Z]+\*?)\}(?s:.*?)(?:\\end\{(?P=env)\}|\Z)"),
    ("latex", "bracket", r"\\\[(?s:.+?)\\\]|\\\((?s:.+?)\\\)"),
    ("latex", "inline", r"(?<![\\$\w])\$(?=[^\s$])[^$\n]*[^\s$\\]\$(?![\d$])|(?<![\\$\w])\$[^\s$]\$(?![\d$])|\$\^\{?[^$\n]+\$"),
    ("latex", "command", r"~?\\(?:[a-zA-Z]{2,}\*?|[a-zA-Z](?=\{))(?:\[[^\]\n]*\])*(?:\{(?:[^{}]|\{[^{}]*\})*\})*|\\[%&_#{},;$](?=\S|\s)|\\\\(?=\s)"),
    ("latex", "script", r"(?<=[\w)])[_^]\{[^{}\n]+\}"),
    ("wiki", "table", r"(?m:^[ ]*\{\|)(?s:.*?)(?:\|\}|\Z)"),
    ("wiki", "template", r"(?<![\w{^_])\{\{\s*[A-Za-z#!:][^{}]*\}\}"),
    ("wiki", "link", r"\[\[\s*:?[^\W\d][^\[\]\n]*\]\]|\[\[[^\[\]\n|]*\|[^\[\]\n]*\]\]"),
    ("wiki", "heading", r"(?m:^[ ]*(?P<eq>={1,6})[ ]*[^=\n][^\n]*?[ ]*(?P=eq)[ ]*$)"),
    ("wiki", "bold", r"'''(?=\S)[^\n]+?(?<=\S)'''"),
    ("wiki", "italic", r"(?<!')''(?![\s'])[^'\n](?:[^\n]*?[^\s'])?''(?!')"),
    ("wiki", "external", r"\[https?://[^\s\]]+ [^\]\n]+\]"),
    ("wiki", "magic", r"__(?:TOC|NOTOC|NOEDITSECTION|FORCETOC)__|~~~~"),
    ("markdown", "image", r"!\[[^\]\n]*\]\([^)\n]*\)(?:\{[^}\n]*\})?"),
    ("markdown", "link", r"\[[^\[\]\n]+\]\((?=[^)\s]*[#/.:])[^)\s]*(?:\s+\"[^\"\n]*\")?\)(?:\{[^}\n]*\})?"),
    ("markdown", "footnote", r"\[\^[\w-]+\]:?"),
    ("markdown", "attribute", r"\{[#.][\w-]+[^}\n]*\}"),
    ("markdown", "heading", r"(?m:^[ ]{0,3}#{1,6}[ ]+(?=\S))"),
    ("markdown", "rule", r"(?m:^[ ]{0,3}(?:\*[ ]?){3,}$|^[ ]{0,3}(?:_[ ]?){3,}$)"),
    ("markdown", "quote", r"(?m:^[ ]{0,3}>[ ]+(?=[^\s\d]))"),
    ("markdown", "item", r"(?m:^[ ]{0,6}[*+][ ]+(?=[^\s]*[^\W\d]))"),
    ("markdown", "dashes", r"(?m:^[ ]{0,6}-[ ]+(?=[^\W\d])[^\n]*\n[ ]{0,6}-[ ]+(?=[^\W\d]))"),
    ("markdown", "table", r"(?m:^[ ]*\|?[ ]*:?-{3,}:?[ ]*(?:\|[ ]*:?-{3,}:?[ ]*)+\|?[ ]*$|^[ ]*\|[ ]*:?-{3,}:?[ ]*\|[ ]*$)"),
    ("markdown", "code", r"(?<![`\w])`(?!`)[^`\n]+`(?!`)"),
    ("markdown", "bold", r"(?<![\w*\\])\*\*(?=[^\s*])[^\n]+?(?<=[^\s*])\*\*(?!\*)|(?<![\w_])__(?=[^\s_])[^\n]+?(?<=[^\s_])__(?![\w_])"),
    ("markdown", "italic", r"(?<![\w*\\])\*(?=[^\s*])[^*\n]+?(?<=[^\s*])\*(?![\w*])|(?<![\w_/\\.])_(?=[^\s_])[^_\n]+?(?<=[^\s_])_(?![\w_/])"),
    ("markdown", "strike", r"~~(?=\S)[^~\n]+?(?<=\S)~~"),
]
_MASTER = re.compile("|".join(f"(?P<r{i}>{p})" for i, (_, _, p) in enumerate(_RULES)), re.I)
#: Cheap test of a text that may hold markup at all.
MAY_HOLD = r"(?m)[<&$\\{}*_`#|=~^]|''|\]\(|\[\[|!\[|\[https?:|^ {0,3}>|^\s*[-+]\s"
_VOID = {"br", "hr", "img", "input", "meta", "link", "col", "wbr"}
_INNER = {"bold", "italic", "strike", "image", "link"}


class Node:
    __slots__ = ("kind", "name", "text", "children", "style", "number", "path")

    def __init__(self, kind: str, name: str, text: str = "", style: str = ""):
        self.kind, self.name, self.text, self.style = kind, name, text, style
        self.children: list[Node] = []
        self.number, self.path = 0, ""


def parse(text: str | None) -> Node:
    """The DOM of a field, whatever its depth; its nodes are numbered in document order."""
    root = Node("", "root")
    todo = [(root, text or "")]
    while todo:
        node, inner = todo.pop()
        _fill(node, inner, todo)
    _number(root)
    return root


def _fill(top: Node, text: str, todo: list[tuple[Node, str]]) -> None:
    """Appends the nodes of ``text`` to ``top``; what stands inside marks goes to ``todo``."""
    stack = [top]

    def put(node: Node) -> None:
        stack[-1].children.append(node)

    at = 0
    for m in _MASTER.finditer(text):
        if m.start() > at:
            put(Node("", "text", text[at : m.start()]))
        at = m.end()
        kind, name, _ = _RULES[int(next(k for k, v in m.groupdict().items() if v is not None and k[0] == "r" and k[1:].isdigit())[1:])]
        body = m.group(0)
        if name == "tag":
            tag = m.group("tag").lower()
            if m.group("close"):
                for k in range(len(stack) - 1, 0, -1):
                    if stack[k].name == tag:
                        del stack[k:]
                        break
                else:
                    put(Node("html", tag, ""))  # a stray closing tag
                continue
            cls = re.search(r"class\s*=\s*[\"']?([\w -]+)", m.group("attrs") or "")
            node = Node("html", tag, "", f"{tag}.{cls.group(1)}" if cls else tag)
            put(node)
            if tag not in _VOID and not body.endswith("/>"):
                stack.append(node)
        elif not kind:
            put(Node("", "text", body))
        else:
            node = Node(kind, name, body, f"{kind}:{name}")
            if name in _INNER:
                todo.append((node, _inside(name, body)))
            elif (kind, name) == ("wiki", "table"):
                todo.append((node, re.sub(r"^\s*\{\||\|\}\s*$", "", body)))
            put(node)
    if at < len(text):
        put(Node("", "text", text[at:]))


def _inside(name: str, body: str) -> str:
    if name == "image":
        return body[2 : body.index("](")]
    if name == "link" and body.startswith("[["):
        parts = body[2:-2].split("|")
        return parts[-1].strip() if parts[0].lower().startswith(("file:", "image:", "datei:")) and len(parts) > 1 else parts[-1].strip(" :")
    if name == "link":
        return body[1 : body.index("](")]
    cut = re.match(r"'''|''|\*\*|__|~~|\*|_", body)
    return body[cut.end() : len(body) - cut.end()] if cut else body


def _number(root: Node) -> None:
    n, todo = 0, [root]
    while todo:
        node = todo.pop()
        node.number, n = n, n + 1
        for c in node.children:
            above = node.path if len(node.path) < 400 else f"/#{_hash(node.path)}"  # long paths by their hash
            c.path = f"{above}/{c.style or c.name}"
        todo.extend(reversed(node.children))


def walk(root: Node) -> Iterator[Node]:
    todo = list(reversed(root.children))
    while todo:
        node = todo.pop()
        yield node
        todo.extend(reversed(node.children))


def kinds(text: str | None) -> set[str]:
    """The kinds of markup a field holds."""
    return {n.kind for n in walk(parse(text)) if n.kind}


_BLOCK = {"p", "div", "section", "article", "ul", "ol", "table", "blockquote", "figure", "header", "footer", "tr", "br", "dl", "dt", "dd", "caption"}


def unescaped(text: str) -> str:
    """A text whose escaped markup is markup, however often it was escaped."""
    while _ESCAPED.search(text) and (plain := html.unescape(text)) != text:
        text = plain
    return text


def render(text: str | None, removed: frozenset[int] = frozenset()) -> str | None:
    """Clean text of a field without the branches whose numbers are in ``removed``."""
    if text is None:
        return None
    root = parse(unescaped(text))
    done: dict[int, str] = {}
    for n in reversed(list(walk(root))):
        done[id(n)] = _render(n, "".join(done.pop(id(c)) for c in n.children), removed)
    out = "".join(done[id(c)] for c in root.children)
    out = re.sub(r"[^\S\n]+", " ", out)
    out = re.sub(r" ?\n ?", "\n", out)
    return re.sub(r"\n{3,}", "\n\n", out).strip()


def _cells(row: str, sep: str) -> str:
    return " | ".join(render(c) or "" for c in re.split(sep, row))


def _latex(node: Node) -> str:
    body, name = node.text, node.name
    if name in ("display", "bracket", "inline", "script"):
        return f"\n{body}\n" if name == "display" else body
    if name == "environment":
        env = re.match(r"\\begin\{([a-zA-Z]+)\*?\}", body).group(1)
        inner = re.sub(r"^\\begin\{[^}]*\}(?:\{[^}]*\}|\[[^\]]*\])*|\\end\{[^}]*\}$", "", body)
        if env.startswith("tabular") or env in ("table", "longtable"):
            rows = [r for r in re.split(r"\\\\", re.sub(r"\\(?:hline|toprule|midrule|bottomrule)\b", "", inner)) if r.strip()]
            return "\n" + "\n".join(_cells(r.strip(), r"(?<!\\)&") for r in rows) + "\n"
        if env in ("itemize", "enumerate", "description"):
            return "\n" + "\n".join(f"- {render(i.strip())}" for i in re.split(r"\\item\b(?:\[[^\]]*\])?", inner) if i.strip()) + "\n"
        if env in ("equation", "align", "gather", "eqnarray", "displaymath", "multline", "math"):
            return f"\n$${inner.strip()}$$\n"
        if env in ("verbatim", "lstlisting"):
            return f"\n```\n{inner.strip()}\n```\n"
        return "\n" + (render(inner) or "") + "\n"
    m = re.match(r"~?\\([a-zA-Z]+)\*?(?:\[[^\]\n]*\])*((?:\{(?:[^{}]|\{[^{}]*\})*\})*)", body)
    if not m:
        return body[1:] if len(body) == 2 and body[1] in "%&_#{}$" else " "
    cmd, args = m.group(1), re.findall(r"\{((?:[^{}]|\{[^{}]*\})*)\}", m.group(2))
    if cmd in ("section", "subsection", "subsubsection", "chapter", "paragraph"):
        return f"\n{'#' * (1 + cmd.count('sub'))} {render(args[-1]) if args else ''}\n"
    if cmd in ("cite", "citep", "citet", "label", "ref", "eqref", "pageref", "hspace", "vspace", "bibliography"):
        return ""
    if cmd == "item":
        return "\n- "
    if cmd == "footnote":
        return f" ({render(args[-1]) if args else ''})"
    return (render(args[-1]) or "") if args else " "


def _render(node: Node, inner: str, removed: frozenset[int]) -> str:
    """Text of a node whose children came out as ``inner``."""
    if node.number in removed and node.number:
        return " "
    k, n, body = node.kind, node.name, node.text
    if not k:
        return body
    if k == "html":
        if n == "entity":
            return html.unescape(body)
        if n in ("comment", "script", "style", "head"):
            return " " if n == "comment" else ""
        if re.fullmatch(r"h[1-6]", n):
            return f"\n{'#' * int(n[1])} {inner.strip()}\n"
        if n == "li":
            return f"\n- {inner.strip()}\n"
        if n in ("td", "th"):
            return f"{inner.strip()} | "
        if n == "tr":
            return f"\n{inner.strip().rstrip('|').strip()}\n"
        if n == "pre":
            return f"\n```\n{inner.strip()}\n```\n"
        if n in ("code", "kbd", "samp", "tt"):
            return f"`{inner}`"
        if n in ("sup", "sub"):
            return f"{'^' if n == 'sup' else '_'}{{{inner}}}" if inner else ""
        return f"\n{inner}\n" if n in _BLOCK else inner
    if k == "latex":
        return _latex(node)
    if k == "wiki":
        if n == "heading":
            return f"\n{'#' * len(re.match(r' *(=+)', body).group(1))} {body.strip().strip('=').strip()}\n"
        if n == "table":
            rows = re.split(r"(?m)^\|-.*$", re.sub(r"^\s*\{\|[^\n]*|\|\}\s*$", "", body))
            lines = (" || ".join(x.strip().lstrip("|!").strip() for x in r.strip().split("\n")) for r in rows if r.strip())
            return "\n" + "\n".join(_cells(r, r"\|\||!!") for r in lines) + "\n"
        if n == "external":
            return body[1:-1].split(" ", 1)[1]
        return "" if n in ("template", "magic") else inner
    if n in ("heading",):
        return f"\n{body.strip()} "
    if n == "item":
        return "\n- "
    if n == "image":
        return f"\n{inner}\n"
    if n in ("fence", "code", "dashes"):
        return f"\n{body}\n" if n == "fence" else body
    return "" if n in ("footnote", "attribute", "rule", "quote", "table") else inner


_NODES = pa.schema(
    [("block_id", pa.int64()), ("host", pa.string()), ("field", pa.string()), ("node", pa.int32()), ("kind", pa.string()),
     ("path", pa.string()), ("style", pa.string()), ("content", pa.int64())]
)


def _hash(s: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(s.encode("utf-8", "replace")) - 2**63


def _contents(nodes: list[Node]) -> dict[int, int]:
    """Hash of each node's content, children before parents, so that any depth is linear."""
    out: dict[int, int] = {}
    for n in reversed(nodes):
        own = _hash(n.text)
        out[id(n)] = own if not n.children else _hash(f"{own},{','.join(str(out[id(c)]) for c in n.children)}")
    return out


def _nodes(ids: list, hosts: list, fields: list, texts: list) -> Iterator[tuple]:
    for i, host, field, text in zip(ids, hosts, fields, texts):
        nodes = list(walk(parse(unescaped(text))))
        if not any(n.kind for n in nodes):
            continue
        content = _contents(nodes)
        for n in nodes:
            if n.kind:
                variant = ",".join(c.style or c.name for c in n.children)
                yield i, host, field, n.number, n.kind, n.path, variant, content[id(n)]


def presentation_nodes(blocks: DataFrame) -> DataFrame:
    """Every presentation node of ``text`` and ``table_body`` with its place in the DOM."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            rows = list(_nodes(*(c.to_pylist() for c in b.columns)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_NODES), _NODES)], schema=_NODES
            )

    fields = fields_of(blocks).where(F.col("value").rlike(MAY_HOLD))
    return fields.transform(
        in_arrow, batches, "block_id bigint, host string, field string, node int, kind string, path string, style string, content bigint"
    )


def fields_of(blocks: DataFrame) -> DataFrame:
    """(block_id, host, field, value) of the two fields that may hold markup."""
    parts = F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in ("text", "table_body")])
    host = F.coalesce(F.col("paper_id"), F.concat(F.lit("#"), F.col("block_id").cast("string")))
    return (
        blocks.select(F.col("block_id").cast("bigint"), host.alias("host"), F.explode(parts).alias("p"))
        .select("block_id", "host", "p.field", "p.value")
        .where(F.col("block_id").isNotNull() & F.col("value").isNotNull())
    )


LOW, MIN_PAGES, DECAY = 0.2, 4, 0.9


def _entropy(n, m) -> object:
    p = n / m
    return F.sum(-p * F.log(p) / F.log(F.greatest(m, F.lit(2))))


def style_tree(nodes: DataFrame) -> DataFrame:
    """(host, path, pages, importance) of the merged style nodes."""
    at = ["host", "path"]
    pages = nodes.groupBy(*at).agg(F.approx_count_distinct("block_id").alias("pages"), F.count("*").alias("m"))

    def entropy(what: str) -> DataFrame:
        counts = nodes.groupBy(*at, what).agg(F.count("*").alias("n"))
        return counts.join(pages, at).groupBy(*at).agg(_entropy(F.col("n"), F.col("m")).alias(f"{what}_imp"))

    both = entropy("style").join(entropy("content"), at).join(pages, at)
    own = F.greatest(F.col("style_imp"), F.col("content_imp"))
    depth = F.size(F.split("path", "/")) - 2
    return both.select(
        *at, "pages", F.when(F.col("m") == 1, F.lit(1.0)).otherwise(own * F.pow(F.lit(DECAY), depth)).alias("importance")
    )


#: Nodes that give a text its structure; the branches that may go are all others of HTML, Markdown and wiki links.
STRUCTURE = (
    "h1 h2 h3 h4 h5 h6 p br hr ul ol li dl dt dd table thead tbody tfoot tr td th caption col colgroup sup sub code pre kbd samp tt math entity comment b i em strong u s "
    "blockquote q cite html body article section main figure figcaption"
).split()


def on_sites(nodes: DataFrame, sites: DataFrame | None) -> DataFrame:
    """Nodes with the site of their paper as host; ``sites``: (paper_id, site). Papers without a site keep their own tree."""
    if sites is None:
        return nodes
    known = sites.where(F.nullif(F.trim("site"), F.lit("")).isNotNull()).groupBy("paper_id").agg(F.min("site").alias("site"))
    return nodes.join(known.withColumnRenamed("paper_id", "host"), "host", "left").withColumn("host", F.coalesce("site", "host")).drop("site")


def low_branches(nodes: DataFrame) -> DataFrame:
    """(block_id, field, node): the branches of low importance that are no structure."""
    low = style_tree(nodes).where((F.col("importance") < LOW) & (F.col("pages") >= MIN_PAGES)).select("host", "path")
    name = F.regexp_replace(F.element_at(F.split("path", "/"), -1), r"[.].*$", "")
    link = F.col("path").rlike(r"/(markdown|wiki):(image|link|external)$")
    removable = nodes.where(((F.col("kind") == "html") & ~name.isin(*STRUCTURE)) | link)
    return removable.join(low, ["host", "path"], "left_semi").select("block_id", "field", "node")


def clean(blocks: DataFrame, sites: DataFrame | None = None) -> DataFrame:
    """(block_id, field, clean): the fields as clean text without low-importance branches; ``sites``: see ``on_sites``."""
    nodes = cut_lineage(on_sites(presentation_nodes(blocks), sites))  # parsed once, aggregated several times
    gone = low_branches(nodes).groupBy("block_id", "field").agg(F.collect_set("node").alias("gone"))
    fields = fields_of(blocks).join(gone, ["block_id", "field"], "left")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            texts = [render(v, frozenset(g or ())) for v, g in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string())], names=["block_id", "field", "clean"])

    holds = F.col("value").rlike(MAY_HOLD)
    parsed = fields.where(holds).select("block_id", "field", "value", "gone").transform(in_arrow, batches, "block_id bigint, field string, clean string")
    plain = fields_of(blocks).where(~holds).select("block_id", "field", tidy_blanks(F.col("value")).alias("clean"))
    return parsed.unionByName(plain)


def tidy_blanks(col: Column) -> Column:
    """What ``render`` does to the blanks of a text without markup, inside the JVM."""
    out = F.regexp_replace(F.regexp_replace(col, r"(?U)[^\S\n]+", " "), r" ?\n ?", "\n")
    return F.regexp_replace(F.regexp_replace(out, r"\n{3,}", "\n\n"), r"(?U)^\s+|\s+$", "")


def found(blocks: DataFrame) -> DataFrame:
    """(block_id, field, kind): the kinds of markup among a field's presentation nodes."""
    return presentation_nodes(blocks).select("block_id", "field", "kind").distinct()
