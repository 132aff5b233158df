"""Adjacency-table shredding of deeply nested records.

A record (an XML string) becomes rows of one adjacency table:

``node``     number of the node in document order, from 0
``parent``   number of its parent, null for the root
``label``    element name without namespace, ``@name`` for an attribute
``ordinal``  position among the siblings with the same label, from 1
``scalar``   own text of an element (beside element children only if it is not blank), value of an
             attribute
``path``     labels from the root to the parent, the chosen attributes' values added
             as ``label=value``
``anc``      node numbers from the root to the parent, in step with ``path``

Parsing is one streaming pass per record inside an Arrow batch; everything after
it (choosing objects, numbering, joining parents, pivoting scalars into entity
tables) is declarative. The labels that a plan needs can be named, and then only
those nodes leave the Python worker.

Defined cases: null, empty and not well-formed records give no rows; records with
equal id and equal text count once; records with one id and different texts stay
apart through ``rec``, the hash of the text; a record without an id has nothing to tie
its rows to and gives none; comments and processing instructions
are no nodes; further input columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paperloom.session import in_arrow

NODE_SCHEMA = (
    "id bigint, rec bigint, node int, parent int, label string, ordinal int, "
    "scalar string, path array<string>, anc array<int>"
)
_ARROW = pa.schema(
    [
        ("id", pa.int64()), ("rec", pa.int64()), ("node", pa.int32()), ("parent", pa.int32()),
        ("label", pa.string()), ("ordinal", pa.int32()), ("scalar", pa.string()),
        ("path", pa.list_(pa.string())), ("anc", pa.list_(pa.int32())),
    ]
)
#: Rows that a worker gathers before it hands an Arrow batch on.
BATCH_ROWS = 20_000


class _Builder:
    """Collects the nodes of one record from the parser's events."""

    def __init__(self, keep: frozenset[str] | None, role_attrs: frozenset[str]):
        self.keep, self.role_attrs = keep, role_attrs
        self.rows: list[list] = []
        self.next = 0
        self.path: list[str] = []
        self.anc: list[int] = []
        self.counts: list[dict[str, int]] = [{}]
        self.text: list[list[str]] = []
        self.mixed: list[bool] = []
        self.open: list[list | None] = []

    def _ordinal(self, label: str) -> int:
        seen = self.counts[-1]
        seen[label] = seen.get(label, 0) + 1
        return seen[label]

    def _add(self, label: str, scalar: str | None) -> list | None:
        node, self.next = self.next, self.next + 1
        ordinal = self._ordinal(label)
        if self.keep is not None and label not in self.keep:
            return None
        row = [node, self.anc[-1] if self.anc else None, label, ordinal, scalar, tuple(self.path), tuple(self.anc)]
        self.rows.append(row)
        return row

    def start(self, name: str, attrs: list[str]) -> None:
        label = name.rpartition(" ")[2]
        if self.mixed:
            self.mixed[-1] = True
        node = self.next
        row = self._add(label, None)
        step = label
        for k, v in zip(attrs[::2], attrs[1::2]):
            if (short := k.rpartition(" ")[2]) in self.role_attrs:
                step += f"={v}"
        self.path.append(step)
        self.anc.append(node)
        self.counts.append({})
        self.open.append(row)
        self.text.append([])
        self.mixed.append(False)
        for k, v in zip(attrs[::2], attrs[1::2]):
            self._add("@" + k.rpartition(" ")[2], v)

    def data(self, chunk: str) -> None:
        if self.text:
            self.text[-1].append(chunk)

    def end(self, _name: str) -> None:
        for stack in (self.path, self.anc, self.counts):
            stack.pop()
        row, own, mixed = self.open.pop(), "".join(self.text.pop()), self.mixed.pop()
        if row is not None and (own.strip() or not mixed):
            row[4] = own


def parse_record(
    xml: str | None, keep: frozenset[str] | None = None, role_attrs: frozenset[str] = frozenset()
) -> list[list] | None:
    """Rows ``[node, parent, label, ordinal, scalar, path, anc]``; None if not well-formed."""
    if not xml or not xml.strip():
        return None
    b = _Builder(keep, role_attrs)
    p = expat.ParserCreate("utf-8", " ")
    p.ordered_attributes = True
    p.buffer_text = True
    p.StartElementHandler, p.EndElementHandler, p.CharacterDataHandler = b.start, b.end, b.data
    try:
        p.Parse(xml.encode("utf-8", "replace"), True)
    except expat.ExpatError:
        return None
    return b.rows


def shred(
    df: DataFrame,
    id_col: str,
    xml_col: str,
    labels: Iterable[str] | None = None,
    role_attrs: Iterable[str] = (),
) -> DataFrame:
    """The adjacency table of every well-formed record of ``df``.

    ``labels``: the labels whose nodes are wanted, all if None.
    ``role_attrs``: attributes whose values qualify the steps of ``path``.
    """
    keep = None if labels is None else frozenset(labels)
    roles = frozenset(role_attrs)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cols: list[list] = [[] for _ in _ARROW]

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _ARROW)], schema=_ARROW)
            for c in cols:
                c.clear()
            return out

        for batch in it:
            for i, rec, xml in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                for row in parse_record(xml.as_py(), keep, roles) or ():
                    for c, v in zip(cols, (i, rec, *row)):
                        c.append(v)
                if len(cols[0]) >= BATCH_ROWS:
                    yield flush()
        if cols[0]:
            yield flush()

    narrow = df.select(
        F.col(id_col).cast("bigint").alias("id"), F.xxhash64(F.col(xml_col)).alias("rec"), F.col(xml_col).alias("xml")
    ).where(F.col("xml").isNotNull())
    return narrow.transform(in_arrow, batches, NODE_SCHEMA)


@dataclass(frozen=True)
class Kind:
    """Rows of one entity: which nodes are its objects and what they hang on.

    ``where``: condition over ``label``, ``path`` and ``anc``.
    ``parents``: (kind, condition on a step of ``path``) tried in turn; the nearest
    step that fulfils the condition is the parent. None fits: the record itself.
    """

    name: str
    where: Column
    parents: Sequence[tuple[str, object]] = ()


def has_step(*names: str) -> Column:
    """Some ancestor has one of these labels."""
    return F.exists("path", lambda s: F.substring_index(s, "=", 1).isin(*names))


def nearest(test) -> Column:
    """Node number of the innermost ancestor whose step passes ``test``, else null."""
    hit = F.filter(F.zip_with("path", "anc", lambda s, a: F.when(test(s), a)), lambda a: a.isNotNull())
    return F.try_element_at(hit, F.lit(-1))


def objects(nodes: DataFrame, kinds: Sequence[Kind]) -> DataFrame:
    """The object nodes: id, rec, node, kind, parent_kind, parent_node."""
    kind = F.coalesce(*[F.when(k.where, F.lit(k.name)) for k in kinds])
    found = nodes.withColumn("kind", kind).where(F.col("kind").isNotNull())
    at = F.lit(None).cast("struct<parent_kind:string,parent_node:int>")
    for k in kinds:
        for parent, test in k.parents:
            node = nearest(test)
            at = F.coalesce(
                at,
                F.when(
                    (F.col("kind") == k.name) & node.isNotNull(),
                    F.struct(F.lit(parent).alias("parent_kind"), node.alias("parent_node")),
                ),
            )
    return found.withColumn("at", at).select(
        "id", "rec", "node", "kind", F.col("at.parent_kind"), F.col("at.parent_node")
    )


def numbered(objs: DataFrame, root_kind: str = "article", parents: Sequence[str] | None = None) -> DataFrame:
    """Objects with ``pos`` (count of the kind in document order) and the parent's pos.

    ``parents``: the kinds that can be parents, all if None; others need not meet anyone.

    A child meets its parent by co-grouping on (id, rec, node): each object stands
    once under its own number, as a parent, and once under its parent's, as a child.
    All windows keep the partitioning by id, so nothing is shuffled again. An object
    whose parent is no object of the named kind hangs on the record, with pos 0.
    """
    w = Window.partitionBy("id", "rec", "kind").orderBy("node")
    placed = objs.withColumn("pos", F.row_number().over(w))
    sides = F.array(
        F.struct(F.lit(False).alias("is_parent"), F.col("parent_node").alias("key")),
        F.struct(F.lit(True).alias("is_parent"), F.col("node").alias("key")),
    )
    meet = Window.partitionBy("id", "rec", "key")
    may = F.lit(True) if parents is None else F.col("kind").isin(*parents)
    joined = (
        placed.select("*", F.explode(sides).alias("side"))
        .select("*", "side.is_parent", "side.key")
        .where(~F.col("is_parent") | may)
        .withColumn("met", F.max(F.when(F.col("is_parent"), F.struct("kind", "pos"))).over(meet))
        .where(~F.col("is_parent"))
    )
    fits = F.col("parent_node").isNotNull() & (F.col("met.kind") == F.col("parent_kind"))
    return joined.select(
        "id",
        "rec",
        "node",
        "kind",
        "pos",
        F.when(fits, F.col("parent_kind")).otherwise(F.lit(root_kind)).alias("parent_kind"),
        F.when(fits, F.col("met.pos")).otherwise(F.lit(0)).alias("parent_pos"),
    )


def entity_table(adjacency: DataFrame, objs: DataFrame, kind: str, columns: dict[str, Column], steps: tuple[str, ...]) -> DataFrame:
    """One row per object of ``kind``, its scalar descendants pivoted into columns.

    ``columns``: result column -> condition that picks the scalar node (over
    ``label`` and ``path``); the first in document order is taken. ``steps``: the
    labels of the object's own element, by which a scalar finds its object; the element's own
    text counts too.
    """
    rows = objs.where(F.col("kind") == kind)
    name = F.coalesce(*[F.when(c, F.lit(n)) for n, c in columns.items()])
    own = F.when(F.col("label").isin(*steps), F.col("node")).otherwise(nearest(lambda s: F.substring_index(s, "=", 1).isin(*steps)))
    scalars = (
        adjacency.withColumn("name", name)
        .where(F.col("name").isNotNull() & F.col("scalar").isNotNull())
        .select("id", "rec", own.alias("node"), F.col("name"), F.struct("node", F.trim("scalar").alias("v")).alias("s"))
        .where(F.col("node").isNotNull())
        .groupBy("id", "rec", "node")
        .agg(*[F.min(F.when(F.col("name") == n, F.col("s"))).getField("v").alias(n) for n in columns])
    )
    return rows.join(scalars, ["id", "rec", "node"], "left")


#: Labels that the article entities need; other nodes stay in the worker.
ARTICLE_LABELS = (
    "contrib", "author", "aff", "affiliation", "kwd", "keyword", "sec", "section", "fig", "figure",
    "table-wrap", "table", "caption", "ref", "bib-reference", "name", "string-name", "collab",
)
ARTICLE_ROLES = ("contrib-type", "person-group-type")


def _is(*names: str):
    return lambda s: F.substring_index(s, "=", 1).isin(*names)


def article_kinds() -> list[Kind]:
    """The entities of a scholarly article, for both publisher dialects."""
    label, parent = F.col("label"), F.element_at("path", -1)
    step = F.substring_index(parent, "=", 1)
    in_abstract, in_ref = has_step("abstract"), has_step("ref", "bib-reference")
    in_sec = has_step("sec", "section") & ~in_abstract
    sec = ("sec", _is("sec", "section"))
    editor = F.exists("path", lambda s: F.lower(s).endswith("=editor"))
    own_name = ~step.isin("name", "string-name", "collab", "author")
    return [
        Kind("author", (label == "contrib") & (F.coalesce("role", F.lit("author")) == "author") & ~in_ref),
        Kind("author", (label == "author") & ~in_ref & has_step("author-group")),
        Kind("aff", label.isin("aff", "affiliation") & ~in_ref,
             [("author", lambda s: s.isin("contrib", "contrib=author", "author"))]),
        Kind("kwd", label.isin("kwd", "keyword") & has_step("kwd-group", "keywords")),
        Kind("sec", label.isin("sec", "section") & ~in_abstract, [sec]),
        Kind("fig", label.isin("fig", "figure") & in_sec & F.col("captioned"), [sec]),
        Kind("table", label.isin("table-wrap", "table") & in_sec & F.col("captioned") & ~has_step("table-wrap"), [sec]),
        Kind("ref", label.isin("ref", "bib-reference")),
        Kind("ref_author", label.isin("name", "string-name", "collab", "author") & in_ref & ~editor & own_name,
             [("ref", _is("ref", "bib-reference"))]),
    ]


#: Scalar or marker children that an article's object nodes are joined with.
_CHILDREN = ("@contrib-type", "caption")


def with_children(adjacency: DataFrame) -> DataFrame:
    """Each node once, joined with its children: ``role`` (@contrib-type), ``captioned``.

    The rows are partitioned by record once; a child is co-grouped with its object
    under the object's number. Repeated records fall together here.
    """
    child = F.col("label").isin(*_CHILDREN)
    own = F.when(~child, F.struct("label", "path", "anc"))
    return (
        adjacency.repartition("id")
        .groupBy("id", "rec", F.when(child, F.col("parent")).otherwise(F.col("node")).alias("node"))
        .agg(
            F.max(own).alias("own"),
            F.max(F.when(F.col("label") == "@contrib-type", F.lower("scalar"))).alias("role"),
            F.coalesce(F.max(F.col("label") == "caption"), F.lit(False)).alias("captioned"),
        )
        .where(F.col("own").isNotNull() & F.col("id").isNotNull())
        .select("id", "rec", "node", "own.label", "own.path", "own.anc", "role", "captioned")
    )


def article_objects(adjacency: DataFrame) -> DataFrame:
    """The numbered objects of an article's adjacency table."""
    kinds = article_kinds()
    return numbered(objects(with_children(adjacency), kinds), "article", sorted({p for k in kinds for p, _ in k.parents}))


def article_nodes(df: DataFrame, id_col: str = "xml_id", xml_col: str = "xml") -> DataFrame:
    """Each node of the article entities with its number and its parent's."""
    return article_objects(shred(df, id_col, xml_col, (*ARTICLE_LABELS, "@contrib-type"), ARTICLE_ROLES))
