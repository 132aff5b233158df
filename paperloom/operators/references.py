"""Bibliography entries: splitting, joining with parsed items, payloads."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.functions import bibliography as B
from paperloom.functions import text as T
from paperloom.session import cut_lineage, in_arrow

#: A number that may open an entry: in brackets, or with or without a full stop.
_MARK = re.compile(r"\[(\d{1,4})\]\s+|(?<![\w.,/–-])(\d{1,4})[.)]?\s+")
_YEAR = re.compile(r"(?<!\d)(?:1[89]|20)\d{2}(?!\d)")
MIN_ENTRY = 6
#: Pages of a reference list that are split together.
LIST_PAGES = 64


def _opens(text: str, at: int) -> bool:
    """What stands at ``at`` can begin an entry: a capital, a letter without case, a quote or a bracket."""
    c = text[at : at + 1]
    return bool(c) and (c in "\"'(“«" or (c.isalpha() and not c.islower()))


class EntryFolder:
    """Folds the rows of one list, in order, into entries (number or None, raw).

    A bracketed number opens an entry wherever an entry can begin after it. A number with a
    full stop or none opens one only at a row's beginning or after a full stop, and only as
    successor of the one before. A row without marks goes on with the entry before it. A list
    without any number has one entry a row, where dated rows open one.
    """

    def __init__(self, last: int = 0):
        self.last = last
        self.entries: list[list] = []
        self.rows: list[str] = []
        self.leading = ""

    def add(self, text: str | None) -> None:
        text = (text or "").strip()
        if not text:
            return
        self.rows.append(text)
        cuts: list[tuple[int, int]] = []
        for m in _MARK.finditer(text):
            if not _opens(text, m.end()):
                continue
            if m.group(1):
                cuts.append((m.start(), int(m.group(1))))
            elif int(m.group(2)) == self.last + 1 and (m.start() == 0 or text[: m.start()].rstrip().endswith(".")):
                self.last += 1
                cuts.append((m.start(), self.last))
        head = text[: cuts[0][0]] if cuts else text
        if head.strip():
            self._go_on(head.strip())
        for (at, n), end in zip(cuts, [c[0] for c in cuts[1:]] + [len(text)]):
            raw = text[at:end].strip()
            if len(raw) >= MIN_ENTRY:
                self.entries.append([n, raw])

    def _go_on(self, text: str) -> None:
        if self.entries:
            self.entries[-1][1] += " " + text
        else:
            self.leading = f"{self.leading} {text}".strip()

    def finish(self, first: bool) -> list[tuple[int, int | None, str]]:
        """(place, number, raw); place 0 goes on with the entry before this part of the list."""
        if not self.entries:
            parts: list[str] = []
            for text in self.rows:
                if parts and not (_opens(text, 0) and _YEAR.search(text)):
                    parts[-1] += " " + text
                elif len(text) >= MIN_ENTRY:
                    parts.append(text)
            return [(k, None, raw) for k, raw in enumerate(dict.fromkeys(parts), 1)]
        out = list(dict.fromkeys((n, raw) for n, raw in self.entries))
        if self.leading and first:
            out.insert(0, (None, self.leading))
        rows = [(k, n, raw) for k, (n, raw) in enumerate(out, 1)]
        return [(0, None, self.leading), *rows] if self.leading and not first else rows


def split_rows(texts: list[str], last: int = 0) -> list[tuple[int | None, str]]:
    """(number, raw) of the entries in the rows of one reference list; ``last``: the dotted number before it."""
    folder = EntryFolder(last)
    for text in texts:
        folder.add(text)
    return [(n, raw) for _, n, raw in folder.finish(True)]


_SPLIT = pa.schema([("paper_id", pa.string()), ("chunk", pa.int32()), ("k", pa.int32()), ("n", pa.int32()), ("raw", pa.string())])


def split_entries(rows: DataFrame) -> DataFrame:
    """(paper_id, pos, n, raw): the entries of each paper's reference rows.

    A list is split in order, in parts of LIST_PAGES pages; a part after the first takes up
    the count where its first numbered row stands, and what it begins with before any entry
    goes on with the last entry of the part before. Tasks fold their sorted parts in one
    stream. Positions run over the whole paper.
    """

    def fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, folder = None, None
        out: list[tuple] = []

        def close() -> None:
            if folder is not None:
                out.extend((*part, *row) for row in folder.finish(part[1] == 0))

        for b in it:
            for paper, chunk, content in zip(*(b.column(k).to_pylist() for k in (0, 1, 4))):
                if part != (paper, chunk):
                    close()
                    part, folder = (paper, chunk), EntryFolder()
                if chunk > 0 and not folder.entries and (m := _MARK.match((content or "").strip())) and m.group(2) and _opens(content.strip(), m.end()):
                    folder.last = int(m.group(2)) - 1
                folder.add(content)
            yield _split_batch(out)
            out.clear()
        close()
        yield _split_batch(out)

    chunk = F.floor(F.col("page_idx") / LIST_PAGES).cast("int").alias("chunk")
    refs = rows.where((F.col("kind") == "reference") & F.col("paper_id").isNotNull()).select("paper_id", chunk, "seq", "sub", "content")
    ordered = refs.repartition("paper_id", "chunk").sortWithinPartitions("paper_id", "chunk", "seq", "sub")
    parts = ordered.transform(in_arrow, fold, "paper_id string, chunk int, k int, n int, raw string")
    # only lists of several parts need the places of the parts before
    w = Window.partitionBy("paper_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    parts = cut_lineage(parts)
    sizes = parts.groupBy("paper_id", "chunk").agg(F.max("k").alias("c"))
    before = sizes.select("paper_id", "chunk", F.coalesce(F.sum("c").over(w), F.lit(0)).alias("before")).where("chunk > 0")
    placed = parts.join(before, ["paper_id", "chunk"], "left").select("paper_id", "chunk", (F.coalesce("before", F.lit(0)) + F.col("k")).cast("int").alias("pos"), "k", "n", "raw")
    tails = placed.where("k = 0").groupBy("paper_id", "pos").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chunk", "raw"))), lambda x: x["raw"]), " ").alias("tail"))
    whole = placed.where("k > 0").join(tails, ["paper_id", "pos"], "left")
    return whole.select("paper_id", "pos", "n", F.concat_ws(" ", "raw", "tail").alias("raw"))


def _split_batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(_SPLIT)], schema=_SPLIT)


def bracket_entries(rows: DataFrame) -> DataFrame:
    """(paper_id, n, raw): entries of lists with bracketed numbers, without leaving the JVM."""
    refs = rows.where(F.col("kind") == "reference")
    pieces = F.split("content", r"(?=\[\d{1,4}\]\s+[A-Z\"'(])")
    e = refs.select("paper_id", F.explode(pieces).alias("raw")).withColumn("raw", F.trim("raw"))
    n = F.regexp_extract("raw", r"^\[(\d{1,4})\]", 1)
    return e.where((n != "") & (F.length("raw") >= MIN_ENTRY)).select("paper_id", n.cast("int").alias("n"), "raw").distinct()


def identifiers(refs: DataFrame) -> DataFrame:
    """refs with ``doi_found``, ``arxiv_found``, ``year_found`` and ``number_found`` from the raw text."""
    return refs.select(
        "*", B.doi(F.col("raw")).alias("doi_found"), B.arxiv(F.col("raw")).alias("arxiv_found"),
        B.year(F.col("raw")).alias("year_found"), B.entry_number(F.col("raw")).alias("number_found"),
    )


def join_items(entries: DataFrame, items: DataFrame, tolerance: float = 0.2) -> DataFrame:
    """Entries with the fields of parsed items, joined on the number, else on the position.

    ``items`` of a paper are not used if their count differs from the entries' by more
    than two and by more than ``tolerance``. The DOI of the raw text overrides the item's.
    """
    ne = entries.groupBy("paper_id").agg(F.count("*").alias("ne"), F.count("n").alias("numbered"))
    ni = items.groupBy("paper_id").agg(F.count("*").alias("ni"))
    usable = ne.join(ni, "paper_id").where(F.abs(F.col("ne") - F.col("ni")) <= F.greatest(F.lit(2.0), F.col("ne") * tolerance))
    w = Window.partitionBy("paper_id").orderBy("item_pos")
    it = items.join(usable.select("paper_id", "numbered"), "paper_id").withColumn("pos", F.row_number().over(w))
    first = it.where("n is not null").groupBy("paper_id", "n").agg(F.min(F.struct("pos", "title", "authors", "year", "venue", "doi")).alias("i"))
    by_pos = it.where("numbered = 0").select("paper_id", "pos", F.struct("pos", "title", "authors", "year", "venue", "doi").alias("j"))
    e = entries.join(first, ["paper_id", "n"], "left").join(by_pos, ["paper_id", "pos"], "left")
    g = lambda f: F.coalesce(F.col(f"i.{f}"), F.col(f"j.{f}"))
    hit = F.col("i").isNotNull() | F.col("j").isNotNull()
    return e.select(
        "paper_id", "pos", "n", "raw", F.when(hit, F.lit("item")).otherwise(F.lit("rule")).alias("source"),
        B.title(g("title"), F.col("raw")).alias("title"), B.sane_authors(g("authors")).alias("authors"),
        B.sane_year(g("year")).alias("year"), g("venue").alias("venue"),
        F.coalesce(B.doi(F.col("raw")), g("doi")).alias("doi"), B.arxiv(F.col("raw")).alias("arxiv_id"),
    )


def payload(refs: DataFrame) -> DataFrame:
    """(paper_id, json): the reference list of each paper as one document; none for papers without."""
    fields = F.struct("n", "raw", "title", "authors", "year", "venue", "doi", "arxiv_id")
    own = F.struct(F.coalesce("n", F.lit(2**31 - 1)).alias("o"), F.col("ref_id"), fields.alias("entry"))
    grouped = refs.groupBy("paper_id").agg(F.count("*").alias("count"), F.sort_array(F.collect_list(own)).alias("e"))
    entries = F.transform("e", lambda x: x["entry"])
    doc = F.struct(F.lit(1).alias("version"), F.lit("rule").alias("source"), "count", entries.alias("references"))
    return grouped.select("paper_id", F.to_json(doc).alias("json"))


def enrich(refs: DataFrame, items: DataFrame) -> DataFrame:
    """Fills fields of structured entries by position where no entry of the paper has any and the counts match."""
    bare = refs.groupBy("paper_id").agg(
        F.count("*").alias("c"),
        F.max(F.coalesce(F.col("title"), F.col("venue"), F.col("doi"), F.col("year").cast("string")).isNotNull()).alias("any"),
    )
    n = items.groupBy("paper_id").agg(F.count("*").alias("m"))
    ok = bare.join(n, "paper_id").where(~F.col("any") & (F.col("c") == F.col("m"))).select("paper_id")
    it = items.join(ok, "paper_id", "left_semi").select("paper_id", F.col("item_pos").alias("pos"), F.col("title").alias("it"), F.col("year").alias("iy"))
    return refs.join(it, ["paper_id", "pos"], "left").withColumn("title", F.coalesce("title", "it")).withColumn("year", F.coalesce("year", "iy")).drop("it", "iy")


def reference_text_share(blocks: DataFrame) -> DataFrame:
    """(paper_id, entries, chars): how much of a paper's text is bibliography."""
    r = blocks.where((F.col("type") == "ref_text") & (F.length(T.collapse(F.col("text"))) > 0))
    return r.groupBy("paper_id").agg(F.count("*").alias("entries"), F.sum(F.length("text")).alias("chars"))
