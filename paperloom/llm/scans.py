"""Scan noise: reading errors, split words and page furniture of blocks, and their repair.

Words are decided by the perceptron editor of ``scan_words``, furniture by that of
``scan_furniture``. Both decide beforehand what does not depend on a single block, so that
judging the blocks is one join with the evidence of their page and one narrow map.

Defined cases: null and empty texts give no row and repair to themselves; a block without
paper_id or page has no furniture evidence; a paper without numbers accepts any bare page
number form; texts are read whole; blocks delivered twice are judged each for itself.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paperloom.llm import scan_furniture as SF
from paperloom.llm import scan_words as SW
from paperloom.session import cut_lineage, in_arrow

MIN_MISREAD = 2

_INPUT = ("block_id", "type", "page_idx", "text", "top", "lines", "offset", "seq")


def _narrow(blocks: DataFrame) -> DataFrame:
    kept = blocks.where(F.col("block_id").isNotNull() & (F.length("text") > 0))
    top = F.when(F.size("bbox") == 4, F.get("bbox", F.lit(1)))
    return kept.select(F.col("block_id").cast("bigint"), "paper_id", SF.bucket().alias("bucket"), "seq", "type", "text", "page_idx", top.alias("top"))


def train_furniture(rows: list) -> SW.Perceptron:
    return SF.train(rows)


def _furniture(blocks: DataFrame, evidence: DataFrame) -> dict[str, float]:
    """Weights of the furniture perceptron from the blocks of the least hashes."""
    sample = _narrow(blocks).orderBy(F.xxhash64("block_id"), "block_id").limit(SF.TRAIN_BLOCKS)
    rows = sample.join(evidence, ["paper_id", "bucket"], "left").collect()
    return train_furniture(sorted(rows, key=lambda r: r["block_id"])).w


def judge(kind: str, page, text: str, top, lines: list, offset, first: bool, reader: SW.Reader, furniture: SW.Perceptron) -> list[str]:
    """The kinds of noise of one block."""
    out = []
    whole = text
    if SW.has_break(text):
        whole = reader.unbreak(text)
        if whole != text:
            out.append("hyphen")
    words = SW.words_of(whole.lower())
    if kind != "equation" and (kind != "page_number" or SF.is_prose(text)) and reader.misread_among(words) >= MIN_MISREAD:
        out.append("chars")
    return out + SF.furniture_kinds(kind, page, text, top, lines, offset, first, furniture, "".join(words).casefold())


def mend(kind: str, page, text: str, top, lines: list, offset, first: bool, reader: SW.Reader, furniture: SW.Perceptron) -> tuple[str, str]:
    """(type, text) of one block, repaired by the kinds that ``judge`` reports."""
    kinds = SF.furniture_kinds(kind, page, text, top, lines, offset, first, furniture)
    if kind in SF.FURNITURE:
        if "body" not in kinds:
            return kind, ""
        kind = "text"
    if "page_no" in kinds:
        return "page_number", ""
    if "running" in kinds:
        held = sorted(SF.lines_held(kind, text, top, lines, first, furniture), reverse=True)
        if any(whole for _, _, whole in held):
            return "header", ""
        for start, end, _ in held:
            head = re.sub(r"\s*(?:\b\d{1,5}\s{2,})?[(\[]?$", "", text[:start])
            tail = re.sub(r"^[^\w\s]{0,2}(?:\s{2,}\d{1,5}\b)?\s*", "", text[end:])
            text = f"{head} {tail}"
    return kind, reader.repair(text) if kind != "equation" else text


def _judged(blocks: DataFrame, schema: pa.Schema, ddl: str, f: Callable) -> DataFrame:
    """Rows that ``f`` gives for each block, with its evidence and the decisions on its words."""
    evidence = cut_lineage(SF.paper_evidence(blocks, SF.evidence_rows(blocks)))
    rows, shared = SW.with_decisions(blocks, _narrow(blocks))
    rows = rows.join(evidence, ["paper_id", "bucket"], "left").select(*_INPUT, *(("fixes", "joins") if shared is None else ()))
    weights = _furniture(blocks, evidence)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        furniture = SW.Perceptron(weights)
        common = SW.reader_of(shared.value, None, None) if shared is not None else None
        for b in it:
            out = [
                (i, *row)
                for i, kind, page, text, top, lines, offset, seq, *own in zip(*(c.to_pylist() for c in b.columns))
                for row in f(kind or "", page, text, top, lines or [], offset, seq in (0, 1), common or SW.reader_of(None, *own), furniture)
            ]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], x.type) for k, x in enumerate(schema)], schema=schema)

    return rows.transform(in_arrow, batches, ddl)


def found(blocks: DataFrame) -> DataFrame:
    """(block_id, kind): the kinds of scan noise of every block."""
    schema = pa.schema([("block_id", pa.int64()), ("kind", pa.string())])
    return _judged(blocks, schema, "block_id bigint, kind string", lambda *a: [(k,) for k in judge(*a)]).distinct()


def repaired(blocks: DataFrame) -> DataFrame:
    """(block_id, type, clean): text of every block without furniture and errors, its type set right.

    A block that is furniture keeps an empty text; prose typed as furniture becomes text.
    """
    schema = pa.schema([("block_id", pa.int64()), ("type", pa.string()), ("clean", pa.string())])
    return _judged(blocks, schema, "block_id bigint, type string, clean string", lambda *a: [mend(*a)])


#: Places of a paper that are numbered together; windows never hold more rows.
SEQ_BUCKET = 1_000


def paragraphs(blocks: DataFrame) -> DataFrame:
    """(paper_id, block_id, parts, text): continuous paragraphs of each paper, also over page breaks.

    A repaired text block goes on with the next one, whatever furniture stands between, where
    it has no end of a sentence and the next begins with a small letter. Of rows delivered
    twice the first block counts. Order inside a paper is found in buckets of SEQ_BUCKET
    places, whose borders meet in a window over one row a bucket, so that a paper of any size
    is spread.
    """
    place = blocks.where(F.col("block_id").isNotNull() & F.col("paper_id").isNotNull()).select(F.col("block_id").cast("bigint"), "paper_id", "seq", "page_idx", F.coalesce("text_level", F.lit(0)).alias("level"))
    body = repaired(blocks).where((F.col("type") == "text") & (F.col("clean") != ""))
    rows = place.join(body, "block_id").groupBy("paper_id", "seq").agg(F.min(F.struct("block_id", "level", "clean")).alias("r")).select("paper_id", "seq", "r.*")
    rows = rows.withColumn("bucket", F.floor(F.col("seq") / SEQ_BUCKET))
    rows = rows.withColumn("open", (F.col("level") == 0) & ~F.rtrim("clean").rlike(r"[.!?。！？:：;；][\"”’')\]]*$")).withColumn("small", (F.col("level") == 0) & F.col("clean").rlike(r"^\p{Ll}"))
    rows = cut_lineage(rows)
    inside = Window.partitionBy("paper_id", "bucket").orderBy("seq")
    last = rows.groupBy("paper_id", "bucket").agg(F.max(F.struct("seq", "open")).alias("last"))
    over = Window.partitionBy("paper_id").orderBy("bucket")
    borders = last.select("paper_id", "bucket", F.lag("last.open").over(over).alias("open_before"))
    before = F.coalesce(F.lag("open").over(inside), F.when(F.row_number().over(inside) == 1, F.col("open_before")), F.lit(False))
    starts = rows.join(borders, ["paper_id", "bucket"]).withColumn("starts", (~(before & F.col("small"))).cast("bigint"))
    counted = starts.withColumn("k", F.sum("starts").over(inside.rowsBetween(Window.unboundedPreceding, 0)))
    totals = starts.groupBy("paper_id", "bucket").agg(F.sum("starts").alias("own"))
    totals = totals.select("paper_id", "bucket", F.coalesce(F.sum("own").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    numbered = counted.join(totals, ["paper_id", "bucket"]).withColumn("para", F.col("base") + F.col("k"))
    parts = F.sort_array(F.collect_list(F.struct("seq", "block_id", "clean")))
    joined = numbered.groupBy("paper_id", "para").agg(parts.alias("p"))
    return joined.select("paper_id", F.get("p", F.lit(0))["block_id"].alias("block_id"), F.size("p").alias("parts"), F.array_join(F.transform("p", lambda x: x["clean"]), " ").alias("text"))
