"""Byte-level BPE over a whole corpus with a public vocabulary.

A pre-token's symbols stand in a doubly linked list; a priority queue holds the
ranks of the pairs that may merge. The least rank (leftmost on ties) merges first;
an entry whose symbols have since changed is stale and skipped. Decoding
concatenates the vocabulary's byte strings.

Encoding is a narrow, shuffle-free map: each Arrow batch goes through one worker,
whose cache of pre-tokens is bounded (``CACHE_TOKENS``) and only saves time; what
falls out of it is encoded again. The vocabulary file is a parameter; its folder is
read on the workers, its size is fixed by its vocabulary.

Defined cases: null and empty texts give an empty list; texts of any length are
encoded whole; lone surrogates cannot occur in a Spark string; strings of special
tokens are ordinary text; repeated ids are encoded row by row.
"""

from __future__ import annotations

import base64
import heapq
from array import array
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import in_arrow

#: Pre-tokens whose ids a worker keeps at most.
CACHE_TOKENS = 400_000
VOCABULARY = "byte_bpe_50k.tiktoken"


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file, from the installed package of public tokenizers."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


@lru_cache(maxsize=4)
def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    n = len(word)
    end = list(range(1, n + 1))  # symbol that starts at i ends before end[i]; 0: merged away
    prev = list(range(-1, n - 1))
    queue: list[tuple[int, int, int]] = []
    get = ranks.get
    for i in range(n - 1):
        if (r := get(word[i : i + 2])) is not None:
            queue.append((r, i, i + 2))
    heapq.heapify(queue)
    while queue:
        _, i, stop = heapq.heappop(queue)
        mid = end[i]
        if not mid or mid >= n or end[mid] != stop:
            continue  # stale: one of its symbols has changed
        end[i] = stop
        end[mid] = 0
        if stop < n:
            prev[stop] = i
            if (r := get(word[i : end[stop]])) is not None:
                heapq.heappush(queue, (r, i, end[stop]))
        if (p := prev[i]) >= 0 and (r := get(word[p:stop])) is not None:
            heapq.heappush(queue, (r, p, stop))
    ids, i = [], 0
    while i < n:
        ids.append(ranks[word[i : end[i]]])
        i = end[i]
    return ids


@lru_cache(maxsize=4)
def encoder(path: str) -> Callable[[str | None], list[int]]:
    """A function from a text to its ids; it keeps the cache of this worker."""
    import public_tokenizers
    import regex

    ranks = load_ranks(path)
    split = regex.compile(public_tokenizers.PATTERN).findall
    cache: dict[str, tuple[int, ...]] = {}

    def encode(text: str | None) -> list[int]:
        if not text:
            return []
        out: list[int] = []
        get, extend = cache.get, out.extend
        for token in split(text):
            ids = get(token)
            if ids is None:
                if len(cache) >= CACHE_TOKENS:
                    cache.clear()
                ids = tuple(merge(token.encode("utf-8"), ranks))
                if len(token) <= 64:
                    cache[token] = ids
            extend(ids)
        return out

    return encode


def decode(ids: list[int], path: str) -> str:
    """The text of ``ids``: their byte strings one after another."""
    return b"".join(_strings(path)[i] for i in ids).decode("utf-8", "replace")


@lru_cache(maxsize=4)
def _strings(path: str) -> dict[int, bytes]:
    return {v: k for k, v in load_ranks(path).items()}


#: Ids that a worker gathers before it hands a part of a batch on.
FLAT_IDS = 20_000_000


def encode_corpus(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None) -> DataFrame:
    """(id, ids) of every row; the ids of a batch go into one flat buffer of 32-bit numbers."""
    where = path or vocabulary_path()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(where)

        def out(batch: pa.RecordBatch, start: int, flat: array, ends: array) -> pa.RecordBatch:
            ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))
            return pa.RecordBatch.from_arrays([batch.column(0).slice(start, len(ends) - 1), ids], names=["id", "ids"])

        for batch in it:
            start, flat, ends = 0, array("i"), array("i", [0])
            for k, text in enumerate(batch.column(1)):
                flat.extend(encode(text.as_py()))
                ends.append(len(flat))
                if len(flat) > FLAT_IDS:  # long texts: the batch goes on in parts
                    yield out(batch, start, flat, ends)
                    start, flat, ends = k + 1, array("i"), array("i", [0])
            yield out(batch, start, flat, ends)

    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("x")).transform(in_arrow, batches, "id bigint, ids array<int>")


def decode_corpus(df: DataFrame, id_col: str = "doc_id", ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """(id, text) of every row of token ids; a null list gives a null text."""
    where = path or vocabulary_path()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            texts = [None if x is None else decode(x, where) for x in (v.as_py() for v in batch.column(1))]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["id", "text"])

    return df.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).alias("x")).transform(in_arrow, batches, "id bigint, text string")


def round_trip(df: DataFrame, text_col: str = "text", path: str | None = None) -> DataFrame:
    """One row (docs, same, tokens): texts, those that their ids give back (null as empty), and all their ids; encoded once, nothing shuffled but sums."""
    where = path or vocabulary_path()

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(where)
        for batch in it:
            docs = same = tokens = 0
            for text in batch.column(0):
                own = text.as_py() or ""
                ids = encode(own)
                docs, same, tokens = docs + 1, same + (decode(ids, where) == own), tokens + len(ids)
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.int64()) for v in (docs, same, tokens)], names=["docs", "same", "tokens"])

    parts = df.select(text_col).transform(in_arrow, batches, "docs bigint, same bigint, tokens bigint")
    return parts.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("docs", "same", "tokens")])
