"""Evaluation passages inside corpus documents.

Words come out of the JVM: texts are brought to one form (look-alike letters,
accents, markup, citation numbers and words broken at line ends), split, and each
word is hashed to 64 bits; Python sees number arrays only.

Search. A window of ``WINDOW`` words is embedded by a CGK random walk: step j emits
the word under a pointer and moves it by a random bit of (j, word), so that texts of
small edit distance get embeddings of small Hamming distance. Each of ``REPEATS``
repetitions uses its own walk and samples ``SAMPLE`` of the ``3 * WINDOW`` positions
as an LSH key. Item windows form sorted key tables; document windows look their keys
up, all in vectorised numpy. ``MIN_HITS`` colliding document positions make a
candidate, which an exact check decides: the item's words, in order, in pieces of at
least eight words with single altered words allowed, must reach 40 of every 100. The check
is a dynamic programme over the equal words of both (``covered``), which finds the most
that any choice of pieces covers; a greedy alignment that already reaches the share is a
witness and spares it.

The item tables are shipped to the workers in blocks of at most ``BLOCK_WORDS`` item
words, whatever the number of items; the corpus itself is neither shuffled nor
broadcast, only one row per document and found item leaves a worker.

Defined cases: null and empty texts and items shorter than eight words give no row;
equal items and documents are each reported under their own ids; a null doc_id or
item_id is ignored; a document is searched whole, whatever its length.
"""

from __future__ import annotations

from collections.abc import Iterator
from difflib import SequenceMatcher

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.llm.lookalike import coarse
from paperloom.session import in_arrow

WINDOW = 8
REPEATS = 3
SAMPLE = 9
MIN_HITS = 2
MIN_PIECE = 8
#: Equal words in a row after which a piece may go on over an altered, added or dropped word.
MIN_RUN = 2
SHARE = 0.4
#: Item words in one block of tables (8 bytes a word and repetition, about 100 MB).
BLOCK_WORDS = 2_000_000
#: Document words that a worker embeds at once (its arrays then stay in the cache).
CHUNK_WORDS = 24_000
_SEED = 20_240_101


def word_hashes(col: Column) -> Column:
    """The words of a text as 64-bit hashes, in order; a text without words gives one filler."""
    x = F.lower(coarse(F.coalesce(col, F.lit(""))))
    x = F.regexp_replace(x, r"</?[a-z][^<>]*>|&#?[a-z0-9]+;|\\[a-z]+\*?|\[\d+(?:[,;–-] ?\d+)*\]|!\[", " ")
    x = F.regexp_replace(x, r"(?<=\p{L})[-¬]\s+(?=\p{L})", "")
    x = F.regexp_replace(x, r"([㐀-鿿])", " $1 ")
    x = F.trim(F.regexp_replace(x, r"[^\p{L}\p{N}]+", " "))
    return F.transform(F.split(x, " "), lambda w: F.xxhash64(w))


class Walk:
    """One CGK walk with its sampled positions.

    Only the steps up to the last sampled one are walked. What a step needs of a word
    (its turn, its mixed value) is computed once per word, in order, and gathered for
    the windows.
    """

    def __init__(self, seed: int, window: int = WINDOW, sample: int = SAMPLE):
        rng = np.random.default_rng(seed)
        steps = 3 * window
        self.turn = rng.integers(1, 2**63, steps, dtype=np.uint64) | np.uint64(1)
        self.mix = rng.integers(1, 2**63, steps, dtype=np.uint64) | np.uint64(1)
        self.taken = np.zeros(steps, bool)
        self.taken[rng.choice(steps, sample, replace=False)] = True
        self.steps = int(np.flatnonzero(self.taken).max()) + 1

    def keys(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """LSH keys of the walks from ``starts``; ``words`` ends with PAD."""
        at = starts.copy()
        key = np.zeros(len(starts), np.uint64)
        for j in range(self.steps):
            if self.taken[j]:
                mixed = words * self.mix[j]
                mixed ^= mixed >> np.uint64(32)
                key *= np.uint64(0x9E3779B97F4A7C15)
                key += mixed[at]
            at += ((words * self.turn[j]) >> np.uint64(63)).astype(np.int32)[at]
        return key ^ (key >> np.uint64(29))


#: Fillers behind the last word, so that no walk leaves the array.
PAD = np.zeros(3 * WINDOW + 1, np.uint64)


def walks() -> list[Walk]:
    return [Walk(_SEED + r) for r in range(REPEATS)]


def window_starts(offsets: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, np.ndarray]:
    """Starts of all whole windows and the number of the text of each."""
    lengths = np.diff(offsets)
    n = np.maximum(lengths - window + 1, 0)
    owner = np.repeat(np.arange(len(n)), n)
    first = np.repeat(np.cumsum(n) - n, n)
    return (offsets[:-1][owner] + (np.arange(n.sum()) - first)).astype(np.int32), owner


class ItemTables:
    """Key tables of one block of items."""

    def __init__(self, items: list[tuple[int, list[int]]]):
        self.ids = [i for i, _ in items]
        self.words = [np.asarray(w, dtype=np.int64).view(np.uint64) for _, w in items]
        flat = np.concatenate([*self.words, PAD])
        offsets = np.concatenate([[0], np.cumsum([len(w) for w in self.words])]).astype(np.int64)
        starts, owner = window_starts(offsets)
        self.walks, self.tables = walks(), []
        for w in self.walks:
            keys = w.keys(flat, starts) if len(starts) else np.zeros(0, np.uint64)
            both = np.unique(np.rec.fromarrays([keys, owner], names="key,item"))
            self.tables.append((np.ascontiguousarray(both["key"]), np.ascontiguousarray(both["item"])))

    def candidates(self, words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
        """(text, item) pairs with at least MIN_HITS colliding positions."""
        starts, owner = window_starts(offsets)
        if not len(starts):
            return []
        hits, words = [], np.concatenate([words, PAD])
        for walk, (keys, item) in zip(self.walks, self.tables):
            if not len(keys):
                continue
            mine = walk.keys(words, starts)
            lo = np.searchsorted(keys, mine, "left")
            found = np.flatnonzero((lo < len(keys)) & (keys[np.minimum(lo, len(keys) - 1)] == mine))
            lo = lo[found]
            n = np.searchsorted(keys, mine[found], "right") - lo
            each = np.repeat(np.arange(len(found)), n)
            at = lo[each] + (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            hits.append(np.stack([owner[found][each], item[at], starts[found][each]]))
        if not hits:
            return []
        places = np.unique(np.concatenate(hits, axis=1), axis=1)
        pairs, count = np.unique(places[:2], axis=1, return_counts=True)
        return [(int(a), int(b)) for a, b in pairs[:, count >= MIN_HITS].T]


def witness(text: list[int], item: list[int]) -> int:
    """Words of the item that one greedy alignment covers in pieces; at most ``covered``."""
    total = begin = end_item = end_text = run = 0
    for a, b, n in SequenceMatcher(None, text, item, autojunk=False).get_matching_blocks():
        if n and end_item > begin and a - end_text <= 1 and b - end_item <= 1 and run >= MIN_RUN:
            end_text, end_item, run = a + n, b + n, n
            continue
        if end_item - begin >= MIN_PIECE:
            total += end_item - begin
        begin, end_item, end_text, run = b, b + n, a + n, n
    return total


def _steps(m: tuple[int, int]) -> list[tuple[int, int]]:
    """The equal words from which a piece may go on to ``m``: next to it, or over one word of either or both."""
    t, j = m
    return [(t - 1, j - 1), (t - 2, j - 2), (t - 2, j - 1), (t - 1, j - 2)]


def pieces(text: list[int], item: list[int]) -> list[tuple[int, int]]:
    """(text place, item place) of the equal words that lie in some piece of MIN_PIECE item words."""
    at: dict[int, list[int]] = {}
    for j, w in enumerate(item):
        at.setdefault(w, []).append(j)
    equal = [(t, j) for t, w in enumerate(text) for j in at.get(w, ())]
    first: dict[tuple[int, int], int] = {}  # the earliest item place from which a piece leads here
    for m in equal:
        first[m] = min([m[1], *(first[p] for p in _steps(m) if p in first)])
    last: dict[tuple[int, int], int] = {m: m[1] for m in equal}
    for m in reversed(equal):
        for p in _steps(m):
            if p in last:
                last[p] = max(last[p], last[m])
    return [m for m in equal if last[m] - first[m] + 1 >= MIN_PIECE]


def covered(text: list[int], item: list[int]) -> int:
    """Most words of the item in pieces of at least MIN_PIECE words that the text holds in order.

    A piece may hold single altered, added or dropped words, each after MIN_RUN equal ones.
    State of the programme: an equal word as the end of a piece of 1 to MIN_PIECE or more
    item words and of a run of 1 to MIN_RUN or more equal ones, with the most words covered
    up to it; ended pieces are kept as the best total up to each item place.
    """
    ended = [0] * (len(item) + 1)  # ended[j]: best total of pieces that end before item place j, in the text so far
    open_: dict[tuple[int, int], list[int]] = {}
    waiting: list[tuple[int, int, int]] = []  # (text place, item place, total) of pieces that may have ended

    def end(place: int, total: int) -> None:
        for k in range(place + 1, len(ended)):
            if ended[k] >= total:
                break
            ended[k] = total

    for m in pieces(text, item):
        t, j = m
        while waiting and waiting[0][0] < t:
            end(*waiting.pop(0)[1:])
        best = {(1, 1): ended[j] + 1}
        for p in _steps(m):
            step, whole = j - p[1], p == (t - 1, j - 1)
            for (size, run), total in open_.get(p, {}).items():
                if whole or run >= MIN_RUN:
                    to = min(MIN_PIECE, size + step), min(MIN_RUN, run + 1) if whole else 1
                    best[to] = max(best.get(to, 0), total + step)
        open_[m] = best
        done = max((total for (size, _), total in best.items() if size == MIN_PIECE), default=0)
        if done:
            waiting.append((t, j, done))
    for _, j, total in waiting:
        end(j, total)
    return ended[-1]


def coverable(text: np.ndarray, item: np.ndarray) -> int:
    """Item words in runs of at least MIN_PIECE whose words the text has in any order, single ones missing; no less than ``covered``."""
    at = np.flatnonzero(np.isin(item, text))
    if not len(at):
        return 0
    cuts = np.flatnonzero(np.diff(at) > 2)
    spans = at[np.append(cuts, len(at) - 1)] - at[np.append(0, cuts + 1)] + 1
    return int(spans[spans >= MIN_PIECE].sum())


def holds(text: np.ndarray, item: np.ndarray) -> bool:
    """The text holds at least SHARE of the item's words in pieces."""
    need = SHARE * len(item)
    if coverable(text, item) < need:
        return False
    t, i = text.tolist(), item.tolist()
    return witness(t, i) >= need or covered(t, i) >= need


def _search(tables: ItemTables, ids: np.ndarray, words: np.ndarray, offsets: np.ndarray) -> list[tuple[int, int]]:
    out = []
    for t, k in tables.candidates(words, offsets):
        if holds(words[offsets[t] : offsets[t + 1]], tables.words[k]):
            out.append((int(ids[t]), tables.ids[k]))
    return out


_OUT = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64())])


def _block(docs: DataFrame, items: list[tuple[int, list[int]]]) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(items)
    built: list[ItemTables] = []

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not built:
            built.append(ItemTables(shared.value))
        tables = built[0]
        for batch in it:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            col = batch.column(1)
            flat = col.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
            offsets = col.offsets.to_numpy().astype(np.int64)
            offsets = offsets - offsets[0]
            found, a = [], 0
            while a < len(ids):  # chunks of whole texts
                b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_WORDS, "right")) - 1)
                part = flat[offsets[a] : offsets[b]]
                if len(part):
                    found += _search(tables, ids[a:b], part, offsets[a : b + 1] - offsets[a])
                a = b
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in found], pa.int64()) for k in (0, 1)], schema=_OUT)

    return docs.transform(in_arrow, batches, "doc_id bigint, item_id bigint")


def leaked(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id) of the documents that hold enough of an item's text."""
    words = docs.where(F.col("doc_id").isNotNull() & (F.length("text") > 0)).select(
        F.col("doc_id").cast("bigint"), word_hashes(F.col("text")).alias("words")
    )
    hashed = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("bigint"), word_hashes(F.col("text")).alias("words")
    )
    hashed = hashed.where(F.size("words") >= MIN_PIECE)
    size = hashed.agg(F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-size // BLOCK_WORDS))
    found = None
    for k in range(blocks):
        own = hashed.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == k)
        part = _block(words, [(r["item_id"], list(r["words"])) for r in own.collect()])
        found = part if found is None else found.unionByName(part)
    return found.distinct()
