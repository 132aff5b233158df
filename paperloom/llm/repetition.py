"""Repetition inside a single text: a linear-chain CRF over its lines.

A text's words are cut into lines (at line ends, sentence ends, semicolons and after
``LINE_WORDS`` words). Each line gets features of its own wording: how many of its words
and word pairs stood before, the longest stretch of old pairs, whether the whole line stood
before, its length, digits and vocabulary. Viterbi decoding of a two-label linear-chain CRF
marks the line as content or boilerplate. A text is retained if its content share is at
least ``RETAIN``; of the others the exact share of repeated words is measured, and those of
at least ``MIN_SHARE`` are found. The features never see the exact measure.

The CRF is fitted on a bounded, deterministic sample (``SAMPLE_ROWS`` texts of the least
hashes, as many again of low vocabulary), each line labelled by the exact measure; every
text is then judged. Judging is a narrow map.

Words: a run of letters (case ignored), a Chinese character, a number (all alike).
Repeated: words in a second or later occurrence of some run of ``RUN`` words.

Defined cases: null, empty and wordless texts have share 0 and content share 1; texts
shorter than a run repeat nothing; texts are measured whole in linear time; each row is
judged for itself, equal rows alike; without any text the CRF keeps its start weights.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import in_arrow

RUN = 4
MIN_WORDS = 20
MIN_SHARE = 0.4
LINE_WORDS = 12
#: A text of at least this content share is retained; a found text has 0.6 at most by the exact measure.
RETAIN = 0.75
SAMPLE_ROWS = 750
#: Longest text that may be in the sample.
SAMPLE_CHARS = 20_000
#: A line of the sample counts as boilerplate from this repeated share on.
LINE_REPEATED = 0.5
CONTENT, BOILERPLATE = 0, 1

_WORD = re.compile(r"[㐀-䶿一-鿿豈-﫿]|[\U00020000-\U0003ffff]|[^\W\d_㐀-䶿一-鿿豈-﫿]+|\d+(?:[.,]\d+)*")
_BREAK = re.compile(r"[\n\r;。；!?！？]|\.(?=\s|$)")


def words_and_lines(text: str | None) -> tuple[list[str], list[int]]:
    """The words and the index of the first word of each line."""
    words, starts, at = [], [0], 0
    text = text or ""
    for m in _WORD.finditer(text):
        if words and (len(words) - starts[-1] >= LINE_WORDS or _BREAK.search(text, at, m.start())):
            starts.append(len(words))
        w = m.group(0)
        words.append("0" if w[0].isdigit() else w.lower())
        at = m.end()
    return words, starts if words else []


def repeated(words: list[str], run: int = RUN) -> np.ndarray:
    """Mask of the words in a second or later occurrence of a run."""
    hit = np.zeros(len(words) + 1, np.int64)
    seen: set[tuple[str, ...]] = set()
    for i in range(len(words) - run + 1):
        g = tuple(words[i : i + run])
        if g in seen:
            hit[i] += 1
            if i + run < len(hit):
                hit[i + run] -= 1
        seen.add(g)
    return np.cumsum(hit)[: len(words)] > 0


def repeated_share(text: str | None) -> tuple[int, float]:
    """(number of words, share of repeated words)."""
    words, _ = words_and_lines(text)
    return len(words), float(repeated(words).mean()) if words else 0.0


N_FEATURES = 13


def features(words: list[str], starts: list[int]) -> np.ndarray:
    """One row of features per line, from the wording alone."""
    bounds = [*starts, len(words)]
    seen: set[str] = set()
    pairs: set[tuple[str, str]] = set()
    lines: set[tuple] = set()
    out = np.zeros((len(starts), N_FEATURES))
    before = None
    for k, (a, b) in enumerate(zip(bounds, bounds[1:])):
        line = words[a:b]
        n = len(line)
        old = old_pairs = stretch = longest = 0
        for w in line:
            old += w in seen
            seen.add(w)
            if before is not None:
                pair = (before, w)
                if pair in pairs:
                    old_pairs += 1
                    stretch += 1
                    longest = max(longest, stretch)
                else:
                    pairs.add(pair)
                    stretch = 0
            before = w
        key = tuple(line)
        again = key in lines
        lines.add(key)
        o = old_pairs / n
        out[k] = (
            1.0, old / n, old == n, o, o >= 0.35, o >= 0.65, o >= 0.9, longest / n, longest >= RUN, again, n / LINE_WORDS,
            sum(w == "0" for w in line) / n, k > 0,
        )
    return out


class Crf:
    """A two-label linear-chain CRF; ``w`` weighs features, ``t`` transitions."""

    def __init__(self, w: np.ndarray | None = None, t: np.ndarray | None = None):
        start = np.zeros((N_FEATURES, 2))
        start[5, BOILERPLATE], start[0, CONTENT] = 4.0, 2.0
        self.w = start if w is None else w
        self.t = np.array([[0.3, 0.0], [0.0, 0.3]]) if t is None else t

    def _lattice(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        e = x @ self.w
        n = len(e)
        f, b = np.zeros((n, 2)), np.zeros((n, 2))
        f[0] = e[0]
        for i in range(1, n):
            f[i] = e[i] + np.logaddexp(f[i - 1][0] + self.t[0], f[i - 1][1] + self.t[1])
        for i in range(n - 2, -1, -1):
            s = self.t + (e[i + 1] + b[i + 1])[None, :]
            b[i] = np.logaddexp(s[:, 0], s[:, 1])
        return e, f, b

    def fit(self, data: list[tuple[np.ndarray, np.ndarray]], rounds: int = 25, rate: float = 0.5, decay: float = 1e-3) -> Crf:
        """Gradient ascent of the conditional log-likelihood."""
        lines = max(1, sum(len(y) for _, y in data))
        for _ in range(rounds):
            gw, gt = -decay * self.w * lines, -decay * self.t * lines
            for x, y in data:
                e, f, b = self._lattice(x)
                z = np.logaddexp(*f[-1])
                p = np.exp(f + b - z)
                gold = np.eye(2)[y]
                gw += x.T @ (gold - p)
                for i in range(1, len(y)):
                    q = np.exp(f[i - 1][:, None] + self.t + (e[i] + b[i])[None, :] - z)
                    q[:] = -q
                    q[y[i - 1], y[i]] += 1
                    gt += q
            self.w = self.w + rate * gw / lines * 10
            self.t = self.t + rate * gt / lines * 10
        return self

    def viterbi(self, x: np.ndarray) -> np.ndarray:
        e = x @ self.w
        best, back = e[0].copy(), np.zeros((len(e), 2), np.int8)
        for i in range(1, len(e)):
            s = best[:, None] + self.t
            back[i] = s.argmax(0)
            best = s.max(0) + e[i]
        y = np.zeros(len(e), np.int8)
        y[-1] = best.argmax()
        for i in range(len(e) - 1, 0, -1):
            y[i - 1] = back[i][y[i]]
        return y


def fit_on(texts: list[str]) -> Crf:
    """A CRF from the exact labels of ``texts``."""
    data = []
    for text in texts:
        words, starts = words_and_lines(text)
        if len(starts) < 2:
            continue
        mask = repeated(words)
        bounds = [*starts, len(words)]
        y = np.array([int(mask[a:b].mean() >= LINE_REPEATED) for a, b in zip(bounds, bounds[1:])])
        if y.any() or len(data) % 3 == 0:
            data.append((features(words, starts), y))
    return Crf().fit(data) if data else Crf()


def content_share(words: list[str], starts: list[int], crf: Crf) -> float:
    """Share of the words in lines that Viterbi decoding marks as content."""
    if not words:
        return 1.0
    labels = crf.viterbi(features(words, starts))
    sizes = np.diff([*starts, len(words)])
    return float(sizes[labels == CONTENT].sum() / len(words))


def judge(text: str | None, crf: Crf) -> tuple[int, float, float]:
    """(words, content share by Viterbi, exact repeated share)."""
    words, starts = words_and_lines(text)
    return len(words), content_share(words, starts, crf), float(repeated(words).mean()) if words else 0.0


def is_degenerate(text: str | None, crf: Crf) -> bool:
    """The CRF does not retain the text, and the exact measure confirms it."""
    words, starts = words_and_lines(text)
    n = len(words)
    # every repeated word stood before, so a text of more different words cannot reach the share
    if n < MIN_WORDS or n - len(set(words)) < MIN_SHARE * n:
        return False
    return content_share(words, starts, crf) < RETAIN and float(repeated(words).mean()) >= MIN_SHARE


_OUT = pa.schema([("id", pa.int64()), ("words", pa.int32()), ("content_share", pa.float64()), ("repeated_share", pa.float64())])


def fit(texts: DataFrame) -> Crf:
    """The CRF of a corpus, from its bounded sample of column ``text``."""
    usable = texts.where(F.length("text").between(2 * MIN_WORDS, SAMPLE_CHARS)).select("text")
    split = F.split(F.lower("text"), r"\W+")
    poor = usable.where(F.size(F.array_distinct(split)) < (1 - MIN_SHARE / 2) * F.size(split))
    rows = [r["text"] for part in (usable, poor) for r in part.orderBy(F.xxhash64("text"), "text").limit(SAMPLE_ROWS).collect()]
    return fit_on(sorted(set(rows)))


def shares(df: DataFrame, id_col: str = "block_id", text_col: str = "text") -> DataFrame:
    """(id, words, content_share, repeated_share) of every row."""
    narrow = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text"))
    fitted = fit(narrow)
    w, t = fitted.w, fitted.t

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Crf(w, t)
        for b in it:
            rows = [(i, *judge(x, crf)) for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows) if rows else [[]] * len(_OUT), _OUT)], schema=_OUT
            )

    return narrow.transform(in_arrow, batches, "id bigint, words int, content_share double, repeated_share double")


def degenerate(df: DataFrame, id_col: str = "block_id", text_col: str = "text") -> DataFrame:
    """Ids of the texts that are not retained and repeat at least MIN_SHARE of MIN_WORDS words or more."""
    narrow = df.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).alias("text")).where(F.col("id").isNotNull())
    fitted = fit(narrow)
    w, t = fitted.w, fitted.t
    schema = pa.schema([("id", pa.int64())])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        crf = Crf(w, t)
        for b in it:
            ids = [i for i, x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()) if is_degenerate(x, crf)]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], schema=schema)

    return narrow.where(F.length("text") >= MIN_WORDS).transform(in_arrow, batches, "id bigint").distinct()
