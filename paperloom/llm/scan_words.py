"""Reading errors in words: an averaged-perceptron editor decided once per distinct word.

At every place of a token where a confusable spelling may stand, and at every mark of a
broken line, an averaged perceptron chooses between keep and an edit (replace, delete or
insert within a confusion, join lines) by the sign of its score. Its features are the
edits, the neighbouring characters and how well the corpus knows the token before and
after them. Every decision depends on the token and the corpus' word counts only, so it is
taken once per distinct token in distributed tables:

1. lexicon: every word and compound with the number of blocks it stands in, counted with
   map-side combining; it is kept whole;
2. broken places: the distinct (left half, mark, gap, right half) of the corpus meet their
   counts by a join; the join perceptron decides each;
3. tokens meet the known words of their confusion key (equal for all spellings that
   confusions turn into each other, however many) by a join; the misread perceptron scores
   each pair, and tokens with digits between letters by themselves;
4. the tokens that are misread, with what they read, and the places that join are two small
   tables. Up to ``SHARED_ROWS`` rows they are shared with all workers; beyond, each block
   gets the rows of its own tokens by a join.

The perceptrons are trained here: words of the lexicon are spoilt and broken on purpose
(``TRAIN_WORDS`` words) beside untouched words, look-alike pairs that the corpus knows about
equally well, codes and compounds.

Defined cases: tokens of fewer than three signs and without letters are never misread; a
corpus without words has no misread ones; texts of any length are read whole.
"""

from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict, deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut_lineage, in_arrow

TRAIN_WORDS = 4_000
#: Rows of misread words and joined places that are shared whole with the workers.
SHARED_ROWS = 500_000
#: A word is known from so many blocks on.
KNOWN = 3
#: An example is learned until its score is so far on its own side.
MARGIN = 1.0

# What a scanner reads for what stands on the page.
CONFUSIONS = (
    ("c", "e"), ("1", "l"), ("1", "i"), ("0", "o"), ("5", "s"), ("9", "g"), ("ri", "n"), ("rn", "m"), ("ii", "u"),
    ("cl", "d"), ("vv", "w"), ("d", "cl"), ("b", "h"), ("6", "b"), ("8", "b"), ("iii", "m"), ("li", "h"), ("l", "1"), ("o", "0"),
)
MARKS = "-‐‑¬­"
BREAK = re.compile(rf"([^\W\d_]+)([{MARKS}])([ \t]*\r?\n[ \t]*|(?<=-) (?=\S))([^\W\d_]+)")
#: A broken line begins with a mark before its end; cheaper to look for than the whole pattern.
BROKEN = re.compile(rf"[{MARKS}][ \t]*\r?\n|[^\W\d_]- [^\W\d_]")
PART = re.compile(r"[^\W_]+")
_WORD = re.compile(r"\w+")
TOKEN = re.compile(r"[^\W_]+(?:[-‐][^\W_]+)*")
COMPOUND = re.compile(r"[^\W\d_]+[-‐][^\W\d_]+")
_INNER_DIGIT = re.compile(r"[^\W\d][0159]+[^\W\d]")


def has_break(text: str) -> bool:
    """The text may hold a broken line; the plain tests spare most texts the pattern."""
    return ("\n" in text or "- " in text) and bool(BROKEN.search(text))


def words_of(low: str) -> list[str]:
    """The runs of letters and digits of a text in small letters, as PART finds them."""
    return _WORD.findall(low.replace("_", " ") if "_" in low else low)


_FUNCTION = frozenset("and or und oder bis et ou y e o a".split())


class Perceptron:
    """A binary averaged perceptron over sparse features."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.w = dict(weights or {})

    def score(self, features: list[str]) -> float:
        get = self.w.get
        return sum(get(f, 0.0) for f in features)

    def fit(self, data: list[tuple[list[str], bool]], rounds: int = 6, seed: int = 7) -> Perceptron:
        w: dict[str, float] = defaultdict(float)
        total: dict[str, float] = defaultdict(float)
        stamp: dict[str, int] = defaultdict(int)
        order, rng, step = list(data), random.Random(seed), 0
        for _ in range(rounds):
            rng.shuffle(order)
            for features, gold in order:
                step += 1
                got = sum(w[f] for f in features)
                if got <= MARGIN if gold else got >= -MARGIN:
                    for f in features:
                        total[f] += (step - stamp[f]) * w[f]
                        stamp[f] = step
                        w[f] += 1.0 if gold else -1.0
        for f in w:
            total[f] += (step - stamp[f]) * w[f]
        self.w = {f: v / max(1, step) for f, v in total.items() if v}
        return self


_KEY = str.maketrans(
    {"e": "c", "1": "l", "i": "l", "0": "o", "5": "s", "9": "g", "d": "cl", "w": "vv", "n": "rl", "u": "ll", "m": "lll", "h": "ll", "b": "ll", "6": "ll", "8": "ll"}
)


def confusion_key(word: str) -> str:
    """Equal for all spellings that confusions turn into each other, however many."""
    key = word.translate(_KEY)
    while "rrl" in key:  # rn and iii are both read for m
        key = key.replace("rrl", "lll")
    return key


def edits(word: str, other: str) -> list[tuple[int, str, str]] | None:
    """The fewest confusions (place, wrong, right) that turn ``word`` into ``other``; None if none do."""
    came: dict[tuple[int, int], tuple | None] = {(0, 0): None}
    best = {(0, 0): 0}
    todo = deque([(0, (0, 0))])
    goal = (len(word), len(other))
    while todo:
        n, at = todo.popleft()
        if n > best[at]:
            continue
        if at == goal:
            out = []
            while came[at] is not None:
                before, step = came[at]
                if step:
                    out.append(step)
                at = before
            return out[::-1]
        i, j = at
        if i < len(word) and j < len(other) and word[i] == other[j]:
            to = (i + 1, j + 1)
            if n < best.get(to, 1 << 30):
                best[to], came[to] = n, (at, None)
                todo.appendleft((n, to))
        for wrong, right in CONFUSIONS:
            if word.startswith(wrong, i) and other.startswith(right, j):
                to = (i + len(wrong), j + len(right))
                if n + 1 < best.get(to, 1 << 30):
                    best[to], came[to] = n + 1, (at, (i, wrong, right))
                    todo.append((n + 1, to))
    return None


def _level(n: int) -> int:
    return 0 if n <= 0 else min(12, n.bit_length())


def _ratio(n: int, own: int) -> int:
    r = (n + 0.5) / (own + 0.5)
    return -1 if r < 1 else min(9, int(r).bit_length())


def misread_features(word: str, steps: list[tuple[int, str, str]], own: int, n: int) -> list[str]:
    """Features of reading a known word for a token; ``own`` and ``n``: blocks that hold the token and the word."""
    k, ratio = min(len(steps), 2), _ratio(n, own)
    out = ["pair", f"k={k}", f"ratio={k}/{ratio}", f"own={k}/{min(_level(own), 4)}", f"len={k}/{min(len(word), 6)}", f"known={min(_level(n), 5)}"]
    for at, wrong, right in steps:
        op = "replace" if len(wrong) == len(right) else "delete" if len(wrong) > len(right) else "insert"
        strange = wrong.isdigit() and (word[at - 1 : at].isalpha() or word[at + 1 : at + 2].isalpha())
        out += [f"op={op}", f"c={wrong}>{right}", f"digit={strange}", f"left={word[max(0, at - 1) : at]}{wrong}", f"right={wrong}{word[at + len(wrong) : at + len(wrong) + 1]}"]
    return out


def strange_features(word: str, own: int, most: int) -> list[str]:
    """Features of a token with digits between its letters of which no known word comes out."""
    letters, digits = sum(c.isalpha() for c in word), sum(c.isdigit() for c in word)
    rare = min(12, int((most + 0.5) / (own + 0.5)).bit_length())
    return ["strange", f"letters={min(letters, 8)}", f"digits={min(digits, 4)}", f"rare={rare}", f"few={min(own, 21) // 7}", f"mix={letters > 3 * digits}", f"edge={word[0].isdigit()}/{word[-1].isdigit()}"]


def join_features(left: str, mark: str, gap: str, right: str, counts: dict[str, int]) -> list[str]:
    """Features of joining the two halves of a broken line."""
    l, r = left.lower(), right.lower()
    whole, compound = counts.get(l + r, 0), counts.get(f"{l}-{r}", 0)
    both = counts.get(l, 0) > 0 and counts.get(r, 0) > 0
    return [
        "bias", f"m={mark}", f"line={'n' in repr(gap)}", f"whole={min(whole, 2)}", f"compound={min(compound, 2)}",
        f"wc={(whole > 0) - (compound > 0)}", f"both={both}/{whole > 0}", f"fn={r in _FUNCTION}", f"lower={right[:1].islower()}",
        f"plain={mark == '-'}/{whole > 0}/{compound > 0}/{both}",
    ]


def train_misread(words: list[tuple[str, int]], most: int, codes: list[tuple[str, int]]) -> Perceptron:
    """The misread perceptron from known words (word, blocks), spoilt on purpose."""
    rng = random.Random(11)
    spoil = [(right, wrong) for wrong, right in CONFUSIONS if not right.isdigit()]
    data = []

    def spoilt(word: str, times: int) -> tuple[str, list[tuple[int, str, str]]] | None:
        bad = word
        for _ in range(times):
            here = [(right, wrong) for right, wrong in spoil if right in bad]
            if not here:
                return None
            right, wrong = rng.choice(here)
            at = rng.choice([m.start() for m in re.finditer(re.escape(right), bad)])
            bad = bad[:at] + wrong + bad[at + len(right) :]
        steps = edits(bad, word)
        return (bad, steps) if steps and bad != word else None

    for word, n in words:
        for times in (1, 2):
            made = spoilt(word, times)
            if made is None:
                continue
            bad, steps = made
            # own counts are drawn evenly over all ratios of which the word is the better known
            least = 8 if len(steps) == 1 else 64
            own = int(n / (least * 1.06 * 2 ** rng.uniform(0, math.log2(max(2, n / least)) + 1)))
            if len(steps) == 1:
                data.append((misread_features(bad, steps, own, n), True))
            else:
                own = rng.choice((0, 1, 2, 3)) if own < 4 else own
                data.append((misread_features(bad, steps, own, n), n > 2 * KNOWN))
                data.append((misread_features(bad, steps, max(4, n // rng.choice((2, 8, 24))), n), False))
            # two words that the corpus knows about equally well, either may be the more frequent
            data.append((misread_features(bad, steps, max(1, n // rng.choice((1, 2, 3, 4))), n), False))
            data.append((misread_features(bad, steps, n * rng.choice((2, 20, 200)), n), False))
            if re.search(r"[0159]", bad) and _INNER_DIGIT.search(bad):
                data.append((strange_features(bad, rng.choice((0, 1, 1, 2, 4)), most), True))
    letters = "abcdefghijklmnopqrstuvwxyz"
    for k in range(min(len(words), 400)):  # codes
        a, b = rng.choice((1, 1, 2)), rng.choice((1, 1, 2))
        code = "".join(rng.choices(letters, k=a)) + "".join(rng.choices("0159", k=rng.choice((1, 2, 3)))) + "".join(rng.choices(letters, k=b))
        data.append((strange_features(code, rng.choice((0, 1, 2, 30, 300)), most), False))
    for word, n in codes:
        data.append((strange_features(word, max(n, most // 200, 21), most), False))
    return Perceptron().fit(data)


def join_cases(words: list[str], compounds: list[str]) -> list[tuple[str, str, str, str, bool]]:
    """(left, mark, gap, right, joins) of words and compounds broken on purpose."""
    rng, out = random.Random(13), []
    for w in words:
        if len(w) >= 6:
            k = rng.randrange(2, len(w) - 2)
            out.append((w[:k], rng.choice(MARKS), rng.choice(("\n", "\r\n", " ")), w[k:], True))
    for c in compounds:
        a, b = re.split(r"[-‐]", c)
        out.append((a, "-", rng.choice(("\n", " ")), b, False))
        out.append((a, "-", " ", rng.choice(("and", "und", "et", "y", "e")), False))
    return out


def _asked(left: str, right: str) -> dict[str, str]:
    l, r = left.lower(), right.lower()
    return {"l": l, "r": r, "whole": l + r, "compound": f"{l}-{r}"}


def train_joins(cases: list[tuple[str, str, str, str, bool]], counts: dict[str, int]) -> Perceptron:
    data = [(join_features(a, mark, gap, b, counts), gold) for a, mark, gap, b, gold in cases]
    if not any(not gold for *_, gold in cases):
        data += [(join_features("low", "-", "\n", "level", {"low": 9, "level": 9, "low-level": 9}), False)] * 20
    return Perceptron().fit(data)


def lexicon(blocks: DataFrame) -> DataFrame:
    """(word, n): words and compounds of all blocks with the number of blocks they occur in.

    Each Arrow batch is counted in the worker, so that one row per different word of a
    batch is shuffled.
    """
    broken = re.compile(rf"[^\W\d_]+[{MARKS}]\s+[^\W\d_]+")

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in it:
            for text in b.column(0).to_pylist():
                low = text.lower()
                words = set(words_of(broken.sub(" ", low) if has_break(low) else low))
                if "-" in low or "‐" in low:
                    words.update(w.replace("‐", "-") for w in TOKEN.findall(broken.sub(" ", low)) if "-" in w or "‐" in w)
                counts.update(words)
            if len(counts) > 200_000:
                yield flush(counts)
                counts.clear()
        yield flush(counts)

    def flush(counts: Counter) -> pa.RecordBatch:
        kept = [(w, n) for w, n in counts.items() if len(w) >= 2 and not w.isdigit()]
        return pa.RecordBatch.from_arrays([pa.array([w for w, _ in kept], pa.string()), pa.array([n for _, n in kept], pa.int64())], names=["word", "n"])

    text = blocks.where(~F.coalesce(F.col("type"), F.lit("")).isin("equation", "page_number") & (F.length("text") > 0)).select("text")
    return text.transform(in_arrow, batches, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


_PLACE = pa.schema([("l", pa.string()), ("mark", pa.string()), ("gap", pa.string()), ("r", pa.string())])
_PLACE_DDL = "l string, mark string, gap string, r string"


def place_of(m: re.Match) -> tuple[str, str, str, str]:
    """What the join of a broken place depends on."""
    left, mark, gap, right = m.groups()
    return left.lower(), mark, "\n" if "\n" in gap else " ", right if right[:1].islower() else ""


def broken_places(blocks: DataFrame) -> DataFrame:
    """The distinct broken places of the corpus whose right half may go on a word."""

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            seen = {place_of(m) for text in b.column(0).to_pylist() if has_break(text) for m in BREAK.finditer(text)}
            yield _batch([(l, mark, gap, r.lower()) for l, mark, gap, r in sorted(seen) if r], _PLACE)

    marked = blocks.where(F.col("text").rlike(rf"[{MARKS}]\s"))
    return marked.select("text").transform(in_arrow, batches, _PLACE_DDL).distinct()


def joined_places(places: DataFrame, lex: DataFrame, joins: Perceptron) -> DataFrame:
    """The broken places whose halves are one word."""
    l, r = F.col("l"), F.col("r")
    roles = F.array(*[F.struct(F.lit(role).alias("role"), w.alias("word")) for role, w in (("l", l), ("r", r), ("whole", F.concat(l, r)), ("compound", F.concat_ws("-", l, r)))])
    asked = places.select(*_PLACE.names, F.explode(roles).alias("q")).select(*_PLACE.names, "q.role", "q.word")
    known = asked.join(lex, "word", "left")
    got = known.groupBy(*_PLACE.names).agg(*[F.coalesce(F.max(F.when(F.col("role") == role, F.col("n"))), F.lit(0)).alias(f"n_{role}") for role in ("l", "r", "whole", "compound")])
    weights = joins.w

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Perceptron(weights)
        for b in it:
            out = []
            for l, mark, gap, r, nl, nr, whole, compound in zip(*(c.to_pylist() for c in b.columns)):
                counts = {l: nl, r: nr, f"{l}-{r}": compound, l + r: whole}
                if p.score(join_features(l, mark, gap, r, counts)) > 0:
                    out.append((l, mark, gap, r))
            yield _batch(out, _PLACE)

    return got.transform(in_arrow, batches, _PLACE_DDL)


_FIX = pa.schema([("word", pa.string()), ("fix", pa.string()), ("rank", pa.int64()), ("n", pa.int64())])


def misread_words(tokens: DataFrame, lex: DataFrame, misread: Perceptron, most: int) -> DataFrame:
    """(word, fix): the tokens (word, n) that are misread, with the known word they stand for, '' where none is known."""
    weights = misread.w

    def keys(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            words = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([confusion_key(w) for w in words], pa.string()), *b.columns], names=["key", "word", "n"])

    long = (F.length("word") >= 3) & F.col("word").rlike(r"\p{L}") & ~F.col("word").contains("-")
    own = tokens.where(long).select("word", "n").transform(in_arrow, keys, "key string, word string, n bigint")
    known = lex.where(long & (F.col("n") >= KNOWN)).select("word", "n").transform(in_arrow, keys, "key string, word string, n bigint")
    pairs = own.join(known.select("key", F.col("word").alias("other"), F.col("n").alias("m")), "key").where(F.col("word") != F.col("other"))

    def judge(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Perceptron(weights)
        for b in it:
            out = []
            for word, n, other, m in zip(*(c.to_pylist() for c in b.columns)):
                steps = edits(word, other)
                if steps and p.score(misread_features(word, steps, n, m)) > 0:
                    out.append((word, other, -len(steps), m))
            yield _batch(out, _FIX)

    def alone(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Perceptron(weights)
        for b in it:
            rows = zip(*(c.to_pylist() for c in b.columns))
            yield _batch([(w, "", -99, 0) for w, n in rows if p.score(strange_features(w, n, most)) > 0], _FIX)

    ddl = "word string, fix string, rank bigint, n bigint"
    fixed = pairs.select("word", "n", "other", "m").transform(in_arrow, judge, ddl)
    strange = tokens.where((F.length("word") >= 4) & F.col("word").rlike(r"\p{L}[0159]+\p{L}") & ~F.col("word").contains("-")).select("word", "n").transform(in_arrow, alone, ddl)
    best = fixed.unionByName(strange).groupBy("word").agg(F.max(F.struct("rank", "n", "fix")).alias("b"))
    return best.select("word", F.col("b.fix").alias("fix"))


def _train(lex: DataFrame) -> tuple[Perceptron, Perceptron, int]:
    """(misread perceptron, join perceptron, blocks of the most frequent word) from a bounded sample of the lexicon."""
    usable = lex.where((F.length("word") >= 4) & F.col("word").rlike(r"^\p{L}+$") & (F.col("n") >= KNOWN))
    some = usable.orderBy(F.desc("n"), "word").limit(TRAIN_WORDS // 2).collect() + usable.orderBy(F.xxhash64("word"), "word").limit(TRAIN_WORDS // 2).collect()
    words = sorted({(r["word"], r["n"]) for r in some}, key=lambda x: (-x[1], x[0]))
    compounds = [r["word"] for r in lex.where(F.col("word").rlike(r"^\p{L}+-\p{L}+$")).orderBy(F.xxhash64("word"), "word").limit(TRAIN_WORDS).collect()]
    compounds = sorted(c for c in compounds if COMPOUND.fullmatch(c))
    most = lex.agg(F.max("n")).first()[0] or 0
    coded = lex.where(F.col("word").rlike(r"\p{L}[0159]+\p{L}") & (F.col("n") > F.lit(max(20, most // 1000))))
    codes = [(r["word"], r["n"]) for r in coded.orderBy(F.desc("n"), "word").limit(TRAIN_WORDS).collect()]
    cases = join_cases([w for w, _ in words], compounds)
    asked = sorted({w for a, _, _, b, _ in cases for w in _asked(a, b).values()})
    counts: dict[str, int] = {}
    if asked:
        bounded = lex.sparkSession.createDataFrame([(w,) for w in asked], "word string")
        counts = {r["word"]: r["n"] for r in lex.join(bounded, "word").collect()}
    return train_misread(words, most, codes), train_joins(cases, counts), most


class Reader:
    """Reads texts with the decisions on their words: misread words with what they stand for, and joined places."""

    def __init__(self, fixes: dict[str, str], joins: set[tuple[str, str, str, str]]):
        self.fixes, self.joins = fixes, joins

    def _joined(self, m: re.Match) -> bool:
        l, mark, gap, r = place_of(m)
        return bool(r) and (l, mark, gap, r.lower()) in self.joins

    def splits(self, text: str) -> bool:
        """Some line end split a word and left its mark."""
        return has_break(text) and any(self._joined(m) for m in BREAK.finditer(text))

    def unbreak(self, text: str) -> str:
        if not has_break(text):
            return text
        return BREAK.sub(lambda m: m.group(1) + m.group(4) if self._joined(m) else m.group(0), text)

    def misreads(self, text: str) -> int:
        """Number of misread words of a text."""
        return self.misread_among(words_of(self.unbreak(text).lower()))

    def misread_among(self, words: list[str]) -> int:
        fixes = self.fixes
        return sum([w in fixes for w in words])

    def repair(self, text: str) -> str:
        """Continuous text: words joined over line ends, misread words corrected, lines unwrapped."""

        def fix(m: re.Match) -> str:
            word = m.group(0)
            good = self.fixes.get(word.lower())
            if not good:
                return word
            return good.upper() if word.isupper() else good.capitalize() if word[:1].isupper() else good

        out = PART.sub(fix, self.unbreak(text))
        return re.sub(r"(?<![.!?:\n])[ \t]*\r?\n(?=[^\W\d_A-Z])", " ", out).strip()


def decisions(blocks: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(misread words, joined places) of the corpus, both checkpointed."""
    lex = cut_lineage(lexicon(blocks))
    misread, joins, most = _train(lex)
    joined = cut_lineage(joined_places(broken_places(blocks), lex, joins))
    whole = joined.select(F.concat("l", "r").alias("word")).distinct().join(lex, "word", "left_anti")
    tokens = lex.unionByName(whole.select("word", F.lit(0).cast("bigint").alias("n")))
    return cut_lineage(misread_words(tokens, lex, misread, most)), joined


def with_decisions(blocks: DataFrame, rows: DataFrame) -> tuple[DataFrame, object]:
    """(rows, shared decisions), or (rows with the columns ``fixes`` and ``joins``, None).

    Small tables of decisions are shared; beyond SHARED_ROWS each block gets those of its
    own words by joins on the word and on the block.
    """
    fixes, joined = decisions(blocks)
    if fixes.count() + joined.count() <= SHARED_ROWS:
        table = fixes.toArrow()
        known = dict(zip(table.column("word").to_pylist(), table.column("fix").to_pylist()))
        places = {tuple(r) for r in joined.collect()}
        return rows, blocks.sparkSession.sparkContext.broadcast((known, places))

    def words(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                low = BREAK.sub(lambda m: f"{m.group(0)} {m.group(1)}{m.group(4)}", text).lower()
                out += [(i, w) for w in sorted(set(PART.findall(low)))]
            yield _batch(out, pa.schema([("block_id", pa.int64()), ("word", pa.string())]))

    def places(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                found = {place_of(m) for m in BREAK.finditer(text)} if has_break(text) else ()
                out += [(i, l, mark, gap, r.lower()) for l, mark, gap, r in sorted(found) if r]
            yield _batch(out, pa.schema([("block_id", pa.int64()), *_PLACE]))

    texts = rows.select("block_id", "text")
    own = texts.transform(in_arrow, words, "block_id bigint, word string").join(fixes, "word").distinct()
    own = own.groupBy("block_id").agg(F.map_from_entries(F.collect_list(F.struct("word", "fix"))).alias("fixes"))
    at = texts.transform(in_arrow, places, f"block_id bigint, {_PLACE_DDL}").join(joined, _PLACE.names, "left_semi").distinct()
    at = at.groupBy("block_id").agg(F.collect_list(F.struct(*_PLACE.names)).alias("joins"))
    return rows.join(own, "block_id", "left").join(at, "block_id", "left"), None


def reader_of(shared: tuple | None, fixes, joins) -> Reader:
    """The reader of a row: the shared decisions, or the row's own."""
    if shared is not None:
        return Reader(*shared)
    return Reader(dict(fixes or ()), {(p["l"], p["mark"], p["gap"], p["r"]) for p in joins or ()})
