"""Languages of documents and of their segments: mixture inference by EM.

Each language has an interpolated character n-gram model, fitted on the labelled sample
texts (at most ``FIT_ROWS`` rows a language). A document's segments (its title, its
sentences) have a tempered log-likelihood under every language (n-grams of one word depend
on each other, ``TEMPER`` scales them to about independent evidence). Expectation-maximisation
estimates the document's language proportions from them, weighted by their n-grams, and
languages are dropped one by one as long as the penalised likelihood (``PENALTY`` times the
log of the number of n-grams for each language, the Bayesian information criterion) rises.
A segment's language is the most probable one of that set under the proportions; its
confidence is the posterior under the proportions, smoothed by half a segment for every
language, so that no language is impossible.

Words of the corpus. The first models label all papers; the words of their confident
segments are counted per language over the whole corpus with map-side combining, and those
in at least ``KNOWN_SHARE`` of a language's papers join the second models, weighted by that
share. A share bounds their number (a language has at most words-per-paper / KNOWN_SHARE of
them) and works alike at every size. Judging documents is a narrow map with a bounded cache
of word scores.

Defined cases: null, empty and letterless texts have no segments; a document without
segments gives no rows; of equally likely languages the smaller code wins; texts of any
length are judged whole; of rows delivered again the latest counts, of equally late ones
the greater by content; without usable samples nothing is judged.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperloom.session import cut_lineage, in_arrow

ORDER = 4
FIT_ROWS = 2_000
PENALTY = 0.5
#: Scales log-likelihoods of n-grams, which are not independent.
TEMPER = 0.35
CACHE_WORDS = 200_000
UNKNOWN_WEIGHT = 0.25
#: Share of a language's papers that hold a word of the second models, and the confidence of segments that count.
KNOWN_SHARE, SELF_CONFIDENCE = 0.01, 0.95

# Usual codes and names of languages.
LANGUAGE_NAMES = {
    "en": "en eng english englisch anglais inglés inglês ingles 英语 英文",
    "de": "de deu ger german deutsch allemand alemán alemão 德语 德文",
    "fr": "fr fra fre french französisch français francais francés francês 法语 法文",
    "es": "es spa spanish castilian spanisch espagnol español espanol castellano espanhol 西班牙语 西班牙文",
    "pt": "pt por portuguese portugiesisch portugais portugués português portugues 葡萄牙语 葡萄牙文",
    "zh": "zh zho chi chinese mandarin chinesisch chinois chino chinês cmn cn 中文 汉语 漢語 普通话 简体中文 繁體中文",
    "it": "it ita italian italiano italienisch",
    "nl": "nl nld dut dutch nederlands",
    "ru": "ru rus russian русский",
    "ja": "ja jpn japanese 日本語",
    "ko": "ko kor korean 한국어",
}
_CODES = {name: code for code, names in LANGUAGE_NAMES.items() for name in names.split()}
_WORD = re.compile(r"[㐀-鿿]|[^\W\d_㐀-鿿]+")
_SENTENCE = re.compile(r"(?<=[。！？])\s*|(?<=[.!?])(?:[\"”»’)\]]*)\s+(?=[\"“«‘(\[¿¡]*[^\W\d_a-z]|[\"“«]|$)|\n\s*\n")


def label_code(label: str | None) -> str | None:
    """The language a label names, whatever its notation; None if it names none."""
    text = (label or "").strip().casefold()
    for part in (text, re.split(r"[-_ (/,;]", text)[0]):
        if part in _CODES:
            return _CODES[part]
    return None


def label_code_column(col: Column) -> Column:
    """``label_code`` as a column expression."""
    known = F.create_map(*[F.lit(x) for pair in _CODES.items() for x in pair])
    text = F.lower(F.trim(col))
    return F.coalesce(F.try_element_at(known, text), F.try_element_at(known, F.regexp_extract(text, r"^([^-_ (/,;]*)", 1)))


class Model:
    """Interpolated character models of several languages, and their known words.

    ``samples``: (language, text) pairs. A word is known if at least two texts of a language
    hold it; words that no language knows are mostly names, which all languages share, and
    count only ``UNKNOWN_WEIGHT``. ``known``: further (language, word, weight), as if so many
    texts held the word.
    """

    def __init__(self, samples: list[tuple[str, str]], known: list[tuple[str, str, int]] = ()):
        self.langs = sorted({lang for lang, _ in samples})
        self.counts: list[dict[str, int]] = [defaultdict(int) for _ in self.langs]
        self.after: list[dict[str, int]] = [defaultdict(int) for _ in self.langs]
        kinds: list[set] = [set() for _ in self.langs]
        self.words: list[Counter] = [Counter() for _ in self.langs]

        def learn(k: int, w: str, times: int) -> None:
            padded = "^" * (ORDER - 1) + w + "$"
            for i in range(ORDER - 1, len(padded)):
                for n in range(ORDER):
                    gram = padded[i - n : i + 1]
                    self.counts[k][gram] += times
                    self.after[k][gram[:-1]] += times
                    kinds[k].add(gram)

        for lang, text in samples:
            k = self.langs.index(lang)
            self.words[k].update(set(tokens(text)))
            for w in tokens(text):
                learn(k, w, 1)
        for lang, w, weight in known:
            k = self.langs.index(lang)
            self.words[k][w] += weight
            learn(k, w, weight)
        self.kinds: list[dict[str, int]] = [Counter(g[:-1] for g in s) for s in kinds]
        self.words = [Counter({w: n for w, n in c.items() if n >= 2}) for c in self.words]
        self.totals = [max(1, sum(c.values())) for c in self.words]
        self.counts, self.after = [dict(c) for c in self.counts], [dict(c) for c in self.after]
        self.kinds = [dict(c) for c in self.kinds]
        self.cache: dict[str, tuple[list[float], float]] = {}

    def _prob(self, k: int, gram: str) -> float:
        p = 1e-4  # a character never seen
        for n in range(1, len(gram) + 1):
            g = gram[len(gram) - n :]
            total = self.after[k].get(g[:-1], 0)
            if not total:
                break
            types = self.kinds[k].get(g[:-1], 0)
            p = (self.counts[k].get(g, 0) + types * p) / (total + types)
        return p

    def word(self, w: str) -> tuple[list[float], float]:
        """Log-likelihood of a word in every language and its number of n-grams, both weighted."""
        hit = self.cache.get(w)
        if hit is not None:
            return hit
        padded = "^" * (ORDER - 1) + w + "$"
        grams = [padded[max(0, i - ORDER + 1) : i + 1] for i in range(ORDER - 1, len(padded))]
        scores = [sum(math.log(self._prob(k, g)) for g in grams) for k in range(len(self.langs))]
        whole = [c.get(w, 0) / t for c, t in zip(self.words, self.totals)]
        if any(whole):
            scores = [math.log(0.5 * p + 0.5 * math.exp(max(s, -700))) for p, s in zip(whole, scores)]
            hit = scores, float(len(grams))
        else:
            hit = [UNKNOWN_WEIGHT * s for s in scores], UNKNOWN_WEIGHT * len(grams)
        if len(self.cache) >= CACHE_WORDS:
            self.cache.clear()
        self.cache[w] = hit
        return hit

    def segment(self, text: str) -> tuple[list[float], float]:
        total, n = [0.0] * len(self.langs), 0.0
        for w in tokens(text):
            s, m = self.word(w)
            n += m
            for k, v in enumerate(s):
                total[k] += v
        return total, n


def tokens(text: str) -> list[str]:
    return [w.lower() for w in _WORD.findall(text)]


#: A phrase set apart by brackets, no sentence of its own.
_ASIDE = re.compile(r"^[(\[（【].*[)\]）】]\W*$", re.S)
_MIN_TOKENS = 3


def sentences(text: str | None) -> list[str]:
    """Whole sentences of a text, in order.

    A bracketed phrase stays with the sentence before it, a heading or number of fewer
    than three words with the one after it.
    """
    out: list[str] = []
    lead = ""
    for s in _SENTENCE.split(text or ""):
        if not s or not s.strip():
            continue
        s = s.strip()
        if out and (m := re.match(r"([(\[（【][^()\[\]（）【】]*[)\]）】])\s+(?=\S)", s)) and not re.search(r"[.!?。！？]\W*$", m.group(1)):
            out[-1] += " " + m.group(1)
            s = s[m.end() :]
        if out and _ASIDE.match(s) and not re.search(r"[.!?。！？]\W*$", s):
            out[-1] += " " + s
        elif len(_WORD.findall(s)) < _MIN_TOKENS:
            lead += s + " "
        else:
            out.append(lead + s)
            lead = ""
    if lead.strip():
        if out:
            out[-1] += " " + lead.strip()
        elif _WORD.search(lead):
            out.append(lead.strip())
    return out


def mixture(likes: list[list[float]], sizes: list[float], n_langs: int, rounds: int = 30) -> tuple[list[float], list[int]]:
    """(proportions, language set) by EM with backward elimination on the penalised likelihood."""

    def em(active: list[int]) -> tuple[list[float], float]:
        pi = [1.0 / len(active) if k in active else 0.0 for k in range(n_langs)]
        total = sum(sizes) or 1
        ll = -math.inf
        for _ in range(rounds):
            new, now = [0.0] * n_langs, 0.0
            for s, m in zip(likes, sizes):
                logs = [math.log(pi[k]) + s[k] if pi[k] > 1e-12 else -math.inf for k in active]
                top = max(logs)
                z = top + math.log(sum(math.exp(v - top) for v in logs))
                now += z
                for k, v in zip(active, logs):
                    new[k] += m * math.exp(v - z)
            pi = [v / total for v in new]
            if now - ll < 1e-6:
                break
            ll = now
        return pi, ll

    cost = PENALTY * math.log(max(2, sum(sizes)))
    # a language that is best for no segment cannot raise the likelihood of the set
    active = sorted({max(range(n_langs), key=lambda k: (s[k], -k)) for s in likes})
    if len(active) == 1:
        return [float(k == active[0]) for k in range(n_langs)], active
    pi, ll = em(active)
    while len(active) > 1:
        trials = [([k for k in active if k != gone],) for gone in active]
        scored = [(em(a[0]), a[0]) for a in trials]
        (best_pi, best_ll), best = max(scored, key=lambda x: x[0][1])
        if best_ll + cost <= ll:
            break
        active, pi, ll = best, best_pi, best_ll
    return pi, active


def scored_segments(title: str | None, abstract: str | None, model: Model) -> list[tuple[str, int, str, list[float], float]]:
    """(field, number, text, tempered log-likelihoods, tempered n-grams) of each segment with letters."""
    parts = [("title", 0, title)] if title and _WORD.search(title) else []
    parts += [("abstract", n, s) for n, s in enumerate(sentences(abstract))]
    out = []
    for f, n, t in parts:
        s, m = model.segment(t)
        if m:
            out.append((f, n, t, [TEMPER * v for v in s], TEMPER * m))
    return out


def judge(title: str | None, abstract: str | None, model: Model) -> list[tuple[str, int, str, str, float]]:
    """(field, number, text, language, confidence) of each segment."""
    scored = scored_segments(title, abstract, model)
    if not scored or not model.langs:
        return []
    n_langs = len(model.langs)
    pi, active = mixture([x[3] for x in scored], [x[4] for x in scored], n_langs)
    n = len(scored)
    prior = [math.log((n * p + 0.5) / (n + 0.5 * n_langs)) for p in pi]
    out = []
    for f, k, t, s, _ in scored:
        best = max(active, key=lambda i: (math.log(max(pi[i], 1e-9)) + s[i], -i))
        logs = [q + v for q, v in zip(prior, s)]
        top = max(logs)
        out.append((f, k, t, model.langs[best], math.exp(logs[best] - top) / sum(math.exp(v - top) for v in logs)))
    return out


def proportions(title: str | None, abstract: str | None, model: Model) -> list[tuple[str, float]]:
    """(language, share) of a document's mixture, languages of the set only."""
    scored = scored_segments(title, abstract, model)
    if not scored or not model.langs:
        return []
    pi, active = mixture([x[3] for x in scored], [x[4] for x in scored], len(model.langs))
    return [(model.langs[k], pi[k]) for k in active]


def sample_rows(samples: DataFrame) -> list[tuple[str, str]]:
    """At most FIT_ROWS labelled (language, text) a language, those of the least hashes."""
    named = samples.select(label_code_column(F.col("lang")).alias("lang"), "text").where(
        F.col("lang").isNotNull() & (F.length("text") > 0)
    )
    langs = [r["lang"] for r in named.select("lang").distinct().collect()]
    rows: list[tuple[str, str]] = []
    for lang in sorted(langs):  # a handful of languages, each a bounded read
        one = named.where(F.col("lang") == lang).orderBy(F.xxhash64("text"), "text").limit(FIT_ROWS)
        rows += [(r["lang"], r["text"]) for r in one.collect()]
    return rows


_COUNTS = pa.schema([("lang", pa.string()), ("word", pa.string()), ("n", pa.int64())])


def corpus_words(papers: DataFrame, model: Model) -> list[tuple[str, str, int]]:
    """(language, word, per cent of the language's papers) of the words that stand in KNOWN_SHARE of them or more."""

    def flush(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in counts], pa.string()), pa.array([k[1] for k in counts], pa.string()), pa.array(counts.values(), pa.int64())],
            schema=_COUNTS,
        )

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for b in it:
            for title, abstract in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by: dict[str, set[str]] = defaultdict(set)
                for _, _, text, lang, confidence in judge(title, abstract, model):
                    if confidence >= SELF_CONFIDENCE:
                        by[lang].update(tokens(text))
                for lang, words in by.items():
                    counts[lang, ""] += 1  # the paper itself
                    counts.update((lang, w) for w in words)
            if len(counts) > 200_000:
                yield flush(counts)
                counts.clear()
        yield flush(counts)

    rows = papers.select("title", "abstract").transform(in_arrow, batches, "lang string, word string, n bigint")
    counted = cut_lineage(rows.groupBy("lang", "word").agg(F.sum("n").alias("n")))
    totals = counted.where("word = ''").select("lang", F.col("n").alias("total"))
    known = counted.where("word <> ''").join(F.broadcast(totals), "lang")  # one row a language
    often = known.where((F.col("n") >= 2) & (F.col("n") >= KNOWN_SHARE * F.col("total")))
    kept = often.select("lang", "word", F.greatest(F.lit(1), F.round(100 * F.col("n") / F.col("total"))).cast("int").alias("w"))
    return sorted((r["lang"], r["word"], r["w"]) for r in kept.collect())


def fit(samples: DataFrame, papers: DataFrame | None = None) -> Model:
    """A model from the samples and, with ``papers`` (one row each), the words that their confident segments share."""
    rows = sample_rows(samples)
    model = Model(rows)
    if papers is None or not rows:
        return model
    return Model(rows, corpus_words(papers, model))


def latest(papers: DataFrame) -> DataFrame:
    """(paper_id, title, abstract, lang): the latest row of every paper."""
    row = F.struct("ingested_at", "title", "abstract", "lang")
    return (
        papers.where(F.col("paper_id").isNotNull())
        .groupBy("paper_id")
        .agg(F.max(row).alias("r"))
        .select("paper_id", "r.title", "r.abstract", "r.lang")
    )


_SEGMENTS = pa.schema(
    [("paper_id", pa.string()), ("label", pa.string()), ("field", pa.string()), ("n", pa.int32()), ("text", pa.string()),
     ("lang", pa.string()), ("confidence", pa.float64())]
)


def segments(papers: DataFrame, samples: DataFrame) -> DataFrame:
    """Every segment of every paper with its language and confidence, beside the paper's label."""
    rows = cut_lineage(latest(papers).select("paper_id", "title", "abstract", label_code_column(F.col("lang")).alias("label")))
    model = fit(samples, rows)

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = [
                (p, label, *seg)
                for p, title, abstract, label in zip(*(c.to_pylist() for c in b.columns))
                for seg in judge(title, abstract, model)
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out) if out else [[]] * len(_SEGMENTS), _SEGMENTS)], schema=_SEGMENTS
            )

    return rows.transform(
        in_arrow, batches, "paper_id string, label string, field string, n int, text string, lang string, confidence double"
    )


def mixtures(papers: DataFrame, samples: DataFrame) -> DataFrame:
    """(paper_id, lang, share): the language proportions of every paper that has segments."""
    rows = cut_lineage(latest(papers).select("paper_id", "title", "abstract"))
    model = fit(samples, rows)
    schema = pa.schema([("paper_id", pa.string()), ("lang", pa.string()), ("share", pa.float64())])

    def batches(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in it:
            out = [(p, *x) for p, title, abstract in zip(*(c.to_pylist() for c in b.columns)) for x in proportions(title, abstract, model)]
            yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in out], f.type) for k, f in enumerate(schema)], schema=schema)

    return rows.transform(in_arrow, batches, "paper_id string, lang string, share double")


def unnamed(papers: DataFrame, samples: DataFrame) -> DataFrame:
    """(paper_id, lang): languages written in a paper that its label does not name."""
    return (
        segments(papers, samples)
        .where(F.col("label").isNull() | (F.col("label") != F.col("lang")))
        .select("paper_id", "lang")
        .distinct()
    )
