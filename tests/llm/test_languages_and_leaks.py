import datetime as dt
from collections import defaultdict

import pytest
from paperloom.llm import languages, leaks
from pyspark.sql import functions as F


@pytest.mark.parametrize(
    ("label", "want"),
    [("en-GB", "en"), ("ENG", "en"), ("ger", "de"), ("Deutsch", "de"), ("zh_CN", "zh"), ("Chinese", "zh"), ("pt-BR", "pt"), ("xx", None), ("", None), (None, None), ("n/a", None), ("fran\u00e7ais", "fr")],
)
def test_labels(spark, label, want):
    assert languages.label_code(label) == want
    df = spark.createDataFrame([(label,)], "l string")
    assert df.select(languages.label_code_column(F.col("l"))).first()[0] == want


def test_sentences():
    s = languages.sentences("One of the two. (\u201cEsta fase libre\u201d) Abstract. Three of 5.3 nm here? Done with it!")
    assert s == ["One of the two. (\u201cEsta fase libre\u201d)", "Abstract. Three of 5.3 nm here?", "Done with it!"]
    assert languages.sentences(None) == [] and languages.sentences(" ... ") == []


def papers(spark, rows):
    return spark.createDataFrame([(*r, 5) for r in rows], "paper_id string, title string, abstract string, lang string, ingested_at timestamp, label int")


def test_held_out_accuracy(spark, medium):
    samples = spark.read.parquet(f"{medium}/lang_samples.parquet").orderBy("sample_id").collect()
    train = [(r.lang, r.text) for r in samples if r.sample_id % 4]
    test = [r for r in samples if r.sample_id % 4 == 0]
    model = languages.Model(train)
    right = sum(languages.judge(None, r.text, model)[0][3] == r.lang for r in test)
    assert right / len(test) >= 0.97


def test_mixed_papers(spark, medium):
    samples = spark.read.parquet(f"{medium}/lang_samples.parquet")
    by = {r.lang: r.text for r in samples.orderBy("sample_id").collect()}
    old, new = dt.datetime(2020, 1, 1), dt.datetime(2021, 1, 1)
    rows = [
        ("a", None, by["de"] + " " + by["en"], "en", old), ("b", None, by["fr"], "fr-CA", old), ("c", None, by["zh"], None, old),
        ("d", None, by["es"], "en", old), ("d", None, by["es"], "es", new), ("e", None, None, "en", old), ("f", "", "", "en", old), (None, None, by["es"], "en", old),
        ("g", None, by["en"] + " (\u201cEsta fase libre\u201d)", "en", old), ("h", None, by["pt"], "English", old), ("h", None, by["pt"], "English", old),
    ]
    got = {tuple(r) for r in languages.unnamed(papers(spark, rows), samples).collect()}
    assert got == {("a", "de"), ("c", "zh"), ("h", "pt")}
    assert languages.unnamed(papers(spark, rows).limit(0), samples).count() == 0
    conf = languages.segments(papers(spark, rows), samples).agg(F.min("confidence"), F.max("confidence")).first()
    assert 0 < conf[0] <= conf[1] <= 1


def test_mixture_drops_what_does_not_pay():
    pi, active = languages.mixture([[-10.0, -10.1], [-10.0, -9.9]], [5, 5], 2)
    assert len(active) == 1
    pi, active = languages.mixture([[-10.0, -90.0], [-90.0, -10.0]], [5, 5], 2)
    assert active == [0, 1] and abs(pi[0] - 0.5) < 0.01


def test_leaks_against_brute_force(spark, medium):
    docs = spark.read.parquet(f"{medium}/documents.parquet")
    items = spark.read.parquet(f"{medium}/eval_items.parquet")
    got = {tuple(r) for r in leaks.leaked(docs, items).collect()}
    words = lambda df, k: df.where("length(text) > 0").select(k, leaks.word_hashes(F.col("text")).alias("w")).collect()
    item = {r.item_id: list(r.w) for r in words(items, "item_id")}
    grams = defaultdict(set)
    for k, w in item.items():
        for i in range(len(w) - 3):
            grams[tuple(w[i : i + 4])].add(k)
    want = set()
    for r in words(docs, "doc_id"):
        hits = {k for i in range(len(r.w) - 3) for k in grams.get(tuple(r.w[i : i + 4]), ())}
        want |= {(r.doc_id, k) for k in hits if leaks.covered(list(r.w), item[k]) >= leaks.SHARE * len(item[k])}
    assert want and len(got & want) / len(want) >= 0.97 and not got - want


def test_leak_edges(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(60))
    w = passage.split()
    bad = " ".join(x if i % 11 else "altered" for i, x in enumerate(w))
    rows = [
        (1, passage), (2, "intro " + bad.replace(" ", "\n", 3)), (3, " ".join(w[:12])), (4, None), (5, ""), (6, passage.upper() + "."), (7, " ".join(reversed(w))),
        (8, "x " * 100_000 + passage), (None, passage), (1, passage), (9, "<b>" + passage.replace(" wordb", " [12] **wordb**") + "</b>"),
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, item_id int")
    items = spark.createDataFrame([(10, passage, "x"), (11, passage, "x"), (12, None, "x"), (13, "short text", "x"), (None, passage, "x")], "item_id bigint, text string, doc_id string")
    got = {tuple(r) for r in leaks.leaked(docs, items).collect()}
    assert got == {(d, i) for d in (1, 2, 6, 8, 9) for i in (10, 11)}
    assert leaks.leaked(docs.limit(0), items).count() == 0 and leaks.leaked(docs, items.limit(0)).count() == 0


def test_blocks_of_items_give_the_same(spark, small, monkeypatch):
    docs, items = spark.read.parquet(f"{small}/documents.parquet"), spark.read.parquet(f"{small}/eval_items.parquet")
    one = {tuple(r) for r in leaks.leaked(docs, items).collect()}
    monkeypatch.setattr(leaks, "BLOCK_WORDS", 4000)
    assert {tuple(r) for r in leaks.leaked(docs, items).collect()} == one


def test_the_mixture_decides_a_doubtful_segment(spark, medium):
    model = languages.Model(languages.sample_rows(spark.read.parquet(f"{medium}/lang_samples.parquet")))
    title, doc = "Estudio de helzayl a 581 °C", spark.read.parquet(f"{medium}/lang_samples.parquet").where("lang = 'es'").orderBy("sample_id").first().text
    alone = languages.judge(title, None, model)
    assert alone[0][3] == "pt"  # what the wording of the title alone says
    assert languages.judge(title, doc, model)[0][3] == "es"
    assert languages.judge(title, doc, model)[0][4] > 1 - alone[0][4]
    assert languages.proportions(title, doc, model) == [("es", 1.0)]


def test_words_of_the_corpus_count_whole_papers(spark, medium):
    samples = spark.read.parquet(f"{medium}/lang_samples.parquet")
    model = languages.Model(languages.sample_rows(samples))
    text = samples.where("lang = 'de'").orderBy("sample_id").first().text
    df = spark.createDataFrame([("t", text + " Zwirbelfunk.")] * 3 + [("t", text)] * 2 + [(None, None)], "title string, abstract string")
    words = {(lang, w): n for lang, w, n in languages.corpus_words(df, model)}
    assert words["de", "zwirbelfunk"] == 60 and all(n == 100 for (_, w), n in words.items() if w in languages.tokens(text))
    rows = papers(spark, [("a", None, text, None, dt.datetime(2020, 1, 1))])
    assert [tuple(r) for r in languages.mixtures(rows, samples).collect()] == [("a", "de", 1.0)]


def slow_cover(text, item, least):
    """Best chain of pieces by trying all."""
    equal = [(t, j) for t, w in enumerate(text) for j, x in enumerate(item) if w == x]
    runs = {(m, m, 1) for m in equal}
    todo = list(runs)
    while todo:
        a, (t, j), run = todo.pop()
        for n in ((t + 1, j + 1), (t + 2, j + 2), (t + 2, j + 1), (t + 1, j + 2)):
            whole = n == (t + 1, j + 1)
            state = (a, n, min(leaks.MIN_RUN, run + 1) if whole else 1)
            if n in equal and (whole or run >= leaks.MIN_RUN) and state not in runs:
                runs.add(state)
                todo.append(state)
    ranges = sorted({(a, b) for a, b, _ in runs if b[1] - a[1] + 1 >= least})

    def best(t, j):
        return max([0, *(b[1] - a[1] + 1 + best(b[0] + 1, b[1] + 1) for a, b in ranges if a[0] >= t and a[1] >= j)])

    return best(0, 0)


def test_cover_is_the_best_of_all_choices(monkeypatch):
    import random

    import numpy as np

    monkeypatch.setattr(leaks, "MIN_PIECE", 3)
    rng = random.Random(2)
    for _ in range(400):
        item = [rng.randrange(5) for _ in range(rng.randint(1, 9))]
        text = [rng.randrange(5) for _ in range(rng.randint(1, 9))]
        want = slow_cover(text, item, 3)
        assert leaks.covered(text, item) == want
        assert leaks.witness(text, item) <= want <= leaks.coverable(np.array(text), np.array(item))


def test_long_tags_do_not_split_a_passage(spark):
    passage = " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(40))
    w = passage.split()
    text = " ".join(w[:6]) + f' <a href="{"x" * 900}">' + " ".join(w[6:13]) + "</a> " + " ".join(w[13:])
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert leaks.leaked(docs, spark.createDataFrame([(5, passage)], "item_id bigint, text string")).count() == 1
