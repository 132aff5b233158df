import pytest
from paperloom.llm import lookalike
from pyspark.sql import functions as F

from tests.llm.test_lookalike_and_bpe import found


@pytest.mark.parametrize(
    ("a", "b", "alike"),
    [
        ("\U0001d400\U0001d622 x", "Aa x", True), ("\ud55c\uad6d", "\u1112\u1161\u11ab\u1100\u116e\u11a8", True), ("\uf900 x", "\u8c48 x", True),
        ("\u0451\u0436", "\u0435\u0308\u0436", True), ("\u0457\u0436", "\u0456\u0308\u0436", True), ("\u045e\u0436", "\u0443\u0306\u0436", True),
        ("\u03bb\u03cc\u03b3", "\u03bb\u03bf\u0301\u03b3", True), ("\ud55c", "\ud558", False), ("\u0451\u0436", "\u0435\u0436", False),
    ],
)
def test_forms_of_all_planes(spark, a, b, alike):
    assert found(spark, [a, b]) == ({(1, 2)} if alike else set())


def test_every_form_of_several_letters_counts(spark):
    multi = {c: v for c, v in lookalike._MULTI.items()}
    rows = spark.createDataFrame([(c,) for c in multi], "c string").select("c", lookalike.mapped(F.col("c")).alias("m"), lookalike.mapped(F.lit("x")).alias("x")).collect()
    plain = spark.createDataFrame([(v,) for v in set(multi.values())], "v string").select("v", lookalike.mapped(F.col("v")).alias("m")).collect()
    want = {r.v: r.m for r in plain}
    assert len(rows) > 200 and all(r.m == want[multi[r.c]] for r in rows)


def test_classes_and_canonical_texts_cover_all_documents(spark):
    texts = ["ﬁne", "fine", "fine", "ﬁne ", None, "", "other"]
    df = spark.createDataFrame([(k, t, 0) for k, t in enumerate(texts)], "doc_id bigint, text string, links int")
    assert {(r.id, r["class"], r.links) for r in lookalike.classes(df).collect()} == {(0, 0, 2), (1, 0, 1), (2, 0, 1)}
    got = {r.id: r.canonical for r in lookalike.canonical_members(df).collect()}
    assert got == {0: "fine", 1: "fine", 2: "fine", 3: "ﬁne ", 4: None, 5: "", 6: "other"}


def test_near_texts_by_shuffle_are_those_by_broadcast(spark, small, monkeypatch):
    df = spark.read.parquet(f"{small}/documents.parquet")
    want = {tuple(r) for r in lookalike.pairs(df).collect()}
    monkeypatch.setattr(lookalike, "NEAR_ROWS", -1)
    assert {tuple(r) for r in lookalike.pairs(df).collect()} == want
