import itertools
import re
import unicodedata

import pytest
from paperloom.llm import bpe, lookalike


def docs(spark, texts, ids=None):
    rows = [(i, t, "x", 7) for i, t in zip(ids or range(1, len(texts) + 1), texts)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, class string, raw int")


def found(spark, texts, ids=None):
    return {tuple(r) for r in lookalike.pairs(docs(spark, texts, ids)).collect()}


@pytest.mark.parametrize(
    ("a", "b", "alike"),
    [
        ("caf\u00e9 x", "cafe\u0301 x", True), ("cafe x", "caf\u00e9 x", False), ("\uff21\uff42c d", "Abc d", True), ("a\u200bb c", "ab c", True),
        ("a\u00a0b", "a b", True), ("a\u3000b", "a b", True), ("\u0441o\u0440y", "copy", True), ("x\u00b2", "x2", False), ("\ufb01n", "fin", True),
        ("a\nb", "a b", False), ("a\r\nb", "a\nb", True), ("a  b", "a b", False), ("A", "a", False), ("\u00bd", "1/2", False), ("a\u00adb", "ab", True),
        ("5 \u2026", "5 ...", False), ("a-b", "a\u2010b", True), ("same", "same", False), (" ", "\u00a0", False),
    ],
)
def test_pairs(spark, a, b, alike):
    assert found(spark, [a, b]) == ({(1, 2)} if alike else set())


def test_edges_and_copies(spark):
    texts = ["", None, " ", "\n", "x y", "x y", "x\u00a0y", "x\u2003y", "z" * 100_000, "z" * 99_999 + "\uff5a"]
    want = {(5, 7), (5, 8), (6, 7), (6, 8), (7, 8), (9, 10)}
    assert found(spark, texts) == want
    hot = ["same text"] * 300 + ["same\u2009text"]
    assert len(found(spark, hot)) == 300
    assert lookalike.pairs(docs(spark, ["a"]).limit(0)).count() == 0
    assert found(spark, ["a b", "a\u00a0b", "q"], [None, 2, 3]) == set()
    assert found(spark, ["a b", "a\u00a0b"], [1, 1]) == set()


def test_canonical_is_the_smallest(spark):
    got = {r.id: r.canonical for r in lookalike.canonical_members(docs(spark, ["x\u00a0y", "x y", "q"])).collect()}
    assert got == {1: "x y", 2: "x y", 3: "q"}


def test_against_brute_force(spark, medium):
    single, multi, _ = lookalike.tables()
    ligatures = multi

    def look(t):
        t = "".join(ligatures.get(c, c) for c in t.replace("\r\n", "\n").replace("\r", "\n"))
        return unicodedata.normalize("NFC", "".join(single.get(c, c) for c in t))

    df = spark.read.parquet(f"{medium}/documents.parquet").select("doc_id", "text")
    groups = {}
    for r in df.collect():
        if r.text and re.sub(r"[\s\u200b-\u200d\u2060\ufeff]", "", r.text):
            groups.setdefault(look(r.text), []).append((r.doc_id, r.text))
    want = {(min(a, b), max(a, b)) for g in groups.values() for (a, s), (b, t) in itertools.combinations(g, 2) if s != t}
    assert {tuple(r) for r in lookalike.pairs(df).collect()} == want and want


def test_bpe_against_the_library(spark, small):
    import public_tokenizers
    import tiktoken

    path = bpe.vocabulary_path()
    lib = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(path), special_tokens={})
    encode = bpe.encoder(path)
    texts = ["", "a", "  two  blanks \n\n", "don't", "\u00fc\u4e2d\u6587\U0001f9ea", "x" * 5000, "<|endoftext|>", "\u200b\ufeff", "1234567 abc", "aaaaaaaaab" * 50]
    for t in texts:
        assert encode(t) == lib.encode_ordinary(t)
        assert bpe.decode(encode(t), path) == t
    assert encode(None) == []
    df = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text", "lang")
    text = {r.doc_id: r.text for r in df.collect()}
    got = bpe.encode_corpus(df).collect()
    assert len(got) == len(text)
    assert all(r.ids == lib.encode_ordinary(text[r.id] or "") for r in got)
    back = bpe.decode_corpus(bpe.encode_corpus(df).withColumnRenamed("id", "doc_id")).collect()
    assert all(r.text == (text[r.id] or "") for r in back)


def test_bpe_on_empty_table(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string, ids string")
    assert bpe.encode_corpus(df).count() == 0


def test_cache_bound_changes_nothing(monkeypatch):
    path = bpe.vocabulary_path()
    whole = bpe.encoder(path)("alpha beta gamma delta alpha beta")
    monkeypatch.setattr(bpe, "CACHE_TOKENS", 1)
    bpe.encoder.cache_clear()
    assert bpe.encoder(path)("alpha beta gamma delta alpha beta") == whole
    bpe.encoder.cache_clear()


def test_parts_of_batches_and_round_trip(spark, small, monkeypatch):
    import pyarrow as pa

    df = spark.read.parquet(f"{small}/documents.parquet").select("doc_id", "text").orderBy("doc_id").limit(40)
    whole = {r.id: r.ids for r in bpe.encode_corpus(df).collect()}
    rows = df.collect()
    monkeypatch.setattr(bpe, "FLAT_IDS", 100)
    taken = []

    class Frame:
        def select(self, *_):
            return self

        def transform(self, _, f, ddl):
            batch = pa.RecordBatch.from_arrays([pa.array([r.doc_id for r in rows], pa.int64()), pa.array([r.text for r in rows], pa.string())], names=["id", "x"])
            taken.extend(f(iter([batch])))

    bpe.encode_corpus(Frame())
    assert len(taken) > 5 and {i: ids for b in taken for i, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist())} == whole
    one = bpe.round_trip(df).first()
    assert one.docs == one.same == 40 and one.tokens == sum(map(len, whole.values()))
    assert tuple(bpe.round_trip(df.limit(0)).first()) == (0, 0, 0)
