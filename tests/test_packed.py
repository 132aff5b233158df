import pytest
from paperloom.operators import packed


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Keywords: a b; c, d.", ["a b", "c", "d"]),
        ('Key words: "x; y","p ""q""",z;', ["x; y", 'p "q"', "z"]),
        ("Mots-clés : “un, deux”;trois ;; quatre", ["un, deux", "trois", "quatre"]),
        ("KEYWORDS one / two / three", ["one", "two", "three"]),
        ("关键词：粘度、指数；分布", ["粘度", "指数", "分布"]),
        ("Index terms — a\nb\nc", ["a", "b", "c"]),
        ("Abbreviations: f(x, y); g", ["f(x, y)", "g"]),
        ("Keywords: only", []),
        ("Keywords are useful, as is known; very much", []),
        ("The Keywords: a; b", []),
        (None, []),
        ("", []),
    ],
)
def test_lists(text, want):
    assert [v for _, v, _ in packed.labelled_list(text)] == want


def test_malformed_quote_backtracks():
    got = packed.labelled_list('Keywords: "broken; next; last')
    assert [(v, f) for _, v, f in got] == [('"broken', "quote"), ("next", None), ("last", None)]


A = "Ann B. Cee, On x, J. Y. Z 4 (1999) 1–9."
B = 'D. E. Eff; G. Hah (2004). "On y". J. Z, 3, 12.'


@pytest.mark.parametrize("sep", ["\n", "; ", " ; ", " || ", " ¶ ", " • ", "\t"])
def test_references(sep):
    assert packed.reference_list(A + sep + B) == [(1, A, None), (2, B, None)]


@pytest.mark.parametrize(("m1", "m2", "sep"), [("[7] ", "[8] ", " "), ("(a) ", "(b) ", "; "), ("a) ", "b) ", " "), ("3. ", "4. ", "\n")])
def test_marked_references(m1, m2, sep):
    assert [v for _, v, _ in packed.reference_list(m1 + A + sep + m2 + B)] == [A, B]


def test_quoted_references_and_single_ones():
    q = lambda s: '"' + s.replace('"', '""') + '"'
    assert [v for _, v, _ in packed.reference_list(q(A) + ", " + q(B))] == [A, B]
    for one in (A, B, "[3] " + B, "X; Y; J 2018, 10; 265.", "(1021) " + A, None, " "):
        assert packed.reference_list(one) == []


def test_long_list_is_whole(spark):
    text = "Keywords: " + "; ".join(f"w{i} x" for i in range(20_000))
    df = spark.createDataFrame([(1, text, 9), (1, text, 9), (2, None, 9)], "block_id bigint, text string, pos int")
    got = packed.labelled_lists(df)
    assert got.count() == 40_000 and got.agg({"pos": "max"}).first()[0] == 20_000
    assert packed.labelled_lists(df.limit(0)).count() == 0


def test_long_raw_is_linear():
    import time

    raw = "\n".join(f"[{i}] " + A for i in range(1, 3001)) + "\n" + "x; y\n" * 20_000
    began = time.time()
    assert len(packed.reference_list(raw)) == 3000
    assert time.time() - began < 20


@pytest.mark.parametrize("size", [10, 50, 150, 5_000])
def test_a_reference_may_end_with_a_link_of_any_length(size):
    a = "Ann B. Cee, On x, J. Y. Z 4 (1999), https://x.org/" + "a" * size
    assert [v for _, v, _ in packed.reference_list(a + "; " + B)] == [a, B]


@pytest.mark.parametrize("end", ["(n.d.).", "in press.", "(forthcoming).", "im Druck.", "no prelo."])
def test_references_without_years(spark, end):
    a, b = f"Cee, A. On x. J. Y. Z, {end}", f"Eff, D. On y. J. Z, {end}"
    assert [v for _, v, _ in packed.reference_list(a + "\n" + b)] == [a, b]
    df = spark.createDataFrame([(1, a + "\n" + b), (2, a)], "ref_id bigint, raw string")
    assert packed.packed_references(df).count() == 2


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("Keywords: [a, (b, c)], d; {e, f}.", ["[a, (b, c)]", "d", "{e, f}"]),
        ("Keywords: (a, b) c, d", ["(a, b) c", "d"]),
        ("Keywords: (a, b; c", ["(a", "b", "c"]),
        ("Keywords: " + "(" * 20_000 + "a, b", ["(" * 20_000 + "a", "b"]),
        ("Keywords: " + "(" * 20_000 + "a, b" + ")" * 20_000 + "; c", ["(" * 20_000 + "a, b" + ")" * 20_000, "c"]),
    ],
)
def test_bracketed_values(text, want):
    assert [v for _, v, _ in packed.labelled_list(text)] == want


def test_bracketed_references():
    a, b = "[Cee, A. On x. J. Y. Z, 1999; 4, 1-9]", "[Eff, D. (On y) 2004; 3]"
    assert [v for _, v, _ in packed.reference_list(f"{a}; {b}")] == [a, b]
