import pytest
from paperloom.functions import bibliography as B
from paperloom.functions import latex as L
from paperloom.functions import text as T
from paperloom.functions.mathml import mathml_to_latex
from paperloom.operators import metadata as MD
from paperloom.operators import quality as Q
from paperloom.operators import references as RF
from pyspark.sql import functions as F


def column(spark, f, *values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(f(F.col("v"))).collect()]


def test_doi(spark):
    got = column(
        spark, B.doi, "see 10.1016/0550-3213(85)90022-7.", "(10.1000/abc)", "doi:10.1/x", "https://doi.org/10.1234/a.b;", "10.99999/x]", None, ""
    )
    assert got == ["10.1016/0550-3213(85)90022-7", "10.1000/abc", None, "10.1234/a.b", "10.99999/x", None, None]


def test_arxiv_and_numbers(spark):
    assert column(spark, B.arxiv, "arXiv:2605.22944v1", "[arXiv:hep-th/0204074]", "none") == ["2605.22944", "hep-th/0204074", None]
    assert column(spark, B.entry_number, "[12] X", "12. X", "12 Xy", "X no number") == ["12", "12", "12", None]


def test_roman(spark):
    assert column(spark, T.roman_to_int, "IV", "xxx", "XXXI", "abc", "IX", "") == [4, 30, None, None, 9, None]
    df = spark.createDataFrame([(n,) for n in (1, 4, 9, 14, 30, 31)], "n int")
    assert [r[0] for r in df.select(T.int_to_roman(F.col("n"))).collect()] == ["I", "IV", "IX", "XIV", "XXX", None]


def test_text_rules(spark):
    assert column(spark, T.spaced_heading, "A B S T R A C T", "Abstract x") == ["Abstract", "Abstract x"]
    assert column(spark, T.brackets_balanced, "(a)", ")(", "(()", "", None) == [True, False, False, True, None]
    assert column(spark, T.footnote_number, "$^{1}$ x", "6 Note", "note") == [1, 6, None]
    assert column(spark, T.citation_superscripts, r"a$^{[1-7]}$", r"b$^{[a]}$") == ["a[1-7]", r"b$^{[a]}$"]
    assert column(spark, T.clean_paragraph, "Review", "© 2020 X", "10.1234/abc", "Plain text stays.", "  ") == [None, None, None, "Plain text stays.", None]
    assert column(spark, T.strip_watermark, "Published on 13 March 2024. Downloaded by X on 1.\nDownloaded from y\nkeep") == ["Published on 13 March 2024.\nkeep"]
    assert column(spark, T.parse_authors, "Zhao, Chen; Wang, Qi; Li, Bo", "A. Bee, C. Dee and E. Eff") == [
        ["Chen Zhao", "Qi Wang", "Bo Li"], ["A. Bee", "C. Dee", "E. Eff"],
    ]


def test_years(spark):
    f = lambda c: MD.publication_year(c, 2027)
    got = column(spark, f, "Received 5 May 2022, Accepted 3 March 2023", "J. X 101 (2007) 372–378 received 2005", "no year", "© 2019 Y")
    assert [(r and (r.year, r.source)) for r in got] == [(2023, "accepted"), (2007, "citation"), None, (2019, "copyright")]


@pytest.mark.parametrize(
    ("rule", "text", "want"),
    [
        (L.single_tag, r"x \tag{5}\tag{50}", r"x \tag{50}"),
        (L.single_tag, r"x \tag{1}\tag{2}", r"x \tag{2}"),
        (L.balance_braces, "$x_{a$ b", "$x_{a}$ b"),
        (L.tidy_math, r"$ x $ \mathrm{C D 3 4} _{0. 2 5}", r"$x$ \mathrm{CD34} _{0.25}"),
        (L.scripts_outside_math, "Na₀.₂₅CoO₂", "Na$_{0.25}$CoO$_{2}$"),
        (L.scripts_outside_math, "Na_xCoO_2 is", "$Na_xCoO_2$ is"),
        (L.heading_math, r"A $\mathrm{CO}_2$", "A CO₂"),
        (L.heading_math, r"A $\frac{1}{2}$", r"A $\frac{1}{2}$"),
    ],
)
def test_latex(rule, text, want):
    assert rule(text) == want


def test_skeleton_and_captions():
    skel, at = L.skeleton("A  B’s ﬁx")
    assert skel == "a b's fix" and len(at) == len(skel)
    parts = L.split_captions("Fig. 5. " + "a" * 50 + " Fig. 6. " + "b" * 50)
    assert [n for n, _ in parts] == ["5", "6"] and L.split_captions("Fig. 5. short") == []


@pytest.mark.parametrize(
    ("xml", "want"),
    [
        ("<math><mfrac><mi>E</mi><mrow><mi>k</mi><mi>T</mi></mrow></mfrac></math>", r"\frac{E}{kT}"),
        ("<msubsup><mi>x</mi><mn>1</mn><mn>2</mn></msubsup>", "x_1^2"),
        ("<msqrt><mi>v</mi></msqrt>", r"\sqrt{v}"),
        ("<mtable><mtr><mtd><mn>1</mn></mtd><mtd><mn>2</mn></mtd></mtr></mtable>", r"\begin{matrix}1 & 2\end{matrix}"),
        ("<mroot><mi>a</mi><mn>3</mn></mroot>", r"\sqrt[3]{a}"),
        ("<odd>text</odd>", "text"),
        ("not xml <", "not xml <"),
    ],
)
def test_mathml(xml, want):
    assert mathml_to_latex(xml) == want


def test_reference_splitting():
    rows = ["[1] Aa B. X. 2001. [2] Cc D. Y citing [5] here.", "[3] Ee F. Z."]
    assert [n for n, _ in RF.split_rows(rows)] == [1, 2, 3]
    assert [n for n, _ in RF.split_rows(["1. Aa B. One.", "2. Cc D. Two.", "390. VDI Verlag"])] == [1, 2]
    apa = ["Aa, B. (2001). X title.", "Wiley.", "Cc, D. (2002). Y title.", "Ee, F. (2003). Z title."]
    assert RF.split_rows(apa) == [(None, "Aa, B. (2001). X title. Wiley."), (None, apa[2]), (None, apa[3])]
    assert RF.split_rows([]) == [] and RF.split_rows([None, " "]) == []


def test_degenerate_loops(spark):
    loop, units = "fire " * 200, ", ".join(f"{1700 + 100 * i % 9000} nm" for i in range(150))
    table = " | ".join(f"cell{i} {'x' * (i % 7)}" for i in range(80))
    prose = "\n".join("fire " * 20 for _ in range(50))
    df = spark.createDataFrame(list(enumerate([loop, units, table, prose, None, ""])), "i int, t string")
    got = {r.id: r for r in Q.degenerate_lines(df, "i", "t").collect()}
    assert {0, 1} <= set(got) and 3 not in got and got[0].repeats >= 10


@pytest.mark.parametrize(
    ("text", "figures", "tables"),
    [
        ("Ref. [55], whose Table 2 or Table 3 list it", [], []), ("Table 2 shows the results; Fig. 4 plots them.", [4], [2]),
        ("Fig. 3 of Ref. [5] and Fig. 7 differ; Figure 8 does not.", [8], []), ("see Fig. 3 in [12]. Table 1", [], [1]),
        ("whose Table 2 gives all of the long list of values or Table 3", [], []), ("Refs. [1, 2]: Fig. 9", [], []), ("Fig. 2, Fig. 2", [2], []),
    ],
)
def test_own_mentions(spark, text, figures, tables):
    r = Q.mentions(spark.createDataFrame([(1, text)], "i int, t string"), "i", "t").first()
    assert (list(r.figures), list(r.tables)) == (figures, tables)


@pytest.mark.parametrize(
    ("bad", "good"),
    [
        ("$O_{2$'}$", "$O_{2'}$"), ("$x_{(O-Na-O$)}$", "$x_{(O-Na-O)}$"), ("$g^{-1$}$", "$g^{-1}$"), (r"$x_{3+$\delta}$", r"$x_{3+\delta}$"),
        ("$x_{2$/3}$", "$x_{2/3}$"), ("{(1-x$)$}", "{(1-x)}"), ("$Li_{0$.75}$", "$Li_{0.75}$"), ("{0$.5-$x}", "{0.5-x}"), ("$Na_{2}/3}$", "$Na_{2/3}$"),
        ("$Na}^+$", "$Na^+$"), (r"\mathrm{$Na}", r"\mathrm{Na}"), (r"\text{$x$}", r"\text{$x$}"), ("costs {$5} or $x$", "costs {$5} or $x$"), ("$$a{b$$", "$$a{b}$$"),
        (r"a \$5 {b}", r"a \$5 {b}"), ("$a_{b$ c", "$a_{b}$ c"), ("", ""), ("$", "$"), ("{{{$", "{{{$"),
    ],
)
def test_scripts_are_repaired(bad, good):
    assert L.repair_scripts(bad) == good and L.repair_scripts(good) == good


def test_entries_that_begin_alike_are_kept():
    long = "[1] Aaron B. Author, Carla D. Author, Emma F. Author, "
    assert len(RF.split_rows([long + "First work, 2001.", long + "Second work, 2002."])) == 2
    assert len(RF.split_rows([long + "First work, 2001."] * 2)) == 1


def test_lists_in_parts_go_on(spark):
    rows = [("p", 63, 1, 0, "reference", "1. Aa B. One,"), ("p", 64, 2, 0, "reference", "and the rest, 2001."), ("p", 64, 3, 0, "reference", "2. Cc D. Two."), ("p", 128, 4, 0, "reference", "3. Ee F. Three."), ("p", 128, 5, 0, "paragraph", "4. Gg")]
    df = spark.createDataFrame(rows, "paper_id string, page_idx int, seq bigint, sub int, kind string, content string")
    got = sorted((r.pos, r.n, r.raw) for r in RF.split_entries(df).collect())
    assert got == [(1, 1, "1. Aa B. One, and the rest, 2001."), (2, 2, "2. Cc D. Two."), (3, 3, "3. Ee F. Three.")]


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("J. Phys. 12 (2003) 45", (2003, "citation")), ("Nature, 1999, 4", (1999, "citation")), ("Vol. 3 (2007).", (2007, "citation")), ("\u00a9 2011 The Authors", (2011, "copyright")),
        ("Received 3 May 2009; accepted 2 July 2010", (2010, "accepted")), ("Published online 2015. Accepted 2014", (2015, "published")), ("in 2004 we", None), ("(c) 3099", None), (None, None),
        ("Received 2001, J. X 4 (2002) 7", (2002, "citation")),
    ],
)
def test_publication_years(spark, text, want):
    got = spark.createDataFrame([(text,)], "t string").select(MD.publication_year(F.col("t"), 2027).alias("y")).first().y
    assert (tuple(got) if got else None) == want


@pytest.mark.parametrize(
    ("text", "noise"),
    [
        ("https://doi.org/10.1/x", True), ("Article https://doi.org/10.1/x", True), ("https://doi.org/10.1/x Received 3 May", True), ("www.site.org", True), ("10.1234/abc", True),
        ("Received: 3 May 2009", True), ("Published online 3 May", True), ("RECEIVED in May", True), ("\u00a9 The Authors", True), ("Download PDF", True), ("Table 3 Values (continued)", True),
        ("Licensed under Creative Commons", True), ("See https://doi.org/10.1/x for all", False), ("Received wisdom says", False), ("Sharing is good", False), ("", False), (None, False),
    ],
)
def test_publisher_noise(spark, text, noise):
    assert spark.createDataFrame([(text,)], "t string").select(T.publisher_noise(F.col("t"))).first()[0] is noise


def test_slug(spark):
    df = spark.createDataFrame(
        [("k<1>", "A B", "2020", "The X"), (None, "Zoë Müller", "2021-05", "On the role"), ("", None, None, None)], "k string, a string, d string, t string"
    )
    got = [r[0] for r in df.select(T.slug(F.col("k"), F.col("a"), F.col("d"), F.col("t"))).collect()]
    assert got[:2] == ["k1", "muller2021role"] and got[2].startswith("paper")
