import glob
import json

import pytest
from paperloom.operators import headings as HD
from paperloom.operators import links as LK
from paperloom.plans import pipeline as P
from pyspark.sql import Window
from pyspark.sql import functions as F

BLOCKS = (
    "block_id bigint, paper_id string, seq bigint, type string, text string, text_level int, page_idx int, img_path string, image_caption array<string>, chart_caption array<string>, "
    "table_body string, table_caption array<string>, list_items array<string>, bbox array<double>, extra string"
)
PAPERS = "paper_id string, title string, author array<struct<name:string,affiliation:string>>, date string, abstract string, doi string, container_title string, keywords array<string>, volume string, issue string, page string, lang string, citekey string"


@pytest.mark.parametrize(
    ("text", "known", "want"),
    [
        ("See [1], [2] and [9].", ["ref-1", "ref-2"], "See [[1]](#ref-1), [[2]](#ref-2) and [9]."), ("See [1, 2].", ["ref-1", "ref-2"], "See [[1]](#ref-1), [[2]](#ref-2)."),
        ("See [1–3].", ["ref-1", "ref-3"], "See [[1]](#ref-1)–[[3]](#ref-3)."), ("See [1, 5].", ["ref-1"], "See [1, 5]."), ("$a[1]$ and [1]", ["ref-1"], "$a[1]$ and [[1]](#ref-1)"),
        ("Fig. 3, Table 2, Eq. (4)", ["fig-3", "eq-4"], "[Fig. 3](#fig-3), Table 2, [Eq. (4)](#eq-4)"), ("[1]", ["ref-1"], "[[1]](#ref-1)"), ("", [], ""),
    ],
)
def test_links_reach_known_targets_only(spark, text, known, want):
    df = spark.createDataFrame([(text, known)], "t string, k array<string>")
    assert df.select(LK.with_links(F.col("t"), F.col("k"))).first()[0] == want


def test_neighbours_over_buckets(spark):
    rows = [("p", s, 0, f"k{s}") for s in (0, 5, 999, 1000, 4500, 4501, 9000)] + [("q", 3, 0, "x"), (None, 1, 0, "n"), (None, 2000, 0, "m")]
    df = spark.createDataFrame(rows, "paper_id string, seq bigint, sub int, kind string")
    w = Window.partitionBy("paper_id").orderBy("seq", "sub")
    want = df.withColumn("a", F.lag("kind").over(w)).withColumn("b", F.lead("kind").over(w))
    assert sorted(map(str, HD.beside(df, "kind", "a", "b").collect())) == sorted(map(str, want.collect()))


def test_a_paper_becomes_one_document(spark, tmp_path):
    rows = []

    def add(kind, text, page=0, level=0, **more):
        seq = len(rows)
        rows.append((seq, "p", seq, kind, text, level, page, more.get("img"), more.get("cap"), None, more.get("body"), more.get("tcap"), None, None, "x"))

    add("header", "Journal", 0)
    add("text", "On the very long title of a paper", 0, 1)
    add("text", "Introduction", 0, 1)
    add("text", "The value $x_{3+$\\delta}$ was seen [1, 2], see Fig. 1 and", 0)
    add("text", "it goes on<sup>2</sup> here. Also [7].", 0)
    add("image", None, 0, img="a.png", cap=["Figure 1. A picture"])
    add("table", None, 0, body="<table><tr><th>A</th></tr><tr><td>1</td></tr></table>", tcap=["Table 1. X"])
    add("table", None, 1, body="<table><tr><th>A</th></tr><tr><td>2</td></tr></table>", tcap=["Table 1 (continued)"])
    add("text", "Download PDF", 1)
    add("ref_text", "[1] A. Author, T., 2020. https://doi.org/10.1234/abc", 1)
    add("ref_text", "[2] B. Author, U., 2021.", 1)
    blocks = spark.createDataFrame(rows, BLOCKS)
    papers = spark.createDataFrame([("p", "On the very long title of a paper", [("A B", None)], "2020", "Abstract\ntext", None, "J", None, None, None, None, "en", "bee2020"), ("q", "Empty", None, None, None, None, None, None, None, None, None, None, None)], PAPERS)
    P.write_corpus(blocks, papers, str(tmp_path))
    (doc,) = glob.glob(f"{tmp_path}/documents/slug=bee2020/*.txt")
    text = open(doc).read()
    assert text.startswith("---\ntitle:") and "abstract: >-\n  Abstract text" in text
    assert "$x_{3+\\delta}$ was seen [[1]](#ref-1), [[2]](#ref-2), see [Fig. 1](#fig-1) and it goes on$^{2}$ here. Also [7]." in text
    assert "images/fig1.png" in text and '<a id="fig-1"></a>' in text and '<a id="ref-1"></a>[1] A. Author' in text
    assert text.count("<td>1</td>") == text.count("<td>2</td>") == 1 and text.count("<th>A</th>") == 1 and "Download PDF" not in text
    assert text.index("# References") < text.index("[1] A. Author") and "Introduction" in text
    (refs,) = glob.glob(f"{tmp_path}/references/slug=bee2020/*.txt")
    found = json.loads(open(refs).read())
    assert found["count"] == 2 and found["references"][0]["doi"] == "10.1234/abc"
    assert P.convert(blocks.limit(0), papers).count() == 0
