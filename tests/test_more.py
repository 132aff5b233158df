import json

from paperloom import cli
from paperloom.functions import latex as L
from paperloom.operators import blocks as BL
from paperloom.operators import quality as QL
from paperloom.operators import render as RD
from pyspark.sql import functions as F

ROWS = "paper_id string, seq bigint, sub int, kind string, level int, page_idx int, caption string, content string"


def test_reference_heading_is_added_once(spark):
    df = spark.createDataFrame([("a", 1, 1, "paragraph", 0, 0, None, "x"), ("a", 2, 1, "reference", 0, 0, None, "[1] y"), ("b", 1, 1, "heading", 1, 0, None, "References"), ("b", 2, 1, "reference", 0, 0, None, "[1] z"), ("c", 1, 1, "paragraph", 0, 0, None, "q")], ROWS)
    got = BL.ensure_reference_heading(df).where("kind = 'heading'").collect()
    assert sorted((r.paper_id, r.seq, r.sub) for r in got) == [("a", 2, -1), ("b", 1, 1)]


def test_anchors_without_rows_go(spark):
    df = spark.createDataFrame([("a", 1, 0, "page_anchor", 0, 0, None, "0"), ("a", 1, 1, "paragraph", 0, 0, None, "x"), ("a", 2, 0, "page_anchor", 0, 1, None, "1")], ROWS)
    assert {r.page_idx for r in BL.tidy_anchors(df).where("kind = 'page_anchor'").collect()} == {0}


def test_frames_and_images(spark):
    pages = spark.createDataFrame([("a", 0, "xx"), ("a", 1, "y")], "paper_id string, page int, text string")
    assert sorted((r.page, r.text, r.split) for r in BL.page_frames(pages).collect()) == [(0, "xxy", 2), (1, "y", None)]
    b = spark.createDataFrame([("a", "images/f.png"), ("a", "http://x/g.png"), ("a", "h.png"), ("a", None)], "paper_id string, img_path string")
    have = spark.createDataFrame([("a", "/d/f.png")], "paper_id string, path string")
    assert [r.img_path for r in BL.resolve_images(b, have).collect()] == ["images/f.png"]


def test_front_matter_round_trip(spark):
    df = spark.createDataFrame([('---\ntitle: "A: b"\nlang: "en"\nlang: "de"\n---\nBody\n---\n',), ("no record",)], "d string")
    got = df.select(QL.front_matter_fields(F.col("d")).alias("m"), QL.strip_front_matter(F.col("d")).alias("b")).collect()
    assert got[0].m == {"title": "A: b", "lang": "en"} and got[0].b == "Body\n---\n" and got[1].b == "no record"


def test_math_markers():
    assert L.without_exponent("x^{2}3", "3") == "x^{2}" and L.without_exponent("^3", "3") is None
    assert L.linked_exponent("$^{1,2}$", {"1": "#ref-1", "2": "#ref-2"}) == "[[1]](#ref-1), [[2]](#ref-2)"
    assert L.linked_exponent("$TiO^{3}$", {"3": "#r"}) == "$TiO$[[3]](#r)" and L.linked_exponent("$^{1,9}$", {"1": "#r"}) is None
    assert L.swallowed_marker("abc $x^{2}$", 3, "2") == (6, 10) and L.lone_marker(["a $^{2}$", "b"], "2") == 0


def test_events_and_anchor_lines(spark):
    e = spark.createDataFrame([("r", 1, "start", None)], "run_id string, seq int, event string, percent int")
    assert json.loads(RD.event_lines(e).first().value) == {"event": "start"}
    a = spark.createDataFrame([("p", "ref-1", 5), ("p", "ref-2", 6)], "paper_id string, anchor string, seq bigint")
    asked = spark.createDataFrame([("p", "ref-1"), ("p", "ref-1")], "paper_id string, anchor string")
    assert [r.line for r in RD.wanted_anchors(a, asked).collect()] == ['<a id="ref-1"></a>']


def test_command_line(spark, small, tmp_path, capsys):
    assert cli.main([small, "-o", str(tmp_path), "--limit", "3", "--headless"]) == 0
    assert json.loads(capsys.readouterr().out.strip().split("\n")[-1])["event"] == "done"
    docs = list((tmp_path / "documents").glob("slug=*/*.txt"))
    assert len(docs) == 3 and all(d.read_text().startswith("---\n") for d in docs)


def test_fragments_merge_within_a_page(spark):
    from paperloom.operators import headings as HD

    rows = [("a", 1, 1, "paragraph", 0, 0, None, "The first part"), ("a", 2, 1, "paragraph", 0, 0, None, "goes on here."), ("a", 3, 1, "paragraph", 0, 0, None, "New one"),
            ("a", 4, 1, "image", 0, 0, "c", None), ("a", 5, 1, "paragraph", 0, 0, None, "after the image"), ("a", 6, 1, "paragraph", 0, 1, None, "other page"), ("b", 1, 1, "paragraph", 0, 0, None, "x 1"), ("b", 2, 1, "paragraph", 0, 0, None, "2 y")]
    got = {(r.paper_id, r.seq): (r.parts, r.content) for r in HD.merge_fragments(spark.createDataFrame(rows, ROWS)).collect()}
    assert got == {("a", 1): (2, "The first part goes on here."), ("a", 3): (1, "New one"), ("a", 5): (1, "after the image"), ("a", 6): (1, "other page"), ("b", 1): (1, "x 1"), ("b", 2): (1, "2 y")}
    assert HD.merge_fragments(spark.createDataFrame([], ROWS)).count() == 0
