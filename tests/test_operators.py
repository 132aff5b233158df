from paperloom.operators import blocks as BL
from paperloom.operators import links as LK
from paperloom.operators import pages as PG
from paperloom.operators import quality as QL
from paperloom.operators import references as RF
from paperloom.operators import relational as R
from paperloom.operators import tables as TB
from paperloom.sources.staging import PROVIDERS, read_block_lists, read_layout_pages
from pyspark.sql import functions as F

BLOCKS = (
    "block_id bigint, paper_id string, seq bigint, type string, text string, text_level int, page_idx int, image_caption array<string>, "
    "chart_caption array<string>, table_body string, table_caption array<string>, list_items array<string>, bbox array<double>"
)


def blocks(spark, rows):
    full = [dict({"paper_id": "p", "page_idx": 0, "seq": i, "block_id": i}, **r) for i, r in enumerate(rows)]
    names = [c.split()[0] for c in BLOCKS.split(", ")]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in full], BLOCKS)


def papers(spark, title=None, doi=None):
    return spark.createDataFrame([("p", title, doi)], "paper_id string, title string, doi string")


def test_cover_needs_markers_and_no_prose(spark):
    lines = ["Citation (APA)", "Document Version", "Important note", "Takedown policy", "Downloaded from x", "For technical reasons", "Delft University of Technology"]
    cover = blocks(spark, [{"type": "text", "text": t} for t in lines])
    assert PG.cover_pages(cover, papers(spark)).first().is_cover
    prose = blocks(spark, [{"type": "text", "text": t} for t in [*lines, "x " * 200]])
    assert not PG.cover_pages(prose, papers(spark)).first().is_cover
    rich = blocks(spark, [{"type": "text", "text": t} for t in lines] + [{"type": "image"}])
    assert not PG.cover_pages(rich, papers(spark)).first().is_cover
    weak = blocks(spark, [{"type": "text", "text": t} for t in [*lines[:3], "A rather long title of a paper"]])
    assert not PG.cover_pages(weak, papers(spark, "A rather long title of a paper")).first().is_cover


def test_article_boundaries(spark):
    title = "A rather long title of a paper"
    b = blocks(
        spark,
        [{"type": "text", "text": "other " * 100}, {"type": "text", "text": title, "text_level": 1}, {"type": "text", "text": "body"},
         {"type": "text", "text": "References", "text_level": 1}, {"type": "ref_text", "text": "[1] X"},
         {"type": "text", "text": "Next article", "text_level": 1}, {"type": "text", "text": "more"}],
    )
    rows = BL.intermediate(b)
    kept = {r.content for r in PG.within_article(rows, papers(spark, title)).where("kind <> 'page_anchor'").collect()}
    assert kept == {title, "body", "References", "[1] X"}


def test_tables_over_pages(spark):
    t = lambda *cells: "<table>" + "".join(f"<tr><td>{c}</td><td>1</td></tr>" for c in cells) + "</table>"
    b = blocks(
        spark,
        [{"type": "table", "table_body": t("h", "a"), "table_caption": ["Table 1. x"]},
         {"type": "table", "table_body": t("h", "b"), "table_caption": [], "page_idx": 1},
         {"type": "text", "text": "Prose that stands between the tables, long enough to count.", "page_idx": 2},
         {"type": "table", "table_body": t("h", "c"), "table_caption": [], "page_idx": 3}],
    )
    m = {r.seq: r for r in TB.merged(BL.intermediate(b)).collect()}
    assert m[0].parts == 2 and m[0].content.count("<tr>") == 3 and m[3].parts == 1


def test_captions_bind(spark):
    rows = [("p", 0, 1, "fig_caption", False), ("p", 0, 2, "image", False), ("p", 0, 3, "image", False), ("p", 0, 4, "text", False),
            ("p", 0, 5, "image", False), ("p", 0, 6, "fig_caption", False), ("p", 0, 7, "table_caption", False), ("p", 0, 9, "table", False)]
    df = spark.createDataFrame(rows, "paper_id string, page_idx int, seq bigint, type string, has_caption boolean")
    assert {r.seq: r.target_seq for r in BL.bind_captions(df).collect()} == {1: 3, 6: 5, 7: 9}


def test_reference_join(spark):
    e = spark.createDataFrame([("p", 1, 1, "[1] A. doi:10.1234/real"), ("p", 2, 2, "[2] B")], "paper_id string, pos int, n int, raw string")
    it = "paper_id string, item_pos int, n int, title string, authors array<string>, year int, venue string, doi string"
    items = spark.createDataFrame([("p", 1, 1, "Title one", [" A ", ""], 2001, "V", "10.0000/guess"), ("p", 2, 2, "Title two", None, 1800, None, None)], it)
    got = {r.n: r for r in RF.join_items(e, items).collect()}
    assert got[1].doi == "10.1234/real" and got[1].authors == ["A"] and got[2].year is None and got[2].title == "Title two"
    six = spark.createDataFrame([("p", i, i, f"[{i}] x") for i in range(1, 7)], "paper_id string, pos int, n int, raw string")
    assert {r.source for r in RF.join_items(six, items.limit(1)).collect()} == {"rule"}


def test_spatial_and_interval_joins(spark):
    chars = spark.createDataFrame([("p", 0, i, 10.0 * i, 0.0, 10.0 * i + 8, 10.0) for i in range(10)], "paper_id string, page int, ci int, x0 double, y0 double, x1 double, y1 double")
    links = spark.createDataFrame([(1, "p", 0, 19.0, -1.0, 49.0, 11.0)], "link_id int, paper_id string, page int, x0 double, y0 double, x1 double, y1 double")
    assert [tuple(r) for r in LK.span_in_rectangle(chars, links).collect()] == [(1, 2, 5)]
    parts = spark.createDataFrame([("p", 0, 0.0, 0.0, 5.0, 9.0, "["), ("p", 0, 5.0, 0.0, 9.0, 9.0, "12"), ("p", 0, 9.0, 0.0, 12.0, 9.0, "]"), ("p", 0, 90.0, 0.0, 95.0, 9.0, "x")], "paper_id string, page int, x0 double, y0 double, x1 double, y1 double, text string")
    assert [(r.text, r.n) for r in LK.citation_clusters(parts).collect()] == [("[12]", 3)]
    assert LK.inject("see 5 and $5$", [(4, 5, "#eq-5"), (11, 12, "#eq-5")]) == "see [5](#eq-5) and $5$"
    assert LK.equal_segments("The  quick brown fox", "quick brown") == [(5, 0, 11)]


def test_number_gaps(spark):
    df = spark.createDataFrame([([1, 4], []), ([2], [5]), ([], [])], "a array<int>, m array<int>")
    assert [r[0] for r in df.select(QL.missing_numbers(F.col("a"), F.col("m"))).collect()] == [[2, 3], [3, 4, 5], []]
    pages = spark.createDataFrame([("a", 3, 5), ("b", 5, 6), ("c", 0, None), ("d", 1, 2), ("e", 0, 0)], "paper_id string, markers int, pages int")
    assert [r.paper_id for r in QL.page_completeness(pages).collect()] == ["a"]


def test_as_of_and_bands_on_hot_keys(spark):
    l = spark.createDataFrame([(1, i) for i in range(300)], "k int, t int")
    r = spark.createDataFrame([(1, 10 * i, i) for i in range(30)], "k int, t int, v int")
    got = {x.t: x.v for x in R.as_of(l, r, "k", "t", "v").collect()}
    assert got == {i: i // 10 for i in range(300)}
    b = R.band_join(l.withColumnRenamed("t", "a"), r.select("k", F.col("t").alias("b")), "k", "a", "b", 2)
    assert b.count() == sum(abs(i - 10 * j) <= 2 for i in range(300) for j in range(30))


def test_sources(spark, tmp_path):
    import json

    folder = tmp_path / "paper1"
    folder.mkdir()
    (folder / "x_content_list.json").write_text(json.dumps([{"type": "text", "text": "a", "page_idx": 0}, {"type": "image", "img_path": "i.png", "page_idx": 1}]))
    rows = read_block_lists(spark, str(tmp_path / "*" / "*_content_list.json")).orderBy("seq").collect()
    assert [(r.paper_id, r.seq, r.type) for r in rows] == [("paper1", 0, "text"), ("paper1", 1, "image")]
    page = {"layoutParsingResults": [{"prunedResult": {"parsing_res_list": [{"block_label": "image", "block_content": "", "block_bbox": [1, 2, 3, 4]}]}, "markdown": {"images": {"imgs/img_in_image_box_1_2_3_4.jpg": "http://u"}}}]}
    (tmp_path / "p.jsonl").write_text(json.dumps(page))
    assert read_layout_pages(spark, str(tmp_path / "p.jsonl")).first().image_url == "http://u"
    PROVIDERS.register("mine", lambda s, p: s.range(1))
    assert "mine" in PROVIDERS.names() and PROVIDERS.get("mine")(spark, "").count() == 1


def test_results_do_not_depend_on_partitions(spark, small):
    from paperloom.plans.corpus import ir_rows

    def rows(n):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        return sorted(map(str, ir_rows(spark, small).collect()))

    one, many = rows(1), rows(8)
    spark.conf.set("spark.sql.shuffle.partitions", 4)
    assert one == many
