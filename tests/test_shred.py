import re
import xml.etree.ElementTree as ET
from collections import Counter

from pyspark.sql import functions as F
from paperloom.operators import shred


def brute(xml_id, xml):
    """The article nodes by one recursive walk, independent of the adjacency table."""
    try:
        root = ET.fromstring(xml)
    except ET.ParseError:
        return set()
    n, out = Counter(), set()

    def add(kind, parent="article", at=0):
        n[kind] += 1
        out.add((xml_id, kind, n[kind], parent, at))
        return n[kind]

    def walk(e, st):
        name, st = re.sub(r"^\{.*\}", "", e.tag), dict(st)
        sec = ("sec", st["sec"]) if "sec" in st else ()
        caption = any(re.sub(r"^\{.*\}", "", c.tag) == "caption" for c in e)
        if name == "contrib" and e.get("contrib-type", "author") == "author":
            st["author"] = add("author")
        elif name == "author" and "ref" not in st:
            st["author"] = add("author")
        elif name in ("aff", "affiliation"):
            add("aff", *(("author", st["author"]) if "author" in st else ()))
        elif name in ("kwd", "keyword"):
            add("kwd")
        elif name == "abstract":
            st["abstract"] = 1
        elif name in ("sec", "section") and "abstract" not in st:
            st["sec"] = add("sec", *sec)
        elif name in ("fig", "figure") and sec and caption:
            add("fig", *sec)
        elif name in ("table-wrap", "table") and sec and caption:
            add("table", *sec)
        elif name in ("ref", "bib-reference"):
            st["ref"] = add("ref")
        elif name == "person-group" and e.get("person-group-type") == "editor":
            st["editor"] = 1
        elif name in ("name", "string-name", "collab", "author") and "ref" in st and "editor" not in st:
            add("ref_author", "ref", st["ref"])
        for c in e:
            walk(c, st)

    walk(root, {})
    return out


def nodes(spark, rows):
    df = spark.createDataFrame(rows, "xml_id bigint, xml string, id string, kind string, rec int")
    out = shred.article_nodes(df.withColumnRenamed("id", "id"))
    return {(r.id, r.kind, r.pos, r.parent_kind, r.parent_pos) for r in out.collect()}


def test_against_a_plain_walk(spark, medium):
    got = shred.article_nodes(spark.read.parquet(f"{medium}/xml_docs.parquet"))
    mine = {(r.id, r.kind, r.pos, r.parent_kind, r.parent_pos) for r in got.collect()}
    want = set()
    for r in spark.read.parquet(f"{medium}/xml_docs.parquet").collect():
        want |= brute(r.xml_id, r.xml)
    assert mine == want and len(mine) > 1000


def test_edge_cases(spark):
    good = "<article><body><sec><title>a</title><sec><fig><caption>c</caption></fig></sec></sec></body></article>"
    rows = [
        (1, good, "x", "y", 3), (1, good, "x", "y", 3), (2, None, None, None, None), (3, "", "x", "y", 3), (4, "<a><b></a>", "x", "y", 3),
        (None, good, "x", "y", 3), (5, "<article>" + "<sec>" * 60 + "</sec>" * 60 + "</article>", "x", "y", 3),
    ]
    got = nodes(spark, rows)
    assert {r for r in got if r[0] == 1} == {(1, "sec", 1, "article", 0), (1, "sec", 2, "sec", 1), (1, "fig", 1, "sec", 2)}
    assert not {r for r in got if r[0] in (2, 3, 4, None)}
    assert (5, "sec", 60, "sec", 59) in got
    empty = spark.createDataFrame([], "xml_id bigint, xml string")
    assert shred.article_nodes(empty).count() == 0


def test_adjacency_keeps_structure():
    rows = shred.parse_record('<r xmlns:x="u"><x:a k="v">t &amp; u</x:a><a/><!-- c --></r>')
    assert [(r[0], r[1], r[2], r[3], r[4]) for r in rows] == [
        (0, None, "r", 1, None), (1, 0, "a", 1, "t & u"), (2, 1, "@k", 1, "v"), (3, 0, "a", 2, ""),
    ]


def test_entity_tables_keep_parents_and_own_text(spark, small, tmp_path):
    from paperloom.plans import general

    xml = (
        "<article><article-meta><title-group><article-title>On x</article-title></title-group><contrib-group>"
        "<contrib contrib-type='author'><name><surname>Cee</surname><given-names>A</given-names></name><aff>Dept of X<country>Y</country></aff></contrib></contrib-group>"
        "<kwd-group><kwd>one</kwd><kwd>two</kwd></kwd-group></article-meta><body><sec><title>S</title><fig><label>Figure 1</label><caption><p>Cap</p></caption></fig></sec></body>"
        "<back><ref-list><ref><label>1</label><mixed-citation><collab>Group Z</collab></mixed-citation></ref></ref-list></back></article>"
    )
    spark.createDataFrame([(1, xml, "p"), (1, xml, "p"), (2, "<broken", "p"), (3, None, "p")], "xml_id bigint, xml string, pos string").write.parquet(f"{tmp_path}/xml_docs.parquet")
    rows = lambda q: [tuple(r) for r in q(spark, str(tmp_path)).collect()]
    assert rows(general.p3_affiliations) == [(1, 1, "author", 1, "Dept of X", "Y", None)]
    assert sorted(r[-1] for r in rows(general.p3_keywords)) == ["one", "two"]
    assert rows(general.p3_figures) == [(1, 1, "sec", 1, "Figure 1", "Cap")]
    assert rows(general.p3_ref_authors) == [(1, 1, "ref", 1, None, None, "Group Z")]
    assert [r[2] for r in rows(general.p3_articles)] == ["On x"]


def test_parents_come_from_the_kinds(spark):
    doc = "<a><box><item>1</item></box><box><item>2</item><item>3</item></box></a>"
    nodes = shred.with_children(shred.shred(spark.createDataFrame([(1, doc)], "id bigint, x string"), "id", "x"))
    kinds = [shred.Kind("box", F.col("label") == "box"), shred.Kind("item", F.col("label") == "item", [("box", lambda s: s == "box")])]
    got = {(r.kind, r.pos, r.parent_kind, r.parent_pos) for r in shred.numbered(shred.objects(nodes, kinds)).collect()}
    assert got == {("box", 1, "article", 0), ("box", 2, "article", 0), ("item", 1, "box", 1), ("item", 2, "box", 2), ("item", 3, "box", 2)}
