from paperloom.operators import xmldoc as X
from paperloom.settings import Settings
from paperloom.sources.model import Model, lenient_json
from pyspark.sql import functions as F

JATS = """<article xmlns:xlink="x"><front><journal-meta><journal-title-group><journal-title>J. Made Up</journal-title></journal-title-group></journal-meta>
<article-meta><article-id pub-id-type="doi">10.1234/abc</article-id><title-group><article-title>On <i>x</i></article-title></title-group>
<contrib-group><contrib contrib-type="author"><name><surname>Bee</surname><given-names>Ann</given-names></name><aff>Uni A</aff></contrib>
<contrib contrib-type="author"><collab>X Group</collab></contrib><contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib></contrib-group>
<pub-date><day>5</day><month>1</month><year>2026</year></pub-date><volume>3</volume><fpage>101</fpage><lpage>118</lpage>
<abstract abstract-type="graphical"><p>pic</p></abstract><abstract><p>Short abstract.</p></abstract><kwd-group><kwd>k1</kwd><kwd>k2</kwd></kwd-group></article-meta></front>
<body><sec><title>Intro</title><p>See <xref ref-type="bibr" rid="B2">2</xref> and H<sub>2</sub>O &nbsp; <inline-formula><math><mi>x</mi></math></inline-formula>.</p>
<sec><title>Deep</title><fig><label>Figure 1</label><caption><p>Cap.</p></caption><graphic xlink:href="g.png"/></fig>
<table-wrap><label>Table 1</label><caption><p>T.</p></caption><table><tr><td>a</td></tr></table></table-wrap>
<disp-formula><label>(3)</label><tex-math>$a=b$</tex-math></disp-formula></sec></sec></body>
<back><ref-list><ref><element-citation><person-group><name><surname>Cee</surname><given-names>D</given-names></name></person-group><article-title>T1</article-title><year>1999</year></element-citation></ref>
<ref><mixed-citation>Plain text 2001.</mixed-citation></ref></ref-list></back></article>"""


def test_metadata():
    m = X.metadata(X.load(JATS))
    assert (m["title"], m["doi"], m["date"], m["page"], m["abstract"]) == ("On x", "10.1234/abc", "2026-01-05", "101-118", "Short abstract.")
    assert [a["name"] for a in m["author"]] == ["Ann Bee", "X Group"] and m["author"][0]["affiliation"] == "Uni A"
    assert m["keywords"] == ["k1", "k2"] and m["container_title"] == "J. Made Up"


def test_blocks():
    b = X.body_blocks(X.load(JATS))
    assert [x["type"] for x in b] == ["text", "text", "text", "image", "table", "equation", "text", "ref_text", "ref_text"]
    assert b[1]["text"].startswith("See [2](#ref-2) and H<sub>2</sub>O") and "$x$" in b[1]["text"]
    assert (b[0]["text_level"], b[2]["text_level"]) == (1, 2)
    assert b[3]["image_caption"] == ["Figure 1. Cap."] and b[3]["img_path"] == "g.png" and "<td>a</td>" in b[4]["table_body"]
    assert b[5]["text"] == r"a=b \tag{3}" and b[7]["text"] == "[1] D Cee, T1, 1999"


def test_bad_records(spark):
    df = spark.createDataFrame([(1, JATS, 0), (2, None, 0), (3, "", 0), (4, "<a>", 0), (5, "<a/>", 0)], "xml_id bigint, xml string, seq int")
    assert {r.xml_id for r in X.xml_metadata(df).collect()} == {1, 5}
    assert {r.xml_id for r in X.xml_blocks(df).collect()} == {1}
    assert X.guard_entities("&alpha; &amp; &unknownname; &lt;") == "α &amp; unknownname &lt;"


def test_model_steps_down_and_keeps_rules():
    def ask(prompt, **o):
        if "thinking" in o:
            raise ValueError("unknown option")
        return f"{prompt}!"

    m = Model(ask)
    assert m("a") == "a!" and m.mode == "effort_low"
    assert Model()("a") is None

    def broken(prompt, **o):
        raise RuntimeError("down")

    n = Model(broken)
    assert n("a") is None and n.failures == ["down"]


def test_settings_and_json(spark):
    s = Settings.from_env({"PAPERLOOM_MAX_PAGES": "9", "PAPERLOOM_ARTICLE_BOUNDARY": "no", "PAPERLOOM_SOURCE": ""})
    assert (s.max_pages, s.article_boundary, s.early_pages) == (9, False, 4)
    df = spark.createDataFrame([('{"a": "x"}',), (r'{"a": "\alpha"}',), ("{",), (None,)], "j string")
    got = [r[0] for r in df.select(F.try_variant_get(lenient_json(F.col("j")), "$.a", "string")).collect()]
    assert got == ["x", r"\alpha", None, None]
