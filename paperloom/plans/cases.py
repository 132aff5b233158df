"""Rules that no SQL states, checked on tables of fixed cases: a query runs the operator on the inputs, its SQL lists what must come out."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paperloom.functions import latex as L
from paperloom.functions import text as T
from paperloom.functions.mathml import mathml_to_latex
from paperloom.functions.udf import text_udf
from paperloom.operators import blocks as BL
from paperloom.operators import headings as HD
from paperloom.operators import links as LK
from paperloom.operators import pages as PG
from paperloom.operators import quality as QL
from paperloom.operators import references as RF
from paperloom.operators import tables as TB
from paperloom.operators import xmldoc as XD
from paperloom.registry import Registry
from paperloom.session import ship_package
from paperloom.sources import staging as ST
from paperloom.sources.model import lenient_json

CASES = Registry()


def _literal(v) -> str:
    if v is None:
        return "null"
    if isinstance(v, bool):
        return str(v).lower()
    if isinstance(v, list):
        return "[" + ", ".join(map(_literal, v)) + "]"
    return "'" + v.replace("'", "''") + "'" if isinstance(v, str) else str(v)


def case(name: str, schema: str, rows: list[tuple], run: Callable[[DataFrame], DataFrame], out: str, expected: list[tuple]) -> None:
    """Registers ``run`` over the rows, with SQL that lists the expected rows in the types of ``out``."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship_package(spark)
        return run(spark.createDataFrame(rows, schema))

    query.__doc__ = f"Fixed cases of {name}."
    columns = [c.strip().split(" ") for c in out.split(",")]
    values = ", ".join("(" + ", ".join(map(_literal, r)) + ")" for r in expected)
    CASES.add(name, f"select {', '.join(f'cast({c} as {t}) as {c}' for c, t in columns)} from (values {values}) t({', '.join(c for c, _ in columns)})")(query)


def scalar(name: str, f: Callable, cases: list[tuple]) -> None:
    """Cases (input, expected) of a text function."""
    rows = [(k, a) for k, (a, _) in enumerate(cases)]
    case(name, "k int, x string", rows, lambda df: df.select("k", f(F.col("x")).alias("value")), "k int, value varchar", [(k, b) for k, (_, b) in enumerate(cases)])


scalar("case_scripts_repaired", L.repair_scripts_col, [
    ("$O_{2$'}$", "$O_{2'}$"), ("$x_{(O-Na-O$)}$", "$x_{(O-Na-O)}$"), ("$g^{-1$}$", "$g^{-1}$"), ("$x_{3+$\\delta}$", "$x_{3+\\delta}$"), ("$x_{2$/3}$", "$x_{2/3}$"),
    ("{(1-x$)$}", "{(1-x)}"), ("$Li_{0$.75}$", "$Li_{0.75}$"), ("{0$.5-$x}", "{0.5-x}"), ("{0$,78}", "{0,78}"), ("{3+$/4+}", "{3+/4+}"), ("$Na_{2}/3}$", "$Na_{2/3}$"),
    ("$Na}^+$", "$Na^+$"), ("\\mathrm{$Na}", "\\mathrm{Na}"), ("$a_{b$ c", "$a_{b}$ c"), ("$$a{b{c$$", "$$a{b{c}}$$"), ("plain", "plain"), (None, None),
])
scalar("case_braces_balanced", L.balance_braces_col, [
    ("${\\mathrm{Na}_{0.7}{\\mathrm{O}}_{2}$", "${\\mathrm{Na}_{0.7}{\\mathrm{O}}_{2}}$"), ("$a}$", "$a}$"), ("$\\{a$", "$\\{a$"), ("${{{{a$", "${{{{a$"), ("$a{b$", "$a{b}$"),
])
scalar("case_single_tag", L.single_tag_col, [
    ("\\alpha = 1", "\\alpha = 1"), ("\\alpha = 1\\tag{50}", "\\alpha = 1\\tag{50}"), ("\\end{array} \\tag {5}\\tag{50}", "\\end{array} \\tag{50}"),
    ("\\end{array} \\tag {A}\\tag{A2}", "\\end{array} \\tag{A2}"), ("\\tag{50}\\tag{5}", "\\tag{50}"), ("a\\tag{5}b\\tag{50}c", "ab\\tag{50}c"), ("\\tag{1}\\tag{5}\\tag{50}", "\\tag{50}"),
])
scalar("case_math_tidy", L.tidy_math_col, [("$ a $ x", "$a$ x"), ("\\mathrm{C D 3 4}", "\\mathrm{CD34}"), ("x_{0. 2 5}", "x_{0.25}"), ("\\text{a b}", "\\text{ab}"), ("none", "none")])
scalar("case_scripts_to_latex", L.scripts_outside_math_col, [
    ("Na₂O", "Na$_{2}$O"), ("x²", "x$^{2}$"), ("Na_xO_2", "$Na_xO_2$"), ("$a₂$", "$a₂$"), ("10⁻³", "10$^{-3}$"), ("plain", "plain"),
])
scalar("case_heading_math", L.heading_math_col, [("A $x^{2}$", "A x²"), ("$\\mathrm{CO}_2$", "CO₂"), ("$\\alpha$", "$\\alpha$"), ("No math", "No math")])
scalar("case_mathml", text_udf(mathml_to_latex), [
    ("<math><mfrac><mi>E</mi><mrow><mi>k</mi><mi>T</mi></mrow></mfrac></math>", "\\frac{E}{kT}"), ("<msubsup><mi>x</mi><mn>1</mn><mn>2</mn></msubsup>", "x_1^2"),
    ("<msqrt><mi>v</mi></msqrt>", "\\sqrt{v}"), ("<mroot><mi>a</mi><mn>3</mn></mroot>", "\\sqrt[3]{a}"), ("<msup><mi>x</mi><mn>10</mn></msup>", "x^{10}"), ("<odd>text</odd>", "text"), ("not xml <", "not xml <"),
])
scalar("case_spaced_heading", T.spaced_heading, [("A B S T R A C T", "Abstract"), ("A B", "A B"), ("Abstract", "Abstract"), (None, None)])
scalar("case_document_body", QL.strip_front_matter, [("---\na: 1\n---\nText", "Text"), ("Text --- more", "Text --- more")])
scalar("case_json_repaired", lambda c: F.variant_get(lenient_json(c), "$.a", "string"), [('{"a": "b"}', "b"), ('{"a": "\\alpha"}', "\\alpha"), ("no json", None), (None, None)])
scalar("case_image_links", lambda c: T.is_url(c).cast("string"), [("https://x.org/a.png", "true"), ("http://x", "true"), ("images/a.png", "false"), (None, "false")])

case("case_captions_split", "k int, x string", [(1, "FIG. 5. " + "a" * 45 + " FIG. 6. " + "b" * 45), (2, "FIG. 5. " + "a" * 45), (3, "Figure 3: see Fig. 3a and Fig. 7). A long caption text that goes on."), (4, "FIG. 1. short FIG. 2. short")],
     lambda df: df.select("k", F.explode(L.split_captions_col(F.col("x"))).alias("c")).select("k", "c.number", "c.text"), "k int, number varchar, text varchar",
     [(1, "5", "FIG. 5. " + "a" * 45), (1, "6", "FIG. 6. " + "b" * 45)])
case("case_exponent_removed", "k int, core string, label string", [(1, "a^{12}", "12"), (2, "a^3", "3"), (3, "^{7}", "7"), (4, "a_{^{2}", "2"), (5, None, "1")],
     lambda df: df.select("k", L.without_exponent_col(F.col("core"), F.col("label")).alias("value")), "k int, value varchar", [(1, "a"), (2, "a"), (3, None), (4, None), (5, None)])
case("case_exponent_linked", "k int, span string, n array<string>, t array<string>", [(1, "$x^{1,2}$", ["1", "2"], ["#ref-1", "#ref-2"]), (2, "$^{1}$", ["1"], ["#ref-1"]), (3, "$x^{9}$", ["1"], ["#ref-1"]), (4, "$x$", ["1"], ["#ref-1"])],
     lambda df: df.select("k", L.linked_exponent_col(F.col("span"), F.col("n"), F.col("t")).alias("value")), "k int, value varchar",
     [(1, "$x$[[1]](#ref-1), [[2]](#ref-2)"), (2, "[[1]](#ref-1)"), (3, None), (4, None)])
case("case_markers_swallowed", "k int, x string, at int, label string", [(1, "ab$x^{3}$", 1, "3"), (2, "ab cdefg$x^3$", 1, "3"), (3, "$x^{2}$", 0, "3")],
     lambda df: df.select("k", F.array_join(L.swallowed_marker_col(F.col("x"), F.col("at"), F.col("label")), "-").alias("value")), "k int, value varchar", [(1, "4-8"), (2, None), (3, None)])
case("case_markers_alone", "k int, x array<string>, label string", [(1, ["a$^{1}$", "b"], "1"), (2, ["a$^{1}$", "b$^1$"], "1"), (3, ["a", "b"], "1")],
     lambda df: df.select("k", L.lone_marker_col(F.col("x"), F.col("label")).alias("value")), "k int, value int", [(1, 0), (2, None), (3, None)])
case("case_skeletons", "k int, x string", [(1, "Ab  ﬁ “x”"), (2, "ß–A")], lambda df: df.select("k", L.skeleton_col(F.col("x")).alias("s")).select("k", "s.skel", F.array_join("s.at", " ").alias("at_")), "k int, skel varchar, at_ varchar",
     [(1, 'ab fi "x"', "0 1 2 4 4 5 6 7 8"), (2, "ss-a", "0 0 1 2")])
case("case_destinations", "k int, d string", [(1, "/XYZ 72 700 0"), (2, "/FitH 600"), (3, "/FitR 10 20 30 740"), (4, "/Fit"), (5, None)],
     lambda df: df.select("k", T.destination_point(F.col("d"), F.lit(800.0)).alias("p")).select("k", "p.x", "p.y"), "k int, x double, y double",
     [(1, 72.0, 100.0), (2, 0.0, 200.0), (3, 10.0, 60.0), (4, None, None), (5, None, None)])
case("case_loops", "i bigint, t string", [(1, "fire " * 200), (2, "The first words of a long line. " + "ab12 " * 150), (3, "\n".join(["fire " * 20] * 50)), (4, "word " * 9), (5, None)],
     lambda df: QL.degenerate_lines(df, "i", "t"), "id bigint, line_no int, period int, repeats int", [(1, 1, 5, 200), (2, 1, 5, 150)])

_R = "paper_id string, seq bigint, sub int, kind string, level int, page_idx int, caption string, content string"


def _rows(*rows: tuple) -> list[tuple]:
    """Rows (kind, content[, page, caption, level]) of one paper in order."""
    return [("p", n, 0, r[0], r[4] if len(r) > 4 else 1, r[2] if len(r) > 2 else 0, r[3] if len(r) > 3 else None, r[1]) for n, r in enumerate(rows)]


_APA = ["Aa, B. (2001). X title.", "Wiley.", "Cc, D. (2002). Y title."]
case("case_entries", _R, [(f"{name}", n, 0, "reference", 0, 0, None, t) for name, texts in {
    "bracket": ["[1] A. Author, Title One, 2020.", "[2] B. Author, Title Two, 2021."], "several": ["[1] A. Author, T1. [2] B. Author, citing [5] here, T2. [3] C. Author, T3."],
    "dots": ["1. Dunn, B., Science 334, 928 (2011).", "2. Liu, J. et al., Adv. 23 (2013)."], "bare": ["1 J. Hwang, Rev., 2017.", "2 X. Xiang, Adv., 2015."], "page": ["1 A. Author, T, 2020, pp. 1–10. 390. VDI Verlag"],
    "goes on": ["[1] A. Author, Very Long Title That", "Wraps Onto Next Block, 2020."], "apa": _APA, "copy": ["[1] A. Author, Same Title, 2020."] * 2, "none": ["Entry without number."]}.items() for n, t in enumerate(texts)],
    RF.split_entries, "paper_id varchar, pos int, n int, raw varchar",
    [("bracket", 1, 1, "[1] A. Author, Title One, 2020."), ("bracket", 2, 2, "[2] B. Author, Title Two, 2021."), ("several", 1, 1, "[1] A. Author, T1."), ("several", 2, 2, "[2] B. Author, citing [5] here, T2."),
     ("several", 3, 3, "[3] C. Author, T3."), ("dots", 1, 1, "1. Dunn, B., Science 334, 928 (2011)."), ("dots", 2, 2, "2. Liu, J. et al., Adv. 23 (2013)."), ("bare", 1, 1, "1 J. Hwang, Rev., 2017."), ("bare", 2, 2, "2 X. Xiang, Adv., 2015."),
     ("page", 1, 1, "1 A. Author, T, 2020, pp. 1–10. 390. VDI Verlag"), ("goes on", 1, 1, "[1] A. Author, Very Long Title That Wraps Onto Next Block, 2020."), ("apa", 1, None, "Aa, B. (2001). X title. Wiley."),
     ("apa", 2, None, "Cc, D. (2002). Y title."), ("copy", 1, 1, "[1] A. Author, Same Title, 2020."), ("none", 1, None, "Entry without number.")])

_BODY = "We have also thoroughly tested the validity of this approximation for the range of parameters considered in the present work, finding agreement."
case("case_stray_paragraphs", _R, _rows(("paragraph", "Last."), ("heading", "References"), ("reference", _BODY), ("reference", "[1] A. Author, T., 2020."), ("reference", "[2] B. Author, U., 2021."), ("reference", _BODY)),
     HD.stray_paragraphs, "paper_id varchar, seq bigint, new_seq double", [("p", 2, 0.5)])
case("case_reference_heading", _R, _rows(("paragraph", "Text."), ("reference", "[1] A."), ("reference", "[2] B.")) + [("q", 0, 0, "heading", 1, 0, None, "References"), ("q", 1, 0, "reference", 0, 0, None, "[1] A.")],
     lambda df: BL.ensure_reference_heading(df).where("kind = 'heading'").select("paper_id", "seq", "sub", "content"), "paper_id varchar, seq bigint, sub int, content varchar", [("p", 1, -1, "References"), ("q", 0, 0, "References")])
case("case_rescued_headings", "paper_id string, page_idx int, text string", [("p", 3, "III. RESULTS"), ("p", 4, "III. RESULTS"), ("p", 5, "X. OTHER"), ("q", 1, "II. NOTHING")],
     lambda df: HD.rescue_headings(df.sparkSession.createDataFrame([("p", "I. INTRODUCTION"), ("p", "II. METHODS"), ("p", "IV. END"), ("q", "Intro")], "paper_id string, content string"), df),
     "paper_id varchar, missing int, content varchar, page_idx int", [("p", 3, "III. RESULTS", 3)])
case("case_fragments_merged", _R, _rows(("paragraph", "A sentence that goes on and"), ("paragraph", "ends here."), ("paragraph", "Another one."), ("heading", "H"), ("paragraph", "ending in of"), ("paragraph", "new page", 1)),
     lambda df: HD.merge_fragments(df).select("paper_id", "seq", "parts", "content"), "paper_id varchar, seq bigint, parts int, content varchar",
     [("p", 0, 2, "A sentence that goes on and ends here."), ("p", 2, 1, "Another one."), ("p", 4, 1, "ending in of"), ("p", 5, 1, "new page")])
_T1, _T2 = "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr></table>", "<table><tr><th>A</th><th>B</th></tr><tr><td>3</td><td>4</td></tr></table>"
case("case_tables_merged", _R, _rows(("table", _T1, 0, "Table 1. X"), ("table", _T2, 1, "Table 1 (continued)"), ("paragraph", "Prose of its own that is long enough to stand between two tables.", 1), ("table", _T2, 2, "")),
     lambda df: TB.merged(df), "paper_id varchar, seq bigint, parts int, content varchar",
     [("p", 0, 2, "<table><tr><th>A</th><th>B</th></tr><tr><td>1</td><td>2</td></tr><tr><td>3</td><td>4</td></tr></table>"), ("p", 3, 1, _T2)])
_SENTENCES = "The first sentence of a long cell stands here; it goes on. Then a second sentence follows, and a third one. " * 3
case("case_table_prose", "block_id bigint, type string, table_body string", [(1, "table", f"<table><tr><td>{_SENTENCES}</td><td colspan='2'>2.1 Methods</td><td>5</td></tr></table>"), (2, "table", _T1), (3, "text", None)],
     TB.rescued_cells, "block_id bigint, pos int, kind varchar, content varchar", [(1, 1, "paragraph", _SENTENCES.strip()), (1, 2, "heading", "2.1 Methods")])
case("case_anchors_kept", _R, _rows(("page_anchor", "0"), ("paragraph", "x"), ("page_anchor", "1", 1), ("page_anchor", "2", 2), ("paragraph", "y", 2)),
     lambda df: BL.tidy_anchors(df).where("kind = 'page_anchor'").select("content"), "content varchar", [("0",), ("2",)])
case("case_page_counts", "paper_id string, page_idx int", [("p", 0), ("p", 4), ("q", None)], BL.page_counts, "paper_id varchar, pages int", [("p", 5), ("q", 1)])
case("case_page_frames", "paper_id string, page int, text string", [("p", 0, "ab"), ("p", 1, "cd")], BL.page_frames, "paper_id varchar, page int, text varchar, split int", [("p", 0, "abcd", 2), ("p", 1, "cd", None)])
case("case_images_resolved", "paper_id string, img_path string", [("p", "images/a.png"), ("p", "images/b.png"), ("p", "https://x/a.png"), ("q", "a.png")],
     lambda df: BL.resolve_images(df, df.sparkSession.createDataFrame([("p", "out/a.png")], "paper_id string, path string")).select("paper_id", "img_path"), "paper_id varchar, img_path varchar", [("p", "images/a.png")])
case("case_image_names", "page int, n int", [(0, 1), (12, 34)], lambda df: df.select(ST.image_name(F.col("page"), F.col("n")).alias("name")), "name varchar", [("img_p000_01.png",), ("img_p012_34.png",)])
case("case_covers_arbitrated", "rule boolean, opinion boolean, confidence string", [(True, True, "low"), (True, False, "high"), (False, True, "high"), (False, True, "low"), (True, None, None)],
     lambda df: df.select("rule", "opinion", "confidence", PG.arbitrate(F.col("rule"), F.col("opinion"), F.col("confidence")).alias("cover")), "rule boolean, opinion boolean, confidence varchar, cover boolean",
     [(True, True, "low", True), (True, False, "high", False), (False, True, "high", True), (False, True, "low", False), (True, None, None, False)])
case("case_pages_incomplete", "paper_id string, markers int, pages int", [("p", 3, 10), ("q", 7, 10), ("r", 1, 2), ("s", 0, 9)], QL.page_completeness, "paper_id varchar, markers int, pages int", [("p", 3, 10)])
case("case_roman_gaps", "paper_id string, content string", [("p", "I. A"), ("p", "II. B"), ("p", "IV. D"), ("q", "I. A"), ("q", "III. C")], HD.roman_gaps, "paper_id varchar, missing int", [("p", 3)])

# ---- links

case("case_link_spans", "paper_id string, page int, ci int, x0 double, y0 double, x1 double, y1 double", [("p", 0, k, 10.0 * k, 5.0, 10.0 * k + 8, 15.0) for k in range(6)],
     lambda df: LK.span_in_rectangle(df, df.sparkSession.createDataFrame([(7, "p", 0, 19.0, 0.0, 40.0, 20.0), (8, "p", 1, 0.0, 0.0, 99.0, 99.0)], "link_id bigint, paper_id string, page int, x0 double, y0 double, x1 double, y1 double")),
     "link_id bigint, c0 int, c1 int", [(7, 2, 4)])
case("case_citation_clusters", "paper_id string, page int, x0 double, y0 double, x1 double, y1 double, text string",
     [("p", 0, 10.0, 5.0, 14.0, 15.0, "["), ("p", 0, 15.0, 5.0, 20.0, 15.0, "12"), ("p", 0, 21.0, 5.0, 24.0, 15.0, "–"), ("p", 0, 25.0, 5.0, 32.0, 15.0, "14]"), ("p", 0, 90.0, 5.0, 99.0, 15.0, "word"), ("p", 0, 10.0, 40.0, 20.0, 50.0, "[7]")],
     LK.citation_clusters, "paper_id varchar, page int, cluster bigint, text varchar, n int", [("p", 0, 1, "[12–14]", 4), ("p", 0, 3, "[7]", 1)])
case("case_alignments", "paper_id string, page int, page_text string", [("p", 0, "Header The quick brown fox jumps. Footer")],
     lambda df: LK.alignments(df, df.sparkSession.createDataFrame([(1, "p", 0, "The quick brown fox jumps."), (2, "p", 1, "other page")], "block_id bigint, paper_id string, page_idx int, text string")),
     "block_id bigint, p0 int, b0 int, size int", [(1, 7, 0, 26)])
case("case_spans_within", "paper_id string, page int, c0 int, c1 int", [("p", 0, 3, 5), ("p", 0, 8, 12)],
     lambda df: LK.spans_within(df, df.sparkSession.createDataFrame([("p", 0, 2, 9)], "paper_id string, page int, s0 int, s1 int")).select("paper_id", "c0", "c1"), "paper_id varchar, c0 int, c1 int", [("p", 3, 5)])
scalar("case_links_injected", text_udf(lambda t: LK.inject(t, [(4, 7, "#ref-1"), (9, 12, "#x")])), [("See [1], $ab$ end", "See [[1]](#ref-1), $ab$ end"), ("short", "short")])

# ---- XML records

_JATS = (
    '<article xmlns:xlink="x"><front><journal-meta><journal-title-group><journal-title>J. Made Up</journal-title></journal-title-group></journal-meta><article-meta>'
    '<article-id pub-id-type="doi">10.1234/abc</article-id><title-group><article-title>On <i>x</i></article-title></title-group><contrib-group>'
    '<contrib contrib-type="author"><name><surname>Bee</surname><given-names>Ann</given-names></name><aff>Uni A</aff></contrib><contrib contrib-type="author"><collab>X Group</collab></contrib>'
    '<contrib contrib-type="editor"><name><surname>Ed</surname></name></contrib></contrib-group><pub-date><day>5</day><month>1</month><year>2026</year></pub-date><volume>3</volume><fpage>101</fpage><lpage>118</lpage>'
    '<abstract abstract-type="graphical"><p>pic</p></abstract><abstract><p>Short abstract.</p></abstract><kwd-group><kwd>k1</kwd><kwd>k2</kwd></kwd-group></article-meta></front>'
    '<body><sec><title>Intro</title><p>See <xref ref-type="bibr" rid="B2">2</xref> and H<sub>2</sub>O.</p><sec><title>Deep</title><fig><label>Figure 1</label><caption><p>Cap.</p></caption><graphic xlink:href="g.png"/></fig>'
    '<table-wrap><label>Table 1</label><caption><p>T.</p></caption><table><tr><td>a</td></tr></table></table-wrap><disp-formula><label>(3)</label><tex-math>$a=b$</tex-math></disp-formula></sec></sec></body>'
    '<back><ref-list><ref><element-citation><person-group><name><surname>Cee</surname><given-names>D</given-names></name></person-group><article-title>T1</article-title><year>1999</year></element-citation></ref>'
    "<ref><mixed-citation>Plain text 2001.</mixed-citation></ref></ref-list></back></article>"
)
_DOCS = [(1, _JATS), (2, None), (3, ""), (4, "<a>"), (5, "<a/>")]
case("case_xml_metadata", "xml_id bigint, xml string", _DOCS,
     lambda df: XD.xml_metadata(df).select("xml_id", "title", F.array_join(F.transform("author", lambda a: F.concat_ws("/", a["name"], a["affiliation"])), "; ").alias("authors"), "date", "abstract", "doi", "container_title", "volume", "page", F.array_join("keywords", ";").alias("words")),
     "xml_id bigint, title varchar, authors varchar, date varchar, abstract varchar, doi varchar, container_title varchar, volume varchar, page varchar, words varchar",
     [(1, "On x", "Ann Bee/Uni A; X Group", "2026-01-05", "Short abstract.", "10.1234/abc", "J. Made Up", "3", "101-118", "k1;k2"), (5, "", "", None, None, None, None, None, None, "")])
case("case_xml_blocks", "xml_id bigint, xml string", _DOCS,
     lambda df: XD.xml_blocks(df).select("seq", "type", "text", "text_level", "img_path", F.array_join("image_caption", ";").alias("fig"), F.array_join("table_caption", ";").alias("tab")),
     "seq bigint, type varchar, text varchar, text_level int, img_path varchar, fig varchar, tab varchar",
     [(0, "text", "Intro", 1, None, None, None), (1, "text", "See [2](#ref-2) and H<sub>2</sub>O.", None, None, None, None), (2, "text", "Deep", 2, None, None, None), (3, "image", None, None, "g.png", "Figure 1. Cap.", None),
      (4, "table", None, None, None, None, "Table 1. T."), (5, "equation", "a=b \\tag{3}", None, None, None, None), (6, "text", "References", 1, None, None, None), (7, "ref_text", "[1] D Cee, T1, 1999", None, None, None, None),
      (8, "ref_text", "[2] Plain text 2001.", None, None, None, None)])
scalar("case_entities_guarded", text_udf(XD.guard_entities), [("&alpha; &amp; &lt;", "α &amp; &lt;"), ("&unknownname;", "unknownname"), ("plain", "plain")])
