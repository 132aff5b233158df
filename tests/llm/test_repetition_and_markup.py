import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from paperloom.llm import markup, repetition


def slow_share(text, run=4):
    words, _ = repetition.words_and_lines(text)
    covered = set()
    for i in range(len(words) - run + 1):
        if any(words[j : j + run] == words[i : i + run] for j in range(i)):
            covered |= set(range(i, i + run))
    return len(covered) / len(words) if words else 0.0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.sampled_from(["a", "b", "c", "7", "\u4e2d"]), max_size=40))
def test_share_against_brute_force(words):
    text = " ".join(words)
    assert repetition.repeated_share(text)[1] == pytest.approx(slow_share(text))


def test_words():
    assert repetition.words_and_lines("Don't 3.5 and 7 \u4e2d\u6587 x_y")[0] == ["don", "t", "0", "and", "0", "\u4e2d", "\u6587", "x", "y"]


def test_viterbi_is_the_best_path():
    rng = np.random.default_rng(1)
    crf = repetition.Crf(rng.normal(size=(repetition.N_FEATURES, 2)), rng.normal(size=(2, 2)))
    x = rng.normal(size=(6, repetition.N_FEATURES))

    def score(y):
        return sum(x[i] @ crf.w[:, v] for i, v in enumerate(y)) + sum(crf.t[a, b] for a, b in zip(y, y[1:]))

    assert tuple(crf.viterbi(x)) == max(itertools.product((0, 1), repeat=6), key=score)


def test_found_is_exact_on_the_corpus(spark, medium):
    df = spark.read.parquet(f"{medium}/blocks.parquet")
    got = {r.id for r in repetition.degenerate(df).collect()}
    want = {r.block_id for r in df.collect() if (m := repetition.repeated_share(r.text))[0] >= 20 and m[1] >= 0.4}
    assert got == want and want


def test_repetition_edges(spark):
    text = "one two three four five six " * 5000
    rows = [(1, None), (2, ""), (3, "   "), (4, text), (4, text), (5, "a b c d " * 5), (6, "a b c d " * 4)]
    df = spark.createDataFrame([(i, t, 0.1) for i, t in rows], "block_id bigint, text string, words double")
    assert {r.id for r in repetition.degenerate(df).collect()} == {4, 5}
    assert repetition.degenerate(df.limit(0)).count() == 0
    assert repetition.shares(df.limit(0)).count() == 0


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<p>x</p>", {"html"}), ("a &alpha; b", {"html"}), ("&lt;b&gt;x", {"html"}), ("<TABLE border=1><TR>", {"html"}), ("p&lt;0.05", {"html"}),
        ("# Head", {"markdown"}), ("a **b** c", {"markdown"}), ("[x](#ref-1)", {"markdown"}), ("```\ncode\n```", {"markdown"}), ("`f(1)` x", {"markdown"}),
        ("x[^1]", {"markdown"}), ("| a | b |\n| --- | --- |\n| 1 | 2 |", {"markdown"}), ("> Quoted words", {"markdown"}), ("_x y_ z", {"markdown"}),
        ("'''x''' y", {"wiki"}), ("[[a|b]]", {"wiki"}), ("{{cite|x=1}}", {"wiki"}), ("== Head ==", {"wiki"}), ("{| class=x\n! a\n|}", {"wiki"}),
        (r"\emph{x}", {"latex"}), ("$x_1$", {"latex"}), ("$$a$$", {"latex"}), (r"\begin{tabular}{l}a\end{tabular}", {"latex"}), (r"~\cite{a}", {"latex"}), (r"\(x\)", {"latex"}),
        ("<td>$x^2$</td>", {"html", "latex"}), ("from $35 to $50 per kg", set()), ("5 * 3 * 2 = 30", set()), ("a < b and c > d", set()),
        (r"to C:\dir\raw_data.", set()), ("file a_b_v2 lists", set()), ("The # of samples", set()), ("Set {a, b} is", set()), ("see [14] and [2, 3]", set()),
        ("https://x.org/a_b_c", set()), ("- 371 -", set()), ("143 |", set()), ("p<0.05 (n > 34)", set()), ("3. Heading", set()), (None, set()), ("", set()),
    ],
)
def test_kinds(text, want):
    assert markup.kinds(text) == want


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("<h2>T</h2><ul><li>a</li><li>b</li></ul>", "## T\n\n- a\n\n- b"), ("<tr><td>a</td><td>b</td></tr>", "a | b"), ("&alpha;-x", "\u03b1-x"),
        ("**a** [b](#c)", "a b"), ("'''a''' [[b|c]] {{d|e=1}}", "a c"), (r"\section{T} \emph{a} $x$", "# T\na $x$"),
        (r"\begin{tabular}{ll}a & b \\ c & d\end{tabular}", "a | b\nc | d"), ("{| class=x\n! a !! b\n|-\n| c || d\n|}", "a | b\nc | d"),
        ("```\nx = 1\n```", "```\nx = 1\n```"), ("&lt;b&gt;x&lt;/b&gt;", "x"), (None, None), ("", ""),
    ],
)
def test_render(text, want):
    assert markup.render(text) == want


def blocks(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], "block_id bigint, paper_id string, text string, table_body string, host string")


def test_style_tree_drops_what_a_host_repeats(spark):
    nav = '<div class="nav">Home | About</div>'
    rows = [(i, "p", f"{nav}<p>Text number {i} of its own.</p>", None) for i in range(8)]
    got = {r.block_id: r.clean for r in markup.clean(blocks(spark, rows).drop("host")).collect()}
    assert got[3] == "Text number 3 of its own."
    few = {r.block_id: r.clean for r in markup.clean(blocks(spark, rows[:2]).drop("host")).collect()}
    assert "Home" in few[0]


def test_markup_edges(spark):
    deep = "<div>" * 3000 + "x" + "</div>" * 3000
    rows = [(1, None, "**a**", "<td>$x_1$</td>"), (1, None, "**a**", "<td>$x_1$</td>"), (2, "p", None, None), (3, "p", "", ""), (4, "p", deep, None), (None, "p", "**a**", None)]
    got = {tuple(r) for r in markup.found(blocks(spark, rows)).collect()}
    assert got == {(1, "text", "markdown"), (1, "table_body", "html"), (1, "table_body", "latex"), (4, "text", "html")}
    assert markup.found(blocks(spark, rows).limit(0)).count() == 0


def test_plain_texts_are_tidied_alike(spark):
    texts = ["a  b\n\n\n\nc ", " x　y \n z", "", " ", "one\r\ntwo", " a"]
    df = blocks(spark, [(i, "p", t, None) for i, t in enumerate(texts)]).drop("host")
    got = {r.block_id: r.clean for r in markup.clean(df).collect()}
    assert got == {i: markup.render(t) for i, t in enumerate(texts)}


def test_the_crf_decides_retention(spark, monkeypatch):
    text = "the same short unit of words comes again and again " * 8
    df = spark.createDataFrame([(1, text), (2, "every word of this line is another one, so nothing of it stands twice " + " ".join(f"w{chr(97 + k)}" for k in range(20)))], "block_id bigint, text string")
    assert {r.id for r in repetition.degenerate(df).collect()} == {1}
    weights = np.zeros((repetition.N_FEATURES, 2))
    weights[0, repetition.CONTENT] = 9.0  # always content: everything is retained
    crf = repetition.Crf(weights)
    assert not repetition.is_degenerate(text, crf)
    weights = weights[:, ::-1]
    assert repetition.is_degenerate(text, repetition.Crf(weights))


def test_the_crf_agrees_with_the_exact_measure_on_held_out_blocks(spark):
    texts = [r.text for r in spark.read.parquet("/root/testdata/sf0.1/blocks.parquet").select("text").where("length(text) >= 20").orderBy("text").distinct().collect()]
    crf = repetition.fit_on(texts[::4])
    right = found = true = 0
    for t in texts[1::4]:
        n, content, share = repetition.judge(t, crf)
        if n >= repetition.MIN_WORDS:
            found, true, right = found + (content <= 0.6), true + (share >= 0.4), right + (content <= 0.6 and share >= 0.4)
    assert true > 50 and right / true >= 0.97 and right / found >= 0.9


def test_shares_are_exact_beside_the_content_share(spark):
    df = spark.createDataFrame([(1, "one two three four five one two three four six seven eight")], "block_id bigint, text string")
    row = repetition.shares(df).first()
    assert row.words == 12 and row.repeated_share == 4 / 12


def test_marks_nest_to_any_depth_and_length():
    text = "**__~~*'''a [b](y.org/z) c'''*~~__**"
    assert markup.kinds(text) == {"markdown", "wiki"} and markup.render(text).replace("\n", " ").split() == ["a", "b", "c"]
    assert markup.kinds("x_{" + "a" * 500 + "}") == {"latex"} and markup.kinds("$^{" + "b " * 80 + "}$") == {"latex"}
    deep = "<div>" * 300 + "x" + "</div>" * 300
    assert len({n.path for n in markup.walk(markup.parse(deep)) if n.kind}) == 300
    escaped = "<b>x</b>"
    for _ in range(6):
        escaped = escaped.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
    assert markup.render(escaped) == "x"


def test_the_style_tree_of_a_site_removes_what_all_its_papers_repeat(spark):
    bar = '<div class="bar">Home | Search</div>'
    rows = [(k, f"p{k}", f"{bar}<p>Text number {k} of its own.</p><table><tr><th>Sample</th></tr></table>", None) for k in range(8)]
    rows.append((99, "p99", f"{bar}<p>Alone.</p>", None))
    df = spark.createDataFrame(rows, "block_id bigint, paper_id string, text string, table_body string")
    sites = spark.createDataFrame([(f"p{k}", "Journal of Tests") for k in range(8)] + [("p99", ""), (None, "x")], "paper_id string, site string")
    clean = lambda s: {r.block_id: r.clean for r in markup.clean(df, s).collect()}
    with_site, alone = clean(sites), clean(None)
    assert all("Search" not in with_site[k] and f"Text number {k}" in with_site[k] and "Sample" in with_site[k] for k in range(8))
    assert "Search" in with_site[99] and all("Search" in t for t in alone.values())


def test_statements_give_what_the_queries_give(spark, medium):
    from paperloom.llm.catalog import LLM
    from tests.oracle_check import connect, same

    con = connect(medium)
    assert LLM.sql and all(same(LLM.queries[n](spark, medium), con, sql) for n, sql in LLM.sql.items())
