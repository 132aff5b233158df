import itertools

import pytest
from paperloom.llm import names, scan_furniture, scan_words, scans


def linked(spark, strings):
    df = spark.createDataFrame([(s, "x") for s in strings], "name string, block string")
    return {tuple(r) for r in names.linked(df).collect()}


def pairs(*group):
    return {tuple(sorted(p)) for p in itertools.combinations(group, 2)}


CONTEXT = ["Kurt Lomer", "Lomer, Kurt", "K. Lomer", "Ida Senwo", "Senwo, Ida", "Anna Kurti", "Kurti, Anna", "Kurt Senwo", "Ida Kurti"]


def test_forms_of_one_person(spark):
    own = ["Catherine M. van Zelwanor", "van Zelwanor, C. M.", "ZELWANOR, Catherine", "Zelwanor CM", "C. Zelwanor", "Cathy Zelwanor", "Catherine Zelwanro", "Zelw\u00e4nor, Catherine", "Zelwaenor, C."]
    got = linked(spark, own + CONTEXT)
    assert {p for p in got if "elw" in (p[0] + p[1]).lower()} == pairs(*own)


def test_groups_and_no_names(spark):
    got = linked(spark, ["TIWANO Collaboration", "The TIWANO Collaboration", "Collaboration TIWANO", "TIWANO Collab.", "KUHENI Collaboration", "et al.", "", " ", None, "Et Al"])
    assert got == pairs("TIWANO Collaboration", "The TIWANO Collaboration", "Collaboration TIWANO", "TIWANO Collab.")


def test_different_people_stay_apart(spark):
    got = linked(spark, ["Karin Zelwanor", "Albert Zelwanor", "Zelwanor, K.", "A. B. Zelwanor", "A. C. Zelwanor", "Karin Momifel"])
    assert ("Karin Zelwanor", "Zelwanor, K.") in got
    assert not {p for p in got if {"A. B. Zelwanor", "A. C. Zelwanor"} == set(p)} and not {p for p in got if "Karin Momifel" in p}


def test_empty_and_copies(spark):
    df = spark.createDataFrame([], "name string")
    assert names.linked(df).count() == 0
    assert linked(spark, ["A. Zelwanor"] * 50) == set()
    assert linked(spark, ["A" * 5000 + " Bee", "x"]) == set()


@pytest.mark.parametrize(
    ("a", "b", "want"),
    [("abcde", "abcde", True), ("abcde", "abxde", True), ("abcde", "abde", True), ("abcde", "abdce", True), ("abcde", "edcba", False), ("abcde", "abxxe", False), ("", "a", True)],
)
def test_one_edit(a, b, want):
    assert names.within_one_edit(a, b) is want and names.within_one_edit(b, a) is want


def test_assignment_is_optimal():
    assert names.assign(["a", "bob"], ["bob", "anna"]) is not None
    assert names.assign(["a"], ["bob"]) is None
    assert names.same(["anna", "b"], ["a"]) and not names.same(["anna", "b"], ["anna", "c"])


BLOCKS = "block_id bigint, paper_id string, seq bigint, type string, text string, page_idx int, bbox array<double>, kind string"


def test_scan_noise_on_a_small_paper(spark):
    words = "the measured viscosity of every sample increased because our furnace controlled this boundary while the detector remained stable".split()
    rows, k = [], 0

    def add(kind, text, page):
        nonlocal k
        k += 1
        rows.append((k, "p", k, kind, text, page, None, "clash"))
        return k

    for page in range(30):
        add("header", f"J. of Tests 4 (2001)  {100 + page}", page)
        add("text", " ".join(words[page % 7 :] + words[: page % 7]).capitalize() + ". A low-frequency sample, a near-surface detector.", page)
        add("page_number", str(100 + page), page)
    hyphen = add("text", "The visco-\nsity increased because our furn\u00ac\nace controlled this boundary.", 3)
    compound = add("text", "The low-\nfrequency detector remained stable; pre- and post-test.", 3)
    chars = add("text", "The meas1ired v1scosity of evcry sample increascd.", 4)
    clean = add("text", "The measured viscosity of every sample increased.", 4)
    running = add("text", "J. of Tests 4 (2001)", 5)
    inside = add("text", "The detector remained\nJ. of Tests 4 (2001)  105 stable because our furnace controlled this.", 5)
    number = add("text", "- 106 -", 6)
    equation = add("text", "(8)", 6)
    body = add("footer", "The measured viscosity increased. Every sample remained stable because our furnace controlled it. The detector increased.", 7)
    add("text", None, 7)
    add("text", "", 7)
    df = spark.createDataFrame(rows, BLOCKS)
    got = {tuple(r) for r in scans.found(df).collect()}
    assert got == {(hyphen, "hyphen"), (chars, "chars"), (running, "running"), (inside, "running"), (number, "page_no"), (body, "body")}
    assert compound and clean and equation
    fixed = {r.block_id: r for r in scans.repaired(df).collect()}
    assert fixed[hyphen].clean == "The viscosity increased because our furnace controlled this boundary."
    assert fixed[running].clean == "" and fixed[running].type == "header" and fixed[number].type == "page_number" and fixed[body].type == "text"
    assert "Tests" not in fixed[inside].clean
    assert scans.found(df.limit(0)).count() == 0


def test_perceptron_learns_and_averages():
    data = [(["bias", f"x={i % 2}"], i % 2 == 0) for i in range(40)]
    p = scan_words.Perceptron().fit(data)
    assert all((p.score(f) > 0) == gold for f, gold in data)


@pytest.mark.parametrize(("text", "want"), [("p. 365", 365), ("\u00b7 486 \u00b7", 486), ("797 |", 797), ("- 12 -", 12), ("Page 7", 7), ("(8)", None), ("12 kg", None), (None, None), ("", None)])
def test_page_numbers(text, want):
    assert scan_furniture.page_number(text) == want
