from paperloom.llm import scan_words, scans

from tests.llm.test_names_and_scans import BLOCKS


def test_repair_follows_the_kinds_that_are_found(spark, monkeypatch):
    words = "the measured viscosity of every sample increased because our furnace controlled this boundary".split()
    rows = []

    def add(kind, text, page):
        rows.append((len(rows) + 1, "p", len(rows) + 1, kind, text, page, None, "clash"))
        return len(rows)

    for page in range(30):
        add("header", f"J. of Tests 4 (2001)  {100 + page}", page)
        add("text", " ".join(words[page % 7 :] + words[: page % 7]).capitalize() + ".", page)
        add("page_number", str(100 + page), page)
    after_comma = add("text", "The sample increased,\nJ. of Tests 4 (2001)  105 because our furnace controlled this.", 5)
    cited = add("ref_text", "A. Bee, On samples, J. of Tests 4 (2001) 17.", 6)
    number = add("text", "106", 6)
    df = spark.createDataFrame(rows, BLOCKS)

    def both():
        return {tuple(r) for r in scans.found(df).collect()}, {r.block_id: r for r in scans.repaired(df).collect()}

    found, fixed = both()
    assert found >= {(after_comma, "running"), (number, "page_no")} and (cited, "running") not in found
    assert "Tests" not in fixed[after_comma].clean and "Tests" in fixed[cited].clean
    assert (fixed[number].type, fixed[number].clean) == ("page_number", "")
    # where the perceptron rejects the form, nothing is reported and nothing is deleted
    monkeypatch.setattr(scans, "train_furniture", lambda rows: scan_words.Perceptron({"number": -1.0}))
    found, fixed = both()
    assert (number, "page_no") not in found
    assert (fixed[number].type, fixed[number].clean) == ("text", "106")


def test_paragraphs_go_on_over_pages_and_furniture(spark):
    rows = []

    def add(kind, text, page, level=0):
        rows.append((len(rows) + 1, "p", len(rows) + 1, kind, text, page, None, level))
        return len(rows)

    add("text", "Results", 0, 1)
    first = add("text", "The sample was heated slowly and", 0)
    add("page_number", "1", 0)
    add("header", "Journal of Tests", 1)
    add("text", "cooled again.", 1)
    last = add("text", "Another sample was not.", 1)
    for k in range(2, 6):
        add("page_number", str(k), k - 1)
    rows.append((99, "p", 2, "text", "The sample was heated slowly and", 0, None, 0))  # delivered twice
    rows.append((100, None, 1, "text", "lost and", 0, None, 0))
    df = spark.createDataFrame(rows, "block_id bigint, paper_id string, seq bigint, type string, text string, page_idx int, bbox array<double>, text_level int")
    got = {r.block_id: (r.parts, r.text) for r in scans.paragraphs(df).collect()}
    assert got[first] == (2, "The sample was heated slowly and cooled again.") and got[last] == (1, "Another sample was not.")
    assert len(got) == 3 and scans.paragraphs(df.limit(0)).count() == 0
