import random
from itertools import product

from paperloom.llm import scan_furniture, scan_words, scans


def decided(spark, counts, tokens=()):
    lex = spark.createDataFrame(sorted(counts.items()), "word string, n bigint")
    asked = spark.createDataFrame(sorted((counts | dict.fromkeys(tokens, 0)).items()), "word string, n bigint")
    known = sorted((w, n) for w, n in counts.items() if len(w) >= 4 and n >= 3)
    rng = random.Random(5)
    vowels, others = "aeiou", "bcdfglmnprstvhw"
    more = [("".join(rng.choice(others) + rng.choice(vowels) for _ in range(rng.randint(2, 5))), rng.choice((20, 200, 2000))) for _ in range(1500)]
    misread = scan_words.train_misread(known + more, max(counts.values()), [])
    return {r.word: r.fix for r in scan_words.misread_words(asked, lex, misread, max(counts.values())).collect()}


def test_words_of_many_places_get_two_edits(spark):
    counts = {"the": 50_000, "corrected": 900, "reproducible": 700, "concentration": 800}
    got = decided(spark, counts, ["corrcctecl", "rcproclucible", "c0ncentrati0n", "unheardof"])
    assert got == {"corrcctecl": "corrected", "rcproclucible": "reproducible", "c0ncentrati0n": "concentration"}
    assert scan_words.Reader(got, set()).misreads("the corrcctecl rcproclucible") == 2


def test_a_token_is_unknown_in_proportion(spark):
    counts = {"the": 5_000_000, "corrected": 90_000, "corrcctecl": 30}
    assert decided(spark, counts) == {"corrcctecl": "corrected"}
    assert decided(spark, counts | {"corrcctecl": 30_000}) == {}


def test_strange_tokens_and_codes(spark):
    got = decided(spark, {"the": 50_000, "viscosity": 2, "p53x": 900}, ["mea5ur1ng", "x1y", "a0b1c"])
    assert got == {"mea5ur1ng": ""}


def test_key_is_shared_by_all_confusions():
    for (a, b), left, right in product(scan_words.CONFUSIONS, ("", "r", "rr", "l", "n", "i"), ("", "l", "n", "ii")):
        assert scan_words.confusion_key(left + a + right) == scan_words.confusion_key(left + b + right)


def test_edits_are_the_fewest_as_by_trying_all():
    def once(w):
        for wrong, right in scan_words.CONFUSIONS:
            at = w.find(wrong)
            while at >= 0:
                yield w[:at] + right + w[at + len(wrong) :]
                at = w.find(wrong, at + 1)

    for w in ("modcl", "clcan", "iiirn", "rnoclel"):
        one = set(once(w)) - {w}
        two = {y for x in one for y in once(x)} - one - {w}
        assert all(len(scan_words.edits(w, o)) == 1 for o in one)
        assert all((e := scan_words.edits(w, o)) is None or len(e) == 2 for o in two) and scan_words.edits(w, w) == []
        assert all(scan_words.edits(w, o + "x") is None for o in one | two)


def test_decisions_by_joins_are_those_that_are_shared(spark, small, monkeypatch):
    df = spark.read.parquet(f"{small}/blocks.parquet")
    shared = {tuple(r) for r in scans.found(df).collect()}
    monkeypatch.setattr(scan_words, "SHARED_ROWS", -1)
    assert {tuple(r) for r in scans.found(df).collect()} == shared


def test_the_perceptrons_decide(spark, small, monkeypatch):
    df = spark.read.parquet(f"{small}/blocks.parquet")

    def kinds():
        return {r.kind: r["count"] for r in scans.found(df).groupBy("kind").count().collect()}

    own = kinds()
    with monkeypatch.context() as m:
        m.setattr(scan_words, "train_misread", lambda *a: scan_words.Perceptron({"pair": 1.0}))
        assert kinds()["chars"] > own["chars"]
        m.setattr(scan_words, "train_misread", lambda *a: scan_words.Perceptron({"pair": -1.0}))
        assert "chars" not in kinds()
    with monkeypatch.context() as m:
        m.setattr(scans, "train_furniture", lambda rows: scan_words.Perceptron({"number": -1.0, "line": -1.0, "typed": -1.0}))
        got = kinds()
        assert "page_no" not in got and "running" not in got and got["body"] > own.get("body", 0)


def test_a_cited_line_of_any_length_is_no_furniture():
    line = "the long title of a volume that nobody can print in a single line of a page " * 3
    rows = [{"type": "header", "text": line, "lines": [scan_furniture.running_line(line)], "offset": 1, "page_idx": k, "seq": k, "top": 20.0} for k in range(40)]
    p = scan_furniture.train(rows)
    held = rows[0]["lines"]

    def found(kind, text):
        return scan_furniture.furniture_kinds(kind, 3, text, 400.0, held, 1, False, p)

    assert found("text", line) == ["running"] and found("text", "Some prose that\n" + line + " goes on here.") == ["running"]
    assert found("ref_text", "A. Bee, On samples, " + line + " 4 (2001).") == []
