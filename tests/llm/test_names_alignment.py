import itertools
import random

from paperloom.llm import names
from tests.llm.test_names_and_scans import CONTEXT, linked, pairs


def test_least_assignment_is_the_best_of_all():
    rng = random.Random(3)
    for _ in range(200):
        n, m = rng.randint(1, 4), rng.randint(4, 6)
        costs = [[rng.choice((0.0, 0.2, 0.4, 1e6)) + 0.05 * rng.randint(0, 3) for _ in range(m)] for _ in range(n)]
        best = min(sum(costs[i][k] for i, k in enumerate(p)) for p in itertools.permutations(range(m), n))
        assert abs(names.least_assignment(costs) - best) < 1e-6


def test_long_lists_are_assigned_in_any_order():
    long = "anna berta carla doris emma frieda gerda hanna".split()
    swapped = [long[1], long[0], *long[2:]]
    assert abs(names.assign(long, swapped) - 0.1) < 1e-9
    assert names.assign(long[:2], long[::-1]) is not None and names.assign(["zoe"], long) is None


def test_the_alignment_accepts_and_rejects_within_a_family(spark):
    john, jane = ["John Tolvamesu", "Tolvamesu, John"], ["Jane Tolvamesu", "JANE TOLVAMESU"]
    df = spark.createDataFrame([(n,) for n in john + jane + CONTEXT], "name string")
    assert names.blocks(df).where("block = 'tolvamesu'").count() == 4  # all four are compared
    got = linked(spark, john + jane + CONTEXT)
    assert {p for p in got if "TOLV" in p[0].upper()} == pairs(*john) | pairs(*jane)


def test_initials_that_look_like_particles(spark):
    own = ["Belrabusi LE", "Lena E. Belrabusi", "Belrabusi, L.E."]
    assert {p for p in linked(spark, own + ["Felix Belrabusi"] + CONTEXT) if "Belrabusi" in p[0]} == pairs(*own)
    assert names.parse("DE BADORMOPI, Johanna")[1] == ["johanna", "badormopi"]


def test_entities_follow_links_and_leave_doubtful_initials_alone(spark):
    strings = ["John Tolvamesu", "Tolvamesu, John", "Jane Tolvamesu", "J. Tolvamesu", "Karl Rimonesu", "K. Rimonesu", "Rimonesu", None, "", "Rimonesu"]
    df = spark.createDataFrame([(s, 1) for s in strings + CONTEXT], "name string, entity int")
    got = {r.name: (r.entity, r.links) for r in names.entities(df).collect()}
    assert got["John Tolvamesu"][0] == got["Tolvamesu, John"][0] != got["Jane Tolvamesu"][0]
    assert got["J. Tolvamesu"] == ("J. Tolvamesu", 3)
    assert got["K. Rimonesu"][0] == got["Karl Rimonesu"][0] and got["Rimonesu"] == ("Rimonesu", 0)
    assert names.entities(df.limit(0)).count() == 0
