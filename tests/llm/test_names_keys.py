from paperloom.llm import names
from tests.llm.test_names_and_scans import CONTEXT, linked, pairs

FAMILIES = "Zelwanor Tiwano Momifel Kuheni Senwo Lomer Kurti Barofo Dulami Fegosa Hivaro Jokute".split()
FREQUENT = [f"Lena {f}" for f in FAMILIES] + [f"Elena {f}" for f in ("Pazuro", "Rikelo", "Sabunte", "Tolgavi")]


def test_frequent_names_within_one_edit_stay_apart(spark):
    own = ["Elena Viforsisu", "E. Viforsisu", "Viforsisu, E."]
    other = ["Lena Viforsisu", "L. Viforsisu"]
    got = linked(spark, own + other + FREQUENT + CONTEXT)
    assert {p for p in got if "Viforsisu" in p[0] and "Viforsisu" in p[1]} == pairs(*own) | pairs(*other)


def test_a_rare_spelling_meets_both_initials(spark):
    got = linked(spark, ["Elna Viforsisu", "E. Viforsisu", "Viforsisu, L.", "Lena Viforsisu"] + FREQUENT + CONTEXT)
    want = pairs("Elna Viforsisu", "E. Viforsisu") | pairs("Elna Viforsisu", "Viforsisu, L.", "Lena Viforsisu")
    assert {p for p in got if "Viforsisu" in p[0] and "Viforsisu" in p[1]} == want


def test_every_string_has_one_entity(spark):
    rows = names.entities(spark.createDataFrame([(n,) for n in ["Elna Viforsisu", "E. Viforsisu"] + FREQUENT], "name string")).collect()
    assert len(rows) == len({r.name for r in rows}) == 2 + len(FREQUENT)
