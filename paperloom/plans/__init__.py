"""Plans: registered queries built from the operators."""


def all_registries() -> list:
    """The registries of the core, in a fixed order."""
    from paperloom.plans import statements  # noqa: F401  adds SQL to the registries
    from paperloom.plans.cases import CASES
    from paperloom.plans.corpus import CORPUS
    from paperloom.plans.general import GENERAL
    from paperloom.plans.pipeline import PIPELINE
    from paperloom.plans.relational import RELATIONAL

    return [GENERAL, CORPUS, PIPELINE, RELATIONAL, CASES]
