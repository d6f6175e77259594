import random

import pytest

from starloom.llm.runtime import prepare

WORDS = "the river of stone and light runs by old green hills while seven birds watch a quiet town in late autumn rain".split()


@pytest.fixture(scope="session")
def llm(spark):
    return prepare(spark)


def prose(seed: int, n: int) -> str:
    r = random.Random(seed)
    return " ".join(r.choice(WORDS) + str(r.randrange(40)) for _ in range(n))


@pytest.fixture(scope="session")
def awkward():
    """(doc_id, text) rows: nulls, blanks, copies, near copies, shared passages, runs, a very long text."""
    base, other, passage = prose(1, 120), prose(2, 90), prose(3, 30)
    near = base.split()
    near[60] = "changed"
    rows = [
        (1, base), (2, base), (2, base), (3, " ".join(near)), (4, other), (5, None), (6, ""), (7, " \n\t "), (8, "one two"),
        (9, "one two"), (10, prose(4, 20) + " " + passage + "\n" + prose(5, 20)), (11, prose(6, 15) + "  " + passage + " end."),
        (12, "a " * 60), (13, "b " + "a " * 40 + "c"), (14, "x y " * 30), (15, "y " + "x y " * 20), (16, prose(7, 30_000)),
        (17, "Éa ñ ß 漢字   tail"), (18, prose(4, 20)), (19, "w" * 5000), (20, base.upper()), (21, " ".join(prose(4, 20).split()[2:])),
    ]
    return rows + [(100 + i, " ".join(base.split()[:100] + [f"n{i}"] + base.split()[101:])) for i in range(12)]


#: Columns whose names the operators use inside; values of no meaning.
CLASHES = ["head", "component", "class_id", "page", "label", "n", "size", "text_", "ids", "fingerprint", "part", "bits", "score", "u", "v"]


@pytest.fixture(scope="session")
def awkward_docs(llm, awkward):
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} string" for c in CLASHES)
    langs = ["en", None, "de"]
    return llm.createDataFrame([(i, t, langs[i % 3], "s", 7, *["x"] * len(CLASHES)) for i, t in awkward], schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(awkward_docs):
    return awkward_docs.limit(0)
