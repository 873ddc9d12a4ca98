import random

import pytest

WORDS = "the of and to in that is was for on are with as his they at be this from have or one had by".split()


@pytest.fixture(scope="session")
def tricky(spark):
    """Documents with every odd case and with columns whose names clash with the operators' own."""
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(WORDS) + rng.choice(["", "x", "Y", "é"]) for _ in range(n))
    base = text(60)
    rows = [
        (1, base), (2, base), (2, base), (3, base + " Tail"), (4, base.upper()), (5, None), (6, ""), (7, "  \n\t"),
        (8, "one two"), (9, "one two"), (10, text(20_000)), (11, text(15) + " " + base[:150]), (None, base),
        (None, None), (13, "漢字 \U0001F600 ſ \x1c \x85 x"), (14, "x" * 5000), (15, " " * 3000 + "y"), (16, "!?;"),
        *((20 + i, text(30) + "\n" + base) for i in range(6)), *((40 + i, text(40)) for i in range(10)),
    ]
    cols = ["fp", "_id", "_hash", "words", "gram", "_n_words", "_hits", "_lang_pred", "_score", "c0", "label"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{c} int" for c in cols)
    full = [(d, t, "en" if (d or 0) % 2 else "fr", "s", len(t or ""), *range(len(cols))) for d, t in rows]
    return rows, spark.createDataFrame(full, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")


def by_row(found, *cols):
    """Result rows as a sorted list of tuples (ids may repeat or be null)."""
    return sorted(map(tuple, found.select(*cols).collect()), key=repr)
