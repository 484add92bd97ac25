import random

import pytest

WORDS = "the of and river stone bright under walking quickly green house seven letters paper window cold".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "s", "ed", "er", str(rng.randrange(50))]) for _ in range(n))


def odd_rows():
    """(doc_id, text, lang, source): nulls, empty and long texts, ties, repeated rows."""
    base = prose(1, 120)
    near = base.replace(base.split()[60], "changed", 1)
    long = prose(2, 30_000)
    return [
        (1, base, "en", "a"),
        (2, base.replace(" ", "\n"), "en", "a"),
        (3, base + " ", "en", "b"),
        (3, base + " ", "en", "b"),
        (4, near, "en", None),
        (5, None, "en", "a"),
        (6, "", None, "b"),
        (7, " \t\n", "de", "b"),
        (8, "two words", "de", "c"),
        (9, long, "de", "c"),
        (10, long + " end", "de", None),
        (11, "123 456 ???", "en", "a"),
        (12, prose(3, 80), None, "a"),
        (13, "x" * 5000, "fr", "d"),
        (None, prose(4, 50), "en", "a"),
        (None, None, None, None),
    ]


#: Names that operators use inside.
CLASHES = ["row", "size", "n", "hash", "w", "i", "rows", "kept", "h", "shard", "run", "sha", "set", "all", "copies", "skey", "score", "doc", "id"]


@pytest.fixture(scope="session")
def odd_docs(spark):
    rows = [(*r, *[k for k in range(len(CLASHES))]) for r in odd_rows()]
    schema = "doc_id long, text string, lang string, source string, " + ", ".join(f"`{c}` int" for c in CLASHES)
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.filter("doc_id = -1")
