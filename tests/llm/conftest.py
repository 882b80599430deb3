import random

import pytest

#: Columns whose names the operators use themselves.
CLASH = ["key", "h", "fp", "bucket", "batch", "part", "_text", "spans", "n", "k", "row"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"`{c}` string" for c in CLASH)


def prose(rng, n):
    letters = "etaoinshrdlucmfwygpbvk"
    pool = ["".join(rng.choice(letters) for _ in range(rng.randint(2, 9))) for _ in range(300)]
    return " ".join(rng.choice(pool) for _ in range(n))


@pytest.fixture(scope="session")
def edge_rows():
    """Nulls in every column, empty and long texts, ties and repeated rows."""
    rng = random.Random(4)
    long = prose(rng, 40_000)
    same = prose(rng, 120)
    texts = [
        (1, None), (2, ""), (3, " \n\t "), (4, long), (5, same), (5, same), (6, same), (None, same), (None, None),
        (7, "x" * 50_000), (8, "mail me at bo.b@ex-am.example.com or 4111111111111111 or +1 (234) 555-1234 now"), (9, "one two"),
        (10, "  lead and  trail  "), (11, "日本語 😀 é naïve \x1c\x85  <|endoftext|> end"), (12, prose(rng, 80)), (12, prose(rng, 80)),
    ]
    return [(d, t, None, None, None, *CLASH) for d, t in texts]


@pytest.fixture(scope="session")
def edge_docs(spark, edge_rows):
    return spark.createDataFrame(edge_rows, SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
