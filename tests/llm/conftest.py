import random

import pytest

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, size int, rank int, id string, component string"


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choice("abcdefghiklmnoprstu") for _ in range(draw.randint(2, 8))) for _ in range(n))


@pytest.fixture(scope="session")
def texts() -> list:
    """(doc_id, text): nulls, empties, a very long text, copies, near copies, repeated rows, marks and other scripts."""
    base = prose(1, 120)
    near = base.split()
    near[60] = "other"
    rows = [(1, base), (2, base), (3, " ".join(near)), (4, None), (5, ""), (6, " \t\n"), (7, prose(2, 40_000)), (8, prose(3, 90)), (8, prose(3, 90)), (None, prose(4, 50)), (None, base), (9, "Ünï 漢字 😀 ▁ end"), (10, "one two three"), (11, "ONE two  three")]
    return [*rows, *((20 + i, prose(100 + i, 80)) for i in range(20))]


@pytest.fixture(scope="session")
def docs(spark, texts):
    rows = [(i, t, None if i == 8 else "en", None if i == 20 else f"s{(i or 0) % 3}", None if t is None else len(t), 7, 1, "x", "y") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(20 + i, int(i % 3 > 0), int(i % 4 == 0)) for i in range(20)] + [(None, 1, 1), (1, None, None)]
    return spark.createDataFrame(rows, "doc_id bigint, quality int, toxic int")
