import random

import pytest

SCHEMA = "doc_id long, text string, rule string, kept string, key long, chunk string, n_words string"


def prose(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.fixture(scope="session")
def rows():
    """(id, text): nulls, empty and long texts, exact and near copies, shared passages, repeated rows."""
    rng = random.Random(3)
    base, passage = prose(rng, 120), prose(rng, 60)
    out = [(5, None), (6, ""), (7, " \n\t "), (8, "one two three"), (9, "one two three"), (10, "é" * 80), (11, "é" * 90)]
    out += [(20, " ".join(base)), (21, " ".join(base)), (22, "  ".join(base) + "\n")]
    for k in range(23, 40):
        near = list(base)
        near[rng.randrange(120)] = f"x{k}"
        out.append((k, " ".join(near)))
    for k in range(40, 46):
        out.append((k, " ".join(prose(rng, 50) + passage + prose(rng, 40))))
    out += [(46, " ".join(passage + prose(rng, 30) + passage)), (47, "again and again " * 200)]
    out += [(48, " ".join(prose(rng, 30_000, 5000))), (49, "a" * 30_000), (50, " ".join(prose(rng, 300)) + " 😀 Straße ΣΑΣ")]
    out += [(51, "Line one here\nLine one here\n\nother ### line\nLine one here"), (51, "Line one here\nLine one here\n\nother ### line\nLine one here")]
    out += [(None, " ".join(base)), (None, " ".join(passage))]
    return out


@pytest.fixture(scope="session")
def docs(spark, rows):
    return spark.createDataFrame([(i, t, "r", "k", 1, "c", "n") for i, t in rows], SCHEMA).repartition(3).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
