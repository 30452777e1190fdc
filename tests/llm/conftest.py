import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())])


@pytest.fixture
def documents(spark):
    """Makes a table from texts; ids count from 0 unless pairs are given."""

    def make(texts, parts=3):
        rows = [(t if isinstance(t, tuple) else (k, t)) for k, t in enumerate(texts)]
        return spark.createDataFrame([(i, t, "en", "src0", len(t or "")) for i, t in rows], SCHEMA).repartition(parts)

    return make


def prose(seed, words=60, vocabulary=4000):
    r = random.Random(seed)
    return " ".join(f"w{r.randrange(vocabulary)}" for _ in range(words))


@pytest.fixture
def corpus():
    """Texts with copies, near copies, shared passages, empty, null and very long ones."""
    r = random.Random(11)
    base = [prose(k, r.choice([3, 20, 60, 200])) for k in range(40)]
    passage = prose(999, 40)
    near = []
    for k in range(25):
        words = prose(500, 120).split()
        for _ in range(k % 4):
            words[r.randrange(len(words))] = f"x{r.randrange(99)}"
        near.append(" ".join(words))
    chain = prose(600, 60).split()
    steps = []
    for k in range(8):
        chain[5 * k % 55] = f"y{k}"
        steps.append(" ".join(chain))
    return [*base, *base[:10], *near, *steps, *(f"{prose(700 + k, 30)}\n{passage}\n{prose(800 + k, 5)}" for k in range(6)), "", None, "  \n ", "one", "One", "é ü\nß 漢字 " * 30, prose(1000, 6000), "a" * 400, "a" * 250]
