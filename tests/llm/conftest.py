from __future__ import annotations

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("source", T.StringType()),
        # names that operators use for columns of their own
        T.StructField("id", T.StringType()),
        T.StructField("g", T.IntegerType()),
        T.StructField("n", T.StringType()),
        T.StructField("kept", T.StringType()),
        T.StructField("copy", T.StringType()),
        T.StructField("_source", T.StringType()),
    ]
)


@pytest.fixture
def frame(spark):
    """Documents from (id, text) pairs, with extra columns whose names clash."""

    def make(pairs, partitions=3):
        rows = [(i, t, f"s{(i or 0) % 3}" if i != 4 else None, "x", 7, "y", "z", "w", "v") for i, t in pairs]
        return spark.createDataFrame(rows, SCHEMA).repartition(partitions)

    return make


@pytest.fixture(scope="session")
def corpus():
    """Texts with every case: null, empty, blank, short, exact and near copies, a very long one, odd characters."""
    import random

    draw = random.Random(11)
    letters = "abcdefghijklmnopqrstuvwxyzéßñ"
    vocabulary = ["".join(draw.choice(letters) for _ in range(draw.randint(2, 8))) for _ in range(400)]

    def prose(n):
        return " ".join(draw.choice(vocabulary) for _ in range(n))

    base, shared = prose(200), prose(60)
    near = base.split()
    near[17] = "changed"
    far = base.split()
    far[20:120] = prose(100).split()
    texts = [
        None, "", "  \n\t ", "one", "two words", "One", base, base, base.upper(), " ".join(near), " ".join(far), prose(50) + " " + shared,
        prose(30) + "\n" + shared + "\n" + prose(5), shared, prose(6000), "   wide　spaces \x00 \x1c end", "ab" * 400,
        "ab" * 300 + " tail", "\n".join(["same line here"] * 5), "x" * 5000, "é" * 300, prose(40).upper(), prose(4),
    ]
    pairs = list(enumerate(texts))
    return pairs + [pairs[6], (None, base), (None, "nameless " + shared), (3, "one")]
