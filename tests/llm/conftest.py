import random

import pytest
from pyspark.sql import types as T

from byteloom.llm import common

DOCS = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves.
        *(T.StructField(c, T.StringType()) for c in ("shard", "slot", "body", "row", "key", "copies", "id", "node")),
    ]
)


def words(rng, n):
    return " ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 7))) for _ in range(n))


@pytest.fixture(scope="session")
def texts():
    """(doc_id, text): copies, near copies, repeated rows, NULLs, empty and long texts."""
    rng = random.Random(4)
    out = [(i, words(rng, rng.randint(1, 200))) for i in range(60)]
    long = words(rng, 4000)
    passage = words(rng, 120)
    out += [(100, long), (101, long), (102, long[:9000] + " changed " + long[9000:])]
    out += [(110 + i, words(rng, 30) + " " + passage + " " + words(rng, 30)) for i in range(12)]
    near = words(rng, 300).split()
    for i in range(20):
        edited = list(near)
        edited[rng.randrange(300)] = f"edit{i}"
        out.append((140 + i, " ".join(edited)))
    out += [(200, None), (201, ""), (202, " \t\n "), (203, "ONE two"), (204, "one TWO"), (205, "a" * 3000), (206, "ab" * 900)]
    out += [(7, out[7][1]), (7, out[7][1]), (None, "no id here"), (None, out[8][1]), (-5, out[9][1]), (2**62, "x y z")]
    return out


@pytest.fixture(scope="session")
def docs(spark, texts):
    common.share_package(spark)
    rng = random.Random(9)
    rows = [
        (i, t, None, rng.choice(["s0", "s0", "s0", "s1", "s2", None]), None if t is None else len(t), *["clash"] * 8)
        for i, t in texts
    ]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="session")
def no_docs(spark, docs):
    return spark.createDataFrame([], docs.schema)
