import random

import pytest
from pyspark.sql import types as T

SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                       T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                       # Names that operators use for themselves.
                       *[T.StructField(c, T.StringType()) for c in ("key", "rank", "size", "fp", "row", "copies", "own", "g")]])
SF = "/root/testdata/sf0.001"


def rows_of(pairs):
    """Rows of (doc_id, text[, source]) with the other columns filled in."""
    return [(p[0], p[1], "en", p[2] if len(p) > 2 else "s", None if p[1] is None else len(p[1]), *["x"] * 8) for p in pairs]


def odd_texts():
    """Nulls, empty and blank texts, repeated rows and keys, ties, signs beyond the basic plane, one very long text."""
    rnd = random.Random(7)
    say = lambda n: " ".join(rnd.choice(["alpha", "beta", "Gamma", "delta", "É", "übung", "x1", "#", "日本", "😀"]) + str(rnd.randrange(30)) for _ in range(n))
    passage, base = say(70), say(160)
    pairs = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "two words"), (6, base), (7, base), (7, base), (8, base + " end"), (9, say(30) + " " + passage + " " + say(30)),
             (10, passage), (None, passage), (None, None), (11, say(12) + "\n" + passage), (12, say(49)), (13, say(50)), (14, ("loop loop " * 60).strip()), (15, "z" * 3000),
             (16, say(20000)), (17, "a@b.co 1.2.3.4 +1 (555) 010-9999 4111 1111 1111 1111"), (18, "\u0000 ퟿ <|endoftext|>　x")]
    return [(*p, ["s", "t", None][i % 3]) for i, p in enumerate(pairs)]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame(rows_of(odd_texts()), SCHEMA)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")
