import os
import random
import sys

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
# The columns of documents and some whose names the operators use inside.
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in ("shard", "bucket", "print", "size", "__id", "copies", "ids", "row", "bound", "whole", "with_bound", "__row_key", "blob", "words", "runs")],
])


def make(spark, rows):
    return spark.createDataFrame([(*r, None if r[1] is None else len(r[1]), *["x"] * 15) for r in rows], SCHEMA)


def odd_rows():
    """Nulls, empty, white, very long, repeated, near and exact copies, odd characters."""
    rng = random.Random(5)
    word = ["alpha", "beta", "Gamma", "delta", "épsilon", "zeta,", "eta.", "theta", "iota", "<|endoftext|>", "日本語", "naïve", "don't"]
    words = [rng.choice(word) + str(rng.randrange(60)) for _ in range(400)]
    base = " ".join(words)
    changed = " ".join(w if i % 97 else "other" for i, w in enumerate(words))
    half = " ".join(words[:200] + [f"new{i}" for i in range(200)])
    texts = [
        None, "", "  \n\t ", base, base, base.replace(" ", "\n"), changed, half, base.upper(), "one two", "One  Two", "three",
        "a  b  c d  <|endoftext|>  e\x1cf 　g", "x" * 3000, "ab " * 2000, " ".join(rng.choice(word) for _ in range(30000)),
        "\x00\x01 ퟿\U0001f600 é", "idiot " * 20, "12 34 !!", base[:200], base[100:260],
    ]
    sources = ["src0", "src1", None, "Z", "z"]
    langs = ["en", "de", None]
    return [(i, t, langs[i % 3], sources[i % 5] if i % 4 else "src0") for i, t in enumerate(texts)]


@pytest.fixture
def odd(spark):
    return make(spark, odd_rows()).repartition(3, F.col("doc_id"))


@pytest.fixture
def nothing(spark):
    return make(spark, [])


@pytest.fixture
def repeated(spark):
    """The odd rows, each twice, and rows without an id."""
    rows = odd_rows()
    return make(spark, [*rows, *rows, (None, rows[3][1], None, None), (None, "nobody", "en", "src1")])
