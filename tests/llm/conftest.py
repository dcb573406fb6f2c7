import random

import pytest

from orderlens.llm import common as c

LETTERS = "abcdefghijklmnopqrstuvwxyz"


def prose(rng, n, vocabulary=400):
    """n random words as sentences; the same rng gives the same words."""
    words = ["".join(LETTERS[(i * 7 + j * j * 3) % 26] for j in range(2 + i % 7)) + LETTERS[i % 26]
             for i in range(vocabulary)]
    out = [words[min(int(rng.expovariate(1 / 60)), vocabulary - 1)] for _ in range(n)]
    for i in range(9, n, 10):
        out[i] += "."
    return " ".join(out)


@pytest.fixture
def rng():
    return random.Random(5)


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text, lang) rows with extra columns whose names clash."""
    c.for_workers(spark)

    def make(rows):
        rows = [(*r, "en")[:3] for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
        return df.selectExpr("*", "'src0' AS source", "cast(length(text) AS bigint) AS n_chars",
                             "true AS kept", "1 AS _key", "'x' AS _slot", "0.5D AS score", "2 AS h", "3 AS key")
    return make


def rows_of(df, *key):
    return {tuple(r[k] for k in key) if len(key) > 1 else r[key[0]]: r for r in df.collect()}
