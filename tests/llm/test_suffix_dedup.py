import collections
import hashlib

import numpy as np
import pytest

from orderlens.llm import suffix_dedup as m
from tests.llm.conftest import prose


def brute(rows, length=m.LENGTH):
    count = collections.Counter()
    texts = [(i, (t or "").encode()) for i, t in rows]
    for _, b in texts:
        count.update(b[a:a + length] for a in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = np.zeros(len(b), bool)
        for a in range(len(b) - length + 1):
            if count[b[a:a + length]] > 1:
                gone[a:a + length] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[:1].sum())
        out.append((-1 if i is None else i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def result(df):
    return sorted((-1 if r[0] is None else r[0], *r[1:]) for r in df.collect())


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_equals_brute_force(docs_of, rng, batches):
    shared, other = prose(rng, 150), prose(rng, 90)
    line = "the same line again and again\n"
    rows = [(0, None), (1, ""), (2, "short"), (3, shared), (4, shared)]
    rows += [(10 + i, prose(rng, 40 + 30 * i) + shared[i * 7:] + prose(rng, 20)) for i in range(6)]
    rows += [(20 + i, prose(rng, 10) + other[:300 + 50 * i] + prose(rng, 60)) for i in range(6)]
    rows += [(30, line * 40), (31, "a" * 900), (32, "a" * 399 + "b" + "a" * 400), (33, "é" * 450), (34, "x" + "é" * 230)]
    rows += [(40, prose(rng, 300))] * 2 + [(None, shared[:500])]
    rows += [(50, other + "\n" + other), (51, prose(rng, 2000))]
    assert result(m.remove_repeats(docs_of(rows), batches)) == brute(rows)


def test_levels_are_powers_of_two(spark):
    family = m.SuffixFamily()
    for k in range(7):
        family.add(spark.range(k * 10, k * 10 + 20).selectExpr("id AS h"))
    assert sorted(family.levels) == [0, 1, 2]
    assert family.levels[2].agg({"n": "sum"}).first()[0] == 80


def test_matches_against_levels_are_found(spark):
    family = m.SuffixFamily()
    assert family.add(spark.range(0, 5).selectExpr("id AS h")).count() == 0
    assert family.add(spark.range(5, 9).selectExpr("id AS h")).count() == 0  # merged with the first
    assert sorted(r[0] for r in family.add(spark.range(3, 12).selectExpr("id AS h")).collect()) == [3, 4, 5, 6, 7, 8]


def test_empty_table(docs_of):
    assert m.remove_repeats(docs_of([])).collect() == []
    assert m.cut_texts(docs_of([])).collect() == []
