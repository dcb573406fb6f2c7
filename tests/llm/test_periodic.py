import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from orderlens.llm import periodic
from tests.llm.conftest import prose, rows_of

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(words, min_words=24, exponent=3):
    n, out = len(words), []
    for q in range(1, n // exponent + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            run, length = words[i:j + q], j + q - i
            if length >= max(min_words, exponent * q) and not any(run[x:] == run[:-x] for x in range(1, q)):
                out.append((i, length, q))
            i = j
    return sorted(out, key=lambda r: (r[0], r[2]))


def expected(doc_id, text):
    words = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute(words)
    gone = {i for s, m, q in runs for i in range(s + q, s + m)}
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=(None, None, None))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None,
            sha("".join(f"{s},{m},{q}\n" for s, m, q in runs)),
            sha(" ".join(w for i, w in enumerate(words) if i not in gone)))


@pytest.mark.parametrize("exponent,min_words", [(2, 2), (2, 5), (3, 7), (3, 24), (4, 9)])
def test_runs_equal_brute_force(exponent, min_words):
    rng = random.Random(exponent * 100 + min_words)
    for case in range(400):
        letters = rng.choice((1, 2, 2, 3, 5))
        words = [rng.randrange(letters) for _ in range(rng.randrange(0, 45))]
        if case % 2:  # a planted period between other words
            root = words[:rng.randrange(1, 9)] or [0]
            words = words[:9] + (root * 12)[:rng.randrange(60)] + words[-7:]
        got = periodic.runs_of(np.array(words, np.int64), min_words, exponent)
        assert list(zip(*(x.tolist() for x in got), strict=True)) == brute(words, min_words, exponent), words


def test_lce_and_orders_equal_brute_force():
    rng = random.Random(1)
    for _ in range(60):
        s = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        n, e = len(s), periodic.Extensions(np.array(s))
        assert e.leaves == sorted(range(n + 1), key=lambda i: s[i:])
        assert e.inverse_leaves() == sorted(range(n + 1), key=lambda i: [-x for x in s[i:]])
        for i in range(n):
            others = np.array([j for j in range(n) if j != i], int)
            want = [next((x for x in range(n) if max(i, j) + x == n or s[i + x] != s[j + x])) for j in others]
            assert e.lce(np.full(len(others), i), others).tolist() == want


def test_fibonacci_words_and_long_runs():
    a, b = [0], [0, 1]
    while len(b) < 600:
        a, b = b, b + a
    got = periodic.runs_of(np.array(b), 2, 2)
    assert list(zip(*(x.tolist() for x in got), strict=True)) == brute(b, 2, 2)
    start, length, period = periodic.runs_of(np.arange(100_000) % 700)
    assert (start.tolist(), length.tolist(), period.tolist()) == ([0], [100_000], [700])


def test_query_columns_equal_brute_force(docs_of, rng):
    rows = [(0, None), (1, ""), (2, " \n\t"), (3, "é"), (4, "w " * 23), (5, "w\n" * 24), (6, "a b " * 12 + "a"),
            (7, ("a b c d " * 20) + ("x " * 30) + "a b " * 20)]
    for i in range(10, 160):
        text = prose(rng, 5 + i)
        if i % 3 == 0:  # a passage repeated far apart and one repeated at once
            part = prose(rng, i % 19 + 1)
            text = f"{part} {text} {' '.join([part] * 5)} {text[:200]}"
        rows.append((i, text))
    got = periodic.digest(periodic.periodic_runs(docs_of(rows), rewrite=periodic.planted)).drop("n_words")
    want = {i: expected(i, t) for i, t in rows}
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 5
    assert sum(w[1] for w in want.values()) > 50
    assert {r["doc_id"]: tuple(r) for r in got.collect()} == want


def test_collapsed_text_repeated_rows_null_ids_and_empty_tables(docs_of):
    text = "start here " + "one two three " * 10 + "end\nhere"
    rows = [(3, text), (3, text), (None, text), (9, "plain")]
    got = periodic.periodic_runs(docs_of(rows)).collect()
    assert [r["collapsed"] for r in got] == ["start here one two three end here"] * 3 + ["plain"]
    assert [tuple(r["runs"][0]) for r in got if r["runs"]] == [(2, 30, 3)] * 3
    assert periodic.digest(periodic.periodic_runs(docs_of([]))).collect() == []


def test_a_very_long_text(docs_of, rng):
    text = prose(rng, 30_000) + " " + "again and again " * 20_000
    row = rows_of(periodic.periodic_runs(docs_of([(1, text)])), "doc_id")[1]
    assert [tuple(r) for r in row["runs"]] == [(30_000, 60_000, 3)] or len(row["runs"]) == 1
    assert row["n_words"] == 90_000 and len(row["collapsed"].split()) <= 30_005
