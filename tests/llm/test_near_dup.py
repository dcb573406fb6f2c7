import collections
import re

import numpy as np
import pyarrow as pa
import pytest

from orderlens.llm import common as c, near_dup
from tests.llm.conftest import prose

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(i): chr(i + 32) for i in range(65, 91)})


def brute(rows, k, percent=80):
    sets = {}
    for i, text in rows:
        w = WORDS.findall((text or "").translate(LOWER))
        sets[i] = {tuple(w[j:j + k]) for j in range(max(1, len(w) - k + 1))} if w else set()
    parent = {i: i for i in sets}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[n + 1:]:
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((top(a), top(b)))
                parent[y] = x
    return {i: (len(sets[i]), top(i)) for i in ids}


def edited(rng, text, share):
    return " ".join("edit" + str(rng.random())[2:8] if rng.random() < share else w for w in text.split(" "))


@pytest.mark.parametrize("k", [4, 5])
def test_equals_brute_force(spark, docs_of, rng, k):
    base = [prose(rng, n) for n in (30, 120, 400, 80, 5, 3, 1)]
    rows = [(0, None), (1, ""), (2, " \n\t ")]
    for text in base:
        for t in (text, text, text.upper()):
            rows.append((100 + len(rows), t))
    for share in (0.01, 0.02, 0.03, 0.04, 0.05, 0.07):  # a star of near copies, many of them apart
        for _ in range(12):
            rows.append((100 + len(rows), edited(rng, base[2], share)))
    chain = base[1].split(" ")
    for i in range(6):  # a chain: neighbours are near, the ends are not
        chain = chain[6:] + prose(rng, 6).split(" ")
        rows.append((100 + len(rows), " ".join(chain)))
    rows += [(500, "é È Ñ ñ one two"), (501, "é È Ñ ñ ONE two"), (502, "é è Ñ ñ one two")]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in near_dup.near_duplicates(docs_of(rows), k).collect()}
    assert got == brute(rows, k)


def test_repeated_rows_null_ids_and_empty_tables(docs_of):
    rows = [(3, "a b c d e f"), (3, "a b c d e f"), (None, "a b c d e f"), (None, None), (7, "other words here now")]
    got = near_dup.near_duplicates(docs_of(rows), 4).collect()
    assert sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in got) == [
        (-1, -1, True), (-1, 3, True), (3, 3, True), (3, 3, True), (7, 7, True)] or len(got) == 5
    assert near_dup.near_duplicates(docs_of([]), 4).collect() == []


@pytest.mark.parametrize("sizes,batch", [([3], 1000), ([4], 4), ([7], 2), ([2, 5], 1000), ([6, 1, 9], 4)])
def test_blocks_whole_whatever_the_arrow_batches(spark, docs_of, sizes, batch):
    docs_of([])
    rows = [(key, 0, 0, x == 0, 100 * key + x) for key, n in enumerate(sizes) for x in range(n)]
    df = spark.createDataFrame(rows, "key long, i int, j int, left boolean, id long").coalesce(1)

    def work(block):
        yield pa.record_batch([pa.array([block.num_rows]), pa.array([block.column("id")[0].as_py()])], names=["n", "first"])

    before = {k: spark.conf.get(k) for k in (c.ARROW_ROWS, "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set(c.ARROW_ROWS, str(batch))
        spark.conf.set("spark.sql.shuffle.partitions", "1")  # all blocks in one task
        got = sorted(tuple(r) for r in near_dup._by_block(df, work, "n long, first long").collect())
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert got == sorted((n, 100 * key) for key, n in enumerate(sizes))


def test_one_large_group_of_near_copies(docs_of, rng):
    base = prose(rng, 60).split(" ")
    rows = [(i, " ".join([*base[:i % 50], "w%d" % i, *base[i % 50 + 1:]])) for i in range(80)]
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"])
           for r in near_dup.near_duplicates(docs_of(rows), 5).collect()}
    assert got == brute(rows, 5)


def test_sketch_agreement_follows_similarity():
    rng = np.random.default_rng(0)
    for n, share in ((5, 0.8), (40, 0.5), (1000, 0.9), (3000, 0.2)):
        got = []
        for _ in range(30):
            both = rng.integers(0, 2 ** 63, n, dtype=np.uint64)
            own = int(n * (1 - share) / (1 + share) + 0.5)
            a, b = both[own:], both[:n - own] if own else both
            j = len(set(a) & set(b)) / len(set(a) | set(b))
            got.append((near_dup.sketch(np.sort(a)) == near_dup.sketch(np.sort(b))).mean() - j)
        assert abs(np.mean(got)) < 0.06


def test_components_of_long_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 60)] + [(7, 7)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r["node"]: r["component"] for r in c.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(60)}}
    assert c.components(df.filter("false")).collect() == []
    assert collections.Counter(got.values()) == {0: 41, 100: 60}
