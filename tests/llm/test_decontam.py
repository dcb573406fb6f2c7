import numpy as np

from orderlens.llm import decontam as d
from tests.llm.conftest import prose


def smith_waterman(item, text):
    h = np.zeros((len(item) + 1, len(text) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(text, 1):
            h[i, j] = max(0, h[i - 1, j - 1] + (d.MATCH if a == b else d.OTHER), h[i - 1, j] - d.GAP, h[i, j - 1] - d.GAP)
    return int(h.max())


def test_alignment_equals_plain_smith_waterman():
    r = np.random.default_rng(1)
    for _ in range(300):
        item = r.integers(0, 6, r.integers(1, 15)).astype(np.uint64)
        text = r.integers(0, 6, r.integers(0, 30)).astype(np.uint64)
        score, a, b = d.align(item, text)
        assert score == smith_waterman(item, text)
        assert 0 <= a <= b <= len(text)
        if score:  # the stretch that is named holds the whole alignment
            assert d.align(item, text[a:b])[0] == score


def bench(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string, score double")


def test_equals_brute_force_over_all_pairs(spark, docs_of, rng):
    items = [(i, prose(rng, 35), 1.0) for i in range(12)]
    items += [(50, items[0][1].upper().replace(" ", ",  "), 1.0), (51, "too short", 1.0), (52, None, 1.0), (53, "", 1.0),
              (0, items[0][1], 1.0), (None, items[1][1], 1.0)]
    rows = [(i, prose(rng, 200)) for i in range(30)]
    for i in range(12):
        words = items[i][1].split(" ")
        rows += [(100 + i, prose(rng, 50) + " " + items[i][1] + " " + prose(rng, 50)),
                 (200 + i, " ".join("other" + str(k) if k % 7 == 3 else w for k, w in enumerate(words))),
                 (300 + i, prose(rng, 9) + " ".join(w for k, w in enumerate(words) if k % 9) + prose(rng, 9)),
                 (400 + i, " ".join(words[:12])), (500 + i, items[i][1] * 2)]
    rows += [(900, None), (901, ""), (902, "too short"), (100, rows[30][1]), (None, items[3][1])]
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in d.contaminated(docs_of(rows), bench(spark, items)).collect()}
    want = {}
    for i, text in rows:
        w = d.words((text or "").encode())
        for k, item, _ in items:
            own = d.words((item or "").encode())
            if k is not None and len(own) >= d.MIN_WORDS:
                score = smith_waterman(own.tolist(), w.tolist()) / (2 * len(own))
                if score >= d.MIN_SCORE:
                    want[i, k] = max(score, want.get((i, k), 0))
    assert got == want
    assert all((100 + i, i) in got and (200 + i, i) in got and (300 + i, i) in got for i in range(12))
    assert not any(i is not None and i < 100 for i, _ in got)


def test_edited_copies_equal_brute_force(spark, docs_of, rng):
    # one copy of each item: a word of every 4, 5 or 6 replaced, or two added after every 4; half of the
    # items also have an exact copy beside it
    items = [(i, prose(rng, 37), 1.0) for i in range(8)]
    rows = [(i, prose(rng, 150)) for i in range(10)]
    for i, text, _ in items:
        words, n = text.split(" "), i // 2 + 4
        copy = (" ".join(f"other{k}" if k % n == n - 1 else w for k, w in enumerate(words)) if n < 7 else
                " ".join(f"{w} added{k} more{k}" if k % 4 == 3 else w for k, w in enumerate(words)))
        rows.append((100 + i, prose(rng, 40) + " " + copy + " " + prose(rng, 40)))
        if i % 2:
            rows.append((200 + i, text))
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in d.contaminated(docs_of(rows), bench(spark, items)).collect()}
    want = {}
    for i, text in rows:
        w = d.words(text.encode())
        for k, item, _ in items:
            own = d.words(item.encode())
            score = smith_waterman(own.tolist(), w.tolist()) / (2 * len(own))
            if score >= d.MIN_SCORE:
                want[i, k] = score
    assert got == want
    assert all((100 + i, i) in got for i in range(8))


def test_empty_tables(spark, docs_of):
    assert d.contaminated(docs_of([]), bench(spark, [(1, "one two three four five six", 0.0)])).collect() == []
    assert d.contaminated(docs_of([(1, "one two three four five six")]), bench(spark, [])).collect() == []


def test_blocks_of_items_give_the_same_result(spark, docs_of, rng, monkeypatch):
    items = [(i, prose(rng, 30), 0.0) for i in range(20)]
    docs = docs_of([(i, prose(rng, 20) + " " + t) for i, t, _ in items])
    whole = sorted(map(tuple, d.contaminated(docs, bench(spark, items)).collect()))
    monkeypatch.setattr(d, "BLOCK_WORDS", 100)
    assert sorted(map(tuple, d.contaminated(docs, bench(spark, items)).collect())) == whole
    assert len(whole) >= 20
