import zlib

import numpy as np
import pytest

from orderlens.llm import packing
from tests.llm.conftest import prose


def test_pieces_equal_whole_text_tokenizer(docs_of, rng):
    from tokenizers import Tokenizer
    tok = Tokenizer.from_file(packing.default_tokenizer())
    rows = [(0, None), (1, ""), (2, "Don't STOP me\r\nnow!!  it's\t3.5 <|endoftext|>x é ́a"),
            (3, prose(rng, 3000)), (4, "word " * 5000), (5, "x" * 9000), (6, "a\x0bb\x0cc d 日本 語"), (6, "twice")]
    got = sorted((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"], tuple(r["ids"]))
                 for r in packing.pieces(docs_of(rows), packing.default_tokenizer(), with_ids=True).collect())
    want = []
    for i, text in rows:
        ids = np.array([*tok.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        for k, at in enumerate(range(0, len(ids), 2048)):
            part = ids[at:at + 2048]
            want.append((i, k, at, len(part), zlib.crc32(part.tobytes()), tuple(part.tolist())))
    assert got == sorted(want)


def lower_bound(counts):
    """Sequences that no packing can do without: for every cut k, pieces longer than half a
    sequence are apart, those above capacity - k take no piece of k or more, and the pieces from
    k to half share what room is left."""
    full, size = len(counts) - 1, np.arange(len(counts))
    best = 0
    for k in range(full // 2 + 1):
        alone = counts[size > full - k].sum()
        big, small = (size > full / 2) & (size <= full - k), (size >= max(k, 1)) & (size <= full / 2)
        room = counts[big].sum() * full - (counts * size)[big].sum()
        best = max(best, alone + counts[big].sum() + max(0, -(-((counts * size)[small].sum() - room) // full)))
    return int(best)


def check_places(rows, capacity):
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by)


def test_places_are_gapless_and_nearly_fewest(docs_of, rng):
    rows = [(i, prose(rng, rng.choice([1, 3, 20, 100, 300, 900, 2500]))) for i in range(400)] + [(7, "same")] * 30
    rows += [(None, None), (None, "no id")]
    got = packing.pack(docs_of(rows)).collect()
    n = check_places(got, 2048)
    least = lower_bound(np.bincount([r["length"] for r in got], minlength=2049))
    assert least <= n <= 1.01 * least + 1
    assert len({(r["sequence_id"], r["offset"]) for r in got}) == len(got)
    assert packing.pack(docs_of([])).collect() == []


@pytest.mark.parametrize("seed", range(5))
def test_plan_uses_every_piece_once(seed):
    r = np.random.default_rng(seed)
    counts = np.zeros(257, np.int64)
    counts[1:] = r.poisson(r.choice([0, 1, 50, 3000], 256))
    counts[256] = 5000
    used = np.zeros_like(counts)
    sequences = 0
    for pattern, n in packing.plan(counts):
        assert sum(pattern) <= 256 and n > 0
        np.add.at(used, list(pattern), n)
        sequences += n
    assert (used == counts).all()
    assert lower_bound(counts) <= sequences <= 1.01 * lower_bound(counts) + 1


def test_fit_is_a_non_negative_least_squares_solution():
    counts = np.array([0, 4, 9, 7, 30, 11, 3, 2, 40])
    columns = packing.patterns(counts)
    assert columns and all(sum(p) == 8 for p in columns)
    a = np.zeros((len(counts), len(columns)))
    for j, p in enumerate(columns):
        np.add.at(a[:, j], list(p), 1)
    x = packing.fit(counts, columns, 20000)
    used = np.unique([v for p in columns for v in p])
    grad = a[used].T @ (a[used] @ x - counts[used])
    assert (x >= 0).all() and (grad > -0.05).all() and abs(grad @ x) < 0.5
