import collections
import hashlib

import numpy as np
import pytest

from orderlens.llm import alignment, queries
from tests.llm.conftest import prose

A_PATH, B_PATH = alignment.default_tokenizers()


@pytest.fixture(scope="module")
def tokenizers():
    return alignment.ByteLevel(A_PATH), alignment.Pieces(B_PATH)


def brute(rows, tokenizers):
    """Every pair of tokens whose byte ranges meet inside one group, by nested loops."""
    a, b = tokenizers
    per, holders = [], collections.Counter()
    for i, t in rows:
        tokens = ([], [])
        if t:
            tokens = a.encode([t])[0], b.encode([t])[0]
            want = b" " + t.encode()
            if any(b"".join(side.bytes[x] for x in ids) != want for side, ids in zip(tokenizers, tokens, strict=True)):
                tokens = ([], [])
        spans = []
        for side, ids in zip(tokenizers, tokens, strict=True):
            at, out = 0, []
            for x in ids:
                out.append((at, at + len(side.bytes[x]), x))
                at += len(side.bytes[x])
            spans.append(out)
        links = [(x, y) for s, e, x in spans[0] for u, v, y in spans[1] if s < v and u < e]
        ends = sorted({e for _, e, _ in spans[0]} & {e for _, e, _ in spans[1]})
        text, start = [], 0
        for end in ends:
            text.append("|".join(",".join(str(x) for s, e, x in side if start <= s and e <= end) for side in spans))
            start = end
        per.append((i, spans, ends, links, ";".join(text)))
        holders.update(set(links))
    top = collections.Counter()
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    return sorted(((i, len(s[0]), len(s[1]), len(ends), len(links), sum(holders[p] == top[p[0]] for p in links),
                    sum(holders[p] for p in links), hashlib.sha256(text.encode()).hexdigest() if s[0] else "")
                   for i, s, ends, links, text in per), key=str)


TEXTS = [None, "", " ", "a", "  leading  and   inner\tspaces\n\n", "plain words here, and more.", "café naïve — “quoted”",
         "Привет, мир! Как дела?", "こんにちは世界。", "한국어 텍스트", "🙂🙃 emoji 👩‍👩‍👧", "<|endoftext|> <s> </s> <unk> <0x41>",
         "1234567890 3.14159 x=1;y=2", "▁ a block ▁mark", "\u0000\u0001 control", "ﬁ ligature ½ ²", "á combining é",
         "supercalifragilisticexpialidocious antidisestablishmentarianism", "　wide　space", "\r\n\x0b\x0c"]


def test_equals_brute_force(docs_of, rng, tokenizers):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    rows += [(100 + i, prose(rng, 3 + 5 * i)) for i in range(25)]
    rows += [(200, "plain words here, and more."), (200, "plain words here, and more."), (None, "plain words")]
    got = sorted((tuple(r) for r in alignment.align(docs_of(rows)).collect()), key=str)
    assert got == brute(rows, tokenizers)


def test_blocks_of_pairs_give_the_same_rows(docs_of, rng, tokenizers):
    rows = [(i, prose(rng, 40)) for i in range(8)]
    df = docs_of(rows)
    got = sorted((tuple(r) for r in alignment.align(df, block=60).collect()), key=str)
    assert got == brute(rows, tokenizers)


def test_gallop_counts_smaller_values_from_any_guess():
    rng = np.random.default_rng(3)
    for _ in range(200):
        among = np.unique(rng.integers(0, 300, rng.integers(0, 90)))
        wanted = rng.integers(-5, 310, rng.integers(0, 60))
        guess = rng.integers(0, max(1, len(among)), len(wanted))
        assert (alignment.gallop(wanted, among, guess) == np.searchsorted(among, wanted)).all()


def test_token_bytes_give_the_text_back(tokenizers):
    a, b = tokenizers
    for t in filter(None, TEXTS):
        assert b"".join(a.bytes[x] for x in a.encode([t])[0]) == b" " + t.encode()
    assert b"".join(b.bytes[x] for x in b.encode(["a b\nç🙂"])[0]) == " a b\nç🙂".encode()


def test_words_give_the_ids_of_whole_texts(rng, tokenizers, monkeypatch):
    texts = [t for t in TEXTS if t] + [prose(rng, 60) for _ in range(20)] + [
        "it's we'll 'tis o'clock 'S x'", "a  b", "a \n b", "a\n b", "tail ", " head", "x\u00a0y \u00a0z", "a\u2003 b",
        "(a) [b] {c} <d> ... !!! ?! 12 3.4 -- – — “q”", "ｗｉｄｅ ½½ ⅷ 一二 三", "tab\tin side", "\x1c \x85 x"]
    for cache in (alignment.WORD_CACHE, 3):
        monkeypatch.setattr(alignment, "WORD_CACHE", cache)
        for side in tokenizers:
            words = alignment.Words(side)
            assert words.apart
            for some in (texts, texts[::-1], texts):
                got = words.ids(some)
                want = [np.array(x, "<i4").tobytes() for x in side.encode(some)]
                same = [b"".join(side.bytes[i] for i in x) == b" " + t.encode()
                        for t, x in zip(some, side.encode(some), strict=True)]
                assert got == [w if s else None for w, s in zip(want, same, strict=True)]


def test_empty_table_and_a_very_long_text(docs_of, rng, tokenizers):
    assert alignment.align(docs_of([])).collect() == []
    text = prose(rng, 60_000)
    row = alignment.align(docs_of([(1, text)])).collect()[0]
    assert (row["n_a"], row["n_b"]) == tuple(len(side.encode([text])[0]) for side in tokenizers)
    assert row["n_links"] == row["n_a"] + row["n_b"] - row["n_groups"]


def whole_groups(rows, tokenizers):
    """Every pair of tokens of one group, by nested loops; brute() gives the other columns."""
    per, holders = [], collections.Counter()
    for i, t in rows:
        spans = []
        for side in tokenizers:
            ids = side.encode([t])[0] if t else []
            ends = np.cumsum([len(side.bytes[x]) for x in ids]).tolist()
            if b"".join(side.bytes[x] for x in ids) != b" " + (t or "").encode():
                spans = [[], []]
                break
            spans.append(list(zip(ids, ends)))
        cuts = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        of = [[(x, next(k for k, cut in enumerate(cuts) if e <= cut)) for x, e in side] for side in spans]
        links = [(x, y) for x, g in of[0] for y, h in of[1] if g == h]
        per.append((i, links))
        holders.update(set(links))
    top = collections.Counter()
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    return sorted(((i, len(links), sum(holders[p] == top[p[0]] for p in links), sum(holders[p] for p in links))
                   for i, links in per), key=str)


def test_links_of_whole_groups(docs_of, rng, tokenizers, monkeypatch, tmp_path):
    """The query links all tokens of a group, also those that do not overlap."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(100 + i, prose(rng, 60)) for i in range(6)]
    rows += [(200, "zqxjkvwq " * 3 + "brxtqqq"), (200, "zqxjkvwq"), (None, "plain words"), (201, "x" * 301 + "=" * 77)]
    want = whole_groups(rows, tokenizers)
    plain = brute(rows, tokenizers)
    assert [x[1] for x in want] != [x[4] for x in plain]
    docs_of(rows).write.parquet(f"{tmp_path}/documents.parquet")
    spark = docs_of([]).sparkSession
    got = sorted((tuple(r) for r in queries.op11_tokenizer_alignment(spark, str(tmp_path)).collect()), key=str)
    assert [(r[0], *r[4:7]) for r in got] == want
    assert [(*r[:4], r[7]) for r in got] == [(*r[:4], r[7]) for r in plain]
    # ids of long groups paired once give the same pairs and times
    aligner, texts = alignment.Aligner(*tokenizers), [t for _, t in rows]
    found = []
    for long in (1 << 60, 1, 5):
        monkeypatch.setattr(alignment, "LONG", long)
        found.append([(*x[:5], x[5].tolist(), x[6].tolist()) for x in aligner.align(texts, "group")])
    assert found[0] == found[1] == found[2]
