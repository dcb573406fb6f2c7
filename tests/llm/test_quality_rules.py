import collections
import math
import re

import numpy as np
import pytest

from orderlens.llm import charlm, common as c, langmodel, quality_rules as q
from tests.llm.conftest import prose, rows_of


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = collections.Counter(tuple(words[i:i + 8]) for i in range(len(words) - 7))
    inside = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i:i + 8])] > 1:
            inside.update(range(i, i + 8))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(words), sum(map(len, words)), sum(ch in "#*$%&|<>" for ch in text), dup, len(inside)


def test_statistics_equal_brute_force(rng):
    part = prose(rng, 9)
    for text in ("", " ", "\n\n", "a", part * 3, f"{part} {part} {part}", f"{part}\n{part}\n \n \nx\n{part}",
                 "é\xa0ü # * $ % & | < > \x0b\x0c é", "a b c d e f g h " * 4, "x\r\ny\r\nx\r\n"):
        assert q.statistics(text.encode()) == brute(text), text


def test_base_rule_and_band(docs_of, rng):
    rows = [(i, prose(rng, 150)) for i in range(40)]
    rows += [(100, None), (101, ""), (102, prose(rng, 19)), (103, (prose(rng, 12) + " ") * 9),
             (104, " ".join("zqxj" + chr(120 + i % 3) * 3 for i in range(200))), (105, "Ж" * 4000 + " ж" * 30)]
    got = rows_of(q.quality_rules(docs_of(rows)), "doc_id")
    assert len(got) == len(rows)
    for i, text in rows:
        r = got[i]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == brute(text)
        assert r["base_failed"] == (r["n_words"] < 20 or 100 * r["n_repeat_words"] > 30 * r["n_words"])
        assert not (r["kept"] and r["base_failed"])
    assert all(got[i]["kept"] for i in range(40))
    assert not got[104]["kept"] and not got[105]["kept"]
    assert q.quality_rules(docs_of([])).collect() == []


def test_languages_have_their_own_bands(docs_of, rng):
    rows = [(i, prose(rng, 120), "en") for i in range(20)] + [(50 + i, prose(rng, 120)[::-1], "xx") for i in range(20)]
    rows += [(99, prose(rng, 120), None)]
    got = rows_of(q.quality_rules(docs_of(rows)), "doc_id")
    assert all(r["kept"] for r in got.values())
    assert got[0]["lower"] != got[50]["lower"]


def test_model_is_modified_kneser_ney(docs_of, rng):
    """Probabilities of every context sum to one, and equal a plain dictionary model."""
    texts = [prose(rng, 60) for _ in range(5)]
    model = charlm.train(docs_of(list(enumerate(texts))))["en"]
    top = collections.Counter()
    for t in texts:
        s = [0, 0, 0, *charlm.fold(t.encode()).tolist()]
        top.update(tuple(s[i:i + 4]) for i in range(len(s) - 3))
    counts = [top]
    for _ in range(3):
        counts.insert(0, collections.Counter(g[1:] for g in counts[0]))

    def prob(gram):
        if not gram:
            return 1 / charlm.SYMBOLS
        table = counts[len(gram) - 1]
        d = charlm.Model._discounts(np.array(list(table.values())))
        same = {g: n for g, n in table.items() if g[:-1] == gram[:-1]}
        if not same:
            return prob(gram[1:])
        total = sum(same.values())
        back = sum(d[min(n, 3)] for n in same.values()) / total
        n = same.get(gram, 0)
        return max(n - d[min(n, 3)], 0) / total + back * prob(gram[1:])

    for ctx in ((5, 6, 7), (0, 0, 0), (9, 0, 12), (31, 31, 31)):
        p = [math.exp(model.logp(np.array([((ctx[0] * 32 + ctx[1]) * 32 + ctx[2]) * 32 + s], np.uint32))[0])
             for s in range(32)]
        assert sum(p) == pytest.approx(1, abs=1e-4)
        assert p == pytest.approx([prob((*ctx, s)) for s in range(32)], rel=1e-3)


def brute_perplexities(rows):
    """Perplexity of each row's words by a plain recursive model of each language."""
    out = {}
    for lang in {r[2] for r in rows}:
        texts = {r[0]: re.findall(r"[^\x20\x09-\x0D]+", r[1]) for r in rows if r[2] == lang}
        held = collections.Counter(w for words in texts.values() for w in set(words))
        tables = [collections.Counter() for _ in range(langmodel.ORDER + 1)]
        for w, n in held.items():
            for gram in langmodel.word_grams(w):
                tables[len(gram)][gram] += n - 1
        for k in range(langmodel.ORDER - 1, 0, -1):
            for gram, n in tables[k + 1].items():
                tables[k][gram[1:]] += n > 0

        def prob(gram):
            if not gram:
                return 1 / (sum(n > 0 for n in tables[1].values()) + 1)
            table = tables[len(gram)]
            d = charlm.Model._discounts(np.array(list(table.values())))
            same = [n for g, n in table.items() if g[:-1] == gram[:-1]]
            if not sum(same):
                return prob(gram[1:])
            n, back = table[gram], sum(d[min(x, 3)] for x in same) / sum(same)
            return (n - d[min(n, 3)]) / sum(same) + back * prob(gram[1:])

        score = {w: sum(math.log(prob(g)) for g in langmodel.word_grams(w)) for w in held}
        for i, words in texts.items():
            size = sum(map(len, words)) + len(words)
            out[i] = math.exp(-sum(score[w] for w in words) / size) if size else None
    return out


@pytest.mark.parametrize(("size", "table"), [(langmodel.FREQUENT, langmodel.TABLE), (12, langmodel.TABLE), (12, 0)])
def test_perplexity_equals_a_plain_model(docs_of, rng, monkeypatch, size, table):
    """However many words are broadcast, and whether n-grams are broadcast or joined."""
    monkeypatch.setattr(langmodel.frequent, "__defaults__", (size,))
    monkeypatch.setattr(langmodel.train, "__defaults__", (table,))
    rows = [(i, prose(rng, 25, 60), "en") for i in range(6)] + [(20, "one two\tone  thirteen\n", "en"), (21, " ", "en")]
    rows += [(30 + i, prose(rng, 15, 30), None) for i in range(3)] + [(40, "мама мыла раму", ""), (41, "мама мыла 窓🙂", "")]
    got = rows_of(q.quality_rules(docs_of(rows)), "doc_id")
    for i, want in brute_perplexities(rows).items():
        assert got[i]["perplexity"] == (want and pytest.approx(want, rel=1e-9))


@pytest.mark.parametrize("first", ["а", "一"])
def test_junk_in_other_scripts_is_rejected(docs_of, rng, first):
    """Random letters in words of the right lengths; folded to one symbol they looked like the language."""
    def other(text):
        return "".join(chr(ord(first) + ord(ch) - 97) if ch.isalpha() else ch for ch in text)
    rows = [(i, other(prose(rng, 150)), "zz") for i in range(30)]
    mash = ["".join(rng.choice("abcdefghijklmnopqrstuvwx") for _ in w) for w in prose(rng, 150).split()]
    got = rows_of(q.quality_rules(docs_of([*rows, (99, other(" ".join(mash)), "zz")])), "doc_id")
    assert all(got[i]["kept"] for i in range(30))
    assert not got[99]["kept"] and not got[99]["base_failed"]


def test_what_the_model_gathers_grows_with_the_words(docs_of, rng):
    """A word form that two documents share is a word of the model, whatever others there are."""
    def gathered(n):
        rows = [(i, " ".join(f"{chr(0x4e00 + k)}{chr(0x4e00 + k * 7 % n)}" for k in range(n))) for i in range(2)]
        return len(langmodel.train(c.texts(docs_of(rows), "lang"))[0].grams)
    assert gathered(5000) > 9 * gathered(500) > 9 * 1000
