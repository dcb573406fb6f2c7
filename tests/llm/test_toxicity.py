import zlib

import numpy as np
import pytest

from orderlens.llm import charlm, toxicity as t
from tests.llm.conftest import prose, rows_of

BAD = ["wretchscum", "vileoaf", "grotbag", "dunghead"]


@pytest.fixture(scope="module")
def corpus():
    import random
    rng = random.Random(9)
    rows, labels = [], []
    for i in range(600):
        words = prose(rng, rng.choice([20, 80, 300])).split(" ")
        toxic = i % 5 == 2
        if toxic:
            for _ in range(rng.choice([1, 2, 4])):
                words.insert(rng.randrange(len(words)), rng.choice(BAD) + rng.choice(["", "s", ",", "!!!"]))
        rows.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return rows, labels


def test_held_out_accuracy_and_obfuscated_words(spark, docs_of, corpus):
    rows, labels = corpus
    hidden = ["wr3tch5cum", "v1leoaf", "w r e t c h s c u m", "grotttbaaag", "WRETCHSCUM", "dungh3@d"]
    import random
    rng = random.Random(2)
    extra = [(1000 + i, prose(rng, 30) + " " + w + " " + prose(rng, 30)) for i, w in enumerate(hidden)]
    odd = [(2000, None), (2001, ""), (2002, "x"), (None, "grotbag"), (2003, "grotbag " * 20000), (5, rows[5][1])]
    lab = spark.createDataFrame([*labels, (3, None), (None, 1)], "doc_id long, toxic int")
    out = t.toxicity(docs_of(rows + extra + odd), lab).collect()
    assert len(out) == len(rows) + len(extra) + len(odd)
    got = {r["doc_id"]: r for r in out}
    truth = dict(labels)
    for i, r in got.items():
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5)
        assert r["held_out"] == (i is not None and zlib.crc32(str(i).encode()) % 5 == 0)
    held = [i for i in truth if got[i]["held_out"]]
    assert np.mean([got[i]["predicted"] == truth[i] for i in held]) >= 0.98
    assert [got[1000 + i]["predicted"] for i in range(len(hidden))] == [1] * len(hidden)
    assert got[2000]["score"] == got[2001]["score"] < 0.5
    assert got[None]["predicted"] == got[2003]["predicted"] == 1


def test_held_out_labels_are_not_used(spark, docs_of, corpus):
    rows, labels = corpus
    flipped = [(i, 1 - y if zlib.crc32(str(i).encode()) % 5 == 0 else y) for i, y in labels]
    scores = [rows_of(t.toxicity(docs_of(rows), spark.createDataFrame(x, "doc_id long, toxic int")), "doc_id")
              for x in (labels, flipped)]
    assert {i: r["score"] for i, r in scores[0].items()} == {i: r["score"] for i, r in scores[1].items()}


def test_without_labels_or_documents(spark, docs_of, corpus):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    assert {r["score"] for r in t.toxicity(docs_of(corpus[0][:5]), none).collect()} == {0.0}
    assert t.toxicity(docs_of([]), none).collect() == []


def test_viterbi_equals_search_over_all_readings(docs_of, corpus):
    import itertools
    decoder = t.Decoder(charlm.train(docs_of(corpus[0][:100]))["en"])
    for stretch in ("gr0tb4g", "v1le0af", "aaab5", "d u n g", "x7", "l0ll"):
        best = None
        for path in itertools.product(*decoder.lattice(stretch)):
            text, score, state = "".join(p[0] for p in path), sum(p[1] for p in path), 0
            for symbol in charlm.fold((text + " ").encode()).tolist():
                p, state = decoder.step(state, symbol)
                score += p
            best = max(best or (score, text), (score, text))
        assert decoder.read(stretch) == best[1]


HIDDEN = {  # leading, trailing and mixed forms
    "!diot": "idiot", "(unt": "cunt", "|oser": "loser", "a$$": "ass", "dumb@$$": "dumbass", "whor3": "whore",
    "1 d 1 o t": "idiot", "s.h.1.t": "shit", "i d i o t": "idiot", "i  d  i  o  t": "idiot", "i/d/i/o/t": "idiot",
    "st.upid": "stupid", "w-h-0-r-e": "whore", "$tup1d": "stupid", "idiiii0t": "idiot", "1d10t": "idiot"}


def test_every_form_of_obfuscation_is_restored(docs_of):
    import random
    rng = random.Random(4)
    words = sorted(set(HIDDEN.values()))
    rows = [(i, " ".join(w for x in prose(rng, 60).split(" ") for w in ([x, rng.choice(words)] if rng.random() < 0.2 else
                                                                        [f"({x})"] if rng.random() < 0.2 else [x])))
            for i in range(60)]
    decoder = t.Decoder(charlm.train(docs_of(rows))["en"])
    wrong = {h: decoder.restore(f"Words {h} here").split(" ", 1)[1].rsplit(" ", 1)[0] for h in HIDDEN}
    wrong = {h: r for h, r in wrong.items() if r != HIDDEN[h]}
    assert not wrong
    plain = "Some words, and more (in brackets) here! See a/b, end. Next 10% of 3 4 5 at 12:30."
    assert decoder.restore(plain) == plain.lower()
    for h in HIDDEN:
        assert t.suspicious(np.frombuffer(f"Words {h} here".encode(), np.uint8)), h


def test_the_language_tag_is_no_input(spark, docs_of, corpus):
    rows, labels = corpus
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    extra = [(5000, "some text gr0tb4g here"), (5001, "some text gr0tb4g here"), (5002, "some text gr0tb4g here")]
    tagged = [(*r, "en") for r in rows] + [(*extra[0], "en"), (*extra[1], "yy"), (*extra[2], None)]
    got = rows_of(t.toxicity(docs_of(tagged), lab), "doc_id")
    assert got[5000]["score"] == got[5001]["score"] == got[5002]["score"] >= 0.5


def test_quick_test_misses_nothing():
    for text in ("plain words only", "a b c", "x1y", "heeey", "1a", "a1", "a b", "é é é", "ab c d e f", "no. 5, 6!", "a  b  c", "(x) y",
                 "$ h ! t", "x.y", "ab.cd", "é.éé.é", "éé/éé", "a$", "!ab", "| o s e r", "one_two"):
        data = np.frombuffer(text.encode(), np.uint8)
        if any(p.search(text.lower()) for p in (t._MIXED, t._SPACED, t._PARTED)):
            assert t.suspicious(data), text
