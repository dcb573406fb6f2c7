import numpy as np

from orderlens.llm import labelmodel as m
from tests.llm.conftest import prose, rows_of


def test_prose_is_kept_and_junk_is_not(docs_of, rng):
    def sentence(n):
        return prose(rng, n).capitalize() + "."

    good = [(i, " ".join(sentence(12) for _ in range(rng.choice([5, 12, 40])))) for i in range(150)]
    junk = []
    for k in range(10):
        w = prose(rng, 120).replace(".", "").split(" ")
        junk += [(1000 + 5 * k, " ".join(x + "%%%" for x in w)), (1001 + 5 * k, " | ".join(w)),
                 (1002 + 5 * k, "!! ".join(x.upper() for x in w)), (1003 + 5 * k, w[0] + " " + w[1]),
                 (1004 + 5 * k, (" ".join(w[:9]) + "\n") * 30)]
    odd = [(5000, None), (5001, ""), (None, good[0][1]), (3, good[3][1]), (5002, good[0][1] * 200)]
    out = m.quality(docs_of(good + junk + odd)).collect()
    assert len(out) == len(good) + len(junk) + len(odd)
    got = {r["doc_id"]: r for r in out}
    assert all(got[i]["kept"] for i, _ in good)
    assert not any(got[i]["kept"] for i, _ in junk)
    assert not got[5000]["kept"] and got[5000]["score"] == got[5001]["score"]
    assert m.quality(docs_of([])).collect() == []


def test_estimation_recovers_labeller_accuracies():
    r = np.random.default_rng(0)
    truth = r.random(60000) < 0.7
    right = np.linspace(0.65, 0.95, m.LABELLERS)
    votes = np.where(r.random((len(truth), m.LABELLERS)) < 0.4, 1,
                     2 * (truth[:, None] ^ (r.random((len(truth), m.LABELLERS)) > right)))
    codes, counts = np.unique(m.pattern(votes), return_counts=True)
    post = dict(zip(codes.tolist(), m.estimate(codes, counts.astype(float)).tolist(), strict=True))
    found = np.array([post[int(k)] for k in m.pattern(votes)])
    assert ((found > 0.5) == truth).mean() > 0.9
    exact = 1 / (1 + np.exp(-(np.log(0.7 / 0.3) + (votes - 1) @ np.log(right / (1 - right)))))
    assert np.abs(found - exact).mean() < 0.02


def test_equal_votes_have_equal_posteriors(docs_of, rng):
    got = rows_of(m.quality(docs_of([(i, prose(rng, 60)) for i in range(30)])), "doc_id")
    seen = {}
    for r in got.values():
        assert seen.setdefault(r["pattern"], r["posterior"]) == r["posterior"]
