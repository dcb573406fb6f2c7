import re

from orderlens.llm import licences as m
from tests.llm.conftest import prose


def test_families_are_found_and_other_passages_are_unknown(docs_of, rng):
    plain = [(i, "\n".join(prose(rng, 30) for _ in range(3))) for i in range(40)]
    texts = [t for f in m.FAMILIES if f != m.UNKNOWN for t in m.TEMPLATES[f]]
    family = {t: f for f in m.FAMILIES if f != m.UNKNOWN for t in m.TEMPLATES[f]}
    rows = [(100 + i, prose(rng, 20) + "\n" + t + "\n" + prose(rng, 20)) for i, t in enumerate(texts)]
    rows += [(300, "Licensed under the Apache License, Version 2.0. " + prose(rng, 200)),
             (301, "The licence to fish costs ten crowns a year."), (302, "RELEASED UNDER THE MIT LICENSE"),
             (303, "All rights reserved."), (304, None), (305, ""), (303, "All rights reserved."),
             (None, "Released under the MIT License."), (306, "permission " * 4000)]
    out = m.scan(docs_of(plain + rows)).collect()
    got = {}
    for r in out:
        got.setdefault(r["doc_id"], []).append(r)
    assert not any(i is not None and i < 100 for i in got)
    hit = 0
    for i, t in enumerate(texts):
        if any(s in t.lower() for s in m.STEMS):
            # a sentence that several families share may name either
            hit += any(r["family"] == family[t] for r in got[100 + i])
    assert hit >= 0.85 * sum(any(s in t.lower() for s in m.STEMS) for t in texts)
    assert [r["family"] for r in got[300]] == ["Apache-2.0"]
    assert [r["family"] for r in got[301]] == [m.UNKNOWN]
    assert [r["family"] for r in got[302]] == ["MIT"] == [r["family"] for r in got[None]]
    assert [r["family"] for r in got[303]] == ["Proprietary"] * 2
    assert 304 not in got and 305 not in got
    assert all(r["family"] == (r["predicted"] if r["confirmed"] else m.UNKNOWN) and 0 <= r["probability"] <= 1 for r in out)


def test_passages_equal_brute_force(docs_of, rng):
    rows = [(1, "One licence. Two! Permission? no\nx\n\nCopyright"), (2, "none"), (3, "LICENSED. a. b licen"), (4, None)]
    want = []
    for i, text in rows:
        for n, line in enumerate((text or "").split("\n")):
            for k, s in enumerate(re.split(r"(?<=[.!?])\s+", line)):
                if any(x in s.lower() for x in m.STEMS):
                    want.append((i, n, k, s))
    assert sorted(tuple(r) for r in m.passages(docs_of(rows)).collect()) == sorted(want)


def test_passages_without_a_stem_meet_the_classifier(docs_of, rng):
    plain = [(i, "\n".join(prose(rng, 30) for _ in range(3))) for i in range(40)]
    said = {100: ("Released under the GNU GPL, version 3 or later.", "GPL"), 101: ("Released under the MIT.", "MIT")}
    rows = [(i, prose(rng, 20) + "\n" + t + "\n" + prose(rng, 20)) for i, (t, _) in said.items()]
    rows += [(102, "Distributed under MIT."), (103, "Released under the terms of the GNU GPL v3.")]
    assert not any(s in t.lower() for _, t in rows for s in m.STEMS)
    got = {r["doc_id"]: r for r in m.scan(docs_of(plain + rows)).collect()}
    assert set(got) == {100, 101, 102, 103}
    assert all((got[i]["passage"], got[i]["family"]) == want for i, want in said.items())
    assert (got[102]["predicted"], got[103]["predicted"]) == ("MIT", "GPL")


def test_the_gate_keeps_every_passage_that_the_result_can_hold(spark, docs_of, rng):
    import itertools
    bigrams = set()
    for f, own in m.TEMPLATES.items():
        for t in own if f != m.UNKNOWN else ():
            words = re.findall("[a-z0-9]+", t.lower())
            bigrams |= set(itertools.pairwise(words))
    texts = [f"x {a.upper()} - {b}, y" for a, b in bigrams] + [f"{a} {b}" for a, b in bigrams]
    texts += [prose(rng, 12) for _ in range(40)] + ["the mits license", "under them it", "é the é mit", "rights", "0 1"]
    texts += [" ".join(rng.choice(sorted(bigrams))[rng.randrange(2)] for _ in range(5)) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "passage string")
    got = {r[0] for r in df.filter(m._may_match(m.F.col("passage"))).collect()}
    for t in texts:
        held = bigrams & set(itertools.pairwise(re.findall("[a-z0-9]+", t.lower())))
        assert (t in got) == (bool(held) or any(s in t.lower() for s in m.STEMS)), t


def test_empty_table(docs_of):
    assert m.scan(docs_of([])).collect() == []
