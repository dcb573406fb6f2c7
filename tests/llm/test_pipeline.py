import corpus_pipeline as p
from orderlens.llm import common as c, near_dup
from tests.llm.conftest import prose

SF = "/root/testdata/sf0.001"


def test_stages_keep_the_columns_and_take_effect(spark):
    docs = c.read(spark, SF, "documents")
    before, at = docs.count(), docs
    for name, stage in p.STAGES[:-1]:
        out = c.written(stage(spark, at, SF), name)
        assert out.columns == docs.columns and out.schema == at.schema
        assert out.count() <= at.count()
        at = out
    assert 0 < at.count() < before
    packed = p.STAGES[-1][1](spark, at, SF)
    assert packed.select("doc_id").distinct().count() == at.select("doc_id").distinct().count()
    assert [n for n, _ in p.STAGES] == ["quality_rules", "near_dedup", "suffix_array_dedup", "decontamination",
                                        "best_fit_packing"]


def test_near_dedup_keeps_one_of_each_group(spark, docs_of, rng):
    a, b = prose(rng, 80), prose(rng, 60)
    rows = [(5, a), (3, a), (9, a + " x"), (7, b), (7, b), (None, b), (None, None), (8, None)]
    out = p.near_dedup(spark, docs_of(rows), SF)
    assert sorted(-1 if r["doc_id"] is None else r["doc_id"] for r in out.collect()) == [-1, -1, 3, 7, 8]
    assert out.columns == docs_of(rows).columns
    left = near_dup.near_duplicates(out.filter("doc_id is not null"), 5).collect()
    assert all(r["kept"] for r in left)


def test_stages_on_empty_tables_and_odd_rows(spark, docs_of, rng):
    odd = docs_of([(1, None), (2, ""), (None, prose(rng, 60)), (3, prose(rng, 60)), (3, prose(rng, 300))])
    for docs in (docs_of([]), odd):
        for name, stage in p.STAGES:
            out = stage(spark, docs, SF)
            assert out.count() <= docs.count() + 1, name
            assert name == "best_fit_packing" or out.columns == docs.columns


def test_suffix_stage_cuts_repeated_passages(spark, docs_of, rng):
    shared = prose(rng, 150)
    rows = [(i, prose(rng, 100) + "\n" + shared + "\n" + prose(rng, 100)) for i in range(4)] + [(9, shared[:450]), (10, shared[:450])]
    got = {r["doc_id"]: r for r in p.suffix_array_dedup(spark, docs_of(rows), SF).collect()}
    assert sorted(got) == [0, 1, 2, 3]
    for i in range(4):
        assert shared[50:-50] not in got[i]["text"]
        assert got[i]["n_chars"] == len(got[i]["text"]) and rows[i][1][:300] in got[i]["text"]
