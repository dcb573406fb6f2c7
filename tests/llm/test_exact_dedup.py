import hashlib
import re

import pytest

from orderlens.llm import common as c, exact_dedup
from tests.llm.conftest import prose

SPACE = re.compile(r"[\x20\x09-\x0D]")


def brute(rows):
    groups, out = {}, []
    for i, t in rows:
        groups.setdefault(SPACE.sub("", t or ""), []).append((-len(t or ""), i is None, i))
    for norm, members in groups.items():
        members.sort()
        sha = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, members[0][2], len(members), x == 0, sha) for x, (_, _, i) in enumerate(members)]
    return sorted(out, key=str)


def result(df):
    return sorted((tuple(r) for r in exact_dedup.exact_duplicates(df).collect()), key=str)


@pytest.fixture
def slices(spark):
    before = {k: spark.conf.get(k) for k in (c.ARROW_ROWS, "spark.sql.shuffle.partitions",
                                             "spark.sql.adaptive.coalescePartitions.enabled")}
    for k, v in zip(before, ("3", "11", "false"), strict=True):
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def test_equals_brute_force_with_groups_over_many_slices(spark, docs_of, rng, slices):
    rows = [(0, None), (1, ""), (2, " \n\t\r\x0b\x0c"), (3, " "), (4, "a b")]
    rows += [(10 + i, prose(rng, 1 + i % 40)) for i in range(60)]
    rows += [(100 + i, "the same passage " + " " * (i % 7)) for i in range(80)]  # most rows: over slices
    rows += [(300 + i, ("the same passag" if i % 2 else "the\nsame passage, longer") + " x" * (i % 3)) for i in range(30)]
    rows += [(400, "x" * 300_000), (401, "x" * 300_000 + " "), (402, "x" * 299_999 + "y")]
    rng.shuffle(rows)
    df = docs_of(rows).repartition(5)
    assert exact_dedup._sorted_contents(df).rdd.getNumPartitions() > 5
    assert result(df) == brute(rows)


def test_all_rows_equal_spread_and_are_joined(docs_of, slices):
    rows = [(i, "same" + " " * (i % 3)) for i in range(200)]
    df = docs_of(rows).repartition(4)
    got = c.written(exact_dedup._sorted_contents(df).mapInArrow(exact_dedup._runs, exact_dedup._ROWS), "runs")
    per = [r["count"] for r in got.filter("edge is null").groupBy("slice").count().collect()]
    assert len(per) > 5 and max(per) < 80  # no slice holds the group
    assert result(df) == brute(rows)


def test_repeated_rows_null_ids_and_empty_tables(docs_of, slices):
    rows = [(3, "a b"), (3, "a b"), (3, "ab"), (None, "a  b"), (None, "only null"), (None, "onlynull"), (5, "c")]
    assert result(docs_of(rows)) == brute(rows)
    assert result(docs_of([])) == []


def test_oracle_statement_agrees(spark, docs_of, duck, rng):
    import duckdb
    rows = [(i, prose(rng, i % 5) + " \t" * (i % 3)) for i in range(60)] + [(70, None), (71, "　 é ")]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    assert sorted(con.execute(exact_dedup.ORACLE_SQL).fetchall(), key=str) == result(docs_of(rows))
