"""Sources and sinks without external systems."""

import pytest

from orderlens.sources.landing import LANDING_SCHEMAS
from orderlens.session import scratch_path
from orderlens.sources import jdbc, results


def test_ingest_copies_each_table_overwriting(spark, monkeypatch, capsys):
    """E1's write loop: one Parquet folder per table, overwrite, properties never printed.

    The JDBC read itself needs a database, which these tests do not start; it is
    replaced by a reader of in-session rows.
    """
    calls = []

    def fake_read(spark_, url, table, props, partitioning=None):
        calls.append((table, partitioning))
        rows = spark_.createDataFrame([(table, 1), (table, 2)], "source string, v int")
        name = table.removeprefix("dbo.")  # the declared columns, typed as a database has them, and two more
        return rows.selectExpr("*", *[f"cast(null AS {'int' if x in ('item_quantity', 'year') else 'string'}) AS {x}"
                                      for x in LANDING_SCHEMAS[name].fieldNames()])

    monkeypatch.setattr(jdbc, "read_table", fake_read)
    out = scratch_path(spark, "landing")
    props = {"user": "someone", "password": "s3cret"}
    part = {"order_items": jdbc.Partitioning("order_id", 4, 1, 100)}
    for _ in range(2):  # a second run replaces, not appends
        written = jdbc.ingest(spark, "jdbc:none", {"order_items": "dbo.order_items", "date_dim": "dbo.date_dim"},
                              props, out, part)
    assert set(written) == {"order_items", "date_dim"}
    back = spark.read.parquet(written["order_items"])
    assert back.count() == 2 and back.columns == [*LANDING_SCHEMAS["order_items"].fieldNames(), "source", "v"]
    assert dict(back.dtypes)["item_quantity"] == "string"  # landing types, whatever the database has
    assert calls[0] == ("dbo.order_items", part["order_items"]) and calls[1] == ("dbo.date_dim", None)
    assert "s3cret" not in capsys.readouterr().out


def test_latest_result_picks_largest_run_id(spark):
    out = scratch_path(spark, "results")
    for run, v in (("20010101000000-a", 1), ("20020101000000-b", 2), ("20011231000000-c", 3)):
        results.write_result(spark.createDataFrame([(v,)], "v int"), out, "r", run)
    assert [r.v for r in results.read_latest(spark, out, "r", schema=None).collect()] == ["2"]
    with pytest.raises(FileNotFoundError):
        results.read_latest(spark, out, "missing")


def test_jdbc_bounds_of_numbers_dates_and_times():
    import datetime as dt
    from decimal import Decimal

    import pytest

    from orderlens.sources.jdbc import as_bounds
    assert as_bounds((3, 9)) == (3, 10) and as_bounds((Decimal("2.5"), Decimal("7.5"))) == (2, 8)
    assert as_bounds((dt.date(2020, 1, 2), dt.date(2021, 1, 1))) == ("2020-01-02", "2021-01-01")
    assert as_bounds((dt.datetime(2020, 1, 2, 3), dt.datetime(2021, 1, 1))) == ("2020-01-02 03:00:00", "2021-01-01 00:00:00")
    assert as_bounds((None, None)) is None
    with pytest.raises(ValueError, match="str"):
        as_bounds(("a", "b"))
