"""F11-F22 (loading job): work per line that grows with the landing is done once, in generated code."""

from pyspark.sql import functions as F

from orderlens import schemas
from orderlens.functions.dates import ISO_UTC_FORMAT, parse_iso_utc
from orderlens.operators import conform, rejects
from orderlens.sources import testdata

SF = "/root/testdata/sf0.001"
TIME = "2001-06-01T12:34:56.789Z"


def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_times_equal_the_parse_by_format(spark):
    texts = [TIME, None, "", f"{TIME}\n", f" {TIME}", f"{TIME} ", TIME[:-1], TIME.replace("T", " "), f"1{TIME}", f"-{TIME}",
             "0000-01-01T00:00:00.000Z", "0001-01-01T00:00:00.000Z", "9999-12-31T23:59:59.999Z", "1582-10-10T00:00:00.000Z",
             "2001-02-29T00:00:00.000Z", "2000-02-29T00:00:00.000Z", "2001-13-01T00:00:00.000Z", "2001-01-00T00:00:00.000Z",
             "2001-01-01T24:00:00.000Z", "2001-01-01T23:60:00.000Z", "2001-01-01T23:59:60.000Z", "2001-1-1T00:00:00.000Z",
             "2001-06-01T12:34:56.78Z", "2021-03-28T02:30:00.000Z", "yesterday", "٢001-06-01T12:34:56.789Z"]
    by_format = F.try_to_timestamp("t", F.lit(ISO_UTC_FORMAT)).cast("timestamp_ntz")
    for zone in ("UTC", "Europe/Berlin"):
        own = spark.newSession()
        own.conf.set("spark.sql.session.timeZone", zone)
        rows = own.createDataFrame([(t,) for t in texts], "t string").select(
            "t", by_format.cast("string").alias("want"), parse_iso_utc("t").cast("string").alias("got")).collect()
        assert [r.got for r in rows] == [r.want for r in rows]
        assert sum(r.got is not None for r in rows) >= 5


def test_usual_times_are_not_parsed_by_format(spark):
    df = spark.createDataFrame([(TIME,)], "t string").select(parse_iso_utc("t"))
    assert "RLIKE" in _plan(df)


def test_reasons_are_found_in_generated_code(spark):
    rows = [("1", "1", "x", "many", "1,5"), (None, "2", TIME, "2", "1.5"), ("3", "3", TIME, "2", "1.5"), ("4", None, None, None, None)]
    df = spark.createDataFrame(rows, "order_id string, lineitem_id string, creation_time_utc string, "
                                     "item_quantity string, item_price string")
    flagged = rejects.flagged(df, "order_items")
    assert [r[rejects.REASONS] for r in flagged.collect()] == [
        ["creation_time_utc is not a time", "item_quantity is not a whole number", "item_price is not a price"],
        ["order_id is missing"], [], ["lineitem_id is missing"]]
    counted = conform.conform_orders(flagged).agg(*rejects.counts("order_items"))
    assert counted.first().asDict() == {"rows": 4, "rejected": 3, "creation_time_utc": 1, "item_quantity": 1, "item_price": 1}
    assert "lambda" not in _plan(counted)


def test_time_text_is_made_once_an_order(spark):
    plan = _plan(testdata.order_items_source(spark, SF)).splitlines()
    made = next(i for i, x in enumerate(plan) if "date_format" in x)
    assert any("Join" in x for x in plan[:made])
    assert testdata.order_items_source(spark, SF).columns == schemas.ORDER_ITEMS.fieldNames()
