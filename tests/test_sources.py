"""Generated rows, catalog tables, times and scalar helpers."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F, types as T

from tests import fixtures as fx
from tidemark.functions import scalars
from tidemark.session import builder, shared_dir, write_and_read
from tidemark.sources import generators, streams, tables


def test_numbered_orders(spark):
    rows = [tuple(r) for r in generators.numbered_orders(spark, 20).orderBy(F.expr("CAST(substr(orderId, 2) AS INT)")).collect()]
    assert rows[0] == ("o0", "u0", 10.0) and rows[19] == ("o19", "u3", 30.0) and len(rows) == 20


def test_skewed_events(spark):
    counts = {r["k"]: r["count"] for r in generators.skewed_events(spark, 4000).groupBy("k").count().collect()}
    assert set(counts) == {"VIP", "u1", "u2", "u3"} and 3500 < counts["VIP"] < 3700
    assert all(90 < n < 180 for k, n in counts.items() if k != "VIP")


def test_random_amounts(spark):
    values = {r["amount"] for r in generators.random_amounts(spark, 2000).collect()}
    assert values == {float(v) for v in range(5, 55)}


def test_catalog_table(spark):
    df = spark.createDataFrame(fx.ORDERS, fx.ORDERS_SCHEMA)
    tables.keep_table(df, "kept_orders")
    assert spark.table("kept_orders").count() == 12
    assert spark.catalog.tableExists("kept_orders")
    spark.sql("DROP TABLE kept_orders")


def test_zones(spark, data_dir):
    events = tables.load_table(spark, data_dir, "events")
    zoned = tables.with_zone(events)
    assert zoned.schema["ts"].dataType == T.TimestampType()
    back = tables.without_zone(zoned)
    assert back.schema == events.schema
    assert back.exceptAll(events).count() == 0


def test_order_numbers_ignore_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        times = [datetime(2024, 10, 27, h, m, 5, 123456) for h in range(4) for m in (0, 30)]
        df = spark.createDataFrame([(t,) for t in times], "ts timestamp_ntz")
        got = [r[0] for r in df.select(scalars.order_number("ts", T.TimestampNTZType())).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    epoch = datetime(1970, 1, 1)
    assert got == [(t - epoch).total_seconds() // 1 * 1_000_000 + t.microsecond for t in times]


def test_scalars(spark):
    row = spark.range(1).select(
        scalars.two_decimals(F.lit(1.005 * 100)).alias("text"),
        scalars.list_tail(F.array(*map(F.lit, (1, 2, 3))), 2).alias("tail"),
        scalars.list_tail(F.array(F.lit(1)), 2).alias("short"),
        scalars.joined(F.array(F.lit("a"), F.lit("b"))).alias("joined"),
        scalars.lookup(F.lit("x"), {}, "?").alias("unknown"),
        scalars.lookup(F.lit("u1"), fx.NAMES, "?").alias("known"),
    ).first()
    assert tuple(row) == ("100.50", [2, 3], [1], "a,b", "?", "Bob")
    lines = spark.createDataFrame([("o1", None, 2.5)], "a string, b string, c double")
    assert lines.select(scalars.csv_line("a", "b", "c")).first()[0] == "o1,,2.5"


def test_written_steps(spark):
    assert spark.conf.get("spark.checkpoint.dir") == shared_dir(spark)
    df = spark.createDataFrame([(1, date(2024, 1, 1))], "a int, d date")
    again = write_and_read(df)
    assert again.collect() == df.collect() and again.schema == df.schema
    assert shared_dir(spark) in again.inputFiles()[0]


def test_file_times(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "t"))
    stamped = streams.with_file_time(spark.read.parquet(str(tmp_path / "t")))
    assert stamped.where("event_time IS NULL").count() == 0
    assert dict(stamped.dtypes)["event_time"] == "timestamp"


def test_cluster_settings():
    options = builder("x", cores=4000)._options
    assert options["spark.sql.shuffle.partitions"] == "32000"
