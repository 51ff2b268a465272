"""BatchWindow helpers and windowed reads."""

import datetime as dt

from pyspark.sql import functions as F

from tillroll.functions.window import BatchWindow, since, windowed, windowed_days


def test_window_days(spark):
    w = BatchWindow("2024-01-08", "2024-01-10", "2024-01-30")
    row = spark.range(1).select(w.first_day.alias("a"), w.last_day.alias("b"), w.today.alias("c")).first()
    assert (row.a, row.b, row.c) == (dt.date(2024, 1, 8), dt.date(2024, 1, 9), dt.date(2024, 1, 30))
    prev = BatchWindow.days_before(w, 1)
    assert (prev.date, prev.date_next, prev.as_of) == ("2024-01-07", "2024-01-08", "2024-01-30")


def test_windowed_adds_partition_bounds_only_for_its_day_column(spark):
    T = dt.datetime
    rows = [(1, T(2024, 1, 7, 23, 59), dt.date(2024, 1, 7)), (2, T(2024, 1, 8), dt.date(2024, 1, 8)),
            (3, T(2024, 1, 9, 12), dt.date(2024, 1, 9)), (4, T(2024, 1, 10), dt.date(2024, 1, 10))]
    df = spark.createDataFrame(rows, "id long, ts timestamp_ntz, ts__day date")
    w = BatchWindow("2024-01-08", "2024-01-10")
    assert sorted(r.id for r in windowed(df, "ts", w).collect()) == [2, 3]
    plan = windowed(df, "ts", w)._jdf.queryExecution().optimizedPlan().toString()
    assert "ts__day" in plan
    other = df.withColumnRenamed("ts__day", "other__day")
    filters = [
        line for line in windowed(other, "ts", w)._jdf.queryExecution().optimizedPlan().toString().split("\n")
        if "Filter" in line
    ]
    assert filters and not any("__day" in line for line in filters)
    half = BatchWindow("2024-01-08 12:00:00", "2024-01-09 06:00:00")
    assert sorted(r.id for r in windowed_days(df, "ts", half).collect()) == [2, 3]
    assert sorted(r.id for r in since(df.select("id", F.to_date("ts").alias("d")), "d", F.lit("2024-01-09").cast("date")).collect()) == [3, 4]
