import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidewater.functions import dates
from tidewater.plans import partitions


def _range(spark, s, e, t):
    return spark.range(1).select(dates.period_range(F.lit(s), F.lit(e), t)).first()[0]


@pytest.mark.parametrize("s, e, t, expected", [
    ("2024-01", "2024-03", dates.MONTH, ["2024-01", "2024-02", "2024-03"]),
    ("2024-01-01", "2024-01-03", dates.DAY, ["2024-01-01", "2024-01-02", "2024-01-03"]),
    ("2024-01", "2024-01", dates.MONTH, ["2024-01"]),
    ("2024-01-15", "2024-01-15", dates.DAY, ["2024-01-15"]),
    ("2023-12", "2024-02", dates.MONTH, ["2023-12", "2024-01", "2024-02"]),
    ("2024-01-30", "2024-02-02", dates.DAY, ["2024-01-30", "2024-01-31", "2024-02-01", "2024-02-02"]),
    ("2024-01-15", "2024-03-20", dates.MONTH, ["2024-01", "2024-02", "2024-03"]),
])
def test_period_range_golden(spark, s, e, t, expected):
    assert _range(spark, s, e, t) == expected


def test_period_range_inverted_or_bad(spark):
    assert _range(spark, "2024-02", "2024-01", dates.MONTH) == []
    assert spark.range(1).select(dates.parse_day(F.lit("2024-01"))).first()[0] is None


def test_previous_period(spark):
    r = spark.range(1).select(dates.previous_period(F.lit("2023-06-15"), dates.DAY),
                              dates.previous_period(F.lit("2023-01-15"), dates.MONTH)).first()
    assert tuple(r) == ("2023-06-14", "2022-12")
    with pytest.raises(ValueError, match="Invalid date_type 'DAILY'"):
        dates.previous_period(F.lit("2023-06-15"), "DAILY")


@pytest.mark.parametrize("today, t, start, end", [
    ("2023-06-15", dates.DAY, "2023-06-14", "2023-06-14"),
    ("2023-06-15", dates.MONTH, "2023-05-01", "2023-05-31"),
    ("2023-01-15", dates.MONTH, "2022-12-01", "2022-12-31"),
    ("2023-03-15", dates.MONTH, "2023-02-01", "2023-02-28"),
    ("2024-03-15", dates.MONTH, "2024-02-01", "2024-02-29"),
])
def test_incremental_window_golden(spark, today, t, start, end):
    s, e = dates.incremental_window(F.lit(today), t)
    r = spark.range(1).select(F.date_format(s, "yyyy-MM-dd"), F.date_format(e, "yyyy-MM-dd")).first()
    assert tuple(r) == (start, end)


@pytest.mark.parametrize("a, b, t, start, end", [
    ("2023-06-15", "2023-06-15", dates.DAY, "2023-06-15", "2023-06-15"),
    ("2023-06-25", "2023-07-05", dates.DAY, "2023-06-25", "2023-07-05"),
    ("2023-12-28", "2024-01-05", dates.DAY, "2023-12-28", "2024-01-05"),
    ("2023-06", "2023-06", dates.MONTH, "2023-06-01", "2023-06-30"),
    ("2023-03", "2023-06", dates.MONTH, "2023-03-01", "2023-06-30"),
    ("2023-02", "2023-02", dates.MONTH, "2023-02-01", "2023-02-28"),
    ("2024-02", "2024-02", dates.MONTH, "2024-02-01", "2024-02-29"),
    ("2023-12", "2023-12", dates.MONTH, "2023-12-01", "2023-12-31"),
    ("2023-11", "2024-02", dates.MONTH, "2023-11-01", "2024-02-29"),
    ("2023-01", "2023-12", dates.MONTH, "2023-01-01", "2023-12-31"),
])
def test_full_window_golden(spark, a, b, t, start, end):
    s, e = dates.full_window(F.lit(a), F.lit(b), t)
    r = spark.range(1).select(F.date_format(s, "yyyy-MM-dd"), F.date_format(e, "yyyy-MM-dd")).first()
    assert tuple(r) == (start, end)


def test_full_window_inverted_is_null(spark):
    s, e = dates.full_window(F.lit("2023-06"), F.lit("2023-05"), dates.MONTH)
    assert tuple(spark.range(1).select(s, e).first()) == (None, None)


def test_local_date_bogota(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 3, 0),), (dt.datetime(2024, 1, 1, 6, 0),)], "ts timestamp_ntz")
    assert [r[0] for r in df.select(dates.local_date("ts")).collect()] == [dt.date(2023, 12, 31), dt.date(2024, 1, 1)]
    assert dates.today_local(dt.datetime(2025, 1, 15, 4, 0, tzinfo=dt.timezone.utc)) == "2025-01-14"


def test_partition_plan_rules(spark):
    cfg = spark.createDataFrame([
        ("file", "FULL", dates.DAY, "2025-01-01", "2025-01-02", "fecha", "data/x.xlsx"),
        ("add", "INC", dates.MONTH, None, None, "add_mes", None),
        ("full", "FULL", dates.DAY, "2025-01-30", "2025-02-01", "fecha", None),
        ("inc", "INC", dates.DAY, None, None, "fecha", None),
        ("nodates", "FULL", dates.DAY, None, None, "fecha", None),
        ("inverted", "FULL", dates.MONTH, "2025-02", "2025-01", "mes", None),
        ("badtype", "DELTA", dates.DAY, None, None, "fecha", None),
    ], "id string, process_type string, date_type string, start_date string, end_date string, "
       "partition_key_raw string, file_name_excel string")
    rows = {r["id"]: r for r in partitions.plan_partitions(cfg, "2025-01-15").collect()}
    assert rows["file"]["partitions"] == ["data/x.xlsx"]
    assert rows["add"]["partitions"] == ["2025-01"] and rows["add"]["partition_key"] == "mes"
    assert rows["full"]["partitions"] == ["2025-01-30", "2025-01-31", "2025-02-01"]
    assert rows["inc"]["partitions"] == ["2025-01-14"]
    assert rows["nodates"]["partitions"] is None and "must be provided" in rows["nodates"]["plan_error"]
    assert rows["inverted"]["partitions"] is None and "greater" in rows["inverted"]["plan_error"]
    assert rows["badtype"]["plan_error"] == "Invalid process_type: DELTA"
    assert rows["full"]["plan_error"] is None


from hypothesis import given, settings, strategies as st  # noqa: E402


def _py_months(a: dt.date, b: dt.date):
    out, y, m = [], a.year, a.month
    while (y, m) <= (b.year, b.month):
        out.append(f"{y:04d}-{m:02d}")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


@given(st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2030, 12, 31)), st.integers(0, 400))
@settings(max_examples=20, deadline=None)
def test_period_range_property(spark, start, span):
    end = start + dt.timedelta(days=span)
    days = _range(spark, start.isoformat(), end.isoformat(), dates.DAY)
    assert days == [(start + dt.timedelta(days=i)).isoformat() for i in range(span + 1)]
    months = _range(spark, start.isoformat()[:7], end.isoformat()[:7], dates.MONTH)
    assert months == _py_months(start, end)


def test_plan_format_errors(spark):
    cfg = spark.createDataFrame([
        ("d", "FULL", dates.DAY, "2024-01", "2024-02", "fecha", None),
        ("m", "FULL", dates.MONTH, "2024", "2024-02", "mes", None),
        ("y", "FULL", "YEAR_PRECISION", "2024", "2025", "x", None),
    ], "id string, process_type string, date_type string, start_date string, end_date string, "
       "partition_key_raw string, file_name_excel string")
    rows = {r["id"]: r["plan_error"] for r in partitions.plan_partitions(cfg, "2025-01-15").collect()}
    assert rows == {"d": "[ERROR] DAY_PRECISION requires format YYYY-MM-DD",
                    "m": "[ERROR] MONTH_PRECISION requires format YYYY-MM",
                    "y": "[ERROR] Invalid date_type 'YEAR_PRECISION'"}
