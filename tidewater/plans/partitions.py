"""Partition plans: which raw partitions a load reads.

A plan is computed for a whole table of job configurations at once (one row
per dataset), so planning scales with the number of datasets, not with
driver-side loops. First matching rule wins:

1. an explicit file name -> that file;
2. a raw key ``add_<key>`` -> today's period (the raw data carries no partition
   column; the loader adds it);
3. FULL -> every period from start to end;
4. INC -> the previous period.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import DAY, DAY_FMT, MONTH, MONTH_FMT, period_range, previous_day, previous_month


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def plan_partitions(configs: DataFrame, today, process_type="process_type", date_type="date_type",
                    start_date="start_date", end_date="end_date", partition_key_raw="partition_key_raw",
                    file_name="file_name_excel") -> DataFrame:
    """Adds ``partitions`` (array<string>), ``partition_key`` (raw key, ``add_`` cut)
    and ``plan_error`` (text when the configuration is invalid) to each config row."""
    pt, dt = _c(process_type), _c(date_type)
    key = _c(partition_key_raw)
    fname = F.trim(F.coalesce(_c(file_name), F.lit("")))
    today_c = today if isinstance(today, Column) else F.lit(today)
    is_add = F.lower(key).startswith("add_")
    today_period = (F.when(dt == DAY, F.date_format(F.to_date(today_c), DAY_FMT))
                     .when(dt == MONTH, F.date_format(F.to_date(today_c), MONTH_FMT)))
    prev = F.when(dt == DAY, previous_day(today_c)).when(dt == MONTH, previous_month(today_c))
    full_day = period_range(_c(start_date), _c(end_date), DAY)
    full_month = period_range(_c(start_date), _c(end_date), MONTH)
    full = F.when(dt == DAY, full_day).when(dt == MONTH, full_month)
    has_dates = (F.coalesce(_c(start_date), F.lit("")) != "") & (F.coalesce(_c(end_date), F.lit("")) != "")
    partitions = (F.when(fname != "", F.array(fname))
                   .when(is_add & pt.isin("FULL", "INC") & today_period.isNotNull(), F.array(today_period))
                   .when((pt == "FULL") & has_dates & (F.size(full) > 0), full)
                   .when((pt == "INC") & prev.isNotNull(), F.array(prev)))
    error = (F.when(fname != "", F.lit(None))
              .when(is_add & ~pt.isin("FULL", "INC"), F.concat(F.lit("Invalid process_type: "), pt))
              .when(is_add & today_period.isNull(), F.concat(F.lit("Invalid date_type: "), dt))
              .when(is_add, F.lit(None))
              .when((pt == "FULL") & ~has_dates, F.lit("start_date and end_date must be provided for FULL process_type"))
              .when((pt == "FULL") & ~dt.isin(DAY, MONTH), F.concat(F.lit("[ERROR] Invalid date_type '"), dt, F.lit("'")))
              .when((pt == "FULL") & (dt == DAY) & ((F.length(_c(start_date)) != 10) | (F.length(_c(end_date)) != 10)),
                    F.lit("[ERROR] DAY_PRECISION requires format YYYY-MM-DD"))
              .when((pt == "FULL") & (dt == MONTH) & (~F.length(_c(start_date)).isin(7, 10)
                                                      | ~F.length(_c(end_date)).isin(7, 10)),
                    F.lit("[ERROR] MONTH_PRECISION requires format YYYY-MM"))
              .when((pt == "FULL") & (F.size(full) <= 0), F.lit("[ERROR] Start date cannot be greater than end date."))
              .when((pt == "INC") & prev.isNull(), F.concat(F.lit("[ERROR] Invalid date_type '"), dt, F.lit("'")))
              .when(~pt.isin("FULL", "INC"), F.concat(F.lit("Invalid process_type: "), pt)))
    part_key = F.when(is_add, F.substring(key, 5, 1 << 20)).otherwise(key)
    return configs.withColumns({"partitions": partitions, "partition_key": part_key, "plan_error": error})


def explode_plan(planned: DataFrame, *keep: str, value_col: str = "partition_value") -> DataFrame:
    """One row per (config, planned partition)."""
    return planned.select(*keep, F.explode("partitions").alias(value_col))
