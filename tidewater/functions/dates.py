"""Calendar arithmetic for load windows, as Column expressions.

"Today" is always an argument (a column or literal), never ``current_date()``
inside a query, so re-running a plan gives the same partitions.
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) -------------------------
LOCAL_TZ = "America/Bogota"
DAY = "DAY_PRECISION"
MONTH = "MONTH_PRECISION"
DAY_FMT = "yyyy-MM-dd"
MONTH_FMT = "yyyy-MM"
# -----------------------------------------------------------------------------


def _c(x) -> Column:
    if isinstance(x, Column):
        return x
    return F.lit(x)


def today_local(now_utc: datetime | None = None, tz: str = LOCAL_TZ) -> str:
    """Today's date in the local zone (driver side; the plan's "today")."""
    now_utc = now_utc or datetime.now(timezone.utc)
    try:
        from zoneinfo import ZoneInfo
        zone = ZoneInfo(tz)
    except Exception:  # no time zone database: Bogota has been UTC-5 without DST since 1993
        zone = timezone(timedelta(hours=-5))
    return now_utc.astimezone(zone).strftime("%Y-%m-%d")


def local_date(ts_utc: Column | str, tz: str = LOCAL_TZ) -> Column:
    """Calendar date in ``tz`` of a UTC wall-clock timestamp (NTZ in, DATE out)."""
    ts = F.col(ts_utc) if isinstance(ts_utc, str) else ts_utc
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(tz), ts.cast("timestamp_ntz")))


def previous_day(today) -> Column:
    return F.date_format(F.date_sub(F.to_date(_c(today)), 1), DAY_FMT)


def previous_month(today) -> Column:
    return F.date_format(F.add_months(F.trunc(F.to_date(_c(today)), "MM"), -1), MONTH_FMT)


def previous_period(today, date_type: str) -> Column:
    """Yesterday as ``yyyy-MM-dd`` or the previous month as ``yyyy-MM``."""
    if date_type == MONTH:
        return previous_month(today)
    if date_type == DAY:
        return previous_day(today)
    raise ValueError(f"[ERROR] Invalid date_type '{date_type}'")


def parse_month(x) -> Column:
    """``yyyy-MM`` (or ``yyyy-MM-dd``, cut to the month) -> first day of month; else NULL."""
    s = _c(x).cast("string")
    cut = F.when(F.length(s) == 10, F.substring(s, 1, 7)).otherwise(s)
    return F.when(F.length(cut) == 7, F.to_date(F.try_to_timestamp(cut, F.lit(MONTH_FMT))))


def parse_day(x) -> Column:
    """``yyyy-MM-dd`` -> date; other lengths or bad text -> NULL."""
    s = _c(x).cast("string")
    return F.when(F.length(s) == 10, F.to_date(F.try_to_timestamp(s, F.lit(DAY_FMT))))


def parse_period(x, date_type: str) -> Column:
    if date_type == MONTH:
        return parse_month(x)
    if date_type == DAY:
        return parse_day(x)
    raise ValueError(f"[ERROR] Invalid date_type '{date_type}'")


def period_range(start, end, date_type: str) -> Column:
    """Inclusive list of partition values between two period strings.

    DAY -> ``yyyy-MM-dd`` strings, MONTH -> ``yyyy-MM`` strings. An inverted
    range yields an empty array (callers turn that into an error where required).
    """
    s = parse_period(start, date_type)
    e = parse_period(end, date_type)
    step = F.expr("INTERVAL 1 DAY") if date_type == DAY else F.expr("INTERVAL 1 MONTH")
    fmt = DAY_FMT if date_type == DAY else MONTH_FMT
    seq = F.when(s <= e, F.sequence(s, e, step)).otherwise(F.array().cast("array<date>"))
    return F.transform(seq, lambda d: F.date_format(d, fmt))


def incremental_window(today, date_type: str) -> tuple[Column, Column]:
    """(start, end) dates of the incremental load: yesterday twice, or the previous month."""
    t = F.to_date(_c(today))
    if date_type == DAY:
        y = F.date_sub(t, 1)
        return y, y
    if date_type == MONTH:
        first_this = F.trunc(t, "MM")
        return F.add_months(first_this, -1), F.date_sub(first_this, 1)
    raise ValueError("Invalid date_type. Expected 'DAY_PRECISION' or 'MONTH_PRECISION'.")


def full_window(start, end, date_type: str) -> tuple[Column, Column]:
    """(start, end) dates of a FULL load.

    MONTH expects ``yyyy-MM`` and spans first day of the start month to the last
    day of the end month; DAY expects ``yyyy-MM-dd`` and is the identity. Bad
    input gives NULLs.
    """
    if date_type == MONTH:
        s = _c(start).cast("string")
        e = _c(end).cast("string")
        sd = F.when(F.length(s) == 7, F.to_date(F.try_to_timestamp(s, F.lit(MONTH_FMT))))
        ed = F.when(F.length(e) == 7, F.last_day(F.to_date(F.try_to_timestamp(e, F.lit(MONTH_FMT)))))
    elif date_type == DAY:
        sd = F.to_date(F.try_to_timestamp(_c(start).cast("string"), F.lit(DAY_FMT)))
        ed = F.to_date(F.try_to_timestamp(_c(end).cast("string"), F.lit(DAY_FMT)))
    else:
        raise ValueError("Invalid date_type. Expected 'MONTH_PRECISION' or 'DAY_PRECISION'.")
    ok = sd <= ed
    return F.when(ok, sd), F.when(ok, ed)
