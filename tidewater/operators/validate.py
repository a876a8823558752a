"""Validation of raw data against a declared schema, in one aggregate pass.

The per-column checks (column present, values conform to the declared type,
column not entirely NULL, required columns without NULLs) are all counters, so
they fold into a single ``agg`` over the data: one scan, map-side partial
aggregation, and a shuffle of one tiny row per task (per group when a partition
column is given). The result is a long report table; :func:`raise_for_report`
turns it into the fail-fast errors of the original loader, in its order
(missing columns, then types, then required fields).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DataType, DateType, NumericType, StringType, StructType, TimestampNTZType, TimestampType,
)

from tidewater.schema import build_struct, is_compatible, required_fields, types_equal

def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _conform_type(dt: DataType) -> str:
    if isinstance(dt, TimestampType):
        return "timestamp_ntz"
    return dt.simpleString()


def _is_num(dt: DataType) -> bool:
    return isinstance(dt, NumericType)


def _is_time(dt: DataType) -> bool:
    return isinstance(dt, (DateType, TimestampType, TimestampNTZType))


def _unparseable(c: Column, declared: DataType) -> Column:
    """Present value that does not parse as the declared raw type."""
    if isinstance(declared, StringType):
        return F.lit(False)
    if isinstance(declared, StructType) or declared.typeName() in ("array", "map", "binary"):
        return c.isNotNull()
    if isinstance(declared, (TimestampType, TimestampNTZType)):
        return c.isNotNull() & c.try_cast("timestamp_ntz").isNull()
    return c.isNotNull() & c.try_cast(_conform_type(declared)).isNull()


def _plan_checks(df: DataFrame, fields: list[dict], strict: bool, relaxed: bool):
    """Aggregate expressions for every check, plus the metadata to read them back."""
    struct = build_struct(fields)
    required = required_fields(fields)
    actual = {f.name: f.dataType for f in df.schema.fields}
    aggs = [F.count(F.lit(1)).alias("__rows")]
    checks = []  # (check_name, column, agg alias or None for 'all rows')
    for f in struct.fields:
        if f.name not in actual:
            checks.append(("missing_column", f.name, "__rows"))
            continue
        c = F.col(_q(f.name))
        nn = f"__nn_{len(aggs)}"
        aggs.append(F.count(c).alias(nn))
        checks.append(("all_null", f.name, nn))
        a = actual[f.name]
        if relaxed and (types_equal(f.dataType, a) or is_compatible(f.dataType, a)):
            bad = F.lit(False)  # workbooks: the compatibility lattice decides, values are not checked
        elif isinstance(a, StringType):
            bad = _unparseable(c, f.dataType)
        elif types_equal(f.dataType, a) or (relaxed and is_compatible(f.dataType, a)):
            bad = F.lit(False)
        elif strict:
            bad = c.isNotNull()
        elif isinstance(f.dataType, StringType):
            bad = F.lit(False)
        elif _is_num(f.dataType) and _is_num(a):
            bad = c.isNotNull() & c.try_cast(_conform_type(f.dataType)).isNull()
        elif _is_time(f.dataType) and _is_time(a):
            bad = F.lit(False)
        else:
            bad = c.isNotNull()
        alias = f"__bad_{len(aggs)}"
        aggs.append(F.count_if(bad).alias(alias))
        checks.append(("unparseable", f.name, alias))
    for r in required:
        if r not in actual:
            continue
        c = F.col(_q(r))
        alias = f"__null_{len(aggs)}"
        aggs.append(F.count_if(c.isNull()).alias(alias))
        checks.append(("required_null", r, alias))
        if isinstance(actual[r], StringType):
            alias2 = f"__empty_{len(aggs)}"
            aggs.append(F.count_if(c == F.lit("")).alias(alias2))
            checks.append(("required_empty", r, alias2))
    return aggs, checks


def profile(df: DataFrame, fields: list[dict], by: list[str] | None = None,
            strict: bool = False, relaxed: bool = False, keep=None) -> DataFrame:
    """Long profile table: one row per (group, check, column) with its count.

    ``check_name`` is one of missing_column, all_null (value = non-NULL count),
    unparseable, required_null, required_empty. ``keep`` (a function of the row
    struct with fields check_name, column_name, value) selects rows before they
    are generated -- a Filter node over this wide aggregate would make
    Catalyst's constraint inference very slow for schemas with many columns.
    """
    by = by or []
    aggs, checks = _plan_checks(df, fields, strict, relaxed)
    agg = df.groupBy(*[F.col(_q(b)) for b in by]).agg(*aggs) if by else df.agg(*aggs)
    # Unpivot with one array of counters zipped with two constant arrays of
    # labels (constant-folded to literals): small generated code even for
    # hundreds of columns.
    rows = F.arrays_zip(
        F.array(*[F.lit(name) for name, _, _ in checks]).alias("check_name"),
        F.array(*[F.lit(col) for _, col, _ in checks]).alias("column_name"),
        F.array(*[F.col(alias).cast("bigint") for _, _, alias in checks]).alias("value"))
    if keep is not None:
        rows = F.filter(rows, keep)
    return agg.select(*[F.col(_q(b)) for b in by], F.col("__rows").cast("bigint").alias("total_rows"),
                      F.inline(rows)).select(*[F.col(_q(b)) for b in by], "check_name", "column_name",
                                             "value", "total_rows")


FAILURES = ("missing_column", "unparseable", "required_null")


def validation_report(df: DataFrame, fields: list[dict], by: list[str] | None = None,
                      strict: bool = False, relaxed: bool = False) -> DataFrame:
    """Failures only: (check_name, column_name, bad_rows) [+ group columns].

    A column that is entirely NULL has no present value, so it can never count
    as unparseable -- the original loader's "skip all-NULL columns" rule holds
    without a second pass.
    """
    by = by or []
    keep = lambda r: r["check_name"].isin(*FAILURES) & (r["value"] > 0)
    p = profile(df, fields, by, strict, relaxed, keep=keep)
    return p.select(*by, "check_name", "column_name", F.col("value").alias("bad_rows"))


def type_conformance(df: DataFrame, fields: list[dict], by: list[str] | None = None) -> DataFrame:
    """Per typed column: rows scanned and values that do not parse as the declared type."""
    by = by or []
    struct = build_struct(fields)
    typed = [f.name for f in struct.fields if not isinstance(f.dataType, StringType)]
    keep = lambda r: (r["check_name"] == "unparseable") & r["column_name"].isin(*typed)
    p = profile(df, fields, by, keep=keep)
    return p.select(*by, "column_name", F.col("total_rows"), F.col("value").alias("bad_rows"))


def required_nulls(df: DataFrame, fields: list[dict], by: list[str] | None = None) -> DataFrame:
    """Per required column: NULL count and (for text) empty-string count, one pass."""
    by = by or []
    actual = {f.name: f.dataType for f in df.schema.fields}
    req = [r for r in required_fields(fields) if r in actual]
    aggs = []
    for i, r in enumerate(req):
        c = F.col(_q(r))
        aggs.append(F.count_if(c.isNull()).alias(f"__n{i}"))
        empty = F.count_if(c == F.lit("")) if isinstance(actual[r], StringType) else F.lit(0).cast("bigint")
        aggs.append(empty.alias(f"__e{i}"))
    if not aggs:
        return df.sparkSession.createDataFrame([], "column_name string, null_rows bigint, empty_rows bigint")
    agg = df.groupBy(*[F.col(_q(b)) for b in by]).agg(*aggs) if by else df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(r).alias("column_name"), F.col(f"__n{i}").alias("null_rows"),
                              F.col(f"__e{i}").cast("bigint").alias("empty_rows"))
                     for i, r in enumerate(req)])
    return agg.select(*[F.col(_q(b)) for b in by], F.inline(rows))


def all_null_columns(df: DataFrame, fields: list[dict] | None = None, by: list[str] | None = None) -> DataFrame:
    """Columns without a single non-NULL value (all columns when no schema is given)."""
    by = by or []
    if fields is None:
        fields = [{"name": c, "type": "string"} for c in df.columns if c not in by]
    keep = lambda r: (r["check_name"] == "all_null") & (r["value"] == 0)
    return profile(df, fields, by, keep=keep).select(*by, "column_name")


def raise_for_report(rows, required_message: bool = True) -> None:
    """Raise the first failure in check order: missing columns, types, required fields."""
    rows = [r.asDict() if hasattr(r, "asDict") else dict(r) for r in rows]
    missing = [r["column_name"] for r in rows if r["check_name"] == "missing_column" and r["bad_rows"] > 0]
    if missing:
        raise ValueError(f"Missing fields in DataFrame: {missing}")
    for r in rows:
        if r["check_name"] == "unparseable" and r["bad_rows"] > 0:
            raise TypeError(f"Data type mismatch for field {r['column_name']}: "
                            f"{r['bad_rows']} values do not match the declared type.")
    for r in rows:
        if r["check_name"] == "required_null" and r["bad_rows"] > 0:
            raise ValueError(f"Required field {r['column_name']} has {r['bad_rows']} null or empty values.")
