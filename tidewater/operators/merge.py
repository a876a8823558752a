"""Upsert, partition overwrite and schema evolution as DataFrame plans.

These are the *logical* results of the staging writes; ``sinks.table`` applies
them to stored tables, rewriting only the partitions they touch.

Scale notes
* ``merge_upsert`` is one anti join on the merge keys plus a union. Spark
  picks broadcast (source below ``autoBroadcastJoinThreshold``, measured at
  runtime by AQE) or a sort-merge join; a target key that is hot is split by
  AQE's skew-join handling, which supports left-anti joins.
* Partition overwrite anti-joins on the *distinct partition values* of the
  source, pre-aggregated before the shuffle, so the build side is bounded by
  the number of partitions, not by the number of rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType, ByteType, DataType, DecimalType, DoubleType, FloatType, IntegerType, LongType, MapType, ShortType, StructField, StructType,
)


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def parse_merge_keys(keys) -> list[str] | None:
    """Merge keys from comma text or a list; ``none`` (any case) means overwrite -> None."""
    if keys is None:
        raise ValueError("merge keys are required (use 'none' for partition overwrite)")
    if isinstance(keys, str):
        if keys.strip().lower() == "none":
            return None
        out = [k.strip() for k in keys.split(",") if k.strip()]
    else:
        out = [k.strip() for k in keys if isinstance(k, str) and k.strip()]
    if not out or out in (["''"], ['""'], ["null"], ["NULL"], ["None"]):
        raise ValueError("merge keys are required (use 'none' for partition overwrite)")
    return out


def merge_upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """MERGE ... WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *.

    Target rows whose key appears in the source are replaced by the source row;
    other source rows are inserted. NULL keys never match (they are inserted).
    Columns present on one side only are NULL on the other.
    """
    src_keys = source.select(*[F.col(_q(k)) for k in keys]).where(
        F.lit(True) if not keys else F.expr(" AND ".join(f"{_q(k)} IS NOT NULL" for k in keys)))
    kept = target.join(src_keys, on=keys, how="left_anti").select(*[F.col(_q(c)) for c in target.columns])
    return kept.unionByName(source, allowMissingColumns=True)


def duplicate_keys(source: DataFrame, keys: list[str], *more) -> DataFrame:
    """Keys carried by more than one source row (MERGE would be ambiguous).

    Rows with a NULL key never match, so they are not duplicates. Partial
    aggregation runs map-side, so a hot key costs one row per task. ``more`` aggregates come along.
    """
    not_null = F.lit(True)
    for k in keys:
        not_null = not_null & F.col(_q(k)).isNotNull()
    return (source.where(not_null).groupBy(*[F.col(_q(k)) for k in keys]).agg(F.count(F.lit(1)).alias("n"), *more)
                  .where(F.col("n") > 1))


LAST = "__last"


def repeated_keys(source: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Keys of more than one row, with the last load partition (``order``) each occurs in. NULL keys are left out.

    Reads the key and order columns only and aggregates map-side.
    """
    return duplicate_keys(source, keys, F.max(F.col(_q(order))).alias(LAST)).drop("n")


def without_superseded(source: DataFrame, repeats: DataFrame, keys: list[str], order: str) -> DataFrame:
    """Rows of ``source`` but those whose key comes again in a later load partition, as if the partitions
    were merged one after another. ``repeats`` is ``repeated_keys`` of it, best read from a written table."""
    later = repeats.select(*[F.col(_q(k)).alias(f"__k{i}") for i, k in enumerate(keys)], LAST)
    cond = F.col(_q(order)) < F.col(LAST)
    for i, k in enumerate(keys):
        cond = cond & (F.col(_q(k)) == F.col(f"__k{i}"))
    return source.join(later, cond, "left_anti")


def last_loads(source: DataFrame, partition_cols: list[str], order: str) -> DataFrame:
    """Per table partition the last load partition (``order``) that writes it, where there are several."""
    o = F.col(_q(order))
    return (source.groupBy(*[F.col(_q(c)) for c in partition_cols]).agg(F.max(o).alias(LAST), F.min(o).alias("__first"))
                  .where(F.col("__first") < F.col(LAST)).drop("__first"))


def without_overwritten(source: DataFrame, last: DataFrame, partition_cols: list[str], order: str) -> DataFrame:
    """Rows of ``source`` but those of table partitions that a later load partition replaces."""
    last = last.select(*[F.col(_q(c)).alias(f"__k{i}") for i, c in enumerate(partition_cols)], LAST)
    cond = F.col(_q(order)) < F.col(LAST)
    for i, c in enumerate(partition_cols):
        cond = cond & F.col(_q(c)).eqNullSafe(F.col(f"__k{i}"))
    return source.join(last, cond, "left_anti")


def overwrite_partitions(target: DataFrame, source: DataFrame, partition_cols: list[str]) -> DataFrame:
    """Dynamic partition overwrite: every partition present in the source is
    replaced wholesale; the others are kept."""
    touched = source.select(*[F.col(_q(c)).alias(f"__p{i}") for i, c in enumerate(partition_cols)]).distinct()
    # NULL is a partition value of its own (one directory), so match it null-safely
    cond = None
    for i, c in enumerate(partition_cols):
        e = target[_q(c)].eqNullSafe(touched[f"__p{i}"])
        cond = e if cond is None else cond & e
    kept = target.join(touched, on=cond, how="left_anti").select(*[F.col(_q(c)) for c in target.columns])
    return kept.unionByName(source, allowMissingColumns=True)


# Widening allowed by schema synchronisation (never narrowing, never dropping).
_WIDEN = {
    (ByteType, ShortType), (ByteType, IntegerType), (ByteType, LongType),
    (ShortType, IntegerType), (ShortType, LongType), (IntegerType, LongType),
    (FloatType, DoubleType),
}


def widen(a: DataType, b: DataType) -> DataType | None:
    """Common type of two column types under the widening rules, else None.

    A decimal grows to the integer digits and the scale of both, up to 38 digits;
    a struct to the fields of both, by name, each widened; an array by its
    elements, a map by its keys and values.
    """
    if isinstance(a, StructType) and isinstance(b, StructType):
        return _merged(a, b)
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        e = widen(a.elementType, b.elementType)
        return e and ArrayType(e)
    if isinstance(a, MapType) and isinstance(b, MapType):
        k, v = widen(a.keyType, b.keyType), widen(a.valueType, b.valueType)
        return MapType(k, v) if k and v else None
    if isinstance(a, DecimalType) and isinstance(b, DecimalType):
        scale = max(a.scale, b.scale)
        digits = max(a.precision - a.scale, b.precision - b.scale) + scale
        return DecimalType(digits, scale) if digits <= 38 else None
    if a == b:
        return a
    if (type(a), type(b)) in _WIDEN:
        return b
    if (type(b), type(a)) in _WIDEN:
        return a
    return None


def _merged(a: StructType, b: StructType) -> StructType | None:
    """The fields of ``a``, widened by those of ``b`` of the same name, then the other fields of ``b``."""
    new = {f.name.lower(): f for f in b.fields}
    fields = []
    for f in a.fields:
        other = new.pop(f.name.lower(), None)
        t = f.dataType if other is None else widen(f.dataType, other.dataType)
        if t is None:
            return None
        fields.append(StructField(f.name, t, True))
    return StructType(fields + [StructField(f.name, f.dataType, True) for f in new.values()])


def fitted(c: Column, have: DataType, want: DataType) -> Column:
    """``c`` of type ``have`` as the wider ``want``: struct fields by name, those it lacks as NULL."""
    if isinstance(want, StructType) and isinstance(have, StructType):
        own = {f.name.lower(): f for f in have.fields}
        parts = [(fitted(c.getField(own[f.name.lower()].name), own[f.name.lower()].dataType, f.dataType) if f.name.lower() in own
                  else F.lit(None).cast(f.dataType)).alias(f.name) for f in want.fields]
        return F.when(c.isNotNull(), F.struct(*parts))
    if isinstance(want, ArrayType) and isinstance(have, ArrayType):
        return F.transform(c, lambda x: fitted(x, have.elementType, want.elementType))
    if isinstance(want, MapType) and isinstance(have, MapType):
        keyed = F.transform_keys(c, lambda k, _: fitted(k, have.keyType, want.keyType))
        return F.transform_values(keyed, lambda _, v: fitted(v, have.valueType, want.valueType))
    return c.cast(want)


def synced_schema(table_schema, batch_schema) -> list[tuple[str, DataType]]:
    """Evolved table columns: existing ones (widened where needed), then new ones."""
    cur = {f.name.lower(): f for f in table_schema.fields}
    out = []
    for f in table_schema.fields:
        b = next((x for x in batch_schema.fields if x.name.lower() == f.name.lower()), None)
        t = f.dataType if b is None else widen(f.dataType, b.dataType)
        if t is None:
            raise TypeError(f"Incompatible type change for column {f.name}: {f.dataType} -> {b.dataType}")
        out.append((f.name, t))
    for b in batch_schema.fields:
        if b.name.lower() not in cur:
            out.append((b.name, b.dataType))
    return out


def conform(df: DataFrame, columns: list[tuple[str, DataType]]) -> DataFrame:
    """Project ``df`` onto an evolved column list (missing columns as NULL)."""
    have = {c.lower(): c for c in df.columns}
    cols = []
    for name, t in columns:
        src = have.get(name.lower())
        cols.append((fitted(F.col(_q(src)), df.schema[src].dataType, t) if src else F.lit(None).cast(t)).alias(name))
    return df.select(*cols)


def schema_sync(table: DataFrame, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides projected onto the synchronised schema."""
    cols = synced_schema(table.schema, batch.schema)
    return conform(table, cols), conform(batch, cols)


def append_synced(table: DataFrame, batch: DataFrame) -> DataFrame:
    t, b = schema_sync(table, batch)
    return t.unionByName(b)
