"""Schema-driven projections: cast, select + rename, name normalisation.

Each operator is a single projection over the input (one ``select`` /
``withColumns`` / ``toDF``), so Catalyst collapses the whole chain into one
Project node and prunes unused columns down to the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewater.functions.casts import lenient_cast, normalize_type
from tidewater.functions.names import check_collisions, normalize_name
from tidewater.schema import output_name


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cast_by_schema(df: DataFrame, fields: list[dict], ntz: bool = True) -> DataFrame:
    """Cast every field that declares a ``converted_type`` (one projection).

    Casts are lenient (NULL on failure); dates and timestamps fall back to the
    Spanish AM/PM parser. Fields without ``converted_type`` are left as they are.
    """
    if not fields:
        raise RuntimeError("Error casting columns from schema: Schema is empty. Cannot perform casting.")
    types = {f.name: f.dataType for f in df.schema.fields}
    casts = {}
    for field in fields:
        name = field.get("name")
        if not name:
            raise RuntimeError(f"Error casting columns from schema: Schema field missing 'name': {field}")
        ct = field.get("converted_type")
        if not ct:
            continue
        if name not in types:
            raise RuntimeError(f"Error casting columns from schema: column '{name}' not found")
        casts[name] = lenient_cast(F.col(_q(name)), normalize_type(ct), types[name], ntz=ntz)
    return df.withColumns(casts) if casts else df


def select_rename(df: DataFrame, fields: list[dict], keep: list[str] | None = None) -> DataFrame:
    """Keep only schema columns, in schema order, renamed to ``converted_name``
    or the snake_case of the raw name. Absent columns are skipped.

    ``keep`` lists extra columns carried through unchanged (partition columns).
    """
    present = set(df.columns)
    cols = [F.col(_q(f["name"])).alias(output_name(f)) for f in fields if f["name"] in present]
    outs = [output_name(f) for f in fields if f["name"] in present]
    for k in keep or []:
        if k in present and k not in outs:
            cols.append(F.col(_q(k)))
            outs.append(k)
    return df.select(*cols)


def normalize_column_names(df: DataFrame, untouched: list[str] | None = None) -> DataFrame:
    """Fold accents, año -> anio, non-word characters -> '_' in every column name (but the ``untouched``).

    Raises when two names collide after normalisation (Spark resolves names
    case-insensitively, so a collision would make later references ambiguous).
    """
    names = [c if c in (untouched or []) else normalize_name(c) for c in df.columns]
    check_collisions(names)
    return df.toDF(*names)


def split_partition_keys(keys) -> tuple[list[str], list[str]]:
    """Staging partition keys: comma text or list, trimmed; ``add_x`` -> key ``x``
    that the loader must add as a column. Returns (keys, keys_to_add)."""
    if isinstance(keys, str):
        keys = [k.strip() for k in keys.split(",") if k.strip()]
    cleaned, to_add = [], []
    for k in keys or []:
        if k.startswith("add_"):
            k2 = k.replace("add_", "")
            cleaned.append(k2)
            to_add.append(k2)
        else:
            cleaned.append(k)
    return cleaned, to_add


def add_partition_column(df: DataFrame, name: str, value) -> DataFrame:
    """Add a constant (or per-row Column) partition column."""
    from pyspark.sql import Column
    return df.withColumn(name, value if isinstance(value, Column) else F.lit(value))
