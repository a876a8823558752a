import pytest

from tidewater.operators import validate

FIELDS = [
    {"name": "id", "type": "int", "nullable": False},
    {"name": "nombre", "type": "string", "nullable": True},
    {"name": "edad", "type": "int"},
]


def _report(df, fields, **kw):
    return sorted(tuple(r) for r in validate.validation_report(df, fields, **kw).collect())


def test_clean_frame_has_no_failures(spark):
    df = spark.createDataFrame([("1", "Ana", "30"), ("2", "Luis", None)], "id string, nombre string, edad string")
    assert _report(df, FIELDS) == []
    validate.raise_for_report([])


def test_missing_column_first(spark):
    df = spark.createDataFrame([("1", "Ana")], "id string, nombre string")
    rows = validate.validation_report(df, FIELDS).collect()
    assert [(r.check_name, r.column_name, r.bad_rows) for r in rows] == [("missing_column", "edad", 1)]
    with pytest.raises(ValueError, match=r"Missing fields in DataFrame: \['edad'\]"):
        validate.raise_for_report(rows)


def test_type_then_required(spark):
    df = spark.createDataFrame([(None, "Ana", "x"), ("2", None, "3")], "id string, nombre string, edad string")
    rows = validate.validation_report(df, FIELDS).collect()
    assert sorted((r.check_name, r.column_name, r.bad_rows) for r in rows) == \
        [("required_null", "id", 1), ("unparseable", "edad", 1)]
    with pytest.raises(TypeError, match="edad"):
        validate.raise_for_report(rows)


def test_required_message(spark):
    df = spark.createDataFrame([(None, "Ana", "1")], "id string, nombre string, edad string")
    with pytest.raises(ValueError, match="Required field id has 1 null or empty values."):
        validate.raise_for_report(validate.validation_report(df, FIELDS).collect())


def test_all_null_column_skips_type_check(spark):
    df = spark.createDataFrame([("1", "Ana", None)], "id string, nombre string, edad string")
    assert _report(df, FIELDS) == []
    assert [r[0] for r in validate.all_null_columns(df, FIELDS).collect()] == ["edad"]


def test_strict_types_on_typed_frame(spark):
    df = spark.createDataFrame([(1, "Ana", 30)], "id bigint, nombre string, edad int")
    assert ("unparseable", "id", 1) in _report(df, FIELDS, strict=True)


def test_relaxed_workbook_types(spark):
    df = spark.createDataFrame([("1", "Ana", 30.0)], "id string, nombre string, edad double")
    assert not [r for r in _report(df, FIELDS, strict=True, relaxed=True) if r[0] == "unparseable"]
    fields = [{"name": "d", "type": "date"}]
    num = spark.createDataFrame([(1.0,)], "d double")
    assert ("unparseable", "d", 1) in _report(num, fields, strict=True, relaxed=True)


def test_grouped_profile(spark):
    df = spark.createDataFrame([("a", None, "x", "1"), ("b", "2", "y", "z")],
                               "p string, id string, nombre string, edad string")
    rows = sorted(tuple(r) for r in validate.validation_report(df, FIELDS, by=["p"]).collect())
    assert rows == [("a", "required_null", "id", 1), ("b", "unparseable", "edad", 1)]


def test_required_nulls_counts_empty_separately(spark):
    df = spark.createDataFrame([("", "Ana", "1"), (None, "", "2")], "id string, nombre string, edad string")
    fields = FIELDS + [{"name": "nombre", "type": "string", "nullable": False}]
    rows = {r.column_name: (r.null_rows, r.empty_rows) for r in validate.required_nulls(df, fields).collect()}
    assert rows == {"id": (1, 1), "nombre": (0, 1)}


def test_wide_schema_report_plans_quickly(spark):
    import time

    from pyspark.sql import functions as F
    n = 200
    df = spark.range(50).select(*[F.col("id").cast("string").alias(f"c{i}") for i in range(n)])
    fields = [{"name": f"c{i}", "type": "int" if i % 2 else "string", "nullable": i % 3 != 0} for i in range(n)]
    t = time.time()
    assert validate.validation_report(df, fields).collect() == []
    assert time.time() - t < 20  # no filter over the wide aggregate (constraint inference blow-up)
