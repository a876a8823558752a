import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from tidewater.functions import names
from tidewater.operators import project


# golden values from the original loader's unit tests
@pytest.mark.parametrize("raw, expected", [
    ("CamelCase", "camel_case"),
    ("UserID", "user_id"),
    ("already_snake", "already_snake"),
    ("HTTPResponse", "http_response"),
    ("IOError", "io_error"),
])
def test_snake_case_golden(raw, expected):
    assert names.snake_case(raw) == expected


def test_snake_case_none():
    with pytest.raises(RuntimeError, match="Error converting"):
        names.snake_case(None)


def test_snake_case_column_matches_driver(spark):
    raws = ["CamelCase", "UserID", "already_snake", "HTTPResponse", "IOError", "getHTTP2Response", "A", ""]
    df = spark.createDataFrame([(r,) for r in raws], "r string")
    got = [r[0] for r in df.select(names.snake_case_col("r")).collect()]
    assert got == [names.snake_case(r) for r in raws]


@given(st.lists(st.text(alphabet="aAbBzZ09_ -áÑñçÉ!.", max_size=12), min_size=1, max_size=20))
@settings(max_examples=15, deadline=None)
def test_value_rules_equal_name_rules(spark, raws):
    df = spark.createDataFrame([(r,) for r in raws], "r string")
    rows = df.select(names.snake_case_col("r").alias("s"), names.normalize_name_col("r").alias("n"),
                     names.sheet_key_col("r").alias("k")).collect()
    assert [r["s"] for r in rows] == [names.snake_case(r) for r in raws]
    assert [r["n"] for r in rows] == [names.normalize_name(r) for r in raws]
    assert [r["k"] for r in rows] == [names.sheet_key(r) for r in raws]


def test_select_then_normalise_names(spark):
    df = spark.createDataFrame([(1, "a", 2, "x")], ["Nómbre Completo", "Año_del_Cliente!!", "Cól__n!__Espéçial", "Extra"])
    fields = [{"name": c, "type": "string"} for c in ["Nómbre Completo", "Año_del_Cliente!!", "Cól__n!__Espéçial"]]
    out = project.normalize_column_names(project.select_rename(df, fields))
    assert out.columns == ["nombre_completo", "ano_del_cliente", "col_n_espe_ial"]


def test_normalise_keeps_case_and_anio():
    assert names.normalize_name("Nómbre Completo") == "Nombre_Completo"
    assert names.normalize_name("Año Saldo") == "anio_Saldo"
    assert names.normalize_name("AÑO") == "anio"
    assert names.normalize_name("Año_x") == "Ano_x"


def test_collision_raises(spark):
    df = spark.createDataFrame([(1, 2)], ["Año", "ano!"])
    with pytest.raises(ValueError, match="collide"):
        project.normalize_column_names(df)


def test_select_rename_converted_name_and_order(spark):
    df = spark.createDataFrame([(1, "a", 3)], ["UserID", "UserName", "Other"])
    fields = [{"name": "UserName"}, {"name": "UserID", "converted_name": "id"}, {"name": "Missing"}]
    out = project.select_rename(df, fields)
    assert out.columns == ["user_name", "id"]
    assert out.first().asDict() == {"user_name": "a", "id": 1}


def test_dotted_names_are_quoted(spark):
    df = spark.createDataFrame([("1",)], ["a.b"])
    out = project.select_rename(project.cast_by_schema(df, [{"name": "a.b", "converted_type": "int"}]),
                                [{"name": "a.b", "converted_name": "ab"}])
    assert out.first()["ab"] == 1


def test_sheet_key():
    assert names.sheet_key("Hoja 1") == "hoja_1"
    assert names.sheet_key("  Mi   Hoja Dos ") == "mi_hoja_dos"


def test_accent_fold_values(spark):
    df = spark.createDataFrame([("Año nuevo, ANO viejo, anoche, año_x",)], "t string")
    assert df.select(names.fold_accents_col("t")).first()[0] == "anio nuevo, anio viejo, anoche, ano_x"


def test_add_partition_keys():
    assert project.split_partition_keys("add_fecha_carga, region ,") == (["fecha_carga", "region"], ["fecha_carga"])
    assert project.split_partition_keys(["mes"]) == (["mes"], [])


def test_snake_case_line_terminators(spark):
    raws = ["a\rBc", "x Yz", "a\nBc"]
    df = spark.createDataFrame([(r,) for r in raws], "r string")
    assert [r[0] for r in df.select(names.snake_case_col("r")).collect()] == [names.snake_case(r) for r in raws]


def test_anio_word_rule_matches_python_next_to_marks_and_numbers(spark):
    import re
    raws = ["x²ano", "anó", "çano x", "el ano pasado", "ano_x", "ANO"]
    df = spark.createDataFrame([(r,) for r in raws], "r string")
    got = [r[0] for r in df.select(names.fold_accents_col("r")).collect()]
    assert got == [re.sub(names.ANIO_PATTERN, names.ANIO_REPLACEMENT, names.fold_accents(r)) for r in raws]
