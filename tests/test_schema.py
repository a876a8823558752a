import json
import os

import pytest
from pyspark.sql.types import DecimalType, IntegerType, LongType, StringType, TimestampType

from tidewater import schema as S
from tidewater.session import local_path, scratch_path
from tidewater.sources.schema_docs import load_schema, schema_doc_path


def test_build_struct_and_required():
    fields = [{"name": "id", "type": "int", "nullable": False}, {"name": "name", "type": "string", "nullable": True},
              {"name": "email", "type": "varchar", "nullable": False}, {"name": "x", "type": " DECIMAL "},
              {"name": "y", "type": "decimal(10,2)"}, {"name": "z", "type": "datetime"}, {"name": "w", "type": "bigint"}]
    st = S.build_struct(fields)
    assert [f.dataType for f in st.fields] == [IntegerType(), StringType(), StringType(), DecimalType(38, 10),
                                              StringType(), TimestampType(), LongType()]
    assert S.required_fields(fields) == ["id", "email"]


def test_build_struct_errors():
    with pytest.raises(ValueError):
        S.build_struct([])
    with pytest.raises(KeyError):
        S.build_struct([{"name": "a"}])
    with pytest.raises(ValueError):
        S.required_fields([])


@pytest.mark.parametrize("text, exc", [("", FileNotFoundError), ("{}", FileNotFoundError),
                                       ('{"fields": []}', ValueError), ("{bad", ValueError)])
def test_parse_document_errors(text, exc):
    with pytest.raises(exc):
        S.parse_schema_document(text)


def test_schema_doc_path():
    assert schema_doc_path("s3://b", "/raw/data/", "Hoja 1") == "s3://b/raw/data/hoja_1/schema.json"
    assert schema_doc_path("s3://b", "raw/data") == "s3://b/raw/data/schema.json"


def _doc(spark, text):
    d = scratch_path(spark, "schema-doc")
    os.makedirs(local_path(d), exist_ok=True)
    with open(os.path.join(local_path(d), "schema.json"), "w") as f:
        f.write(text)
    return f"{d}/schema.json"


def test_load_schema_from_storage(spark):
    fields = [{"name": "id", "type": "int", "nullable": False}, {"name": "Nombre", "type": "string",
                                                                  "converted_name": "nombre"}]
    got = load_schema(spark, _doc(spark, json.dumps({"fields": fields})))
    assert got == [{"name": "id", "type": "int", "nullable": False},
                   {"name": "Nombre", "type": "string", "converted_name": "nombre"}]
    with pytest.raises(ValueError, match="does not contain"):
        load_schema(spark, _doc(spark, json.dumps({"fields": []})))
    with pytest.raises(ValueError, match="not valid JSON"):
        load_schema(spark, _doc(spark, "{not json"))
    with pytest.raises(FileNotFoundError):
        load_schema(spark, scratch_path(spark, "nothing") + "/schema.json")


def test_fields_from_json_column(spark):
    from pyspark.sql import functions as F

    from tidewater.sources.schema_docs import fields_from_json
    docs = spark.createDataFrame([('{"fields":[{"name":"id","type":"int","nullable":false},{"name":"x","type":"string"}]}',),
                                  ("{bad",)], "doc string")
    out = docs.select(F.size(fields_from_json("doc")).alias("n"), fields_from_json("doc")[0]["name"].alias("first"))
    rows = [tuple(r) for r in out.collect()]
    assert rows[0] == (2, "id")
    assert rows[1][1] is None
