"""Schema-definition documents (``schema.json``) read with Spark.

``read_field_table`` turns any number of documents into one field table (one
row per declared field), so the schemas of many datasets load in one job.
``load_schema`` returns one dataset's fields as dicts, with the error
taxonomy of the original loader.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions.names import sheet_key

FIELD_TYPE = ("struct<name:string,type:string,converted_type:string,converted_name:string,"
              "nullable:boolean>")
DOC_SCHEMA = f"fields array<{FIELD_TYPE}>, _corrupt_record string"


def schema_doc_path(schema_root: str, key: str, excel_sheet: str | None = None) -> str:
    """``{root}/{key}/schema.json``, or ``{root}/{key}/{sheet_key}/schema.json`` for a workbook sheet."""
    base = f"{schema_root.rstrip('/')}/{key.strip('/')}"
    if excel_sheet and excel_sheet.strip():
        return f"{base}/{sheet_key(excel_sheet)}/schema.json"
    return f"{base}/schema.json"


def read_field_table(spark: SparkSession, paths) -> DataFrame:
    """(schema_path, position, name, type, converted_type, converted_name, nullable, doc_error)."""
    docs = (spark.read.option("multiLine", "true").option("mode", "PERMISSIVE")
                 .schema(DOC_SCHEMA).json(paths)
                 .select(F.col("_metadata.file_path").alias("schema_path"), "fields", "_corrupt_record"))
    return docs.select(
        "schema_path",
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("invalid_json"))
         .when(F.coalesce(F.size("fields"), F.lit(0)) <= 0, F.lit("no_fields")).alias("doc_error"),
        F.posexplode_outer("fields").alias("position", "field"),
    ).select("schema_path", "position", "field.*", "doc_error")


def fields_from_json(doc: Column | str) -> Column:
    """``array<struct<...>>`` of the fields in a schema document held in a text column."""
    doc = F.col(doc) if isinstance(doc, str) else doc
    return F.from_json(doc, f"struct<fields:array<{FIELD_TYPE}>>")["fields"]


def load_schema(spark: SparkSession, path: str) -> list[dict]:
    """Fields of one schema document.

    Missing or empty document -> FileNotFoundError; invalid JSON or no fields ->
    ValueError; anything else -> RuntimeError.
    """
    try:
        rows = read_field_table(spark, path).collect()
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e):
            raise FileNotFoundError(f"Schema document not found: {path}") from e
        raise RuntimeError(f"Unexpected error while parsing schema: {e}") from e
    if not rows:
        raise FileNotFoundError("Schema content is empty or not provided.")
    if any(r["doc_error"] == "invalid_json" for r in rows):
        raise ValueError("The provided content is not valid JSON.")
    if all(r["doc_error"] == "no_fields" for r in rows):
        raise ValueError("The provided schema does not contain any defined fields.")
    out = []
    for r in sorted(rows, key=lambda r: r["position"]):
        f = {k: r[k] for k in ("name", "type", "converted_type", "converted_name", "nullable") if r[k] is not None}
        out.append(f)
    return out
