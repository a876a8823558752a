from pyspark.sql import functions as F

from tidewater.job import parse_args
from tidewater.operators import report, validate


def test_partition_outcomes(spark):
    df = spark.createDataFrame([("a", "1", "x"), ("a", None, "y"), ("b", "2", "z"), ("c", "q", None)],
                               "p string, id string, name string")
    fields = [{"name": "id", "type": "int", "nullable": False}, {"name": "name", "type": "string"}]
    out = {r.p: (r.n, r.status, r.error) for r in report.partition_outcomes(validate.profile(df, fields, by=["p"]), "p").collect()}
    assert out == {"a": (2, "FAILED", "required_null: id"), "b": (1, "SUCCEEDED", None),
                   "c": (1, "FAILED", "unparseable: id")}


def test_empty_partitions_and_message(spark):
    planned = spark.createDataFrame([("2024-01-01",), ("2024-01-02",), ("2024-01-03",)], "d string")
    counts = spark.createDataFrame([("2024-01-02", 5), ("2024-01-03", 0)], "d string, n bigint")
    empty = report.empty_partitions(planned, counts, "d")
    assert sorted(r.d for r in empty.collect()) == ["2024-01-01", "2024-01-03"]
    msg = report.empty_partitions_message(empty, "d").first()
    assert msg.status == "WARNING"
    assert msg.message == "Warning: The following partitions had no data and were skipped: 2024-01-01, 2024-01-03"
    assert report.empty_partitions_message(empty.where(F.lit(False)), "d").count() == 0


def test_audit_record(spark):
    row = report.audit_record(spark, "job", "FAILED", "boom", {"a": 1}, environment="dev").first()
    assert (row.job_type, row.trigger_source, row.environment, row.status) == ("GLUE", "CRON", "DEV", "FAILED")
    assert row.input_parameters == '{"a": "1"}'


def test_cli_optional_arguments():
    args, audit = parse_args([
        "--job_name", "j", "--project_name", "p", "--path_name_raw", "r", "--path_name_staging", "s",
        "--catalog_database", "db", "--catalog_table", "t", "--merge_keys", "id", "--partition_key_staging", "mes",
        "--partition_key_raw", "mes", "--process_type", "INC", "--date_type", "MONTH_PRECISION",
        "--excel_sheet", "-", "--file_name_excel", "--partition_key_raw_path", " fecha "])
    assert args.excel_sheet == "" and args.file_name_excel == "" and args.partition_key_raw_path == "fecha"
    assert audit is None and args.raw_root is None
