"""Run reports: rows per partition, empty partitions, run audit records."""

from __future__ import annotations

import json
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's rules) -------------------------
EMPTY_MESSAGE_PREFIX = "Warning: The following partitions had no data and were skipped: "
STATUS_WARNING = "WARNING"
STATUS_SUCCEEDED = "SUCCEEDED"
STATUS_FAILED = "FAILED"
JOB_TYPE = "GLUE"
TRIGGER_SOURCE = "CRON"
# -----------------------------------------------------------------------------


def partition_counts(df: DataFrame, partition_col: str, name: str | None = None) -> DataFrame:
    """Rows per partition value (map-side partial count, one tiny shuffle)."""
    out = df.groupBy(F.col(partition_col).alias(name or partition_col)).agg(F.count(F.lit(1)).alias("n"))
    return out


def empty_partitions(planned: DataFrame, counts: DataFrame, planned_col: str,
                     counts_col: str | None = None) -> DataFrame:
    """Planned partitions that produced no rows.

    ``planned`` is the partition plan (bounded by the calendar window), ``counts``
    the per-partition row counts of what was read. A planned partition missing
    from ``counts`` (no directory, or only header rows) is empty.
    """
    counts_col = counts_col or planned_col
    observed = counts.where(F.col("n") > 0).select(F.col(counts_col).alias(planned_col))
    return planned.select(planned_col).join(observed, on=planned_col, how="left_anti")


def empty_partitions_message(empty: DataFrame, col: str) -> DataFrame:
    """One-row notification text listing the empty partitions in plan order.

    The collected list is bounded by the plan (calendar days/months of the window).
    """
    agg = empty.agg(F.sort_array(F.collect_list(F.col(col))).alias("parts"))
    return agg.where(F.size("parts") > 0).select(
        F.lit(STATUS_WARNING).alias("status"),
        F.concat(F.lit(EMPTY_MESSAGE_PREFIX), F.array_join("parts", ", ")).alias("message"))


def partition_outcomes(profile: DataFrame, partition_col: str) -> DataFrame:
    """Per-partition status from a grouped validation profile (``validate.profile``).

    One small aggregate over the profile rows, so the data is scanned once:
    SKIPPED when empty, FAILED when any check failed, else SUCCEEDED; the first
    failure in check order (missing columns, types, required fields) is the
    error text.
    """
    failing = F.col("check_name").isin("missing_column", "unparseable", "required_null") & (F.col("value") > 0)
    order = (F.when(F.col("check_name") == "missing_column", 1)
              .when(F.col("check_name") == "unparseable", 2).otherwise(3))
    agg = profile.groupBy(partition_col).agg(
        F.max("total_rows").alias("n"),
        F.min_by(F.when(failing, F.concat_ws(": ", "check_name", "column_name")),
                 F.when(failing, F.struct(order, F.col("column_name")))).alias("error"))
    status = (F.when(F.col("n") == 0, F.lit("SKIPPED"))
               .when(F.col("error").isNotNull(), F.lit(STATUS_FAILED))
               .otherwise(F.lit(STATUS_SUCCEEDED)))
    return agg.select(partition_col, "n", status.alias("status"), "error")


def audit_row(job_name: str, status: str, error: str | None, params: dict, run_id: str = "",
              project_name: str = "", environment: str = "") -> dict:
    """The audit values of a job run."""
    return {
        "project_name": project_name, "job_name": job_name, "run_id": run_id,
        "job_type": JOB_TYPE, "environment": environment.upper(), "trigger_source": TRIGGER_SOURCE,
        "status": status, "error_message": error,
        "input_parameters": json.dumps({k: str(v) for k, v in params.items()}, sort_keys=True),
        "emitted_at": datetime.now(timezone.utc).replace(tzinfo=None),
    }


def audit_record(spark: SparkSession, job_name: str, status: str, error: str | None,
                 params: dict, run_id: str = "", project_name: str = "", environment: str = "") -> DataFrame:
    """One audit row for a job run as a table."""
    schema = ("project_name string, job_name string, run_id string, job_type string, environment string, "
              "trigger_source string, status string, error_message string, input_parameters string, "
              "emitted_at timestamp_ntz")
    return spark.createDataFrame([audit_row(job_name, status, error, params, run_id, project_name, environment)], schema)
