"""Incremental (INC) loads as Structured Streaming over the raw zone.

Instead of computing "yesterday" and reading that one partition, the raw
directory is a stream of files: every run with ``trigger(availableNow=True)``
stages exactly the files that arrived since the last run (tracked in the
checkpoint), then stops. The stream carries files' names only; each micro-batch
routes its files by header, a scan for each distinct one, so files whose
columns come in another order, or are more or fewer, stage by name. The rows go
through the same operators as the batch job -- one-pass validation, cast,
rename, normalise -- and are merged into the staging table.

A batch that holds several raw partitions is validated partition by partition:
a declared column that a file lacks is missing in that file's partition only.
With ``invalid="fail"`` the first failing partition fails the batch, which is not
committed to the checkpoint and is re-run on the next start; with
``invalid="report"`` the failing partitions are left out and the others staged.
Either way ``audit_path`` takes a row for the batch and one for each of its
partitions, once, however often the batch is run. Of a key that comes
in several partitions the last one's row counts; the merge is keyed, so a re-run is idempotent.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.operators import merge as M
from tidewater.operators import project, report, validate
from tidewater.session import shared_dir
from tidewater.sinks import ledger
from tidewater.sinks.table import StagingTable
from tidewater.sources import files

LOAD_PARTITION = "__load_partition"  # the raw partition a row came in: later ones win
HEADER = "__header"  # number of the header that a row's file has
FILE_SCHEMA = "path string, modificationTime timestamp, length long, content binary"


def file_stream(spark: SparkSession, raw_dir: str, fmt: str = "csv", max_files_per_trigger: int | None = None) -> DataFrame:
    """Names and sizes of the raw files as they arrive; their content is not read here."""
    if fmt not in ("csv", "json"):
        raise ValueError(f"Unsupported streaming raw format: {fmt}")
    r = spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("pathGlobFilter", files.ext_glob(fmt)).option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return r.load(raw_dir).select("path", "length")


def _literal(path: str) -> str:
    """A path whose glob characters stand for themselves."""
    return re.sub(r"([\[\]{}*?\\])", r"\\\1", path)


def read_files(spark: SparkSession, paths: list[str], fields: list[dict], partition_key: str, fmt: str) -> tuple[DataFrame | None, dict[int, set[str]]]:
    """The declared columns of the files as text, ``LOAD_PARTITION`` and ``HEADER``; and by header the columns that its files lack.

    CSV files without a line are in no scan; None if no other is left. JSON records have no
    header: all are read by the declared names.
    """
    names = [f["name"] for f in fields]
    if fmt == "csv":
        groups: dict[str, list[str]] = {}
        for path, head in sorted(files.first_lines(spark, paths).items()):
            if head is not None:
                groups.setdefault(head, []).append(path)
        frames = [files.read_csv(spark, [_literal(p) for p in group]) for group in groups.values()]
    else:
        frames = [files.read_json(spark, [_literal(p) for p in paths], files.text_schema(names))]
    absent, out = {}, None
    for i, df in enumerate(frames):
        value = files.partition_of(F.col("_metadata.file_path"), partition_key)
        absent[i] = {n for n in names if n not in df.columns and n != partition_key}
        df = df.select(*[F.col(f"`{n}`") if n in df.columns else (value if n == partition_key else F.lit(None).cast("string")).alias(n) for n in names],
                       value.alias(LOAD_PARTITION), F.lit(i).alias(HEADER))
        out = df if out is None else out.unionByName(df)
    return out, absent


def partition_profile(raw: DataFrame, fields: list[dict], absent: dict[int, set[str]]) -> list[dict]:
    """One aggregate over the batch, by partition and header: a column that a header lacks is missing in its rows.

    Bounded by partitions x headers x checks.
    """
    out = []
    for r in validate.profile(raw, fields, by=[LOAD_PARTITION, HEADER]).collect():
        r = r.asDict()
        if r["column_name"] in absent[r[HEADER]]:
            if r["check_name"] != "all_null":
                continue
            r.update(check_name="missing_column", value=r["total_rows"])
        out.append(r)
    return out


def _without_key(spark: SparkSession, profile: list[dict], paths: list[str], partition_key: str) -> None:
    """JSON: a column without any value in a partition is missing there if no record of it has the key."""
    doubt = {}
    for r in profile:
        if r["check_name"] == "all_null" and r["value"] == 0 and r["total_rows"] and r["column_name"] != partition_key:
            doubt.setdefault(r[LOAD_PARTITION], set()).add(r["column_name"])
    near = [_literal(p) for p in paths if any(f"/{partition_key}={v}/" in p for v in doubt)]
    if not near:
        return
    names = sorted(set().union(*doubt.values()))
    for r in files.json_keys(spark, near, partition_key).where(F.col("name").isin(names)).collect():
        doubt.get(r["value"], set()).discard(r["name"])
    lacking = {(p, c) for p, columns in doubt.items() for c in columns}
    profile[:] = [r if (r[LOAD_PARTITION], r["column_name"]) not in lacking else {**r, "check_name": "missing_column", "value": r["total_rows"]}
                  for r in profile if (r[LOAD_PARTITION], r["column_name"]) not in lacking or r["check_name"] == "all_null"]


def _outcomes(spark: SparkSession, profile: list[dict]) -> list[dict]:
    """Rows, status and first failure of each partition, over all its headers."""
    kinds = f"{LOAD_PARTITION} string, {HEADER} int, check_name string, column_name string, value long, total_rows long"
    rows = spark.createDataFrame(profile, kinds)
    size = rows.groupBy(LOAD_PARTITION, HEADER).agg(F.max("total_rows").alias("n")).groupBy(LOAD_PARTITION).agg(F.sum("n").alias("total_rows"))
    whole = rows.groupBy(LOAD_PARTITION, "check_name", "column_name").agg(F.sum("value").alias("value")).join(F.broadcast(size), LOAD_PARTITION)
    return [{"partition_value": r[LOAD_PARTITION], "n": r["n"], "partition_status": r["status"], "partition_error": r["error"]}
            for r in report.partition_outcomes(whole, LOAD_PARTITION).collect()]


def stage_batch(batch: DataFrame, fields: list[dict], table: StagingTable, merge_keys: list[str] | None,
                partition_key: str, add_columns: list[str], fmt: str = "csv", invalid: str = "fail") -> list[dict]:
    """Validate, transform and write one micro-batch of files; returns its partitions' outcomes.

    The raw rows are parsed once, into a columnar copy in the table's
    staging folder; validation, casts and the merge read that copy (nothing is
    cached on executors, so a lost executor only costs a re-read). The names of a batch's files
    pass the driver, as they do in the file source itself; ``maxFilesPerTrigger`` bounds them.
    """
    spark = batch.sparkSession
    paths = [r["path"] for r in batch.where("length > 0").select("path").collect()]
    raw, absent = read_files(spark, paths, fields, partition_key, fmt) if paths else (None, {})
    if raw is None:
        return []
    copy = f"{table._staging_dir()}/raw"
    raw.write.mode("overwrite").parquet(copy)
    raw = spark.read.parquet(copy)
    profile = partition_profile(raw, fields, absent)
    if fmt == "json":
        _without_key(spark, profile, paths, partition_key)
    outcomes = _outcomes(spark, profile)
    failed = sorted(o["partition_value"] for o in outcomes if o["partition_status"] == report.STATUS_FAILED)
    if failed and invalid == "fail":
        try:
            validate.raise_for_report([{**r, "bad_rows": r["value"]} for r in profile if r[LOAD_PARTITION] == failed[0]])
        except (TypeError, ValueError) as e:
            e.outcomes = outcomes
            raise
    if len(failed) < len(outcomes):
        df = raw.where(~F.col(LOAD_PARTITION).isin(failed)) if failed else raw
        for c in add_columns:
            df = project.add_partition_column(df, c, F.col(LOAD_PARTITION))
        df = project.cast_by_schema(df, fields)
        df = project.select_rename(df, fields, keep=[*add_columns, LOAD_PARTITION])
        df = project.normalize_column_names(df, untouched=[LOAD_PARTITION])
        if merge_keys is None:
            table.overwrite_partitions(df, order=LOAD_PARTITION)
        else:
            table.merge(df, merge_keys, materialise=False, order=LOAD_PARTITION)
    table._cleanup()
    return outcomes


def run_incremental(spark: SparkSession, raw_dir: str, fields: list[dict], table: StagingTable,
                    merge_keys, partition_key: str, partition_key_staging, fmt: str = "csv",
                    checkpoint: str | None = None, max_files_per_trigger: int | None = None,
                    invalid: str = "fail", audit_path: str | None = None, job_name: str = "incremental"):
    """Stage every raw file not seen before, then stop. Returns the finished query."""
    if invalid not in ("fail", "report"):
        raise ValueError(f"invalid must be 'fail' or 'report', not {invalid!r}")
    keys = M.parse_merge_keys(merge_keys)
    _, add_columns = project.split_partition_keys(partition_key_staging)
    checkpoint = checkpoint or f"{shared_dir(spark).rstrip('/')}/tidewater-streams/{table.path.rsplit('/', 1)[-1]}"

    def audit(batch_id: int, status: str, error: str | None, outcomes: list[dict]) -> None:
        if audit_path:
            row = report.audit_row(job_name, status, error, {"raw": raw_dir, "table": table.path, "batch": batch_id}, f"{checkpoint}#{batch_id}")
            ledger.append(spark, audit_path, row, [job_name, checkpoint, str(batch_id)], outcomes)

    def one(batch: DataFrame, batch_id: int) -> None:
        try:
            outcomes = stage_batch(batch, fields, table, keys, partition_key, add_columns, fmt, invalid)
        except Exception as e:
            audit(batch_id, report.STATUS_FAILED, str(e), getattr(e, "outcomes", []))
            raise
        left_out = sorted(o["partition_value"] for o in outcomes if o["partition_status"] == report.STATUS_FAILED)
        audit(batch_id, report.STATUS_WARNING if left_out else report.STATUS_SUCCEEDED,
              f"left out: {', '.join(left_out)}" if left_out else None, outcomes)

    q = (file_stream(spark, raw_dir, fmt, max_files_per_trigger).writeStream
         .foreachBatch(one)
         .option("checkpointLocation", checkpoint)
         .trigger(availableNow=True)
         .start())
    q.awaitTermination()
    return q
