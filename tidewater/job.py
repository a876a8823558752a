"""The raw -> staging load as a few Spark jobs per run.

Where a per-partition loop would scan each raw partition several times
(count, emptiness, one pass per checked column), this job

1. plans the partitions (``plans.partitions``),
2. lists only the planned directories and detects their formats,
3. parses all planned raw files once, into a columnar copy in the table's
   staging folder (this also cuts the lineage),
4. profiles the copy in one aggregate grouped by partition (row counts,
   missing columns, unparseable values, required NULLs),
5. fails fast, in the original order, on the first partition with a failure
   -- before the table is touched,
6. casts, selects/renames and normalises in one projection,
7. merges (or dynamically overwrites) the touched partitions of the table,
8. reports empty partitions; ``run_with_audit`` adds the audit record.
"""

from __future__ import annotations

import json
import logging
import uuid
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import dates as D
from tidewater.functions.params import entity_from_path, format_of_path
from tidewater.operators import merge as M
from tidewater.operators import project, report, validate
from tidewater.plans.partitions import plan_partitions
from tidewater.schema import Schema
from tidewater.session import _context, apply_staging_conf
from tidewater.sinks import ledger
from tidewater.sinks.table import StagingTable
from tidewater.sources import files
from tidewater.sources.schema_docs import load_schema, schema_doc_path

log = logging.getLogger("tidewater.job")

PARTITION_VALUE = "__partition_value"  # the planned value a row was read for
ADD_VALUE = "__add_value"              # the value an ``add_`` partition column takes

# --- fixed value: the catalog that qualifies staging tables -------------------
CATALOG = "glue_catalog"
# ------------------------------------------------------------------------------


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


@dataclass
class StagingArgs:
    """Job arguments (the loader's string parameters)."""
    job_name: str
    project_name: str
    path_name_raw: str
    path_name_staging: str
    catalog_database: str
    catalog_table: str
    merge_keys: str
    partition_key_staging: str
    partition_key_raw: str
    process_type: str
    date_type: str
    start_date: str = ""
    end_date: str = ""
    bucket_name_raw: str = ""
    bucket_name_schema: str = ""
    bucket_name_staging: str = ""
    excel_sheet: str = ""
    partition_key_raw_path: str = ""
    file_name_excel: str = ""
    notification_emails: str = ""
    # roots of the three zones; default to s3://{bucket}
    raw_root: str | None = None
    schema_root: str | None = None
    staging_root: str | None = None
    today: str | None = None  # Bogota date; computed when not given
    # True: CSV/JSON types are inferred and must equal the declared raw types
    # (the original strict check; costs an inference pass). False: text is read
    # as text and each value is checked against its declared type.
    strict_types: bool = False
    # True: a planned raw directory that does not exist fails the run (the
    # original behaviour); False: it is reported with the empty partitions.
    fail_on_missing: bool = False
    # True: read only the first workbook of a directory (the original behaviour)
    excel_first_only: bool = False
    # True: read JSON with the declared names as text (no inference pass); a
    # declared column absent from every record then reports as all-NULL
    json_declared_schema: bool = False
    # False: a key never changes partition, so a merge reads only the batch's
    # partitions instead of scanning every key of the table
    keys_may_move: bool = True
    # catalog that qualifies the table; with an Iceberg catalog of this name the table lives there
    catalog_name: str = CATALOG
    # True: the Parquet table is registered as catalog_database.catalog_table in the session catalog and kept in step
    register_table: bool = False
    # identity in the audit record
    job_run_id: str = ""
    stage: str = ""

    def root(self, kind: str) -> str:
        explicit = {"raw": self.raw_root, "schema": self.schema_root, "staging": self.staging_root}[kind]
        bucket = {"raw": self.bucket_name_raw, "schema": self.bucket_name_schema,
                  "staging": self.bucket_name_staging}[kind]
        return (explicit or f"s3://{bucket}").rstrip("/")


@dataclass
class StagingResult:
    status: str
    partitions: list[str]
    empty_partitions: list[str] = field(default_factory=list)
    rows_written: int = 0
    message: str | None = None

    def warning_record(self, args: StagingArgs) -> dict | None:
        """What a notifier needs to report the empty partitions (None when there are none)."""
        if not self.empty_partitions:
            return None
        # --- fixed values: the record's field names -----------------------------
        return {"Payload": {"JobStatus": self.status, "ProcessType": args.process_type, "ProjectName": args.project_name,
                            "JobName": args.job_name, "Arguments": {"--catalog_table": args.catalog_table},
                            "ErrorMessage": self.message, "NotificationEmails": args.notification_emails}}
        # --------------------------------------------------------------------------


class StagingJob:
    def __init__(self, spark: SparkSession, args: StagingArgs):
        self.spark = spark
        self.args = args
        apply_staging_conf(spark)
        self.key_raw = args.path_name_raw.strip("/")
        self.key_staging = args.path_name_staging.strip("/")
        self.table_raw_path = f"{args.root('raw')}/{self.key_raw}"
        self.table_staging_path = f"{args.root('staging')}/{self.key_staging}"
        self.catalog_table = f"{args.catalog_name}.{args.catalog_database}.{args.catalog_table}"
        self.excel_sheet = args.excel_sheet.strip() or None
        self.file_name_excel = args.file_name_excel.strip() or None
        self.materialise_raw = True
        self.outcomes: list[dict] = []  # by partition, as far as the run came
        self.raw_key = ""
        self.absent: dict[str, set[str]] = {}  # per planned value, declared columns that its files do not have
        self.json_values: list[str] = []       # planned values read as JSON with an inferred schema

    # -- step 1 --------------------------------------------------------------
    def plan(self) -> tuple[list[str], str]:
        a = self.args
        today = a.today or D.today_local()
        lit = lambda v: F.lit(v).cast("string")
        cfg = self.spark.range(1).select(
            lit(a.process_type).alias("process_type"), lit(a.date_type).alias("date_type"),
            lit(a.start_date or None).alias("start_date"), lit(a.end_date or None).alias("end_date"),
            lit(a.partition_key_raw).alias("partition_key_raw"), lit(self.file_name_excel).alias("file_name_excel"))
        row = plan_partitions(cfg, today).first()
        if row["plan_error"]:
            raise ValueError(row["plan_error"])
        raw_key = a.partition_key_raw_path.strip() or row["partition_key"]
        return list(row["partitions"]), raw_key

    # -- step 2 --------------------------------------------------------------
    def read(self, parts: list[str], raw_key: str, schema: Schema) -> DataFrame | None:
        """The declared columns of all planned partitions, one scan per format and distinct CSV header.

        ``self.absent`` notes which partitions lack which declared columns.
        """
        self.raw_key, self.absent, self.json_values = raw_key, {}, []
        if self.file_name_excel:
            path = self._resolve_file(self.file_name_excel)
            fmt = "excel" if path.lower().endswith(".xlsx") else ("json" if path.lower().endswith(".json") else "csv")
            if fmt == "excel":
                from tidewater.sources.xlsx import read_xlsx
                df = self._with_entity(read_xlsx(self.spark, path, sheet=self.excel_sheet, keep_path=True), schema)
            else:
                df = files.read_raw(self.spark, path, fmt)
            # a single file carries no partition value: added columns take the window start
            return df.withColumns({PARTITION_VALUE: F.lit(parts[0]),
                                   ADD_VALUE: F.lit(self.args.start_date or self.args.today or D.today_local())})
        frames = []
        for (fmt, _), values in self._detect(parts, raw_key).items():
            kw = {"infer": True} if (self.args.strict_types and fmt == "csv") else {}
            if fmt == "excel":
                kw.update(sheet=self.excel_sheet, first_only=self.args.excel_first_only)
            if fmt == "json" and self.args.json_declared_schema:
                kw["schema"] = files.text_schema(schema.names)
            part = files.read_partitions(self.spark, self.table_raw_path, raw_key, values, fmt, PARTITION_VALUE, **kw)
            if part is None:
                continue
            if fmt == "excel":
                part = self._with_entity(part, schema)
            if fmt == "json" and "schema" not in kw:
                self.json_values += values
            self.absent.update({v: set(schema.names) - set(part.columns) for v in values})
            # columns that are not declared never leave the scan
            frames.append(part.select(*[_quoted(c) for c in part.columns if c in schema.names], PARTITION_VALUE))
        if not frames:
            return None
        df = frames[0]
        if len(frames) > 1:
            # different formats or headers: align them as text, by column name
            texts = [f.select(*[_quoted(c).cast("string").alias(c) for c in f.columns]) for f in frames]
            df = texts[0]
            for f in texts[1:]:
                df = df.unionByName(f, allowMissingColumns=True)
        return df.withColumn(ADD_VALUE, F.col(PARTITION_VALUE))

    @staticmethod
    def _with_entity(df: DataFrame, schema: Schema) -> DataFrame:
        if schema.expects_entity() and "entidad" not in {c.lower() for c in df.columns}:
            df = df.withColumn("Entidad", entity_from_path(F.col("_source_path")))
        return df.drop("_source_path")

    def _profile(self, raw: DataFrame, schema: Schema) -> list[dict]:
        """One aggregate over all partitions; a column that a partition's own files lack is missing there,
        although the common schema fills it with NULLs. Bounded by partitions x checks."""
        rows = [r.asDict() for r in validate.profile(raw, list(schema.fields), by=[PARTITION_VALUE],
                                                     strict=self.args.strict_types,
                                                     relaxed=bool(self.file_name_excel)).collect()]
        absent = {v: set(c) for v, c in self.absent.items()}
        # JSON: only a column without any value in a partition can be lacking there; those partitions' keys decide
        doubt: dict[str, set[str]] = {}
        for r in rows:
            if r["check_name"] == "all_null" and r["value"] == 0 and r["total_rows"] and r[PARTITION_VALUE] in self.json_values:
                doubt.setdefault(r[PARTITION_VALUE], set()).add(r["column_name"])
        if doubt:
            for r in files.json_keys(self.spark, files.partition_glob(self.table_raw_path, self.raw_key, sorted(doubt)), self.raw_key) \
                          .where(F.col("name").isin(sorted(set().union(*doubt.values())))).collect():
                doubt[r["value"]].discard(r["name"])
            for v, columns in doubt.items():
                absent[v] |= columns
        # the entity comes from workbooks' names: next to them, other formats need not have it
        absent = {v: {c for c in columns if c.lower() != "entidad"} for v, columns in absent.items()}
        out = []
        for r in rows:
            if r["column_name"] in absent.get(r[PARTITION_VALUE], ()) and r["check_name"] != "missing_column":
                if r["check_name"] != "all_null":
                    continue
                r = {**r, "check_name": "missing_column", "value": r["total_rows"]}
            out.append(r)
        return out

    def _resolve_file(self, name: str) -> str:
        if "://" in name or name.startswith("/"):
            return name
        key = name.lstrip("/")
        if not (key.startswith(f"{self.key_raw}/") or key == self.key_raw):
            key = f"{self.key_raw}/{key}"
        return f"{self.args.root('raw')}/{key}"

    def _detect(self, parts: list[str], raw_key: str) -> dict[tuple, list[str]]:
        """Planned partition values grouped by the format detected in their directory
        (first supported file by key order) and, for CSV, by header line. A CSV
        partition of empty files only is in no group.

        A directory holding files but none of a supported type is an error, as is
        a missing directory when ``fail_on_missing`` is set; otherwise a missing
        directory is reported as an empty partition.
        """
        glob = files.partition_glob(self.table_raw_path, raw_key, parts)
        try:
            inv = files.file_inventory(self.spark, glob)
            # group by partition value (files may sit in sub-folders of a partition)
            value = F.regexp_extract("path", f"/{raw_key}=([^/]+)/", 1)
            fmt = format_of_path(F.col("path"))
            det = (inv.groupBy(value.alias("value"))
                      .agg(F.min_by(fmt, F.when(fmt.isNotNull(), F.col("path"))).alias("format"),
                           F.min(F.when((fmt == "csv") & (F.col("length") > 0), F.col("path"))).alias("head"))
                      .collect())
        except AnalysisException as e:
            if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
                raise
            det = []
        unsupported = sorted(r["value"] for r in det if r["format"] is None)
        if unsupported:
            raise RuntimeError(f"No supported file type (.csv, .json, .xlsx) found in "
                               f"{self.table_raw_path}/{raw_key}={unsupported[0]}")
        found = {r["value"] for r in det}
        missing = [p for p in parts if p not in found]
        if missing and self.args.fail_on_missing:
            raise FileNotFoundError(f"No files found in {self.table_raw_path}/{raw_key}={missing[0]}")
        heads = files.first_lines(self.spark, [r["head"] for r in det if r["format"] == "csv" and r["head"]])
        groups: dict[tuple, list[str]] = {}
        for r in sorted(det, key=lambda r: r["value"]):
            head = heads.get(r["head"]) if r["format"] == "csv" else ""
            if head is not None:
                groups.setdefault((r["format"], head), []).append(r["value"])
        return groups

    # -- report only -------------------------------------------------------------
    def validate(self) -> DataFrame | None:
        """Per planned partition: rows, status and first failure, without writing.

        One pass over the raw files (the profile); None when nothing was found.
        """
        a = self.args
        parts, raw_key = self.plan()
        schema = Schema.of(load_schema(self.spark, schema_doc_path(a.root("schema"), self.key_raw, self.excel_sheet)))
        raw = self.read(parts, raw_key, schema)
        if raw is None:
            return None
        return self._outcomes(self._profile(raw, schema)).withColumnRenamed(PARTITION_VALUE, "partition_value")

    def _outcomes(self, profile: list[dict]) -> DataFrame:
        rows = self.spark.createDataFrame(profile, f"{PARTITION_VALUE} string, check_name string, column_name string, value long, total_rows long")
        return report.partition_outcomes(rows, PARTITION_VALUE)

    def _registered_name(self) -> str | None:
        if not self.args.register_table:
            return None
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.args.catalog_database}`")
        return f"`{self.args.catalog_database}`.`{self.args.catalog_table}`"

    # -- the whole run -----------------------------------------------------------
    def run(self) -> StagingResult:
        a = self.args
        parts, raw_key = self.plan()
        log.info("%s: %s %s, %d planned partition(s) under %s=", a.job_name, a.process_type, a.date_type,
                 len(parts), raw_key)
        schema = Schema.of(load_schema(self.spark, schema_doc_path(a.root("schema"), self.key_raw, self.excel_sheet)))
        keys, to_add = project.split_partition_keys(a.partition_key_staging)
        merge_keys = M.parse_merge_keys(a.merge_keys)

        raw = self.read(parts, raw_key, schema)
        if raw is None:
            log.warning("%s: no raw files found for the planned partitions", a.job_name)
            return self._finish(parts, parts, 0)

        table = StagingTable(self.spark, self.table_staging_path, keys, self.catalog_table, self._registered_name())
        table.recover()
        # a failure leaves the staged content: the next load publishes what is whole and discards the rest
        result = self._load(parts, schema, raw, table, to_add, merge_keys)
        table._cleanup()
        return result

    def _load(self, parts, schema, raw, table, to_add, merge_keys) -> StagingResult:
        a = self.args
        if self.materialise_raw:
            # The only pass over the raw files (CSV/JSON/workbook parsing): a columnar
            # copy in the table's staging folder, which also cuts the lineage. The
            # profile, the casts and the write all read this copy.
            copy = f"{table._staging_dir()}/raw"
            raw.write.mode("overwrite").parquet(copy)
            raw = self.spark.read.parquet(copy)

        # one aggregate: per-partition row counts and every validation counter
        prof = self._profile(raw, schema)
        self.outcomes = [{"partition_value": r[PARTITION_VALUE], "n": r["n"], "partition_status": r["status"], "partition_error": r["error"]}
                         for r in self._outcomes(prof).collect()]
        rows_by_part = {r[PARTITION_VALUE]: r["total_rows"] for r in prof}
        failures_by_part: dict[str, list[dict]] = {}
        for r in prof:
            if r["check_name"] in ("missing_column", "unparseable", "required_null"):
                failures_by_part.setdefault(r[PARTITION_VALUE], []).append(
                    {"check_name": r["check_name"], "column_name": r["column_name"], "bad_rows": r["value"]})
        empty = [p for p in parts if not rows_by_part.get(p)]
        for p in parts:  # plan order: the first failing partition decides the error
            if p not in empty:
                validate.raise_for_report(failures_by_part.get(p, []))
        log.info("%s: %d row(s) in %d partition(s), %d empty", a.job_name, sum(v or 0 for v in rows_by_part.values()),
                 len(parts) - len(empty), len(empty))
        if len(empty) == len(parts):
            return self._finish(parts, empty, 0)

        df = raw
        for c in to_add:
            df = project.add_partition_column(df, c, F.col(ADD_VALUE))
        df = project.cast_by_schema(df, list(schema.fields))
        df = project.select_rename(df, list(schema.fields), keep=[*to_add, PARTITION_VALUE])
        df = project.normalize_column_names(df, untouched=[PARTITION_VALUE])

        missing = [k for k in table.partition_cols + (merge_keys or []) if k not in df.columns]
        if missing:
            raise ValueError(f"Staging partition or merge columns not in the staged data: {missing}; "
                             f"columns are {[c for c in df.columns if c != PARTITION_VALUE]}")
        log.info("%s: %s into %s (partitioned by %s)", a.job_name,
                 "overwrite" if merge_keys is None else f"merge on {merge_keys}", table.path, table.partition_cols)
        table.create(df.drop(PARTITION_VALUE))
        # one write for all raw partitions, with the outcome of writing them one after another
        if merge_keys is None:
            table.overwrite_partitions(df, order=PARTITION_VALUE)
        else:
            table.merge(df, merge_keys, materialise=not self.materialise_raw, keys_may_move=a.keys_may_move,
                        order=PARTITION_VALUE)
        written = sum(v for p, v in rows_by_part.items() if v)
        return self._finish(parts, empty, written)

    def _finish(self, parts, empty, written) -> StagingResult:
        if empty:
            msg = report.EMPTY_MESSAGE_PREFIX + ", ".join(empty)
            return StagingResult(report.STATUS_WARNING, parts, list(empty), written, msg)
        return StagingResult(report.STATUS_SUCCEEDED, parts, [], written, None)


def run_with_audit(spark: SparkSession, args: StagingArgs, audit_path: str | None = None) -> StagingResult:
    """Run the job and add its outcome, SUCCEEDED or FAILED (which re-raises), to the ledger at ``audit_path``.

    The outcomes of its partitions go along. A run that is repeated under its run id adds nothing.
    """
    params = {k: v for k, v in vars(args).items() if v is not None}
    run_id = args.job_run_id or uuid.uuid4().hex

    def audit(status: str, error: str | None, partitions: list[dict]) -> None:
        if audit_path:
            row = report.audit_row(args.job_name, status, error, params, args.job_run_id, args.project_name, args.stage)
            identity = [args.job_name, run_id, args.catalog_database, args.catalog_table, args.path_name_raw, args.start_date, args.end_date]
            if not ledger.append(spark, audit_path, row, identity, partitions):
                log.warning("%s: run %s is in the ledger already", args.job_name, run_id)

    job = None
    try:
        job = StagingJob(spark, args)
        result = job.run()
    except Exception as e:  # audit every failure, including planning errors
        audit(report.STATUS_FAILED, str(e), job.outcomes if job else [])
        raise
    audit(report.STATUS_SUCCEEDED, None, job.outcomes)
    return result


class PlanFailure(RuntimeError):
    """Some loads of a plan failed; ``results`` holds every load's outcome, in plan order (an exception where it failed)."""

    def __init__(self, results: list):
        self.results = results
        failed = [r for r in results if isinstance(r, Exception)]
        super().__init__(f"{len(failed)} of {len(results)} loads failed: " + "; ".join(str(e) for e in failed))


def run_plan(spark: SparkSession, staging_plan: DataFrame, process_type: str, date_type: str,
             audit_path: str | None = None, concurrency: int = 4, **defaults) -> list[StagingResult]:
    """Run one staging job per row of a staging plan (``plans.load_plan.staging_plan``).

    The plan is metadata (one row per dataset), so it is collected; each job is
    a distributed load. Up to ``concurrency`` loads run at a time, each from a thread
    and in a scheduler pool of its own, so that under fair scheduling
    (``session.build_session`` asks for it) a small load does not wait for a large one's tasks.
    Loads into the same table run one after the other, in plan order. ``defaults`` fills
    the arguments a plan row does not carry (job and project names, roots,
    buckets, options). A load that fails does not keep the others from running;
    ``PlanFailure`` is raised at the end.
    """
    results: list = []
    tables: dict[str, list[tuple[int, StagingArgs]]] = {}
    for row in staging_plan.collect():
        r = row.asDict()
        if r.get("plan_error"):
            results.append(ValueError(f"{r.get('catalog_table')}: {r['plan_error']}"))
            continue
        args = _plan_args(r, process_type, date_type, defaults)
        tables.setdefault(args.path_name_staging.strip().strip("/"), []).append((len(results), args))
        results.append(None)
    context = _context(spark)

    def load(one: tuple[str, list[tuple[int, StagingArgs]]]) -> None:
        name, loads = one
        if context is not None:
            context.setLocalProperty("spark.scheduler.pool", f"load {name}")
        for at, args in loads:
            try:
                results[at] = run_with_audit(spark, args, audit_path)
            except Exception as e:
                log.exception("%s failed", args.job_name)
                results[at] = e

    with ThreadPoolExecutor(max(1, concurrency)) as pool:
        list(pool.map(load, tables.items()))
    if any(isinstance(r, Exception) for r in results):
        raise PlanFailure(results)
    return results


def _plan_args(r: dict, process_type: str, date_type: str, defaults: dict) -> StagingArgs:
    """The arguments of a plan row's load."""
    kw = {"path_name_raw": r["path_name_raw"], "path_name_staging": r["path_name_staging"],
          "partition_key_raw": r["partition_key_raw"], "partition_key_staging": r["partition_key_staging"],
          "catalog_database": r["catalog_database"], "catalog_table": r["catalog_table"],
          "merge_keys": r["merge_keys"], "excel_sheet": r.get("excel_sheet") or "",
          "partition_key_raw_path": r.get("partition_key_raw_path") or "",
          "file_name_excel": r.get("file_name_excel") or "",
          "process_type": process_type, "date_type": date_type}
    # the plan's window is in days; a MONTH load plans whole months from it
    if date_type == D.MONTH:
        kw["start_date"], kw["end_date"] = r["start_date"][:7], r["end_date"][:7]
    else:
        kw["start_date"], kw["end_date"] = r["start_date"], r["end_date"]
    if process_type.upper() == "INC":  # the window is already resolved into dates
        kw["process_type"] = "FULL"
    fields = set(StagingArgs.__dataclass_fields__)
    kw.update({k: v for k, v in defaults.items() if k in fields})
    kw.setdefault("job_name", kw["catalog_table"])
    kw.setdefault("project_name", "")
    return StagingArgs(**kw)


# --- command line -------------------------------------------------------------------

OPTIONAL_ARGS = ("excel_sheet", "partition_key_raw_path", "file_name_excel")


def _optional(value: str | None) -> str:
    """Optional argument: blank, '-' or a value that is really the next flag -> ''."""
    v = (value or "").strip()
    return "" if (not v or v == "-" or v.startswith("--")) else v


def parse_args(argv: list[str]) -> tuple[StagingArgs, str | None]:
    import argparse
    p = argparse.ArgumentParser(prog="tidewater.job", description="Stage raw partitions into a staging table.")
    required = ["job_name", "project_name", "path_name_raw", "path_name_staging", "catalog_database",
                "catalog_table", "merge_keys", "partition_key_staging", "partition_key_raw", "process_type",
                "date_type"]
    for r in required:
        p.add_argument(f"--{r}", required=True)
    for o in ("start_date", "end_date", "bucket_name_raw", "bucket_name_schema", "bucket_name_staging",
              "notification_emails", "raw_root", "schema_root", "staging_root", "today", "audit_path",
              "stage", *OPTIONAL_ARGS):
        p.add_argument(f"--{o}", default="", nargs="?", const="")
    p.add_argument("--JOB_RUN_ID", "--job_run_id", dest="job_run_id", default="")
    p.add_argument("--catalog_name", default=CATALOG)
    p.add_argument("--strict_types", action="store_true")
    p.add_argument("--fail_on_missing", action="store_true")
    p.add_argument("--register_table", action="store_true")
    p.add_argument("--excel_first_only", action="store_true")
    p.add_argument("--validate_only", action="store_true")
    p.add_argument("--keys_stay_in_partition", dest="keys_may_move", action="store_false")
    ns, _unknown = p.parse_known_args(argv)
    kw = {k: v for k, v in vars(ns).items() if k not in ("audit_path", "validate_only")}
    for o in OPTIONAL_ARGS:
        kw[o] = _optional(kw[o])
    for o in ("raw_root", "schema_root", "staging_root", "today"):
        kw[o] = kw[o] or None
    args = StagingArgs(**kw)
    args.validate_only = ns.validate_only  # type: ignore[attr-defined]
    return args, (ns.audit_path or None)


def main(argv: list[str] | None = None) -> int:
    import sys

    from tidewater.session import build_session
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(name)s: %(message)s")
    args, audit = parse_args(sys.argv[1:] if argv is None else argv)
    spark = build_session(app_name=args.job_name)
    if getattr(args, "validate_only", False):
        out = StagingJob(spark, args).validate()
        if out is not None:
            for r in out.orderBy("partition_value").toLocalIterator():
                print(r.asDict())
        return 0
    result = run_with_audit(spark, args, audit)
    print(result)
    warning = result.warning_record(args)
    if warning:
        print(json.dumps(warning, ensure_ascii=False))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
