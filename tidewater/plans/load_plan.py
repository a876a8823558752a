"""Load plans: one parameter record per raw extraction / staging load.

Input is a table of dataset configurations (one row each), with ``params`` as
``map<string, struct<type:string, value:string>>`` in declaration order. The
plan is a projection of that table -- no driver loop -- so thousands of
datasets plan in one Spark stage.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewater.functions.dates import DAY, DAY_FMT, MONTH, full_window, incremental_window
from tidewater.functions.params import CUT_PARAM, END_PARAM, START_PARAM, json_ascii, rstrip_slashes

PARAMS_TYPE = "map<string,struct<type:string,value:string>>"
CONFIG_SCHEMA = (
    "name string, path_name_input string, file_name string, partition_key_raw string, "
    f"params {PARAMS_TYPE}, path_name_output string, catalog_database string, catalog_table string, "
    "merge_keys string, partition_key_staging string, excel_sheet string, partition_key_raw_path string, "
    "file_name_excel string"
)


def _validate(process_type: str, date_type: str) -> str:
    pt = process_type.upper()
    if pt not in ("FULL", "INC"):
        raise ValueError("Invalid 'process_type'. Must be 'FULL' or 'INC'.")
    if date_type not in (DAY, MONTH):
        raise ValueError("Invalid date_type. Expected 'DAY_PRECISION' or 'MONTH_PRECISION'.")
    return pt


def select_window(params: Column, process_type: str, date_type: str, today=None) -> tuple[Column, Column, Column]:
    """(start, end, error) of a config's load window, as ``yyyy-MM-dd`` text.

    FULL: ``fecha_inicial`` + ``fecha_final`` when both exist, else ``fecha_corte``
    twice, else an error. INC: the incremental window of ``today``.
    """
    pt = _validate(process_type, date_type)
    if pt == "INC":
        if today is None:
            raise ValueError("INC plans need 'today'")
        s, e = incremental_window(today, date_type)
        return F.date_format(s, DAY_FMT), F.date_format(e, DAY_FMT), F.lit(None).cast("string")
    has_range = F.map_contains_key(params, F.lit(START_PARAM)) & F.map_contains_key(params, F.lit(END_PARAM))
    has_cut = F.map_contains_key(params, F.lit(CUT_PARAM))
    start_txt = F.when(has_range, params[START_PARAM]["value"]).when(has_cut, params[CUT_PARAM]["value"])
    end_txt = F.when(has_range, params[END_PARAM]["value"]).when(has_cut, params[CUT_PARAM]["value"])
    s, e = full_window(start_txt, end_txt, date_type)
    err = (F.when(~(has_range | has_cut), F.lit("Missing date parameters for FULL process."))
            .when(s.isNull() | e.isNull(), F.lit("Invalid or inverted date parameters.")))
    return F.date_format(s, DAY_FMT), F.date_format(e, DAY_FMT), err


def params_json(params: Column, start: Column, end: Column) -> Column:
    """Parameters as compact JSON ``[{"name","type","value"},...]`` in map order,
    with the window start/end written into the date parameters; NULL when the
    window is invalid (the plan row then carries ``plan_error``).

    Pass the window as columns of a previous projection: they are referenced
    twice here, which keeps Catalyst from inlining the window expressions into
    the per-entry lambda (evaluated once per row instead of once per entry)."""
    def entry(e):
        k = e["key"]
        v = (F.when(k == START_PARAM, start)
              .when(k.isin(END_PARAM, CUT_PARAM), end)
              .otherwise(e["value"]["value"]))
        return F.struct(k.alias("name"), e["value"]["type"].alias("type"), v.alias("value"))
    doc = json_ascii(F.to_json(F.transform(F.map_entries(params), entry), {"ignoreNullFields": "false"}))
    return F.when(start.isNotNull() & end.isNotNull(), doc)


def _windowed(configs: DataFrame, process_type: str, date_type: str, today) -> DataFrame:
    s, e, err = select_window(F.col("params"), process_type, date_type, today)
    return configs.withColumns({"__start": s, "__end": e, "__error": err})


def raw_plan(configs: DataFrame, process_type: str, date_type: str, today=None) -> DataFrame:
    """Raw extraction payloads: name, path (trailing '/' cut), file name, raw key, params JSON."""
    w = _windowed(configs, process_type, date_type, today)
    return w.select(
        "name",
        rstrip_slashes("path_name_input").alias("path_name_input"),
        "file_name", "partition_key_raw",
        params_json(F.col("params"), F.col("__start"), F.col("__end")).alias("params"),
        F.col("__error").alias("plan_error"))


def staging_plan(configs: DataFrame, process_type: str, date_type: str, today=None) -> DataFrame:
    """Staging payloads; optional fields default to ''."""
    w = _windowed(configs, process_type, date_type, today)
    opt = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    return w.select(
        F.col("path_name_input").alias("path_name_raw"),
        F.col("path_name_output").alias("path_name_staging"),
        "partition_key_raw", "partition_key_staging", "catalog_database", "catalog_table", "merge_keys",
        opt("excel_sheet"), opt("partition_key_raw_path"), opt("file_name_excel"),
        F.col("__start").alias("start_date"), F.col("__end").alias("end_date"),
        F.col("__error").alias("plan_error"))


def load_plan(configs: DataFrame, job_type: str, process_type: str, date_type: str, today=None,
              db_type: str | None = "sqlserver", secret_db: str | None = None) -> DataFrame:
    """Both layers in one table: ``layer`` ('raw' / 'staging'), ``name`` and the window.

    job_type 'raw', 'staging' or 'raw-to-staging'; any other value plans nothing.
    Raw plans need ``db_type`` and ``secret_db``.
    """
    _validate(process_type, date_type)
    w = _windowed(configs, process_type, date_type, today)
    layers = []
    if job_type in ("raw", "raw-to-staging"):
        if db_type is None or secret_db is None:
            raise ValueError("Missing required parameters for raw job payload creation")
        layers.append(("raw", F.col("name")))
    if job_type in ("staging", "raw-to-staging"):
        layers.append(("staging", F.col("catalog_table")))
    if not layers:
        return configs.sparkSession.createDataFrame([], "layer string, name string, start_date string, end_date string")
    # one pass over the configs: each row fans out to its layers
    rows = F.array(*[F.struct(F.lit(layer).alias("layer"), name.alias("name"),
                              F.col("__start").alias("start_date"), F.col("__end").alias("end_date"))
                     for layer, name in layers])
    return w.select(F.inline(rows))


def configs_frame(spark, job_parameters: list[dict]):
    """Configuration table from a list of job-parameter records (metadata, one row each).

    ``params`` travels as JSON text and is parsed with ``from_json`` so the map
    keeps the declaration order; ``merge_keys`` given as a list is stored as
    comma text (the job accepts both)."""
    import json
    rows = []
    for c in job_parameters or []:
        r = dict(c)
        mk = r.get("merge_keys")
        if isinstance(mk, (list, tuple)):
            r["merge_keys"] = ",".join(str(k) for k in mk)
        r["params"] = json.dumps(r.get("params") or {})
        rows.append({k: r.get(k) for k in (
            "name", "path_name_input", "file_name", "partition_key_raw", "params", "path_name_output",
            "catalog_database", "catalog_table", "merge_keys", "partition_key_staging", "excel_sheet",
            "partition_key_raw_path", "file_name_excel")})
    text_schema = CONFIG_SCHEMA.replace(f"params {PARAMS_TYPE}", "params string")
    df = spark.createDataFrame(rows, text_schema)
    return df.withColumn("params", F.from_json("params", PARAMS_TYPE)).select(*[c.split()[0] for c in
                                                                             CONFIG_SCHEMA.split(", ")])


def build_payloads(spark, event: dict, today=None) -> dict:
    """Planner entry point: ``{"payloadParameters": {...}}`` -> raw and staging plan tables.

    ``project_name`` and ``notification_emails`` are mandatory, ``db_type``
    defaults to sqlserver. Unknown job types plan nothing.
    """
    p = event.get("payloadParameters", {})
    if p.get("project_name") is None or p.get("notification_emails") is None:
        raise ValueError("'project_name' and 'notification_emails' are required in the event parameters.")
    job_type, date_type, process_type = p["job_type"], p["date_type"], p["process_type"]
    db_type, secret_db = p.get("db_type", "sqlserver"), p.get("secret_db")
    pt = _validate(process_type, date_type)
    if today is None:
        from tidewater.functions.dates import today_local
        today = today_local()
    configs = configs_frame(spark, p["job_parameters"])
    empty_raw = spark.createDataFrame([], "name string, path_name_input string, file_name string, "
                                          "partition_key_raw string, params string, plan_error string")
    raw = empty_raw
    staging = None
    if job_type in ("raw", "raw-to-staging"):
        if db_type is None or secret_db is None:
            raise ValueError("Missing required parameters for raw job payload creation")
        raw = raw_plan(configs, pt, date_type, today)
    if job_type in ("staging", "raw-to-staging"):
        staging = staging_plan(configs, pt, date_type, today)
    if staging is None:
        staging = staging_plan(configs.limit(0), pt, date_type, today)
    return {"status": "payload generation complete", "payloads_raw": raw, "payloads_staging": staging}
