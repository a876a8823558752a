"""Registered queries: each staging operator run over the driver tables.

Every query builds its *raw* input from a clean table inside the plan (text
values, messy names, Spanish timestamps, files in a Hive layout), runs the
operator, and returns a result that an independent SQL query over the clean
table reproduces (``ORACLES``). Queries that need raw files write them once per
session under the shared scratch folder (the session's checkpoint dir).
"""

from __future__ import annotations

import threading
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.functions import casts, dates, names, params
from tidewater.operators import merge, project, report, validate
from tidewater.plans import load_plan, partitions
from tidewater.session import apply_staging_conf, scratch_path, session_key
from tidewater.sinks.manifest import Files
from tidewater.sinks.table import StagingTable, read_table
from tidewater.sources import files

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()

NBSP, NNBSP = "\u00a0", "\u202f"


def T(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def text_cols(df: DataFrame) -> DataFrame:
    """Every column as text, the way a CSV lands in the raw zone."""
    return df.select(*[F.col(c).cast("string").alias(c) for c in df.columns])


def spanish_ts(ts: Column, style: Column) -> Column:
    """Render a timestamp as Spanish 12-hour text in one of five spellings."""
    base = F.date_format(ts, "d/M/yyyy h:mm:ss")
    pm = F.hour(ts) >= 12
    return (F.when(style == 0, F.concat(base, F.lit(NBSP), F.when(pm, "p. m.").otherwise("a. m.")))
             .when(style == 1, F.concat(base, F.lit(NNBSP), F.when(pm, "P. M.").otherwise("A. M.")))
             .when(style == 2, F.concat(base, F.lit("  "), F.when(pm, "p.m.").otherwise("a.m.")))
             .when(style == 3, F.concat(F.lit(" "), base, F.lit(" "), F.when(pm, "p m").otherwise("a m")))
             .otherwise(F.concat(base, F.lit(" "), F.when(pm, "PM").otherwise("AM"))))


def _style_of_event(event_type: Column) -> Column:
    return (F.when(event_type == "view", 0).when(event_type == "click", 1)
             .when(event_type == "signup", 2).when(event_type == "purchase", 3).otherwise(4))


# --- raw zone fixtures (written once per session and table directory) --------
_written: dict = {}
_lock = threading.Lock()


def _once(spark: SparkSession, key: tuple, build: Callable[[], str]) -> str:
    k = (session_key(spark), *key)
    with _lock:
        if k not in _written:
            _written[k] = build()
        return _written[k]


def _raw_orders(o: DataFrame) -> DataFrame:
    return o.select(
        F.col("o_orderkey").cast("string").alias("OrderKey"),
        F.col("o_custkey").cast("string").alias("CustKey"),
        F.col("o_orderstatus").alias("Estado"),
        F.col("o_totalprice").cast("string").alias("TotalPrice"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("FechaOrden"),
        F.when((F.col("o_orderstatus") == "P") & (F.col("o_totalprice") < 10000), F.lit(None))
         .otherwise(F.col("o_orderpriority")).alias("Prioridad"),
        F.date_format("o_orderdate", "yyyy-MM").alias("mes"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"))


def _write_raw_csv(df: DataFrame, path: str, key: str) -> None:
    # no shuffle by the partition column (a hot day or month would land in one
    # task): each task writes its own rows, sorted so it keeps one file open
    (df.sortWithinPartitions(key).write.mode("overwrite")
       .options(header="true", sep=";", nullValue="\\N")
       .partitionBy(key).csv(path))


def raw_orders_dir(spark: SparkSession, sf_dir: str) -> str:
    """Orders as ';' CSV with header under ``mes=yyyy-MM`` (a MONTH_PRECISION raw dataset).

    Priority is missing (``\\N``) for pending orders under 10,000 -- the dirt the
    validation checks find.
    """
    def build() -> str:
        path = scratch_path(spark, "raw-orders")
        _write_raw_csv(_raw_orders(T(spark, sf_dir, "orders")).drop("fecha"), path, "mes")
        return path
    return _once(spark, (sf_dir, "orders"), build)


def raw_orders_daily_dir(spark: SparkSession, sf_dir: str) -> str:
    """The same orders under ``fecha=yyyy-MM-dd`` (a DAY_PRECISION raw dataset)."""
    def build() -> str:
        path = scratch_path(spark, "raw-orders-daily")
        _write_raw_csv(_raw_orders(T(spark, sf_dir, "orders")).drop("mes"), path, "fecha")
        return path
    return _once(spark, (sf_dir, "orders-daily"), build)


def raw_customer_json_dir(spark: SparkSession, sf_dir: str) -> str:
    """Customers as multi-line JSON: each file holds one JSON array of records."""
    def build() -> str:
        path = scratch_path(spark, "raw-customer-json")
        c = T(spark, sf_dir, "customer")
        docs = c.select(F.to_json(F.struct(*c.columns)).alias("j"))

        def to_array(batches):
            parts = [b["j"] for b in batches]
            if parts:
                body = pd.concat(parts, ignore_index=True)
                if len(body):
                    yield pd.DataFrame({"value": ["[" + ",".join(body.tolist()) + "]"]})
        docs.mapInPandas(to_array, "value string").write.mode("overwrite").text(path)
        return path
    return _once(spark, (sf_dir, "customer-json"), build)


def raw_customer_jsonl_by_nation(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = scratch_path(spark, "raw-customer-nation")
        c = T(spark, sf_dir, "customer")
        c.sortWithinPartitions("c_nationkey").write.mode("overwrite").partitionBy("c_nationkey").json(path)
        return path
    return _once(spark, (sf_dir, "customer-jsonl"), build)


def raw_orders_csv_flat(spark: SparkSession, sf_dir: str) -> str:
    def build() -> str:
        path = scratch_path(spark, "raw-orders-flat")
        o = T(spark, sf_dir, "orders")
        raw = o.select(
            F.col("o_orderkey"), F.col("o_custkey"),
            F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("o_orderstatus"),
            F.col("o_totalprice"),
            F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("o_orderdate"))
        raw.write.mode("overwrite").options(header="true", sep=";", nullValue="\\N").csv(path)
        return path
    return _once(spark, (sf_dir, "orders-flat"), build)


SUPPLIER_SHEET_HEADERS = ["Proveedor ID", "Nombre", "Nación", "Saldo", "Fecha Alta", "Activo", "Comentario",
                          "Bono", "Código"]
#: Most rows of a fixture workbook, about: far below what a sheet can hold.
WORKBOOK_ROWS = 50_000


def raw_supplier_workbooks(spark: SparkSession, sf_dir: str) -> str:
    """Suppliers as .xlsx workbooks (one per input partition) under ``{dir}/comisionista/``."""
    def build() -> str:
        from tidewater.sources.xlsx import write_workbooks
        path = scratch_path(spark, "raw-supplier-xlsx") + "/comisionista"
        s = T(spark, sf_dir, "supplier")
        nk = F.col("s_nationkey")
        rows = s.select(
            "s_suppkey", "s_name", "s_nationkey", "s_acctbal",
            F.date_add(F.lit("2020-01-01").cast("date"), nk).cast("timestamp_ntz").alias("fecha_alta"),
            (F.col("s_acctbal") > 0).alias("activo"),
            F.lit(None).cast("string").alias("comentario"),
            F.when(nk >= 5, F.col("s_acctbal")).alias("bono"),
            F.when(nk >= 5, nk).alias("codigo"))
        # several workbooks, round-robin: a task each, of a bounded number of rows
        write_workbooks(rows.repartition(max(3, -(-s.count() // WORKBOOK_ROWS))), path,
                        SUPPLIER_SHEET_HEADERS, sheet="Hoja 1", prefix="proveedores")
        return path
    return _once(spark, (sf_dir, "supplier-xlsx"), build)


ORDERS_RAW_FIELDS = [
    {"name": "OrderKey", "type": "bigint", "converted_type": "bigint", "converted_name": "o_orderkey", "nullable": False},
    {"name": "CustKey", "type": "bigint", "converted_type": "bigint", "converted_name": "o_custkey"},
    {"name": "Estado", "type": "string", "converted_type": "string", "converted_name": "o_orderstatus"},
    {"name": "TotalPrice", "type": "double", "converted_type": "double", "converted_name": "o_totalprice"},
    {"name": "FechaOrden", "type": "timestamp", "converted_type": "timestamp", "converted_name": "o_orderdate"},
    {"name": "Prioridad", "type": "string", "converted_type": "string", "converted_name": "o_orderpriority",
     "nullable": False},
]


def _month_bounds(spark: SparkSession, sf_dir: str) -> tuple[str, str]:
    r = T(spark, sf_dir, "orders").agg(F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("a"),
                                       F.date_format(F.max("o_orderdate"), "yyyy-MM").alias("b")).first()
    return r["a"], r["b"]


def _planned_months(spark: SparkSession, start: str, end: str) -> list[str]:
    """The month plan of a FULL load (bounded by the calendar, not the data)."""
    row = spark.range(1).select(dates.period_range(F.lit(start), F.lit(end), dates.MONTH).alias("p")).first()
    return list(row["p"])


def read_raw_orders(spark: SparkSession, sf_dir: str, months: list[str] | None = None) -> DataFrame:
    base = raw_orders_dir(spark, sf_dir)
    if months is None:
        months = _planned_months(spark, *_month_bounds(spark, sf_dir))
    return files.read_partitions(spark, base, "mes", months, "csv")


# --- projections -------------------------------------------------------------

def q_select_rename(spark, sf):
    """Raw orders with CamelCase names + an unused column; keep schema columns, rename (converted_name or snake_case)."""
    o = T(spark, sf, "orders")
    raw = o.select(F.col("o_orderkey").alias("OrderKey"), F.col("o_custkey").alias("CustKey"),
                   F.col("o_totalprice").alias("TotalPrice"), F.col("o_orderstatus").alias("EstadoSinUso"))
    fields = [{"name": "OrderKey", "type": "bigint", "converted_name": "order_key"},
              {"name": "CustKey", "type": "bigint"},
              {"name": "TotalPrice", "type": "double", "converted_name": "precio_total"},
              {"name": "Comentario", "type": "string"}]
    return project.select_rename(raw, fields)


def q_normalize_names(spark, sf):
    """P1+P3: accented, spaced customer column names -> snake_case -> accent folding, año->anio, slug."""
    c = T(spark, sf, "customer")
    raw = c.select(F.col("c_custkey").alias("CustomerID"), F.col("c_name").alias("Nómbre Completo"),
                   F.col("c_acctbal").alias("Año Saldo"), F.col("c_mktsegment").alias("Segmento"),
                   F.col("c_nationkey").alias("Nación"))
    fields = [{"name": "CustomerID", "type": "bigint"}, {"name": "Nómbre Completo", "type": "string"},
              {"name": "Año Saldo", "type": "double"}, {"name": "Segmento", "type": "string"}]
    return project.normalize_column_names(project.select_rename(raw, fields))


def q_snake_case_values(spark, sf):
    """P2 over values: CamelCase text built from part names and types -> snake_case."""
    p = T(spark, sf, "part")
    camel = F.concat(F.regexp_replace(F.initcap("p_name"), " ", ""), F.col("p_type"))
    return p.select("p_partkey", names.snake_case_col(camel).alias("snake"))


def q_accent_fold(spark, sf):
    """E5/E6 over whole document texts: accent folding and the año->anio word rule."""
    d = T(spark, sf, "documents")
    return d.select("doc_id", names.fold_accents_col("text").alias("folded"))


def q_slugify(spark, sf):
    """E7 over page URLs: non-word characters -> '_', collapsed and stripped."""
    p = T(spark, sf, "pages")
    return p.select("page_id", names.slugify_col("url").alias("slug"))


def q_sheet_key(spark, sf):
    """Sheet names with odd whitespace -> schema folder key."""
    c = T(spark, sf, "customer")
    sheet = F.concat(F.lit(" "), F.col("c_mktsegment"), F.lit(NBSP + " "), F.col("c_name"), F.lit("\t"))
    return c.select("c_custkey", names.sheet_key_col(sheet).alias("sheet_key"))


def q_add_partition_col(spark, sf):
    """P4/P5: 'add_' staging keys become literal partition columns."""
    e = T(spark, sf, "events").select("event_id", "event_type")
    keys, to_add = project.split_partition_keys("add_fecha_carga, event_type")
    for k in to_add:
        e = project.add_partition_column(e, k, "2024-01-31")
    return e.select("event_id", *keys)


def q_cast_by_schema(spark, sf):
    """Lineitem as text, cast by declared converted types in one projection, then renamed."""
    raw = text_cols(T(spark, sf, "lineitem"))
    fields = [{"name": "l_orderkey", "type": "string", "converted_type": "bigint"},
              {"name": "l_linenumber", "type": "string", "converted_type": "integer"},
              {"name": "l_quantity", "type": "string", "converted_type": "int", "converted_name": "qty"},
              {"name": "l_extendedprice", "type": "string", "converted_type": "number", "converted_name": "price"},
              {"name": "l_shipdate", "type": "string", "converted_type": "date", "converted_name": "ship_date"}]
    return project.select_rename(project.cast_by_schema(raw, fields), fields)


def q_cast_int(spark, sf):
    """Decimal text (truncated) and 'n/a' -> int."""
    li = T(spark, sf, "lineitem")
    txt = F.when(F.col("l_linenumber") == 3, F.lit("n/a")).otherwise(
        F.concat(F.lit(" "), (F.col("l_quantity") + F.col("l_discount")).cast("string")))
    return li.select("l_orderkey", "l_linenumber", casts.lenient_cast(txt, "int").alias("qty"))


def q_cast_bigint(spark, sf):
    """Padded digits and words -> bigint."""
    o = T(spark, sf, "orders")
    txt = F.when(F.col("o_orderpriority") == "5-LOW", F.lit("desconocido")).otherwise(
        F.concat(F.col("o_custkey").cast("string"), F.lit(" ")))
    return o.select("o_orderkey", casts.lenient_cast(txt, "long").alias("cust"))


def q_cast_double(spark, sf):
    """Price text and 'N/A' -> double."""
    li = T(spark, sf, "lineitem")
    txt = F.when(F.col("l_returnflag") == "R", F.lit("N/A")).otherwise(F.col("l_extendedprice").cast("string"))
    return li.select("l_orderkey", "l_linenumber", casts.lenient_cast(txt, "double").alias("price"))


def q_cast_decimal(spark, sf):
    """Price text -> decimal(18,2)."""
    o = T(spark, sf, "orders")
    return o.select("o_orderkey", casts.lenient_cast(F.col("o_totalprice").cast("string"), "DECIMAL(18,2)").alias("total"))


def q_cast_boolean(spark, sf):
    """C4: Y / false / other words -> boolean."""
    o = T(spark, sf, "orders")
    txt = (F.when(F.col("o_orderstatus") == "F", "Y").when(F.col("o_orderstatus") == "O", " false")
            .otherwise("pendiente"))
    return o.select("o_orderkey", casts.lenient_cast(txt, "bool").alias("closed"))


def q_cast_string(spark, sf):
    """Int -> string."""
    p = T(spark, sf, "part")
    return p.select("p_partkey", casts.lenient_cast(F.col("p_size"), "varchar", p.schema["p_size"].dataType)
                    .alias("size_text"))


# --- Spanish timestamps and calendars ----------------------------------------

def q_es_ampm_parse(spark, sf):
    """Event times rendered in five Spanish 12-hour spellings (NBSP, NNBSP, 'p. m.', 'p m', ...) -> timestamp."""
    e = T(spark, sf, "events")
    txt = spanish_ts(F.col("ts"), _style_of_event(F.col("event_type")))
    return e.select("event_id", casts.parse_es_ampm(txt).alias("ts"))


def _mixed_ts_text(e: DataFrame) -> Column:
    return (F.when(F.col("event_type") == "error", F.lit("sin fecha"))
             .when(F.col("event_type") == "view", F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
             .otherwise(spanish_ts(F.col("ts"), _style_of_event(F.col("event_type")))))


def q_safe_timestamp(spark, sf):
    """ISO text, Spanish text and junk -> timestamp (cast first, Spanish parse as fallback)."""
    e = T(spark, sf, "events")
    return e.select("event_id", casts.safe_timestamp(_mixed_ts_text(e)).alias("ts"))


def q_safe_date(spark, sf):
    """The same mixed text -> date."""
    e = T(spark, sf, "events")
    return e.select("event_id", casts.safe_date(_mixed_ts_text(e)).alias("d"))


def q_bogota_date(spark, sf):
    """UTC event times -> Bogota calendar date."""
    e = T(spark, sf, "events")
    return e.select("event_id", dates.local_date("ts").alias("local_date"))


def q_calendar_day(spark, sf):
    """D3: inclusive daily partition values between the first and last event day."""
    e = T(spark, sf, "events")
    b = e.agg(F.date_format(F.min("ts"), "yyyy-MM-dd").alias("s"), F.date_format(F.max("ts"), "yyyy-MM-dd").alias("e"))
    return b.select(F.explode(dates.period_range(F.col("s"), F.col("e"), dates.DAY)).alias("partition_date"))


def q_calendar_month(spark, sf):
    """D3: inclusive monthly partition values between the first and last order month."""
    o = T(spark, sf, "orders")
    b = o.agg(F.date_format(F.min("o_orderdate"), "yyyy-MM").alias("s"),
              F.date_format(F.max("o_orderdate"), "yyyy-MM").alias("e"))
    return b.select(F.explode(dates.period_range(F.col("s"), F.col("e"), dates.MONTH)).alias("partition_month"))


def q_parse_period(spark, sf):
    """Yyyy-MM / yyyy-MM-dd text -> first day of month."""
    o = T(spark, sf, "orders")
    txt = F.when(F.col("o_orderstatus") == "F", F.date_format("o_orderdate", "yyyy-MM-dd")) \
           .otherwise(F.date_format("o_orderdate", "yyyy-MM"))
    return o.select("o_orderkey", dates.parse_month(txt).alias("month_start"))


def q_previous_period(spark, sf):
    """Previous day / month relative to each order date as 'today'."""
    o = T(spark, sf, "orders")
    today = F.to_date("o_orderdate")
    return o.select("o_orderkey", dates.previous_period(today, dates.DAY).alias("prev_day"),
                    dates.previous_period(today, dates.MONTH).alias("prev_month"))


def q_incremental_window(spark, sf):
    """Incremental MONTH window relative to each order date as 'today'."""
    o = T(spark, sf, "orders")
    s, e = dates.incremental_window(F.col("o_orderdate"), dates.MONTH)
    return o.select("o_orderkey", s.alias("win_start"), e.alias("win_end"))


def q_full_window(spark, sf):
    """FULL MONTH window of each order's month."""
    o = T(spark, sf, "orders")
    m = F.date_format("o_orderdate", "yyyy-MM")
    s, e = dates.full_window(m, m, dates.MONTH)
    return o.select("o_orderkey", s.alias("win_start"), e.alias("win_end"))


def _supplier_configs(spark, sf) -> DataFrame:
    s = T(spark, sf, "supplier")
    nk = F.col("s_nationkey")
    return s.select(
        "s_suppkey", "s_name",
        F.when(nk < 5, "FULL").when(nk < 10, "INC").when(nk < 15, "FULL").when(nk < 20, "FULL")
         .otherwise("INC").alias("process_type"),
        F.when(nk < 5, dates.DAY).when(nk < 8, dates.DAY).when(nk < 10, dates.MONTH)
         .when(nk < 15, dates.DAY).when(nk < 20, dates.MONTH).otherwise(dates.DAY).alias("date_type"),
        F.when(nk < 5, "2025-01-01").when((nk >= 15) & (nk < 20), "2024-11").alias("start_date"),
        F.when(nk < 5, "2025-01-03").when((nk >= 15) & (nk < 20), "2025-01").alias("end_date"),
        F.when((nk >= 10) & (nk < 15), "add_fecha").otherwise("fecha").alias("partition_key_raw"),
        F.when(nk >= 20, F.concat(F.lit("proveedores/"), F.col("s_name"), F.lit(".xlsx"))).alias("file_name_excel"))


def q_partition_plan(spark, sf):
    """Supplier rows as job configs (FULL/INC/add_/file modes) -> planned partitions."""
    planned = partitions.plan_partitions(_supplier_configs(spark, sf), today="2025-01-15")
    return partitions.explode_plan(planned, "s_suppkey")


# --- sources -----------------------------------------------------------------

def q_partition_scan(spark, sf):
    """Twelve planned months of the raw orders zone in one pruned CSV scan, cast and renamed."""
    months = _planned_months(spark, "1997-01", "1997-12")
    raw = read_raw_orders(spark, sf, months)
    staged = project.select_rename(project.cast_by_schema(raw, ORDERS_RAW_FIELDS), ORDERS_RAW_FIELDS, keep=["mes"])
    return staged.select("o_orderkey", "o_totalprice", "mes")


def q_csv_scan(spark, sf):
    """S1: ';' CSV with '\\N' nulls read as text, cast by schema."""
    path = raw_orders_csv_flat(spark, sf)
    raw = files.read_csv(spark, path)
    fields = [{"name": "o_orderkey", "type": "bigint", "converted_type": "bigint"},
              {"name": "o_custkey", "type": "bigint", "converted_type": "bigint"},
              {"name": "o_orderstatus", "type": "string"},
              {"name": "o_totalprice", "type": "double", "converted_type": "double"},
              {"name": "o_orderdate", "type": "timestamp", "converted_type": "timestamp"}]
    return project.select_rename(project.cast_by_schema(raw, fields), fields)


def q_json_scan(spark, sf):
    """Multi-line JSON arrays read and cast by schema."""
    path = raw_customer_json_dir(spark, sf)
    raw = files.read_json(spark, path, glob=None)
    fields = [{"name": "c_custkey", "type": "long", "converted_type": "bigint"},
              {"name": "c_name", "type": "string"},
              {"name": "c_nationkey", "type": "long", "converted_type": "int"},
              {"name": "c_acctbal", "type": "double", "converted_type": "double"},
              {"name": "c_mktsegment", "type": "string"}]
    return project.select_rename(project.cast_by_schema(raw, fields), fields)


def q_partition_counts(spark, sf):
    """Rows per raw partition of the whole orders zone."""
    raw = read_raw_orders(spark, sf)
    return report.partition_counts(raw, "mes", "partition_month")


def q_empty_partitions(spark, sf):
    """Planned days of the daily raw zone that hold no rows."""
    o = T(spark, sf, "orders")
    b = o.agg(F.date_format(F.min("o_orderdate"), "yyyy-MM-dd").alias("s"),
              F.date_format(F.max("o_orderdate"), "yyyy-MM-dd").alias("e"))
    planned = b.select(F.explode(dates.period_range(F.col("s"), F.col("e"), dates.DAY)).alias("partition_date"))
    days = [r["partition_date"] for r in planned.collect()]  # the plan: bounded by the calendar
    raw = files.read_partitions(spark, raw_orders_daily_dir(spark, sf), "fecha", days, "csv")
    counts = report.partition_counts(raw, "fecha", "partition_date")
    return report.empty_partitions(planned, counts, "partition_date")


def q_detect_format(spark, sf):
    """Format of every raw partition directory from a file inventory (contents not read)."""
    inv = files.file_inventory(spark, raw_orders_dir(spark, sf)).unionByName(
        files.file_inventory(spark, raw_customer_jsonl_by_nation(spark, sf)))
    det = files.detect_formats(inv)
    return det.select(F.regexp_extract("directory", "=([^/=]+)$", 1).alias("partition_value"), "format")


def q_entity_from_path(spark, sf):
    """Entity name carried by each page URL."""
    p = T(spark, sf, "pages")
    return p.select("page_id", params.entity_from_path("url").alias("entity"))


def q_xlsx_scan(spark, sf):
    """S3: supplier workbooks decoded, typed, cast and renamed."""
    from tidewater.sources.xlsx import read_xlsx
    raw = read_xlsx(spark, raw_supplier_workbooks(spark, sf), sheet="Hoja 1")
    fields = [{"name": "Proveedor ID", "type": "long", "converted_name": "s_suppkey"},
              {"name": "Nombre", "type": "string", "converted_name": "s_name"},
              {"name": "Nación", "type": "long", "converted_type": "int", "converted_name": "s_nationkey"},
              {"name": "Saldo", "type": "double", "converted_name": "s_acctbal"},
              {"name": "Fecha Alta", "type": "timestamp"},
              {"name": "Activo", "type": "boolean"}]
    return project.normalize_column_names(project.select_rename(project.cast_by_schema(raw, fields), fields))


def q_cell_type_inference(spark, sf):
    """Inferred column types of the supplier workbooks."""
    from tidewater.sources.xlsx import infer_types, read_cells
    cells = read_cells(spark, raw_supplier_workbooks(spark, sf), sheet="Hoja 1")
    return infer_types(cells).select("column_name", "spark_type")


# --- validation --------------------------------------------------------------

def q_all_null_columns(spark, sf):
    """V3/A3: columns without any value."""
    o = text_cols(T(spark, sf, "orders")).withColumn("o_clerk", F.lit(None).cast("string"))
    fields = [{"name": c, "type": "string"} for c in o.columns]
    return validate.all_null_columns(o, fields)


def _dirty_customer(spark, sf) -> DataFrame:
    c = T(spark, sf, "customer")
    return text_cols(c.select(
        "c_custkey",
        F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("")).otherwise(F.col("c_name")).alias("c_name"),
        "c_nationkey",
        F.when(F.col("c_acctbal") < 0, F.lit("negativo")).otherwise(F.col("c_acctbal").cast("string")).alias("c_acctbal"),
        F.when(F.col("c_mktsegment") != "BUILDING", F.col("c_mktsegment")).alias("c_mktsegment")))


CUSTOMER_FIELDS = [
    {"name": "c_custkey", "type": "bigint", "nullable": False},
    {"name": "c_name", "type": "string", "nullable": False},
    {"name": "c_nationkey", "type": "int"},
    {"name": "c_acctbal", "type": "double"},
    {"name": "c_mktsegment", "type": "string", "nullable": False},
    {"name": "c_comment", "type": "string"},
]


def q_required_nulls(spark, sf):
    """V5/A2: NULL and empty counts of required customer columns."""
    return validate.required_nulls(_dirty_customer(spark, sf), CUSTOMER_FIELDS)


def q_validation_report(spark, sf):
    """V1/V2/V5/V6: missing column, unparseable values and required NULLs in one profile."""
    return validate.validation_report(_dirty_customer(spark, sf), CUSTOMER_FIELDS)


def q_type_conformance(spark, sf):
    """V2: per typed column, rows and values that do not parse as declared."""
    li = T(spark, sf, "lineitem")
    raw = text_cols(li.withColumn("l_extendedprice", F.when(F.col("l_returnflag") != "R", F.col("l_extendedprice").cast("string"))
                                  .otherwise(F.lit("N/A"))))
    fields = [{"name": "l_linenumber", "type": "int"}, {"name": "l_quantity", "type": "double"},
              {"name": "l_extendedprice", "type": "double"}, {"name": "l_shipdate", "type": "timestamp"},
              {"name": "l_returnflag", "type": "string"}]
    return validate.type_conformance(raw, fields)


# --- writes (logical results) --------------------------------------------------

def _merge_batches(spark, sf):
    o = T(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderdate")
    target = o.where(F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp_ntz"))
    source = (o.where(F.col("o_orderdate") >= F.lit("1997-07-01").cast("timestamp_ntz"))
               .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return target, source


def q_merge_upsert(spark, sf):
    """K4: a later batch (updated prices) merged into an earlier one on the order key."""
    target, source = _merge_batches(spark, sf)
    keys = merge.parse_merge_keys(" o_orderkey ")
    return merge.merge_upsert(target, source, keys).select("o_orderkey", "o_custkey", "o_totalprice")


def q_merge_dup_keys(spark, sf):
    """K5: keys carried by more than one source row."""
    o = T(spark, sf, "orders")
    return merge.duplicate_keys(o, ["o_custkey"])


def q_overwrite_partitions(spark, sf):
    """K3: a re-loaded status partition replaces the old one."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", "o_orderdate")
    source = o.where((F.col("o_orderstatus") == "F") & (F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")))
    return merge.overwrite_partitions(o, source, ["o_orderstatus"]).select("o_orderkey", "o_orderstatus", "o_orderpriority")


def q_schema_sync(spark, sf):
    """K2: a later batch adds a column and widens int -> bigint."""
    c = T(spark, sf, "customer")
    first = c.where(F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")).select("c_custkey", "c_name", "c_nationkey")
    later = c.where(~F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")).select(
        "c_custkey", "c_name", F.col("c_nationkey").cast("bigint").alias("c_nationkey"), "c_acctbal")
    return merge.append_synced(first, later)


def q_run_audit(spark, sf):
    """K7/V6: what the ledger has of a load of the raw orders zone that its required priority fails, run twice under one id."""
    from tidewater.job import run_with_audit
    from tidewater.sinks import ledger
    fields = [{**f, "nullable": False} if f["name"] == "Prioridad" else f for f in JOB_FIELDS]
    args, zone = _orders_job(spark, sf, "audit", fields, job_run_id="run-1")
    for _ in range(2):
        try:
            run_with_audit(spark, args, f"{zone}/ledger")
        except ValueError:  # the priority is required; the ledger has the reason
            pass
    return (ledger.read(spark, f"{zone}/ledger").where("partition_value IS NOT NULL")
            .select(F.col("partition_value").alias("partition_month"), "n", F.col("partition_status").alias("status"),
                    F.col("partition_error").alias("error")))


def q_empty_partitions_message(spark, sf):
    """K6: the empty-partition warning text."""
    return report.empty_partitions_message(q_empty_partitions(spark, sf), "partition_date")


# --- schema documents and whole-job runs ------------------------------------------

def _write_text(path: str, text: str) -> None:
    """Write one small metadata document through pyarrow's filesystem layer."""
    from pyarrow import fs as pafs
    uri = path.replace("file:///", "/").replace("file:/", "/") if path.startswith("file:") else path
    filesystem, p = pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)
    filesystem.create_dir(p.rsplit("/", 1)[0], recursive=True)
    with filesystem.open_output_stream(p) as f:
        f.write(text.encode("utf-8"))


JOB_FIELDS = [
    {"name": "OrderKey", "type": "bigint", "converted_type": "bigint", "converted_name": "o_orderkey", "nullable": False},
    {"name": "CustKey", "type": "bigint", "converted_type": "bigint", "converted_name": "o_custkey"},
    {"name": "Estado", "type": "string", "converted_name": "o_orderstatus"},
    {"name": "TotalPrice", "type": "double", "converted_type": "double", "converted_name": "o_totalprice"},
    {"name": "FechaOrden", "type": "timestamp", "converted_type": "timestamp", "converted_name": "o_orderdate"},
    {"name": "Prioridad", "type": "string", "converted_name": "o_orderpriority"},
]


def _orders_job(spark, sf, name: str, fields: list[dict], **more):
    """Arguments of a FULL monthly load of the raw orders zone, and its folder."""
    import json

    from tidewater.job import StagingArgs
    raw_root, key = raw_orders_dir(spark, sf).rsplit("/", 1)
    zone = scratch_path(spark, name)
    _write_text(f"{zone}/schema/{key}/schema.json", json.dumps({"fields": fields}))
    start, end = _month_bounds(spark, sf)
    return StagingArgs(job_name="staging_orders", project_name="tidewater", path_name_raw=key,
                       path_name_staging="ordenes", catalog_database="staging", catalog_table="ordenes",
                       merge_keys="o_orderkey", partition_key_staging="add_mes_carga", partition_key_raw="mes",
                       process_type="FULL", date_type=dates.MONTH, start_date=start, end_date=end,
                       raw_root=raw_root, schema_root=f"{zone}/schema", staging_root=f"{zone}/staging", **more), zone


def q_staging_job(spark, sf):
    """FULL monthly load of the whole raw orders zone into a merged staging table."""
    from tidewater.job import StagingJob
    args, zone = _orders_job(spark, sf, "job", JOB_FIELDS)
    StagingJob(spark, args).run()
    return read_table(spark, f"{zone}/staging/ordenes")


def q_stream_incremental(spark, sf):
    """The raw orders zone staged by an availableNow file stream, merged on the key."""
    from tidewater.streaming.incremental import run_incremental
    zone = scratch_path(spark, "stream")
    table = StagingTable(spark, f"{zone}/table", ["mes_carga"])
    run_incremental(spark, raw_orders_dir(spark, sf), JOB_FIELDS, table, "o_orderkey", "mes", "add_mes_carga",
                    checkpoint=f"{zone}/checkpoint")
    return table.read()


def _drift_stream(spark, sf) -> tuple[StagingTable, str]:
    """The raw months of three headers staged by a stream; returns the table and its ledger."""
    from tidewater.streaming.incremental import run_incremental
    zone = scratch_path(spark, "stream-drift")
    table = StagingTable(spark, f"{zone}/table", ["mes_carga"])
    run_incremental(spark, raw_orders_drift_dir(spark, sf, 3), DRIFT_FIELDS, table, "o_orderkey", "mes", "add_mes_carga",
                    checkpoint=f"{zone}/checkpoint", invalid="report", audit_path=f"{zone}/ledger")
    return table, f"{zone}/ledger"


def q_stream_drift(spark, sf):
    """S6/V1 in a stream: files of three headers, routed by header; months that lack a declared column are left out."""
    return _drift_stream(spark, sf)[0].read()


def q_stream_audit(spark, sf):
    """K7/V1 in a stream: the ledger's row for each raw month of the batch."""
    from tidewater.sinks import ledger
    return ledger.read(spark, _drift_stream(spark, sf)[1]).where("partition_value IS NOT NULL").select(
        "partition_value", "n", "partition_status", "partition_error", F.col("status").alias("batch_status"))


# --- the stored table: what the sink itself leaves behind -----------------------

def _sink(spark, name: str, partition_cols: list[str]):
    return StagingTable(spark, f"{scratch_path(spark, name)}/table", partition_cols)


def _sink_orders(spark, sf) -> DataFrame:
    """Orders with a partition text that holds NULLs and characters a path must escape."""
    return T(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", "o_totalprice", "o_orderdate",
        F.when(F.col("o_orderstatus") == "F", "a:b/c, d=1").when(F.col("o_orderstatus") == "O", "100%").alias("clase"))


def q_sink_merge(spark, sf):
    """K4: a second load updates keys, inserts keys, and moves keys from one partition (also NULL) to another."""
    o = _sink_orders(spark, sf)
    table = _sink(spark, "sink-merge", ["clase"])
    table.merge(o.where("o_orderdate < timestamp_ntz'1998-01-01'"), ["o_orderkey"])
    later = o.where("o_orderdate >= timestamp_ntz'1997-07-01'")
    table.merge(later.withColumns({
        "o_totalprice": F.col("o_totalprice") + 1,
        "clase": F.when(F.col("o_custkey") % 5 == 0, F.lit("nueva")).when(F.col("o_custkey") % 5 != 1, F.col("clase"))}),
        ["o_orderkey"])
    return table.read().select("o_orderkey", "o_custkey", "o_totalprice", "clase")


def q_sink_overwrite(spark, sf):
    """K3: a second load replaces the partitions it writes (escaped and NULL ones too) and leaves the others."""
    o = _sink_orders(spark, sf)
    table = _sink(spark, "sink-overwrite", ["clase"])
    table.overwrite_partitions(o)
    table.overwrite_partitions(o.where("(clase IS NULL OR clase <> '100%') AND o_orderdate >= timestamp_ntz'1997-01-01'")
                                .withColumn("o_totalprice", F.col("o_totalprice") + 1))
    return table.read().select("o_orderkey", "o_totalprice", "clase")


def q_sink_schema_sync(spark, sf):
    """K1/K2: a second load brings a wider type and a new column; stored files stay as they are."""
    c = T(spark, sf, "customer").withColumn("c_nationkey", F.col("c_nationkey").cast("int"))
    early = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    table = _sink(spark, "sink-sync", ["c_mktsegment"])
    table.merge(c.where(early).select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), ["c_custkey"])
    table.merge(c.where(~early).select("c_custkey", "c_name", F.col("c_nationkey").cast("bigint").alias("c_nationkey"),
                                       "c_acctbal", "c_mktsegment"), ["c_custkey"])
    return table.read().select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def q_sink_schema_growth(spark, sf):
    """K2: a later load brings more decimal digits, a struct with one more field and a wider one, and wider array elements."""
    c = T(spark, sf, "customer")
    early = F.col("c_mktsegment").isin("AUTOMOBILE", "BUILDING")
    table = _sink(spark, "sink-growth", ["c_mktsegment"])
    table.merge(c.where(early).select(
        "c_custkey", F.col("c_acctbal").cast("decimal(9,2)").alias("saldo"), "c_mktsegment",
        F.struct(F.col("c_nationkey").cast("int").alias("pais"), F.col("c_name").alias("nombre")).alias("datos"),
        F.array(F.col("c_nationkey").cast("int")).alias("codigos")), ["c_custkey"])
    table.merge(c.where(~early).select(
        "c_custkey", (F.col("c_acctbal") + 0.0001).cast("decimal(15,4)").alias("saldo"), "c_mktsegment",
        F.struct(F.col("c_name").alias("contacto"), F.col("c_nationkey").cast("bigint").alias("pais")).alias("datos"),
        F.array(F.col("c_nationkey").cast("bigint"), F.lit(3_000_000_000)).alias("codigos")), ["c_custkey"])
    return table.read().select("c_custkey", F.col("saldo").cast("double").alias("saldo"), "datos.pais", "datos.nombre", "datos.contacto",
                               F.element_at("codigos", -1).alias("codigo"), "c_mktsegment")


def raw_orders_drift_dir(spark: SparkSession, sf_dir: str, kinds: int) -> str:
    """All orders by month, with ``kinds`` headers in turn. The second kind has columns in another order, one more, a column
    named as the raw key, and besides its own the orders of the month before, all at another price; the third lacks the status."""
    def build() -> str:
        path = scratch_path(spark, "raw-orders-drift")
        month, place = F.date_format("o_orderdate", "yyyy-MM"), F.year("o_orderdate") * 12 + F.month("o_orderdate")
        o = T(spark, sf_dir, "orders").select("*", month.alias("m"), place.alias("i"))
        last = o.agg(F.max("i")).first()[0]
        text = lambda c: F.col(c).cast("string")
        key, price, state = text("o_orderkey").alias("OrderKey"), text("o_totalprice"), F.col("o_orderstatus").alias("Estado")
        options = {"header": "true", "sep": ";", "nullValue": "\\N"}
        of = lambda k: o.where(F.col("i") % kinds == k)
        of(0).select(key, price.alias("TotalPrice"), state, F.col("m").alias("mes")).write.options(**options).partitionBy("mes").csv(path)
        again = of(0).where(F.col("i") < last).withColumn("at", F.date_format(F.add_months("o_orderdate", 1), "yyyy-MM"))
        (of(1).withColumn("at", F.col("m")).unionByName(again)
         .select(F.lit("x").alias("Nota"), state, (F.col("o_totalprice") + 1).cast("string").alias("TotalPrice"), key, F.col("m").alias("mes"), "at")
         .write.options(**options).partitionBy("at").csv(f"{path}-second"))
        if kinds > 2:
            of(2).select(price.alias("TotalPrice"), key, F.col("m").alias("mes")).write.mode("append").options(**options).partitionBy("mes").csv(path)
        found = Files(spark, path)  # a writer takes a partition's column out of the file, so these folders get their name afterwards
        for folder in found.folders(f"{path}-second", 1):
            found.fs.rename(found.path(f"{path}-second/{folder}"), found.path(f"{path}/mes={folder.split('=', 1)[1]}"))
        return path
    return _once(spark, (sf_dir, f"orders-drift-{kinds}"), build)


DRIFT_FIELDS = [{"name": "OrderKey", "type": "bigint", "converted_type": "bigint", "converted_name": "o_orderkey"},
                {"name": "TotalPrice", "type": "double", "converted_type": "double", "converted_name": "o_totalprice"},
                {"name": "Estado", "type": "string", "converted_name": "o_orderstatus"}]


def _drift_job(spark, sf, kinds: int):
    import json

    from tidewater.job import StagingArgs, StagingJob
    raw_root, key = raw_orders_drift_dir(spark, sf, kinds).rsplit("/", 1)
    zone = scratch_path(spark, "drift")
    _write_text(f"{zone}/schema/{key}/schema.json", json.dumps({"fields": DRIFT_FIELDS}))
    start, end = _month_bounds(spark, sf)
    return StagingJob(spark, StagingArgs(
        job_name="drift", project_name="tidewater", path_name_raw=key, path_name_staging="ordenes",
        catalog_database="staging", catalog_table="ordenes", merge_keys="o_orderkey", partition_key_staging="add_mes_carga",
        partition_key_raw="mes", process_type="FULL", date_type=dates.MONTH, start_date=start, end_date=end,
        raw_root=raw_root, schema_root=f"{zone}/schema", staging_root=f"{zone}/staging")), f"{zone}/staging/ordenes"


def q_staging_job_overlap(spark, sf):
    """K4/K5: one load of all raw months; an order that is in two has the later month's row."""
    job, path = _drift_job(spark, sf, 2)
    job.run()
    return read_table(spark, path)


def q_drift_scan(spark, sf):
    """Raw months whose headers differ, each read by its own header; a file column named as the raw key stays."""
    job, _ = _drift_job(spark, sf, 3)
    from tidewater.job import PARTITION_VALUE
    from tidewater.schema import Schema
    parts, raw_key = job.plan()
    df = job.read(parts, raw_key, Schema.of([*DRIFT_FIELDS, {"name": "mes", "type": "string"}]))
    return df.select(F.col("OrderKey").alias("o_orderkey"), F.col("TotalPrice").cast("double").alias("o_totalprice"),
                     F.col("Estado").alias("o_orderstatus"), F.col("mes").alias("file_mes"),
                     F.col(PARTITION_VALUE).alias("raw_month"))


def q_missing_by_partition(spark, sf):
    """V1/V6: a column that some raw months lack is missing in those only."""
    job, _ = _drift_job(spark, sf, 3)
    return job.validate().select("partition_value", "n", "status", "error")


def q_create_partitioned(spark, sf):
    """K1: a table of the session catalog, read by its name after create, evolve, merge and a month that is emptied."""
    o = T(spark, sf, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus", F.date_format("o_orderdate", "yyyy-MM").alias("mes"))
    first, last = _month_bounds(spark, sf)
    name = f"ordenes_{scratch_path(spark, 'x').rsplit('-', 1)[1]}"
    table = StagingTable(spark, f"{scratch_path(spark, 'create-partitioned')}/table", ["mes"], register=name)
    slim = o.select(F.col("o_orderkey").cast("int").alias("o_orderkey"), "o_totalprice", "mes")
    table.create(slim)
    table.merge(slim, ["o_orderkey"])
    # a wider key, a new column, new prices; the orders of the first month move to the last
    late = o.where((F.col("o_orderstatus") == "P") | (F.col("mes") == first)).withColumns({
        "o_orderkey": F.col("o_orderkey").cast("bigint"), "o_totalprice": F.col("o_totalprice") + 1,
        "mes": F.when(F.col("mes") == first, F.lit(last)).otherwise(F.col("mes"))})
    table.merge(late, ["o_orderkey"])
    return spark.table(name)


def q_cast_epoch(spark, sf):
    """Numbers become timestamps as seconds since 1970."""
    o = T(spark, sf, "orders")
    seconds = F.unix_timestamp(F.col("o_orderdate").cast("timestamp"))
    raw = o.select("o_orderkey", seconds.alias("whole"), (seconds + F.lit(0.5)).cast("double").alias("half"))
    return raw.select("o_orderkey", casts.lenient_cast(F.col("whole"), "timestamp", raw.schema["whole"].dataType).alias("ts"),
                      casts.lenient_cast(F.col("half"), "timestamp", raw.schema["half"].dataType).alias("ts_half"))


def q_safe_timestamp_offset(spark, sf):
    """Text with an offset is an instant and becomes its UTC wall clock."""
    o = T(spark, sf, "orders")
    local = F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss")
    text = F.when(F.col("o_orderstatus") == "F", F.concat(local, F.lit("-05:00"))) \
            .when(F.col("o_orderstatus") == "O", F.concat(local, F.lit("Z"))).otherwise(local)
    return o.select("o_orderkey", casts.safe_timestamp(text).alias("ts"))


def q_xlsx_na(spark, sf):
    """Cell texts that mean "no value" are NULL and leave the column its number type."""
    from tidewater.sources.xlsx import read_xlsx, write_workbooks

    def build() -> str:
        path = scratch_path(spark, "raw-supplier-na")
        s = T(spark, sf, "supplier")
        na = F.element_at(F.array(*[F.lit(x) for x in ("#N/A", "NA", "null", "NaN", "n/a")]), (F.col("s_nationkey") % 5 + 1).cast("int"))
        rows = s.select("s_suppkey", F.when(F.col("s_nationkey") < 5, na).otherwise(F.col("s_name")).alias("n"),
                        F.when(F.col("s_nationkey") >= 5, F.col("s_acctbal")).alias("saldo"), na.alias("nada"))
        write_workbooks(rows.repartition(4, "s_suppkey"), path, ["Clave", "Nombre", "Saldo", "Nada"])
        return path
    df = read_xlsx(spark, _once(spark, (sf, "supplier-na"), build))
    kinds = dict(df.dtypes)
    return df.select(F.col("Clave").alias("s_suppkey"), F.col("Nombre").alias("s_name"), F.col("Saldo").alias("s_acctbal"),
                     F.col("Nada").alias("nada"), F.lit(f"{kinds['Clave']},{kinds['Saldo']},{kinds['Nada']}").alias("kinds"))


# --- plans -----------------------------------------------------------------------

def _order_params(o: DataFrame) -> Column:
    st = lambda t, v: F.struct(F.lit(t).alias("type"), v.alias("value"))
    month = F.date_format("o_orderdate", "yyyy-MM")
    return F.create_map(F.lit("fecha_inicial"), st("date", month), F.lit("fecha_final"), st("date", month),
                        F.lit("prioridad"), st("string", F.col("o_orderpriority")))


def q_params_json(spark, sf):
    """Per order, a parameter map with window dates written in -> compact JSON."""
    o = T(spark, sf, "orders").select("o_orderkey", _order_params(T(spark, sf, "orders")).alias("params"))
    s, e, _ = load_plan.select_window(F.col("params"), "FULL", dates.MONTH)
    w = o.withColumns({"__start": s, "__end": e})
    return w.select("o_orderkey", load_plan.params_json(F.col("params"), F.col("__start"), F.col("__end")).alias("params"))


def q_window_selection(spark, sf):
    """fecha_inicial/fecha_final or fecha_corte -> load window."""
    o = T(spark, sf, "orders")
    st = lambda t, v: F.struct(F.lit(t).alias("type"), v.alias("value"))
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    p = F.when(F.col("o_orderstatus") == "F",
               F.create_map(F.lit("fecha_inicial"), st("date", F.date_format(F.date_sub(F.to_date("o_orderdate"), 30), "yyyy-MM-dd")),
                            F.lit("fecha_final"), st("date", day))) \
         .otherwise(F.create_map(F.lit("fecha_corte"), st("date", day)))
    s, e, _ = load_plan.select_window(p, "full", dates.DAY)
    return o.select("o_orderkey", s.alias("win_start"), e.alias("win_end"))


def _plan_configs(spark, sf) -> DataFrame:
    s = T(spark, sf, "supplier")
    cut = F.date_format(F.add_months(F.lit("2023-01-01").cast("date"), F.col("s_nationkey")), "yyyy-MM")
    params_map = F.create_map(F.lit("fecha_corte"), F.struct(F.lit("date").alias("type"), cut.alias("value")))
    return s.select(
        F.col("s_name").alias("name"),
        F.concat(F.lit("raw/"), F.lower("s_name"), F.lit("/")).alias("path_name_input"),
        F.concat(F.col("s_name"), F.lit(".json")).alias("file_name"),
        F.lit("fecha").alias("partition_key_raw"),
        params_map.alias("params"),
        F.concat(F.lit("staging/"), F.lower("s_name")).alias("path_name_output"),
        F.lit("staging_db").alias("catalog_database"),
        F.lower("s_name").alias("catalog_table"),
        F.lit("id").alias("merge_keys"),
        F.lit("add_fecha").alias("partition_key_staging"),
        F.lit(None).cast("string").alias("excel_sheet"),
        F.lit(None).cast("string").alias("partition_key_raw_path"),
        F.lit(None).cast("string").alias("file_name_excel"))


def q_raw_plan(spark, sf):
    """Supplier configs -> raw extraction payloads."""
    return load_plan.raw_plan(_plan_configs(spark, sf), "FULL", dates.MONTH).select(
        "name", "path_name_input", "file_name", "partition_key_raw", "params")


def q_staging_plan(spark, sf):
    """Supplier configs -> staging payloads."""
    return load_plan.staging_plan(_plan_configs(spark, sf), "FULL", dates.MONTH).select(
        "catalog_table", "path_name_raw", "excel_sheet", "file_name_excel", "start_date", "end_date")


def q_load_plan(spark, sf):
    """Raw-to-staging plan union."""
    return load_plan.load_plan(_plan_configs(spark, sf), "raw-to-staging", "FULL", dates.MONTH,
                               secret_db="secret")


def q_parse_list(spark, sf):
    """Comma lists with blanks and none-like text -> cleaned lists."""
    p = T(spark, sf, "part")
    raw = F.when(F.col("p_size") > 45, F.lit("null")).otherwise(
        F.concat(F.lit(" "), F.regexp_replace("p_name", " ", " , "), F.lit(" ,")))
    return p.select("p_partkey", F.array_join(params.parse_list(raw), "|").alias("items"))


# --- the end-to-end load ---------------------------------------------------------

def raw_orders_es_dir(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a raw ';' CSV export with messy headers and Spanish 12-hour dates."""
    def build() -> str:
        path = scratch_path(spark, "raw-orders-es")
        o = T(spark, sf_dir, "orders")
        raw = o.select(
            F.col("o_orderkey").cast("string").alias("OrderKey"),
            F.col("o_custkey").cast("string").alias("CustKey"),
            F.col("o_totalprice").cast("string").alias("Precio Total"),
            spanish_ts(F.col("o_orderdate"), F.substring("o_orderpriority", 1, 1).cast("int") - 1).alias("FechaOrden"),
            F.date_format("o_orderdate", "yyyy-MM").alias("Año Mes"))
        raw.write.mode("overwrite").options(header="true", sep=";", nullValue="\\N").csv(path)
        return path
    return _once(spark, (sf_dir, "orders-es"), build)


STAGED_ORDER_FIELDS = [
    {"name": "OrderKey", "type": "string", "converted_type": "bigint"},
    {"name": "CustKey", "type": "string", "converted_type": "bigint"},
    {"name": "Precio Total", "type": "string", "converted_type": "decimal(18,2)"},
    {"name": "FechaOrden", "type": "string", "converted_type": "timestamp"},
    {"name": "Año Mes", "type": "string", "converted_type": "string"},
]


def staged_orders(spark, sf) -> DataFrame:
    """Raw orders CSV (messy names, text values) -> cast -> select/rename -> normalise."""
    raw = files.read_csv(spark, raw_orders_es_dir(spark, sf))
    fields = STAGED_ORDER_FIELDS
    return project.normalize_column_names(project.select_rename(project.cast_by_schema(raw, fields), fields))


def q_staging_load(spark, sf):
    """Flagship: raw Spanish CSV export -> cast/rename/normalise -> merge of two batches -> revenue per month."""
    staged = staged_orders(spark, sf)
    cut_hi = F.lit("1998-01-01").cast("timestamp_ntz")
    cut_lo = F.lit("1997-07-01").cast("timestamp_ntz")
    target = staged.where(F.col("fecha_orden") < cut_hi)
    source = staged.where(F.col("fecha_orden") >= cut_lo).withColumn(
        "precio_total", (F.col("precio_total") + F.lit(1)).cast("decimal(18,2)"))
    merged = merge.merge_upsert(target, source, ["order_key"])
    return merged.groupBy("anio_mes").agg(
        F.sum("precio_total").cast("decimal(38,2)").alias("revenue"), F.count(F.lit(1)).alias("orders"))


def write_raw_zones(spark: SparkSession, sf_dir: str) -> None:
    """The raw files that the queries read, once a session."""
    for build in (raw_orders_dir, raw_orders_csv_flat, raw_customer_json_dir, raw_customer_jsonl_by_nation, raw_orders_daily_dir,
                  raw_supplier_workbooks, raw_orders_es_dir):
        build(spark, sf_dir)
    for kinds in (2, 3):
        raw_orders_drift_dir(spark, sf_dir, kinds)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "select_rename": q_select_rename,
    "normalize_names": q_normalize_names,
    "snake_case_values": q_snake_case_values,
    "accent_fold": q_accent_fold,
    "slugify": q_slugify,
    "sheet_key": q_sheet_key,
    "add_partition_col": q_add_partition_col,
    "cast_by_schema": q_cast_by_schema,
    "cast_int": q_cast_int,
    "cast_bigint": q_cast_bigint,
    "cast_double": q_cast_double,
    "cast_decimal": q_cast_decimal,
    "cast_boolean": q_cast_boolean,
    "cast_string": q_cast_string,
    "es_ampm_parse": q_es_ampm_parse,
    "safe_timestamp": q_safe_timestamp,
    "safe_date": q_safe_date,
    "bogota_date": q_bogota_date,
    "calendar_day": q_calendar_day,
    "calendar_month": q_calendar_month,
    "parse_period": q_parse_period,
    "previous_period": q_previous_period,
    "incremental_window": q_incremental_window,
    "full_window": q_full_window,
    "partition_plan": q_partition_plan,
    "partition_scan": q_partition_scan,
    "csv_scan": q_csv_scan,
    "json_scan": q_json_scan,
    "partition_counts": q_partition_counts,
    "empty_partitions": q_empty_partitions,
    "detect_format": q_detect_format,
    "entity_from_path": q_entity_from_path,
    "xlsx_scan": q_xlsx_scan,
    "cell_type_inference": q_cell_type_inference,
    "all_null_columns": q_all_null_columns,
    "required_nulls": q_required_nulls,
    "validation_report": q_validation_report,
    "type_conformance": q_type_conformance,
    "merge_upsert": q_merge_upsert,
    "merge_dup_keys": q_merge_dup_keys,
    "overwrite_partitions": q_overwrite_partitions,
    "schema_sync": q_schema_sync,
    "run_audit": q_run_audit,
    "params_json": q_params_json,
    "window_selection": q_window_selection,
    "raw_plan": q_raw_plan,
    "staging_plan": q_staging_plan,
    "load_plan": q_load_plan,
    "parse_list": q_parse_list,
    "staging_load": q_staging_load,
    "empty_partitions_message": q_empty_partitions_message,
    "staging_job": q_staging_job,
    "stream_incremental": q_stream_incremental,
    "stream_drift": q_stream_drift,
    "stream_audit": q_stream_audit,
    "sink_merge": q_sink_merge,
    "sink_overwrite": q_sink_overwrite,
    "sink_schema_sync": q_sink_schema_sync,
    "sink_schema_growth": q_sink_schema_growth,
    "staging_job_overlap": q_staging_job_overlap,
    "drift_scan": q_drift_scan,
    "missing_by_partition": q_missing_by_partition,
    "create_partitioned": q_create_partitioned,
    "cast_epoch": q_cast_epoch,
    "safe_timestamp_offset": q_safe_timestamp_offset,
    "xlsx_na": q_xlsx_na,
}


def _prep(fn):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        apply_staging_conf(spark)
        return fn(spark, sf_dir)
    run.__name__ = fn.__name__
    run.__doc__ = fn.__doc__
    return run


QUERIES = {k: _prep(v) for k, v in QUERIES.items()}

