import json
import os

import pytest
from pyspark.sql import functions as F

from tidewater.sinks.table import read_table
from tidewater.job import StagingArgs, StagingJob, run_with_audit
from tidewater.sinks import ledger
from tidewater.session import scratch_path

SF = "/root/testdata/sf0.001"

FIELDS = [
    {"name": "OrderKey", "type": "string", "converted_type": "bigint", "nullable": False},
    {"name": "CustKey", "type": "string", "converted_type": "bigint"},
    {"name": "Estado", "type": "string"},
    {"name": "TotalPrice", "type": "string", "converted_type": "decimal(18,2)", "converted_name": "precio_total"},
    {"name": "FechaOrden", "type": "string", "converted_type": "timestamp"},
]


@pytest.fixture(scope="module")
def zone(spark):
    root = scratch_path(spark, "zone")
    raw, schema, staging = f"{root}/raw", f"{root}/schema", f"{root}/staging"
    o = spark.read.parquet(f"{SF}/orders.parquet").where("o_orderdate >= '1996-01-01' AND o_orderdate < '1996-03-01'")
    (o.select(F.col("o_orderkey").cast("string").alias("OrderKey"), F.col("o_custkey").cast("string").alias("CustKey"),
              F.col("o_orderstatus").alias("Estado"), F.col("o_totalprice").cast("string").alias("TotalPrice"),
              F.date_format("o_orderdate", "d/M/yyyy h:mm:ss a").alias("FechaOrden"),
              F.date_format("o_orderdate", "yyyy-MM-dd").alias("fecha"))
      .write.options(header="true", sep=";").partitionBy("fecha").csv(f"{raw}/ventas/ordenes"))
    path = f"{schema}/ventas/ordenes/schema.json"
    local = path[5:] if path.startswith("file:") else path
    os.makedirs(os.path.dirname(local), exist_ok=True)
    with open(local, "w") as f:
        json.dump({"fields": FIELDS}, f)
    return {"raw_root": raw, "schema_root": schema, "staging_root": staging, "orders": o}


def _args(zone, **kw):
    base = dict(job_name="j", project_name="p", path_name_raw="/ventas/ordenes/", path_name_staging="ordenes",
                catalog_database="db", catalog_table="ordenes", merge_keys="order_key",
                partition_key_staging="add_fecha_carga", partition_key_raw="fecha",
                process_type="FULL", date_type="DAY_PRECISION", start_date="1996-01-01", end_date="1996-01-31",
                raw_root=zone["raw_root"], schema_root=zone["schema_root"], staging_root=zone["staging_root"])
    base.update(kw)
    return StagingArgs(**base)


def test_full_then_overlapping_full_merges(spark, zone):
    r1 = StagingJob(spark, _args(zone)).run()
    jan = zone["orders"].where("o_orderdate < '1996-02-01'")
    jan_days = {r[0] for r in jan.select(F.date_format("o_orderdate", "yyyy-MM-dd")).distinct().collect()}
    assert set(r1.empty_partitions) == {f"1996-01-{d:02d}" for d in range(1, 32)} - jan_days
    assert r1.rows_written == jan.count()
    r2 = StagingJob(spark, _args(zone, start_date="1996-01-15", end_date="1996-02-29")).run()
    assert r2.status in ("SUCCEEDED", "WARNING")
    t = read_table(spark, f"{zone['staging_root']}/ordenes")
    assert t.count() == zone["orders"].count()
    assert t.select("order_key").distinct().count() == t.count()
    assert set(t.columns) == {"order_key", "cust_key", "estado", "precio_total", "fecha_orden", "fecha_carga"}
    assert dict(t.dtypes)["fecha_orden"] == "timestamp_ntz"


def test_missing_partition_window_is_all_empty(spark, zone):
    r = StagingJob(spark, _args(zone, start_date="2030-01-01", end_date="2030-01-02")).run()
    assert r.status == "WARNING" and r.empty_partitions == ["2030-01-01", "2030-01-02"]
    assert r.message == "Warning: The following partitions had no data and were skipped: 2030-01-01, 2030-01-02"


def test_plan_errors(spark, zone):
    with pytest.raises(ValueError, match="must be provided"):
        StagingJob(spark, _args(zone, start_date="", end_date="")).run()
    with pytest.raises(ValueError, match="Invalid process_type"):
        StagingJob(spark, _args(zone, process_type="DELTA")).run()


def test_audit_records_failure(spark, zone):
    audit = scratch_path(spark, "audit")
    with pytest.raises(ValueError):
        run_with_audit(spark, _args(zone, merge_keys=""), audit)
    rows = ledger.read(spark, audit).where("partition_value IS NULL").collect()
    assert rows[0]["status"] == "FAILED" and "merge keys" in rows[0]["error_message"]


def test_single_workbook_with_entity_and_relaxed_types(spark):
    import datetime as dt

    from tidewater.session import local_path
    from tidewater.sources.xlsx import workbook_bytes
    root = scratch_path(spark, "zone-xlsx")
    raw_dir = local_path(f"{root}/raw/417")
    os.makedirs(raw_dir, exist_ok=True)
    rows = [("Ana", 1.5, "5/1/2025 3:04:05 p. m."), ("Luis", 2.0, "6/1/2025 9:00:00 a. m.")]
    with open(os.path.join(raw_dir, "bancos_2025-01.xlsx"), "wb") as f:
        f.write(workbook_bytes({"Reporte Mensual": (["Nombre", "Valor", "Fecha"], rows)}))
    schema_dir = local_path(f"{root}/schema/417/reporte_mensual")
    os.makedirs(schema_dir, exist_ok=True)
    fields = [{"name": "Nombre", "type": "string", "nullable": False},
              {"name": "Valor", "type": "int", "converted_type": "double"},
              {"name": "Fecha", "type": "date", "converted_type": "date"},
              {"name": "Entidad", "type": "string"}]
    with open(os.path.join(schema_dir, "schema.json"), "w") as f:
        json.dump({"fields": fields}, f)
    args = StagingArgs(job_name="x", project_name="p", path_name_raw="417", path_name_staging="rep",
                       catalog_database="db", catalog_table="rep", merge_keys="none",
                       partition_key_staging="add_fecha_carga", partition_key_raw="fecha", process_type="FULL",
                       date_type="DAY_PRECISION", start_date="2025-01-31", end_date="2025-01-31",
                       excel_sheet=" Reporte  Mensual ", file_name_excel="bancos_2025-01.xlsx",
                       raw_root=f"{root}/raw", schema_root=f"{root}/schema", staging_root=f"{root}/staging")
    args.excel_sheet = "Reporte Mensual"
    r = StagingJob(spark, args).run()
    assert r.status == "SUCCEEDED" and r.rows_written == 2
    from tidewater.sinks.table import StagingTable
    t = StagingTable(spark, f"{root}/staging/rep", ["fecha_carga"]).read()
    got = sorted(tuple(x) for x in t.select("nombre", "valor", "fecha", "entidad", "fecha_carga").collect())
    assert got == [("Ana", 1.5, dt.date(2025, 1, 5), "bancos", "2025-01-31"),
                   ("Luis", 2.0, dt.date(2025, 1, 6), "bancos", "2025-01-31")]


def test_strict_types_reject_inferred_mismatch(spark, zone):
    # CSV inference reads OrderKey as int while the schema declares string: the strict check fails
    with pytest.raises(TypeError, match="OrderKey"):
        StagingJob(spark, _args(zone, strict_types=True, start_date="1996-01-02", end_date="1996-01-05")).run()


def test_incremental_day_reads_yesterday(spark, zone):
    day = zone["orders"].select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")).orderBy("d").first()["d"]
    import datetime as dt
    today = (dt.date.fromisoformat(day) + dt.timedelta(days=1)).isoformat()
    args = _args(zone, process_type="INC", start_date="", end_date="", today=today,
                 path_name_staging="ordenes_inc", catalog_table="ordenes_inc")
    r = StagingJob(spark, args).run()
    assert r.partitions == [day] and r.status == "SUCCEEDED"
    t = read_table(spark, f"{zone['staging_root']}/ordenes_inc")
    assert t.count() == zone["orders"].where(F.date_format("o_orderdate", "yyyy-MM-dd") == day).count()


def test_partitions_in_mixed_formats_and_workbooks(spark):
    from tidewater.session import local_path
    from tidewater.sources.xlsx import workbook_bytes
    root = scratch_path(spark, "zone-mixed")
    raw = local_path(f"{root}/raw/mix")
    for d in ("mes=2025-01", "mes=2025-02", "mes=2025-03"):
        os.makedirs(os.path.join(raw, d), exist_ok=True)
    with open(os.path.join(raw, "mes=2025-01", "a.csv"), "w") as f:
        f.write("id;valor\n1;10\n2;20\n")
    with open(os.path.join(raw, "mes=2025-02", "b.json"), "w") as f:
        f.write('[{"id": 3, "valor": 30}]')
    with open(os.path.join(raw, "mes=2025-03", "banco_2025-03.xlsx"), "wb") as f:
        f.write(workbook_bytes({"Hoja 1": (["id", "valor"], [(4, 40), (5, 50)])}))
    sdir = local_path(f"{root}/schema/mix")
    os.makedirs(sdir, exist_ok=True)
    with open(os.path.join(sdir, "schema.json"), "w") as f:
        json.dump({"fields": [{"name": "id", "type": "string", "converted_type": "bigint", "nullable": False},
                              {"name": "valor", "type": "string", "converted_type": "double"},
                              {"name": "Entidad", "type": "string"}]}, f)
    args = StagingArgs(job_name="x", project_name="p", path_name_raw="mix", path_name_staging="mix",
                       catalog_database="db", catalog_table="mix", merge_keys="id", partition_key_staging="add_mes_carga",
                       partition_key_raw="mes", process_type="FULL", date_type="MONTH_PRECISION",
                       start_date="2025-01", end_date="2025-04",
                       raw_root=f"{root}/raw", schema_root=f"{root}/schema", staging_root=f"{root}/staging")
    r = StagingJob(spark, args).run()
    assert r.empty_partitions == ["2025-04"] and r.rows_written == 5
    from tidewater.sinks.table import StagingTable
    t = StagingTable(spark, f"{root}/staging/mix", ["mes_carga"]).read()
    got = sorted(tuple(x) for x in t.select("id", "valor", "mes_carga", "entidad").collect())
    assert got == [(1, 10.0, "2025-01", None), (2, 20.0, "2025-01", None), (3, 30.0, "2025-02", None),
                   (4, 40.0, "2025-03", "banco"), (5, 50.0, "2025-03", "banco")]


def test_add_raw_key_reads_today_and_raw_path_key(spark, zone):
    day = zone["orders"].select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d")).orderBy(F.desc("d")).first()["d"]
    n = zone["orders"].where(F.date_format("o_orderdate", "yyyy-MM-dd") == day).count()
    r = StagingJob(spark, _args(zone, partition_key_raw="add_fecha", today=day, path_name_staging="hoy",
                                catalog_table="hoy")).run()
    assert r.partitions == [day] and r.rows_written == n
    r2 = StagingJob(spark, _args(zone, partition_key_raw="dia", partition_key_raw_path="fecha", start_date=day,
                                 end_date=day, path_name_staging="hoy2", catalog_table="hoy2")).run()
    assert r2.rows_written == n
    with pytest.raises(ValueError, match="Invalid date_type"):
        StagingJob(spark, _args(zone, partition_key_raw="add_fecha", date_type="YEAR", today=day)).run()


def test_missing_and_unsupported_directories(spark, zone):
    from tidewater.session import local_path
    with pytest.raises(FileNotFoundError, match="No files found"):
        StagingJob(spark, _args(zone, start_date="2031-01-01", end_date="2031-01-01", fail_on_missing=True)).run()
    bad = os.path.join(local_path(zone["raw_root"]), "ventas", "ordenes", "fecha=2031-02-01")
    os.makedirs(bad, exist_ok=True)
    with open(os.path.join(bad, "notes.txt"), "w") as f:
        f.write("x")
    with pytest.raises(RuntimeError, match="No supported file type"):
        StagingJob(spark, _args(zone, start_date="2031-02-01", end_date="2031-02-01")).run()


def test_validate_only_reports_without_writing(spark, zone):
    r = StagingJob(spark, _args(zone, start_date="1996-01-01", end_date="1996-01-10",
                                path_name_staging="never", catalog_table="never")).validate()
    rows = {x.partition_value: (x.n, x.status) for x in r.collect()}
    assert rows and all(st == "SUCCEEDED" and n > 0 for n, st in rows.values())
    from tidewater.sinks.table import StagingTable
    assert not StagingTable(spark, f"{zone['staging_root']}/never", ["fecha_carga"]).exists()


def test_command_line_run(spark, zone):
    import subprocess
    import sys
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    cmd = [sys.executable, "-m", "tidewater.job", "--job_name", "cli", "--project_name", "p",
           "--path_name_raw", "ventas/ordenes", "--path_name_staging", "cli_out", "--catalog_database", "db",
           "--catalog_table", "cli_out", "--merge_keys", "none", "--partition_key_staging", "add_fecha_carga",
           "--partition_key_raw", "fecha", "--process_type", "FULL", "--date_type", "DAY_PRECISION",
           "--start_date", "1996-01-01", "--end_date", "1996-01-03", "--excel_sheet", "-",
           "--raw_root", zone["raw_root"], "--schema_root", zone["schema_root"], "--staging_root", zone["staging_root"]]
    env = dict(os.environ, PYSPARK_SUBMIT_ARGS="--master local[2] pyspark-shell")
    out = subprocess.run(cmd, cwd=repo, env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    assert "StagingResult(status=" in out.stdout
    n = zone["orders"].where("o_orderdate < '1996-01-04'").count()
    assert read_table(spark, f"{zone['staging_root']}/cli_out").count() == n


def test_csv_partitions_with_different_column_order(spark):
    from tidewater.session import local_path
    root = scratch_path(spark, "zone-order")
    raw = local_path(f"{root}/raw/orden")
    for d, txt in (("mes=2025-01", "id;valor\n1;10\n2;20\n"), ("mes=2025-02", "valor;id\n30;3\n")):
        os.makedirs(os.path.join(raw, d), exist_ok=True)
        with open(os.path.join(raw, d, "x.csv"), "w") as f:
            f.write(txt)
    sdir = local_path(f"{root}/schema/orden")
    os.makedirs(sdir, exist_ok=True)
    with open(os.path.join(sdir, "schema.json"), "w") as f:
        json.dump({"fields": [{"name": "id", "type": "int", "converted_type": "int"},
                              {"name": "valor", "type": "int", "converted_type": "int"}]}, f)
    args = StagingArgs(job_name="x", project_name="p", path_name_raw="orden", path_name_staging="orden",
                       catalog_database="db", catalog_table="orden", merge_keys="id", partition_key_staging="add_mes_carga",
                       partition_key_raw="mes", process_type="FULL", date_type="MONTH_PRECISION",
                       start_date="2025-01", end_date="2025-02",
                       raw_root=f"{root}/raw", schema_root=f"{root}/schema", staging_root=f"{root}/staging")
    StagingJob(spark, args).run()
    t = read_table(spark, f"{root}/staging/orden")
    assert sorted(tuple(r) for r in t.select("id", "valor").collect()) == [(1, 10), (2, 20), (3, 30)]


def test_json_with_declared_schema_skips_inference(spark):
    from tidewater.session import local_path
    root = scratch_path(spark, "zone-json")
    raw = local_path(f"{root}/raw/js")
    os.makedirs(os.path.join(raw, "mes=2025-01"), exist_ok=True)
    with open(os.path.join(raw, "mes=2025-01", "a.json"), "w") as f:
        f.write('[{"id": 1, "valor": 1.5, "extra": "x"}, {"id": 2, "valor": null}]')
    sdir = local_path(f"{root}/schema/js")
    os.makedirs(sdir, exist_ok=True)
    with open(os.path.join(sdir, "schema.json"), "w") as f:
        json.dump({"fields": [{"name": "id", "type": "long", "converted_type": "bigint", "nullable": False},
                              {"name": "valor", "type": "double", "converted_type": "double"}]}, f)
    args = StagingArgs(job_name="x", project_name="p", path_name_raw="js", path_name_staging="js",
                       catalog_database="db", catalog_table="js", merge_keys="id", partition_key_staging="add_mes_carga",
                       partition_key_raw="mes", process_type="FULL", date_type="MONTH_PRECISION",
                       start_date="2025-01", end_date="2025-01", json_declared_schema=True,
                       raw_root=f"{root}/raw", schema_root=f"{root}/schema", staging_root=f"{root}/staging")
    StagingJob(spark, args).run()
    t = read_table(spark, f"{root}/staging/js")
    assert sorted(tuple(r) for r in t.select("id", "valor").collect()) == [(1, 1.5), (2, None)]


def test_unknown_partition_or_merge_column(spark, zone):
    with pytest.raises(ValueError, match="not in the staged data"):
        StagingJob(spark, _args(zone, merge_keys="no_such_key", start_date="1996-01-02", end_date="1996-01-02")).run()


def test_keys_stay_in_partition_merge(spark, zone):
    args = _args(zone, start_date="1996-01-01", end_date="1996-01-05", path_name_staging="stay",
                 catalog_table="stay", keys_may_move=False)
    StagingJob(spark, args).run()
    StagingJob(spark, args).run()  # same window again: rows replaced, not duplicated
    n = zone["orders"].where("o_orderdate < '1996-01-06'").count()
    assert read_table(spark, f"{zone['staging_root']}/stay").count() == n


def test_run_plan_from_a_staging_plan(spark, zone):
    from tidewater.job import run_plan
    from tidewater.plans import load_plan as LP
    cfg = [{"name": "ordenes", "path_name_input": "ventas/ordenes", "path_name_output": "plan_out",
            "partition_key_raw": "fecha", "partition_key_staging": "add_fecha_carga", "catalog_database": "db",
            "catalog_table": "plan_out", "merge_keys": ["order_key"],
            "params": {"fecha_inicial": {"type": "date", "value": "1996-01-01"},
                       "fecha_final": {"type": "date", "value": "1996-01-04"}}}]
    plan = LP.staging_plan(LP.configs_frame(spark, cfg), "FULL", "DAY_PRECISION")
    audit = scratch_path(spark, "plan-audit")
    results = run_plan(spark, plan, "FULL", "DAY_PRECISION", audit_path=audit, project_name="p",
                       raw_root=zone["raw_root"], schema_root=zone["schema_root"], staging_root=zone["staging_root"])
    n = zone["orders"].where("o_orderdate < '1996-01-05'").count()
    assert [r.rows_written for r in results] == [n]
    assert ledger.read(spark, audit).where("partition_value IS NULL").first()["status"] == "SUCCEEDED"
