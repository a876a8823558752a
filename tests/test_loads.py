"""Loads of several raw partitions: different headers, missing columns, keys that come again, and failures on the way."""
import decimal
import json
import os
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType

from tidewater import job as jobs
from tidewater.job import PlanFailure, StagingArgs, StagingJob, run_plan, run_with_audit
from tidewater.operators import merge
from tidewater.sinks import ledger
from tidewater.session import local_path, scratch_path
from tidewater.sinks.manifest import CommitConflict, Files, Manifests, Version
from tidewater.sinks.table import StagingTable, read_table

FIELDS = [{"name": "id", "type": "bigint", "converted_type": "bigint"}, {"name": "v", "type": "string"}]


def _put(path, text):
    path = local_path(path)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


@pytest.fixture
def zone(spark):
    root = scratch_path(spark, "loads")

    def job(days: dict, fields=FIELDS, ext="csv", **kw):
        for day, text in days.items():
            _put(f"{root}/raw/d/f=2025-01-{day:02d}/a.{ext}", text)
        _put(f"{root}/schema/d/schema.json", json.dumps({"fields": fields}))
        args = {"job_name": "j", "project_name": "p", "path_name_raw": "d", "path_name_staging": "d", "catalog_database": "db",
                "catalog_table": "t", "merge_keys": "id", "partition_key_staging": "add_dia", "partition_key_raw": "f",
                "process_type": "FULL", "date_type": "DAY_PRECISION", "start_date": "2025-01-01", "end_date": "2025-01-03",
                "raw_root": f"{root}/raw", "schema_root": f"{root}/schema", "staging_root": f"{root}/staging", **kw}
        return StagingJob(spark, StagingArgs(**args))

    def rows(*cols):
        return sorted(read_table(spark, f"{root}/staging/d").select(*cols).collect(), key=str)

    return job, rows


def test_headers_differ(zone):
    job, rows = zone
    job({1: "id;v\n1;a\n", 2: "x;v;id\nq;b;2\n", 3: "v;id;y;z\nc;3;q;q\n"}).run()
    assert [tuple(r) for r in rows("id", "v", "dia")] == [(1, "a", "2025-01-01"), (2, "b", "2025-01-02"), (3, "c", "2025-01-03")]


@pytest.mark.parametrize("ext, days", [("csv", {1: "id;v\n1;a\n", 2: "id;w\n2;b\n"}),
                                       ("json", {1: '[{"id": 1, "v": "a"}]', 2: '[{"id": 2, "w": {"k": [1]}}]'}),
                                       ("json", {1: '{"id": 1, "v": "a"}', 2: '{"id": 2}'})])
def test_column_missing_in_one_partition(zone, ext, days):
    job, _ = zone
    j = job(days, ext=ext)
    with pytest.raises(ValueError, match=r"Missing fields in DataFrame: \['v'\]"):
        j.run()
    got = {r.partition_value: (r.status, r.error) for r in j.validate().collect()}
    assert got["2025-01-01"] == ("SUCCEEDED", None) and got["2025-01-02"] == ("FAILED", "missing_column: v")


def test_json_null_is_not_missing(zone):
    job, rows = zone
    job({1: '[{"id": 1, "v": "a"}]', 2: '[{"id": 2, "v": null}]'}, ext="json").run()
    assert [tuple(r) for r in rows("id", "v")] == [(1, "a"), (2, None)]


def test_file_column_named_as_the_raw_key(zone):
    job, rows = zone
    job({1: "id;f;v\n1;mine;a\n"}, fields=[*FIELDS, {"name": "f", "type": "string"}]).run()
    assert [tuple(r) for r in rows("id", "f", "dia")] == [(1, "mine", "2025-01-01")]


def test_empty_file_is_an_empty_partition(zone):
    job, _ = zone
    r = job({1: "id;v\n1;a\n", 2: "", 3: "id;v\n"}).run()
    assert r.empty_partitions == ["2025-01-02", "2025-01-03"] and r.warning_record(job({}).args)["Payload"]["JobStatus"] == "WARNING"


def test_later_partition_wins(zone):
    job, rows = zone
    job({1: "id;v\n1;a\n2;b\n\\N;n\n", 2: "id;v\n1;c\n\\N;m\n", 3: "id;v\n1;d\n3;e\n"}).run()
    assert [tuple(r) for r in rows("id", "v", "dia")] == [(1, "d", "2025-01-03"), (2, "b", "2025-01-01"), (3, "e", "2025-01-03"),
                                                         (None, "m", "2025-01-02"), (None, "n", "2025-01-01")]


def test_twice_in_one_partition_raises(zone):
    job, _ = zone
    with pytest.raises(ValueError, match="more than one row"):
        job({1: "id;v\n1;a\n1;b\n", 2: "id;v\n1;c\n"}).run()


def test_overwrite_keeps_the_last_load_of_a_table_partition(zone):
    job, rows = zone
    job({1: "id;v\n1;x\n2;y\n4;\\N\n", 2: "id;v\n3;x\n5;\\N\n"}, merge_keys="none", partition_key_staging="v").run()
    assert [tuple(r) for r in rows("id", "v")] == [(2, "y"), (3, "x"), (5, None)]


def test_plan_goes_on_after_a_failure(spark, zone):
    job, rows = zone
    audit = scratch_path(spark, "audit")
    a = job({1: "id;v\n1;a\n"}, job_run_id="r1", stage="dev").args
    row = {"path_name_raw": "d", "path_name_staging": "d", "partition_key_raw": "f", "partition_key_staging": "add_dia",
           "catalog_database": "db", "catalog_table": "t", "merge_keys": "id", "start_date": "2025-01-01", "end_date": "2025-01-01"}
    plan = spark.createDataFrame([{**row, "plan_error": "bad"}, {**row, "merge_keys": "zz", "plan_error": None}, {**row, "plan_error": None}],
                                 ", ".join(f"{c} string" for c in [*row, "plan_error"]))
    with pytest.raises(PlanFailure) as e:
        run_plan(spark, plan, "FULL", "DAY_PRECISION", audit, raw_root=a.raw_root, schema_root=a.schema_root,
                 staging_root=a.staging_root, job_run_id="r1", stage="dev")
    assert [isinstance(r, Exception) for r in e.value.results] == [True, True, False] and len(rows("id")) == 1
    records = {r.status: r for r in ledger.read(spark, audit).where("partition_value IS NULL").collect()}
    assert set(records) == {"FAILED", "SUCCEEDED"} and {(r.run_id, r.environment) for r in records.values()} == {("r1", "DEV")}
    assert run_with_audit(spark, a).status == "WARNING"


def _plan(spark, tables):
    cols = ["path_name_raw", "path_name_staging", "partition_key_raw", "partition_key_staging", "catalog_database", "catalog_table", "merge_keys", "start_date", "end_date"]
    return spark.createDataFrame([("d", t, "f", "add_dia", "db", t, "id", "2025-01-01", "2025-01-03") for t in tables], ", ".join(f"{c} string" for c in cols)).coalesce(1)


def test_loads_of_a_plan_run_side_by_side(spark, monkeypatch):
    """Two loads that wait for each other both end; one that fails stops neither; a table's loads keep their order."""
    meet, order = threading.Barrier(2, timeout=60), []

    def run(spark, args, audit_path):
        if args.catalog_table in ("a", "b"):
            meet.wait()
            assert spark.range(10).count() == 10
        order.append((args.catalog_table, spark.sparkContext.getLocalProperty("spark.scheduler.pool")))
        if args.catalog_table == "b":
            raise ValueError("lost")
        return args.catalog_table

    monkeypatch.setattr(jobs, "run_with_audit", run)
    with pytest.raises(PlanFailure) as e:
        run_plan(spark, _plan(spark, ["a", "c", "b", "c", "c"]), "FULL", "DAY_PRECISION", concurrency=2)
    assert [str(r) for r in e.value.results] == ["a", "c", "lost", "c", "c"]
    assert sorted(order) == [("a", "load a"), ("b", "load b"), *[("c", "load c")] * 3]


def test_nested_and_decimal_columns_grow(spark):
    """A struct in an array in a map gains a field and digits; rows of before keep their values and have NULL there."""
    table = StagingTable(spark, f"{scratch_path(spark, 'grow')}/t", ["p"])
    one = "struct<m: map<int, array<struct<x: int, d: decimal(5,2)>>>, s: struct<a: float>>"
    two = "struct<m: map<bigint, array<struct<d: decimal(8,4), y: string, X: bigint>>>, s: struct<b: int, a: double>>"
    rows = [(1, "a", json.dumps({"m": {"1": [{"x": 1, "d": 1.25}, None]}, "s": {"a": 0.5}})), (2, "b", json.dumps({"m": {}, "s": None}))]
    more = [(3, "a", json.dumps({"m": {"5000000000": [{"x": 6000000000, "X": 6000000000, "d": 1234.5678, "y": "t"}]}, "s": {"b": 1, "a": 0.25}})), (2, "c", None)]
    for kind, part in ((one, rows), (two, more)):
        df = spark.createDataFrame(part, "id long, p string, j string")
        table.merge(df.select("id", "p", F.col("j").isNotNull().alias("present"), F.from_json("j", kind.replace("map<int", "map<string").replace("map<bigint", "map<string")).cast(kind).alias("v")), ["id"])
    got = {r.id: (r.p, r.v.asDict(recursive=True) if r.v else None) for r in table.read().select("id", "p", "v").collect()}
    d = decimal.Decimal
    assert got == {1: ("a", {"m": {1: [{"x": 1, "d": d("1.2500"), "y": None}, None]}, "s": {"a": 0.5, "b": None}}), 2: ("c", None),
                   3: ("a", {"m": {5000000000: [{"x": 6000000000, "d": d("1234.5678"), "y": "t"}]}, "s": {"a": 0.25, "b": 1}})}
    assert table.read().schema["v"].dataType.simpleString() == "struct<m:map<bigint,array<struct<x:bigint,d:decimal(8,4),y:string>>>,s:struct<a:double,b:int>>"
    with pytest.raises(TypeError, match="Incompatible"):
        table.merge(spark.createDataFrame([(9, "a", True, 1)], "id long, p string, present boolean, v int"), ["id"])
    assert merge.widen(DecimalType(38, 0), DecimalType(10, 2)) is None


def _rows(table):
    return sorted(tuple(r) for r in table.read().select("id", "p").collect())


OLD = [(1, "a"), (2, "b"), (3, "c"), (4, "d")]
NEW = [(1, "x"), (2, "y"), (3, "b"), (4, "d")]


@pytest.mark.parametrize("step", ["write", "folders", "ranges", "half a manifest", "before commit", "after commit"])
def test_a_load_that_dies_changes_all_or_nothing(spark, monkeypatch, step):
    """Killed at each step: the table has the rows of before or of after, and the next load goes on."""
    path = f"{scratch_path(spark, 'dies')}/t"
    StagingTable(spark, path, ["p"]).merge(spark.createDataFrame(OLD, "id long, p string"), ["id"])
    later = spark.createDataFrame(NEW[:3], "id long, p string")

    def die(*a, **k):
        raise RuntimeError("lost")

    def half(self, name, data):
        create(self, name, data[:len(data) // 2])
        die()

    def late(self, before, after):
        commit(self, before, after)
        die()

    create, commit = Files.create, Manifests.commit
    target, name, new = {"write": (StagingTable, "_write", die), "folders": (Files, "folders", die), "ranges": (StagingTable, "_record_ranges", die),
                         "half a manifest": (Files, "create", half), "before commit": (Manifests, "commit", die),
                         "after commit": (Manifests, "commit", late)}[step]
    with monkeypatch.context() as m:
        m.setattr(target, name, new)
        with pytest.raises(RuntimeError, match="lost"):
            StagingTable(spark, path, ["p"]).merge(later, ["id"])
    again = StagingTable(spark, path, ["p"])
    assert _rows(again) == (NEW if step == "after commit" else OLD)
    again.merge(later, ["id"])
    assert _rows(again) == NEW
    again.recover()
    folders = {f for n in os.listdir(local_path(path)) if n.startswith("__load=") for f in os.listdir(f"{local_path(path)}/{n}") if f.startswith("p=")}
    assert folders == {"p=x", "p=y", "p=b", "p=d"}  # nothing of dead loads is left


def test_no_file_is_renamed_by_a_commit(spark, monkeypatch):
    """A commit is one new file; whatever a rename does on a file system, the sink calls none."""
    path = f"{scratch_path(spark, 'norename')}/t"
    t = StagingTable(spark, path, ["p"])
    t.merge(spark.createDataFrame(OLD, "id long, p string"), ["id"])
    assert not hasattr(Files, "rename") and len(t.manifests.numbers()) == 1
    t.merge(spark.createDataFrame(NEW, "id long, p string"), ["id"])
    v = t.version()
    assert len(t.manifests.numbers()) == 2 and sorted(v.folders) == ["p=b", "p=d", "p=x", "p=y"]
    assert Version.decode(v.encode()) == v and Version.decode(v.encode()[:-1]) is None and Version.decode(b"") is None


def test_readers_of_the_version_before_keep_their_files(spark):
    path = f"{scratch_path(spark, 'readers')}/t"
    t = StagingTable(spark, path, ["p"])
    t.merge(spark.createDataFrame(OLD, "id long, p string"), ["id"])
    before = t.read()
    t.merge(spark.createDataFrame(NEW, "id long, p string"), ["id"])
    assert sorted(map(tuple, before.select("id", "p").collect())) == OLD and _rows(t) == NEW


def test_second_writer_is_refused(spark):
    path = f"{scratch_path(spark, 'two')}/t"
    t = StagingTable(spark, path, ["p"])
    t.merge(spark.createDataFrame(OLD, "id long, p string"), ["id"])
    stale = t.version()
    StagingTable(spark, path, ["p"]).merge(spark.createDataFrame([(9, "z")], "id long, p string"), ["id"])
    with pytest.raises(CommitConflict):
        t.manifests.commit(stale, Version(0, ["p"], stale.schema))


def _opened(df):
    return {f.split("/__load=", 1)[1].split("/", 1)[1] for f in df.inputFiles()}


def test_merge_opens_touched_partitions_and_files_in_reach_of_its_keys(spark, monkeypatch):
    """The batch's month, and of the others only files whose key range meets the batch's."""
    path = f"{scratch_path(spark, 'pruned')}/t"
    t = StagingTable(spark, path, ["m"])
    for m in range(1, 7):
        t.merge(spark.createDataFrame([(100 * m + i, f"v{m}", f"2024-{m:02d}") for i in range(50)], "id long, v string, m string"), ["id"])
    reads = []
    read = StagingTable._read_paths
    monkeypatch.setattr(StagingTable, "_read_paths", lambda self, v, p: reads.append(read(self, v, p)) or reads[-1])
    # 300 moves from March to May, and June gets a new key
    t.merge(spark.createDataFrame([(300, "new", "2024-05"), (349, "new", "2024-05")], "id long, v string, m string"), ["id"])
    search, target = (_opened(r) for r in reads)
    assert {f.split("/")[0] for f in search} == {"m=2024-03"} and {f.split("/")[0] for f in target} == {"m=2024-03", "m=2024-05"}
    assert search == {f for f in target if f.startswith("m=2024-03")}
    reads.clear()
    t.merge(spark.createDataFrame([(999, "new", "2024-06")], "id long, v string, m string"), ["id"])
    assert [{f.split("/")[0] for f in _opened(r)} for r in reads] == [{"m=2024-06"}]  # no other file is opened at all
    rows = {r.id: (r.v, r.m) for r in t.read().collect()}
    assert len(rows) == 301 and rows[300] == ("new", "2024-05") and rows[301] == ("v3", "2024-03") and rows[999] == ("new", "2024-06")


@pytest.mark.parametrize("kind, keys", [("string", ["a", "ä+b %", "z"]), ("double", [1.5, 2.5, 1e300]), ("date", None), ("decimal(20,2)", None)])
def test_moved_keys_of_any_type_are_found(spark, kind, keys):
    import datetime as dt
    import decimal
    keys = keys or {"date": [dt.date(2020, 1, d) for d in (1, 2, 3)], "decimal(20,2)": [decimal.Decimal(x) for x in ("-9.50", "10", "9.99")]}[kind]
    t = StagingTable(spark, f"{scratch_path(spark, 'kinds')}/t", ["p"])
    t.merge(spark.createDataFrame([(k, f"p:{i}/+ %") for i, k in enumerate(keys)], f"id {kind}, p string"), ["id"])
    t.merge(spark.createDataFrame([(keys[2], "q"), (None, "q")], f"id {kind}, p string"), ["id"])
    got = sorted(map(tuple, t.read().select("id", "p").collect()), key=str)
    assert got == sorted([(keys[0], "p:0/+ %"), (keys[1], "p:1/+ %"), (keys[2], "q"), (None, "q")], key=str)


def test_registered_table_follows_every_version(spark):
    path = f"{scratch_path(spark, 'reg')}/t"
    spark.sql("DROP TABLE IF EXISTS reg_t")
    t = StagingTable(spark, path, ["p"], register="reg_t")
    t.create(spark.createDataFrame([], "id int, p string"))
    assert spark.table("reg_t").columns == ["id", "p"] and spark.table("reg_t").count() == 0
    t.merge(spark.createDataFrame([(1, "a"), (2, "it's"), (3, None), (4, "x/y")], "id int, p string"), ["id"])
    assert spark.table("reg_t").where("p = 'x/y'").collect() == [(4, "x/y")]
    t.merge(spark.createDataFrame([(1, "n", "b"), (5_000_000_000, "m", None)], "id long, extra string, p string"), ["id"])
    got = sorted(map(tuple, spark.table("reg_t").select("id", "extra", "p").collect()))
    assert got == [(1, "n", "b"), (2, None, "it's"), (3, None, None), (4, None, "x/y"), (5_000_000_000, "m", None)]
    assert got == sorted(map(tuple, t.read().select("id", "extra", "p").collect()))
    plan = spark.table("reg_t").where("p = 'b'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and len(spark.sql("SHOW PARTITIONS reg_t").collect()) == 4  # a is left without rows
    u = StagingTable(spark, f"{path}u", [], register="reg_u")
    for rows in ([(1,)], [(2,)]):
        u.merge(spark.createDataFrame(rows, "id int"), ["id"])
    assert sorted(r.id for r in spark.table("reg_u").collect()) == [1, 2]
    for name in ("reg_t", "reg_u"):
        spark.sql(f"DROP TABLE {name}")


def test_every_key_moves_or_table_has_no_partitions(spark):
    path = scratch_path(spark, "whole")
    one, two = ([(1, "a"), (2, "b")], [(2, "c"), (3, "d")])
    df = [spark.createDataFrame(x, "id long, p string") for x in (one, two)]
    for name, parts in (("t", ["p"]), ("u", [])):
        t = StagingTable(spark, f"{path}/{name}", parts)
        t.merge(df[0], ["id"])
        t.merge(df[1], ["id"])
        assert _rows(t) == [(1, "a"), (2, "c"), (3, "d")]
    t = StagingTable(spark, f"{path}/u", [])
    t.overwrite_partitions(df[0])
    assert _rows(t) == one and t.recover() == 0 and _rows(t) == one


def test_workbook_na_texts_and_1904_dates(spark):
    import datetime as dt
    import io
    import zipfile

    from tidewater.sources.xlsx import read_xlsx, workbook_bytes
    data = workbook_bytes({"S": (["NA", "d"], [(1.5, dt.datetime(2020, 1, 1)), ("#N/A", None), (2.5, dt.datetime(2020, 1, 2))])})
    out = io.BytesIO()
    with zipfile.ZipFile(io.BytesIO(data)) as old, zipfile.ZipFile(out, "w") as new:
        for n in old.namelist():
            new.writestr(n, old.read(n).replace(b"<sheets>", b'<workbookPr date1904="1"/><sheets>') if n == "xl/workbook.xml" else old.read(n))
    folder = local_path(scratch_path(spark, "na"))
    os.makedirs(folder)
    with open(f"{folder}/a.xlsx", "wb") as f:
        f.write(out.getvalue())
    df = read_xlsx(spark, folder)
    assert dict(df.dtypes)["NA"] == "double" and [r["NA"] for r in df.collect()] == [1.5, None, 2.5]
    assert df.first()["d"] == dt.datetime(2024, 1, 2)
