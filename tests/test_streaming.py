import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidewater.session import scratch_path
from tidewater.sinks.table import StagingTable
from tidewater.streaming.incremental import run_incremental

SF = "/root/testdata/sf0.001"
FIELDS = [
    {"name": "OrderKey", "type": "bigint", "converted_type": "bigint", "nullable": False},
    {"name": "TotalPrice", "type": "double", "converted_type": "double"},
]


def _write_day(spark, raw, day, price_delta=0.0):
    o = spark.read.parquet(f"{SF}/orders.parquet").where(F.to_date("o_orderdate") == F.lit(day).cast("date"))
    (o.select(F.col("o_orderkey").cast("string").alias("OrderKey"),
              (F.col("o_totalprice") + price_delta).cast("string").alias("TotalPrice"))
      .write.mode("append").options(header="true", sep=";").csv(f"{raw}/fecha={day}"))
    return o.count()


def test_available_now_stages_only_new_files(spark):
    root = scratch_path(spark, "stream")
    raw, ckpt = f"{root}/raw", f"{root}/ckpt"
    days = [r[0] for r in spark.read.parquet(f"{SF}/orders.parquet")
            .select(F.date_format("o_orderdate", "yyyy-MM-dd")).distinct().orderBy(1).limit(3).collect()]
    n0 = _write_day(spark, raw, days[0]) + _write_day(spark, raw, days[1])
    table = StagingTable(spark, f"{root}/table", ["fecha_carga"])
    run_incremental(spark, raw, FIELDS, table, "order_key", "fecha", "add_fecha_carga", checkpoint=ckpt)
    assert table.read().count() == n0
    n1 = _write_day(spark, raw, days[2])
    run_incremental(spark, raw, FIELDS, table, "order_key", "fecha", "add_fecha_carga", checkpoint=ckpt)
    t = table.read()
    assert t.count() == n0 + n1
    assert sorted(r[0] for r in t.select("fecha_carga").distinct().collect()) == days


def test_micro_batches_merge_in_order(spark):
    root = scratch_path(spark, "stream-mb")
    raw, ckpt = f"{root}/raw", f"{root}/ckpt"
    days = [r[0] for r in spark.read.parquet(f"{SF}/orders.parquet")
            .select(F.date_format("o_orderdate", "yyyy-MM-dd")).distinct().orderBy(1).limit(2).collect()]
    n = _write_day(spark, raw, days[0]) + _write_day(spark, raw, days[1])
    table = StagingTable(spark, f"{root}/table", ["fecha_carga"])
    q = run_incremental(spark, raw, FIELDS, table, "order_key", "fecha", "add_fecha_carga", checkpoint=ckpt,
                        max_files_per_trigger=1)
    assert len(q.recentProgress) >= 2
    assert table.read().count() == n


def test_stream_follows_file_header_order(spark):
    import os

    from tidewater.session import local_path
    root = scratch_path(spark, "stream-order")
    d = os.path.join(local_path(root), "raw", "fecha=2024-01-01")
    os.makedirs(d, exist_ok=True)
    with open(os.path.join(d, "a.csv"), "w") as f:
        f.write("TotalPrice;Extra;OrderKey\n10.5;x;1\n20.0;y;2\n")
    table = StagingTable(spark, f"{root}/table", ["fecha_carga"])
    run_incremental(spark, f"{root}/raw", FIELDS, table, "order_key", "fecha", "add_fecha_carga",
                    checkpoint=f"{root}/ckpt")
    assert sorted(tuple(r) for r in table.read().select("order_key", "total_price").collect()) == [(1, 10.5), (2, 20.0)]


def _write(root, name, text):
    import os

    from tidewater.session import local_path
    path = os.path.join(local_path(root), "raw", name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _outcome(spark, ledger_path):
    from tidewater.sinks import ledger
    rows = ledger.read(spark, ledger_path).collect()
    return ({r.partition_value: (r.n, r.partition_status, r.partition_error) for r in rows if r.partition_value},
            sorted((r.status, r.run_id.rsplit("#", 1)[1]) for r in rows if not r.partition_value))


def test_files_of_a_batch_are_routed_by_header(spark):
    """Other order, more and fewer columns, an empty file and one without rows; a file that lacks a column fails its partition only."""
    root = scratch_path(spark, "stream-headers")
    _write(root, "fecha=2024-01-01/a.csv", "OrderKey;TotalPrice\n1;1.5\n")
    _write(root, "fecha=2024-01-01/b.csv", "x;TotalPrice;OrderKey\nq;2.5;2\n")
    _write(root, "fecha=2024-01-01/c.csv", "")
    _write(root, "fecha=2024-01-02/a.csv", "OrderKey;TotalPrice\n3;3.5\n")
    _write(root, "fecha=2024-01-02/b [x].csv", "OrderKey;Other\n4;z\n5;z\n")
    _write(root, "fecha=2024-01-03/a.csv", "TotalPrice;OrderKey\n9.5;1\n")
    _write(root, "fecha=2024-01-04/a.csv", "TotalPrice;OrderKey\n")
    table = StagingTable(spark, f"{root}/table", ["fecha_carga"])

    def run(**kw):
        run_incremental(spark, f"{root}/raw", FIELDS, table, "order_key", "fecha", "add_fecha_carga", checkpoint=f"{root}/ckpt", audit_path=f"{root}/ledger", **kw)
        return sorted(tuple(r) for r in table.read().select("order_key", "total_price", "fecha_carga").collect())

    with pytest.raises(StreamingQueryException, match="TotalPrice"):
        run()
    assert run(invalid="report") == [(1, 9.5, "2024-01-03"), (2, 2.5, "2024-01-01")]
    parts, batches = _outcome(spark, f"{root}/ledger")
    assert parts == {"2024-01-01": (2, "SUCCEEDED", None), "2024-01-02": (3, "FAILED", "missing_column: TotalPrice"), "2024-01-03": (1, "SUCCEEDED", None)}
    assert batches == [("FAILED", "0"), ("WARNING", "0")]
    _write(root, "fecha=2024-01-02/c.csv", "n;OrderKey;TotalPrice\n;7;7.0\n")  # a header that no file had when the stream began
    assert run() == [(1, 9.5, "2024-01-03"), (2, 2.5, "2024-01-01"), (7, 7.0, "2024-01-02")]
    assert _outcome(spark, f"{root}/ledger")[1] == [("FAILED", "0"), ("SUCCEEDED", "1"), ("WARNING", "0")]


def test_json_stream_tells_a_lacking_key_from_nulls(spark):
    root = scratch_path(spark, "stream-json")
    _write(root, "fecha=2024-01-01/a.json", '[{"OrderKey": "1", "TotalPrice": null}, {"OrderKey": "2"}]')
    _write(root, "fecha=2024-01-02/a.json", '[{"OrderKey": "3"}]')
    table = StagingTable(spark, f"{root}/table", ["fecha_carga"])
    run_incremental(spark, f"{root}/raw", FIELDS, table, "order_key", "fecha", "add_fecha_carga", fmt="json", checkpoint=f"{root}/ckpt",
                    invalid="report", audit_path=f"{root}/ledger")
    assert sorted(tuple(r) for r in table.read().select("order_key", "total_price").collect()) == [(1, None), (2, None)]
    assert _outcome(spark, f"{root}/ledger")[0]["2024-01-02"] == (1, "FAILED", "missing_column: TotalPrice")
