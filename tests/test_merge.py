import pytest
from pyspark.sql import functions as F

from tidewater.operators import merge


def test_upsert_updates_inserts_and_keeps(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, v string")
    s = spark.createDataFrame([(2, "B"), (3, "C"), (None, "m")], "id int, v string")
    got = sorted(merge.merge_upsert(t, s, ["id"]).collect(), key=lambda r: (r.id is None, r.id or 0, r.v))
    assert [tuple(r) for r in got] == [(1, "a"), (2, "B"), (3, "C"), (None, "m"), (None, "n")]


def test_merge_keys_parsing():
    assert merge.parse_merge_keys(" id , fecha ") == ["id", "fecha"]
    assert merge.parse_merge_keys(["id", " x "]) == ["id", "x"]
    assert merge.parse_merge_keys("None") is None
    for bad in ["", "null", "''", None]:
        with pytest.raises(ValueError):
            merge.parse_merge_keys(bad)


def test_duplicate_keys(spark):
    s = spark.createDataFrame([(1,), (1,), (2,)], "id int")
    assert [tuple(r) for r in merge.duplicate_keys(s, ["id"]).collect()] == [(1, 2)]


def test_overwrite_partitions(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b"), (3, "b")], "id int, p string")
    s = spark.createDataFrame([(9, "b")], "id int, p string")
    assert sorted(tuple(r) for r in merge.overwrite_partitions(t, s, ["p"]).collect()) == [(1, "a"), (9, "b")]


def test_schema_sync_widens_and_adds(spark):
    t = spark.createDataFrame([(1, 1.5)], "id int, x float")
    b = spark.createDataFrame([(2, 2.5, "n")], "id bigint, x double, extra string")
    out = merge.append_synced(t, b)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double", "string"]
    assert sorted(tuple(r) for r in out.collect()) == [(1, 1.5, None), (2, 2.5, "n")]


def test_schema_sync_refuses_narrowing(spark):
    t = spark.createDataFrame([(1,)], "id string")
    b = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(TypeError, match="Incompatible"):
        merge.schema_sync(t, b)


def test_upsert_plan_has_no_cartesian(spark):
    t = spark.range(1000).withColumn("v", F.lit(1))
    s = spark.range(500, 1500).withColumn("v", F.lit(2))
    plan = merge.merge_upsert(t, s, ["id"])._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_sink_merge_moves_keys_and_touches_only_needed_partitions(spark):
    import os

    from tidewater.session import local_path, scratch_path
    from tidewater.sinks.table import StagingTable
    path = scratch_path(spark, "sink")
    t = StagingTable(spark, path, ["p"])
    assert not t.exists()
    t.merge(spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "y"), (4, "d", "w")],
                                  "id int, v string, p string"), ["id"])
    w_files = _files(t, "p=w")
    t.merge(spark.createDataFrame([(2, "B", "y"), (5, "e", "z")], "id int, v string, p string"), ["id"])
    got = sorted(tuple(r) for r in t.read().select("id", "v", "p").collect())
    assert got == [(1, "a", "x"), (2, "B", "y"), (3, "c", "y"), (4, "d", "w"), (5, "e", "z")]
    # partition w was not touched: same files as before
    assert _files(t, "p=w") == w_files
    t.merge(spark.createDataFrame([(3, "C", "y")], "id int, v string, p string"), ["id"], keys_may_move=False)
    assert sorted(tuple(r) for r in t.read().where("p = 'y'").select("id", "v").collect()) == [(2, "B"), (3, "C")]
    with pytest.raises(ValueError, match="more than one row"):
        t.merge(spark.createDataFrame([(7, "a", "x"), (7, "b", "x")], "id int, v string, p string"), ["id"])


def test_sink_keeps_partition_text(spark):
    from tidewater.session import scratch_path
    from tidewater.sinks.table import StagingTable
    t = StagingTable(spark, scratch_path(spark, "sink-text"), ["p"])
    t.merge(spark.createDataFrame([(1, "007"), (2, "010")], "id int, p string"), ["id"])
    t.merge(spark.createDataFrame([(1, "007"), (3, "010")], "id int, p string"), ["id"])
    t.overwrite_partitions(spark.createDataFrame([(4, "010")], "id int, p string"))
    assert sorted(tuple(r) for r in t.read().select("id", "p").collect()) == [(1, "007"), (4, "010")]


def test_sink_schema_evolution_widens_and_adds(spark):
    from tidewater.session import scratch_path
    from tidewater.sinks.table import StagingTable
    t = StagingTable(spark, scratch_path(spark, "sink-evolve"), ["p"])
    t.merge(spark.createDataFrame([(1, 1, "a")], "id int, n int, p string"), ["id"])
    import os

    from tidewater.session import local_path
    a_files = _files(t, "p=a")
    t.merge(spark.createDataFrame([(2, 3000000000, "b", "x")], "id int, n bigint, p string, extra string"), ["id"])
    assert _files(t, "p=a") == a_files  # nothing rewritten
    out = t.read()
    assert dict(out.dtypes)["n"] == "bigint" and "extra" in out.columns
    assert sorted(tuple(r) for r in out.select("id", "n", "p", "extra").collect()) == \
        [(1, 1, "a", None), (2, 3000000000, "b", "x")]


def test_sink_merge_with_date_partition_column(spark):
    import datetime as dt

    from tidewater.session import scratch_path
    from tidewater.sinks.table import StagingTable
    t = StagingTable(spark, scratch_path(spark, "sink-date"), ["d"])
    t.merge(spark.createDataFrame([(1, dt.date(2024, 1, 1)), (2, dt.date(2024, 1, 2))], "id int, d date"), ["id"])
    t.merge(spark.createDataFrame([(2, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 3))], "id int, d date"), ["id"])
    got = sorted(tuple(r) for r in t.read().select("id", "d").collect())
    assert got == [(1, "2024-01-01"), (2, "2024-01-01"), (3, "2024-01-03")]


class _RecordingSpark:
    """A session stand-in that records catalog SQL (no Iceberg runtime here)."""

    def __init__(self, spark, exists=True):
        self._spark, self.statements = spark, []
        self.catalog = type("C", (), {"tableExists": staticmethod(lambda name: exists)})()
        self.conf = type("Conf", (), {"get": staticmethod(
            lambda k, d=None: "org.apache.iceberg.spark.SparkCatalog" if k == "spark.sql.catalog.ice" else d)})()

    def sql(self, text):
        self.statements.append(" ".join(text.split()))

    def table(self, name):
        return self._spark.createDataFrame([(1, 1, "a")], "id int, n int, p string")

    def __getattr__(self, item):
        return getattr(self._spark, item)


def test_iceberg_statements(spark):
    from tidewater.sinks.table import StagingTable
    rec = _RecordingSpark(spark)
    t = StagingTable(rec, "/unused", ["p"], name="ice.db.t")
    assert t.iceberg
    batch = spark.createDataFrame([(2, 5, "b", "x")], "id int, n bigint, p string, extra string")
    t.merge(batch, ["id"], check_duplicates=False)
    assert rec.statements[0] == "ALTER TABLE ice.db.t ALTER COLUMN `n` TYPE bigint"
    assert rec.statements[1] == "ALTER TABLE ice.db.t ADD COLUMN `extra` string"
    assert rec.statements[2].startswith("MERGE INTO ice.db.t t USING tidewater_src_")
    assert rec.statements[2].endswith("ON t.`id` = s.`id` WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")


def test_sink_moves_keys_out_of_escaped_partitions(spark):
    from tidewater.session import scratch_path
    from tidewater.sinks.table import StagingTable
    t = StagingTable(spark, scratch_path(spark, "sink-escape"), ["p"])
    t.merge(spark.createDataFrame([(1, "a:b/c"), (2, "x=y")], "id int, p string"), ["id"])
    t.merge(spark.createDataFrame([(1, "plain"), (2, "x=y")], "id int, p string"), ["id"])
    assert sorted(tuple(r) for r in t.read().select("id", "p").collect()) == [(1, "plain"), (2, "x=y")]


def test_null_keys_are_not_duplicates(spark):
    s = spark.createDataFrame([(None, "a"), (None, "b"), (1, "c")], "id int, v string")
    assert merge.duplicate_keys(s, ["id"]).count() == 0


def test_overwrite_replaces_null_partition(spark):
    t = spark.createDataFrame([(1, None), (2, "b")], "id int, p string")
    s = spark.createDataFrame([(9, None)], "id int, p string")
    assert sorted(tuple(r) for r in merge.overwrite_partitions(t, s, ["p"]).collect()) == [(2, "b"), (9, None)]


def test_hot_partition_is_split_over_several_writers(spark):
    import os

    from pyspark.sql import functions as F

    from tidewater.session import local_path, scratch_path
    from tidewater.sinks.table import StagingTable
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    old = spark.conf.get(key)
    spark.conf.set(key, "256k")
    try:
        li = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
        hot = li.select(F.monotonically_increasing_id().alias("id"), "l_extendedprice", "l_comment"
                        if "l_comment" in li.columns else F.col("l_returnflag").alias("note"),
                        F.when(F.col("l_linenumber") <= 3, F.lit("HOT")).otherwise(F.col("l_returnflag")).alias("p"))
        t = StagingTable(spark, scratch_path(spark, "hot"), ["p"])
        # many input splits, as on a cluster: AQE splits a skewed rebalance partition by map ranges
        t.merge(hot.repartition(8), ["id"], check_duplicates=False)
        files = _files(t, "p=HOT")
        assert len(files) > 1  # the hot partition was written by several tasks
        assert t.read().count() == li.count()
    finally:
        spark.conf.set(key, old)


def test_schema_record_of_a_table_without_rows_is_replaced(spark):
    from tidewater.session import scratch_path
    from tidewater.sinks.table import StagingTable
    t = StagingTable(spark, scratch_path(spark, "sink-record"), ["p"])
    t.create(spark.createDataFrame([], "id int, p string"))
    t.merge(spark.createDataFrame([(1, "x", "a")], "id int, extra string, p string"), ["id"])
    assert sorted(tuple(r) for r in t.read().select("id", "extra", "p").collect()) == [(1, "x", "a")]


def _files(table, partition):
    import os

    from tidewater.session import local_path
    v = table.version()
    folder = local_path(f"{table.path}/__load={v.folders[partition]}/{partition}")
    return sorted(f"{v.folders[partition]}/{f}" for f in os.listdir(folder) if f.endswith(".parquet"))


def _table(spark, name, parts=("p",)):
    from tidewater.session import scratch_path
    from tidewater.sinks.table import StagingTable
    return StagingTable(spark, scratch_path(spark, name), list(parts))


def _rows(table):
    return sorted((r["id"], r["v"], r["p"]) for r in table.read().select("id", "v", "p").collect())


@pytest.mark.parametrize("value", [None, "a:b", "a,b", "a/b", "007", "{x}", "50%"])
def test_merge_keeps_the_rest_of_odd_partitions(spark, value):
    t = _table(spark, "odd")
    schema = "id int, v string, p string"
    t.merge(spark.createDataFrame([(1, "old", value), (2, "old", value), (3, "old", "z")], schema), ["id"], keys_may_move=False)
    t.merge(spark.createDataFrame([(1, "new", value)], schema), ["id"], keys_may_move=False)
    assert sorted(_rows(t), key=lambda r: r[0]) == [(1, "new", value), (2, "old", value), (3, "old", "z")]


def test_merge_drops_emptied_partitions(spark):
    t = _table(spark, "emptied")
    schema = "id int, v string, p string"
    t.merge(spark.createDataFrame([(1, "a", "x"), (2, "a", "y")], schema), ["id"])
    t.merge(spark.createDataFrame([(1, "b", "z"), (2, "b", "z")], schema), ["id"])
    assert _rows(t) == [(1, "b", "z"), (2, "b", "z")]
