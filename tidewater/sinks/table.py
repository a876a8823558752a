"""Staging tables: versioned Parquet folders (or a catalog table when an
Iceberg catalog is configured) with create / schema-sync / overwrite / merge.

A load writes its rows once, where they stay: in a folder of its own below the table
(``__load=<id>/<partition>``). A version of the table (``manifest``) names, for each partition, the load that holds
its rows. Committing a version is the only step that changes the table: a run
that dies before leaves it as it was, one that dies after has changed it in full, and no file is
moved, on any file system. Readers go through ``read`` (or ``read_table``, or the session
catalog where the table is registered). Folders that a version replaces stay until the next load begins, for the
readers of the version before.

Parquet has no MERGE, so a merge rewrites only the partitions it touches:

1. touched = partitions of the source rows, plus partitions holding target
   rows whose key appears in the source (a key may move partition). These are looked for
   in the key columns of the files whose key range, recorded when they were
   written, meets the batch's;
2. the touched partitions, read by their folders, keep the rows that the batch does not
   replace (anti join on the keys); those and the batch are the load's content;
3. the new version names the load's folders for the touched partitions; one left
   without rows is named no more.

A load of several raw partitions behaves as if they were written one after
another (``order`` names the column of the raw partition): a merge keeps, per
key, the row of the last one; an overwrite keeps, per table partition, the rows
of the last one that writes it.

Executor loss is retried by Spark's task retry. Partitioned writes carry a REBALANCE hint (few
files per partition, hot partitions split by AQE). One load writes a table at a time; a second one that
commits in between is refused. Schema evolution is part of the version: reads apply it and
Spark's Parquet reader widens older files, so no data is rewritten.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ByteType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType, StructField, StructType,
                               TimestampNTZType)

from tidewater.operators import merge as M
from tidewater.session import read_text_partitions
from tidewater.sinks.manifest import Files, Manifests, Version


def _q(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def iceberg_catalog(spark: SparkSession, table: str) -> bool:
    """True when ``table`` is qualified by a configured Iceberg catalog."""
    cat = table.split(".")[0]
    impl = spark.conf.get(f"spark.sql.catalog.{cat}", None)
    return bool(impl) and "iceberg" in impl.lower()


# --- fixed values: Spark's directory name for a NULL partition value ----------
DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"
# -----------------------------------------------------------------------------
LOAD = "__load"
#: Types whose text gives back the same value and order in any session.
RANGED = (ByteType, ShortType, IntegerType, LongType, DecimalType, StringType, DateType, TimestampNTZType)
KEY_RANGES = "_key_ranges"


def unquote_partition_value(text: str) -> str:
    """Inverse of Spark's partition-path escaping (``%XX`` -> character)."""
    return re.sub(r"%([0-9A-Fa-f]{2})", lambda m: chr(int(m.group(1), 16)), text)


def partition_values(folder: str) -> tuple:
    """The values in a partition's folder name, as Spark reads them back."""
    raw = [level.split("=", 1)[1] for level in folder.split("/")] if folder else []
    return tuple(None if v == DEFAULT_PARTITION else unquote_partition_value(v) for v in raw)


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the Parquet staging table at ``path``."""
    found = Manifests(Files(spark, path), path.rstrip("/")).latest()
    return StagingTable(spark, path, found.partition_cols if found else []).read()


class StagingTable:
    """``register`` names a table of the session catalog that is kept in step with every version."""

    def __init__(self, spark: SparkSession, path: str, partition_cols: list[str], name: str | None = None, register: str | None = None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_cols = list(partition_cols)
        self.name = name
        self.register = register
        self.iceberg = bool(name) and iceberg_catalog(spark, name)
        self._stages: list[str] = []
        if not self.iceberg:
            self.files = Files(spark, self.path)
            self.manifests = Manifests(self.files, self.path)

    # -- reading -----------------------------------------------------------
    def version(self) -> Version | None:
        return self.manifests.latest()

    def exists(self) -> bool:
        """Whether the table has data; metadata only."""
        if self.iceberg:
            return self.spark.catalog.tableExists(self.name)
        found = self.version()
        return bool(found and found.folders)

    def read(self) -> DataFrame:
        """The stored rows; partition columns come back as text (as written in the paths)."""
        if self.iceberg:
            return self.spark.table(self.name)
        found = self.version()
        if found is None:  # not written by this sink: the files' schemas, merged
            return read_text_partitions(self.spark, self.path, self.partition_cols, mergeSchema="true")
        return self._read(found, list(found.folders))

    def _folder(self, version: Version, partition: str) -> str:
        return f"{self.path}/{LOAD}={version.folders[partition]}/{partition}".rstrip("/")

    def _read(self, version: Version, partitions: list[str]) -> DataFrame:
        """Rows of the given partitions; only their folders are listed."""
        return self._read_paths(version, [self._folder(version, p) for p in partitions])

    def _read_paths(self, version: Version, paths: list[str]) -> DataFrame:
        # older files holding a narrower type are widened to the recorded one on read
        parts = [StructField(c, StringType(), True) for c in self.partition_cols]
        schema = StructType(list(version.schema.fields) + parts)
        if not paths:
            return self.spark.createDataFrame([], schema)
        whole = StructType([*version.schema.fields, StructField(LOAD, StringType(), True), *parts])
        return (self.spark.read.schema(whole).option("basePath", self.path).option("__globPaths__", "false")
                .parquet(*paths).select(*[F.col(_q(f.name)) for f in schema.fields]))

    # -- K1: create --------------------------------------------------------
    def _data_schema(self, schema: StructType) -> StructType:
        part = {c.lower() for c in self.partition_cols}
        return StructType([StructField(f.name, f.dataType, True) for f in schema.fields if f.name.lower() not in part])

    def create(self, df: DataFrame) -> None:
        """Create the table with the schema of ``df``, without rows; one that exists stays as it is."""
        if self.iceberg:
            if not self.exists():
                df.limit(0).writeTo(self.name).partitionedBy(*[F.col(c) for c in self.partition_cols]) \
                  .using("iceberg").tableProperty("location", self.path).create()
        elif self.version() is None:
            self._commit(None, Version(0, self.partition_cols, self._data_schema(df.schema)))

    # -- K2: schema sync ------------------------------------------------------
    def synchronize_schema(self, df: DataFrame, exists: bool | None = None) -> DataFrame:
        """Evolve the table to accept ``df``: add new columns (nullable), widen
        int->bigint / float->double, never drop. Returns ``df`` projected onto
        the evolved schema."""
        before = None if self.iceberg else self.version()
        if not (before or self.iceberg and (self.exists() if exists is None else exists)):
            return df
        part = {c.lower() for c in self.partition_cols}
        current = self._data_schema(self.read().schema if before is None else before.schema)
        data = StructType([f for f in df.schema.fields if f.name.lower() not in part])
        cols = M.synced_schema(current, data) + [(f.name, f.dataType) for f in df.schema.fields
                                                 if f.name.lower() in part]
        have = {f.name.lower(): f.dataType for f in current.fields}
        changed = [(n, t) for n, t in cols
                   if n.lower() not in part and (n.lower() not in have or t != have[n.lower()])]
        if self.iceberg and changed:
            for n, t in changed:
                if n.lower() in have:
                    self.spark.sql(f"ALTER TABLE {self.name} ALTER COLUMN {_q(n)} TYPE {t.simpleString()}")
                else:
                    self.spark.sql(f"ALTER TABLE {self.name} ADD COLUMN {_q(n)} {t.simpleString()}")
        elif changed:
            # Parquet files keep the types they were written with; the version's schema
            # carries the evolution and the reader widens older files
            # (int -> bigint, float -> double), so no data is rewritten.
            new = self._data_schema(StructType([StructField(n, t, True) for n, t in cols]))
            self._commit(before, Version(0, before.partition_cols, new, dict(before.folders)))
        return M.conform(df, cols)

    # -- K3: dynamic partition overwrite --------------------------------------
    def overwrite_partitions(self, df: DataFrame, order: str | None = None) -> None:
        self.recover()
        if order:
            # a table, as it decides what is kept and is small: one row per partition that several loads write
            record = f"{self._staging_dir()}/last"
            M.last_loads(df, self.partition_cols, order).write.parquet(record)
            last = self.spark.read.parquet(record)
            if not last.isEmpty():
                df = M.without_overwritten(df, last, self.partition_cols, order)
            df = df.drop(order)
        df = self.synchronize_schema(df)
        if self.iceberg:
            df.writeTo(self.name).overwritePartitions()
            return
        self._write(df, set())

    # -- K4/K5: merge ----------------------------------------------------------
    def merge(self, df: DataFrame, keys: list[str], check_duplicates: bool = True,
              keys_may_move: bool = True, materialise: bool = True, order: str | None = None) -> None:
        """Upsert ``df`` on ``keys`` (WHEN MATCHED UPDATE * WHEN NOT MATCHED INSERT *).

        The batch is materialised once under the table's staging folder, so the
        raw source is parsed a single time; the duplicate-key check, the
        touched-partition search and the rewrite all read that columnar copy.
        ``keys_may_move=False`` declares that a key never changes partition, so only
        the source's partitions are listed and read (no scan of the table's keys).
        ``materialise=False`` when ``df`` already reads a materialised copy.
        ``order`` names the column of the load partition: a key may come once in
        each, and its row in the last one counts; the column is not stored.
        """
        if order:
            self.recover()
            if materialise:
                df = self._materialise(df)
            df = self._last_of_each_key(df, keys, order)
            check_duplicates, materialise = False, False
        if self.iceberg:
            if check_duplicates:
                self._check_duplicates(df, keys)
            if not self.exists():
                self.create(df)
            df = self.synchronize_schema(df)
            view = f"tidewater_src_{uuid.uuid4().hex[:8]}"
            df.createOrReplaceTempView(view)
            cond = " AND ".join(f"t.{_q(k)} = s.{_q(k)}" for k in keys)
            self.spark.sql(f"MERGE INTO {self.name} t USING {view} s ON {cond} "
                           "WHEN MATCHED THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *")
            return
        self.recover()
        if materialise:
            df = self._materialise(df)
        if check_duplicates:
            self._check_duplicates(df, keys)
        df = self.synchronize_schema(df)
        version = self.version()
        if not (version and version.folders):
            self._write(df, set(), keys)
            return
        p = self.partition_cols
        touched = {tuple(r) for r in df.select(*[F.col(_q(c)).cast("string") for c in p]).distinct().collect()} if p else {()}
        folders = {f for f in version.folders if partition_values(f) in touched}
        if keys_may_move and p:
            folders |= self._moved_from(version, df, keys, folders)
        # partition values come back from the paths as text: give them the batch's types
        target = self._read(version, sorted(folders)).withColumns({c: F.col(_q(c)).cast(df.schema[c].dataType) for c in p})
        new_content = M.merge_upsert(target, df, keys)
        self._write(M.conform(new_content, [(f.name, f.dataType) for f in df.schema.fields]), folders, keys)

    def _moved_from(self, version: Version, df: DataFrame, keys: list[str], touched: set[str]) -> set[str]:
        """Other partitions that hold a key of the batch.

        Each load records the range of the first key in each of its files. Only the files
        whose range meets the batch's are opened, and of those only the key columns.
        """
        others = [f for f in version.folders if f not in touched]
        if not others:
            return set()
        first = F.col(_q(keys[0]))
        lo, hi = df.agg(F.min(first), F.max(first)).first()
        if lo is None:  # NULL keys match nothing
            return set()
        ranges = [f"{self.path}/{KEY_RANGES}/{n}" for n in sorted({version.folders[f] for f in others})
                  if self.files.names(f"{self.path}/{KEY_RANGES}/{n}")]
        if ranges:
            kind = version.schema[keys[0]].dataType if keys[0] in version.schema.names else StringType()
            seen = self.spark.read.parquet(*ranges).where(F.col("key") == F.lit(keys[0]))
            near = seen.where((F.col("first").cast(kind) <= F.lit(hi)) & (F.col("last").cast(kind) >= F.lit(lo)))
            files = {(r["load"], r["partition"]): [] for r in seen.select("load", "partition").distinct().collect()}
            for r in near.select("load", "partition", "file").collect():
                files[r["load"], r["partition"]].append(r["file"])
        else:
            files = {}
        paths = []
        for f in others:
            folder = self._folder(version, f)
            own = files.get((version.folders[f], f))
            paths += [folder] if own is None else [f"{folder}/{x}" for x in own]
        if not paths:
            return set()
        columns = [F.col(_q(c)) for c in self.partition_cols]
        found = (self._read_paths(version, paths).select(*[F.col(_q(k)) for k in keys if k not in self.partition_cols], *columns)
                 .join(df.select(*[F.col(_q(k)) for k in keys]), on=keys, how="left_semi").select(*columns).distinct().collect())
        values = {tuple(r) for r in found}
        return {f for f in others if partition_values(f) in values}

    # -- internals ----------------------------------------------------------------
    def _staging_dir(self) -> str:
        d = f"{self.path}/_staging/{uuid.uuid4().hex}"
        self._stages.append(d)
        return d

    def _cleanup(self) -> None:
        """Drop the batch copies; for callers whose load has committed or failed."""
        if not self.iceberg:
            for d in self._stages:
                self.files.delete(d)
        self._stages = []

    def _clustered(self, df: DataFrame) -> DataFrame:
        """Group rows of one table partition into few write tasks (few files per
        partition) without a hot partition landing in a single task: the
        REBALANCE hint lets AQE split skewed partitions and merge small ones."""
        return df.hint("rebalance", *self.partition_cols) if self.partition_cols else df

    def _materialise(self, df: DataFrame) -> DataFrame:
        """Write the batch once (Parquet, shared storage) and continue from that copy."""
        stage = f"{self._staging_dir()}/source"
        df.write.mode("overwrite").parquet(stage)
        return self.spark.read.parquet(stage)

    @staticmethod
    def _check_duplicates(df: DataFrame, keys: list[str]) -> None:
        dup = M.duplicate_keys(df, keys).limit(1).collect()
        if dup:
            raise ValueError(f"MERGE source has more than one row for key {dup[0].asDict()}")

    def _last_of_each_key(self, df: DataFrame, keys: list[str], order: str) -> DataFrame:
        """``df`` without the rows that a later load partition replaces; two rows for a key in one partition raise."""
        record = f"{self._staging_dir()}/repeats"
        M.repeated_keys(df, keys, order).write.parquet(record)
        repeats = self.spark.read.parquet(record)
        if not repeats.isEmpty():
            self._check_duplicates(df.join(repeats.select(*[F.col(_q(k)) for k in keys]), keys, "left_semi"), [*keys, order])
            df = M.without_superseded(df, repeats, keys, order)
        return df.drop(order)

    def _write(self, df: DataFrame, replaced: set[str], keys: list[str] = ()) -> None:
        """Write ``df`` as a load and commit a version that names its folders in place of ``replaced`` and of equal partitions."""
        before = self.version()
        load = f"{(before.number if before else 0) + 1:09d}-{uuid.uuid4().hex[:12]}"
        folder = f"{self.path}/{LOAD}={load}"
        self._clustered(df).write.partitionBy(*self.partition_cols).parquet(folder)
        new = dict.fromkeys(self.files.folders(folder, len(self.partition_cols)), load)
        if keys and self.partition_cols and new and keys[0] not in self.partition_cols and isinstance(df.schema[keys[0]].dataType, RANGED):
            self._record_ranges(folder, load, keys[0])
        old = dict(before.folders) if before else {}
        gone = [f for f in old if f in new or f in replaced]
        schema = before.schema if before else self._data_schema(df.schema)
        self._commit(before, Version(0, self.partition_cols, schema, {**{f: n for f, n in old.items() if f not in gone}, **new},
                                     [f"{LOAD}={old[f]}/{f}".rstrip("/") for f in gone]))

    def _record_ranges(self, folder: str, load: str, key: str) -> None:
        """Smallest and largest key of each file of a load, as text, for the search of later merges."""
        place = F.substring_index(F.input_file_name(), f"{LOAD}={load}/", -1)
        rows = (self.spark.read.parquet(folder).groupBy(place.alias("at"))
                .agg(F.min(F.col(_q(key))).cast("string").alias("first"), F.max(F.col(_q(key))).cast("string").alias("last")))
        # input_file_name is a URI: the folder's own escapes are escaped once more there
        at = F.expr("url_decode(replace(at, '+', '%2B'))")
        rows.select(F.lit(load).alias("load"), F.lit(key).alias("key"), F.regexp_extract(at, "^(.*)/[^/]*$", 1).alias("partition"),
                    F.substring_index(at, "/", -1).alias("file"), "first", "last").write.parquet(f"{self.path}/{KEY_RANGES}/{load}")

    def _commit(self, before: Version | None, after: Version) -> None:
        self.manifests.commit(before, after)
        if self.register:
            self._sync_catalog(before, after)
        self.spark.catalog.refreshByPath(self.path)

    def recover(self) -> int:
        """Remove what no version needs: folders replaced by the latest one, those of loads that died, batch copies. Returns the dead loads.

        For one writer at a time, as the loads themselves. The copies of this object's own load are left alone.
        """
        if self.iceberg:
            return 0
        for name in self.files.names(f"{self.path}/_staging"):
            if f"{self.path}/_staging/{name}" not in self._stages:
                self.files.delete(f"{self.path}/_staging/{name}")
        now = self.version()
        live = set(now.folders.values()) if now else set()
        for f in now.replaced if now else []:
            self.files.delete(f"{self.path}/{f}")
        known = live | {f.split("/", 1)[0].removeprefix(f"{LOAD}=") for f in (now.replaced if now else [])}
        done = 0
        for name in self.files.names(self.path):
            load = name.removeprefix(f"{LOAD}=")
            if name != load and load not in live:
                self.files.delete(f"{self.path}/{name}")
                done += load not in known
        for load in self.files.names(f"{self.path}/{KEY_RANGES}"):
            if load not in live:
                self.files.delete(f"{self.path}/{KEY_RANGES}/{load}")
        self.manifests.forget_old()
        if self.register and now and not self.spark.catalog.tableExists(self.register):  # died between commit and registration
            self._sync_catalog(None, now)
        return done

    # -- the session catalog ----------------------------------------------------
    def _spec(self, partition: str) -> str:
        values = ["null" if v is None else "'" + v.replace("\\", "\\\\").replace("'", "\\'") + "'" for v in partition_values(partition)]
        return "PARTITION (" + ", ".join(f"{_q(c)} = {v}" for c, v in zip(self.partition_cols, values, strict=True)) + ")"

    def _at(self, version: Version, partition: str) -> str:
        return "LOCATION '" + self._folder(version, partition).replace("\\", "\\\\").replace("'", "\\'") + "'"

    def _sync_catalog(self, before: Version | None, after: Version) -> None:
        """Bring the registered table's columns and partitions to ``after``; only what changed is altered."""
        name = self.register
        p = self.partition_cols
        same = before is not None and before.schema == after.schema and self.spark.catalog.tableExists(name) and bool(p)
        if not same:
            self.spark.sql(f"DROP TABLE IF EXISTS {name}")
            cols = ", ".join(f"{_q(f.name)} {f.dataType.simpleString()}" for f in [*after.schema.fields, *[StructField(c, StringType()) for c in p]])
            by = f"PARTITIONED BY ({', '.join(map(_q, p))})" if p else ""
            root = self.path if p or not after.folders else self._folder(after, "")
            self.spark.sql(f"CREATE TABLE {name} ({cols}) USING parquet {by} LOCATION '{root}'")
        old = before.folders if same else {}
        for f in [f for f in old if f not in after.folders]:
            self.spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {self._spec(f)}")
        for f in [f for f in old if f in after.folders and old[f] != after.folders[f]]:
            self.spark.sql(f"ALTER TABLE {name} {self._spec(f)} SET {self._at(after, f)}")
        new = [f for f in after.folders if f not in old] if p else []
        for lo in range(0, len(new), 500):
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS " + " ".join(f"{self._spec(f)} {self._at(after, f)}" for f in new[lo:lo + 500]))
        self.spark.sql(f"REFRESH TABLE {name}")
