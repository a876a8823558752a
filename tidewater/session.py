"""Session settings and the shared scratch location.

The loader needs a handful of session-level settings (dynamic partition
overwrite, CORRECTED datetime rebase, a pinned time zone, AQE). Everything
else is left to Spark's defaults so a cluster-provided session keeps its own
tuning.
"""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StringType, StructField, StructType

# Settings the staging job relies on. Values are Spark's public configuration keys.
STAGING_CONF = {
    "spark.sql.parquet.datetimeRebaseModeInRead": "CORRECTED",
    "spark.sql.parquet.datetimeRebaseModeInWrite": "CORRECTED",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(master: str | None = None, app_name: str = "tidewater",
                  shuffle_partitions: int | None = None, extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the staging settings applied.

    On a cluster ``master`` is left to spark-submit; tests pass ``local[*]``.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(STAGING_CONF)
    conf["spark.ui.enabled"] = "false"
    conf["spark.scheduler.mode"] = "FAIR"  # for loads that run side by side, each in its pool
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    apply_staging_conf(spark)
    return spark


def apply_staging_conf(spark: SparkSession) -> None:
    """Apply the runtime-settable staging settings to an existing session."""
    for k, v in STAGING_CONF.items():
        try:
            spark.conf.set(k, v)
        except AnalysisException:  # a setting this session does not let change: keep the cluster's value
            pass


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None on Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:
        return None


def shared_dir(spark: SparkSession) -> str:
    """Root of the cluster-visible scratch folder.

    Uses the session's checkpoint directory (``spark.checkpoint.dir`` or the one
    set on the SparkContext). Only when none is configured -- local tests --
    a directory is created and registered as the checkpoint dir.
    """
    sc = _context(spark)
    path = None
    if sc is not None:
        try:
            path = sc.getCheckpointDir()
        except Exception:
            path = None
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None)
        if not path and sc is not None:
            path = sc.getConf().get("spark.checkpoint.dir", None)
        if not path:
            master = (sc.master if sc is not None else spark.conf.get("spark.master", "")) or ""
            if master and not master.startswith("local"):
                raise ValueError("spark.checkpoint.dir must name a folder every executor can reach "
                                 "(a machine-local temporary folder would lose scratch data)")
            path = tempfile.mkdtemp(prefix="tidewater-ckpt-")  # local mode (tests) only
        if sc is not None:
            sc.setCheckpointDir(path)
            try:
                path = sc.getCheckpointDir() or path
            except Exception:
                pass
    return path


def session_key(spark: SparkSession):
    """Identity of the running application (for per-session caches)."""
    sc = _context(spark)
    if sc is not None:
        return sc.applicationId
    return spark.conf.get("spark.app.id", None) or id(spark)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh sub-folder of the shared scratch folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/tidewater-scratch/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str | None:
    """Filesystem path for ``file:`` URIs (tests inspect written files)."""
    if path.startswith("file:"):
        return path[5:].replace("///", "/", 1) if path.startswith("file:///") else path[5:]
    if path.startswith("/"):
        return path
    return None if "://" in path else os.path.abspath(path)


def read_text_partitions(spark: SparkSession, path: str, partition_cols: list[str], **options: str) -> DataFrame:
    """A partitioned Parquet folder with its directory values as text (``p=007`` stays '007').

    Spark takes a directory value as it stands where the given schema declares
    its column; the footers give the schema, and no session setting is touched.
    """
    seen = spark.read.options(**options).parquet(path).schema
    fields = [StructField(f.name, StringType(), True) if f.name in partition_cols else f for f in seen.fields]
    return spark.read.schema(StructType(fields)).parquet(path)
