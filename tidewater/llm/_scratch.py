"""Cutting lineage in the folder all executors share."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from tidewater.session import scratch_path, shared_dir


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and go on from there.

    A lost executor then costs the tasks it ran, not the work before, and a
    result that two later steps read is computed once.
    """
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


class Tables:
    """Parquet tables in the shared scratch folder that live until no later step reads them."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.name, self.paths = spark, name, {}

    def put(self, key: str, df: DataFrame) -> DataFrame:
        """Write ``df`` and read it from there; an earlier table of that key is dropped once the new one is whole.

        The shuffle files behind it are of no more use then. Spark deletes them when the driver's
        garbage collector finds their plan gone, which a driver with little to do may not run for long.
        """
        path, schema = scratch_path(self.spark, f"{self.name}-{key}"), df.schema
        df.write.option("compression", "zstd").parquet(path)
        self.drop(key)
        self.paths[key] = path
        del df
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return self.spark.read.schema(schema).parquet(path)

    def drop(self, *keys: str) -> None:
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in [self.paths.pop(k) for k in keys if k in self.paths]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)

    def keep_only(self, *keys: str) -> None:
        self.drop(*[k for k in self.paths if k not in keys])
