"""An append-only ledger of runs: what each run, and each of its partitions, came to.

Every run is one file of JSON lines, named by the run and its status and
created only if there is none of that name. A run that is repeated under
its id therefore adds nothing, whoever runs it and however often, and says so.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession

from tidewater.sinks.manifest import Files

SCHEMA = ("project_name string, job_name string, run_id string, job_type string, environment string, trigger_source string, "
          "status string, error_message string, input_parameters string, emitted_at timestamp_ntz, "
          "partition_value string, n long, partition_status string, partition_error string")


def append(spark: SparkSession, path: str, record: dict, identity: list[str], partitions: list[dict] = ()) -> bool:
    """Add a run's row and one for each of its partitions; False if the ledger has the run already."""
    files = Files(spark, path)
    name = f"{path.rstrip('/')}/{hashlib.sha256(json.dumps([*identity, record['status']]).encode()).hexdigest()}.json"
    if files.fs.exists(files.path(name)):
        return False
    record = {**record, "emitted_at": record["emitted_at"].isoformat(timespec="microseconds")}
    lines = [record, *({**record, **p} for p in partitions)]
    try:
        files.create(name, "\n".join(json.dumps(x) for x in lines).encode())
    except Exception as e:
        if "AlreadyExists" in str(e):  # the same run, reported by someone else in between
            return False
        raise
    return True


def read(spark: SparkSession, path: str) -> DataFrame:
    """A row for each run (``partition_value`` is null) and for each partition that it looked at."""
    return spark.read.schema(SCHEMA).json(path)
