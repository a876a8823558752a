"""Count how many SQL executions of one staging job scan the raw files.

    python tools/count_raw_scans.py [sf_dir]

Runs the whole-zone FULL load (the ``staging_job`` query) in a fresh session
with Spark's event log written to a scratch folder, then reads the log: every
SQL execution whose physical plan has a CSV scan is a pass over raw files.
"""

from __future__ import annotations

import glob
import json
import os
import re
import sys
import tempfile

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main(argv: list[str]) -> None:
    sf_dir = next((a for a in argv[1:] if not a.startswith("--")), "/root/testdata/sf0.01")
    log_dir = tempfile.mkdtemp(prefix="tidewater-eventlog-")
    from tidewater import scenarios
    from tidewater.session import build_session
    spark = build_session("local[8]", shuffle_partitions=16, extra={
        "spark.ui.showConsoleProgress": "false", "spark.eventLog.enabled": "true",
        "spark.eventLog.dir": f"file://{log_dir}", "spark.eventLog.compress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    scenarios.raw_orders_dir(spark, sf_dir)          # raw zone exists before the load
    scenarios.q_staging_job(spark, sf_dir).count()   # the load itself (+ a read-back count)
    spark.stop()
    csv_scans = total = 0
    executions = []
    for path in glob.glob(os.path.join(log_dir, "**", "*"), recursive=True):
        if os.path.isdir(path):
            continue
        with open(path) as f:
            for line in f:
                ev = json.loads(line)
                if ev.get("Event", "").endswith("SQLExecutionStart"):
                    total += 1
                    plan = ev.get("physicalPlanDescription", "")
                    scans = sorted(set(re.findall(r"Scan (\w+)", plan)))
                    if "csv" in scans:
                        csv_scans += 1
                    root = plan.splitlines()[1].strip() if len(plan.splitlines()) > 1 else ""
                    executions.append({"id": ev.get("executionId"), "root": root[:80], "scans": scans})
    if "--verbose" in argv:
        for e in sorted(executions, key=lambda e: e["id"]):
            print(json.dumps(e))
    print(json.dumps({"sql_executions": total, "executions_scanning_raw_csv": csv_scans, "event_log": log_dir}))


if __name__ == "__main__":
    main(sys.argv)
