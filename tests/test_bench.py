"""The benchmark runs and times what it is asked for."""
import json
import os
import subprocess
import sys

import __spark_entry__ as E

REPO = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_line_of_figures():
    names = ["cast_int", "sink_merge"]
    assert set(names) <= set(E.queries())
    env = {**os.environ, "BENCH_SF_DIR": "/root/testdata/sf0.001", "BENCH_CPUS": "4"}
    out = subprocess.run([sys.executable, os.path.join(REPO, "bench.py"), *names], env=env, capture_output=True, text=True, timeout=300)
    assert out.returncode == 0, out.stderr[-2000:]
    x = json.loads(out.stdout.strip().splitlines()[-1])
    assert set(x["queries"]) == set(names) and x["unit"] == "sec" and x["value"] > 0
