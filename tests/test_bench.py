"""bench.py prints exactly one JSON line with the driver's keys."""

import json
import os
import subprocess
import sys

from .conftest import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF001, BENCH_CPUS="2", BENCH_QUERIES="touch_rate,hub_top")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=tmp_path,
                         capture_output=True, text=True, timeout=900, check=True).stdout.strip().splitlines()
    assert len(out) == 1
    d = json.loads(out[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= set(d)
    assert d["unit"] == "sec" and set(d["queries"]) == {"touch_rate", "hub_top"} and d["value"] > 0
    assert d["source_scans"]["hub"]["actions"] == 1
