"""bench.py prints exactly one JSON line with the agreed keys (own JVM)."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF_SMALL


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_RUNS="1", BENCH_CPUS="2",
               BENCH_QUERIES="dwd_video_wide")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True).stdout
    lines = [l for l in out.splitlines() if l.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert {"metric", "value", "unit", "queries", "sf"} <= rec.keys()
    assert rec["unit"] == "sec" and rec["sf"] == "0.001"
    assert rec["queries"]["dwd_video_wide"] > 0
