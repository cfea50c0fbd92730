import json
import os
import subprocess
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF, BENCH_CPUS="2", BENCH_QUERIES="kpis,win_city",
               BENCH_WARMUP_DIR=SF)
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env,
                         capture_output=True, text=True, timeout=600, check=True)
    lines = [ln for ln in out.stdout.splitlines() if ln.strip()]
    assert len(lines) == 1
    res = json.loads(lines[0])
    assert res["unit"] == "sec" and res["sf"] == "0.001"
    assert set(res["queries"]) == {"kpis", "win_city"}
    assert res["value"] == pytest.approx(sum(res["queries"].values()), abs=0.01)
