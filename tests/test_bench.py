"""bench.py prints exactly one JSON line with the keys the driver reads."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.001"


@pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")
def test_bench_prints_one_json_line():
    env = {**os.environ, "BENCH_SF_DIR": SF, "BENCH_CPUS": "2", "BENCH_REPEAT": "1",
           "BENCH_QUERIES": "count_commtype,unique_calls"}
    out = subprocess.run([sys.executable, str(ROOT / "bench.py")], capture_output=True, text=True,
                         env=env, timeout=900, check=True).stdout
    lines = [ln for ln in out.splitlines() if ln.strip()]
    assert len(lines) == 1
    d = json.loads(lines[0])
    assert d["unit"] == "sec" and d["sf"] == 0.001 and isinstance(d["value"], float)
    assert set(d["queries"]) == {"count_commtype", "unique_calls"}
    assert d["value"] == pytest.approx(sum(d["queries"].values()), abs=0.01)
