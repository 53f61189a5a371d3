"""Skew regression: one participant-day holds a third of all rows; no
post-shuffle task may read more than a small fraction of it."""

import json
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
SF = "/root/testdata/sf0.01"


@pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")
def test_hot_participant_day_is_never_read_by_one_task(tmp_path):
    out = subprocess.run([sys.executable, str(ROOT / "tools" / "skew_check.py"), SF, str(tmp_path)],
                         capture_output=True, text=True, timeout=900, check=True).stdout
    report = json.loads(out[out.index("{"):])
    hot = report["participant_day_rows"]
    assert hot * 3 >= report["event_rows"] * 0.9
    assert set(report["queries"]) >= {"count_commtype", "stats_phone", "call_duration", "unique_calls",
                                      "call_duration_all_tied", "sensor_population"}
    for name, q in report["queries"].items():
        assert q["max_task_shuffle_records"] < hot / 4, (name, q, hot)
