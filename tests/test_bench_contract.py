"""bench.py prints exactly one JSON line with the fields the driver records."""

import json
import os
import subprocess
import sys

from tests.conftest import ROOT, SF


def test_bench_prints_one_json_line(tmp_path):
    env = dict(os.environ, BENCH_SF_DIR=SF["0.001"], BENCH_CPUS="4", BENCH_REPEAT="1",
               BENCH_STREAM="0", BENCH_LLM="0")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=str(tmp_path),
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [l for l in out.stdout.splitlines() if l.strip()]
    assert len(lines) == 1
    rec = json.loads(lines[0])
    assert rec["metric"] and rec["unit"] == "sec" and rec["sf"] == 0.001
    assert rec["value"] > 0 and len(rec["queries"]) == 30
    assert abs(sum(rec["queries"].values()) - rec["value"]) < 0.01
