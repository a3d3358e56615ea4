"""bench.py prints exactly one JSON line with the fields the driver reads."""

import json
import os
import subprocess
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_bench_prints_one_json_line(sf_small):
    env = dict(os.environ, BENCH_SF_DIR=sf_small, BENCH_CPUS="4", BENCH_REPEATS="1")
    out = subprocess.run([sys.executable, os.path.join(ROOT, "bench.py")], env=env, cwd=ROOT,
                         capture_output=True, text=True, timeout=900)
    assert out.returncode == 0, out.stderr[-2000:]
    lines = [line for line in out.stdout.splitlines() if line.strip()]
    assert len(lines) == 1
    report = json.loads(lines[0])
    assert report["unit"] == "sec" and report["metric"]
    assert report["value"] > 0 and report["sf"] == "0.001"
    assert {"train_model", "score_corpus", "class_stats", "stream_score"} <= set(report["queries"])
    assert abs(sum(report["queries"].values()) - report["value"]) < 0.05
