"""bench.py prints exactly one JSON line with the fields the driver reads."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import REPO, SF_SMALL

import __spark_entry__ as contract


def test_bench_prints_one_json_line():
    env = dict(os.environ, BENCH_SF_DIR=SF_SMALL, BENCH_CPUS="2", BENCH_WARMUP="1", BENCH_REPEAT="1", BENCH_SLOW="0")
    out = subprocess.run(
        [sys.executable, os.path.join(REPO, "bench.py")],
        env=env,
        capture_output=True,
        text=True,
        timeout=1800,
        check=True,
    ).stdout
    lines = [line for line in out.splitlines() if line.strip()]
    assert len(lines) == 1, out
    result = json.loads(lines[0])
    assert result["unit"] == "sec"
    assert result["sf"] == 0.001
    assert set(result["queries"]) == set(contract.queries()) == set(result["cold"])
    assert all(seconds > 0 for seconds in result["cold"].values())
    assert result["shuffle_partitions"] == 200  # the default users get
    assert result["value"] == round(sum(result["queries"].values()), 4)
