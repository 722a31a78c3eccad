"""Re-executed and re-laid-out work gives the same result.

Executors can be lost at any time; Spark then re-runs their tasks, possibly
with other splits and in another order. The flagship keeps no driver-side
state and sums exactly (order-independent), so a re-run must reproduce the
result bit for bit.
"""

from __future__ import annotations

import json
import os
import subprocess
import sys

import pytest
from conftest import REPO, SF_ORACLE, SF_SMALL

from tillandsia.plans.pricing import LINEITEM_COLUMNS, pricing_summary, pricing_summary_of
from tillandsia.sources.tables import read_table


def as_strings(rows) -> list[list[str]]:
    return [[str(v) for v in r] for r in rows]


@pytest.mark.parametrize("partitions", [1, 3, 64])
def test_same_result_for_any_task_layout(spark, partitions):
    lineitem = read_table(spark, SF_ORACLE, "lineitem", schema=LINEITEM_COLUMNS)
    # rows reach the partial aggregates in another grouping and order each time
    shuffled = lineitem.orderBy(lineitem.l_extendedprice.desc()).repartition(partitions)
    assert pricing_summary_of(shuffled).collect() == pricing_summary(spark, SF_ORACLE).collect()


def test_failed_task_attempts_are_retried_to_the_same_result(spark, tmp_path):
    """Scan-stage and post-shuffle tasks fail on their first attempt, then succeed."""
    job = os.path.join(os.path.dirname(os.path.abspath(__file__)), "_retry_job.py")
    done = subprocess.run(
        [sys.executable, job, REPO, SF_SMALL, str(tmp_path)],
        capture_output=True,
        text=True,
        timeout=300,
    )
    assert done.returncode == 0, done.stderr[-3000:]
    rows = json.loads(done.stdout.strip().splitlines()[-1])
    assert sorted(os.listdir(tmp_path)) == ["final-0", "scan-0", "scan-5"]
    assert rows == as_strings(pricing_summary(spark, SF_SMALL).collect())
