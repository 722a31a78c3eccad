"""Pricing summary on a session that retries tasks, with failures injected.

Run as a script by ``test_retry.py``: ``python _retry_job.py REPO SF_DIR MARK_DIR``.
First attempts of some tasks fail, both in the scan stage (after part of the
task's output is produced) and in the stage after the shuffle; the retried
job must give the same rows. Each injected failure leaves a marker file in
MARK_DIR so the test can tell the failures really happened. Prints the result
rows as one JSON line.
"""

from __future__ import annotations

import json
import os
import sys

REPO, SF_DIR, MARK_DIR = sys.argv[1:4]
sys.path.insert(0, REPO)

from pyspark import TaskContext  # noqa: E402

from tillandsia.plans.pricing import LINEITEM_COLUMNS, pricing_summary_of  # noqa: E402
from tillandsia.session import build_session  # noqa: E402
from tillandsia.sources.tables import read_table  # noqa: E402

# Which task partitions fail on their first attempt.
FAILING_SCAN_PARTITIONS = {0, 5}
FAILING_FINAL_PARTITIONS = {0}


def failing_first_attempt(stage: str, partitions: set[int]):
    def run(batches):
        ctx = TaskContext.get()
        fail = ctx.attemptNumber() == 0 and ctx.partitionId() in partitions
        for i, batch in enumerate(batches):
            if fail and i == 1:  # part of this task's output is already out
                open(os.path.join(MARK_DIR, f"{stage}-{ctx.partitionId()}"), "w").close()
                raise RuntimeError(f"injected failure: {stage} partition {ctx.partitionId()}")
            yield batch
        if fail:  # fewer than two batches
            open(os.path.join(MARK_DIR, f"{stage}-{ctx.partitionId()}"), "w").close()
            raise RuntimeError(f"injected failure: {stage} partition {ctx.partitionId()}")

    return run


def main() -> None:
    spark = build_session(
        "local[4,3]",  # 4 threads, up to 3 attempts per task
        app_name="tillandsia-retry-test",
        conf={
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
        },
    )
    spark.sparkContext.setLogLevel("OFF")
    lineitem = read_table(spark, SF_DIR, "lineitem", schema=LINEITEM_COLUMNS).repartition(8)
    flaky = lineitem.mapInPandas(failing_first_attempt("scan", FAILING_SCAN_PARTITIONS), lineitem.schema)
    summary = pricing_summary_of(flaky)
    result = summary.mapInPandas(failing_first_attempt("final", FAILING_FINAL_PARTITIONS), summary.schema)
    rows = [[str(v) for v in r] for r in result.collect()]
    spark.stop()
    print(json.dumps(rows))


if __name__ == "__main__":
    main()
