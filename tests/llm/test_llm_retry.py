"""Tasks that fail and are retried change no operator's rows."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from conftest import REPO, SF_SMALL


def test_retried_tasks_give_the_same_rows(tmp_path):
    script = os.path.join(os.path.dirname(os.path.abspath(__file__)), "_llm_retry_job.py")
    out = subprocess.run(
        [sys.executable, script, REPO, SF_SMALL, str(tmp_path)],
        capture_output=True,
        text=True,
        timeout=900,
        env=dict(os.environ, PYTHONPATH=REPO),
    )
    assert out.returncode == 0, out.stderr[-3000:]
    same = json.loads(out.stdout.strip().splitlines()[-1])
    assert len(same) == 16 and all(same.values()), same
    assert sum(name[0].isdigit() for name in os.listdir(tmp_path)) >= 14
