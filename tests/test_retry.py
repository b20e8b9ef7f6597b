"""Jobs survive lost tasks: results whole, nothing duplicated."""

import json
import os
import subprocess
import sys

from conftest import ROOT, SF001


def test_jobs_survive_task_loss():
    env = dict(os.environ, PYTHONPATH=ROOT)
    p = subprocess.run(
        [sys.executable, os.path.join(ROOT, "tests", "retry_job.py"), ROOT, SF001],
        capture_output=True, text=True, timeout=600, env=env,
    )
    line = [x for x in p.stdout.splitlines() if x.startswith("RESULT ")]
    assert line, p.stdout[-2000:] + p.stderr[-4000:]
    r = json.loads(line[0][7:])
    n = r["orders"]
    assert r["write"] == [1, n] and r["read"] == n and r["distinct"] == n
    assert r["incremental"] == n and r["incremental_read"] == n
    assert r["ytd"] == 1183
