"""Task failures: results after retries equal the clean results (separate process, since
a session that allows task retries needs its own master setting)."""

import os
import subprocess
import sys

from tests.conftest import SF001

SCRIPT = os.path.join(os.path.dirname(__file__), "scripts", "retry_run.py")


def test_retried_tasks_give_the_same_results(tmp_dir):
    out = subprocess.run([sys.executable, SCRIPT, SF001, tmp_dir], capture_output=True, text=True, timeout=600)
    assert out.returncode == 0, out.stderr[-2000:]
    assert out.stdout.strip().startswith("OK"), out.stdout + out.stderr[-2000:]
    assert len(os.listdir(tmp_dir)) > 0          # failures were really injected and retried
