import json
import subprocess
import sys
from pathlib import Path


def test_failed_tasks_leave_whole_batches():
    """Tasks that fail half-way and run again lose no row and store none twice."""
    script = Path(__file__).with_name("flaky_job.py")
    done = subprocess.run(
        [sys.executable, str(script)], capture_output=True, text=True, timeout=300
    )
    assert done.returncode == 0, done.stderr[-3000:]
    assert json.loads(done.stdout.splitlines()[-1]) == [5000] * 5
