"""Queries run where executors have no copy of this package: the driver alone finds it."""

import os
import subprocess
import sys

REPO = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SCRIPT = """
import sys
sys.path.insert(0, {repo!r})
import __spark_entry__ as entry
from lagline.session import build_session
spark = build_session("far", 4)
failed = []
for name, fn in entry.queries().items():
    if name.startswith("op") or name == "pipeline":
        try:
            fn(spark, "/root/testdata/sf0.001").collect()
        except Exception as e:
            failed.append(name + ": " + str(e)[-400:])
print("FAILED", failed)
"""


def test_queries_without_the_package_on_executors(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run([sys.executable, "-c", SCRIPT.format(repo=REPO)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=900)
    assert "FAILED []" in run.stdout, run.stdout[-3000:] + run.stderr[-2000:]
