"""Executors need no installed package: functions travel with their code."""

import os
import subprocess
import sys

from conftest import ROOT, SMALL

SCRIPT = """
import sys
sys.path.insert(0, {root!r})  # the driver's own path; workers do not inherit it
from tallywork.plans import catalog
from tallywork.session import get_session
spark = get_session("elsewhere", "local[2]", **{{"spark.ui.enabled": "false", "spark.sql.shuffle.partitions": "2"}})
queries = catalog.load()[0]
for name in ("ab_ttest", "ab_ztest", "simple_regression", "segment_bonferroni"):
    print(name, len(queries[name](spark, {small!r}).collect()))
"""


def test_tail_queries_from_another_folder(tmp_path):
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=ROOT, small=SMALL)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300
    )
    assert run.returncode == 0, run.stderr[-2000:]
    assert run.stdout.count("\n") >= 4
