"""Failures: retried tasks give the same rows; a replayed micro-batch does not duplicate silver."""

from __future__ import annotations

import json
import os
import subprocess
import sys

from estatelake.sources.files import read_bronze, read_silver
from estatelake.sources.messages import file_messages
from estatelake.streaming.incremental import append_new
from estatelake.streaming.ingest import run_bronze
from tests.conftest import SF_SMALL
from tests.test_streaming import land, message

HERE = os.path.dirname(os.path.abspath(__file__))


def test_task_retries_give_identical_results():
    """Own process with ``local[2,4]``: the first attempt of tasks after the join fails."""
    out = subprocess.run(
        [sys.executable, os.path.join(HERE, "scripts", "retry_run.py"), SF_SMALL],
        capture_output=True, text=True, timeout=900,
    )
    assert out.returncode == 0, out.stderr[-2000:]
    assert "injected task failure" in out.stderr  # failures did happen
    line = next(ln for ln in out.stdout.splitlines() if ln.startswith("RESULT "))
    result = json.loads(line[len("RESULT "):])
    assert result.pop("silver_rows") > 0
    assert all(result.values()), result


def test_replayed_batch_is_absorbed(spark, scratch):
    """foreachBatch is at-least-once: a batch replayed after its files were committed adds nothing."""
    root = scratch("replay")
    inbox, bronze, silver = f"{root}/inbox", f"{root}/bronze", f"{root}/silver"
    land(spark, inbox, [message("A", 1.0), message("B", 2.0), message("B", 2.0), message(None, 3.0)])
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    batch = read_bronze(spark, bronze)
    append_new(batch, silver)
    first = sorted(map(tuple, read_silver(spark, silver).select("district", "price").collect()), key=str)
    append_new(batch, silver)  # same batch again, as after a crash before the offset commit
    again = sorted(map(tuple, read_silver(spark, silver).select("district", "price").collect()), key=str)
    assert first == again and len(first) == 3
