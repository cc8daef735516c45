"""What the stages leave on disk: packed text, no checkpoints, no shuffle files of jobs that have ended."""

from __future__ import annotations

import os
import time

import pytest

from estatelake.plans import catalog
from estatelake.session import exists, list_names, shared_root
from estatelake.sinks import messages as sink
from estatelake.sources.files import read_silver
from estatelake.streaming import incremental
from estatelake.streaming.append_log import AppendLog
from tests.test_append_log import bronze, day, prices
from tests.test_deliver import tables


def files(spark, root):
    """Paths of the data files below a folder."""
    return [os.path.join(at, f) for at, _, names in os.walk(root) for f in names if not f.startswith((".", "_"))]


def shuffles(spark):
    """Shuffles that have files."""
    found = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = [found.apply(i).getName() for i in range(found.length())]
    return {n.split("_")[1] for n in names if n.startswith("shuffle_")}


def at_most(spark, before, n):
    for _ in range(60):  # files are deleted beside the jobs
        if len(shuffles(spark) - before) <= n:
            return True
        time.sleep(0.5)
    return False


def checkpoints(spark):
    root = spark.sparkContext.getCheckpointDir() or shared_root(spark)
    return {os.path.join(at, d) for at, dirs, _ in os.walk(root.removeprefix("file:")) for d in dirs if d.startswith("rdd-")}


def scratch_of(monkeypatch, scratch):
    made = []
    monkeypatch.setattr(catalog, "scratch_path", lambda _spark, name: made.append(scratch(name)) or made[-1])
    return made


def test_messages_are_packed_in_bounded_files(spark, scratch):
    path = scratch("packed")
    lines = ['{"price": %d, "address": "Ä street", "district": null}' % i for i in range(2000)]
    sent = spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1)
    sink.write_messages(sent, "text", path, options={"maxRecordsPerFile": "600"})
    held = files(spark, path)
    assert len(held) == 4 and all(f.endswith(".lz4") for f in held)
    assert sum(os.path.getsize(f) for f in held) < sum(map(len, lines)) / 3
    assert sorted(r["value"] for r in spark.read.text(path).collect()) == sorted(lines)
    assert int(sink.TEXT_FILES["maxRecordsPerFile"]) <= 1_000_000


@pytest.mark.parametrize("name", ["gold_merged", "gold_end_to_end", "silver_incremental", "silver_incremental_state"])
def test_a_query_keeps_its_steps_and_nothing_else(spark, scratch, monkeypatch, name):
    made, kept, held = scratch_of(monkeypatch, scratch), checkpoints(spark), shuffles(spark)
    assert catalog.QUERIES[name](spark, tables(spark, scratch)).collect()
    assert checkpoints(spark) == kept
    inbox = files(spark, f"{made[0]}/inbox")
    assert inbox and all(f.endswith(".lz4") for f in inbox)
    places = list_names(spark, f"{made[0]}/silver") + list_names(spark, f"{made[0]}/silver/listings")
    assert any(n.startswith("district=") for n in places) and not "_appends" in places
    marts = 2 if name.startswith("gold") else 0  # a run's marts are held in memory, over a shuffle of one row per group
    assert at_most(spark, held, marts)


def test_csv_and_inbox_of_the_feed_are_packed(spark, scratch, monkeypatch):
    made = scratch_of(monkeypatch, scratch)
    assert catalog.q_feed_messages(spark, tables(spark, scratch)).count() > 0
    for part in ("csv", "inbox"):
        held = files(spark, f"{made[0]}/{part}")
        assert held and all(f.endswith(".lz4") for f in held)


@pytest.mark.parametrize("against_silver", [True, False])
def test_rows_of_a_lost_append_go_with_the_next(spark, scratch, monkeypatch, against_silver):
    path = scratch("lost_rows")

    def dies(*_args, **_kwargs):
        raise RuntimeError

    with monkeypatch.context() as patch:
        patch.setattr(incremental, "append_partitioned", dies)
        with pytest.raises(RuntimeError):
            incremental.append_new(bronze(spark, [(1.0, "A", day(1))]), path, against_silver=against_silver, name="q-0")
    staged = list_names(spark, f"{path}/_appends")
    assert staged and not AppendLog(spark, path).has_rows()
    incremental.append_new(bronze(spark, [(1.0, "A", day(1)), (2.0, None, "")]), path, against_silver=against_silver, name="q-0")
    assert prices(spark, path) == [1.0, 2.0] and read_silver(spark, path).where("district IS NULL").count() == 1
    assert not exists(spark, f"{path}/_appends")


def test_seen_keys_lie_in_rocksdb_unless_the_session_says_otherwise(spark, scratch):
    at, name = scratch("store"), "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    try:
        for kind, own in (("rocks", None), ("heap", "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider")):
            spark.conf.unset(name) if own is None else spark.conf.set(name, own)
            root = f"{at}/{kind}"
            for run in range(2):
                bronze(spark, [(float(i), f"d{i % 3}", day(i)) for i in range(10 * run, 10 * run + 15)]).write.mode("append").parquet(f"{root}/bronze")
                incremental.run_state_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ck")
                assert spark.conf.get(name, None) == own
            assert prices(spark, f"{root}/silver") == [float(i) for i in range(25)]
            kinds = {f.rsplit(".", 1)[1] for f in files(spark, f"{root}/ck/state/state/0") if "." in os.path.basename(f)}
            assert ("zip" in kinds) == (own is None) and ("delta" in kinds) == (own is not None)
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)
