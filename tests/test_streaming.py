"""Checkpointed runs: bronze drains and resumes; silver adds only new keys."""

from __future__ import annotations

import json

import pytest

from estatelake.sources.files import read_bronze, read_silver
from estatelake.sources.messages import file_messages, read_messages
from estatelake.streaming.incremental import refine_batch, run_incremental_silver
from estatelake.streaming.ingest import run_bronze


def message(district, price, address="x", area=50.0, published="2024-01-01 00:00:00"):
    return json.dumps({
        "price": price, "area": area, "rooms": 2, "floor": 1, "total_floors": 9,
        "district": district, "address": address, "building_type": "b",
        "published_at": published, "current_timestamp": "2024-01-01T00:00:00.000000+00:00",
    })


def land(spark, inbox, lines):
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1) \
        .write.mode("append").text(inbox)


def test_bronze_two_runs_resume(spark, scratch):
    root = scratch("stream_two_runs")
    inbox, out, ck = f"{root}/inbox", f"{root}/bronze", f"{root}/_ck"
    land(spark, inbox, [message("A", 1.0), "junk"])
    run_bronze(file_messages(spark, inbox), out, ck)
    assert read_bronze(spark, out).count() == 2  # the junk line is kept as a NULL row
    run_bronze(file_messages(spark, inbox), out, ck)  # nothing new
    assert read_bronze(spark, out).count() == 2
    land(spark, inbox, [message("B", 2.0)])
    run_bronze(file_messages(spark, inbox), out, ck)
    rows = read_bronze(spark, out).collect()
    assert len(rows) == 3
    assert sorted(r["district"] for r in rows if r["district"]) == ["A", "B"]
    assert all(r["kafka_timestamp"] is not None and r["bronze_loaded_at"] is not None for r in rows)


def test_incremental_silver_adds_only_new(spark, scratch):
    root = scratch("incremental_two_runs")
    inbox, bronze, silver = f"{root}/inbox", f"{root}/bronze", f"{root}/silver"
    land(spark, inbox, [message("A", 1.0), message("A", 1.0), message(None, 2.0), message("B", None)])
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    run_incremental_silver(spark, bronze, silver, f"{root}/_ck_s")
    assert read_silver(spark, silver).count() == 2
    land(spark, inbox, [message("A", 1.0), message("C", 5.0), message(None, 2.0)])
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    run_incremental_silver(spark, bronze, silver, f"{root}/_ck_s")
    got = sorted((r["district"] or "", r["price"]) for r in read_silver(spark, silver).collect())
    assert got == [("", 2.0), ("A", 1.0), ("C", 5.0)]


def test_incremental_equals_one_shot(spark, scratch):
    """Batch 'new_only' over two runs and a one-shot refine give the same key set."""
    root = scratch("incremental_vs_one_shot")
    inbox, bronze = f"{root}/inbox", f"{root}/bronze"
    first = [message("A", float(i), address=f"a{i % 7}") for i in range(40)]
    second = [message("A", float(i), address=f"a{i % 7}") for i in range(20, 60)] + ["junk"]
    land(spark, inbox, first)
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    refine_batch(spark, bronze, f"{root}/silver_inc", mode="new_only")
    land(spark, inbox, second)
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    appended = refine_batch(spark, bronze, f"{root}/silver_inc", mode="new_only")
    assert appended == 20
    refine_batch(spark, bronze, f"{root}/silver_one", mode="new_only")
    key = ["district", "address", "price", "area", "published_at"]
    a = sorted(map(tuple, read_silver(spark, f"{root}/silver_inc").select(*key).collect()))
    b = sorted(map(tuple, read_silver(spark, f"{root}/silver_one").select(*key).collect()))
    assert a == b and len(a) == 60


def test_reappend_mode_grows_by_d1_plus_d2(spark, scratch):
    root = scratch("reappend")
    inbox, bronze, silver = f"{root}/inbox", f"{root}/bronze", f"{root}/silver"
    land(spark, inbox, [message("A", 1.0), message("A", 1.0), message("B", 2.0)])
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    assert refine_batch(spark, bronze, silver, mode="reappend") == 2
    land(spark, inbox, [message("C", 3.0)])
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    assert refine_batch(spark, bronze, silver, mode="reappend") == 3
    assert read_silver(spark, silver).count() == 5


def test_source_dispatch(spark, scratch):
    root = scratch("dispatch")
    land(spark, f"{root}/inbox", [message("A", 1.0)])
    df = read_messages(spark, "text", path=f"{root}/inbox", max_files_per_trigger=1)
    assert df.isStreaming and df.columns == ["value", "timestamp"]
    # The Kafka connector is not on this classpath: the source fails at planning,
    # before any connection is attempted.
    with pytest.raises(Exception, match="(?i)kafka"):
        read_messages(spark, "kafka", bootstrap_servers="localhost:9092", topic="t")


def test_state_store_silver_adds_only_new(spark, scratch):
    from estatelake.streaming.incremental import run_state_silver

    root = scratch("state_two_runs")
    inbox, bronze, silver = f"{root}/inbox", f"{root}/bronze", f"{root}/silver"
    land(spark, inbox, [message("A", 1.0), message("A", 1.0), message(None, 2.0), message("B", None), "junk"])
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    run_state_silver(spark, bronze, silver, f"{root}/_ck_s")
    assert read_silver(spark, silver).count() == 2
    run_state_silver(spark, bronze, silver, f"{root}/_ck_s")  # nothing new: no second copy
    assert read_silver(spark, silver).count() == 2
    land(spark, inbox, [message("A", 1.0), message("C", 5.0), message(None, 2.0)])
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    q = run_state_silver(spark, bronze, silver, f"{root}/_ck_s")
    got = sorted((r["district"] or "", r["price"]) for r in read_silver(spark, silver).collect())
    assert got == [("", 2.0), ("A", 1.0), ("C", 5.0)]
    # one state operator, which holds every key seen so far; the batch only added the new one
    (state,) = q.lastProgress["stateOperators"]
    assert state["numRowsTotal"] == 3 and state["numRowsUpdated"] == 1


def test_state_store_silver_merges_signed_zero(spark, scratch):
    from estatelake.streaming.incremental import run_state_silver

    root = scratch("state_signed_zero")
    inbox, bronze, silver = f"{root}/inbox", f"{root}/bronze", f"{root}/silver"
    land(spark, inbox, [message("A", 0.0), message("A", -0.0), message("B", 1.0, area=-0.0),
                        message("B", 1.0, area=0.0)])
    run_bronze(file_messages(spark, inbox), bronze, f"{root}/_ck_b")
    run_state_silver(spark, bronze, silver, f"{root}/_ck_s")
    rows = read_silver(spark, silver).collect()
    assert len(rows) == 2
    assert all(str(r["price"]) != "-0.0" and str(r["area"]) != "-0.0" for r in rows)


# Spellings of unknown dates, blanks and sentinel dates, each with the run that sends it.
HARD = [("n/a", "A", 1), ("unknown", "A", 2), ("", "A", 1), ("n/a", "", 2), ("n/a", None, 1), ("n/a", "", 1),
        ("9999-12-31 23:59:59", "A", 2), ("0001-01-01 00:00:00", "A", 2), ("9999-12-31 23:59:59", "B", 1),
        ("0001-01-01 00:00:00", "A", 1), ("2024-01-01 00:00:00", "A", 1), ("2024-01-01 00:00:00", "A", 2),
        ("2024-1-1 0:0:0", "A", 2)]


@pytest.mark.parametrize("mode", ["stream", "state", "new_only", "one_shot"])
def test_silver_does_not_depend_on_batches(spark, scratch, mode):
    from estatelake.plans.pipeline import Layout, run_silver

    layout = Layout(scratch(f"hard_{mode}"))
    for run in (1, 2):
        land(spark, f"{layout.root}/inbox", [message(d, 1.0, published=t) for t, d, r in HARD if r == run])
        run_bronze(file_messages(spark, f"{layout.root}/inbox"), layout.bronze, layout.checkpoint("bronze"))
        if mode != "one_shot" or run == 2:
            run_silver(spark, layout, "new_only" if mode == "one_shot" else mode)
    got = sorted((str(r["published_at"]), r["district"] or "-") for r in
                 read_silver(spark, layout.silver).selectExpr("string(published_at) AS published_at", "district").collect())
    known = {"2024-01-01 00:00:00", "9999-12-31 23:59:59", "0001-01-01 00:00:00"}
    want = sorted((t if t in known else "None", d or "-") for t, d in {(t, d) for t, d, _ in HARD})
    assert got == want


@pytest.mark.parametrize("method", ["anti_join", "state"])
def test_backlog_in_bounded_batches_dedups_across_batches(spark, scratch, method):
    """A backlog of three files drained one file per micro-batch; copies span the files."""
    from estatelake.streaming.incremental import run_state_silver

    root = scratch(f"bounded_{method}")
    inbox, bronze, silver = f"{root}/inbox", f"{root}/bronze", f"{root}/silver"
    for part in range(3):
        land(spark, inbox, [message("A", float(i)) for i in range(part, part + 5)])
    q = run_bronze(file_messages(spark, inbox, max_files_per_trigger=1), bronze, f"{root}/_ck_b")
    assert read_bronze(spark, bronze).count() == 15
    assert sum(p["numInputRows"] > 0 for p in q.recentProgress) == 3
    if method == "state":
        run_state_silver(spark, bronze, silver, f"{root}/_ck_s", max_files_per_trigger=1)
    else:
        run_incremental_silver(spark, bronze, silver, f"{root}/_ck_s", max_files_per_trigger=1)
    prices = sorted(r["price"] for r in read_silver(spark, silver).collect())
    assert prices == [float(i) for i in range(7)]  # 0..6, each once
