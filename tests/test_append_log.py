"""The tables beside silver: what a batch reads, and that they agree with silver after lost runs."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from estatelake.operators import marts as M
from estatelake.plans.pipeline import Layout, run_gold, run_silver
from estatelake.session import delete, list_names, replace_text
from estatelake.sources.files import read_mart, read_silver
from estatelake.sources.listings import as_bronze
from estatelake.streaming.append_log import KEY_HASH, AppendLog
from estatelake.streaming.incremental import append_new, claim, only_new, with_key_hash
from tests.helpers import plan_text

REC = ("price double, area double, rooms int, floor int, total_floors int, district string, "
       "address string, building_type string, published_at string")


def bronze(spark, rows):
    """rows: (price, district, published_at)"""
    return as_bronze(spark.createDataFrame([(p, 2.0, int(p) % 4 if math.isfinite(p) else 1, 1, 9, d, "a", "b", t) for p, d, t in rows], REC))


def day(n):
    return f"2024-{1 + n % 12:02d}-{1 + n % 28:02d} 10:00:00"


def keys_of(df):
    return sorted(tuple(r) for r in df.select(*KEY_HASH).collect())


def agrees(spark, path):
    """Key table, silver's own hashes and the merged marts all stand for the same rows."""
    log = AppendLog(spark, path)
    silver = log.rows()
    assert keys_of(log.keys().distinct()) == keys_of(silver)
    full = canon(M.marts_aggregate(read_silver(spark, path)))
    assert canon(M.merge_partials(log.partials())) == full


def canon(df):
    return sorted((str(r.asDict()) for r in df.select(*sorted(df.columns)).collect()))


def prices(spark, path):
    return sorted(r["price"] for r in read_silver(spark, path).collect())


def test_a_batch_reads_the_key_table_only(spark, scratch):
    path = scratch("key_table")
    append_new(bronze(spark, [(float(i), f"d{i % 9}", day(i)) for i in range(200)]), path, key_buckets=4)
    batch = with_key_hash(bronze(spark, [(float(i), f"d{i % 9}", day(i)) for i in range(190, 220)]))
    batch.write.parquet(f"{path}_batch")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = only_new(spark.read.parquet(f"{path}_batch"), AppendLog(spark, path).keys())
        plan = plan_text(new, "formatted")
        assert new.count() == 20
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Bucketed: true" in plan and "SelectedBucketsCount: 4 out of 4" in plan
    assert plan.count("Exchange (") == 1  # the batch is shuffled, the key table is not
    assert "district=" not in plan and plan.count("Location: InMemoryFileIndex") == 2  # the batch and the key files
    assert "ReadSchema: struct<key_hash_1:bigint,key_hash_2:bigint>" in plan


def test_what_is_read_does_not_follow_districts_and_dates(spark, scratch):
    """Silvers of as many rows over 2 and over 60 districts and dates: key tables of the same files and about the same bytes."""
    sizes = []
    for n in (2, 60):
        path = scratch(f"reach_{n}")
        append_new(bronze(spark, [(float(i), f"d{i % n}", day(i % n)) for i in range(600)]), path, key_buckets=4)
        files = AppendLog(spark, path).keys().inputFiles()
        sizes.append((len(files), sum(len(open(f.removeprefix("file:"), "rb").read()) for f in files)))
    assert sizes[0][0] == sizes[1][0] == 4 and abs(sizes[0][1] - sizes[1][1]) < 0.1 * sizes[0][1]


def test_key_table_is_made_from_a_silver_without_one(spark, scratch):
    path = scratch("bootstrap")
    append_new(bronze(spark, [(1.0, "A", day(1)), (2.0, None, "n/a")]), path, against_silver=False)
    assert AppendLog(spark, path)._current_keys() is None
    append_new(bronze(spark, [(2.0, None, "n/a"), (3.0, "A", day(1))]), path)
    assert prices(spark, path) == [1.0, 2.0, 3.0]
    agrees(spark, path)


class Lost(RuntimeError):
    pass


@pytest.mark.parametrize("mode", ["keyed", "state"])
@pytest.mark.parametrize("step", ["before write", "half written", "written", "partials", "keys", "told"])
def test_lost_appends(spark, scratch, monkeypatch, mode, step):
    """A run that dies at any step of an append, and its replay: every key once, and all tables agree."""
    path = scratch("lost")
    keyed = mode == "keyed"
    first = [(float(i), f"d{i % 3}", day(i)) for i in range(12)]
    second = [(float(i), f"d{i % 3}", day(i)) for i in range(8 if keyed else 12, 24)]
    options = {"against_silver": keyed, "unique": not keyed}
    append_new(bronze(spark, first), path, name="q-0", **options)
    AppendLog(spark, path).partials()

    def dies(*_args, **_kwargs):
        raise Lost

    from estatelake.streaming import incremental

    with monkeypatch.context() as patch:
        if step == "before write":
            patch.setattr(incremental, "append_partitioned", dies)
        elif step in ("half written", "written"):
            patch.setattr(AppendLog, "_tell", dies)
        elif step == "partials":
            patch.setattr(AppendLog, "_write_partial", dies)
        elif step == "keys":
            patch.setattr(AppendLog, "_add_keys", dies)
        else:
            note = AppendLog._note
            patch.setattr(AppendLog, "_note", lambda self, b, a, done: dies() if done else note(self, b, a, done))
        if keyed or step != "keys":
            with pytest.raises(Lost):
                append_new(bronze(spark, second), path, name="q-1", **options)
    if step == "half written":  # the commit of the write came as far as one district
        attempt = AppendLog(spark, path)._last()["attempts"][-1]
        for file in AppendLog(spark, path).rows(attempt).select(F.input_file_name()).distinct().collect():
            if "district=d0" not in file[0]:
                delete(spark, file[0])
    append_new(bronze(spark, second), path, name="q-1", **options)
    assert prices(spark, path) == [float(i) for i in range(24)]
    append_new(bronze(spark, second), path, name="q-1", **options)  # and played once more
    assert prices(spark, path) == [float(i) for i in range(24)]
    if keyed:
        agrees(spark, path)
    else:
        assert canon(M.merge_partials(AppendLog(spark, path).partials())) == canon(M.marts_aggregate(read_silver(spark, path)))


def test_merge_equals_recompute(spark, scratch, monkeypatch):
    """Marts merged over several runs, with Infinity and NaN, equal those made from silver; many folders are added up."""
    from estatelake.streaming import append_log

    monkeypatch.setattr(append_log, "PARTIAL_FOLDERS", 2)
    layout = Layout(scratch("merge"))
    odd = [float("inf"), 1e13, 0.1, 0.2, 0.3, -5.0]
    for run in range(5):
        rows = [(x, ["A", "B", None, ""][i % 4], ["n/a", day(i), day(run)][i % 3]) for i, x in enumerate([*odd, 100.0 + run, 7e20 + run])]
        append_new(bronze(spark, rows), layout.silver)
        if run == 3:  # a NaN in a derived column
            append_new(as_bronze(spark.createDataFrame([(float("inf"), float("inf"), 2, 1, 9, "B", "nan", "b", day(3))], REC)), layout.silver)
        merged = run_gold(spark, layout, mode="merge")
        got = {n: canon(read_mart(spark, layout.gold, n)) for n in M.build_marts(read_silver(spark, layout.silver))}
        full = run_gold(spark, layout)
        assert merged == full
        assert got == {n: canon(read_mart(spark, layout.gold, n)) for n in got}
    assert len(list_names(spark, AppendLog(spark, layout.silver).partial_root)) <= 3


def test_merge_reads_no_silver(spark, scratch):
    path = scratch("merge_plan")
    append_new(bronze(spark, [(1.0, "A", day(1))]), path)
    AppendLog(spark, path).partials()
    append_new(bronze(spark, [(2.0, "A", day(1))]), path)
    plan = plan_text(M.merge_partials(AppendLog(spark, path).partials()), "formatted")
    assert "_partials" in plan and "district=" not in plan


def test_keys_are_compacted(spark, scratch):
    path = scratch("compact_keys")
    for run in range(6):
        append_new(bronze(spark, [(float(10 * run + i), "A", day(i)) for i in range(10)]), path, key_buckets=2)
    log = AppendLog(spark, path)
    before, keys = len(log.keys().inputFiles()), keys_of(log.keys())
    assert before > 2 * 3 and not log.compact_keys(files_per_bucket=50)
    assert log.compact_keys(files_per_bucket=2)
    assert len(AppendLog(spark, path).keys().inputFiles()) <= 2 and keys_of(AppendLog(spark, path).keys()) == keys
    append_new(bronze(spark, [(5.0, "A", day(5)), (99.0, "A", day(5))]), path)
    agrees(spark, path)


def test_of_two_first_starts_one_wins(spark, scratch):
    path = scratch("claims")
    assert replace_text(spark, f"{path}/_written_by", "state", overwrite=False)
    assert not replace_text(spark, f"{path}/_written_by", "keyed", overwrite=False)
    with pytest.raises(ValueError, match="another folder"):
        claim(spark, path, "stream")
    claim(spark, path, "state")
    assert list_names(spark, path) == ["._written_by.crc", "_written_by"] or "_written_by" in list_names(spark, path)


@pytest.mark.parametrize("mode", ["stream", "new_only"])
def test_streams_leave_agreeing_tables(spark, scratch, mode):
    layout = Layout(scratch("stream_log"))
    for run in range(2):
        bronze(spark, [(float(i), f"d{i % 3}", day(i)) for i in range(10 * run, 10 * run + 15)]).write.mode("append").parquet(layout.bronze)
        run_silver(spark, layout, mode)
    assert prices(spark, layout.silver) == [float(i) for i in range(25)]
    agrees(spark, layout.silver)
