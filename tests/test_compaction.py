"""Compaction of silver: few files, the same rows, and nothing lost or doubled by a crash on the way."""

from __future__ import annotations

import pytest

from estatelake import cli
from estatelake.session import delete, exists, list_names
from estatelake.sinks import compaction as C
from estatelake.sources.files import read_silver
from estatelake.streaming.append_log import STORED, AppendLog
from estatelake.streaming.incremental import append_new
from tests.test_append_log import agrees, bronze, canon, day, prices
from tests.test_marts_together import Lost

DISTRICTS = ["A", "a b/c#d%20{x}", None]


def grown(spark, path, runs, start=0):
    for run in range(start, start + runs):
        append_new(bronze(spark, [(float(3 * run + i), d, day(run)) for i, d in enumerate(DISTRICTS)]), path, key_buckets=2)


def files(spark, path):
    return {d: len(f) for d, f in C.files_of(spark, path, STORED).items()}


def test_file_count_stays_bounded_over_runs(spark, scratch):
    root = scratch("compaction")
    path, runs, most = f"{root}/silver/listings", 20, 4
    for run in range(runs):
        grown(spark, path, 1, run)
        if run % 4 == 3:
            cli.main(["compact", "--root", root, "--max-files", str(most)], spark)
        assert max(files(spark, path).values()) <= most + 4, run
    assert prices(spark, path) == [float(i) for i in range(3 * runs)]
    assert {r["district"] for r in read_silver(spark, path).select("district").collect()} == set(DISTRICTS)
    agrees(spark, path)
    assert not [n for n in list_names(spark, path) if n.startswith("_staged")]
    assert AppendLog(spark, path).compact(most) == 0 or max(files(spark, path).values()) <= most


@pytest.mark.parametrize("step", ["staging", "note", "first move", "moves", "first delete", "deletes", "done"])
def test_a_crash_on_the_way(spark, scratch, monkeypatch, step):
    """At every step readers see each row once, an append may follow, and the next compaction completes the lost one."""
    path = scratch("compaction_lost")
    grown(spark, path, 4)
    before = canon(AppendLog(spark, path).rows())
    calls = {"delete": 0, "move": 0}

    def dying(name, at, true):
        def call(*args):
            calls[name] += 1
            if calls[name] == at:
                raise Lost
            return true(*args)
        return call

    with monkeypatch.context() as patch:
        if step == "staging":
            patch.setattr(C, "replace_text", lambda *_: (_ for _ in ()).throw(Lost))
        elif step == "note":
            patch.setattr(C, "finish", lambda *_: (_ for _ in ()).throw(Lost) if exists(spark, f"{path}/{C.NOTE}") else None)
        elif step in ("first move", "moves"):
            patch.setattr(C, "make_folder", dying("move", 2 if step == "first move" else 3, C.make_folder))
        elif step in ("first delete", "deletes"):
            patch.setattr(C, "delete", dying("delete", 2 if step == "first delete" else 7, C.delete))
        else:
            patch.setattr(C, "replace_text", lambda s, p, t: (_ for _ in ()).throw(Lost) if p.endswith(C.DONE) else replace(s, p, t))
        replace = __import__("estatelake.session", fromlist=["replace_text"]).replace_text
        with pytest.raises(Lost):
            C.compact(spark, path, STORED, 2)
    assert canon(AppendLog(spark, path).rows()) == before
    assert prices(spark, path) == [float(i) for i in range(12)]
    append_new(bronze(spark, [(5.0, DISTRICTS[2], day(1)), (99.0, "A", day(9))]), path)  # 5.0 is known already
    assert prices(spark, path) == sorted([99.0, *[float(i) for i in range(12)]])
    AppendLog(spark, path).compact(2)
    assert prices(spark, path) == sorted([99.0, *[float(i) for i in range(12)]]) and max(files(spark, path).values()) <= 2
    assert not exists(spark, f"{path}/{C.NOTE}")
    agrees(spark, path)


def test_a_running_append_is_left_alone(spark, scratch, monkeypatch):
    """Files that an append adds while a compaction writes are not on its note."""
    path = scratch("compaction_beside")
    grown(spark, path, 4)
    true = C.replace_text

    def meanwhile(session, at, text):
        if at.endswith(C.NOTE):
            grown(spark, path, 1, 4)
        return true(session, at, text)

    with monkeypatch.context() as patch:
        patch.setattr(C, "replace_text", meanwhile)
        assert C.compact(spark, path, STORED, 2) == 12
    assert prices(spark, path) == [float(i) for i in range(15)]
    agrees(spark, path)


def test_nothing_to_do(spark, scratch):
    path = scratch("compaction_none")
    assert AppendLog(spark, path).compact() == 0
    grown(spark, path, 1)
    assert AppendLog(spark, path).compact() == 0 and prices(spark, path) == [0.0, 1.0, 2.0]
    delete(spark, path)
