"""Marts change together: a run that dies between two of them leaves all old ones readable."""

from __future__ import annotations

import pytest

from estatelake.plans.pipeline import Layout, run_gold
from estatelake.schemas import MART_TABLES
from estatelake.session import list_names
from estatelake.sinks import versions
from estatelake.sinks.jdbc import JdbcMarts
from estatelake.sinks.parquet import MartStore
from estatelake.sources.files import read_jdbc, read_mart
from estatelake.streaming.incremental import append_new
from tests.test_append_log import bronze, canon, day


class Lost(RuntimeError):
    pass


def grown(spark, layout, run):
    append_new(bronze(spark, [(float(10 * run + i), "AB"[i % 2], day(i)) for i in range(6)]), layout.silver)


@pytest.mark.parametrize("step", ["first write", "second write", "show"])
def test_a_lost_run_leaves_the_old_marts(spark, scratch, monkeypatch, step):
    layout = Layout(scratch("flip"))
    grown(spark, layout, 0)
    run_gold(spark, layout)
    old = {n: canon(read_mart(spark, layout.gold, n)) for n in MART_TABLES}
    reading = read_mart(spark, layout.gold, "mart_listings_by_day")  # a reader that has started
    grown(spark, layout, 1)
    write, written = MartStore.write, []

    def lose(self, name, mart):
        if len(written) == (0 if step == "first write" else 1):
            raise Lost
        written.append(name)
        write(self, name, mart)

    with monkeypatch.context() as patch:
        patch.setattr(MartStore, "write" if "write" in step else "show", lose if "write" in step else lambda self: (_ for _ in ()).throw(Lost))
        with pytest.raises(Lost):
            run_gold(spark, layout)
    assert {n: canon(read_mart(spark, layout.gold, n)) for n in MART_TABLES} == old
    run_gold(spark, layout)
    new = {n: canon(read_mart(spark, layout.gold, n)) for n in MART_TABLES}
    assert all(new[n] != old[n] for n in MART_TABLES)
    assert canon(reading) == old["mart_listings_by_day"]  # its version is kept for one more flip
    run_gold(spark, layout)
    run_gold(spark, layout)
    assert sum(n.startswith(versions.PREFIX) for n in list_names(spark, layout.gold)) == 2


def test_no_marts_yet(spark, scratch):
    with pytest.raises(ValueError, match="no marts"):
        read_mart(spark, scratch("none"), "mart_listings_by_day")


def test_jdbc_marts_are_swapped_in_one_transaction(spark, scratch, monkeypatch):
    """Embedded Derby in memory: a run that dies before or within the swap leaves the old tables."""
    url, props = "jdbc:derby:memory:estatelake_flip;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    layout = Layout(scratch("flip_jdbc"))
    grown(spark, layout, 0)
    run_gold(spark, layout, url, props)

    def stored():
        return {n: canon(read_jdbc(spark, url, n, props)) for n in MART_TABLES}

    old = stored()
    grown(spark, layout, 1)
    with monkeypatch.context() as patch:
        patch.setattr(JdbcMarts, "show", lambda self: (_ for _ in ()).throw(Lost))
        with pytest.raises(Lost):
            run_gold(spark, layout, url, props)
    assert stored() == old
    with monkeypatch.context() as patch:  # a table to rename is missing: the swap fails after the first two
        show = JdbcMarts.show
        patch.setattr(JdbcMarts, "show", lambda self: (self.tables.append("mart_that_was_not_written"), show(self)))
        with pytest.raises(Exception, match="(?i)mart_that_was_not_written"):
            run_gold(spark, layout, url, props)
    assert stored() == old
    run_gold(spark, layout, url, props)
    assert all(stored()[n] != old[n] for n in MART_TABLES)
