"""End-to-end run: messages from the adapter → bronze → silver → gold, twice."""

from __future__ import annotations

import pytest

from estatelake.operators import messages
from estatelake.plans.catalog import silver as silver_of
from estatelake.plans.pipeline import Layout, run_pipeline
from estatelake.sources.files import read_mart, read_silver
from estatelake.sources.listings import listings
from estatelake.sources.messages import file_messages
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("mode", ["stream", "state"])
def test_pipeline_twice(spark, scratch, mode):
    root = scratch("pipeline")
    layout = Layout(root)
    inbox = f"{root}/inbox"
    messages.encode(listings(spark, SF_SMALL)).write.mode("append").text(inbox)

    first = run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode=mode)
    expected = silver_of(spark, SF_SMALL).count()
    assert first["silver_rows"] == expected
    assert first["mart_avg_price_by_district"] == 26
    assert read_silver(spark, layout.silver).count() == expected

    assert first["bronze_rows"] == listings(spark, SF_SMALL).count()
    assert first["valid_rows"] == first["silver_appended"] == expected
    if mode == "stream":
        assert first["bronze_rows"] > first["dedup_rows"] > first["valid_rows"]

    # no new messages: silver unchanged, marts overwritten (one copy)
    second = run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode=mode)
    assert {k: v for k, v in second.items() if k.startswith("mart")} == {k: v for k, v in first.items() if k.startswith("mart")}
    assert second["silver_rows"] == expected and second["silver_appended"] == 0
    mart = read_mart(spark, layout.gold, "mart_avg_price_by_district")
    assert mart.count() == 26
    assert len(mart.inputFiles()) == 1  # a small mart is merged into one file
    assert sum(r["listing_count"] for r in mart.collect()) == expected


def test_pipeline_reappend_mode(spark, scratch):
    root = scratch("pipeline_reappend")
    layout = Layout(root)
    inbox = f"{root}/inbox"
    messages.encode(listings(spark, SF_SMALL)).write.mode("append").text(inbox)
    a = run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode="reappend")
    b = run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode="reappend")
    assert b["silver_rows"] == 2 * a["silver_rows"] == 2 * a["silver_appended"]


def test_lenient_ints_reach_bronze(spark, scratch):
    layout = Layout(scratch("lenient"))
    line = ('{"price":1.0,"area":2.0,"rooms":2.0,"floor":1,"total_floors":9,"district":"A","address":"x",'
            '"building_type":"b","published_at":"2024-01-01 00:00:00","current_timestamp":"t"}')
    spark.createDataFrame([(line,)], "value string").write.text(f"{layout.root}/inbox")
    run_pipeline(spark, file_messages(spark, f"{layout.root}/inbox"), layout, lenient_ints=True)
    assert read_silver(spark, layout.silver).first()["rooms"] == 2


@pytest.mark.parametrize("first,second", [("state", "new_only"), ("stream", "state"), ("reappend", "stream")])
def test_a_folder_belongs_to_one_way_of_writing(spark, scratch, first, second):
    layout = Layout(scratch("modes"))
    inbox = f"{layout.root}/inbox"
    messages.encode(listings(spark, SF_SMALL)).write.mode("append").text(inbox)
    run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode=first)
    with pytest.raises(ValueError, match="another folder"):
        run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode=second)


def test_stream_and_new_only_share_a_folder(spark, scratch):
    layout = Layout(scratch("shared"))
    inbox = f"{layout.root}/inbox"
    messages.encode(listings(spark, SF_SMALL)).write.mode("append").text(inbox)
    a = run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode="stream")
    b = run_pipeline(spark, file_messages(spark, inbox), layout, silver_mode="new_only")
    assert b["silver_appended"] == 0 and b["silver_rows"] == a["silver_rows"]
