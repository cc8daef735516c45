"""The scheduled steps through the command line, one after the other."""

from __future__ import annotations

from estatelake import cli
from estatelake.operators import messages
from estatelake.plans.catalog import silver as silver_of
from estatelake.sources.listings import listings
from tests.conftest import SF_SMALL


def test_steps_in_order_then_sql(spark, scratch):
    root = scratch("cli")
    inbox = f"{root}/inbox"
    messages.encode(listings(spark, SF_SMALL)).write.mode("append").text(inbox)
    cli.main(["bronze", "--root", root, "--inbox", inbox], spark)
    cli.main(["silver", "--root", root], spark)
    gold = cli.main(["gold", "--root", root], spark)
    assert gold["silver_rows"] == silver_of(spark, SF_SMALL).count()
    res = cli.main(["sql", "--root", root,
                    "SELECT rooms, listing_count FROM mart_avg_price_by_rooms ORDER BY rooms;"], spark)
    assert res["total_rows"] == 6 and res["columns"] == ["rooms", "listing_count"] and [r[0] for r in res["rows"]] == [1, 2, 3, 4, 5, 6]
    flats = cli.main(["sql", "--root", root, "SELECT district, avg(price) FROM silver_listings WHERE rooms = 2 GROUP BY district"], spark)
    assert flats["total_rows"] == 26
    merged = cli.main(["gold", "--root", root, "--gold-mode", "merge"], spark)
    assert {k: v for k, v in merged.items() if k != "step"} == {k: v for k, v in gold.items() if k != "step"}
    bad = cli.main(["sql", "--root", root, "DROP TABLE mart_avg_price_by_rooms"], spark)
    assert "error" in bad
    late = cli.main(["sql", "--root", root, "SELECT raise_error('late') FROM mart_avg_price_by_rooms"], spark)
    assert "late" in late["error"]


def test_reappend_step_reports_counts(spark, scratch):
    root = scratch("cli_reappend")
    inbox = f"{root}/inbox"
    messages.encode(listings(spark, SF_SMALL)).write.mode("append").text(inbox)
    cli.main(["bronze", "--root", root, "--inbox", inbox], spark)
    out = cli.main(["silver", "--root", root, "--silver-mode", "reappend"], spark)
    assert out["bronze_rows"] == listings(spark, SF_SMALL).count()
    assert out["silver_appended"] == silver_of(spark, SF_SMALL).count()


def test_feed_step_draws_anew(spark, scratch):
    from estatelake.schemas import LISTING

    root = scratch("cli_feed")
    rows = [(float(i), 1.0, 1, 1, 1, "A", f"a{i}", "b", "2024-01-01 00:00:00") for i in range(2000)]
    spark.createDataFrame(rows, LISTING).select(*reversed(LISTING.names)).write.option("header", "true").csv(f"{root}/csv")
    sent = []
    for run in (1, 2):
        cli.main(["feed", "--csv", f"{root}/csv", "--inbox", f"{root}/inbox{run}", "--fraction", "0.1"], spark)
        sent.append({r["value"] for r in spark.read.text(f"{root}/inbox{run}").selectExpr(
            "get_json_object(value, '$.address') AS value").collect()})
        assert 120 < len(sent[-1]) < 290
    assert sent[0] != sent[1]


def test_settings_come_from_arguments():
    args = cli._parser().parse_args(["run", "--root", "/r", "--input-bytes", str(2**40), "--cores", "100",
                                     "--s3-endpoint", "http://s:9000", "--s3-access-key", "k", "--s3-secret-key", "s"])
    conf = cli._conf(args)
    assert conf["spark.sql.shuffle.partitions"] == "4096"
    assert conf["spark.hadoop.fs.s3a.endpoint"] == "http://s:9000"
    assert "RocksDB" in conf["spark.sql.streaming.stateStore.providerClass"]
