"""Feed data steps: CSV → exact sample → messages → inbox → bronze."""

from __future__ import annotations

from estatelake.plans.feed import publish_from_csv
from estatelake.session import object_store_conf, scale_conf
from estatelake.sources.files import read_bronze
from estatelake.sources.listings import listings
from estatelake.sources.messages import file_messages
from estatelake.streaming.ingest import run_bronze
from tests.conftest import SF_SMALL

CSV_SCHEMA = (
    "price double, area double, rooms int, floor int, total_floors int, district string, "
    "address string, building_type string, published_at string, src_id long, src_line int, copy_no int"
)


def test_publish_exact_sample_and_ingest(spark, scratch):
    root = scratch("producer")
    recs = listings(spark, SF_SMALL).where("copy_no = 0")
    n = recs.count()
    recs.write.option("header", "true").csv(f"{root}/raw")
    publish_from_csv(spark, f"{root}/raw", CSV_SCHEMA, fraction=0.1, seed=5,
                     exact_key=["src_id", "src_line"], fmt="text", path=f"{root}/inbox")
    run_bronze(file_messages(spark, f"{root}/inbox"), f"{root}/bronze", f"{root}/_ck")
    assert read_bronze(spark, f"{root}/bronze").count() == round(n * 0.1)


def test_conf_helpers():
    c = object_store_conf("http://store:9000", "k", "s")
    assert c["spark.hadoop.fs.s3a.path.style.access"] == "true"
    s = scale_conf(100 * 2**40, 8000)
    assert int(s["spark.sql.shuffle.partitions"]) == 409600
    assert int(scale_conf(1, 8)["spark.sql.shuffle.partitions"]) == 16
