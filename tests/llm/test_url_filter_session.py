from __future__ import annotations

from pyspark.sql import Observation
from pyspark.sql import functions as F

from estatelake.llm.url_filter import filter_urls


def test_after_observations(spark):
    """A session that has observed something cannot be serialized; the model must not hold it."""
    seen = Observation("seen")
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get["n"] == 3
    rows = [(i, f"http://h{i}.com/a") for i in range(9)] + [(10 + i, f"http://h{i}.net/es/b") for i in range(9)]
    assert filter_urls(spark.createDataFrame(rows, "page_id long, url string")).count() == 18
    assert len(filter_urls(spark.createDataFrame(rows, "page_id long, url string")).collect()) == 18
