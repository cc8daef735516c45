"""URL filter: prefix rules first, then logistic regression on hashed character n-grams of host and path.

The labelled URL table is the distinct pairs of host and path that a rule decides, at most ``LABELLED`` of each
verdict, those with the smallest hashes; a pair that many rows repeat is learned once.  Features are the distinct character
``GRAM``-grams of ``host + path`` (each marked with its part), hashed into ``BUCKETS`` slots by Spark's ``HashingTF``.
All of it is DataFrame work inside the JVM; no Python runs on the executors.

Defined results: a null URL or one without ``://`` has an empty host and path, fits no
rule and is scored by its end marks alone; without labelled URLs every score is 0.5,
with one verdict only the score is that verdict's; a score of 0.5 or more is ``block``;
repeated rows each get their own result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from estatelake.llm.shared import cut_lineage, lower_ascii

# The rules (host and path prefix) and their verdicts.
RULES = {
    "com/": "allow",
    "example.com/en/": "block",
    "www.example.com/en/": "allow",
    "net/es/": "block",
    "net/fr/": "block",
}

GRAM = 4
BUCKETS = 1 << 14
LABELLED = 4000  # bound of the labelled table, rows per verdict


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for a null URL or one without ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), r"^[^?#]*", 0)
    return lower_ascii(host), path


def matching_rule(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest rule that fits, else null."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):  # the longest is tried last and wins
        name, slash, prefix = rule.partition("/")
        fits = ((host == name) | F.endswith(host, F.lit("." + name))) & F.startswith(path, F.lit(slash + prefix))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of a URL, host and path apart, with marked ends."""

    def cut(text: Column, part: str) -> Column:
        count = F.greatest(F.length(text) - (GRAM - 1), F.lit(0))
        at = F.slice(F.sequence(F.lit(1), F.greatest(count, F.lit(1))), F.lit(1), count)
        return F.transform(at, lambda i: F.concat(F.lit(part), F.substring(text, i, F.lit(GRAM))))

    ends = lambda text: F.concat(F.lit("^"), text, F.lit("$"))
    return F.concat(cut(ends(host), "h"), cut(ends(path), "p"))


def labelled_urls(pages: DataFrame, per_verdict: int) -> DataFrame:
    """A bounded table of rule-decided URLs: ``host, path`` and ``label`` (1 for block)."""
    order = F.xxhash64("host", "path").alias("order")
    distinct = lambda verdict: pages.where(F.col("verdict") == verdict).select("host", "path", "verdict").distinct()
    picked = [
        distinct(verdict).select("host", "path", "verdict", order).orderBy("order", "host", "path").limit(per_verdict)
        for verdict in ("allow", "block")
    ]
    label = (F.col("verdict") == "block").cast("double")
    return picked[0].unionByName(picked[1]).select("host", "path", label.alias("label"))


def scored(urls: DataFrame, labelled: DataFrame) -> DataFrame:
    """``urls`` with ``score``, the probability of block by the model fitted on ``labelled``."""
    labelled = cut_lineage(labelled)
    seen = sorted(r["label"] for r in labelled.select("label").distinct().collect())
    if len(seen) < 2:  # nothing to separate
        return urls.withColumn("score", F.lit(seen[0] if seen else 0.5))
    hashed = HashingTF(numFeatures=BUCKETS, binary=True, inputCol="grams", outputCol="features")
    featured = lambda df: hashed.transform(df.withColumn("grams", grams(F.col("host"), F.col("path"))))
    model = LogisticRegression(maxIter=40, regParam=0.001, standardization=False).fit(
        featured(labelled).select("label", "features")
    )
    # The training summary holds the session, which does not travel to executors.
    model._java_obj.setSummary(urls.sparkSession._jvm.scala.Option.apply(None))
    return model.transform(featured(urls)).select(*urls.columns, vector_to_array("probability")[1].alias("score"))


def filter_urls(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    rules: Mapping[str, str] = RULES,
    labelled: int = LABELLED,
) -> DataFrame:
    """Per row: ``id, host, path, rule, verdict, score`` (the model's probability of block)."""
    host, path = host_and_path(F.col(url_col))
    parts = pages.select(F.col(id_col).alias("id"), host.alias("host"), path.alias("path"))
    parts = parts.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules))
    decided = F.lit(None).cast("string")
    for rule, verdict in rules.items():
        decided = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(decided)
    parts = parts.withColumn("verdict", decided)
    return scored(parts, labelled_urls(parts, labelled)).select(
        "id",
        "host",
        "path",
        "rule",
        F.coalesce("verdict", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"),
        "score",
    )
