"""The feed's data steps as one Spark job: CSV → sample → JSON messages → sink.

Pacing (a sleep between messages), progress logging and broker connection
retries belong to a simulator and are not rebuilt; Spark's Kafka sink retries
failed sends with the task.
"""

from __future__ import annotations

import logging
import random
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from estatelake.operators.messages import encode
from estatelake.operators.sample import bernoulli_sample, exact_sample
from estatelake.schemas import LISTING
from estatelake.session import fine_splits
from estatelake.sinks.messages import write_messages
from estatelake.sources.files import read_csv

log = logging.getLogger(__name__)

# Fixed value: share of the listing table sent per run.
SAMPLE_FRACTION = 0.1


def sample_messages(
    listings: DataFrame,
    fraction: float = SAMPLE_FRACTION,
    seed: int | None = None,
    exact_key: Sequence[str] | None = None,
) -> DataFrame:
    """A random share of the listings as JSON messages (NaN → null, ISO send stamp).

    Without a ``seed`` each call draws anew; the seed drawn is logged, so that a run can be repeated.

    With ``exact_key`` the sample holds exactly ``round(n * fraction)`` rows
    (``key`` must be unique); without it, it is a Bernoulli sample.
    """
    if seed is None:
        seed = random.SystemRandom().getrandbits(63)
        log.info("sample seed %d", seed)
    if exact_key:
        picked = exact_sample(listings, fraction, exact_key, seed)
    else:
        picked = bernoulli_sample(listings, fraction, seed)
    return encode(picked)


def publish_from_csv(
    spark: SparkSession,
    csv_path: str,
    schema: StructType | str = LISTING,
    fraction: float = SAMPLE_FRACTION,
    seed: int | None = None,
    exact_key: Sequence[str] | None = None,
    multiline: bool = False,
    **sink,
) -> None:
    """Read the listing CSV with its schema, sample it and publish the messages."""
    msgs = sample_messages(read_csv(spark, csv_path, schema, multiline=multiline), fraction, seed, exact_key)
    with fine_splits(spark):
        write_messages(msgs, **sink)
