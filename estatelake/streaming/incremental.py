"""Silver that adds only new listings.

The reference re-reads all of bronze and appends the whole refined result on
every run, so silver grows by D1 + D2 + ... (kept here as ``mode="reappend"``).
The default follows the stated aim instead: bronze is read as a stream, each
micro-batch is refined and only keys that silver does not hold yet are
appended.

A listing's key is its raw dedup key, before dates are parsed and blanks become
NULL.  Silver's files carry 128 bits of its hash in two columns beside the silver columns
(``KEY_HASH``; readers with the declared schema do not see them), so what counts
as one listing does not depend on how bronze is cut into batches.  A batch is checked
against the key table beside silver (``append_log``), never against silver itself.

Each silver folder belongs to one way of writing (``claim``): a run that would mix
two of them in a folder is refused.

Retries: ``foreachBatch`` is at-least-once.  A replayed batch adds only what its earlier
attempts did not, whether they were lost before, in or after the write (``append_log``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from estatelake.operators.refine import deduplicate, derive, drop_incomplete, key_hash, normalize_types
from estatelake.schemas import BRONZE, CRITICAL, DEDUP_KEY, ddl
from estatelake.session import changed_conf, delete, fine_splits, lean_shuffles, list_names, make_folder, read_text, replace_text
from estatelake.sinks.parquet import append_partitioned
from estatelake.sources.files import read_bronze
from estatelake.streaming.append_log import KEY_HASH, AppendLog, columns_of_silver

# The ways of writing silver and the modes that share one: both anti-join modes hold each key once.
WRITERS = {"stream": "keyed", "new_only": "keyed", "state": "state", "reappend": "reappend"}


# What a listing is grouped by: the hash of its key, and the numbers in it, so that filters on them move below the dedup.
UNIQUE = [*KEY_HASH, *CRITICAL]


def claim(spark: SparkSession, silver_path: str, mode: str) -> None:
    """Mark a silver folder as written by ``mode``'s way of writing; raise if it belongs to another.

    The mark is put in place whole and only once, so of two first starts one wins.
    """
    if mode not in WRITERS:
        raise ValueError(f"unknown silver mode: {mode}")
    mark = f"{silver_path}/_written_by"
    owner = read_text(spark, mark)
    if owner is None and not replace_text(spark, mark, WRITERS[mode], overwrite=False):
        owner = read_text(spark, mark)
    if owner not in (None, WRITERS[mode]):
        raise ValueError(f"{silver_path} is written by mode(s) "
                         f"{', '.join(m for m, w in WRITERS.items() if w == owner)}; use another folder for {mode!r}")


def with_key_hash(rows: DataFrame, key: Sequence[str] = DEDUP_KEY) -> DataFrame:
    """``rows`` with the hash of the raw key: NULL differs from '', signed zeros are one."""
    return rows.withColumns({name: key_hash(rows, key, name) for name in KEY_HASH})


def only_new(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """Rows whose key hash ``keys`` does not hold (an anti join, bucket to bucket where ``keys`` is the key table)."""
    return rows.join(keys.select(*KEY_HASH), KEY_HASH, "left_anti")


def _count(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _observed(seen: Observation) -> int:
    """The rows counted; a plan that Spark finds to be empty while it runs counts none and has no result row."""
    row = seen._jo.getRow()
    return int(row.getLong(0)) if row.length() else 0


def append_new(
    batch: DataFrame,
    silver_path: str,
    order_by: Sequence[str] | None = None,
    report: dict[str, int] | None = None,
    against_silver: bool = True,
    unique: bool = False,
    name: str | None = None,
    key_buckets: int | None = None,
) -> None:
    """Refine bronze rows and append them to silver, with ``against_silver`` only those with new keys.

    ``unique`` says that no key repeats within ``batch``.  ``name`` tells a batch that is played again
    from a new one.  ``key_buckets``: of the key table, when it is made.

    ``report`` receives the rows read, left by the dedup, left by the null filter, and
    appended (added to what it holds); the counts are observed in the same job.  Without
    it, Catalyst moves the null filter below the dedup shuffle.
    """
    log = AppendLog(batch.sparkSession, silver_path, key_buckets)
    attempts = log.settle(name)
    raw = with_key_hash(batch)
    counts: dict[str, Observation] = {}

    def counted(df: DataFrame, name: str) -> DataFrame:
        if report is None:
            return df
        df, counts[name] = _count(df, name)
        return df

    rows = counted(raw, "bronze_rows")
    if not unique:
        rows = deduplicate(rows, UNIQUE, order_by or ())
    rows = counted(drop_incomplete(counted(rows, "dedup_rows")), "valid_rows")
    rows = derive(normalize_types(rows)).select(*columns_of_silver(), *KEY_HASH)
    if against_silver:
        rows = only_new(rows, log.keys()) if log.has_keys() else rows
    elif attempts and name is not None:
        rows = only_new(rows, log.rows(*attempts))
    log.append(counted(rows, "silver_appended"), lambda df: append_partitioned(df, silver_path), name, attempts)
    for stage, seen in counts.items():
        report[stage] = report.get(stage, 0) + _observed(seen)


def batch_name(batch: DataFrame, batch_id: int) -> str | None:
    """A name of a micro-batch that it has again when it is replayed: the query's id, kept in its checkpoint, and its number."""
    query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
    return f"{query}-{batch_id}" if query else None


def start_incremental_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    order_by: Sequence[str] | None = None,
    max_files_per_trigger: int | None = None,
    report: dict[str, int] | None = None,
) -> StreamingQuery:
    """Stream bronze → silver, adding only new keys (``availableNow`` run)."""
    claim(spark, silver_path, "stream")
    stream = _bronze_stream(spark, bronze_path, max_files_per_trigger)
    return (
        stream.writeStream.foreachBatch(
            lambda df, batch_id: append_new(df, silver_path, order_by, report, name=batch_name(df, batch_id))
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _bronze_stream(spark: SparkSession, bronze_path: str, max_files_per_trigger: int | None) -> DataFrame:
    reader = spark.readStream.schema(BRONZE)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return reader.parquet(bronze_path)


def run_incremental_silver(spark: SparkSession, *args, **kwargs) -> StreamingQuery:
    """``start_incremental_silver`` to its end, with bronze in splits that a task can sort."""
    with fine_splits(spark), lean_shuffles(spark):
        query = start_incremental_silver(spark, *args, **kwargs)
        query.awaitTermination()
    return query


def state_store(spark: SparkSession) -> dict[str, str]:
    """RocksDB for the seen keys, unless the session names a state store: the default one holds all keys in the heap.

    A checkpoint keeps the store that it was begun with.
    """
    name = "spark.sql.streaming.stateStore.providerClass"
    rocks = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    return {} if spark.conf.get(name, None) else {name: rocks}


def thin(batch: DataFrame) -> DataFrame:
    """Bronze rows that can reach silver, the smallest one of each key, with the key hash.

    A batch aggregate, so it has a partial one before the shuffle: a listing that a third of the
    rows repeat leaves each task as one row.
    """
    return deduplicate(with_key_hash(drop_incomplete(batch)), UNIQUE, ())


def start_state_silver(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    checkpoint: str,
    max_files_per_trigger: int | None = None,
    report: dict[str, int] | None = None,
) -> StreamingQuery:
    """Stream bronze → silver with the seen keys kept in the streaming state store.

    Two queries follow each other.  The first has no state: it thins each micro-batch of bronze to one
    row per key (``thin``) and writes it to a folder below its checkpoint.  The second, which is returned, has
    one state operator: streaming dedup on the key hash, which remembers every key it has emitted
    (16 bytes of hash each, partitioned by key, checkpointed next to the offsets).  So a micro-batch is checked
    against its own keys only, and a hot key reaches its state partition as one row per micro-batch of
    bronze.  Rows that can never reach silver (NULL/NaN price or area) are dropped before the state,
    which keeps the same key set as the batch order dedup → filter.  The survivor among
    duplicates is arbitrary.  For large state use the RocksDB state store (``scale_conf`` and ``run_state_silver`` set it).

    A replayed micro-batch of the first query overwrites its own folder; one of the second adds what its earlier
    attempts did not.  Thinned rows go when the second query has taken them.  The number of state
    partitions is the session's ``spark.sql.shuffle.partitions`` when the query first starts; Spark keeps it
    in the checkpoint, so size it for the cluster the query will run on.
    """
    claim(spark, silver_path, "state")
    thinned = f"{checkpoint}/thinned"
    make_folder(spark, thinned)

    def write_thin(batch: DataFrame, batch_id: int) -> None:
        seen = None
        if report is not None:
            batch, seen = _count(batch, "bronze_rows")
        thin(batch).write.mode("overwrite").parquet(f"{thinned}/batch-{batch_id}")
        if seen is not None:
            report["bronze_rows"] = report.get("bronze_rows", 0) + _observed(seen)

    bronze = _bronze_stream(spark, bronze_path, max_files_per_trigger)
    first = bronze.writeStream.foreachBatch(write_thin).option("checkpointLocation", f"{checkpoint}/thin")
    first.trigger(availableNow=True).start().awaitTermination()

    def append(batch: DataFrame, batch_id: int) -> None:
        counts: dict[str, int] | None = None if report is None else {}
        append_new(batch.drop(*KEY_HASH), silver_path, report=counts, against_silver=False, unique=True, name=batch_name(batch, batch_id))
        for stage, n in (counts or {}).items():
            if stage != "bronze_rows":
                report[stage] = report.get(stage, 0) + n

    reader = spark.readStream.schema(f"{ddl(BRONZE)}, {', '.join(f'{k} long' for k in KEY_HASH)}").option("recursiveFileLookup", "true")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    second = reader.parquet(thinned).dropDuplicates(KEY_HASH).writeStream.foreachBatch(append)
    return second.option("checkpointLocation", f"{checkpoint}/state").trigger(availableNow=True).start()


def run_state_silver(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str, **kwargs) -> StreamingQuery:
    """``start_state_silver`` to its end; what was thinned is taken then, and deleted."""
    with fine_splits(spark), lean_shuffles(spark), changed_conf(spark, state_store(spark)):
        query = start_state_silver(spark, bronze_path, silver_path, checkpoint, **kwargs)
        query.awaitTermination()
    for name in list_names(spark, f"{checkpoint}/thinned"):
        delete(spark, f"{checkpoint}/thinned/{name}")
    return query


def refine_batch(
    spark: SparkSession,
    bronze_path: str,
    silver_path: str,
    mode: str = "new_only",
    order_by: Sequence[str] | None = None,
    report: dict[str, int] | None = None,
) -> int:
    """Batch silver over all of bronze; returns the number of rows appended.

    ``mode="new_only"`` appends keys silver does not hold (same result as the
    streaming path); ``mode="reappend"`` appends the whole refined bronze on every
    run, as the reference does.  The counts are observed while
    writing, so the write is the only job over the data.
    """
    if mode not in ("new_only", "reappend"):
        raise ValueError(f"unknown silver mode: {mode}")
    claim(spark, silver_path, mode)
    counts: dict[str, int] = {} if report is None else report
    before = counts.get("silver_appended", 0)
    with lean_shuffles(spark):
        append_new(read_bronze(spark, bronze_path), silver_path, order_by, counts, against_silver=mode == "new_only")
    return counts["silver_appended"] - before
