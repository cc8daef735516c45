"""What silver keeps beside its rows: a key table, partial mart aggregates and the record of its last append.

All of it lies in folders of silver whose names start with an underscore, which readers of silver skip.

*Key table.*  The key hashes of all rows (16 bytes each), bucketed by hash.  The check of a batch for known keys is a
join bucket to bucket: the key side is neither shuffled nor sorted anew by files of silver, and no
file of any district is opened, however many districts and dates silver has.

*Partials.*  The sums and counts of the marts, one folder per append, so that the marts are merged from them
without a scan of silver.  Kept from the first merge on.

*Appends.*  Rows carry the id of their append.  The record says before an append that it is under way, and after
it that the key table and the partials have its rows too.  An append found under way is completed
first: the rows of it that silver shows are what it wrote, whole or in part, and their keys and partials are written
(again).  A batch that is played again adds what its earlier attempts did not.
The rows of an append are made once, in a hidden folder of Parquet files that goes when the append is done.
One writer at a time, as for any checkpoint.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.operators.marts import add_partials, marts_partial
from estatelake.schemas import SILVER, ddl
from estatelake.session import delete, list_names, make_folder, read_text, replace_text
from estatelake.sinks import versions
from estatelake.sinks.compaction import compact, silver_rows

KEY_HASH = ["key_hash_1", "key_hash_2"]
APPEND_ID = "append_id"
STORED = ", ".join([ddl(SILVER), *[f"{k} long" for k in KEY_HASH], f"{APPEND_ID} string"])  # silver's files with what readers skip
MOST_BUCKETS = 4096  # a key table of 10^11 keys has 400 MB a bucket then
STAGED = "_appends"  # the folder beside silver's districts for the rows of an append under way
PARTIAL_FOLDERS = 32  # appends whose partials are kept apart; more are added up at the next merge


def columns_of_silver() -> list[str]:
    return [f.name for f in SILVER.fields]


def default_buckets(spark: SparkSession) -> int:
    """Buckets of a new key table: enough to keep all cores busy in a join, but an append writes up to a file for each."""
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return max(1, min(partitions, 4 * spark.sparkContext.defaultParallelism, MOST_BUCKETS))


class AppendLog:
    """The side tables of one silver folder."""

    def __init__(self, spark: SparkSession, silver_path: str, buckets: int | None = None):
        """``buckets`` of the key table: fixed when it is made (default: ``default_buckets`` of that session)."""
        self.spark, self.path, self._buckets = spark, silver_path, buckets
        self.key_root, self.partial_root = f"{silver_path}/_keys", f"{silver_path}/_partials"

    # ---- rows of silver ------------------------------------------------------------

    def has_rows(self) -> bool:
        """Whether silver has any data files (folders of districts)."""
        return any(not name.startswith(("_", ".")) for name in list_names(self.spark, self.path))

    def rows(self, *attempts: str) -> DataFrame:
        """Rows of silver with their key hashes: all, or those of some appends (a filter pushed to the scan)."""
        if not self.has_rows():
            return self.spark.createDataFrame([], STORED)
        rows = silver_rows(self.spark, self.path, STORED)
        return rows.where(F.col(APPEND_ID).isin(*attempts)) if attempts else rows

    def compact(self, max_files: int = 8) -> int:
        """Rewrite the districts, and the key table, that have more than ``max_files`` files each, or per bucket."""
        replaced = compact(self.spark, self.path, STORED, max_files) if self.has_rows() else 0
        self.compact_keys(max_files)
        return replaced

    # ---- key table -----------------------------------------------------------------

    def _key_table(self, folder: str) -> tuple[str, int]:
        """Name and buckets of the session's table over a version of the key files."""
        buckets = int(folder.rsplit("/", 1)[1].split("-")[1])
        name = f"estatelake_keys_{hashlib.md5(folder.encode()).hexdigest()}"
        keys, place = ", ".join(KEY_HASH), folder.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({', '.join(f'{k} BIGINT' for k in KEY_HASH)}) USING parquet "
            f"CLUSTERED BY ({keys}) INTO {buckets} BUCKETS LOCATION '{place}'"
        )
        return name, buckets

    def _add_keys(self, folder: str, rows: DataFrame) -> None:
        name, _ = self._key_table(folder)
        rows.select(*KEY_HASH).hint("rebalance", *KEY_HASH).write.insertInto(name)

    def _current_keys(self) -> str | None:
        return versions.current(self.spark, self.key_root)

    def _made_keys(self, keys: DataFrame | None, buckets: int) -> str:
        """Make ``keys`` (none: an empty one) the key table, in a fresh version."""
        folder = versions.fresh(self.key_root, str(buckets))
        if keys is None:
            make_folder(self.spark, folder)
        else:
            self._add_keys(folder, keys)
        versions.flip(self.spark, self.key_root, folder)
        return folder

    def keys(self) -> DataFrame:
        """The keys that silver holds; the table is made from silver's files where there is none yet."""
        folder = self._current_keys()
        if folder is None:
            buckets = self._buckets or default_buckets(self.spark)
            folder = self._made_keys(self.rows() if self.has_rows() else None, buckets)
        name, _ = self._key_table(folder)
        self.spark.catalog.refreshTable(name)
        return self.spark.table(name)

    def has_keys(self) -> bool:
        """Whether there is any key to check a batch against; the key table is made if there is none yet."""
        if self._current_keys() is None:
            self.keys()
        return any(name.endswith(".parquet") for name in list_names(self.spark, self._current_keys()))

    def compact_keys(self, files_per_bucket: int = 8) -> bool:
        """Write the key table anew, one file per bucket, if it has more than ``files_per_bucket`` on the average."""
        folder = self._current_keys()
        if folder is None:
            return False
        _, buckets = self._key_table(folder)
        files = sum(name.endswith(".parquet") for name in list_names(self.spark, folder))
        if files <= files_per_bucket * buckets:
            return False
        self._made_keys(self.keys().distinct(), buckets)
        return True

    # ---- partials ------------------------------------------------------------------

    def _write_partial(self, folder: str, name: str, partial: DataFrame) -> None:
        partial.coalesce(1).write.mode("overwrite").parquet(f"{folder}/append={name}")  # one row per group

    def partials(self) -> DataFrame:
        """The partials of all appends; made from all of silver the first time, added up when there are many."""
        self.settle()
        folder = versions.current(self.spark, self.partial_root)
        parts = [] if folder is None else [n for n in list_names(self.spark, folder) if n.startswith("append=")]
        if folder is None or len(parts) > PARTIAL_FOLDERS:
            made = versions.fresh(self.partial_root)
            whole = marts_partial(self.rows()) if folder is None else add_partials(self.spark.read.parquet(folder).drop("append"))
            self._write_partial(made, "before", whole)
            versions.flip(self.spark, self.partial_root, made)
            folder = made
        return self.spark.read.parquet(folder).drop("append")

    # ---- appends -------------------------------------------------------------------

    def _last(self) -> dict | None:
        said = read_text(self.spark, f"{self.path}/_last_append")
        return json.loads(said) if said else None

    def _note(self, batch: str | None, attempts: Sequence[str], done: bool) -> None:
        replace_text(self.spark, f"{self.path}/_last_append", json.dumps({"batch": batch, "attempts": list(attempts), "done": done}))

    def keeps(self) -> bool:
        """Whether anything beside silver has to be told of new rows."""
        return any(versions.current(self.spark, root) is not None for root in (self.key_root, self.partial_root))

    def _tell(self, attempt: str, rows: DataFrame, again: bool = False) -> None:
        keys, partials = self._current_keys(), versions.current(self.spark, self.partial_root)
        if partials is not None:
            self._write_partial(partials, attempt, marts_partial(rows))
        if keys is not None:
            self._add_keys(keys, rows.join(self.keys(), KEY_HASH, "left_anti") if again else rows)

    def settle(self, batch: str | None = None) -> list[str]:
        """Complete a lost append; returns the attempts that were made at ``batch``."""
        last = self._last()
        if last is None:
            return []
        if not last["done"]:
            attempt = last["attempts"][-1]
            self._tell(attempt, self.rows(attempt), again=True)
            self._note(last["batch"], last["attempts"], True)
        return last["attempts"] if batch is not None and last["batch"] == batch else []

    def append(self, rows: DataFrame, write, batch: str | None = None, attempts: Sequence[str] = ()) -> None:
        """Append ``rows`` (silver columns and key hashes) by ``write``, and tell the side tables."""
        attempt = uuid.uuid4().hex
        self._drop_staged()
        staged = f"{self.path}/{STAGED}/{attempt}"
        rows.withColumn(APPEND_ID, F.lit(attempt)).write.option("compression", "zstd").parquet(staged)
        # Silver, keys and partials must have the same rows, also if an executor is lost in between.
        rows = self.spark.read.schema(STORED).parquet(staged)
        self._note(batch, [*attempts, attempt], False)
        write(rows)
        self._tell(attempt, rows)
        self._note(batch, [*attempts, attempt], True)
        self._drop_staged()

    def _drop_staged(self) -> None:
        """Delete the staged rows of this append, and of those that were lost."""
        delete(self.spark, f"{self.path}/{STAGED}")
