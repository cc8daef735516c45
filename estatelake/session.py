"""Session construction and shared scratch locations."""

from __future__ import annotations

import contextlib
import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

# Settings the library relies on.  UTC keeps ``to_date`` and the ISO stamp stable;
# ANSI stays on (the default in Spark 4), every fallible expression uses a ``try_`` form.
DEFAULT_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    # Checkpoint files go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app_name: str = "estatelake",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Build (or reuse) a session with the library defaults.

    On a cluster, pass ``master=None`` and let ``spark-submit`` decide; size
    ``shuffle_partitions`` to the data (AQE coalesces the small ones away).
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def shared_root(spark: SparkSession) -> str:
    """Root of the shared folder the cluster names in ``spark.checkpoint.dir``.

    The setting is read from the session.  Only when it is unset and the master
    is local (tests, a laptop) a folder under the system temp dir is chosen and
    registered as the checkpoint dir; on a cluster an unset value is an error,
    because a machine-local folder is not visible to other executors.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext.getCheckpointDir()
    if not root:
        master = spark.sparkContext.master
        if not master.startswith("local"):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; point it at a shared folder (HDFS, S3, ...)"
            )
        root = os.path.join(os.environ.get("TMPDIR", "/tmp"), "estatelake-checkpoints")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


# Scratch folders handed out in this process and not yet deleted.
_scratch: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder below the shared root for one run of ``name``.

    Results that are read lazily may live there, so nothing is deleted on its
    own: call ``clean_scratch`` when the results have been used.
    """
    path = f"{shared_root(spark)}/estatelake/{name}-{uuid.uuid4().hex}"
    _scratch.append(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists in the file system it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(at.getFileSystem(spark._jsc.hadoopConfiguration()).exists(at))


def delete(spark: SparkSession, path: str) -> None:
    """Delete a folder, if it exists, in the file system it names."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make a folder, and those above it, unless it exists."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(at)


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the files and folders in a folder; none if it does not exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().getName() for s in fs.listStatus(at)) if fs.exists(at) else []


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file, or ``None`` if it does not exist."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(at):
        return None
    source = fs.open(at)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(source)).decode()
    finally:
        source.close()


def replace_text(spark: SparkSession, path: str, text: str, overwrite: bool = True) -> bool:
    """Put a small file in place whole, by a rename; without ``overwrite``, return whether it was not there before."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(path)
    draft = jvm.org.apache.hadoop.fs.Path(at.getParent(), f"_draft-{uuid.uuid4().hex}")
    fs = at.getFileSystem(conf)
    out = fs.create(draft, True)
    try:
        out.write(text.encode())
    finally:
        out.close()
    kind = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    how = spark.sparkContext._gateway.new_array(kind, 1)
    how[0] = kind.OVERWRITE if overwrite else kind.NONE
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), conf).rename(draft, at, how)
    except Py4JJavaError as exc:
        fs.delete(draft, False)
        if not overwrite and fs.exists(at):
            return False
        raise exc
    return True


def clean_scratch(spark: SparkSession) -> None:
    """Delete the scratch folders that this process has made."""
    while _scratch:
        delete(spark, _scratch.pop())


# Applications that have been given the package.
_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give executors this package, for functions that run there in Python (as ``--py-files`` would)."""
    if spark.sparkContext.applicationId in _shipped:
        return
    here = Path(__file__).resolve().parent
    made = Path(tempfile.mkdtemp(prefix="estatelake-package-")) / "estatelake.zip"
    with zipfile.ZipFile(made, "w") as out:
        for source in sorted(here.rglob("*.py")):
            out.write(source, source.relative_to(here.parent))
    spark.sparkContext.addPyFile(str(made))
    _shipped.add(spark.sparkContext.applicationId)


# Bytes of files that one task reads where it sorts or adds up their rows: bronze and silver hold few bytes a row
# (dictionaries), so that a task over Spark's default of 128 MB may have tens of millions of rows to sort.
SPLIT_BYTES = 16 * 1024 * 1024
SPLITS_PER_CORE = 4  # at least, for files of enough bytes: the last round of tasks leaves few cores idle


@contextlib.contextmanager
def changed_conf(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """While open, the session has these settings; those before are put back at the end."""
    before = {name: spark.conf.get(name, None) for name in values}
    try:
        for name, value in values.items():
            spark.conf.set(name, value)
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


@contextlib.contextmanager
def fine_splits(spark: SparkSession) -> Iterator[None]:
    """While open, files are read in splits of ``SPLIT_BYTES`` at most (or the session's, if smaller), ``SPLITS_PER_CORE`` or more.

    The session's settings are put back at the end.  Which rows are read does not change.
    """
    most, fewest = "spark.sql.files.maxPartitionBytes", "spark.sql.files.minPartitionNum"
    limit = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(most))
    parts = max(SPLITS_PER_CORE * spark.sparkContext.defaultParallelism, int(spark.conf.get(fewest, None) or 0))
    with changed_conf(spark, {most: str(min(limit, SPLIT_BYTES)), fewest: str(parts)}):
        yield


@contextlib.contextmanager
def lean_shuffles(spark: SparkSession) -> Iterator[None]:
    """While open, the shuffle files of a job go when it ends, not when the driver's garbage collector finds them unused.

    A step that reads a shuffle again later (a cached block was dropped) has it made again by a stage retry.
    """
    with changed_conf(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"}):
        yield


def object_store_conf(
    endpoint: str,
    access_key: str,
    secret_key: str,
    path_style: bool = True,
    ssl: bool = False,
) -> dict[str, str]:
    """Settings for an S3-compatible object store through S3A (``s3a://`` paths).

    Credentials are arguments, never read from the environment here; the
    ``hadoop-aws`` package must be on the cluster's classpath.
    """
    return {
        "spark.hadoop.fs.s3a.endpoint": endpoint,
        "spark.hadoop.fs.s3a.access.key": access_key,
        "spark.hadoop.fs.s3a.secret.key": secret_key,
        "spark.hadoop.fs.s3a.path.style.access": str(path_style).lower(),
        "spark.hadoop.fs.s3a.impl": "org.apache.hadoop.fs.s3a.S3AFileSystem",
        "spark.hadoop.fs.s3a.connection.ssl.enabled": str(ssl).lower(),
    }


def scale_conf(
    input_bytes: int,
    total_cores: int,
    target_partition_bytes: int = 256 * 1024 * 1024,
) -> dict[str, str]:
    """Partition sizing for a run over ``input_bytes`` on ``total_cores`` cores.

    Shuffle partitions are sized so that each holds about
    ``target_partition_bytes`` before AQE coalesces the small ones (never fewer
    than twice the cores); scan splits use the same size; AQE splits skewed
    join partitions above five times the median.  Streaming state (the seen
    keys of the state-store silver) lives in RocksDB instead of the JVM heap.
    """
    target = int(target_partition_bytes)
    shuffle = max(2 * total_cores, -(-int(input_bytes) // target))
    return {
        "spark.sql.shuffle.partitions": str(shuffle),
        "spark.sql.files.maxPartitionBytes": str(target),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
