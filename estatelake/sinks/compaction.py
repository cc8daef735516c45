"""Rewrites many small files of silver's districts into few.

Every run appends files to each district it touches.  ``compact`` takes the files that the crowded districts hold
when it starts, writes their rows to a hidden folder, and commits by putting a note in place whole: from then on the
rewritten files count and the old ones do not.  Then the new files are moved into their districts
and the old ones deleted; ``finish`` does so again, or first, after a run that died on the way.

Readers of this library (``silver_rows``) follow the note, so they see each row once at every step: before the note the
old files, under it the new ones wherever they are by then.  A reader that has listed files which are deleted before it
reads them fails and is repeated.  An append that runs meanwhile only adds files, which are not on the note.
Bronze is not rewritten: the file sink's own log names its files.
"""

from __future__ import annotations

import json
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from estatelake.session import delete, exists, make_folder, read_text, replace_text

NOTE = "_compaction"
DONE = "_compacted"
FILE = "_metadata.file_path"


def _plain(uri: str) -> str:
    """A file's path as the file system names it, from its address."""
    return unquote(uri)


def _in_district(path: str) -> str:
    """The folder of the district and the name of the file, which alone may be the same in several districts."""
    return "/".join(path.rsplit("/", 2)[1:])


def _bare(path: str) -> str:
    """A path without its scheme, to compare paths from different sources."""
    return "/" + path.split(":", 1)[-1].lstrip("/")


def silver_rows(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The rows of silver, each once, whether or not a compaction is under way."""
    while True:
        state = read_text(spark, f"{path}/{NOTE}"), read_text(spark, f"{path}/{DONE}")
        rows = spark.read.schema(schema)
        if state[0] is None:
            out = rows.parquet(path)
        else:
            note = json.loads(state[0])
            staged = rows.parquet(note["staged"]) if exists(spark, note["staged"]) else None
            left = set() if staged is None else set(map(_in_district, staged.inputFiles()))
            gone = note["old"] + [f for f in note["new"] if _in_district(f) in left]
            out = rows.parquet(path).where(~F.col(FILE).isin(gone))  # files are pruned by this before they are opened
            out = out if staged is None or not left else out.unionByName(staged)
        # The files are listed by now; if a compaction began or ended meanwhile, they are listed again.
        if state == (read_text(spark, f"{path}/{NOTE}"), read_text(spark, f"{path}/{DONE}")):
            return out


def files_of(spark: SparkSession, path: str, schema: str) -> dict[str | None, list[str]]:
    """The addresses of silver's files by district."""
    found: dict[str | None, list[str]] = {}
    for district, file in spark.read.schema(schema).parquet(path).select("district", FILE).distinct().collect():
        found.setdefault(district, []).append(file)
    return found


def compact(spark: SparkSession, path: str, schema: str, max_files: int = 8) -> int:
    """Rewrite the districts of more than ``max_files`` files; returns how many files were replaced."""
    finish(spark, path)
    crowded = [f for files in files_of(spark, path, schema).values() if len(files) > max_files for f in files]
    if not crowded:
        return 0
    name = uuid.uuid4().hex
    staged = f"{path}/_staged-{name}"
    rows = spark.read.schema(schema).option("basePath", path).parquet(*map(_plain, crowded))
    rows.hint("rebalance", "district").write.partitionBy("district").parquet(staged)
    fresh = spark.read.schema(schema).parquet(staged).inputFiles()
    _, _, below = _bare(crowded[0]).partition(_bare(path))
    root = crowded[0][: len(crowded[0]) - len(below)]  # the address of the folder, as the files' addresses have it
    new = [f"{root}/{_in_district(f)}" for f in fresh]
    replace_text(spark, f"{path}/{NOTE}", json.dumps({"id": name, "staged": staged, "old": crowded, "new": new}))
    finish(spark, path)
    return len(crowded)


def finish(spark: SparkSession, path: str) -> None:
    """Carry out what a committed compaction has left to do."""
    said = read_text(spark, f"{path}/{NOTE}")
    if said is None:
        return
    note = json.loads(said)
    make = spark._jvm.org.apache.hadoop.fs.Path
    for file in note["new"]:
        target = _plain(file)
        source = make(f"{note['staged']}/{_in_district(target)}")
        fs = source.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(source):
            make_folder(spark, target.rsplit("/", 1)[0])
            if not fs.rename(source, make(target)):
                raise OSError(f"{source.toString()} could not be moved to {target}")
    for file in note["old"]:
        delete(spark, _plain(file))
    replace_text(spark, f"{path}/{DONE}", note["id"])
    delete(spark, f"{path}/{NOTE}")
    delete(spark, note["staged"])
