"""Versioned folders: a table, or several that belong together, written beside the old ones and shown at once.

A root holds version folders and a small file that names the one to read.  Writers fill a fresh version
and flip the pointer last, by an atomic rename; a run that dies before leaves the old version in place.
The version before the current one is kept for readers that have started on it.
"""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

from estatelake.session import delete, list_names, read_text, replace_text

POINTER = "_current"
PREFIX = "v-"


def fresh(root: str, label: str = "") -> str:
    """A new version folder; ``label`` becomes part of its name."""
    return f"{root}/{PREFIX}{label}{'-' if label else ''}{uuid.uuid4().hex}"


def current(spark: SparkSession, root: str) -> str | None:
    """The version folder to read, or ``None`` before the first flip."""
    said = read_text(spark, f"{root}/{POINTER}")
    return f"{root}/{said.split()[0]}" if said else None


def flip(spark: SparkSession, root: str, version: str) -> None:
    """Make ``version`` the one to read; all but it and the one before are deleted."""
    said = read_text(spark, f"{root}/{POINTER}")
    names = [version.rsplit("/", 1)[1], *([said.split()[0]] if said else [])]
    replace_text(spark, f"{root}/{POINTER}", "\n".join(names))
    for name in list_names(spark, root):
        if name.startswith(PREFIX) and name not in names:
            delete(spark, f"{root}/{name}")
