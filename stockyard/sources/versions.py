"""Safe replacement of written tables: versioned folders and a small manifest that is switched last.

A writer puts its tables in a new folder below the root and then replaces the manifest, one small file, by a
rename.  A reader follows the manifest, so it sees either all of the old tables or all of the new
ones; a write that fails leaves the manifest, and with it the old tables, as they were.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from contextlib import contextmanager
from dataclasses import dataclass, field

from pyspark.sql import SparkSession

MANIFEST = "_current.json"
#: Versions that stay readable when a new one is published: the new one and those before it.
KEEP = 2


@dataclass
class Manifest:
    """The current tables of a root: where each lies, and what the writer noted about it."""

    tables: dict[str, str]
    rows: dict[str, int] = field(default_factory=dict)
    bytes: dict[str, dict[str, int]] = field(default_factory=dict)
    notes: dict = field(default_factory=dict)
    #: Folders of this and earlier versions that still exist, oldest first.
    folders: list[str] = field(default_factory=list)


def _hadoop(spark: SparkSession, path: str):
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    where = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, where, where.getFileSystem(conf)


def new_folder(root: str) -> str:
    return f"{root.rstrip('/')}/v-{time.time_ns()}-{uuid.uuid4().hex[:8]}"


def current(spark: SparkSession, root: str) -> Manifest | None:
    """The manifest of ``root``, or None if nothing was ever published there."""
    path = f"{root.rstrip('/')}/{MANIFEST}"
    _, _, where, fs = _hadoop(spark, path)
    if not fs.exists(where):
        return None
    stream = fs.open(where)
    try:
        return Manifest(**json.loads(bytes(stream.readAllBytes()).decode()))
    finally:
        stream.close()


def publish(spark: SparkSession, root: str, manifest: Manifest, keep: int = KEEP) -> Manifest:
    """Make ``manifest`` the current one; delete the folders of versions that are no longer kept."""
    root = root.rstrip("/")
    old = current(spark, root)
    used = list(dict.fromkeys([*(old.folders if old else []), *manifest.folders]))
    drop, manifest.folders = used[: max(0, len(used) - keep)], used[-keep:]
    # A folder that a table still lies in stays, however old it is.
    still = [f for f in drop if any(t == f or t.startswith(f + "/") for t in manifest.tables.values())]
    manifest.folders = [*still, *manifest.folders]
    jvm, conf, target, fs = _hadoop(spark, f"{root}/{MANIFEST}")
    draft = jvm.org.apache.hadoop.fs.Path(f"{root}/.{MANIFEST}.{uuid.uuid4().hex}")
    stream = fs.create(draft, True)
    try:
        stream.write(bytearray(json.dumps(manifest.__dict__).encode()))
    finally:
        stream.close()
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), conf).rename(draft, target, overwrite)
    for folder in drop:
        if folder not in still:
            delete(spark, folder)
    return manifest


def delete(spark: SparkSession, path: str) -> None:
    _, _, where, fs = _hadoop(spark, path)
    fs.delete(where, True)


@contextmanager
def new_version(spark: SparkSession, root: str):
    """A new folder to write in; removed again if the block fails, before anything was published."""
    folder = new_folder(root)
    try:
        yield folder
    except BaseException:
        delete(spark, folder)
        raise


def resolve(spark: SparkSession, root: str, tables: Mapping[str, str] | None = None) -> dict[str, str]:
    """Folder of each current table of ``root``; ``tables`` as they lie without a manifest."""
    found = current(spark, root)
    return found.tables if found else dict(tables or {})
