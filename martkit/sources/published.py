"""All-or-nothing publication of several tables.

Every load writes its tables to folders of its own. They become visible together, by
one atomic step: a small manifest that names them is renamed into the catalog folder.
Readers take the newest manifest, so they see all tables of one load or all of the
load before it, also while a load runs, fails half-way, or two loads race (the later
rename of one version number fails, and that load with it).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .tables_io import read_as, write_table

_MANIFEST = "manifest-%012d.json"


def _fs(spark: SparkSession, root: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    return path, path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def _path(spark: SparkSession, *parts: str):
    return spark.sparkContext._jvm.org.apache.hadoop.fs.Path("/".join(parts))


def current_version(spark: SparkSession, root: str) -> int:
    """The newest published version; 0 before the first. (Version numbers go up by one.)"""
    top, fs = _fs(spark, root)
    found = fs.globStatus(_path(spark, root, "manifest-*.json")) if fs.exists(top) else []
    return max((int(f.getPath().getName()[len("manifest-"):-len(".json")]) for f in found or []), default=0)


def _manifest(spark: SparkSession, root: str, version: int) -> dict:
    if not version:
        return {}
    _, fs = _fs(spark, root)
    stream = fs.open(_path(spark, root, _MANIFEST % version))
    try:
        return json.loads(bytes(stream.readAllBytes()).decode())
    finally:
        stream.close()


def published(spark: SparkSession, root: str, name: str, version: int | None = None) -> DataFrame | None:
    """A table as of the newest (or the given) version, or None if it has none yet."""
    entry = _manifest(spark, root, current_version(spark, root) if version is None else version).get(name)
    return None if entry is None else read_as(spark, entry["path"], StructType.fromJson(entry["schema"]))


def publish(spark: SparkSession, root: str, tables: dict[str, Callable[[DataFrame | None], DataFrame]]) -> int:
    """One load: each step of ``tables`` (name -> function of the table as it is now, None
    before the first load) is written, in order, and then all become visible at once.
    Other tables of the catalog stay as they are. A step that fails raises, and readers
    keep what they had; its files are left for a clean-up, and never read. Returns the
    new version."""
    version = current_version(spark, root)
    entries = _manifest(spark, root, version)
    load = uuid.uuid4().hex[:12]
    for name, step in tables.items():
        df = step(published(spark, root, name, version))
        path = write_table(df, f"{root.rstrip('/')}/tables/{name}/load-{load}")
        entries[name] = {"path": path, "schema": json.loads(df.schema.json())}
    _commit(spark, root, version + 1, entries, load)
    return version + 1


def _commit(spark: SparkSession, root: str, version: int, entries: dict, load: str) -> None:
    top, fs = _fs(spark, root)
    fs.mkdirs(top)
    staged = _path(spark, root, f"staged-{load}.json")
    out = fs.create(staged, False)
    out.write(bytearray(json.dumps(entries, sort_keys=True).encode()))
    out.close()
    target = _path(spark, root, _MANIFEST % version)
    # a rename onto an existing file is refused, or replaces it, by file system: look first
    if fs.exists(target) or not fs.rename(staged, target):
        fs.delete(staged, False)
        raise RuntimeError(f"version {version} of {root} was published by another load")
