"""Tables in numbered versions: a version is there once its commit file is.

Every writer writes to paths of its own and then creates ``commits/<number>.json``, which fails if another writer has created
that number: of two writers who start from the same version one wins, the other removes what it wrote and raises. Readers start from a
commit, so they see all tables of one version. The file system's create must be exclusive (as in HDFS and local folders).
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Mapping
from typing import NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession


class Version(NamedTuple):
    """A committed version: its number, the last period it holds, and path and row count of its tables."""

    number: int
    period: int
    paths: Mapping[str, str]
    rows: Mapping[str, int]


class LostRace(RuntimeError):
    """Another writer has committed the version first; nothing of this one is left."""


def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def versions(spark: SparkSession, folder: str) -> list[Version]:
    """All committed versions of a folder, oldest first; none if it isn't there. One small file each."""
    files, listed = _files(spark, f"{folder.rstrip('/')}/commits")
    if not files.exists(listed):
        return []
    found = []
    for status in files.listStatus(listed):
        name = status.getPath().getName()
        if name.endswith(".json") and name[:-5].isdigit():
            stream = files.open(status.getPath())
            try:
                text = spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
            finally:
                stream.close()
            if text.endswith("\n"):  # a file without its end is still being written
                found.append(Version(int(name[:-5]), **json.loads(text)))
    return sorted(found)


def version_of(spark: SparkSession, folder: str, period: int | None = None, number: int | None = None) -> Version | None:
    """The newest version, or the newest of a period, or the one with a number."""
    fitting = [v for v in versions(spark, folder) if period in (None, v.period) and number in (None, v.number)]
    return fitting[-1] if fitting else None


def commit(folder: str, tables: Mapping[str, DataFrame], period: int, base: int | None = None) -> Version:
    """Write tables as the version after ``base`` (after the newest one, if not given; 0: none yet), or raise ``LostRace``."""
    spark = next(iter(tables.values())).sparkSession
    folder = folder.rstrip("/")
    if base is None:
        newest = version_of(spark, folder)
        base = newest.number if newest else 0
    paths, rows = {}, {}
    try:
        for name, df in tables.items():
            paths[name] = f"{folder}/data/{name}/{uuid.uuid4().hex}"
            df.write.parquet(paths[name])
            rows[name] = spark.read.schema(df.schema).parquet(paths[name]).count()
        text = json.dumps({"period": period, "paths": paths, "rows": rows}) + "\n"
        files, target = _files(spark, f"{folder}/commits/{base + 1:010d}.json")
        try:
            stream = files.create(target, False)
        except Py4JJavaError as error:
            if "AlreadyExists" in error.java_exception.getClass().getName():
                raise LostRace(f"version {base + 1} of {folder} is committed by another writer") from None
            raise
        stream.write(text.encode())
        stream.close()
    except Exception:
        for path in paths.values():
            files, target = _files(spark, path)
            files.delete(target, True)
        raise
    return Version(base + 1, period, paths, rows)


def read_version(
    spark: SparkSession, folder: str, name: str, period: int | None = None, number: int | None = None
) -> DataFrame:
    """A table of a version, see ``version_of``."""
    found = version_of(spark, folder, period, number)
    if found is None or name not in found.paths:
        raise ValueError(f"{folder} has no version with {name}" + (f" for {period}" if period is not None else ""))
    return spark.read.parquet(found.paths[name])


def _abandoned(spark: SparkSession, folder: str, before: float) -> list:
    """Commit files whose writer was lost before it came to their end: they hold a number, and no version."""
    files, listed = _files(spark, f"{folder}/commits")
    known = {v.number for v in versions(spark, folder)}
    found = list(files.listStatus(listed)) if files.exists(listed) else []
    return [
        s.getPath() for s in found
        if s.getPath().getName()[:-5].isdigit() and int(s.getPath().getName()[:-5]) not in known and s.getModificationTime() < before
    ]


def vacuum(spark: SparkSession, folder: str, oldest: int = 0, idle_seconds: float = 86_400) -> list[str]:
    """Remove table paths that no version from ``oldest`` on names, and the commits before it; returns the removed paths.

    A path that was touched within ``idle_seconds`` stays: its writer may be about to commit it. So does an unfinished
    commit file; an older one goes, which frees its number.
    """
    folder = folder.rstrip("/")
    before = (time.time() - idle_seconds) * 1000
    known = versions(spark, folder)
    kept = {path.rsplit("/", 1)[1] for v in known if v.number >= oldest for path in v.paths.values()}
    files, data = _files(spark, f"{folder}/data")
    removed = []
    for path in _abandoned(spark, folder, before):
        files.delete(path, False)
    for v in known:
        if v.number < oldest:
            files.delete(_files(spark, f"{folder}/commits/{v.number:010d}.json")[1], False)
    for name in files.listStatus(data) if files.exists(data) else []:
        for status in files.listStatus(name.getPath()):
            path = status.getPath()
            if path.getName() not in kept and status.getModificationTime() < before:
                files.delete(path, True)
                removed.append(path.toString())
    return removed
