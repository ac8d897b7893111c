"""Published versions of a warehouse: one small manifest file each.

A manifest says which load holds each batch, which tables that load wrote, and their last keys. It is
written aside and renamed into place; the rename fails when the number is taken, so that of two
loads that began on one version only the first is published. The file system's rename must be
atomic, as it is on HDFS and POSIX file systems.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


class ConcurrentLoad(RuntimeError):
    """Another load was published since this one began."""


@dataclass(frozen=True)
class Entry:
    """What a version knows of one batch."""

    load: str
    tables: tuple[str, ...] = ()
    last_keys: Mapping[str, int] = field(default_factory=dict)
    buckets: Mapping[str, tuple[int, ...]] = field(default_factory=dict)  # of an index, that the load wrote


@dataclass(frozen=True)
class Version:
    """``number`` 0 is the empty warehouse before the first load."""

    number: int = 0
    batches: Mapping[int, Entry] = field(default_factory=dict)


class Files:
    """The few file operations that Spark's readers and writers don't have, on any Hadoop path."""

    def __init__(self, spark: SparkSession):
        self._jvm = spark._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self._gateway = spark.sparkContext._gateway

    def _at(self, path: str):
        where = self._jvm.org.apache.hadoop.fs.Path(path)
        return where, where.getFileSystem(self._conf)

    def names(self, folder: str) -> list[str]:
        where, files = self._at(folder)
        return [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []

    def find(self, pattern: str) -> list[str]:
        where, files = self._at(pattern)
        return [f.getPath().toString() for f in files.globStatus(where) or []]

    def larger_than(self, paths: Iterable[str], size: int) -> list[str]:
        found = []
        for path in paths:
            where, files = self._at(path)
            if files.getFileStatus(where).getLen() > size:
                found.append(path)
        return found

    def read(self, path: str) -> str:
        where, files = self._at(path)
        stream = files.open(where)
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def delete(self, path: str) -> None:
        where, files = self._at(path)
        files.delete(where, True)

    def create(self, path: str, text: str) -> bool:
        """Write a file whole or not at all; False when there is one of that name."""
        where, files = self._at(path)
        aside = f"{path.rpartition('/')[0]}/.{uuid.uuid4().hex}"
        begun, _ = self._at(aside)
        stream = files.create(begun, False)
        try:
            stream.write(bytearray(text.encode()))
        finally:
            stream.close()
        names = self._jvm.org.apache.hadoop.fs
        keep_what_is_there = self._gateway.new_array(getattr(names, "Options$Rename"), 0)
        try:
            names.FileContext.getFileContext(files.makeQualified(where).toUri(), self._conf).rename(
                files.makeQualified(begun), files.makeQualified(where), keep_what_is_there
            )
        except Py4JJavaError as error:
            files.delete(begun, False)
            if "AlreadyExists" not in error.java_exception.getClass().getName():
                raise
            return False
        return True


def _path(root: str, number: int) -> str:
    return f"{root}/versions/{number:012d}.json"


def published(files: Files, root: str) -> list[int]:
    """Numbers of the versions that are kept, in order."""
    return sorted(int(n[:-5]) for n in files.names(f"{root}/versions") if n.endswith(".json") and not n.startswith("."))


def read_version(files: Files, root: str, number: int) -> Version:
    if number == 0:
        return Version()
    told = json.loads(files.read(_path(root, number)))
    entries = {
        int(b): Entry(e["load"], tuple(e["tables"]), e["last_keys"], {t: tuple(n) for t, n in e["buckets"].items()})
        for b, e in told["batches"].items()
    }
    return Version(number, entries)


def publish(files: Files, root: str, version: Version) -> None:
    told = {
        "version": version.number,
        "batches": {
            str(b): {"load": e.load, "tables": sorted(e.tables), "last_keys": dict(e.last_keys), "buckets": dict(e.buckets)}
            for b, e in sorted(version.batches.items())
        },
    }
    newest = max(published(files, root), default=0)
    if newest >= version.number or not files.create(_path(root, version.number), json.dumps(told)):
        raise ConcurrentLoad(f"version {version.number} was published by another load; begin again")


def forget(files: Files, root: str, number: int) -> None:
    files.delete(_path(root, number))
