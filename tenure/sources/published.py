"""Versions of a folder: data is written beside what is there and becomes current by one rename of a small file.

`<root>/_versions/<number>.json` names what belongs to a version; the highest number is current. A writer that dies
before the rename leaves the old version in place, and files that no version names are not read. Two writers
that start from one version cannot both publish the next: the rename refuses to replace a file. It is
atomic on HDFS and local disks; on an object store it is as atomic as the store's rename without overwriting.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

VERSIONS = "_versions"


class VersionConflict(RuntimeError):
    """Another writer has published the version in the meantime."""


class Folder:
    """The files of a folder in any store that Spark reaches."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.jvm, self.conf = spark._jvm, spark._jsc.hadoopConfiguration()
        self.fs = self._path(self.root).getFileSystem(self.conf)

    def _path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def names(self, folder: str) -> list[str]:
        """Names in a subfolder; none if it is not there."""
        at = self._path(f"{self.root}/{folder}")
        return [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []

    def read(self, name: str) -> str:
        stream = self.fs.open(self._path(f"{self.root}/{name}"))
        try:
            return self.jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def write_new(self, name: str, text: str) -> None:
        """Write a file whole or not at all; VersionConflict if the name is taken."""
        parts = name.rsplit("/", 1)
        beside = f"{self.root}/{parts[0]}/.{parts[-1]}-{uuid.uuid4().hex}"
        stream = self.fs.create(self._path(beside), True)
        stream.write(bytearray(text.encode()))
        stream.close()
        target = self._path(f"{self.root}/{name}")
        option = getattr(self.jvm.org.apache.hadoop.fs, "Options$Rename")
        context = self.jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), self.conf)
        try:
            context.rename(self._path(beside), target, self.spark.sparkContext._gateway.new_array(option, 0))
        except Exception as error:
            self.fs.delete(self._path(beside), False)
            if "AlreadyExists" in str(error):
                raise VersionConflict(name) from error
            raise

    def delete(self, name: str) -> None:
        self.fs.delete(self._path(f"{self.root}/{name}"), True)


def versions(folder: Folder) -> list[int]:
    return sorted(int(n[:-5]) for n in folder.names(VERSIONS) if re.fullmatch(r"\d{10}\.json", n))


def manifest(folder: Folder, version: int | None = None) -> tuple[int, dict]:
    """(number, content) of a version, by default of the current one; (0, {}) if there is none."""
    numbers = versions(folder)
    number = version if version is not None else numbers[-1] if numbers else 0
    return number, json.loads(folder.read(f"{VERSIONS}/{number:010d}.json")) if number else {}


def publish(folder: Folder, after: int, content: dict) -> int:
    """Make `content` the version behind `after`."""
    folder.write_new(f"{VERSIONS}/{after + 1:010d}.json", json.dumps(content, sort_keys=True))
    return after + 1


def sweep(folder: Folder, data: str, named: Sequence[str], keep: int = 2) -> None:
    """Delete all versions but the last `keep`, and the folders in `data` that none of these names.

    `named` are the keys of a manifest whose values name folders. Not while a writer is at work: what it has
    written and not yet published would go.
    """
    numbers = versions(folder)
    used = set()
    for number in numbers[-keep:]:
        content = manifest(folder, number)[1]
        for key in named:
            values = content.get(key, [])
            for value in values.values() if isinstance(values, dict) else [values] if isinstance(values, str) else values:
                used.add(value.split("/")[1])
    for name in folder.names(data):
        if name not in used:
            folder.delete(f"{data}/{name}")
    for number in numbers[:-keep]:
        folder.delete(f"{VERSIONS}/{number:010d}.json")


def replace(df: DataFrame, root: str, partition_by: Sequence[str] = ()) -> None:
    """Replace a whole table: it is written beside the current one, which stays readable until the new one is complete."""
    folder = Folder(df.sparkSession, root)
    before, _ = manifest(folder)
    at = f"data/{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(f"{folder.root}/{at}")
    publish(folder, before, {"table": at})


def open_table(spark: SparkSession, root: str, schema: StructType | None = None) -> DataFrame:
    """The current version of a table that `replace` wrote."""
    folder = Folder(spark, root)
    number, content = manifest(folder)
    if not number:
        raise FileNotFoundError(f"no version of {root}")
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(f"{folder.root}/{content['table']}")
