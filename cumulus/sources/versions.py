"""K3: a parquet table with versions, for upserts that never overwrite what
they read.

A version is a manifest: which folder holds each partition (or the whole
table), and notes of the writer. A commit writes new folders for the
partitions that it changes, then puts the manifest under the next number by a
rename that fails if that number is taken. Readers take the highest number,
so they see a version whole or not at all; a writer that dies before the
rename leaves the old version, one that lost the race is told and can start
again from the new one. Old versions stay readable until ``vacuum``.

Folders and manifests are reached through Spark's own file systems.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field
from urllib.parse import unquote

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, functions as F

from cumulus.sources.sinks import file_count, placed, upsert

_NUMBER = re.compile(r"v(\d{12})\.json$")


class CommitConflict(RuntimeError):
    """Another writer has committed a version since this one read."""


@dataclass(frozen=True)
class Version:
    number: int = 0
    folders: dict[str, str] = field(default_factory=dict)
    notes: dict[str, str] = field(default_factory=dict)


class VersionedTable:
    """The table below ``base``; ``partition_by`` names at most one column,
    whose values are folders that are replaced one by one."""

    def __init__(self, spark: SparkSession, base: str, schema: str, partition_by: str | None = None):
        self.spark, self.base, self.schema, self.partition_by = spark, base.rstrip("/"), schema, partition_by

    # ------------------------------------------------------------ files
    def _path(self, *parts: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path("/".join([self.base, *parts]))

    def _fs(self):
        return self._path().getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._path(folder)
        return [s.getPath().getName() for s in self._fs().listStatus(path)] if self._fs().exists(path) else []

    def numbers(self) -> list[int]:
        return sorted(int(m.group(1)) for n in self._names("commits") if (m := _NUMBER.match(n)))

    def version(self, number: int | None = None) -> Version:
        """A version; the newest one by default, number 0 before the first."""
        found = self.numbers()
        if number is None:
            number = found[-1] if found else 0
        if number == 0:
            return Version()
        if number not in found:
            raise ValueError(f"{self.base} has no version {number}")
        source = self._fs().open(self._path("commits", f"v{number:012d}.json"))
        try:
            text = self.spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
        finally:
            source.close()
        held = json.loads(text)
        return Version(number, held["folders"], held["notes"])

    # ------------------------------------------------------------ reading
    def read(self, version: Version | None = None, parts: Sequence[str] | None = None) -> DataFrame:
        """The rows of a version, or of some of its partitions (by the value
        as a string)."""
        version = version or self.version()
        folders = [f for p, f in sorted(version.folders.items()) if parts is None or p in parts]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.base}/data/{f}" for f in folders])

    # ------------------------------------------------------------ writing
    def write(self, df: DataFrame) -> str:
        """The rows in a new folder that no version names yet."""
        name = uuid.uuid4().hex
        df.write.parquet(f"{self.base}/data/{name}")
        return name

    def commit(self, read: Version, folders: dict[str, str], notes: dict[str, str] | None = None) -> Version:
        """Makes the version after ``read``, with these folders in place of
        its own. Fails if ``read`` isn't the newest any more."""
        new = Version(read.number + 1, {**read.folders, **folders}, {**read.notes, **(notes or {})})
        fs, draft = self._fs(), self._path("commits", f".{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        try:
            out.write(bytearray(json.dumps({"folders": new.folders, "notes": new.notes}).encode()))
        finally:
            out.close()
        context = self.spark._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._path().toUri(), self.spark._jsc.hadoopConfiguration())
        options = self.spark._sc._gateway.new_array(self.spark._jvm.org.apache.hadoop.fs.Options.Rename, 0)
        try:
            if read.number + 1 in self.numbers():
                raise CommitConflict(f"{self.base} has moved on from version {read.number}")
            context.rename(draft, self._path("commits", f"v{new.number:012d}.json"), options)
        except Py4JJavaError as e:
            if "FileAlreadyExists" in str(e.java_exception):
                raise CommitConflict(f"{self.base} has moved on from version {read.number}") from e
            raise
        finally:
            fs.delete(draft, False)
        return new

    def upsert(self, new: DataFrame, keys: Sequence[str], read: Version | None = None,
               notes: dict[str, str] | None = None) -> Version:
        """``ON CONFLICT (keys) DO UPDATE``: rows of ``new`` replace those with
        the same keys; of a partitioned table only the partitions that ``new``
        touches are written. ``new`` may be computed from the version read.
        ``keys`` must contain the partition column, and ``new`` a key once."""
        read = read or self.version()
        if self.partition_by is None:
            return self.commit(read, {"": self.write(upsert(self.read(read), new, keys))}, notes)
        if self.partition_by not in keys:
            raise ValueError("keys must contain the partition column")
        name = uuid.uuid4().hex
        fresh = self.spark.read.schema(new.schema).parquet(f"{self.base}/data/{self.write(new)}")
        value = F.coalesce(F.col(self.partition_by).cast("string"), F.lit(""))  # null and empty share a folder
        touched = [r[0] for r in fresh.select(value).distinct().collect()]
        rows = upsert(self.read(read, touched), fresh, keys).select(*fresh.columns)
        rows = placed(rows.select("*", value.alias("_part")), ["_part"], file_count(rows))
        rows.write.partitionBy("_part").parquet(f"{self.base}/data/{name}")
        held = {n.split("=", 1)[1]: f"{name}/{n}" for n in self._names(f"data/{name}") if n.startswith("_part=")}
        return self.commit(read, {self._value(v): f for v, f in held.items()}, notes)

    @staticmethod
    def _value(folder: str) -> str:
        return "" if folder == "__HIVE_DEFAULT_PARTITION__" else unquote(folder)

    def vacuum(self, keep: int = 2) -> list[str]:
        """Forgets all but the newest ``keep`` versions and deletes folders
        that none of these names; give running readers time first. Returns
        the names deleted."""
        numbers = self.numbers()
        stay = {f.split("/", 1)[0] for n in numbers[-keep:] for f in self.version(n).folders.values()}
        for n in numbers[:-keep]:
            self._fs().delete(self._path("commits", f"v{n:012d}.json"), False)
        gone = [n for n in self._names("data") if n not in stay]
        for n in gone:
            self._fs().delete(self._path("data", n), True)
        return gone
