"""Committed tables: readers see the old version or the new one, never a half-written one.

A table is a folder. ``data/<id>`` holds immutable files, each folder written by one Spark job;
``commits/<number>.json`` says which of them make up a version. A version exists once its
file does: the file is written aside and published under its number in one step that fails
if the number is taken. So

* a reload that dies half way leaves files that no version names, and the old rows;
* of two writers that started from the same version one commits and the other gets
  ``Conflict``; it decides whether to start over (``replace``, merges) or to add its files to
  the newer version (``append``, which is right on top of any version);
* a version that is read stays readable while others are written, and ``rollback`` commits
  the files of an earlier one again.

A table may hold several families of rows (``family``), committed together, each laid out in
buckets by an expression; a commit may replace single buckets and keep the files of the others.
Only names of files and buckets pass through the driver, never rows.

The step is a hard link on a shared local file system and a rename without overwrite
elsewhere, which HDFS and its like do atomically; a store without such a rename needs one
writer at a time.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmart.session import shuffles_freed

_BUCKET = "_bucket_"
_NAME = re.compile(r"(\d{12})\.json")


class Conflict(RuntimeError):
    """Another writer has committed since the version that a writer started from."""


class CommitLog:
    """Numbered JSON records in a folder, from 1. A number is given once."""

    def __init__(self, spark: SparkSession, folder: str):
        self._jvm, self._conf, self._gateway = spark._jvm, spark._jsc.hadoopConfiguration(), spark.sparkContext._gateway
        self.folder = folder.rstrip("/")
        root = self._path(self.folder)
        self._fs = root.getFileSystem(self._conf)
        self._local = self._fs.getUri().getScheme() == "file"
        self._fs.mkdirs(root)

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def latest(self) -> int:
        """The highest number given, 0 if none."""
        names = (status.getPath().getName() for status in self._fs.listStatus(self._path(self.folder)))
        return max((int(m[1]) for m in map(_NAME.fullmatch, names) if m), default=0)

    def get(self, number: int) -> dict:
        stream = self._fs.open(self._path(f"{self.folder}/{number:012d}.json"))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def put(self, number: int, record: dict) -> None:
        """Publish a record under a number, whole or not at all; ``Conflict`` if the number is taken."""
        aside, at = self._path(f"{self.folder}/.{uuid.uuid4().hex}"), self._path(f"{self.folder}/{number:012d}.json")
        out = self._fs.create(aside, False)
        out.write(bytearray(json.dumps(record).encode()))
        out.close()
        try:
            if self._local:
                as_java = lambda p: self._jvm.java.nio.file.Paths.get(p.toUri().getPath(), self._gateway.new_array(self._jvm.String, 0))
                self._jvm.java.nio.file.Files.createLink(as_java(at), as_java(aside))
            else:
                options = self._gateway.new_array(self._jvm.org.apache.hadoop.fs.Options.Rename, 0)
                self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._fs.getUri(), self._conf).rename(
                    self._fs.makeQualified(aside), self._fs.makeQualified(at), options)
        except Exception as e:
            if "AlreadyExists" in str(e):
                raise Conflict(f"{at} is taken") from None
            raise
        finally:
            if self._fs.exists(aside):
                self._fs.delete(aside, False)

    def children(self, folder: str) -> list[str]:
        return [status.getPath().getName() for status in self._fs.listStatus(self._path(folder))]


@dataclass(frozen=True)
class Version:
    """What a commit says. ``parts``: family -> bucket -> folders; the bucket of an unbucketed family is ``""``."""

    number: int
    operation: str
    parts: dict[str, dict[str, list[str]]] = field(default_factory=dict)
    schemas: dict[str, dict] = field(default_factory=dict)
    rows: int | None = None  # written by this commit
    run: str | None = None  # label of the job that committed
    properties: dict = field(default_factory=dict)


@dataclass(frozen=True)
class Written:
    """Files that no version names yet."""

    family: str
    parts: dict[str, list[str]]
    schema: T.StructType
    rows: int


NOTHING = Version(0, "none")


class CommittedTable:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/commits")

    # ---- versions

    def latest(self) -> Version:
        """The last version; one without parts and with number 0 if there is none."""
        number = self.log.latest()
        return self.at(number) if number else NOTHING

    def at(self, number: int) -> Version:
        return Version(number=number, **self.log.get(number)) if number else NOTHING

    def committed(self, run: str) -> Version | None:
        """The version that a job of this label has committed, if any: a job that is run again can tell."""
        for number in range(self.log.latest(), 0, -1):
            version = self.at(number)
            if version.run == run:
                return version
        return None

    def history(self) -> list[Version]:
        return [self.at(n) for n in range(1, self.log.latest() + 1)]

    def commit(self, base: Version, operation: str, parts: dict, schemas: dict, rows: int | None = None, run: str | None = None,
               properties: dict | None = None) -> Version:
        """The version after ``base``; ``Conflict`` if there is one already."""
        record = {"operation": operation, "parts": parts, "schemas": schemas, "rows": rows, "run": run,
                  "properties": base.properties if properties is None else properties}
        self.log.put(base.number + 1, record)
        return Version(number=base.number + 1, **record)

    # ---- rows

    def read(self, version: Version | int | None = None, family: str = "", buckets: Iterable[int | str] | None = None) -> DataFrame:
        """Rows of a version (the latest by default), of all buckets or of those named."""
        if not isinstance(version, Version):
            version = self.latest() if version is None else self.at(version)
        if family not in version.schemas:
            raise FileNotFoundError(f"{self.root} has no rows of family {family!r} in version {version.number}")
        schema = T.StructType.fromJson(version.schemas[family])
        have = version.parts.get(family, {})
        chosen = have if buckets is None else [str(b) for b in buckets if str(b) in have]
        paths = [f"{self.root}/{folder}" for b in chosen for folder in have[b]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read_written(self, written: Written) -> DataFrame:
        """Rows of files that no version names yet."""
        paths = [f"{self.root}/{folder}" for folders in written.parts.values() for folder in folders]
        return self.spark.read.schema(written.schema).parquet(*paths) if paths else self.spark.createDataFrame([], written.schema)

    def write(self, df: DataFrame, family: str = "", bucket: Column | None = None, spread: bool = True) -> Written:
        """Write rows into a new folder that no version names yet, and count them on the way.

        With ``bucket`` each of its values has a folder of its own. Full buckets are split over tasks and small
        ones put together by the sizes seen in the shuffle. ``spread=False``: the rows are read from buckets, so each task
        has few of them as it is, and nothing is shuffled.
        """
        folder, schema = f"data/{uuid.uuid4().hex}", df.schema
        seen = Observation()
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        if bucket is None:
            with shuffles_freed(self.spark):
                df.write.parquet(f"{self.root}/{folder}")
            parts = {"": [folder]}
        else:
            df = df.withColumn(_BUCKET, bucket)
            df = df.hint("rebalance", _BUCKET) if spread else df
            with shuffles_freed(self.spark):
                df.write.option("compression", "zstd").partitionBy(_BUCKET).parquet(f"{self.root}/{folder}")
            names = [n for n in self.log.children(f"{self.root}/{folder}") if n.startswith(f"{_BUCKET}=")]
            parts = {n.split("=", 1)[1]: [f"{folder}/{n}"] for n in sorted(names)}
        return Written(family, parts, schema, self._observed(seen, parts, schema))

    def _observed(self, seen: Observation, parts: dict[str, list[str]], schema: T.StructType) -> int:
        try:
            return int(seen.get["rows"])
        except Exception:  # nothing is observed if the planner knows that there are no rows
            paths = [f"{self.root}/{folder}" for folders in parts.values() for folder in folders]
            return self.spark.read.schema(schema).parquet(*paths).count() if paths else 0

    def replace(self, df: DataFrame, base: Version | None = None, run: str | None = None, bucket: Column | None = None,
                properties: dict | None = None) -> Version:
        """Full reload of the table. ``Conflict`` if another writer commits after ``base`` (by default, after this call began)."""
        base = self.latest() if base is None else base
        new = self.write(df, bucket=bucket)
        return self.commit(base, "replace", {"": new.parts}, {"": new.schema.jsonValue()}, new.rows, run, properties)

    def append(self, df: DataFrame, run: str | None = None, bucket: Column | None = None) -> Version:
        """Add rows, by name. Other writers' commits do not matter: the files are added to whatever is the latest version."""
        base = self.latest()
        if base.schemas:
            schema = T.StructType.fromJson(base.schemas[""])
            if sorted(schema.names) != sorted(df.columns):
                raise ValueError(f"columns {sorted(df.columns)} do not match those of {self.root}: {sorted(schema.names)}")
            df = df.select(*[F.col(f.name).cast(f.dataType) for f in schema])
        new = self.write(df, bucket=bucket)
        while True:
            base = self.latest()
            schemas = base.schemas or {"": new.schema.jsonValue()}
            if schemas[""] and T.StructType.fromJson(schemas[""]).names != new.schema.names:
                raise Conflict(f"{self.root} was replaced by a table of other columns")
            try:
                return self.commit(base, "append", base.parts | {"": added(base.parts.get("", {}), new.parts)}, schemas, new.rows, run)
            except Conflict:
                continue

    def rollback(self, number: int) -> Version:
        """Make an earlier version the latest again, as a commit of its own."""
        old = self.at(number)
        return self.commit(self.latest(), "rollback", old.parts, old.schemas, properties=old.properties)


def added(have: dict[str, list[str]], new: dict[str, list[str]]) -> dict[str, list[str]]:
    """Folders by bucket, the new ones after those that are there."""
    return have | {b: have.get(b, []) + folders for b, folders in new.items()}


def replaced(have: dict[str, list[str]], buckets: Iterable[int | str], new: dict[str, list[str]]) -> dict[str, list[str]]:
    """Folders by bucket, those of ``buckets`` as ``new`` has them, all others as they were."""
    gone = {str(b) for b in buckets}
    return {b: folders for b, folders in have.items() if b not in gone} | new


class Sequence:
    """Numbers that are given once, over loads and loaders.

    A block is taken by a commit that moves the next free number, so two loaders never get the
    same one and no table is scanned for its maximum. A block that is taken and not used leaves a gap.
    """

    def __init__(self, spark: SparkSession, root: str, start: int = 1):
        self.log, self.start = CommitLog(spark, root), start

    def take(self, n: int) -> int:
        """The first number of a block of ``n``."""
        while True:
            number = self.log.latest()
            first = self.log.get(number)["next"] if number else self.start
            if n <= 0:
                return first
            try:
                self.log.put(number + 1, {"next": first + n})
                return first
            except Conflict:
                continue
