"""Type-2 history whose open rows stay where their key is.

Open rows are stored in files by the hash of the key (Spark bucketed tables). A run writes its
source once in the same buckets and joins bucket to bucket: the source is shuffled, the open
rows never are. Closed rows are added as files, and ``compact`` puts the files of many runs
together. Every run is one commit, so a run that dies leaves the history as it was, one that is
run again under its label does nothing, and of two at once one gets ``Conflict``.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmart.operators.history import _first_version, check_unique_keys, scd2_step
from chartmart.sources.commits import CommitLog

BUCKETS = 64


class StoredHistory:
    """``buckets`` is fixed by the first run; raise it with the data (a bucket is one task of the join)."""

    def __init__(self, spark: SparkSession, root: str, key_cols: Sequence[str], updated_at: str, buckets: int = BUCKETS):
        self.spark, self.root, self.keys, self.updated_at = spark, root.rstrip("/"), list(key_cols), updated_at
        self.log = CommitLog(spark, f"{self.root}/commits")
        self.buckets = self._state()["buckets"] if self.log.latest() else buckets

    def _state(self) -> dict:
        number = self.log.latest()
        return self.log.get(number) | {"number": number} if number else {"number": 0}

    # ---- files by bucket

    def _name(self, folder: str) -> str:
        return "history_" + hashlib.md5(f"{self.root}/{folder}".encode()).hexdigest()

    def _store(self, rows: DataFrame, what: str) -> str:
        """Write rows that lie in tasks by key, and name their folder; a task writes the bucket it holds."""
        folder = f"data/{what}-{uuid.uuid4().hex}"
        rows.write.bucketBy(self.buckets, *self.keys).sortBy(*self.keys).option("path", f"{self.root}/{folder}").saveAsTable(self._name(folder))
        return folder

    def _read(self, folder: str, schema: T.StructType) -> DataFrame:
        """A stored folder as a bucketed table; a session that has not seen it yet enters it in its catalog."""
        name = self._name(folder)
        if not self.spark.catalog.tableExists(name):
            keys, quote = ", ".join(f"`{k}`" for k in self.keys), str.maketrans({"'": "\\'", "\\": "\\\\"})
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
            self.spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
                           f"INTO {self.buckets} BUCKETS LOCATION '{f'{self.root}/{folder}'.translate(quote)}'")
        return self.spark.table(name)

    def open_rows(self) -> DataFrame:
        state = self._state()
        return self._read(state["open"], T.StructType.fromJson(state["schema"]))

    # ---- runs

    def step(self, current: DataFrame, as_of: datetime | str) -> tuple[DataFrame, DataFrame]:
        """The rows that a run closes and the next open rows; ``current`` is stored in the same buckets."""
        return scd2_step(self.open_rows(), current, self.keys, self.updated_at, as_of)

    def run(self, current: DataFrame, as_of: datetime | str, run: str | None = None) -> int:
        """Compare a load with the open rows; the number of the version it made, or of the one its label made earlier."""
        state, run = self._state(), str(as_of) if run is None else run
        if run in state.get("runs", ()):
            return state["number"]
        if state["number"]:  # hashes depend on the type: keys are read as the stored ones
            kinds = T.StructType.fromJson(state["schema"])
            current = current.select(*[F.col(c).cast(kinds[c].dataType).alias(c) if c in self.keys else F.col(c) for c in current.columns])
        source = self._read(self._store(current.repartition(self.buckets, *self.keys), "source"), current.schema)
        check_unique_keys(source, self.keys)
        closed = list(state.get("closed", ()))
        if state["number"]:
            gone, rows = self.step(source, as_of)
            folder = f"data/closed-{uuid.uuid4().hex}"
            gone.write.parquet(f"{self.root}/{folder}")
            closed.append(folder)
        else:
            rows = _first_version(source, self.keys, self.updated_at)
        record = {"runs": [*state.get("runs", ()), run], "buckets": self.buckets, "schema": rows.schema.jsonValue(),
                  "open": self._store(rows, "open"), "closed": closed}
        self.log.put(state["number"] + 1, record)
        return state["number"] + 1

    def compact(self) -> int:
        """Put the closed rows of all runs into files of even size; open rows keep theirs."""
        state = self._state()
        if len(state.get("closed", ())) < 2:
            return state["number"]
        folder = f"data/closed-{uuid.uuid4().hex}"
        self._closed(state).hint("rebalance").write.parquet(f"{self.root}/{folder}")
        record = {k: v for k, v in state.items() if k != "number"} | {"closed": [folder]}
        self.log.put(state["number"] + 1, record)
        return state["number"] + 1

    def _closed(self, state: dict) -> DataFrame:
        schema = T.StructType.fromJson(state["schema"])
        paths = [f"{self.root}/{f}" for f in state["closed"]]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def snapshot(self) -> DataFrame:
        """All versions of all keys."""
        return self._closed(self._state()).unionByName(self.open_rows())
