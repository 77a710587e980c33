"""Named tables: ``namespace.table`` names resolved to storage locations.

The warehouse addresses tables by name in two namespaces, ``raw`` (landing and cleaned
tables) and ``analytics`` (marts). A ``Catalog`` maps such names to parquet folders
below one root (shared storage), reads them with ``table`` and replaces or appends them
with ``write``; names registered in the session catalog are read from there instead.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from chartmart.sources.commits import CommittedTable
from chartmart.sources.versions import exists

NAMESPACES = ("raw", "analytics")


@dataclass
class Catalog:
    spark: SparkSession
    root: str
    overrides: dict[str, str] = field(default_factory=dict)

    def location(self, name: str) -> str:
        if name in self.overrides:
            return self.overrides[name]
        ns, _, table = name.partition(".")
        if not table or ns not in NAMESPACES:
            raise ValueError(f"table names are '<{'|'.join(NAMESPACES)}>.<table>', got {name!r}")
        return f"{self.root.rstrip('/')}/{ns}/{table}"

    def register(self, name: str, path: str) -> None:
        """Bind a name to an existing folder (e.g. a driver-provided table)."""
        self.overrides[name] = path

    def _registered_here(self, name: str) -> bool:
        """A session-catalog table of this name whose files are this catalog's location."""
        if not self.spark.catalog.tableExists(name):
            return False
        info = {r[0].strip(): (r[1] or "").strip() for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {name}").collect()}
        return info.get("Location", "").rstrip("/").endswith(self.location(name).split(":", 1)[-1].rstrip("/"))

    def committed(self, name: str) -> CommittedTable:
        """The table of this name as one of committed versions (``sources.commits``)."""
        return CommittedTable(self.spark, self.location(name))

    def table(self, name: str) -> DataFrame:
        if exists(self.spark, f"{self.location(name)}/commits"):
            return self.committed(name).read()
        if self._registered_here(name):
            return self.spark.table(name)  # carries the bucketing spec
        return self.spark.read.parquet(self.location(name))

    def write(self, name: str, df: DataFrame, mode: str = "overwrite", partition_by: list[str] | None = None,
              bucket_by: tuple[int, list[str]] | None = None) -> DataFrame:
        """Replace (full reload) or append; returns the table as readers now see it.

        ``bucket_by=(n, cols)`` stores the table hash-bucketed and sorted by ``cols`` (an external
        catalog table at the same location): a later join on ``cols`` reads it without a shuffle."""
        w = df.write.mode(mode)
        if partition_by:
            w = w.partitionBy(*partition_by)
        if bucket_by:
            n, cols = bucket_by
            ns = name.partition(".")[0]
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {ns}")
            w.bucketBy(n, *cols).sortBy(*cols).option("path", self.location(name)).saveAsTable(name)
            return self.spark.table(name)
        w.parquet(self.location(name))
        return self.table(name)
