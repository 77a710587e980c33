"""File sources and sinks: CSV landing with a named format, nested JSON pages, table writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from chartmart.session import shuffles_freed


@dataclass(frozen=True)
class FileFormat:
    """A named delimited-file format: comma, optional '"' quoting (doubled quotes escape a
    quote), one header line skipped, empty field -> NULL. Columns are bound by position to
    the given schema; header names are ignored.
    A record is one line, so large files are read by many tasks. ``multi_line=True`` also reads
    quoted fields that hold newlines, at the price of one task per file.
    Files are written as ``compression`` says, of ``file_rows`` rows at most: a gzip file is read by one task, so
    it is kept to a size that one task reads. Readers take any codec by the files' names."""

    sep: str = ","
    quote: str = '"'
    escape: str = '"'
    header: bool = True
    null_value: str = ""
    multi_line: bool = False
    mode: str = "FAILFAST"
    encoding: str = "UTF-8"
    compression: str = "gzip"
    file_rows: int = 500_000

    def reader_options(self) -> dict[str, str]:
        return {
            "sep": self.sep, "quote": self.quote, "escape": self.escape,
            "header": str(self.header).lower(), "nullValue": self.null_value,
            "multiLine": str(self.multi_line).lower(), "mode": self.mode, "encoding": self.encoding,
            "enforceSchema": "true", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
        }

    def writer_options(self) -> dict[str, str]:
        # the CSV writer trims edge whitespace unless told not to: keep values byte-exact
        return {"sep": self.sep, "quote": self.quote, "escape": self.escape,
                "header": str(self.header).lower(), "nullValue": self.null_value, "encoding": self.encoding,
                "compression": self.compression, "maxRecordsPerFile": str(self.file_rows),
                "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def scan_csv(spark: SparkSession, path: str, schema: T.StructType, fmt: FileFormat = FileFormat()) -> DataFrame:
    """Read delimited files into a fixed (normally all-string) schema; a short row fails the load."""
    return spark.read.schema(schema).options(**fmt.reader_options()).csv(path)


def write_csv(df: DataFrame, path: str, fmt: FileFormat = FileFormat()) -> None:
    with shuffles_freed(df.sparkSession):
        df.write.mode("overwrite").options(**fmt.writer_options()).csv(path)


def write_replace(df: DataFrame, target: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Full reload: replace the table's contents. Writes a path, or a catalog table when
    ``target`` has no '/'."""
    w = df.write.mode("overwrite").format(fmt)
    if partition_by:
        w = w.partitionBy(*partition_by)
    if "/" in target:
        w.save(target)
    else:
        w.saveAsTable(target)


def write_append(df: DataFrame, target: str, fmt: str = "parquet") -> None:
    w = df.write.mode("append").format(fmt)
    if "/" in target:
        w.save(target)
    elif df.sparkSession.catalog.tableExists(target):
        # insertInto binds by position: bring the columns into the table's order first
        names = df.sparkSession.table(target).columns
        if sorted(names) != sorted(df.columns):
            raise ValueError(f"columns {sorted(df.columns)} do not match those of {target}: {sorted(names)}")
        df.select(*names).write.mode("append").format(fmt).insertInto(target)
    else:
        w.saveAsTable(target)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType, fmt: str = "parquet") -> None:
    """CREATE TABLE IF NOT EXISTS with a fixed schema (database created when named)."""
    if "." in name:
        db = name.rsplit(".", 1)[0]
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {db}")
    if not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, schema=schema, source=fmt)


def write_counted(df: DataFrame, target: str, fmt: str = "parquet") -> int:
    """Replace ``target`` with ``df`` and report the row count observed during the write
    (no second pass over the data)."""
    from pyspark.sql import Observation
    from pyspark.sql import functions as F

    obs = Observation("write_counted")
    write_replace(df.observe(obs, F.count(F.lit(1)).alias("rows")), target, fmt)
    return int(obs.get["rows"])


def materialize_as(df: DataFrame, name: str, kind: str = "view") -> DataFrame:
    """Materialise a model: "view" (temp view, inlined by Catalyst), "table" (saved table),
    or "ephemeral" (the DataFrame itself)."""
    if kind == "view":
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if kind == "table":
        df.write.mode("overwrite").saveAsTable(name)
        return df.sparkSession.table(name)
    if kind == "ephemeral":
        return df
    raise ValueError(f"unknown materialization {kind!r}")
