"""Data-quality checks. Each check returns its failing rows as a DataFrame; ``check_result``
turns failing rows into the one-row result (failures, should_warn, should_error) and
``run_checks`` unions results into a report."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartmart.schemas import CHECK_RESULT


def check_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.select(col).filter(F.col(col).isNull())


def check_unique(df: DataFrame, col: str) -> DataFrame:
    """Values seen more than once; NULL is ignored (as the generated test does)."""
    return (df.filter(F.col(col).isNotNull()).groupBy(F.col(col).alias("unique_field"))
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def check_key(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Primary-key violations: key tuples seen more than once, or with a NULL part."""
    cols = list(cols)
    any_null = F.lit(False)
    for c in cols:
        any_null = any_null | F.col(c).isNull()
    g = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("n_records"))
    return g.filter((F.col("n_records") > 1) | any_null)


def check_foreign_key(child: DataFrame, parent: DataFrame, child_col: str, parent_col: str | None = None) -> DataFrame:
    """Orphans: non-NULL child keys with no parent row (left anti join)."""
    parent_col = parent_col or child_col
    keys = parent.select(F.col(parent_col).alias("_pk"))
    c = child.filter(F.col(child_col).isNotNull())
    return c.join(keys, c[child_col] == keys["_pk"], "left_anti")


def check_fanout(dim: DataFrame, natural_key: Sequence[str]) -> DataFrame:
    """Natural keys held by more than one dimension row (a LEFT lookup would fan out)."""
    return (dim.groupBy(*natural_key).agg(F.count(F.lit(1)).alias("n_rows"))
            .filter(F.col("n_rows") > 1))


_NUMBER_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType, T.DecimalType)
_TYPE_CLASSES = {"number": _NUMBER_TYPES, "string": (T.StringType,), "date": (T.DateType,),
                 "timestamp": (T.TimestampType, T.TimestampNTZType), "boolean": (T.BooleanType,)}


def type_matches(df: DataFrame, col: str, type_class: str) -> bool:
    return isinstance(df.schema[col].dataType, _TYPE_CLASSES[type_class.lower()])


def check_result(failing: DataFrame, name: str) -> DataFrame:
    """One row: check_name, failures = count(*), should_warn/should_error = failures != 0."""
    n = F.count(F.lit(1)).cast("bigint")
    return failing.agg(n.alias("failures")).select(
        F.lit(name).alias("check_name"), F.col("failures"),
        (F.col("failures") != 0).alias("should_warn"), (F.col("failures") != 0).alias("should_error"))


def check_type(df: DataFrame, col: str, type_class: str, name: str | None = None) -> DataFrame:
    """Column type check (metadata only; no scan): one result row."""
    spark: SparkSession = df.sparkSession
    bad = 0 if type_matches(df, col, type_class) else 1
    name = name or f"type_{type_class}_{col}"
    return spark.createDataFrame([(name, bad, bad != 0, bad != 0)], CHECK_RESULT)


def run_checks(results: Sequence[DataFrame]) -> DataFrame:
    out = results[0]
    for r in results[1:]:
        out = out.unionByName(r)
    return out
