"""All checks of a table in one pass.

Every checked column is one grouping set of a single aggregation: the groups of a column's
set give both its nulls (the size of the null group) and its repeated values (groups of two rows or more), so a table is
read once however many checks it has. Columns that are only checked for nulls are grouped by
whether they are null. Type checks need the schema alone.

``enforce`` lets failed checks of severity ``error`` stop a run; those of severity ``warn`` are
only reported.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.operators.quality import type_matches

KINDS = ("not_null", "unique", "type")


@dataclass(frozen=True)
class Check:
    kind: str
    column: str
    name: str
    type_class: str | None = None
    severity: str = "error"

    def __post_init__(self):
        if self.kind not in KINDS or self.severity not in ("warn", "error"):
            raise ValueError(f"{self.name}: unknown kind {self.kind!r} or severity {self.severity!r}")


class CheckFailed(RuntimeError):
    """Checks of severity ``error`` have failures."""


def run_table_checks(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """``check_name, failures, should_warn, should_error`` of each check, from one scan of ``df``.

    Nulls are no repeated values. A table without rows has no failures.
    """
    scanned = [c for c in checks if c.kind != "type"]
    columns = list(dict.fromkeys(c.column for c in scanned))
    failures = {c: F.lit(0 if type_matches(df, c.column, c.type_class) else 1).cast("bigint") for c in checks if c.kind == "type"}
    if columns:
        whole = {c.column for c in scanned if c.kind == "unique"}
        at = {c: f"_c{k}" for k, c in enumerate(columns)}
        # a column that only has to be not null: two groups, whether it is
        keyed = df.select(*[(F.col(c) if c in whole else F.when(F.col(c).isNotNull(), True)).alias(at[c]) for c in columns])
        groups = keyed.groupingSets([[F.col(k)] for k in at.values()], *[F.col(k) for k in at.values()]).agg(
            F.count(F.lit(1)).alias("_n"), *[F.grouping(k).alias(f"_g{k}") for k in at.values()])
        for c in scanned:
            k = at[c.column]
            own = F.col(f"_g{k}") == 0
            if c.kind == "not_null":
                n = F.sum(F.when(own & F.col(k).isNull(), F.col("_n")))
            else:
                n = F.sum(F.when(own & F.col(k).isNotNull() & (F.col("_n") > 1), 1))
            failures[c] = F.coalesce(n, F.lit(0)).cast("bigint")
        one = groups.agg(*[failures[c].alias(f"_f{k}") for k, c in enumerate(checks)])
    else:
        one = df.sparkSession.range(1).select(*[failures[c].alias(f"_f{k}") for k, c in enumerate(checks)])
    rows = F.array(*[F.struct(F.lit(c.name).alias("check_name"), F.col(f"_f{k}").alias("failures"), F.lit(c.severity).alias("severity")) for k, c in enumerate(checks)])
    out = one.select(F.explode(rows).alias("_r")).select("_r.*")
    return out.select("check_name", "failures", (F.col("failures") != 0).alias("should_warn"),
                      ((F.col("failures") != 0) & (F.col("severity") == "error")).alias("should_error"))


def run_compiled(tables: Sequence[tuple[DataFrame, Sequence[Check]]]) -> DataFrame:
    """The checks of several tables as one report."""
    out = None
    for df, checks in tables:
        own = run_table_checks(df, checks)
        out = own if out is None else out.unionByName(own)
    return out


def enforce(report: DataFrame) -> list[str]:
    """Names of the checks that warn; ``CheckFailed`` if any has to stop the run. A report has a row for each check."""
    failed = report.where("should_warn or should_error").orderBy("check_name").collect()
    if errors := [f"{r['check_name']} ({r['failures']})" for r in failed if r["should_error"]]:
        raise CheckFailed(", ".join(errors))
    return [r["check_name"] for r in failed]
