"""Marts kept up to date from the parts of the fact that change.

A mart is sums and averages per group. Both follow from exact partials, a sum and the number
of values, which can be added and taken away again. Stored are

``partials``  per part of the fact (a load, a day, ...) and group: rows, sums and numbers of values;
``totals``    the same per group over all parts, by bucket of the group.

Loading a part aggregates that part alone. If the part was loaded before, its old partials are taken
off: the difference goes to the totals of the groups it touches, whose buckets are
written anew while the files of all others stay. Groups without rows left go. Partials and totals are
committed together (``sources.commits``); of two loads at once one gets ``Conflict``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.operators.bucketed import _touched, bucket_of
from chartmart.operators.marts import is_whole, whole_sum
from chartmart.session import stage
from chartmart.sources.commits import CommittedTable, Version, replaced

EXACT = "decimal(38,12)"


class IncrementalMart:
    """``measures``: result column -> (``sum`` or ``avg``, column of the fact)."""

    def __init__(self, table: CommittedTable, group: Sequence[str], measures: Mapping[str, tuple[str, str]], buckets: int = 16):
        self.table, self.group, self.measures, self.n = table, list(group), dict(measures), buckets
        self.columns = list(dict.fromkeys(c for _, c in measures.values()))
        self.partial = ["_rows", *[f"{p}{c}" for c in self.columns for p in ("_sum_", "_num_")]]

    def _partials(self, rows: DataFrame) -> DataFrame:
        aggregates = [F.count(F.lit(1)).alias("_rows")]
        for c in self.columns:
            total = whole_sum(c) if is_whole(rows, c) else F.sum(F.col(c).cast(EXACT))
            aggregates += [F.coalesce(total.cast(EXACT), F.lit(0)).cast(EXACT).alias(f"_sum_{c}"), F.count(c).alias(f"_num_{c}")]
        return rows.groupBy(*self.group).agg(*aggregates)

    def load(self, part: str, rows: DataFrame, run: str | None = None) -> Version:
        """Set the rows of a part of the fact: new, or in place of those it had."""
        if run is not None and (done := self.table.committed(run)):
            return done
        base = self.table.latest()
        new = stage(self._partials(rows), "partials")
        change = new
        if "partials" in base.schemas and base.parts["partials"].get(part):
            old = self.table.read(base, "partials", [part])
            minus = old.select(*self.group, *[(-F.col(c)).cast(new.schema[c].dataType).alias(c) for c in self.partial])
            change = new.unionByName(minus)
        change = stage(self._added(change), "change")
        hit = _touched(change, self.group, self.n)
        totals = change
        if "totals" in base.schemas:
            totals = self._added(self.table.read(base, "totals", hit).unionByName(change))
        total = self.table.write(totals.where("_rows <> 0"), "totals", bucket_of(self.group, self.n))
        own = self.table.write(new, "partials")
        parts = dict(base.parts)
        parts["partials"] = {**parts.get("partials", {}), part: own.parts[""]}
        parts["totals"] = replaced(parts.get("totals", {}), hit, total.parts)
        return self.table.commit(base, f"load {part}", parts, {"partials": own.schema.jsonValue(), "totals": total.schema.jsonValue()}, own.rows, run)

    def _added(self, partials: DataFrame) -> DataFrame:
        return partials.groupBy(*self.group).agg(*[F.sum(c).cast(partials.schema[c].dataType).alias(c) for c in self.partial])

    def read(self, ndigits: int | None = None, version: Version | int | None = None) -> DataFrame:
        """The mart: sums as integers, averages as doubles (rounded half-up to ``ndigits``, if given). Null where no value is."""

        def value(kind: str, c: str) -> Column:
            total, n = F.col(f"_sum_{c}"), F.col(f"_num_{c}")
            if kind == "sum":
                return F.when(n > 0, total).cast("bigint")
            mean = F.when(n > 0, total / n)
            return (mean if ndigits is None else F.round(mean, ndigits)).cast("double")

        return self.table.read(version, "totals").select(*self.group, *[value(*how).alias(name) for name, how in self.measures.items()])


WEEKLY = {"total_streams": ("sum", "streams"), "avg_rank": ("avg", "rank")}
ARTIST = {**WEEKLY, "avg_popularity": ("avg", "popularity_score")}
