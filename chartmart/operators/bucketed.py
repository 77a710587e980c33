"""MERGE and purge into stored tables that touch only the buckets that a load touches.

``merge_into``  a dimension laid out by the hash of its merge keys: the buckets that the
                source's keys fall into are read, merged and written anew; the files of all others are
                taken over into the next version by name.
``PurgeIndex``  the purge of repeated rows over appended loads: fingerprints of all rows ever
                loaded are kept in buckets, so a load is compared with the buckets it touches and not with
                the rows of earlier loads.

Both commit once (``sources.commits``): a load that dies leaves the table as it was, one that
is run again under its label does nothing, and of two at once one gets ``Conflict``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.operators.dedup import by_keys
from chartmart.operators.keys import assign_from_sequence
from chartmart.operators.upsert import merge_upsert
from chartmart.session import stage
from chartmart.sources import commits
from chartmart.sources.commits import CommittedTable, Version, Written, added, replaced

BUCKETS = 64
SLICE_ROWS = 25_000_000  # rows of a load that are shuffled at once


def bucket_of(columns: Sequence[str | Column], n: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(n)).cast("int")


def _touched(rows: DataFrame, columns: Sequence[str | Column], n: int) -> list[int]:
    """The buckets that rows fall into, at most ``n`` numbers."""
    return sorted(r[0] for r in rows.select(bucket_of(columns, n)).distinct().collect())


# ---------------------------------------------------------------- merge

def store_dimension(table: CommittedTable, dim: DataFrame, keys: Sequence[str], n: int = BUCKETS, run: str | None = None) -> Version:
    """Full load of a dimension, laid out by the hash of ``keys`` for ``merge_into``."""
    return table.replace(dim, run=run, bucket=bucket_of(keys, n), properties={"keys": list(keys), "buckets": n})


def merge_into(table: CommittedTable, source: DataFrame, on: Sequence[tuple[str, str]], set_: Mapping[str, Column], insert: Mapping[str, Column],
               key: str, sequence: commits.Sequence, fresher: tuple[str, str] | None = None, on_stale: str = "skip",
               insert_order: Sequence[str] | None = None, run: str | None = None) -> Version:
    """``merge_upsert`` of ``source`` (staged: it is read several times) into a stored dimension, as its next version.

    New rows take their keys from ``sequence``. ``on`` starts with the columns that the dimension is laid out by.
    A source without rows, or a ``run`` that is committed already, changes nothing.
    """
    if run is not None and (done := table.committed(run)):
        return done
    base = table.latest()
    n, keys = base.properties["buckets"], base.properties["keys"]
    if [t for t, _ in on][: len(keys)] != keys:
        raise ValueError(f"the dimension is laid out by {keys}, the merge is on {[t for t, _ in on]}")
    # hashes depend on the type: the source's keys are read as the target's
    types = table.read(base, buckets=[]).schema
    by_key = dict((t, s) for t, s in on)
    hit = _touched(source, [F.col(by_key[k]).cast(types[k].dataType) for k in keys], n)
    if not hit:
        return base
    number = lambda rows, order: assign_from_sequence(rows, order, key, sequence)
    merged = merge_upsert(table.read(base, buckets=hit), source, on, set_, insert, key, fresher, on_stale, insert_order, number=number)
    new = table.write(merged, bucket=bucket_of(keys, n))
    return table.commit(base, "merge", {"": replaced(base.parts[""], hit, new.parts)}, base.schemas, new.rows, run)


# ---------------------------------------------------------------- purge over appended loads

class PurgeIndex:
    """Rows of many loads without those whose key belongs to a repeated group, as one purge of their union has them.

    Three families are committed together:

    ``prints``  ``_h1, _h2, _n``: how many rows with this fingerprint (128 bits of all compared
                columns and the key) a load brought, by bucket of ``_h1``; all its entries count together;
    ``dead``    the keys of repeated groups, by bucket of the key: later rows with such a key go too;
    ``rows``    the rows that stay, by bucket of the key.

    A load reads the buckets of ``prints`` and ``dead`` that its rows fall into. Rows of earlier
    loads are read only in the buckets of keys that die by this load, first the key columns
    alone; buckets that hold such rows are written anew, each from its own files without a shuffle, to all
    others files are added.
    Null parts of compared columns are equal, a row with a null key part is never purged.
    """

    def __init__(self, table: CommittedTable, key_cols: Sequence[str], compare_cols: Sequence[str], buckets: int = BUCKETS,
                 slice_rows: int = SLICE_ROWS):
        self.table, self.keys, self.n, self.slice_rows = table, list(key_cols), buckets, slice_rows
        self.by = list(dict.fromkeys([*compare_cols, *key_cols]))

    def _family(self, base: Version, family: str, like: DataFrame, buckets: Sequence[int] | None = None) -> DataFrame:
        return self.table.read(base, family, buckets) if family in base.schemas else like.limit(0)

    def _spread(self, rows: DataFrame, n: int) -> Written:
        """Rows written into their buckets, some buckets after the other: what is shuffled at once is bounded."""
        bucket = bucket_of(self.keys, self.n)
        done = [self.table.write(rows.where(F.pmod(bucket, F.lit(n)) == k) if n > 1 else rows, "rows", bucket) for k in range(n)]
        return Written("rows", reduce(lambda a, b: a | b, [w.parts for w in done]), done[0].schema, sum(w.rows for w in done))

    def load(self, df: DataFrame, run: str | None = None, stored: bool = False) -> Version:
        """``stored``: ``df`` reads written files, no copy is needed."""
        if run is not None and (done := self.table.committed(run)):
            return done
        base, names, keys = self.table.latest(), df.columns, self.keys
        rows = df if stored else stage(df, "load")
        # two hashes of all columns, with differing seeds; nulls count by their place. Not stored with the rows: they take more room than those
        marks = F.concat(*[F.when(F.col(c).isNull(), F.lit("0")).otherwise(F.lit("1")) for c in self.by])
        pair = [F.xxhash64(*self.by, marks).alias("_h1"), F.xxhash64(F.lit(7), marks, *reversed(self.by)).alias("_h2")]

        own = rows.select(*pair).groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
        index = self.table.write(own, "prints", bucket_of(["_h1"], self.n))
        mine = self.table.read_written(index)
        old = self._family(base, "prints", own, sorted(map(int, index.parts)))
        both = mine.withColumn("_new", F.lit(True)).unionByName(old.withColumn("_new", F.lit(False)))
        counts = both.groupBy("_h1", "_h2").agg(F.sum("_n").alias("_n"), F.max("_new").alias("_new"))
        repeated = stage(counts.where("_n > 1 and _new").select("_h1", "_h2"), "repeated")

        present = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
        tagged = rows.where(present).select(*keys, *pair)
        dying = by_keys(tagged, repeated, ["_h1", "_h2"], "left_semi").select(*keys).distinct()
        dead = self._family(base, "dead", dying, _touched(rows, keys, self.n))
        dying = stage(dying.join(dead, keys, "left_anti"), "dying")

        stay = by_keys(rows, dying, keys, "left_anti")
        if "dead" in base.schemas:
            stay = by_keys(stay, dead, keys, "left_anti")
        fresh = self._spread(stay.select(*names), max(1, -(-index.rows // self.slice_rows)))
        kept = self._family(base, "rows", stay, _touched(dying, keys, self.n))
        hit = _touched(by_keys(kept.select(*keys), dying, keys, "left_semi"), keys, self.n)
        left = {}
        if hit:
            purged = by_keys(self._family(base, "rows", stay, hit), dying, keys, "left_anti").select(*names)
            left = self.table.write(purged, "rows", bucket_of(keys, self.n), spread=False).parts

        parts, schemas = dict(base.parts), dict(base.schemas)
        parts["rows"] = added(replaced(parts.get("rows", {}), hit, left), fresh.parts)
        parts["prints"] = added(parts.get("prints", {}), index.parts)
        gone = self.table.write(dying, "dead", bucket_of(keys, self.n))
        parts["dead"] = added(parts.get("dead", {}), gone.parts)
        for w in (fresh, index, gone):
            schemas.setdefault(w.family, w.schema.jsonValue())
        return self.table.commit(base, "load", parts, schemas, fresh.rows, run)

    def rows(self, version: Version | int | None = None) -> DataFrame:
        return self.table.read(version, "rows")
