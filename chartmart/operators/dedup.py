"""Duplicate handling: purge (delete every row of a repeated key), keep-one, latest per key.

One algorithm at every size. Wide rows are never grouped as they are: a narrow pass groups
hashes of the compared columns (partially aggregated on the map side, so a hot group is
combined before the shuffle), and only rows of repeated hashes are grouped by the columns
themselves, which rules collisions out. Sets of keys are written once and joined; whether
such a join broadcasts is the planner's choice, from the size of the written files.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def duplicate_groups(df: DataFrame, compare_cols: Sequence[str], count_col: str = "n_copies") -> DataFrame:
    """Groups of rows equal on ``compare_cols`` (NULLs equal, like PARTITION BY) that occur
    more than once, with their size."""
    return (df.groupBy(*compare_cols).agg(F.count(F.lit(1)).alias(count_col))
            .filter(F.col(count_col) > 1))


def _hashes(columns: Sequence[str]) -> list[Column]:
    return [F.xxhash64(*columns).alias("_h1"), F.hash(*columns).alias("_h2")]


MOST_BROADCAST = 2_000_000  # narrow rows that are broadcast


def _may_broadcast(df: DataFrame) -> bool:
    return df.sparkSession.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) != "-1"


def if_small(df: DataFrame, most: int | None = None) -> DataFrame:
    """A stored narrow set of keys, marked for broadcast if it has few rows (``MOST_BROADCAST`` by default), so that wide
    rows stay where they are; otherwise, and in a session whose adaptive joins may not broadcast, the planner chooses."""
    if not _may_broadcast(df):
        return df
    return F.broadcast(df) if df.count() <= (MOST_BROADCAST if most is None else most) else df


FILTER_BITS = 27  # the filter of a larger set has 2 to this power bits: at most 2 million words of 64 bits are broadcast


def by_keys(df: DataFrame, keys: DataFrame, columns: Sequence[str], how: str) -> DataFrame:
    """``left_semi`` or ``left_anti`` join with a stored narrow set of keys that is made of rows of ``df``.

    A set too large to broadcast does not make all rows shuffle: a filter of its hashes is broadcast instead, and the rows
    that it lets through, those of the set and a few others, are joined with the set itself. ``df`` is then read twice.
    """
    joined = lambda rows, keys: rows.join(keys, [rows[k] == keys[k] for k in columns], how)
    if not _may_broadcast(df):
        return joined(df, keys)
    if keys.count() <= MOST_BROADCAST:
        return joined(df, F.broadcast(keys))
    h = F.xxhash64(*columns)
    word, bit = F.shiftrightunsigned(h, 64 - FILTER_BITS + 6), h.bitwiseAND(F.lit(63)).cast("int")
    words = keys.select(word.alias("_word"), F.call_function("shiftleft", F.lit(1).cast("bigint"), bit).alias("_bits"))
    words = F.broadcast(words.groupBy("_word").agg(F.bit_or("_bits").alias("_bits")))
    marked = df.join(words, word == words["_word"], "left")
    hit = F.coalesce(F.call_function("shiftrightunsigned", F.col("_bits"), bit).bitwiseAND(F.lit(1)) == 1, F.lit(False))
    some = joined(marked.where(hit).select(*df.columns), keys)
    return some if how == "left_semi" else marked.where(~hit).select(*df.columns).unionByName(some)


def suspects(df: DataFrame, compare_cols: Sequence[str], hashed: bool = False) -> DataFrame:
    """The rows of ``df`` whose compared columns share both hashes with another row's: all
    rows of repeated groups, and (rarely) rows that merely collide. ``df`` is read twice.
    ``hashed``: ``df`` has ``_hashes`` of the compared columns already."""
    from chartmart.session import stage

    tagged = df if hashed else df.select("*", *_hashes(compare_cols))
    pairs = tagged.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    pairs = stage(pairs.filter(F.col("_n") > 1).select("_h1", "_h2"), "repeated_hashes")
    return by_keys(tagged, pairs, ["_h1", "_h2"], "left_semi").select(*df.columns)


def flag_duplicates(df: DataFrame, compare_cols: Sequence[str], key_cols: Sequence[str],
                    count_col: str = "n_copies") -> DataFrame:
    """Keys of repeated groups with the number of surplus copies (rows a ROW_NUMBER>1 would flag)."""
    compare_cols, key_cols = list(compare_cols), list(key_cols)
    g = duplicate_groups(suspects(df, compare_cols), compare_cols, "_n")
    return (g.groupBy(*key_cols).agg(F.sum(F.col("_n") - 1).cast("bigint").alias(count_col)))


def purge_duplicated_keys(df: DataFrame, key_cols: Sequence[str], compare_cols: Sequence[str], store: str | None = None) -> DataFrame:
    """Delete *every* row whose key belongs to a repeated group (DELETE ... WHERE key IN (...)).

    Grouping treats NULLs as equal, the delete test does not: a row with a NULL key part
    is never deleted. That is exactly a ``left_anti`` join on the key columns (null-unaware),
    never ``NOT IN``. ``df`` is read three times; pass a staged (materialised) input, or its name
    as ``store``: then ``df`` is staged here, its hashes with it, and the pass that counts them reads nothing else.
    """
    from chartmart.session import stage

    key_cols, compare_cols = list(key_cols), list(compare_cols)
    by, names = list(dict.fromkeys([*compare_cols, *key_cols])), df.columns
    if store:
        tagged = stage(df.select("*", *_hashes(by)), store, None, "zstd")
        found, df = suspects(tagged, by, hashed=True), tagged.select(*names)
    else:
        found = suspects(df, by)
    groups = duplicate_groups(found, by, "_n")
    return by_keys(df, stage(groups.select(*key_cols).distinct(), "dup_keys"), key_cols, "left_anti")


SLICE_ROWS = 150_000_000  # rows whose hashes are shuffled at once


def purge_in_slices(df: DataFrame, key_cols: Sequence[str], compare_cols: Sequence[str], store: str, slice_rows: int = SLICE_ROWS) -> DataFrame:
    """``purge_duplicated_keys`` for narrow rows in great number, such as a fact after its lookups: the rows are staged as
    ``store`` (so the lookups run once) without hashes, which would take more room than they do. Equal rows have equal
    hashes, so slices of the hashes are counted and confirmed one after the other, and what is shuffled at once is bounded."""
    from chartmart.session import stage

    key_cols = list(key_cols)
    by = list(dict.fromkeys([*compare_cols, *key_cols]))
    rows = stage(df, store, None, "zstd")
    n = max(1, -(-rows.count() // slice_rows))
    tagged = rows.select(*by, F.xxhash64(*by).alias("_h1"))  # collisions are few, and confirmed by the columns
    found = []
    for k in range(n):
        part = tagged.where(F.pmod(F.shiftright("_h1", 32), F.lit(n)) == k)
        hashes = part.groupBy("_h1").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1).select("_h1")
        groups = duplicate_groups(by_keys(part, stage(hashes, "repeated_hashes"), ["_h1"], "left_semi"), by, "_n")
        found.append(stage(groups.select(*key_cols).distinct(), "dup_keys"))
    return by_keys(rows, reduce(DataFrame.unionByName, found), key_cols, "left_anti")


def drop_exact_duplicates(df: DataFrame, cols: Sequence[str] | None = None,
                          order: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per ``cols`` group. Without ``order`` any row of the group is kept (all
    equal when ``cols`` is every column); with ``order`` the row smallest in that order wins."""
    if cols is None or set(cols) == set(df.columns):
        return df.dropDuplicates()
    if order is None:
        return df.dropDuplicates(list(cols))
    return first_per_wide_key(df, cols, order, descending=False)


def first_per_wide_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = True) -> DataFrame:
    """``first_per_key`` that does not shuffle long keys (whole texts) of rows that are alone.

    A narrow pass counts the hash pairs of the key. A row whose pair is unique is the only
    row of its key and passes through; rows of repeated pairs are grouped by the key itself.
    ``df`` is read three times.
    """
    from chartmart.session import stage

    keys = list(keys)
    tagged = df.select("*", *_hashes(keys))
    pairs = tagged.groupBy("_h1", "_h2").agg(F.count(F.lit(1)).alias("_n"))
    pairs = stage(pairs.filter(F.col("_n") > 1).select("_h1", "_h2"), "repeated_hashes")
    singles = tagged.join(pairs, ["_h1", "_h2"], "left_anti").select(*df.columns)
    repeats = tagged.join(pairs, ["_h1", "_h2"], "left_semi").select(*df.columns)
    return singles.unionByName(first_per_key(repeats, keys, order, descending))


def first_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str], descending: bool = True) -> DataFrame:
    """One row per key: the greatest (``descending``) or smallest in ``order``.

    Expressed as ``max``/``min`` of a struct (order columns first, then the payload). Spark runs
    it as a sort aggregate with a partial step, so each task sends one row per key and a hot key
    is reduced before the shuffle, where a window would bring all its rows together.
    NULL order values rank lowest, as ORDER BY ... DESC NULLS LAST.
    """
    keys = list(keys)
    payload = [c for c in df.columns if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(c) for c in payload])
    pick = F.max(packed) if descending else F.min(packed)
    best = df.groupBy(*keys).agg(pick.alias("_best"))
    return best.select(*[F.col(k) for k in keys], *[F.col(f"_best.{c}").alias(c) for c in payload]).select(*df.columns)


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """QUALIFY ROW_NUMBER() OVER (PARTITION BY keys ORDER BY order DESC) = 1.

    When every order term is a plain column sorted descending, the struct-max form is used;
    other orders fall back to a window.
    """
    if all(isinstance(o, str) for o in order):
        return first_per_key(df, keys, list(order), descending=True)
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")
