"""Near-duplicate documents by ProbMinHash.

The weight of a shingle (five words in a row) is how often the text holds it, and the
similarity is the probability Jaccard of the weights,
``J_P(x, y) = sum_i 1 / sum_j max(x_j / x_i, y_j / y_i)`` over the shared shingles: the
chance that an exponential race over each text's shingles has the same winner. Where no
shingle repeats it is the ordinary Jaccard similarity.

1. Each shingle is a Poisson process whose rate is its weight; its arrivals, drawn from
   its hash, hit random registers, and each register keeps its earliest arrival. A shingle
   stops as soon as its next arrival is later than all registers hold. Two registers agree
   with probability ``J_P``.
2. Texts with equal shingles become one. Bands of registers put the rest into buckets;
   buckets with the same members count once. In a bucket, members whose signatures agree
   in six tenths of the registers or more are joined (at 0.8 that is missed once in
   millions of pairs). Large buckets are dealt into pairs of blocks.
3. The texts of each group so joined meet (again in pairs of blocks) and their ``J_P`` is
   computed exactly from the whole texts. Pairs of ``threshold`` or more link.
4. Links and equal texts form classes, named after the smallest id.

A task emits one row per member, never the pairs of a group.

Defined cases: a text of one to four words is one shingle; a text without words (null or
empty too) is alone in its class; a null id is alone in a class without a name and is
kept; rows that share an id are one document, all kept or none; other columns do not
matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.session import stage

from . import text as T
from .graph import Union, block_pairs, components

WORDS = 5
THRESHOLD = 0.8
REGISTERS = 96
BAND = 4  # registers of a band: at 0.8 all 24 bands differ in 3 of a million pairs
PLAUSIBLE = 0.6
BLOCK = 1000
TOGETHER = 3 << 20  # bytes of text signed at once


def shingles(texts: pa.Array, words: int = WORDS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, hash and count of the distinct shingles of each text, in that order."""
    w = T.words_of(texts)
    hashes = w.hashes(0)
    at, found = w.windows(hashes, words)
    n = np.diff(w.first)
    short = np.flatnonzero((n > 0) & (n < words))
    row = np.concatenate([w.row[at], short])
    found = np.concatenate([found, T.runs_hash(hashes, w.first[short], w.first[short + 1])])
    order = np.lexsort((found, row))
    row, found = row[order], found[order]
    new = np.ones(len(row), dtype=bool)
    new[1:] = (row[1:] != row[:-1]) | (found[1:] != found[:-1])
    first = np.flatnonzero(new)
    return row[first], found[first], np.diff(np.append(first, len(row)))


def signatures(row: np.ndarray, found: np.ndarray, count: np.ndarray, n_rows: int, registers: int = REGISTERS) -> np.ndarray:
    """The registers of each row: the hash of the shingle that arrives first in each."""
    best = np.full(n_rows * registers, np.inf)
    winner = np.zeros(n_rows * registers, dtype=np.uint64)
    time = np.zeros(len(row))
    turn = 0
    while len(row):
        turn += 1
        draw = T.mix(found + np.uint64(turn * 0xD1B54A32D192ED03 & (2**64 - 1)))
        time = time - np.log(T.uniform(draw)) / count
        latest = best.reshape(n_rows, registers).max(axis=1)
        going = time < latest[row]  # the others can change no register any more
        row, found, count, time, draw = row[going], found[going], count[going], time[going], draw[going]
        slot = row * registers + (T.mix(draw) % np.uint64(registers)).astype(np.int64)
        won = np.flatnonzero(time < best[slot])
        won = won[np.argsort(-time[won], kind="stable")]  # of several, the earliest is written last
        best[slot[won]] = time[won]
        winner[slot[won]] = found[won]
    return winner.reshape(n_rows, registers)


def probability_jaccard(a: np.ndarray, x: np.ndarray, b: np.ndarray, y: np.ndarray) -> float:
    """``J_P`` of two weighted sets: sorted hashes ``a``, ``b`` with positive weights ``x``, ``y``."""
    both, i, j = np.intersect1d(a, b, assume_unique=True, return_indices=True)
    if not len(both):
        return 0.0
    if x.max() == x.min() and y.max() == y.min():
        return len(both) / (len(a) + len(b) - len(both))
    x, y = x / x.sum(), y / y.sum()
    p, q = x[i], y[j]
    order = np.argsort(p / q, kind="stable")
    p, q = p[order], q[order]
    ratio = p / q
    # shingles of one text only: x_j / x_i counts where y_j = 0, and the other way round
    only_x, only_y = x.sum() - p.sum(), y.sum() - q.sum()
    above, below = np.cumsum(p[::-1])[::-1], np.cumsum(q) - q
    lead = np.searchsorted(ratio, ratio, side="left")  # equal ratios give equal terms on either side
    return float(np.sum(1.0 / ((above[lead] + only_x) / p + (below[lead] + only_y) / q)))


def _signed(docs: DataFrame, words: int, registers: int, band: int) -> DataFrame:
    """``id, content, bands, sig`` of every document that has words."""
    own = docs.where("_id > -9223372036854775808")

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.chunks(batch, "_text", TOGETHER):
                parts, rows_before = [], 0
                for part in T.chunks(piece, "_text"):  # hashed a little at a time, signed together
                    row, found, count = shingles(part.column("_text"), words)
                    parts.append((row + rows_before, found, count))
                    rows_before += part.num_rows
                row, found, count = (np.concatenate(x) for x in zip(*parts))
                if not len(row):
                    continue
                has = np.unique(row)
                at = np.searchsorted(has, row)
                sig = signatures(at, found, count.astype(np.float64), len(has), registers)
                cut = np.searchsorted(at, np.arange(len(has) + 1))
                # two sums over the shingles and their counts name the content
                content = [np.add.reduceat(T.mix(T.mix(found + np.uint64(k)) + count.astype(np.uint64)), cut[:-1]).view(np.int64) for k in (1, 2)]
                bands = np.stack([T.runs_hash(sig.ravel(), s := np.arange(len(has)) * registers + k * band, s + band) + np.uint64(k)
                                  for k in range(registers // band)], axis=1)
                ids = np.asarray(piece.column("_id"), dtype=np.int64)[has]
                short = (sig & np.uint64(0xFFFF)).astype(np.uint16)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids), pa.array(content[0]), pa.array(content[1]),
                     pa.ListArray.from_arrays(np.arange(len(has) + 1, dtype=np.int32) * bands.shape[1], T.mix(bands.ravel()).view(np.int64)),
                     pa.array([x.tobytes() for x in short], pa.binary())], ["id", "c1", "c2", "bands", "sig"])

    return own.mapInArrow(sign, "id long, c1 long, c2 long, bands array<long>, sig binary")


def _plausible(signed: DataFrame, plausible: float, block: int) -> DataFrame:
    """``a, b``: links that join the members of each bucket whose signatures mostly agree."""
    keys = signed.select("id", F.explode("bands").alias("key"))
    buckets = keys.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("lo"), F.max("id").alias("hi"),
                                      F.sum(F.xxhash64("id") % F.lit(1 << 40)).alias("s"))
    once = buckets.where("n > 1").groupBy("n", "lo", "hi", "s").agg(F.min("key").alias("key")).select("key")
    members = keys.join(once, "key").join(signed.select("id", "sig"), "id")
    dealt = block_pairs(stage(members, "buckets"), "key", "id", block)
    dealt = dealt.withColumn("_task", F.when((F.col("_x") == 0) & (F.col("_y") == 0), F.pmod(F.xxhash64("key"), F.lit(4096)))
                             .otherwise(F.xxhash64("key", "_x", "_y")))

    def join(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        out = []
        own = own.sort_values(["key", "_x", "_y", "id"], kind="stable")
        cuts = np.flatnonzero((np.diff(own["key"]) != 0) | (np.diff(own["_x"]) != 0) | (np.diff(own["_y"]) != 0)) + 1
        ids = own["id"].to_numpy()
        for at in np.split(np.arange(len(own)), cuts):
            sig = np.frombuffer(b"".join(own["sig"].iloc[at]), dtype=np.uint16).reshape(len(at), -1)
            near = np.zeros((len(at), len(at)), dtype=bool)
            for i in range(len(at)):
                near[i] = (sig == sig[i]).mean(axis=1) >= plausible
            union = Union(len(at))
            union.link_all(near)
            root = union.roots()
            far = root != np.arange(len(at))
            out.append(np.stack([ids[at][root[far]], ids[at][far]], axis=1))
        links = np.concatenate(out)
        return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})

    return dealt.groupBy("_task").applyInPandas(join, "a long, b long")


def _similar(rows: list[tuple[np.ndarray, np.ndarray]], side: np.ndarray, threshold: float) -> np.ndarray:
    """Root of each text of a block by the pairs of ``threshold`` or more; pairs on one side of a
    pair of blocks are left to the block's own task."""
    n = len(rows)
    union = Union(n)
    size = np.array([len(a) for a, _ in rows])
    flat = np.array([x.max() == x.min() for _, x in rows])
    _, column, seen = np.unique(np.concatenate([a for a, _ in rows]), return_inverse=True, return_counts=True)
    doc = np.repeat(np.arange(n), size)
    mass = np.concatenate([x / x.sum() for _, x in rows])
    shared = seen[column] > 1
    order = np.argsort(column[shared], kind="stable")
    column, doc, mass = column[shared][order], doc[shared][order], mass[shared][order]
    common, held = np.zeros((n, n), dtype=np.float32), np.zeros((n, n))  # shared shingles; their share of the row's mass
    renamed = np.cumsum(np.append(True, np.diff(column) != 0)) - 1 if len(column) else column
    width = max(1, 4_000_000 // n)
    for low in range(0, int(renamed[-1]) + 1 if len(renamed) else 0, width):
        a, b = np.searchsorted(renamed, [low, low + width])
        present = np.zeros((n, width), dtype=np.float32)
        weight = np.zeros((n, width), dtype=np.float32)
        present[doc[a:b], renamed[a:b] - low] = 1
        weight[doc[a:b], renamed[a:b] - low] = mass[a:b]
        common += present @ present.T
        held += weight @ present.T
    jaccard = common / np.maximum(size[:, None] + size[None, :] - common, 1)
    other = np.ones((n, n), dtype=bool) if len(np.unique(side)) == 1 else side[:, None] != side[None, :]
    plain = flat[:, None] & flat[None, :]
    union.link_all(plain & other & (jaccard >= threshold - 1e-9))
    # J_P is at most the mass that either text has on shared shingles
    maybe = np.triu(other & ~plain & (held >= threshold - 1e-4) & (held.T >= threshold - 1e-4), 1)
    for i, j in zip(*np.nonzero(maybe)):
        if union.find(i) != union.find(j) and probability_jaccard(*rows[i], *rows[j]) >= threshold - 1e-12:
            union.link(int(i), int(j))
    return union.roots()


def _verified(texts: DataFrame, groups: DataFrame, words: int, threshold: float, block: int) -> DataFrame:
    """``a, b``: links that span the pairs of ``threshold`` or more within each group of texts."""
    dealt = block_pairs(groups, "component", "node", block)
    dealt = dealt.withColumn("_task", F.when((F.col("_x") == 0) & (F.col("_y") == 0), F.pmod(F.xxhash64("component"), F.lit(8192)))
                             .otherwise(F.xxhash64("component", "_x", "_y")))
    # one plan at every size: the texts meet their groups in a sort-merge join
    rows = texts.join(dealt.withColumnRenamed("node", "_id").hint("merge"), "_id").drop("_th")

    def check(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        out = [np.zeros((0, 2), dtype=np.int64)]
        own = own.drop_duplicates(["component", "_x", "_y", "_id"]).sort_values(["component", "_x", "_y", "_id"], kind="stable")
        ids, side = own["_id"].to_numpy(), own["_block"].to_numpy()
        row, found, count = shingles(pa.array(own["_text"], pa.large_string()), words)
        cut = np.searchsorted(row, np.arange(len(own) + 1))
        sets = [(found[a:b], count[a:b].astype(np.float64)) for a, b in zip(cut[:-1], cut[1:])]
        cuts = np.flatnonzero((np.diff(own["component"]) != 0) | (np.diff(own["_x"]) != 0) | (np.diff(own["_y"]) != 0)) + 1
        for at in np.split(np.arange(len(own)), cuts):
            if len(at) == 2:
                if probability_jaccard(*sets[at[0]], *sets[at[1]]) >= threshold - 1e-12:
                    out.append(ids[at][None, :])
            elif len(at) > 2:
                root = _similar([sets[i] for i in at], side[at], threshold)
                far = root != np.arange(len(at))
                out.append(np.stack([ids[at][root[far]], ids[at][far]], axis=1))
        links = np.concatenate(out)
        return pd.DataFrame({"a": links[:, 0], "b": links[:, 1]})

    return rows.groupBy("_task").applyInPandas(check, "a long, b long")


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, threshold: float = THRESHOLD,
            registers: int = REGISTERS, band: int = BAND, plausible: float = PLAUSIBLE, block: int = BLOCK) -> DataFrame:
    """``node, component``: the class of each document that is in a class with another."""
    texts = T.keyed(docs, id_col, text_col)
    signed = stage(_signed(texts, words, registers, band), "signed")
    name = signed.groupBy("c1", "c2").agg(F.min("id").alias("first"), F.count("*").alias("n"))
    equal = stage(signed.select("id", "c1", "c2").join(name.where("n > 1"), ["c1", "c2"]).select(F.col("first").alias("a"), F.col("id").alias("b")).where("a < b"), "equal")
    alone = signed.join(equal.select(F.col("b").alias("id")).distinct(), "id", "left_anti").dropDuplicates(["id"])
    groups = stage(components(_plausible(stage(alone.select("id", "bands", "sig"), "alone"), plausible, block)), "groups")
    near = _verified(texts, groups, words, threshold, block)
    return components(equal.union(near))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One row per input row: ``doc_id, class_id`` (smallest id of the class), ``kept``."""
    found = stage(classes(docs, id_col, text_col, **options), "classes")
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    out = ids.join(found.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", F.coalesce("component", "doc_id").alias("class_id"),
                      F.coalesce(F.col("component") == F.col("doc_id"), F.lit(True)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
