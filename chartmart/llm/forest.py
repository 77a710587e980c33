"""Embedding near-dedup by a forest of random-projection trees.

1. ``trees`` trees are fitted on a sample of at most ``sample`` vectors: a node is split at
   the median of a random projection, and vectors within ``overlap`` of its spread on
   either side of the cut go both ways (spill). A node is a leaf when its share of the
   sample stands for ``leaf`` vectors or fewer of all, when the sample gets thin, or when
   its vectors are so alike that a cut would part neighbours. Every vector, sampled or
   not, is sent down all trees.
2. Within a leaf all pairs are compared by cosine in double precision. Large leaves are
   dealt into pairs of blocks. A pair that meets in several leaves counts in the first one
   only: each vector carries the leaves it is in.
3. A leaf returns, per vector, the number of its new links, and links that span those
   found, never the pairs; the counts are summed and the links joined into components.

The trees hold at most ``2 * sample / least`` nodes each, whatever the number of vectors.

Defined cases: vectors that are null, empty, zero, of another length than most, or hold a
null or non-finite component link with nothing; equal vectors link; rows that share an id
count as vectors of their own, with the id's component; a null id links with nothing and
is kept with a null component; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.session import stage

from .graph import Union, block_pairs, components

COSINE = 0.9
TREES = 8
LEAF = 600
SAMPLE = 16384
LEAST = 24  # sampled vectors in a leaf
OVERLAP = 0.12
ALIKE = 0.8  # mean cosine of a node's vectors that makes it a leaf
BLOCK = 2000


class Tree:
    """Splits as arrays: direction, cut and margin of inner nodes; children, or a leaf number below zero."""

    def __init__(self, vectors: np.ndarray, leaf: float, seed: int, overlap: float):
        self.directions, self.cuts, self.margins, self.children, self.leaves = [], [], [], [], 0
        self._grow(vectors, leaf, np.random.default_rng(seed), overlap, 0)
        width = vectors.shape[1]
        self.directions = np.array(self.directions, dtype=np.float64).reshape(-1, width)

    def _grow(self, own: np.ndarray, leaf: float, rng: np.random.Generator, overlap: float, depth: int) -> int:
        mean = own.mean(axis=0) if len(own) else own.sum(axis=0)
        if len(own) <= max(leaf, 2 * LEAST) or depth > 40 or mean @ mean >= ALIKE:
            self.leaves += 1
            return -self.leaves
        direction = rng.standard_normal(own.shape[1])
        direction /= np.linalg.norm(direction)
        at = own @ direction
        cut, margin = float(np.median(at)), overlap * float(at.std())
        if not ((at < cut - margin).any() and (at > cut + margin).any()):
            self.leaves += 1
            return -self.leaves
        node = len(self.cuts)
        self.directions.append(direction)
        self.cuts.append(cut)
        self.margins.append(margin)
        self.children.append([0, 0])
        # the children are grown without the spill, so that sizes halve; vectors spill when sent down
        left = self._grow(own[at <= cut], leaf, rng, overlap, depth + 1)
        right = self._grow(own[at > cut], leaf, rng, overlap, depth + 1)
        self.children[node] = [left, right]
        return node

    def leaves_of(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, leaf) pairs."""
        if not len(self.cuts):
            return np.arange(len(vectors)), np.zeros(len(vectors), dtype=np.int64)
        rows, leaves, todo = [], [], [(0, np.arange(len(vectors)))]
        while todo:
            node, own = todo.pop()
            if node < 0:
                rows.append(own)
                leaves.append(np.full(len(own), -node - 1))
            elif len(own):
                at = vectors[own] @ self.directions[node]
                todo.append((self.children[node][0], own[at <= self.cuts[node] + self.margins[node]]))
                todo.append((self.children[node][1], own[at >= self.cuts[node] - self.margins[node]]))
        return np.concatenate(rows), np.concatenate(leaves)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which rows are usable vectors, and those rows at unit length in double precision."""
    x = x.astype(np.float64)
    scale = np.abs(x).max(axis=1, initial=0)
    good = np.isfinite(x).all(axis=1) & (scale > 0)
    y = x[good] / scale[good, None]  # so that no square overflows or vanishes
    return good, y / np.sqrt((y * y).sum(axis=1, keepdims=True))


def _matrix(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows of a list column that have ``width`` components, and their components (null: NaN)."""
    size = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False)
    right = np.flatnonzero(size == width)
    flat = pc.list_flatten(vectors.take(pa.array(right)))
    return right, flat.to_numpy(zero_copy_only=False).reshape(-1, width)


def _vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return rows.select(F.col(id_col).cast("long").alias("id"), F.col(vector_col).alias("v")).where("id is not null")


def grow(rows: DataFrame, width: int, trees: int, leaf: int, sample: int, overlap: float, seed: int = 11) -> list[Tree]:
    """Trees fitted on a sample of the vectors by a hash of the id."""
    n = rows.where(F.size("v") == width).count()
    part = rows.where(F.size("v") == width)
    if n > sample:
        part = part.where(F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(n)) < int(sample * 0.95))
    found = part.orderBy(F.xxhash64("id")).limit(sample).toPandas()
    held = pa.array(list(found["v"]), pa.list_(pa.float64())) if len(found) else pa.array([], pa.list_(pa.float64()))
    x = _unit(_matrix(held, width)[1])[1]
    return [Tree(x, leaf * len(x) / max(n, 1), seed + k, overlap) for k in range(trees)] if len(x) else []


def _leaves(rows: DataFrame, width: int, trees, kind: str) -> DataFrame:
    """``id, v, leaves, leaf``: a row for each vector and leaf, with all leaves of the vector."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            right, given = _matrix(batch.column("v"), width)
            usable, x = _unit(given)
            if not len(x):
                continue
            right, given = right[usable], given[usable]
            pairs = [t.leaves_of(x) for t in trees.value]
            base = np.cumsum([0] + [max(1, t.leaves) for t in trees.value])
            row = np.concatenate([p[0] for p in pairs])
            leaf = np.concatenate([p[1] + b for p, b in zip(pairs, base)]).astype(np.int32)
            order = np.lexsort((leaf, row))
            row, leaf = row[order], leaf[order]
            edge = np.searchsorted(row, np.arange(len(x) + 1))
            lists = [leaf[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])]
            raw = [v.astype(kind).tobytes() for v in given]
            ids = np.asarray(batch.column("id"), dtype=np.int64)[right]
            for low in range(0, len(row), 20_000):
                at = row[low : low + 20_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[at]), pa.array([raw[i] for i in at], pa.binary()), pa.array([lists[i] for i in at], pa.binary()), pa.array(leaf[low : low + 20_000])],
                    ["id", "v", "leaves", "leaf"])

    return rows.mapInArrow(send, "id long, v binary, leaves binary, leaf int")


def _pairs(dealt: DataFrame, cosine: float, kind: str) -> DataFrame:
    """``id, n, root``: the new links of each vector in a leaf and a vector it is linked with there."""

    def compare(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        leaf = int(key[0])
        own = own.sort_values(["id", "_block"], kind="stable")
        ids, side = own["id"].to_numpy(), own["_block"].to_numpy()
        _, x = _unit(np.frombuffer(b"".join(own["v"]), dtype=kind).reshape(len(own), -1))
        linked = x @ x.T >= cosine
        np.fill_diagonal(linked, False)
        if key[1] != key[2]:
            linked &= side[:, None] != side[None, :]
        # leaves of lower number that two vectors share have counted the pair
        lists = [np.frombuffer(b, dtype=np.int32) for b in own["leaves"]]
        size = [int(np.searchsorted(b, leaf)) for b in lists]
        names, column = np.unique(np.concatenate([b[:k] for b, k in zip(lists, size)]), return_inverse=True)
        member = np.repeat(np.arange(len(own)), size)
        busy = np.flatnonzero(linked.any(axis=1))
        place = np.full(len(own), -1)
        place[busy] = np.arange(len(busy))
        kept = place[member] >= 0
        held = np.zeros((len(busy), len(names)), dtype=np.float32)
        held[place[member[kept]], column[kept]] = 1
        new = linked[np.ix_(busy, busy)] & ((held @ held.T) == 0)
        union = Union(len(busy))
        union.link_all(new)
        return pd.DataFrame({"id": ids[busy], "n": new.sum(axis=1), "root": ids[busy][union.roots()]})

    return dealt.groupBy("leaf", "_x", "_y").applyInPandas(compare, "id long, n long, root long")


def links(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = COSINE, trees: int = TREES, leaf: int = LEAF,
          sample: int = SAMPLE, overlap: float = OVERLAP, block: int = BLOCK) -> DataFrame:
    """One row per vector: ``vec_id, n_links, component_id, kept``."""
    own = _vectors(rows, id_col, vector_col)
    widths = own.groupBy(F.size("v").alias("w")).count().where("w > 0").orderBy(F.desc("count"), "w").limit(1).collect()
    width = widths[0]["w"] if widths else 1
    forest = rows.sparkSession.sparkContext.broadcast(grow(own, width, trees, leaf, sample, overlap))
    kind = "f4" if own.schema["v"].dataType.elementType.simpleString() == "float" else "f8"  # sent as they come
    found = _pairs(block_pairs(stage(_leaves(own, width, forest, kind), "leaves"), "leaf", "id", block), cosine, kind)
    found = stage(found.where("n > 0 or root <> id"), "found")
    counts = found.groupBy("id").agg(F.sum("n").alias("n_links"))
    parts = components(found.select(F.col("root").alias("a"), F.col("id").alias("b"))).withColumnRenamed("node", "id")
    out = rows.select(F.col(id_col).cast("long").alias("id")).join(counts, "id", "left").join(parts, "id", "left")
    return out.select(F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component", "id").alias("component_id"),
                      F.coalesce(F.col("component") == F.col("id"), F.lit(True)).alias("kept"))


def query(spark, sf_dir: str) -> DataFrame:
    return links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE_SQL = f"""
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
p AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= {COSINE}),
n AS (SELECT a AS vec_id, count(*) AS n_links FROM p GROUP BY a),
reach(vec_id, other) AS (SELECT a, b FROM p UNION SELECT r.vec_id, p.b FROM reach r JOIN p ON p.a = r.other),
c AS (SELECT vec_id, least(min(other), vec_id) AS component_id FROM reach GROUP BY vec_id)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM v LEFT JOIN n USING (vec_id) LEFT JOIN c USING (vec_id)
"""
