"""Substring dedup by a count-min prefilter.

A word goes if a window of ``size`` consecutive words covers it whose word sequence also
starts earlier: in a document with a smaller id, or earlier in the same document.

1. Each window is represented by its minimizer, the least hash among its ``gram``-word
   runs. Equal windows hold their minimizer at the same place, so a window that occurs
   twice has a minimizer that occurs twice. Every partition makes a count-min sketch (rows
   of cells that saturate at two) of the minimizers it selects, as sorted cell lists by
   cell range; the ranges are merged by a shuffle. The merged sketch can only
   overestimate, so no repeated window is lost.
2. The second pass over the texts keeps the windows whose minimizer is estimated as
   repeated. Each chunk settles repeats among its own windows and sends only its earliest
   occurrence of each, keyed by the minimizer; the groups compare 96-bit hashes of the
   whole windows exactly and return later occurrences as runs of starts.
3. The runs are gathered per document and joined back to the whole texts.

A passage that a third of all documents hold costs one occurrence per chunk, not per
document. The sketch is the only thing broadcast: ``sketch_bits`` bounds it whatever the
input. With more minimizers than cells it estimates more windows as repeated; the second
pass then groups more, with the same result.

Defined cases: a null text has no words; a null id sorts before all others; rows equal in
id and text are one document and have equal results; rows that share only the id are
compared by their text's hash; other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import occurrence as O
from . import text as T

SIZE = 20
GRAM = 8
DEPTH = 2  # rows of the sketch
SKETCH_BITS = 1 << 27  # most cells of a sketch row: 16 MB each
GROUP_BYTES = 8 << 20  # input text behind one group of the second pass
_RANGE = 1 << 20  # cells merged together
_MOST = np.uint64(2**64 - 1)


class _Windows:
    """Windows of a chunk: the first word and the minimizer of each."""

    def __init__(self, texts: pa.Array, size: int, gram: int):
        self.size, self.words = size, T.words_of(texts)
        self.hashes = self.words.hashes(0)
        row, n = self.words.row, len(self.words.row)
        none = np.zeros(0, dtype=np.int64)
        self.at, self.minimizer, self.selected = none, none.astype(np.uint64), none.astype(np.uint64)
        if n < size:
            return
        inside = np.flatnonzero(row[: n - size + 1] == row[size - 1 :])
        if not len(inside):
            return
        at = np.arange(n - gram + 1)
        grams = T.runs_hash(self.hashes, at, at + gram, 2)
        reach = size - gram + 1  # runs in a window
        least = O.slide(grams, reach, np.minimum)  # for windows in one row, all runs lie in it
        self.at, self.minimizer = inside, least[inside]
        # a run is selected if it is the least of a window that holds it
        of = np.zeros(len(least), dtype=np.uint64)
        of[inside] = self.minimizer
        pad = np.zeros(reach - 1, dtype=np.uint64)
        top = O.slide(np.concatenate([pad, of, pad]), reach, np.maximum)
        self.selected = grams[(grams == top[: len(grams)]) & (top[: len(grams)] > 0)]

    def second(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two hashes of the windows that start at the given words."""
        other = self.words.hashes(1)
        return T.runs_hash(self.hashes, at, at + self.size, 3), T.runs_hash(other, at, at + self.size, 1) >> np.uint64(32)


def _cells(minimizer: np.ndarray, depth: int, cells: int) -> np.ndarray:
    return T.mix(minimizer + np.uint64(depth * 0x9E3779B97F4A7C15 & (2**64 - 1))) & np.uint64(cells - 1)


def _sketch(texts: DataFrame, size: int, gram: int, cells: int) -> np.ndarray:
    """Bitmap by sketch row of the cells counted twice or more, merged over all partitions."""

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
            found = np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)
            out = []
            for d in range(DEPTH):
                cell, count = np.unique(_cells(found, d, cells), return_counts=True)
                both = np.sort(np.concatenate([cell, cell[count > 1]]))  # twice if seen twice: it saturates there
                edge = np.searchsorted(both, np.arange(0, cells + 1, _RANGE).astype(np.uint64))
                for k in range(len(edge) - 1):
                    if edge[k] < edge[k + 1]:
                        own = (both[edge[k] : edge[k + 1]] - np.uint64(k * _RANGE)).astype(np.uint32)
                        out.append((d * (cells // _RANGE) + k, own.tobytes()))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.binary())], ["part", "cells"])

        parts, held = [], 0
        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                found = _Windows(piece.column("_text"), size, gram).selected
                parts.append(found)
                held += len(found)
                if held > 2_000_000:
                    yield from flush(parts)
                    parts, held = [], 0
        yield from flush(parts)

    def merge(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        count = np.zeros(_RANGE, dtype=np.uint8)
        for blob in own["cells"]:
            cell, n = np.unique(np.frombuffer(blob, dtype=np.uint32), return_counts=True)
            count[cell] = np.minimum(2, count[cell] + n)
        return pd.DataFrame({"part": [int(key[0])], "bits": [np.packbits(count > 1).tobytes()]})

    sent = texts.mapInArrow(partition, "part int, cells binary")
    bits = np.zeros((DEPTH, cells // 8), dtype=np.uint8)
    per_row = cells // _RANGE
    for row in sent.groupBy("part").applyInPandas(merge, "part int, bits binary").collect():  # at most DEPTH * cells bits
        d, k = divmod(row["part"], per_row)
        bits[d, k * _RANGE // 8 : (k + 1) * _RANGE // 8] = np.frombuffer(row["bits"], dtype=np.uint8)
    return bits


def later_spans(texts: DataFrame, size: int = SIZE, gram: int = GRAM, sketch_bits: int = SKETCH_BITS,
                group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``_id, _th, _spans``: the words that windows which also start earlier cover.

    ``texts`` is as ``text.keyed`` gives it.
    """
    groups = O.groups_of(texts, group_bytes)
    # about one selected run for 40 bytes of text; eight cells or more for each, up to the bound
    cells = 1 << min(sketch_bits.bit_length() - 1, max(20, (groups * group_bytes // 5).bit_length()))
    sketch = texts.sparkSession.sparkContext.broadcast(_sketch(texts, size, gram, cells))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = sketch.value
        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                w = _Windows(piece.column("_text"), size, gram)
                keep = np.ones(len(w.at), dtype=bool)
                for d in range(DEPTH):
                    cell = _cells(w.minimizer, d, cells)
                    byte, bit = (cell >> np.uint64(3)).astype(np.int64), np.uint8(7) - (cell & np.uint64(7)).astype(np.uint8)
                    keep &= (bits[d, byte] >> bit) & 1 > 0
                at = w.at[keep]
                if not len(at):
                    continue
                row = w.words.row[at]
                ids = np.asarray(piece.column("_id"), dtype=np.int64)[row]
                ths = np.asarray(piece.column("_th"), dtype=np.int64)[row]
                runs = O.Runs(ids, ths, at - w.words.first[row], np.full(len(at), size), *w.second(at))
                yield O.local(runs, O.part_of(w.minimizer[keep], groups))

    return O.later_spans(texts.mapInArrow(windows, O.SENT))


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, **options) -> DataFrame:
    """``doc_id, n_words, n_removed, kept``: the words that stay, joined by one space."""
    texts = T.keyed(docs, id_col, text_col)
    joined = texts.join(later_spans(texts, size, **options), ["_id", "_th"], "left")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                w = T.words_of(piece.column("_text"))
                data, kept, left = w.data.tobytes(), [], []
                for row, blobs in enumerate(piece.column("_spans").to_pylist()):
                    a, b = int(w.first[row]), int(w.first[row + 1])
                    own = np.flatnonzero(~O.covered(blobs, b - a)) + a
                    left.append(len(own))
                    kept.append(b" ".join([data[s:e] for s, e in zip(w.start[own].tolist(), w.end[own].tolist())]))
                n = np.diff(w.first)
                ids = [None if x == T.NO_ID else x for x in piece.column("_id").to_pylist()]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(n, pa.int64()), pa.array(n - np.array(left), pa.int64()),
                                                  pa.array(kept, pa.binary()).cast(pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    return joined.select("_id", "_text", "_spans").mapInArrow(cut, "doc_id long, n_words long, n_removed long, kept string")


def query(spark, sf_dir: str) -> DataFrame:
    """Removed words of every document, with a digest of the words that stay."""
    kept = dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2(F.encode("kept", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS x FROM documents),
w AS (SELECT doc_id, unnest(x) AS w, generate_subscripts(x, 1) AS p FROM d),
g AS (SELECT doc_id, p, w, CASE WHEN count(*) OVER f = {SIZE} THEN string_agg(w, ' ') OVER f END AS g
      FROM w WINDOW f AS (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND {SIZE - 1} FOLLOWING)),
l AS (SELECT doc_id, p, w, g IS NOT NULL AND row_number() OVER (PARTITION BY g ORDER BY doc_id, p) > 1 AS later FROM g),
c AS (SELECT doc_id, p, w, max(later::INT) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN {SIZE - 1} PRECEDING AND CURRENT ROW) AS gone FROM l),
k AS (SELECT doc_id, sum(gone)::BIGINT AS n, string_agg(w, ' ' ORDER BY p) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT doc_id, len(x)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k USING (doc_id)
"""
