"""Which runs of units (words, lines) also start earlier, over all documents.

A chunk of rows settles repeats among its own runs and sends only its earliest occurrence
of each, in one row per target group; so a run that a third of all documents hold costs
one occurrence per chunk. The groups compare 96-bit hashes of the runs exactly.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

_SENT = pa.schema([("part", pa.int32()), ("ids", pa.binary()), ("ths", pa.binary()), ("starts", pa.binary()),
                   ("sizes", pa.binary()), ("h1", pa.binary()), ("h2", pa.binary()), ("later", pa.bool_())])
SENT = "part int, ids binary, ths binary, starts binary, sizes binary, h1 binary, h2 binary, later boolean"


class Runs(NamedTuple):
    """Runs of units: document, first unit, number of units, and two hashes of what they hold."""

    ids: np.ndarray
    ths: np.ndarray
    starts: np.ndarray
    sizes: np.ndarray
    h1: np.ndarray
    h2: np.ndarray

    def take(self, at: np.ndarray) -> Runs:
        return Runs(*(x[at] for x in self))


def _settled(runs: Runs) -> tuple[np.ndarray, np.ndarray]:
    """Order of the runs by content and place, and which of them, so ordered, have an earlier equal.

    Rows equal in id and start but not in text are versions of one place: neither is earlier.
    """
    order = np.lexsort((runs.ths, runs.starts, runs.ids, runs.h2, runs.h1))
    h1, h2, ids, starts = runs.h1[order], runs.h2[order], runs.ids[order], runs.starts[order]
    same = np.zeros(len(order), dtype=bool)
    same[1:] = (h1[1:] == h1[:-1]) & (h2[1:] == h2[:-1])
    lead = np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))
    return order, same & ((ids != ids[lead]) | (starts != starts[lead]))


def local(runs: Runs, part: np.ndarray) -> pa.RecordBatch:
    """A chunk's runs as rows of ``SENT``: later occurrences without hashes, as settled."""
    order, later = _settled(runs)
    runs, part = runs.take(order), part[order]
    out: list[list] = [[] for _ in _SENT]
    for is_later in (True, False):
        own = np.flatnonzero(later == is_later)
        own = own[np.lexsort((runs.starts[own], runs.ids[own], part[own]))]
        cut = np.concatenate([[0], np.flatnonzero(np.diff(part[own])) + 1, [len(own)]])
        for a, b in zip(cut[:-1], cut[1:]):
            if a < b:
                x = runs.take(own[a:b])
                hashes = (None, None) if is_later else (x.h1.tobytes(), x.h2.astype(np.uint32).tobytes())
                row = (int(part[own[a]]), x.ids.tobytes(), x.ths.tobytes(), x.starts.astype(np.int32).tobytes(),
                       x.sizes.astype(np.int32).tobytes(), *hashes, is_later)
                for column, value in zip(out, row):
                    column.append(value)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _SENT)], schema=_SENT)


def _spans(starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Union of intervals with ascending starts, as (start, length) pairs."""
    reach = np.maximum.accumulate(ends)
    opens = np.concatenate([[True], starts[1:] > reach[:-1]])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(starts)) - 1
    return np.stack([starts[first], reach[last] - starts[first]], axis=1).astype(np.int32)


def _settle(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
    def column(rows: pd.DataFrame, name: str, kind) -> np.ndarray:
        return np.frombuffer(b"".join(rows[name]), dtype=kind)

    names = (("ids", np.int64), ("ths", np.int64), ("starts", np.int32), ("sizes", np.int32))
    known, first = own[own["later"]], own[~own["later"]]
    runs = Runs(*(column(first, n, k) for n, k in names), column(first, "h1", np.uint64), column(first, "h2", np.uint32))
    order, later = _settled(runs)
    runs = runs.take(order[later])
    ids, ths, starts, sizes = (np.concatenate([column(known, n, k), x]) for (n, k), x in zip(names, runs))
    order = np.lexsort((starts, ths, ids))
    ids, ths, starts, sizes = ids[order], ths[order], starts[order], sizes[order]
    edge = np.flatnonzero((np.diff(ids) != 0) | (np.diff(ths) != 0)) + 1
    edge = np.concatenate([[0], edge, [len(ids)]]) if len(ids) else np.zeros(1, dtype=np.int64)
    rows = [(int(ids[a]), int(ths[a]), _spans(starts[a:b], starts[a:b] + sizes[a:b]).tobytes()) for a, b in zip(edge[:-1], edge[1:])]
    return pd.DataFrame(rows, columns=["_id", "_th", "spans"])


def later_spans(sent: DataFrame) -> DataFrame:
    """``_id, _th, _spans``: per document, lists of the units that later occurrences cover."""
    return (sent.groupBy("part").applyInPandas(_settle, "_id long, _th long, spans binary")
            .groupBy("_id", "_th").agg(F.collect_list("spans").alias("_spans")))


def covered(blobs: list[bytes] | None, n: int) -> np.ndarray:
    """Which of a document's ``n`` units its spans cover."""
    gone = np.zeros(n + 1, dtype=np.int64)
    for blob in blobs or ():
        span = np.frombuffer(blob, dtype=np.int32).reshape(-1, 2).astype(np.int64)
        np.add.at(gone, span[:, 0], 1)
        np.add.at(gone, span[:, 0] + span[:, 1], -1)
    return np.cumsum(gone)[:n] > 0


def groups_of(texts: DataFrame, group_bytes: int) -> int:
    """A number of groups that follows the bytes of the texts."""
    n_bytes = texts.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    return int(max(8, n_bytes // group_bytes))


def part_of(key: np.ndarray, groups: int) -> np.ndarray:
    return (T.mix(key) % np.uint64(groups)).astype(np.int32)


def slide(values: np.ndarray, n: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every ``n`` consecutive values, by doubling."""
    out, have = values, 1
    while have < n:
        step = min(have, n - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out
