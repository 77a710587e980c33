"""Line dedup by winnowing over line hashes.

A line is what stands between line feeds and holds a word; two lines are equal if their
words are. A run of ``run`` or more lines that also starts earlier (in a document with a
smaller id, or earlier in the same one) is deleted, and so is such a line of ``alone`` or
more words by itself.

1. Winnowing: of the ``gram``-line hashes in every window of ``run`` lines the least are
   selected as fingerprints (all of them, if some are equal). Equal windows select the same
   ones, so every run of ``run`` lines that stands twice shares a fingerprint with its copy:
   that is the guarantee. A line of ``alone`` words is a fingerprint by itself.
2. The positions of a fingerprint are joined: occurrences meet in the group of its hash,
   each with the hashes of the ``run - gram`` lines before and after it.
3. Matches are extended both ways: for ``a`` lines to the left and the rest to the right,
   an occurrence whose lines agree with those of an earlier one is a repeated run. Longer
   runs hold a fingerprint in every window, so their pieces overlap and chain to the longest
   run that is repeated; it may continue with another earlier copy where the first ends.
4. The lines of the runs found are deleted from the later documents, with their line feeds.

A chunk settles repeats among its own occurrences and sends one of what it repeats. A
fingerprint that holds a large share of all occurrences (a common line between neighbours
that differ) is not gathered in one group: its occurrences go, once for each ``a``, to the
group of the fingerprint with those neighbours. Which are so heavy is counted beforehand;
shares above ``1 / groups`` are all found and at most ``2 * groups`` fingerprints (and never
more than ``2 / LEAST_SHARE``) are broadcast, 8 bytes each. The result does not depend on it.

Defined cases: a null text is empty; lines without words never count and stay; a null id
sorts before all others; rows equal in id and text are one document, with equal results;
other columns pass through ``cut`` as they are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartmart.session import stage

from . import occurrence as O
from . import text as T

RUN = 2
GRAM = 1
ALONE = 20
GROUP_BYTES = 32 << 20
LEAST_SHARE = 2.0**-18  # fingerprints below this share of all are never split
_BLOCK = 2_000_000  # fingerprints counted together
_LATER, _ALONE, _ALL = -3, -2, -1  # ways of a sent row other than "extend by that many lines to the left"
_SENT = pa.schema([("part", pa.int32()), ("way", pa.int32())] + [(n, pa.binary()) for n in ("ids", "ths", "starts", "sizes", "h1", "h2", "c1", "c2")])
SENT = "part int, way int, ids binary, ths binary, starts binary, sizes binary, h1 binary, h2 binary, c1 binary, c2 binary"
_BLANK = " \t\n\x0b\x0c\r"


class _Lines:
    """The lines with words of a chunk of texts."""

    def __init__(self, texts: pa.Array):
        w = T.words_of(texts)
        feeds = np.searchsorted(np.flatnonzero(w.data == 10), w.start)
        new = np.ones(len(w.row), dtype=bool)
        new[1:] = (w.row[1:] != w.row[:-1]) | (feeds[1:] != feeds[:-1])
        a = np.flatnonzero(new)
        b = np.append(a[1:], len(w.row))[: len(a)]
        self.row, self.size = w.row[a], b - a
        self.h1, self.h2 = (T.runs_hash(w.hashes(k), a, b, 2) for k in (0, 1))
        self.first = np.searchsorted(self.row, np.arange(len(w.first)))


class Prints(NamedTuple):
    """Occurrences of fingerprints: document, first line, two hashes, and those of the lines around (0: none there).

    Of ``2 * reach`` columns of ``c1`` and ``c2`` the first half are the lines before, the nearest first, the other half those after.
    """

    ids: np.ndarray
    ths: np.ndarray
    starts: np.ndarray
    h1: np.ndarray
    h2: np.ndarray
    c1: np.ndarray
    c2: np.ndarray

    def take(self, at: np.ndarray) -> Prints:
        return Prints(*(x[at] for x in self))


def selected(lines: _Lines, run: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """First lines of the window minima of a chunk, and their hashes."""
    n, reach = len(lines.row), run - gram
    if n < run:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    at = np.arange(n - gram + 1)
    grams = T.runs_hash(lines.h1, at, at + gram, 1)
    least = O.slide(grams, reach + 1, np.minimum)  # for windows in one text, all their grams lie in it
    least[lines.row[: n - run + 1] != lines.row[run - 1 :]] = 0
    pad = np.zeros(reach, dtype=np.uint64)
    top = O.slide(np.concatenate([pad, least, pad]), reach + 1, np.maximum)  # greatest minimum of the windows that hold the gram
    first = np.flatnonzero((grams == top) & (top > 0))
    return first, grams[first]


def _prints(lines: _Lines, ids: np.ndarray, ths: np.ndarray, run: int, gram: int) -> Prints:
    first, h1 = selected(lines, run, gram)
    row, reach = lines.row[first], run - gram
    c1, c2 = np.zeros((len(first), 2 * reach), dtype=np.uint64), np.zeros((len(first), 2 * reach), dtype=np.uint32)
    for j in range(2 * reach):
        line = first - 1 - j if j < reach else first + gram + j - reach
        has = (line >= lines.first[row]) & (line < lines.first[row + 1])
        c1[has, j] = lines.h1[line[has]] | np.uint64(1)
        c2[has, j] = lines.h2[line[has]] >> np.uint64(32)
    h2 = (T.runs_hash(lines.h2, first, first + gram, 2) >> np.uint64(32)).astype(np.uint32)
    return Prints(ids[row], ths[row], (first - lines.first[row]).astype(np.int32), h1, h2, c1, c2)


def _extended(prints: Prints, a: int, run: int) -> tuple[np.ndarray, O.Runs]:
    """The occurrences that have ``a`` lines before and the rest of a run after them, and those runs."""
    reach = prints.c1.shape[1] // 2
    sides = [*range(a), *range(reach, 2 * reach - a)]
    at = np.flatnonzero((prints.c1[:, sides] != 0).all(axis=1))
    own = prints.take(at)
    k1, k2 = own.h1, own.h2.astype(np.uint64)
    for j in sides:
        k1, k2 = T.mix(k1 + T.mix(own.c1[:, j])), T.mix(k2 + T.mix(own.c2[:, j].astype(np.uint64)))
    return at, O.Runs(own.ids, own.ths, own.starts - np.int32(a), np.full(len(at), run, dtype=np.int32), k1, (k2 >> np.uint64(32)).astype(np.uint32))


def _repeated(runs: O.Runs) -> np.ndarray:
    """Which runs have an earlier equal among the given."""
    order, later = O._settled(runs)
    out = np.zeros(len(order), dtype=bool)
    out[order] = later
    return out


def _packed(part: np.ndarray, way: int, ids, ths, starts, **more) -> Iterator[dict]:
    """Arrays as one row of ``SENT`` for each part."""
    order = np.lexsort((starts, ids, part))
    part = part[order]
    edge = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(part)]])
    columns = {"ids": ids, "ths": ths, "starts": starts.astype(np.int32)} | more
    columns = {name: x[order] for name, x in columns.items()}
    for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
        if a < b:
            yield {"part": int(part[a]), "way": way} | {name: x[a:b].tobytes() for name, x in columns.items()}


def _sent(lines: _Lines, ids: np.ndarray, ths: np.ndarray, run: int, gram: int, alone: int, groups: int, heavy: np.ndarray) -> Iterator[dict]:
    """What a chunk sends: the runs it knows to be later, and occurrences that no earlier one in it settles."""
    known = []
    prints = _prints(lines, ids, ths, run, gram)
    is_heavy = np.isin(prints.h1, heavy)
    opens = np.zeros(len(prints.ids), dtype=bool)
    for a in range(run - gram + 1):
        at, runs = _extended(prints, a, run)
        later = _repeated(runs)
        known.append(runs.take(later))
        opens[at[~later]] = True
        own = ~later & is_heavy[at]
        x = prints.take(at[own])
        yield from _packed(O.part_of(runs.h1[own], groups), a, x.ids, x.ths, x.starts, h1=x.h1, h2=x.h2, c1=x.c1, c2=x.c2)
    x = prints.take(opens & ~is_heavy)
    yield from _packed(O.part_of(x.h1, groups), _ALL, x.ids, x.ths, x.starts, h1=x.h1, h2=x.h2, c1=x.c1, c2=x.c2)
    first = np.flatnonzero(lines.size >= alone)
    row = lines.row[first]
    runs = O.Runs(ids[row], ths[row], (first - lines.first[row]).astype(np.int32), np.ones(len(first), dtype=np.int32), lines.h1[first],
                  (lines.h2[first] >> np.uint64(32)).astype(np.uint32))
    later = _repeated(runs)
    known.append(runs.take(later))
    x = runs.take(~later)
    yield from _packed(O.part_of(x.h1, groups), _ALONE, x.ids, x.ths, x.starts, h1=x.h1, h2=x.h2)
    x = O.Runs(*(np.concatenate(parts) for parts in zip(*known)))
    yield from _packed(O.part_of(x.ths.view(np.uint64), groups), _LATER, x.ids, x.ths, x.starts, sizes=x.sizes.astype(np.int32))


def _joined(sent: DataFrame, run: int, gram: int) -> DataFrame:
    """``_id, _th, _spans``: positions of equal fingerprints joined, matches extended both ways."""
    width = 2 * (run - gram)

    def settle(key: tuple, own: pd.DataFrame) -> pd.DataFrame:
        def column(rows: pd.DataFrame, name: str, kind) -> np.ndarray:
            return np.frombuffer(b"".join(rows[name]), dtype=kind)

        found = []
        for way, rows in own.groupby("way"):
            ids, ths, starts = column(rows, "ids", np.int64), column(rows, "ths", np.int64), column(rows, "starts", np.int32)
            if way == _LATER:
                found.append((ids, ths, starts, column(rows, "sizes", np.int32)))
                continue
            h1, h2 = column(rows, "h1", np.uint64), column(rows, "h2", np.uint32)
            if way == _ALONE:
                every = [O.Runs(ids, ths, starts, np.ones(len(ids), dtype=np.int32), h1, h2)]
            else:
                c1, c2 = (column(rows, n, k).reshape(len(ids), width) for n, k in (("c1", np.uint64), ("c2", np.uint32)))
                prints = Prints(ids, ths, starts, h1, h2, c1, c2)
                every = [_extended(prints, a, run)[1] for a in (range(width // 2 + 1) if way == _ALL else [way])]
            found += [runs.take(_repeated(runs))[:4] for runs in every]
        ids, ths, starts, sizes = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((starts, ths, ids))
        ids, ths, starts, sizes = ids[order], ths[order], starts[order], sizes[order]
        if not len(ids):
            return pd.DataFrame({"_id": [], "_th": [], "spans": []})
        edge = np.concatenate([[0], np.flatnonzero((np.diff(ids) != 0) | (np.diff(ths) != 0)) + 1, [len(ids)]])
        out = [(int(ids[a]), int(ths[a]), O._spans(starts[a:b], starts[a:b] + sizes[a:b]).tobytes()) for a, b in zip(edge[:-1], edge[1:])]
        return pd.DataFrame(out, columns=["_id", "_th", "spans"])

    return (sent.groupBy("part").applyInPandas(settle, "_id long, _th long, spans binary")
            .groupBy("_id", "_th").agg(F.collect_list("spans").alias("_spans")))


def heavy_prints(texts: DataFrame, run: int, gram: int, share: float) -> np.ndarray:
    """Hashes of the fingerprints that hold ``share`` of all occurrences (and none below half of it), sorted.

    A block of occurrences reports those with half the share of its own, so what is not reported of a
    fingerprint is below half the share of all; at most ``2 / share`` can pass.
    """

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[np.ndarray], held: int) -> pa.RecordBatch:
            found, n = np.unique(np.concatenate(parts), return_counts=True)
            often = n >= share / 2 * held
            return pa.RecordBatch.from_arrays([pa.array([None, *found[often].view(np.int64).tolist()], pa.int64()),
                                               pa.array([held, *n[often].tolist()], pa.int64())], ["print", "n"])

        parts, held = [], 0
        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                parts.append(selected(_Lines(piece.column("_text")), run, gram)[1])
                held += len(parts[-1])
                if held >= _BLOCK:
                    yield flush(parts, held)
                    parts, held = [], 0
        if held:
            yield flush(parts, held)

    n = stage(texts.select("_text").mapInArrow(counted, "print long, n long").groupBy("print").agg(F.sum("n").alias("n")), "prints")
    total = n.where("print is null").first()
    if total is None:
        return np.zeros(0, dtype=np.uint64)
    rows = n.where(F.col("print").isNotNull() & (F.col("n") >= F.lit(share / 2 * total["n"]))).select("print").toPandas()
    return np.sort(rows["print"].to_numpy(dtype=np.int64).view(np.uint64))


def later_lines(texts: DataFrame, run: int = RUN, gram: int = GRAM, alone: int = ALONE, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """``_id, _th, _spans``: the lines to delete from each document that has any."""
    groups = O.groups_of(texts, group_bytes)
    heavy = texts.sparkSession.sparkContext.broadcast(heavy_prints(texts, run, gram, max(1 / groups, LEAST_SHARE)))

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                ids, ths = (np.asarray(piece.column(c), dtype=np.int64) for c in ("_id", "_th"))
                rows = list(_sent(_Lines(piece.column("_text")), ids, ths, run, gram, alone, groups, heavy.value))
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=_SENT)

    return _joined(texts.mapInArrow(prints, SENT), run, gram)


def cut(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``row`` (all columns of ``docs``, later repeated runs deleted from the text), ``n_lines``, ``n_removed``."""
    spans = later_lines(T.keyed(docs, id_col, text_col), **options)
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"),
                       F.coalesce(F.col(id_col).cast("long"), F.lit(T.NO_ID)).alias("_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_th"))
    made = F.pandas_udf(_delete, "text string, n_lines long, n_removed long")(F.col("row")[text_col], F.col("_spans"))
    out = rows.join(spans, ["_id", "_th"], "left").select("row", made.alias("_cut"))
    return out.select(F.col("row").withField(text_col, F.col("_cut.text")).alias("row"), "_cut.n_lines", "_cut.n_removed")


def _delete(texts: pd.Series, spans: pd.Series) -> pd.DataFrame:
    out = []
    for text, blobs in zip(texts, spans):
        lines = (text or "").split("\n")
        full = [bool(x.strip(_BLANK)) for x in lines]
        n = sum(full)
        gone = 0
        if blobs is not None and len(blobs):
            marked = iter(O.covered(list(blobs), n).tolist())
            stays = [not (f and next(marked)) for f in full]
            gone = len(lines) - sum(stays)
            text = "\n".join([x for x, s in zip(lines, stays) if s])
        out.append((text, n, gone))
    return pd.DataFrame(out, columns=["text", "n_lines", "n_removed"])


def query(spark, sf_dir: str) -> DataFrame:
    """Deleted lines of every document, with a digest of the text that stays."""
    rows = cut(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return rows.select("row.doc_id", "n_lines", "n_removed", F.length("row.text").cast("long").alias("n_chars"),
                       F.sha2(F.encode("row.text", "UTF-8"), 256).alias("kept_sha256"))


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents),
a AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS o FROM d),
b AS (SELECT *, regexp_extract_all(line, '[^\x20\x09-\x0D]+') AS ws FROM a),
l AS (SELECT doc_id, o, len(ws) AS n, array_to_string(ws, ' ') AS s, row_number() OVER (PARTITION BY doc_id ORDER BY o) AS p FROM b WHERE len(ws) > 0),
r AS (SELECT *, s || chr(10) || lead(s) OVER (PARTITION BY doc_id ORDER BY p) AS two FROM l),
m AS (SELECT *, two IS NOT NULL AND row_number() OVER (PARTITION BY two ORDER BY doc_id, p) > 1 AS later,
        n >= {ALONE} AND row_number() OVER (PARTITION BY s ORDER BY doc_id, p) > 1 AS again FROM r),
g AS (SELECT doc_id, o, later OR again OR coalesce(lag(later) OVER (PARTITION BY doc_id ORDER BY p), false) AS gone FROM m),
k AS (SELECT doc_id, count(g.o)::BIGINT AS n_lines, count(*) FILTER (WHERE gone)::BIGINT AS n_removed,
        coalesce(string_agg(line, chr(10) ORDER BY o) FILTER (WHERE gone IS NOT TRUE), '') AS kept FROM a LEFT JOIN g USING (doc_id, o) GROUP BY doc_id)
SELECT doc_id, n_lines, n_removed, length(kept)::BIGINT AS n_chars, sha256(kept) AS kept_sha256 FROM k
"""
