"""Language of a text by rank-order profiles of its most frequent n-grams.

1. Words are runs of letters and marks of the lower-cased text. Their n-grams are runs of one
   to ``GRAM`` signs within a word, a border before and after it included (but not the border alone). An
   n-gram of three 21-bit code points is one 63-bit number, so counts are exact.
2. Learning: n-grams of all learnable texts are counted per language, in each task first,
   then by a shuffle on (language, n-gram). A language's profile is its ``top`` most frequent
   n-grams, ranked by count, equal counts by the n-gram's number.
3. Prediction: a text's own ``top`` most frequent n-grams, counted over the whole text, are
   ranked likewise. The out-of-place distance to a language sums, over them, how far the
   rank in the text is from that in the profile; an n-gram not in the profile costs ``top``.
   The least distance wins, of equals the least language in byte order.

``score`` is one less the distance as a share of the greatest possible one. Only texts are
scored: language, source and id are no input. All learnable rows teach. Profiles are
``top`` rows a language; ``LANGUAGES`` of them are held by a task at once, and more are
compared in further columns of the same pass, so what is sent is bounded whatever the table.

Defined cases: a null text or one without a letter is ``und`` with score 0 and teaches
nothing; rows with a null language teach nothing; null ids are not held out and teach
nothing; repeated rows teach once each and have equal results; without any profile all are
``und``; very long texts are counted whole; other columns do not matter; an empty table
gives no rows.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartmart.session import stage

from . import text as T

FOLDS = 5
GRAM = 3
TOP = 400
LANGUAGES = 256
UNKNOWN = "und"
_BITS = 21
_BORDER = 1  # a code point that is no letter; not 0, so that n-grams of all lengths differ
_HELD = 2_000_000  # n-grams that a task holds before it puts them together


@cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Which code points are letters, and which are letters or marks."""
    kind = np.array([unicodedata.category(chr(c))[0] for c in range(sys.maxunicode + 1)])
    return kind == "L", (kind == "L") | (kind == "M")


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """The n-grams of all texts, text by text, and where each text's begin (one border more than texts).

    A text without a letter has none.
    """
    low = [(t or "").lower() for t in texts]
    code = np.frombuffer("\n".join([*low, ""]).encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    row = np.repeat(np.arange(len(low)), [len(t) + 1 for t in low])
    is_letter, in_word = _letters()
    inside = in_word[code]
    has = np.bincount(row[is_letter[code]], minlength=len(low)) > 0
    inside &= has[row]
    keep = inside.copy()
    keep[1:] |= inside[:-1]  # the border after a word
    sign = np.where(inside, code, _BORDER)[keep].astype(np.uint64)
    sign = np.concatenate([np.full(1, _BORDER, np.uint64), sign])  # and one before the first
    letter = sign != _BORDER
    row = np.concatenate([np.zeros(1, np.int64), row[keep]])
    found, owner = [], []
    for n in range(1, GRAM + 1):
        size = len(sign) - n + 1
        if size <= 0:
            break
        key, good = sign[:size].copy(), letter[:size] | letter[min(n - 1, 1) : size + min(n - 1, 1)]
        for k in range(1, n):
            key = (key << np.uint64(_BITS)) | sign[k : k + size]
            if k < n - 1:
                good &= letter[k : k + size]  # no border in the middle
        own = np.maximum(row[:size], row[1 : size + 1]) if n > 1 else row[:size]  # a border before a word is the word's
        found.append(key[good])
        owner.append(own[good])
    found_, owner_ = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (found, owner))
    order = np.argsort(owner_, kind="stable")
    return found_[order].astype(np.uint64), np.searchsorted(owner_[order], np.arange(len(low) + 1))


def _counted(keys: np.ndarray, weight: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if weight is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weight = keys[order], weight[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    if weight is None:
        return keys[first], np.diff(np.append(first, len(keys)))
    return keys[first], np.add.reduceat(weight, first) if len(first) else weight


def ranked(keys: np.ndarray, top: int) -> np.ndarray:
    """The most frequent n-grams, the first first."""
    own, n = _counted(keys)
    if len(own) > top:  # none that counts less than the last of the top
        most = n >= np.partition(n, len(n) - top)[len(n) - top]
        own, n = own[most], n[most]
    return own[np.argsort(-n, kind="stable")][:top]


def _pieces(texts: pa.Array) -> Iterator[list[str | None]]:
    batch = pa.RecordBatch.from_arrays([texts], ["_text"])
    for piece in T.chunks(batch, "_text"):
        yield piece.column("_text").to_pylist()


def profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", top: int = TOP) -> DataFrame:
    """``lang, gram, rank`` (from 0): the most frequent n-grams of each language's texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        have: dict[str, list[tuple[np.ndarray, np.ndarray]]] = {}
        held = 0

        def merged() -> None:
            for lang, parts in have.items():
                have[lang] = [_counted(*(np.concatenate(x) for x in zip(*parts)))]

        def flush() -> Iterator[pa.RecordBatch]:
            merged()
            for lang, [(keys, n)] in have.items():
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n, pa.int64())],
                                                 ["lang", "gram", "n"])
            have.clear()

        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                langs = np.array(piece.column("_lang").to_pylist(), dtype=object)
                found, edge = grams(piece.column("_text").to_pylist())
                of = np.repeat(np.arange(len(langs)), np.diff(edge))
                for lang in sorted(set(langs)):
                    own, n = _counted(found[(langs == lang)[of]])
                    have.setdefault(lang, []).append((own, n.astype(np.int64)))
                    held += len(own)
                if held > _HELD:
                    merged()
                    held = sum(len(parts[0][0]) for parts in have.values())
                    if held > _HELD // 2:
                        yield from flush()
                        held = 0
        yield from flush()

    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(lang_col).alias("_lang"), F.col(text_col).alias("_text"))
    total = rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by = Window.partitionBy("lang").orderBy(F.col("n").desc(), "gram")
    return total.select("lang", "gram", (F.row_number().over(by) - 1).alias("rank")).where(F.col("rank") < top)


class _Profiles:
    """Ranks of all profiles' n-grams, by language."""

    def __init__(self, langs: list[str], rows: list[tuple[str, int, int]], top: int):
        self.langs, self.top = langs, top
        at = {lang: k for k, lang in enumerate(langs)}
        self.keys = np.unique(np.array([gram for _, gram, _ in rows], dtype=np.uint64))
        self.rank = np.full((len(self.keys) + 1, len(langs)), -1, dtype=np.int64)  # the last: in no profile
        where = np.searchsorted(self.keys, np.array([gram for _, gram, _ in rows], dtype=np.uint64))
        self.rank[where, [at[lang] for lang, _, _ in rows]] = [rank for _, _, rank in rows]

    def nearest(self, own: np.ndarray) -> tuple[int, str]:
        """Distance of the nearest language to a text's ranked n-grams."""
        at = np.searchsorted(self.keys, own)
        at[(at == len(self.keys)) | (self.keys[np.minimum(at, len(self.keys) - 1)] != own)] = len(self.keys)
        rank = self.rank[at]
        off = np.where(rank < 0, self.top, np.abs(rank - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(np.argmin(off))  # the first of equals
        return int(off[best]), self.langs[best]


def predict(docs: DataFrame, learned: DataFrame, text_col: str = "text", top: int = TOP, languages: int = LANGUAGES) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``. ``learned`` is as ``profiles`` gives it."""
    spark = docs.sparkSession
    # the languages' names, and at most ``languages * top`` rows of a slice at once
    langs = sorted((r["lang"] for r in learned.select("lang").distinct().collect()), key=lambda x: x.encode())
    near = []
    for k in range(0, len(langs), languages):
        some = langs[k : k + languages]
        rows = [tuple(r) for r in learned.where(F.col("lang").isin(some)).select("lang", "gram", "rank").collect()]
        near.append(_nearest(spark.sparkContext.broadcast(_Profiles(some, rows, top)), top)(F.col(text_col)))
    if not near:
        return docs.select("*", F.lit(UNKNOWN).alias("lang_pred"), F.lit(0.0).alias("score"))
    best = F.array_min(F.array(*near))  # a least distance is followed by the least name
    out = docs.select("*", best.alias("_best"))
    score = F.when(F.col("_best.of") > 0, 1 - F.col("_best.off") / F.col("_best.of")).otherwise(F.lit(0.0))
    return out.select(*docs.columns, F.col("_best.lang").alias("lang_pred"), score.alias("score"))


def _nearest(given, top: int):
    @F.pandas_udf("off long, lang string, of long")
    def nearest(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        known = given.value
        for texts in batches:
            out = []
            for piece in _pieces(pa.Array.from_pandas(texts, type=pa.string())):
                found, edge = grams(piece)
                for a, b in zip(edge[:-1].tolist(), edge[1:].tolist()):
                    own = ranked(found[a:b], top)
                    out.append((*known.nearest(own), len(own) * top) if a < b else (0, UNKNOWN, 0))
            yield pd.DataFrame(out, columns=["off", "lang", "of"])

    return nearest


def query(spark, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang", "text")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % FOLDS == 0, F.lit(False))
    learned = stage(profiles(docs.where(F.col("doc_id").isNotNull() & ~held_out)), "profiles")
    return predict(docs.select("doc_id", held_out.alias("held_out"), "text"), learned).drop("text")
