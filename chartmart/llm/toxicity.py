"""Toxicity by noisy-channel deobfuscation.

1. A character language model: counts of three characters in a row over the words of all
   texts, each word as often as it occurs, summed over all partitions. Its alphabet is
   a-z, one sign for any other letter and one for a word border, so it has at most
   ``28**3`` numbers however much is counted.
2. Each token that is not plain letters, or repeats a letter, and each run of three or
   more single characters (``i d i o t``, whatever white space parts them) spans a lattice: leetspeak signs stand for
   letters, signs between letters and spaces in such a run may be dropped, longer repeats shrink to
   two or one. Every edge has a channel cost; Viterbi search over the last two characters
   finds the likeliest reading of the whole lattice under channel and language model.
3. Restored words and their first four to six letters are the features. Labelled rows
   (never those held out, at most ``max_train`` of them by a hash of the id) give, for
   each feature, the share of toxic documents among those that have it, shrunk to the
   overall share by ``prior`` documents. Of the features over one half, those count in
   full that are needed to explain the toxic rows, the widest first; the others, such as
   the remaining words of copied texts, count half. A document's score is that of its
   most telling feature, or the overall share without any.

Only texts are scored: labels, language, source and id are no input. The features kept are
bounded by ``max_train``; so is the label table that is broadcast. Counting candidates in
toxic rows first keeps the rest of the vocabulary out of the shuffle.

Defined cases: a null or empty text has the score of no evidence; repeated rows have equal
scores; labels that are null or without a document teach nothing, and several of one
document count as the highest; null ids are held out by no remainder (their flag is
false) and teach nothing; other columns do not matter; without any labels the score is 0;
an empty table gives no rows.
"""

from __future__ import annotations

import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import text as T

FOLDS = 5
MAX_TRAIN = 100_000
PRIOR = 4.0
LEAST_TOXIC = 3  # toxic rows that a feature needs to be counted at all
PREFIXES = (4, 5, 6)

# What a sign may stand for besides itself. Fixed values.
LEET = {"0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "g", "7": "t", "8": "b", "9": "g",
        "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¥": "y", "µ": "u"}
_CENSOR = "*#%"  # stands for any vowel or for nothing
_VOWELS = "aeiou"
_COST = {"leet": 0.7, "drop": 0.5, "space": 0.2, "shrink": 0.3, "censor": 2.5}
_PLAIN = re.compile(r"[^\W\d_]+")
_TRIPLE = re.compile(r"(.)\1")
_MARKS = re.compile(r"([^\w\s])\1{2,}$")
_RUN = re.compile(r"(.)\1*", re.S)
_LEET_SIGNS = frozenset(LEET)
_TAIL = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "«»“”‘’…–—¿¡"
_N = 28


def _signs(text: str) -> np.ndarray:
    """Signs of the model: 0 word border, 1-26 a-z, 27 any other letter."""
    code = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    out = np.where(code >= 0xAA, 27, 0)
    low = (code >= 97) & (code <= 122)
    out[low] = code[low] - 96
    return out


def char_counts(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """``at, n``: how often each three signs in a row occur in the words of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(_N**3)
        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                words = Counter(itertools.chain.from_iterable((t or "").lower().split() for t in piece.column("_text").to_pylist()))
                if not words:
                    continue
                signs = _signs(" ".join(("", *words, "")))
                weight = np.repeat(np.array([*words.values(), 0], dtype=np.float64), [len(w) + 1 for w in words] + [1])
                at = (signs[:-2] * _N + signs[1:-1]) * _N + signs[2:]
                total += np.bincount(at, weights=weight[: len(at)], minlength=_N**3)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(has, pa.int32()), pa.array(total[has], pa.float64())], ["at", "n"])

    rows = docs.select(F.col(text_col).alias("_text")).mapInArrow(count, "at int, n double")
    return rows.groupBy("at").agg(F.sum("n").alias("n"))


def model(counts: DataFrame) -> np.ndarray:
    """Log chance of a sign after two others, smoothed by that after one."""
    n = np.zeros(_N**3)
    for row in counts.collect():  # at most 28**3 rows
        n[row["at"]] = row["n"]
    n = n.reshape(_N, _N, _N)
    two = n.sum(axis=0) + 0.5
    back = two / two.sum(axis=1, keepdims=True)
    return np.log((n + 5 * back[None]) / (n.sum(axis=2, keepdims=True) + 5))


def _made(back: tuple | None) -> str:
    """The letters made along back-pointers."""
    out = []
    while back:
        back, made = back
        out.append(made)
    return "".join(reversed(out))


class _Remembered(dict):
    """What ``make`` gives for each key, made once."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key):
        out = self[key] = self.make(key)
        return out


def _spaced(tokens: list[str]) -> Iterator[str]:
    """Each run of three or more single characters, parted by one space."""
    single = [k for k, token in enumerate(tokens) if len(token) == 1]
    first = 0
    for k in range(1, len(single) + 1) if len(single) > 2 else ():
        if k == len(single) or single[k] != single[k - 1] + 1:
            if k - first > 2:
                yield " ".join(tokens[single[first] : single[k - 1] + 1])
            first = k


class Restorer:
    """Likeliest reading of tokens, remembered from one to the next.

    ``keep`` makes of a token's restored words what is remembered of it, such as its features.
    """

    def __init__(self, lm: np.ndarray, keep=lambda words: words):
        self.lm = lm.ravel().tolist()  # of signs a, b, c at (a * 28 + b) * 28 + c
        self.known = _Remembered(lambda token: keep(self.read(token)))
        self.decoded = _Remembered(self.decode)
        self.edges = _Remembered(lambda run: self._edges(*run))

    def each(self, text: str) -> list:
        """What is kept of each distinct token, and of each run of single characters, of a text."""
        tokens = text.lower().split()
        for held in (self.known, self.decoded, self.edges):
            if len(held) > 400_000:
                held.clear()
        return list(map(self.known.__getitem__, {*tokens, *_spaced(tokens)}))

    def words(self, text: str) -> set[str]:
        """The distinct restored words of a text."""
        return set(itertools.chain.from_iterable(self.each(text)))

    def read(self, token: str) -> tuple[str, ...]:
        core = token.strip(_TAIL)
        if _PLAIN.fullmatch(core) and not _TRIPLE.search(core):
            return (core,)
        # a letter or two doubled is common in plain words: both readings count
        plain = tuple(_PLAIN.findall(token))
        given = core if _LEET_SIGNS.isdisjoint(token) else token
        given = _MARKS.sub("", given.strip(".,;:?\"'"))
        if not any(map(str.isalpha, given)):
            return plain
        return tuple(dict.fromkeys([*plain, *self.decoded[given].split()]))

    def decode(self, given: str) -> str:
        """Viterbi over (last two signs) along the lattice of ``given``, whole however long it is.

        A state is the last two signs, the first times 28 plus the second. Each keeps its cost and a
        back-pointer: (that of the state before, letters made).
        """
        lm, edges_of = self.lm, self.edges
        states: dict[int, tuple] = {0: (0.0, None)}
        for run in _RUN.finditer(given):
            whole = run[0]
            ch, n = whole[0], len(whole)
            n, times = (n, 1) if n == 1 or ch.isalpha() else (1, n)
            edges = edges_of[ch, n]
            for _ in range(times):  # all edges that leave a place end in one place
                into: dict[int, tuple] = {}
                if len(edges) == 1 and len(edges[0][1]) == 1:  # most places
                    ((made, (z,), price),) = edges
                    for x, (cost, back) in states.items():
                        c, x = cost + price - lm[x * _N + z], x % _N * _N + z
                        if x not in into or c < into[x][0]:
                            into[x] = (c, (back, made))
                    states = into
                    continue
                for state, (cost, back) in states.items():
                    for made, signs, price in edges:
                        x, c = state, cost + price
                        for z in signs:
                            c -= lm[x * _N + z]
                            x = x % _N * _N + z
                        if x not in into or c < into[x][0]:
                            into[x] = (c, (back, made) if made else back)
                states = into
        last = [(c - lm[x * _N], back) for x, (c, back) in states.items()]
        if len(last) == 1:
            return _made(last[0][1])
        least = min(c for c, _ in last)
        return min(_made(back) for c, back in last if c == least)

    @staticmethod
    def _edges(ch: str, n: int) -> list[tuple[str, list[int], float]]:
        """(letters made, their signs, channel cost) of each edge over a run of ``n`` letters, or over another character."""
        if ch.isalpha():
            out = [(ch, 0.0)] if n == 1 else [(ch, _COST["shrink"] * n), (ch * 2, 0.0 if n == 2 else _COST["shrink"] * n)]
        elif ch.isspace():
            out = [("", _COST["space"]), (" ", 1.0)]
        else:
            out = [(made, _COST["leet"]) for made in LEET.get(ch, "")]
            if ch in _CENSOR:
                out += [(v, _COST["censor"]) for v in _VOWELS]
            if not ch.isdigit():
                out.append(("", _COST["drop"]))
            out = out or [(" ", 1.0)]
        return [(made, [0 if c == " " else ord(c) - 96 if "a" <= c <= "z" else 27 for c in made], price) for made, price in out]


def _features(words) -> set[str]:
    out = {"=" + w for w in words if len(w) > 2}
    for w in words:
        size = len(w)
        for n in PREFIXES:
            if size > n:
                out.add(w[:n] + "-")
    return out


def _counted(docs: DataFrame, lm, wanted, text_col: str) -> DataFrame:
    """``feature, n`` over the rows of ``docs``; of the ``wanted`` features only, if given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chosen, found = wanted.value if wanted else None, Counter()
        restore = Restorer(lm.value, lambda words: tuple(_features(words) if chosen is None else _features(words) & chosen))

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["feature", "n"])

        for batch in batches:
            for text in batch.column("_text").to_pylist():
                found.update(set(itertools.chain.from_iterable(restore.each(text or ""))))
            if len(found) > 500_000:
                yield flush()
                found.clear()
        yield flush()

    rows = docs.select(F.col(text_col).alias("_text")).mapInArrow(count, "feature string, n long")
    return rows.groupBy("feature").agg(F.sum("n").alias("n"))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % FOLDS == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, lm, id_col: str = "doc_id", text_col: str = "text",
          max_train: int = MAX_TRAIN, prior: float = PRIOR) -> tuple[dict[str, float], float]:
    """Score of each telling feature, and the overall share of toxic rows."""
    spark = docs.sparkSession
    own = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max("toxic").alias("_toxic")).where(~held_out())
    n = own.count()
    if n > max_train:
        own = own.where(F.pmod(F.xxhash64("doc_id"), F.lit(n)) < max_train)
    # at most about max_train rows of two numbers
    rows = docs.join(F.broadcast(own.withColumnRenamed("doc_id", "_label")), F.col(id_col) == F.col("_label"))
    sums = rows.agg(F.count("*").alias("n"), F.sum("_toxic").alias("t")).first()
    if not sums["n"]:
        return {}, 0.0
    share = (sums["t"] or 0) / sums["n"]
    toxic = {r["feature"]: r["n"] for r in _counted(rows.where("_toxic = 1"), lm, None, text_col).where(F.col("n") >= LEAST_TOXIC).collect()}
    wanted = spark.sparkContext.broadcast(frozenset(toxic))
    clean = {r["feature"]: r["n"] for r in _counted(rows.where("_toxic = 0"), lm, wanted, text_col).collect()}
    score = {f: (t + prior * share) / (t + clean.get(f, 0) + prior) for f, t in toxic.items()}
    score = {f: s for f, s in score.items() if s > share}
    strong = spark.sparkContext.broadcast(frozenset(f for f, s in score.items() if s >= 0.5))
    chosen = _cover([r["own"] for r in _strong(rows.where("_toxic = 1"), lm, strong, text_col).collect()], score)
    return {f: s if f in chosen else s / 2 for f, s in score.items()}, share


def _strong(docs: DataFrame, lm, strong, text_col: str) -> DataFrame:
    """The strong features of each row."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restore = Restorer(lm.value, lambda words: tuple(_features(words) & strong.value))
        for batch in batches:
            own = [sorted(set(itertools.chain.from_iterable(restore.each(t or "")))) for t in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.string()))], ["own"])

    return docs.select(F.col(text_col).alias("_text")).mapInArrow(find, "own array<string>")


def _cover(rows: list[list[str]], score: dict[str, float]) -> set[str]:
    """Features that explain the toxic rows, each taken for the rows that those before it leave.

    Copies of a toxic text share all their words; but once a word that toxic texts have in
    common explains them, their other words explain nothing.
    """
    open_ = {f: set() for own in rows for f in own}
    for k, own in enumerate(rows):
        for f in own:
            open_[f].add(k)
    chosen: set[str] = set()
    while open_:
        # most rows first; of equals the surer feature
        best = max(open_, key=lambda f: (len(open_[f]), score[f], f))
        gone = set(open_[best])
        if len(gone) < LEAST_TOXIC:
            break
        chosen.add(best)
        open_ = {f: left for f, own in open_.items() if (left := own - gone)}
    # and those that stand for a chosen word in full or in part
    return chosen | {f for f in score if f[0] == "=" and any(c.endswith("-") and f[1:].startswith(c[:-1]) for c in chosen) and score[f] >= 0.5}


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``doc_id, held_out, score, predicted`` of every row."""
    spark = docs.sparkSession
    lm = spark.sparkContext.broadcast(model(char_counts(docs, text_col)))
    weights, share = train(docs, labels, lm, id_col, text_col, **options)
    given = spark.sparkContext.broadcast(weights)

    @F.pandas_udf("double")
    def rate(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        known = given.value
        restore = Restorer(lm.value, lambda words: max([known[f] for f in _features(words) if f in known], default=share))
        for texts in batches:  # telling features are above the share
            yield pd.Series([max(restore.each(t or ""), default=share) for t in texts], dtype="float64")

    out = docs.select(F.col(id_col).alias("doc_id"), held_out(id_col).alias("held_out"), rate(F.col(text_col)).alias("score"))
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def query(spark, sf_dir: str) -> DataFrame:
    return score(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/labels.parquet"))
