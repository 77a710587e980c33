"""Words of whole texts and their hashes, as arrays over an Arrow batch.

A word is a run of characters other than the six ASCII white-space characters
(``[^\\x20\\x09-\\x0D]+``), so word borders can be found on the UTF-8 bytes. Hashes are
prefix sums of a polynomial modulo 2**64: the hash of any run of bytes, or of any run of
words, is one subtraction and one multiplication, for a whole batch at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
BATCH_ROWS = 1000
CHUNK_BYTES = 1 << 20  # text hashed at once: a worker holds some 60 bytes for each
NO_ID = -(2**63)  # stands for a null id: before all others

# odd multipliers of the polynomial hashes (fixed values, any odd numbers do)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)
_MASK = (1 << 64) - 1
_IS_SPACE = np.zeros(256, dtype=bool)
_IS_SPACE[[32, 9, 10, 11, 12, 13]] = True
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def n_words(text: Column) -> Column:
    """Number of words of a text (null: 0), in the JVM."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _power(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of a base and of its inverse modulo 2**64."""
    have = _powers.get(base)
    if have is None or len(have[0]) <= n:
        size = (n // 65536 + 1) * 65536 + 1
        out = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b & _MASK, dtype=np.uint64)
            p[0] = 1
            out.append(np.cumprod(p, dtype=np.uint64))
        have = _powers[base] = (out[0], out[1])
    return have


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from 64-bit hashes."""
    return ((x >> np.uint64(12)).astype(np.float64) + 0.5) * 2.0**-52


def runs_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int = 0) -> np.ndarray:
    """Hash of each run ``values[start:end]`` (unsigned numbers), its length included."""
    pow_, inv = _power(_BASES[base], len(values))
    total = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * pow_[: len(values)], out=total[1:])
    run = (total[ends] - total[starts]) * inv[starts]
    return mix(run + (ends - starts).astype(np.uint64) * np.uint64(_BASES[3]))


class Words(NamedTuple):
    """The words of a chunk of rows, in order."""

    row: np.ndarray  # row of the chunk that holds the word
    start: np.ndarray  # byte span in ``data``
    end: np.ndarray
    data: np.ndarray
    first: np.ndarray  # index of each row's first word; one entry more than rows

    def hashes(self, base: int = 0) -> np.ndarray:
        return runs_hash(self.data, self.start, self.end, base)

    def windows(self, hashes: np.ndarray, n: int, base: int = 2) -> tuple[np.ndarray, np.ndarray]:
        """Start index and hash of every run of ``n`` words that lies in one row."""
        at = np.arange(max(0, len(hashes) - n + 1))
        at = at[self.row[at] == self.row[at + n - 1]] if len(at) else at
        return at, runs_hash(hashes, at, at + n, base)


def bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array (null: empty) and the border of each row in them."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, borders, data = texts.buffers()
    edge = np.frombuffer(borders, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[edge[0] : edge[-1]], edge - edge[0]


def words_of(texts: pa.Array) -> Words:
    data, edge = bytes_of(texts)
    space = _IS_SPACE[data]
    opens = np.ones(len(data) + 1, dtype=bool)  # is there a border before byte i?
    opens[1:] = space
    opens[edge] = True
    start = np.flatnonzero(~space & opens[: len(data)])
    closes = np.append(space[1:], True) if len(data) else np.zeros(0, dtype=bool)
    if len(data):
        inner = edge[(edge > 0) & (edge <= len(data))]
        closes[inner - 1] = True
    end = np.flatnonzero(~space & closes) + 1
    row = np.searchsorted(edge, start, side="right") - 1
    first = np.searchsorted(row, np.arange(len(edge)), side="left")
    return Words(row, start, end, data, first)


def small_batches(spark, rows: int = BATCH_ROWS) -> None:
    """From now on this session sends Python workers batches of at most ``rows`` rows: the JVM builds each outside its
    heap and the worker holds it, so batches of whole texts make both large. No result depends on it."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= rows:
        spark.conf.set(name, str(rows))


def chunks(batch: pa.RecordBatch, column: str, most: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in order, in slices of about ``most`` bytes of text (one row at least)."""
    if batch.num_rows == 0:
        return
    size = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64))
    at = 0
    while at < batch.num_rows:
        base = size[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(size, base + most, side="right")))
        yield batch.slice(at, stop - at)
        at = stop


def keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` (null: the least long), ``_th`` (hash of the text), ``_text``: a row's identity and text.

    Rows that share an id but not a text stay apart; rows equal in both have equal results.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID).cast("long")).alias("_id"),
        F.xxhash64(text).alias("_th"), text.alias("_text"))
