"""Byte-level BPE encoding and decoding by recursive DuckDB queries in each partition.

Texts are split by the tokenizer's pattern; the distinct pieces of a batch are encoded
once each. Every piece starts as rows of (piece, position, token), a token per byte (one
number, ``spot``, holds piece and position and gives the order of all rows). A recursive
query joins neighbouring rows to the merge table (left token, right token ->
token, its rank) and contracts, in every piece, the leftmost pair of least rank, until no
pair of any piece is in the table; a piece that has no pair left leaves the recursion as
an ordered list of tokens. Decoding joins token rows to the vocabulary and concatenates
their bytes by an ordered aggregate.

The merge table has a row for each way to cut a token into two tokens; as a merge's
result names its rank, the leftmost pair of least rank is what the byte-pair rule merges
next. DuckDB runs inside the task, with one thread and a bound on its memory; nothing but
the merge table (bounded by the vocabulary) is broadcast, and partitions stay as read.
Batches are of ``text.BATCH_ROWS`` rows; a Python worker remembers a bounded number of pieces,
also from one partition to the next that it is given.

The pieces of a batch are encoded in groups of about ``_GROUP`` bytes. A piece of ``n``
bytes takes up to ``n`` rounds over its own rows: cheap for words, and for one of several
thousand letters without a break the one place where time grows with its square.

Defined cases: a null text is empty and has no tokens; special tokens' strings are
ordinary text; ids out of the vocabulary cannot be decoded and raise; repeated rows have
equal results; null ids and other columns do not matter; an empty table gives no rows.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import chain
from typing import ClassVar

import duckdb
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from . import text as T

_GROUP = 1 << 18
_MEMORY = "400MB"
_KNOWN = 200_000  # pieces remembered: the latest so many at least, twice as many at most (and those of a batch)


def read_ranks(spark: SparkSession, path: str) -> dict[bytes, int]:
    """Token bytes and ranks from a rank file (a line: base64, space, rank), on the driver: as large as the vocabulary."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _digest_of(ranks: dict[bytes, int]) -> str:
    return hashlib.sha256(b"".join(b"%d %d " % (len(t), r) + t for t, r in ranks.items())).hexdigest()


def merge_table(ranks: dict[bytes, int]) -> pa.Table:
    """(left, right, token): every way to cut a token into two."""
    rows = [(ranks[t[:k]], ranks[t[k:]], r) for t, r in ranks.items() for k in range(1, len(t)) if t[:k] in ranks and t[k:] in ranks]
    return pa.table({n: pa.array([x[i] for x in rows], pa.int32()) for i, n in enumerate(("l", "r", "token"))})


_ENCODE = """
WITH RECURSIVE state(piece, spot, token, done) AS (
  SELECT piece, piece::BIGINT << 32 | pos, token, false FROM bytes
  UNION ALL
  (WITH near AS (SELECT piece, spot, token, lead(token) OVER following AS next, lead(spot) OVER following AS next_spot
                 FROM state WHERE NOT done WINDOW following AS (ORDER BY spot)),
   pairs AS MATERIALIZED (
     SELECT n.piece, n.spot, n.token, n.next_spot, m.token::BIGINT << 32 | (n.spot & 4294967295) AS rank
     FROM near n LEFT JOIN merges m ON m.l = n.token AND m.r = n.next AND n.next_spot >> 32 = n.piece),
   least AS MATERIALIZED (SELECT piece, min(rank) AS rank, arg_min(next_spot, rank) AS gone FROM pairs GROUP BY piece)
   SELECT p.piece, p.spot, CASE WHEN p.rank = l.rank THEN (l.rank >> 32)::INTEGER ELSE p.token END, l.rank IS NULL
   FROM pairs p JOIN least l ON l.piece = p.piece WHERE p.spot IS DISTINCT FROM l.gone))
SELECT piece, list(token ORDER BY spot) AS ids FROM state WHERE done GROUP BY piece ORDER BY piece
"""

_DECODE = """
SELECT string_agg(v.hex, '' ORDER BY t.pos) AS hex, count(v.hex) = count(*) AS known, t.piece
FROM (SELECT piece, unnest(ids) AS token, generate_subscripts(ids, 1) AS pos FROM lists) t LEFT JOIN vocabulary v ON v.token = t.token
GROUP BY t.piece ORDER BY t.piece
"""


class Codec:
    """Encodes and decodes pieces in an in-memory DuckDB of this process."""

    def __init__(self, ranks: dict[bytes, int], merges: pa.Table):
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": "1", "memory_limit": _MEMORY, "temp_directory": ""})
        # the tables built for the joins are the merges and one row a piece; estimates of a recursion's rows mislead
        self.db.execute("SET disabled_optimizers = 'join_order,build_side_probe_side'")
        words = pa.table({"token": pa.array(list(ranks.values()), pa.int32()), "hex": pa.array([t.hex() for t in ranks])})
        for name, table in (("merges", merges), ("vocabulary", words)):
            self.db.register("given", table)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def _ask(self, query: str, name: str, rows: pa.Table) -> pa.Table:
        self.db.register(name, rows)
        found = self.db.sql(query).to_arrow_table()
        self.db.unregister(name)
        return found

    def encode(self, pieces: list[bytes]) -> pa.ChunkedArray:
        """The ids of each piece; no piece may be empty."""
        size = np.array([len(p) for p in pieces], dtype=np.int64)
        group = np.cumsum(size) // _GROUP
        out = []
        for low, high in zip(*(np.searchsorted(group, np.unique(group), side=s) for s in ("left", "right"))):
            own = size[low:high]
            rows = pa.table({
                "piece": np.repeat(np.arange(len(own), dtype=np.int32), own),
                "pos": (np.arange(own.sum()) - np.repeat(np.cumsum(own) - own, own)).astype(np.int32),
                "token": self.byte[np.frombuffer(b"".join(pieces[low:high]), dtype=np.uint8)]})
            out += self._ask(_ENCODE, "bytes", rows).column("ids").chunks
        return pa.chunked_array(out, pa.list_(pa.int32()))

    def decode(self, lists: pa.ChunkedArray) -> list[bytes]:
        """What each list of ids stands for."""
        out = [b""] * len(lists)
        found = self._ask(_DECODE, "lists", pa.table({"piece": np.arange(len(lists), dtype=np.int32), "ids": lists}))
        if not all(found.column("known").to_pylist()):
            raise ValueError("an id is not in the vocabulary")
        for piece, text in zip(found.column("piece").to_pylist(), found.column("hex").to_pylist()):
            out[piece] = bytes.fromhex(text)
        return out

    def listed(self, lists: pa.ChunkedArray) -> list[str]:
        """The ids of each list in decimal, joined by commas."""
        return self._ask("SELECT array_to_string(ids, ',') AS text FROM lists", "lists", pa.table({"ids": lists})).column("text").to_pylist()


def _encoded(docs: DataFrame, path: str, pattern: str, columns: list[str], text_col: str, finish, schema: str) -> DataFrame:
    """Rows of ``columns`` and what ``finish(texts, pieces, ids, codec)`` makes of each batch."""
    spark = docs.sparkSession
    T.small_batches(spark)
    ranks = read_ranks(spark, path)
    given = spark.sparkContext.broadcast((ranks, merge_table(ranks)))
    whose = _digest_of(ranks)
    kept = [docs.schema[c] for c in columns]
    made = StructType.fromDDL(schema)
    target = StructType(kept + made.fields)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, known = regex.compile(pattern), None
        for batch in batches:
            for part in T.chunks(batch, "_text"):
                known = known or _Known(Codec(*given.value), finish, whose)
                pieces = [split.findall(t or "") for t in part.column("_text").to_pylist()]
                columns_made = finish.rows(pieces, *known.of(chain.from_iterable(pieces)))
                yield pa.RecordBatch.from_arrays([part.column(c) for c in columns] + columns_made, names=[*columns, *made.names])
        if known:  # the worker lives on
            known.leave()
            known.codec.db.close()
            pa.default_memory_pool().release_unused()

    rows = docs.select(*columns, F.col(text_col).alias("_text"))
    return rows.mapInArrow(encode, target)


class _Known:
    """What ``finish.memo`` gives for the pieces of a partition, in a dictionary for each of its lists.

    Two generations bound it: a full one is set aside, its pieces are taken over when they are
    met again and the others are dropped with it, to be encoded again if they come back.
    The worker's next partition with the same tokenizer (``whose``) starts with what a finished
    one knew; a partition that fails leaves nothing.
    """

    _left: ClassVar[dict] = {}  # of this process, for one tokenizer and ``finish`` at a time

    def __init__(self, codec: Codec, finish, whose: str = ""):
        self.codec, self.finish, self.key = codec, finish, (whose, finish)
        none = ({},) * finish.width
        self.young, self.old = self._left.pop(self.key, (none, none))
        self._left.clear()

    def leave(self) -> None:
        self._left[self.key] = self.young, self.old

    def of(self, pieces: Iterable[str]) -> tuple[dict, ...]:
        """Dictionaries that hold all of ``pieces``."""
        if not self.young[0] or len(self.young[0]) > _KNOWN:
            self.young, self.old = tuple({} for _ in self.young), self.young
        first = self.young[0]
        missing = [p for p in dict.fromkeys(pieces) if p not in first]
        before = self.old[0]
        again = [p for p in missing if p in before]
        for young, old in zip(self.young, self.old):
            young.update((p, old[p]) for p in again)
        new = [p for p in missing if p not in first]
        if new:
            for young, made in zip(self.young, self.finish.memo(new, self.codec)):
                young.update(zip(new, made))
        return self.young


class _Ids:
    """A list of ids per text."""

    width = 1

    @staticmethod
    def memo(pieces: list[str], codec: Codec) -> tuple[list, ...]:
        return (codec.encode([p.encode() for p in pieces]).to_pylist(),)

    @staticmethod
    def rows(pieces: list[list[str]], known: dict) -> list[pa.Array]:
        return [pa.array([[i for p in own for i in known[p]] for own in pieces], pa.list_(pa.int32()))]


class _Digest:
    """Number of ids, digest of the ids, and digest of the bytes that the ids decode to."""

    width = 2

    @staticmethod
    def memo(pieces: list[str], codec: Codec) -> tuple[list, ...]:
        ids = codec.encode([p.encode() for p in pieces])
        back = [x.decode() for x in codec.decode(ids)]
        return codec.listed(ids), [p if p == x else x for p, x in zip(pieces, back)]  # equal texts are held once

    @staticmethod
    def rows(pieces: list[list[str]], listed: dict, back: dict) -> list[pa.Array]:
        n, ids, decoded = [], [], []
        for own in pieces:
            text = ",".join(map(listed.__getitem__, own))
            n.append(text.count(",") + 1 if own else 0)  # no piece is without ids
            ids.append(hashlib.sha256(text.encode()).hexdigest())
            decoded.append(hashlib.sha256("".join(map(back.__getitem__, own)).encode()).hexdigest())
        return [pa.array(n, pa.int64()), pa.array(ids), pa.array(decoded)]


def encode(docs: DataFrame, path: str, pattern: str, columns: list[str], text_col: str = "text") -> DataFrame:
    """``columns`` and ``ids``, the token ids of each text."""
    return _encoded(docs, path, pattern, columns, text_col, _Ids, "ids array<int>")


def decode(rows: DataFrame, path: str, columns: list[str], ids_col: str = "ids") -> DataFrame:
    """``columns`` and ``bytes``, what the ids of each row stand for."""
    ranks = read_ranks(rows.sparkSession, path)
    given = rows.sparkSession.sparkContext.broadcast((ranks, merge_table({})))
    def back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = None
        for batch in batches:
            codec = codec or Codec(*given.value)
            lists = pa.chunked_array([batch.column("_ids").fill_null(pa.scalar([], pa.list_(pa.int32())))])
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in columns] + [pa.array(codec.decode(lists), pa.binary())], names=[*columns, "bytes"])

    target = StructType([rows.schema[c] for c in columns] + [StructField("bytes", BinaryType())])
    return rows.select(*columns, F.col(ids_col).alias("_ids")).mapInArrow(back, target)


def digest(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    return _encoded(docs, path, pattern, [id_col], text_col, _Digest, "n_tokens bigint, ids_sha256 string, decoded_sha256 string")


def query(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return digest(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
