"""Phrases whose words stand together, by prefix-free parsing.

A text is lower-cased (A-Z), split at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those at blanks
and tabs into words. Counts are per language (null: ``und``). A phrase is two to ``most`` words of one
piece that occur ``least`` times or more. Its score is that of its worst cut into two parts,
``floor(scale * a / (l + r))`` with the counts of phrase and parts; a phrase whose words lie
in a longer one that occurs ``cover`` percent as often goes.

1. Parsing: a word starts a chunk if a hash of it and the next word says so, so that equal
   passages have equal chunks wherever they stand. A chunk's own words reach to the next
   start; up to ``most - 1`` words of the last word's piece follow as overlap. Pieces stay
   parted within a chunk. The dictionary is the distinct (own, chunk) with their frequencies.
2. Counting goes over the dictionary only, each chunk weighing its frequency. An n-gram counts in the
   chunk of whose own words it starts, so what lies in an overlap counts once.
3. First, single words and pairs are counted by 64-bit hashes. A bitmap of those that occur
   ``least`` times or more (colliding ones together, so none is missed) is all that is
   broadcast; its size follows their number up to ``filter_bits``.
4. Then, exactly and as text: words and pairs in the bitmap, and longer n-grams all of
   whose pairs are in it. A frequent n-gram has frequent pairs, so none is lost. A fuller bitmap
   lets more pass, with the same result.
5. Phrases are cut, joined to the counts of their parts on (language, part), compared with
   the phrases inside them, and ranked: the first ``top`` by shares of a language, then of those.

Defined cases: a null text is empty; a text without words adds nothing; a null language counts
with ``und``; repeated rows count each; null ids and other columns do not matter; scores
are whole numbers, equal ones ordered by count, then by the phrase's bytes; very long texts are parsed in
one task each; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chartmart.session import stage

from . import text as T

LEAST = 30
MOST = 4
TOP = 2000
COVER = 80
SCALE = 2_000_000
PERIOD = 24  # words of a chunk, on the average
FILTER_BITS = 27  # the bitmap has at most 2 to this power bits: 16 MB
_SLICE = 15  # Spark makes bitmaps of 2 to this power bits
_HELD = 1_000_000
_PAIR = np.uint64(0xD6E8FEB86659FD93)  # any odd number

_SEPARATES = np.zeros(256, dtype=bool)
_SEPARATES[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
_GAP = _SEPARATES.copy()
_GAP[[ord(" "), ord("\t")]] = True


class Pieces:
    """The words of a chunk of texts, lower-cased, and the pieces that hold them."""

    def __init__(self, texts: pa.Array):
        data, edge = T.bytes_of(texts)
        upper = (data >= 65) & (data <= 90)
        self.data = data + (upper * np.uint8(32))
        gap = _GAP[data]
        n = len(data)
        opens = np.ones(n, dtype=bool)
        opens[1:] = gap[:-1]
        inner = edge[(edge > 0) & (edge < n)]
        opens[inner] = True
        closes = np.ones(n, dtype=bool)
        closes[:-1] = gap[1:]
        closes[inner - 1] = True
        self.start = np.flatnonzero(opens & ~gap)
        self.end = np.flatnonzero(closes & ~gap) + 1
        self.row = np.searchsorted(edge, self.start, side="right") - 1
        self.first = np.searchsorted(self.row, np.arange(len(edge)))
        self.inside = ~gap
        seps = np.cumsum(_SEPARATES[data])[self.start] if n else np.zeros(0, dtype=np.int64)
        new = np.ones(len(self.row), dtype=bool)
        new[1:] = (self.row[1:] != self.row[:-1]) | (seps[1:] != seps[:-1])
        at = np.flatnonzero(new)
        self.new = new
        self.stop = np.repeat(np.append(at[1:], len(new)), np.diff(np.append(at, len(new))))  # word after the piece's last

    def hashes(self, base: int) -> np.ndarray:
        return T.runs_hash(self.data, self.start, self.end, base)


def _chunks(p: Pieces, overlap: int, period: int) -> tuple[np.ndarray, np.ndarray, list[bytes]]:
    """Row, number of own words and text of each chunk. In it, words stand a blank apart, pieces a line feed."""
    n = len(p.row)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), []
    h = p.hashes(0)
    opens = np.zeros(n, dtype=bool)
    opens[:-1] = T.mix(h[:-1] * _PAIR + h[1:]) % np.uint64(period) == 0
    opens[:-1] &= p.row[:-1] == p.row[1:]
    opens[p.first[:-1][np.diff(p.first) > 0]] = True
    a = np.flatnonzero(opens)
    b = np.append(a[1:], n)
    stop = np.minimum(b + overlap, p.stop[b - 1])  # overlaps do not leave the last word's piece
    size = p.end - p.start
    to = np.cumsum(size + 1) - (size + 1)  # place of each word if one byte parts them
    out = np.empty(int(size.sum()) + n, dtype=np.uint8)
    out[np.arange(int(size.sum())) + np.repeat(np.arange(n), size)] = p.data[p.inside]
    out[to + size] = np.where(np.append(p.new[1:], True), 10, 32)
    line = out.tobytes()
    return p.row[a], b - a, [line[x:y] for x, y in zip(to[a].tolist(), (to + size)[stop - 1].tolist())]


def dictionary(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", most: int = MOST, period: int = PERIOD) -> DataFrame:
    """``lang, own, chunk, weight``: the distinct chunks of all texts, and how often each occurs."""

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                row, own, chunk = _chunks(Pieces(piece.column("_text")), most - 1, period)
                yield pa.RecordBatch.from_arrays([piece.column("_lang").take(pa.array(row)).cast(pa.string()), pa.array(own, pa.int32()),
                                                  pa.array(chunk, pa.binary()).cast(pa.string())], ["lang", "own", "chunk"])

    rows = docs.where(F.col(text_col).isNotNull()).select(F.coalesce(F.col(lang_col), F.lit("und")).alias("_lang"), F.col(text_col).alias("_text"))
    return rows.mapInArrow(parse, "lang string, own int, chunk string").groupBy("lang", "own", "chunk").agg(F.count("*").alias("weight"))


class _Grams:
    """N-grams of dictionary chunks that start in a chunk's own words."""

    def __init__(self, piece: pa.RecordBatch):
        self.words = p = Pieces(piece.column("_text"))
        own = np.asarray(piece.column("own"), dtype=np.int64)
        weight = np.asarray(piece.column("weight"), dtype=np.int64)
        self.lang = np.asarray(piece.column("_lh"), dtype=np.int64).view(np.uint64)[p.row]
        self.counts = np.arange(len(p.row)) - p.first[p.row] < own[p.row]
        self.weight = weight[p.row]
        self.own = [p.hashes(k) for k in (0, 1)]

    def whole(self, n: int) -> np.ndarray:
        """First words of all runs of ``n`` words of one piece, in overlaps too."""
        return np.flatnonzero(np.arange(len(self.words.row)) + n <= self.words.stop)

    def hash(self, at: np.ndarray, n: int, base: int = 0) -> np.ndarray:
        return T.mix(T.runs_hash(self.own[base], at, at + n, base + 2) ^ self.lang[at])


def _frequent(chunks: DataFrame, least: int) -> DataFrame:
    """``h``: hashes of the words and pairs that occur ``least`` times or more."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def flush(parts: list[tuple[np.ndarray, np.ndarray]]) -> Iterator[pa.RecordBatch]:
            if parts:
                h, w = (np.concatenate(x) for x in zip(*parts))
                order = np.argsort(h)
                h, w = h[order], w[order]
                first = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]])) if len(h) else np.zeros(0, np.int64)
                if len(first):
                    yield pa.RecordBatch.from_arrays([pa.array(h[first].view(np.int64)), pa.array(np.add.reduceat(w, first))], ["h", "n"])

        parts, held = [], 0
        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                g = _Grams(piece)
                for n in (1, 2):
                    at = g.whole(n)
                    at = at[g.counts[at]]
                    parts.append((g.hash(at, n), g.weight[at]))
                    held += len(at)
                if held > _HELD:
                    yield from flush(parts)
                    parts, held = [], 0
        yield from flush(parts)

    sent = chunks.mapInArrow(count, "h long, n long")
    return sent.groupBy("h").agg(F.sum("n").alias("n")).where(F.col("n") >= least).select("h")


def _bitmap(hashes: DataFrame, filter_bits: int) -> tuple[np.ndarray, int]:
    """Bitmap by the leading bits of the hashes, and their number."""
    bits = max(_SLICE, min(filter_bits, (16 * hashes.count()).bit_length()))
    at = F.shiftrightunsigned("h", 64 - bits)
    slices = hashes.groupBy(F.shiftright(at, _SLICE).alias("k")).agg(F.bitmap_construct_agg(at.bitwiseAND(F.lit((1 << _SLICE) - 1))).alias("bits"))
    out = np.zeros((1 << bits) // 8, dtype=np.uint8)
    for row in slices.collect():  # 2 to the power ``bits`` bits in all
        out[row["k"] << (_SLICE - 3) : (row["k"] + 1) << (_SLICE - 3)] = np.frombuffer(row["bits"], dtype=np.uint8)
    return out, bits


def frequent(chunks: DataFrame, least: int = LEAST, most: int = MOST, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, phrase, n`` of every run of one to ``most`` words that occurs ``least`` times or more.

    ``chunks`` is as ``dictionary`` gives it.
    """
    rows = chunks.select("lang", F.xxhash64("lang").alias("_lh"), "own", "weight", F.col("chunk").alias("_text"))
    bitmap, bits = _bitmap(stage(_frequent(rows, least), "frequent"), filter_bits)
    given = rows.sparkSession.sparkContext.broadcast(bitmap)

    def passing(h: np.ndarray) -> np.ndarray:
        at = h >> np.uint64(64 - bits)
        return (given.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 > 0

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, bytes], int] = {}

        def flush() -> pa.RecordBatch:
            langs, texts = zip(*total) if total else ((), ())
            out = pa.RecordBatch.from_arrays([pa.array(langs, pa.string()), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(total.values(), pa.int64())],
                                             ["lang", "phrase", "n"])
            total.clear()
            return out

        for batch in batches:
            for piece in T.chunks(batch, "_text"):
                g = _Grams(piece)
                langs = piece.column("lang").to_pylist()
                line = g.words.data.tobytes()
                pair = np.zeros(len(g.words.row) + most, dtype=bool)
                two = g.whole(2)
                pair[two] = passing(g.hash(two, 2))
                for n in range(1, most + 1):
                    at = g.whole(n)
                    at = at[g.counts[at]]
                    if n == 1:
                        at = at[passing(g.hash(at, 1))]
                    for k in range(n - 1):
                        at = at[pair[at + k]]
                    if not len(at):
                        continue
                    one, two_ = g.hash(at, n, 0), g.hash(at, n, 1)
                    order = np.lexsort((two_, one))
                    at, one, two_ = at[order], one[order], two_[order]
                    first = np.flatnonzero(np.concatenate([[True], (one[1:] != one[:-1]) | (two_[1:] != two_[:-1])]))
                    weight = np.add.reduceat(g.weight[at], first).tolist()
                    at = at[first]
                    for row, a, b, w in zip(g.words.row[at].tolist(), g.words.start[at].tolist(), g.words.end[at + n - 1].tolist(), weight):
                        key = (langs[row], line[a:b])
                        total[key] = total.get(key, 0) + w
                if len(total) > _HELD // 4:
                    yield flush()
        yield flush()

    sent = rows.mapInArrow(count, "lang string, phrase string, n long")
    return sent.groupBy("lang", "phrase").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def _part(words: str, first, n) -> F.Column:
    return F.array_join(F.slice(words, first, n), " ")


def collocations(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", least: int = LEAST, most: int = MOST, top: int = TOP,
                 cover: int = COVER, scale: int = SCALE, period: int = PERIOD, filter_bits: int = FILTER_BITS) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``top`` phrases of each language."""
    chunks = stage(dictionary(docs, lang_col, text_col, most, period), "dictionary")
    counts = stage(frequent(chunks, least, most, filter_bits), "counts")
    own = counts.withColumn("_w", F.split("phrase", " ")).withColumn("_n", F.size("_w")).where("_n > 1")
    cuts = own.select("lang", "phrase", F.col("n").alias("a"), F.explode(F.transform(F.sequence(F.lit(1), F.col("_n") - 1), lambda k: F.struct(
        k.alias("k"), _part("_w", 1, k).alias("left"), _part("_w", k + 1, F.col("_n") - k).alias("right")))).alias("_c")).select("lang", "phrase", "a", "_c.*")
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("left"), F.col("n").alias("l")), ["lang", "left"])
    cuts = cuts.join(counts.select("lang", F.col("phrase").alias("right"), F.col("n").alias("r")), ["lang", "right"])
    # decimals: products may pass 64 bits
    score = F.expr(f"cast({scale} as decimal(10,0)) * cast(a as decimal(20,0)) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))")
    scored = cuts.withColumn("_s", score).groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.min(F.struct("_s", "k", "l", "r")).alias("_b"))
    # the contiguous runs of two words or more inside each longer phrase
    inner = F.flatten(F.transform(F.sequence(F.lit(2), F.col("_n") - 1), lambda m: F.transform(
        F.sequence(F.lit(1), F.col("_n") - m + 1), lambda s: _part("_w", s, m))))
    longer = own.where("_n > 2").select("lang", F.explode(inner).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("_longer"))
    kept = scored.join(longer, ["lang", "phrase"], "left")
    covered = F.expr(f"100 * cast(_longer as decimal(20,0)) >= {cover} * cast(a as decimal(20,0))")
    kept = kept.where(~F.coalesce(covered, F.lit(False))).select("lang", "phrase", "a", F.col("_b.l").alias("l"), F.col("_b.r").alias("r"), F.col("_b._s").cast("long").alias("score"))
    by = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    shares = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    some = kept.withColumn("_share", F.pmod(F.xxhash64("phrase"), F.lit(shares)))
    some = some.withColumn("_r", F.row_number().over(Window.partitionBy("lang", "_share").orderBy(*by))).where(F.col("_r") <= top)
    best = some.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*by)).cast("long")).where(F.col("rank") <= top)
    sizes = chunks.groupBy("lang").agg(F.sum(F.col("own") * F.col("weight")).alias("n"))
    return best.join(sizes, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


_GRAM = " UNION ALL ".join(
    f"SELECT lang, {k} AS k, array_to_string(list_slice(w, i, i + {k - 1}), ' ') AS g FROM (SELECT lang, w, unnest(range(1, len(w) - {k} + 2)) AS i FROM p)" for k in range(1, MOST + 1))
ORACLE_SQL = rf"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM t),
f AS (SELECT lang, k, g, count(*) AS n FROM ({_GRAM}) GROUP BY ALL),
c AS (SELECT lang, g, n AS a, k, string_split(g, ' ') AS w FROM f WHERE k > 1 AND n >= {LEAST}),
x AS (SELECT lang, g, a, j, array_to_string(w[1:j], ' ') AS lp, array_to_string(w[j + 1:], ' ') AS rp FROM (SELECT *, unnest(range(1, k)) AS j FROM c)),
s AS (SELECT x.lang, x.g, x.a, x.j, l.n AS l, r.n AS r, ({SCALE}::HUGEINT * x.a) // (l.n + r.n) AS score
      FROM x JOIN f AS l ON l.lang = x.lang AND l.g = x.lp JOIN f AS r ON r.lang = x.lang AND r.g = x.rp),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
i AS (SELECT lang, array_to_string(list_slice(w, i0, i0 + m - 1), ' ') AS g, a
      FROM (SELECT *, unnest(range(1, k - m + 2)) AS i0 FROM (SELECT *, unnest(range(2, k)) AS m FROM c))),
o AS (SELECT lang, g, max(a) AS longer FROM i GROUP BY ALL),
k AS (SELECT b.* FROM b LEFT JOIN o ON o.lang = b.lang AND o.g = b.g WHERE o.longer IS NULL OR 100::HUGEINT * o.longer < {COVER}::HUGEINT * b.a),
n AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT k.lang, row_number() OVER (PARTITION BY k.lang ORDER BY score DESC, a DESC, g) AS rank, g AS phrase, a, l, r, n.n, score::BIGINT AS score
FROM k JOIN n ON n.lang = k.lang QUALIFY rank <= {TOP}
"""
