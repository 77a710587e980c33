"""Mixing sources to target weights by a multivariate-hypergeometric splitting tree, in DataFrame
functions only.

Sources in code-point order (null last) weigh 5, 2, 1, 5, 2, 1, ... and share 150% of all
words; a target stops at twice its source's size and the excess is shared anew by weight.

1. A document falls into one of its source's blocks by a hash; a source has about one
   block for every ``block_words`` words. A source whose target is ``e`` times its size
   and some more words uses all of its blocks ``e`` times, and in one more pass blocks in a
   permuted order until the rest is met. The last block is used in part: documents by a
   hash until the words suffice, the last document in part too.
2. The numbers of blocks each source uses are its quotas. A tree halves the output shards;
   at each node the left half's quotas are drawn from a multivariate hypergeometric law,
   source by source, so the shards get exact, disjoint shares that are as random as a full
   shuffle of all blocks. A node is one row with a number for each source.
3. Each leaf draws its quota from the source's permuted blocks, next to what the shards
   before it draw: block ranks are joined to shards on (source, rank).
4. Within a shard, the order is by a hash of document and pass; ``mixed_rows`` gives the mix in this
   order, a shard in as many slices as its words ask for.

Running totals over blocks are taken in ``CELLS`` cells per source by the permutation's
hash, then inside a cell, so that no window holds a whole source. Joins and sums are on
(source, block) or (source, rank), never on the source alone. Draws and permutations come
from hashes of the seed, so reruns agree.

Defined cases: a null text has no words; a document without words takes none; a null
source is a source; repeated rows are numbered and drawn each by itself; other columns do
not matter; an empty table gives no rows, one without words targets of 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmart.session import stage

from . import text as T
from .sqlmath import let, log_choose

WEIGHTS = (5, 2, 1)
TOTAL = 1.5  # of all words
MOST = 2.0  # times its own size
BLOCK_WORDS = 4096
SHARDS = 16
SLICE_WORDS = 1 << 24  # of a shard, sorted by one task
CELLS = 1024
SEED = 7


def _draw(*parts: Column | str | int) -> Column:
    """A number of 60 bits from a hash of the parts; the same in any engine that has MD5."""
    text = F.concat_ws(":", *[F.coalesce(x.cast("string"), F.lit("-")) if isinstance(x, Column) else F.lit(str(x)) for x in parts])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def _unit(*parts: Column | str | int) -> Column:
    return (_draw(*parts).cast("double") + 0.5) / float(1 << 60)


def targets(sizes: DataFrame, total: float = TOTAL, most: float = MOST, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """``source, source_size, target`` from rows of ``source, size``: a row per source."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    own = own.withColumn("rank", F.row_number().over(by_name) - 1)
    own = own.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), (F.col("rank") % len(weights) + 1).cast("int")))
    # filled to the brim in the order of size by weight, while the level is above the brim
    order = Window.orderBy(F.col("source_size") / F.col("weight"), "rank")
    own = own.withColumn("cap", F.col("source_size") * most)
    before = F.coalesce(F.sum("cap").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum("weight").over(order.rowsBetween(0, Window.unboundedFollowing))
    level = (F.sum("source_size").over(Window.partitionBy()) * total - before) / left
    own = own.withColumn("level", level).withColumn("full", F.col("level") * F.col("weight") >= F.col("cap"))
    # the level stays once a source is not full; it is that of the first such source in the order
    first = F.first(F.when(~F.col("full"), F.col("level")), ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return own.select("source", "rank", "source_size", F.when(F.col("full"), F.col("cap")).otherwise(F.col("weight") * first).alias("target"))


def _hypergeometric(u: Column, marked: Column, others: Column, drawn: Column) -> Column:
    """The ``u`` quantile, counted outwards from the mode, of how many of ``drawn`` items are marked."""
    low, high = F.greatest(F.lit(0), drawn - others), F.least(drawn, marked)
    all_ = marked + others
    mode = F.greatest(low, F.least(high, F.floor((drawn + 1) * (marked + 1) / (all_ + 2)).cast("long")))

    def walk(mode: Column) -> Column:
        at_mode = F.exp(log_choose(marked, mode) + log_choose(others, drawn - mode) - log_choose(all_, drawn))
        # as many steps as forty standard deviations, or all there are
        spread = F.sqrt(drawn * (marked / F.greatest(all_, F.lit(1))) + 1)
        steps = F.least(high - low, (40 * spread + 20).cast("long"))
        start = F.struct((u - at_mode).alias("u"), mode.alias("lo"), mode.alias("hi"), at_mode.alias("plo"), at_mode.alias("phi"),
                         F.when(u < at_mode, mode).alias("got"))

        def step(acc: Column, i: Column) -> Column:
            # one value up, then one down; a value out of range has no chance
            hi, lo = acc["hi"], acc["lo"]
            phi = F.when(hi < high, acc["phi"] * (marked - hi) * (drawn - hi) / ((hi + 1) * (others - drawn + hi + 1))).otherwise(0.0)
            plo = F.when(lo > low, acc["plo"] * lo * (others - drawn + lo) / ((marked - lo + 1) * (drawn - lo + 1))).otherwise(0.0)
            got = F.coalesce(acc["got"], F.when(acc["u"] < phi, hi + 1), F.when(acc["u"] - phi < plo, lo - 1))
            return F.struct((acc["u"] - phi - plo).alias("u"), F.greatest(lo - 1, low).alias("lo"), F.least(hi + 1, high).alias("hi"),
                            plo.alias("plo"), phi.alias("phi"), got.alias("got"))

        return F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(steps, F.lit(1))), start, step, lambda acc: F.coalesce(acc["got"], mode))

    return F.when(low >= high, high).otherwise(let(mode, walk))


def _share(seed: int, level: int):
    """Step over the sources of a node: the next source's part of what the left half still draws."""

    def step(acc: Column, x: Column) -> Column:
        u = _unit(seed, "tree", level, F.col("shard"), F.size(acc["got"]))
        drawn = F.when(acc["left"] == 0, F.lit(0).cast("long")).otherwise(_hypergeometric(u, x, acc["all"] - x, acc["left"]))
        return let(drawn, lambda n: F.struct((acc["left"] - n).alias("left"), (acc["all"] - x).alias("all"), F.concat(acc["got"], F.array(n)).alias("got")))

    return step


def splitting_tree(quotas: DataFrame, shards: int = SHARDS, seed: int = SEED) -> DataFrame:
    """``rank, shard, first, number``: the run of each source's permuted blocks that a shard draws.

    ``quotas`` has ``rank`` (of the source, from 0) and ``quota``: a row per source.
    """
    node = quotas.agg(F.transform(F.sort_array(F.collect_list(F.struct("rank", "quota"))), lambda x: x["quota"]).alias("quota"))
    node = node.select(F.lit(0).alias("shard"), F.lit(shards).alias("width"), F.col("quota"), F.transform("quota", lambda x: F.lit(0).cast("long")).alias("first"))
    depth = max(1, (shards - 1).bit_length())
    for level in range(depth):
        half = F.ceil(F.col("width") / 2).cast("int")
        total = F.aggregate("quota", F.lit(0).cast("long"), lambda a, x: a + x)
        # the left half of the shards takes its share of the blocks, to the nearest block
        node = node.withColumn("half", half).withColumn("total", total).withColumn("want", F.floor(F.col("total") * F.col("half") / F.col("width")).cast("long"))
        start = F.struct(F.col("want").alias("left"), F.col("total").alias("all"), F.array().cast("array<bigint>").alias("got"))

        node = node.withColumn("got", F.aggregate("quota", start, _share(seed, level), lambda acc: acc["got"]))
        left = F.struct(F.col("shard"), F.col("half").alias("width"), F.col("got").alias("quota"), F.col("first"))
        right = F.struct((F.col("shard") + F.col("half")).alias("shard"), (F.col("width") - F.col("half")).alias("width"),
                         F.zip_with("quota", "got", lambda q, g: q - g).alias("quota"), F.zip_with("first", "got", lambda f, g: f + g).alias("first"))
        split = F.when(F.col("width") > 1, F.array(left, right)).otherwise(F.array(F.struct("shard", "width", "quota", "first")))
        node = stage(node.select(F.explode(split).alias("n")).select("n.*"), f"tree{level}")
    leaf = node.select("shard", F.posexplode(F.arrays_zip("quota", "first")).alias("rank", "x"))
    return leaf.select("rank", "shard", F.col("x.first").alias("first"), F.col("x.quota").alias("number")).where("number > 0")


def placed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                slice_words: int = SLICE_WORDS, **options) -> DataFrame:
    """``row, shard, place``: a row for each use of a document in the mix, each shard's rows together and in its
    order; where only the first words of a document are used, the text ends there.

    Texts are shuffled twice: once to meet their uses (rows are numbered and joined by the same key), once to
    their shard. A shard is cut into slices by place, as many as all words ask for, so that no task holds a shard.
    """
    rows, mixed = mix(docs, id_col, text_col, source_col, **options)
    total = rows.agg(F.sum("size")).first()[0] or 0
    slices = max(1, -int(-total * TOTAL // (options.get("shards", SHARDS) * slice_words)))

    def key(id_, source):
        return F.coalesce(id_.cast("long"), F.lit(T.NO_ID)).alias("_i"), F.coalesce(F.concat(F.lit("="), source), F.lit("")).alias("_s")

    uses = mixed.select(*key(F.col("doc_id"), F.col("source")), F.col("size").alias("_n"), "copy", "words", "shard", "place")
    uses = uses.groupBy("_i", "_s", "_n").agg(F.collect_list(F.struct("copy", "words", "shard", "place")).alias("_uses"))
    rows = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), *key(F.col(id_col), F.col(source_col)), T.n_words(F.col(text_col)).alias("_n"))
    numbered = rows.withColumn("_copy", F.row_number().over(Window.partitionBy("_i", "_s", "_n").orderBy(F.xxhash64(F.col("row")[text_col]))))
    used = numbered.join(uses.hint("merge"), ["_i", "_s", "_n"])
    used = used.withColumn("_use", F.explode(F.filter("_uses", lambda u: u["copy"] == F.col("_copy"))))
    text = F.col("row")[text_col]
    text = F.when(F.col("_use.words") == F.col("_n"), text).otherwise(first_words(text, F.col("_use.words")))
    out = used.select(F.col("row").withField(text_col, text).alias("row"), "_use.shard", "_use.place")
    # places are numbers of 60 bits
    out = out.withColumn("_slice", F.shiftright(F.shiftright("place", 30) * F.lit(slices).cast("long"), 30))
    return out.repartition("shard", "_slice").sortWithinPartitions("shard", "_slice", "place").drop("_slice")


def mixed_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """The mix as rows like those of ``docs``, shard by shard in the order of ``placed_rows``."""
    return placed_rows(docs, id_col, text_col, source_col, **options).select("row.*")


def first_words(text: Column, n: Column) -> Column:
    """A text up to the end of its ``n``th word."""
    words, gaps = F.regexp_extract_all(text, F.lit(T.WORD), F.lit(0)), F.split(text, T.WORD, -1)
    return F.array_join(F.flatten(F.slice(F.transform(F.arrays_zip(gaps.alias("g"), words.alias("w")), lambda x: F.array(x["g"], x["w"])), 1, n.cast("int"))), "")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", shards: int = SHARDS,
        block_words: int = BLOCK_WORDS, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """The documents (``_ROW``) and the mix: a row for each use of a document with the same columns, the
    ``pass``, the ``words`` used, the ``shard`` and the ``place`` in it.
    """
    own = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).alias("source"), T.n_words(F.col(text_col)).alias("size"))
    same = Window.partitionBy("doc_id", "source", "size").orderBy("size")  # repeated rows are told apart
    own = own.withColumn("copy", F.row_number().over(same))
    own = stage(own, "sizes")
    sources = stage(targets(own).withColumn("passes", F.when(F.col("source_size") == 0, F.lit(0)).otherwise(
        F.floor(F.col("target") / F.col("source_size"))).cast("int")).withColumn(
        "rest", F.round(F.col("target") - F.col("passes") * F.col("source_size")).cast("long")).withColumn(
        "blocks", F.greatest(F.lit(1), F.ceil(F.col("source_size") / block_words)).cast("long")), "sources")
    doc = F.col("doc_id"), F.col("copy")
    rows = own.join(sources, own["source"].eqNullSafe(sources["source"])).select(
        "doc_id", own["source"], "size", "copy", "rank", "source_size", "target", F.pmod(_draw(seed, "block", *doc), F.col("blocks")).alias("block"))
    used = rows.where("size > 0")
    blocks = stage(used.groupBy("rank", "block").agg(F.sum("size").alias("words")).withColumn(
        "h", _draw(seed, "order", F.col("rank"), F.col("block"))).withColumn("cell", F.pmod("h", F.lit(CELLS))), "blocks")
    # running totals in permuted order: over cells, then in a cell
    cells = blocks.groupBy("rank", "cell").agg(F.sum("words").alias("w"), F.count("*").alias("n"))
    earlier = Window.partitionBy("rank").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = cells.select("rank", "cell", F.coalesce(F.sum("w").over(earlier), F.lit(0)).alias("cell_words"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("cell_blocks"))
    inside = Window.partitionBy("rank", "cell").orderBy("h", "block")
    placed = blocks.join(cells, ["rank", "cell"]).join(sources.select("rank", "passes", "rest"), "rank")
    placed = placed.withColumn("at", F.col("cell_blocks") + F.row_number().over(inside) - 1).withColumn(
        "before", F.col("cell_words") + F.sum("words").over(inside) - F.col("words"))
    n_blocks = blocks.groupBy("rank").agg(F.count("*").alias("n"))
    # every use of a block: whole passes first, then the one in part; ``at`` counts on over the passes
    uses = placed.join(n_blocks, "rank").withColumn("pass", F.explode(F.sequence(F.lit(0), F.col("passes")))).where(
        (F.col("pass") < F.col("passes")) | (F.col("before") < F.col("rest"))).select(
        "rank", "block", "words", "pass", (F.col("pass") * F.col("n") + F.col("at")).alias("at"),
        F.when(F.col("pass") < F.col("passes"), F.col("words")).otherwise(F.least(F.col("words"), F.col("rest") - F.col("before"))).alias("need"))
    uses = stage(uses, "uses")
    quotas = sources.select("rank").join(uses.groupBy("rank").agg(F.count("*").alias("quota")), "rank", "left").select("rank", F.coalesce("quota", F.lit(0)).alias("quota"))
    drawn = splitting_tree(quotas, shards, seed).select("rank", "shard", F.explode(F.sequence("first", F.col("first") + F.col("number") - 1)).alias("at"))
    sharded = uses.join(drawn, ["rank", "at"])
    # a block in part: its documents by a hash until the words suffice, the last in part
    take = sharded.join(used, ["rank", "block"])
    turn = _draw(seed, "turn", F.col("pass"), *doc)
    whole = take.where("need >= words").withColumn("words", F.col("size"))
    order = Window.partitionBy("rank", "block", "pass").orderBy(turn, "doc_id", "copy")
    part = take.where("need < words").withColumn("done", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)) - F.col("size"))
    part = part.where("done < need").withColumn("words", F.least(F.col("size"), F.col("need") - F.col("done"))).drop("done")
    place = _draw(seed, "place", F.col("shard"), F.col("pass"), *doc).alias("place")
    mixed = whole.unionByName(part).select(*_ROW, "pass", "words", "shard", place)
    return rows.select(*_ROW), mixed


_ROW = ("doc_id", "source", "size", "copy", "source_size", "target")


def taken(docs: DataFrame, **options) -> DataFrame:
    """Per document: ``doc_id, source, size, copy, source_size, target`` and ``taken``, the words the mix uses."""
    rows, mixed = mix(docs, **options)
    uses = rows.withColumn("words", F.lit(0).cast("long")).unionByName(mixed.select(*_ROW, "words"))
    return uses.groupBy(*_ROW).agg(F.sum("words").alias("taken"))


def query(spark, sf_dir: str) -> DataFrame:
    return taken(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source", "copy")


ORACLE_SQL = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY doc_id, source, size) AS copy FROM d),
s AS (SELECT source, sum(size)::BIGINT AS n, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS rank FROM o GROUP BY source),
w AS (SELECT *, [5, 2, 1][rank % 3 + 1] AS weight, n * {MOST}::DOUBLE AS cap FROM s),
l AS (SELECT *, (sum(n) OVER () * {TOTAL}::DOUBLE - coalesce(sum(cap) OVER (f ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
        / sum(weight) OVER (f ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w WINDOW f AS (ORDER BY n / weight, rank)),
v AS (SELECT arg_min(level, (n / weight, rank)) AS level FROM l WHERE level * weight < cap),
t AS (SELECT source, rank, n, CASE WHEN l.level * weight >= cap THEN cap ELSE weight * v.level END AS target FROM l LEFT JOIN v ON true),
p AS (SELECT *, CASE WHEN n = 0 THEN 0 ELSE floor(target / n) END::BIGINT AS passes, greatest(1, ceil(n / {BLOCK_WORDS}::DOUBLE))::BIGINT AS blocks FROM t),
r AS (SELECT doc_id, size, copy, rank, n, target, passes, round(target - passes * n)::BIGINT AS rest,
        ('0x' || md5(concat_ws(':', '{SEED}', 'block', coalesce(doc_id::VARCHAR, '-'), copy::VARCHAR))[1:15])::BIGINT % blocks AS block,
        ('0x' || md5(concat_ws(':', '{SEED}', 'turn', passes::VARCHAR, coalesce(doc_id::VARCHAR, '-'), copy::VARCHAR))[1:15])::BIGINT AS turn
      FROM o JOIN p ON o.source IS NOT DISTINCT FROM p.source),
b AS (SELECT *, ('0x' || md5(concat_ws(':', '{SEED}', 'order', rank::VARCHAR, block::VARCHAR))[1:15])::BIGINT AS h FROM r),
c AS (SELECT *, coalesce(sum(size) OVER (PARTITION BY rank ORDER BY h % {CELLS}, h, block, turn, doc_id, copy ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM b)
SELECT doc_id, size, n AS source_size, target, (passes * size + greatest(0, least(size, rest - before)))::BIGINT AS taken FROM c
"""
