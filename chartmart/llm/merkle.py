"""A Merkle manifest of a dataset: leaves per row, a tree per group, one root, a proof per row.

H is the lowercase hex SHA-256 of its inputs put together, digests as hex text. A leaf is H
of a row's fields, each ``-`` if null, else its UTF-8 byte count, a colon and the value. In a
group, leaves ascend by id; every ``fan`` nodes in a row become their H (the last run may have
fewer, even one) until one remains, the group's subroot. Subroots, by group (null first, then
bytewise), become the root in the same way.

1. Leaves are hashed where the rows lie; only id, group and digests go on. They are numbered
   in their group by range partitions and running counts of partitions, with no window over
   rows.
2. ``fan ** height`` leaves that stand together form an aligned block. A block keeps each of
   its levels as one string of hex digits; SHA-256 of its fixed-width substrings, ``fan``
   digests wide, makes the next level. The block's last digest is a leaf of the next round of
   blocks, and so on until one block is left of each group. Subroots go through the same
   rounds.
3. A node's siblings are the substrings to its left and right within its run. From the top
   down, each block's leaves take the block's own path after theirs, so that a row's path is
   the segments of its blocks put together. Folding H over it gives the root again.

Nothing but the height of the tallest tree comes to the driver. A task holds single blocks;
a group of any size is many blocks. Joins are on (group, block), never on the group alone.

Defined cases: null ids sort first; rows that share an id are ordered by their leaf, so equal
rows are interchangeable; a null group is a group; a group of one row has its leaf as
subroot; with one group alone, its subroot is the root; a null or empty text differ in
their leaves; very long texts are hashed where they lie; columns that are no fields do not
matter, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartmart.session import stage

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
FAN = 2
HEIGHT = 8  # levels of a block: 256 leaves, 16 KB a level at most
_HEX = 64
_POS_BITS = 33  # monotonically_increasing_id is the partition, then the place in it


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def _placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``_pos``, the place (from 0) in the group ``_g`` by ``order``, and ``_size`` of the group."""
    by = [F.col(c).asc_nulls_first() for c in ["_g", *order]]
    tagged = rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id())
    tagged = stage(tagged, name).withColumn("_part", F.shiftright("_at", _POS_BITS))
    own = Window.partitionBy("_g")  # as many rows as the group has partitions
    before = F.sum("_n").over(own.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    runs = tagged.groupBy("_g", "_part").agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    runs = runs.select("_g", "_part", (F.coalesce(before, F.lit(0)) - F.col("_from")).alias("_shift"), F.sum("_n").over(own).alias("_size"))
    placed = tagged.join(stage(runs, f"{name}-runs"), ["_g", "_part"])
    return placed.withColumn("_pos", F.col("_at") + F.col("_shift")).drop("_at", "_part", "_shift")


def _until(n: Column) -> Column:
    """0 to ``n - 1``, or nothing."""
    return F.when(n > 0, F.sequence(F.lit(0), n.cast("int") - 1)).otherwise(F.array().cast("array<int>"))


def _power(fan: int, k: Column) -> Column:
    return F.pow(F.lit(fan), k).cast("long")


def _levels(n: Column, fan: int) -> Column:
    """How often ``n`` nodes are to be put together until one is left."""
    return F.size(F.filter(F.sequence(F.lit(0), F.lit(62)), lambda k: F.pow(F.lit(fan), k) < n))


def _parents(level: Column, fan: int) -> Column:
    """The next level: H of each run of ``fan`` digests of the level's string."""
    runs = F.ceil(F.length(level) / F.lit(_HEX * fan))
    hashed = F.transform(_until(runs), lambda j: F.sha2(F.substring(level, j * (_HEX * fan) + 1, F.lit(_HEX * fan)), 256))
    return F.array_join(hashed, "").cast("binary")


def _blocks(nodes: DataFrame, fan: int, height: int, name: str) -> DataFrame:
    """``_g, _block, _members, _rise, _levels, _left``: the nodes by aligned block, and each block's level strings.

    ``nodes`` has ``_g, _pos, _node, _left`` (levels to go up to the group's subroot) and ``_row``.
    """
    size = fan**height
    own = nodes.select("_g", "_left", F.expr(f"_pos div {size}").alias("_block"), F.struct((F.col("_pos") % size).alias("slot"), "_node", "_row").alias("_m"))
    own = own.groupBy("_g", "_block").agg(F.array_sort(F.collect_list("_m")).alias("_members"), F.first("_left").alias("_left"))
    own = own.withColumn("_rise", F.least(F.col("_left"), F.lit(height)))
    ground = F.array(F.array_join(F.transform("_members", lambda m: m["_node"]), "").cast("binary"))
    up = F.aggregate(_until(F.col("_rise")), ground, lambda have, _: F.concat(have, F.array(_parents(F.element_at(have, -1), fan))))
    return stage(own.withColumn("_levels", up), name)


def _segment(levels: Column, rise: Column, slot: Column, fan: int) -> Column:
    """For each level of a block, the siblings to the left and to the right of the node above ``slot``."""

    def flanks(k: Column) -> Column:
        at = F.floor(slot / _power(fan, k))
        run = F.floor(at / fan) * fan
        level = F.element_at(levels, k + 1)
        cut = lambda a, b: F.substring(level, (a * _HEX + 1).cast("int"), ((b - a) * _HEX).cast("int")).cast("string")
        return F.struct(cut(run, at).alias("left"), cut(at + 1, run + fan).alias("right"))

    return F.transform(_until(rise), flanks)


def _tree(nodes: DataFrame, fan: int, height: int, name: str) -> list[DataFrame]:
    """The rounds of blocks, from the leaves up to one block of each group. ``nodes`` has ``_g, _pos, _size, _node, _row``."""
    most = nodes.agg(F.max(_levels(F.col("_size"), fan))).first()[0] or 0
    nodes = nodes.withColumn("_left", _levels(F.col("_size"), fan))
    rounds = []
    while True:
        rounds.append(_blocks(nodes, fan, height, f"{name}-{len(rounds)}"))
        most -= height
        if most <= 0:
            return rounds
        last = F.element_at("_levels", -1).cast("string")
        nodes = rounds[-1].select("_g", F.col("_block").alias("_pos"), last.alias("_node"), F.lit(None).cast("int").alias("_row"),
                                  (F.col("_left") - F.col("_rise")).alias("_left"))


def _paths(rounds: list[DataFrame], top: DataFrame, fan: int, height: int) -> DataFrame:
    """``top``'s columns, ``_m`` (slot, node, row) and ``_path`` of every leaf. ``top`` has ``_g, _path`` and more."""
    carried = [c for c in top.columns if c not in ("_g", "_path")]
    above = top.withColumn("_block", F.lit(0).cast("long"))
    for k in range(len(rounds) - 1, -1, -1):
        met = rounds[k].join(above, ["_g", "_block"])
        each = F.transform("_members", lambda m: F.struct(m.alias("m"), F.concat(_segment(F.col("_levels"), F.col("_rise"), m["slot"], fan), F.col("_path")).alias("path")))
        rows = met.select("_g", "_block", *carried, F.explode(each).alias("_x"))
        path = F.col("_x.path").alias("_path")
        if k == 0:
            return rows.select("_g", *carried, F.col("_x.m").alias("_m"), path)
        above = rows.select("_g", *carried, (F.col("_block") * fan**height + F.col("_x.m.slot")).alias("_block"), path)


def manifest(docs: DataFrame, fields: tuple[str, ...] = FIELDS, group_col: str = "lang", id_col: str = "doc_id", claimed: dict[str, Column] | None = None,
             fan: int = FAN, height: int = HEIGHT) -> DataFrame:
    """``id, leaf, claimed_leaf, subroot, root, path`` of every row.

    ``path`` lists, level by level, the siblings to the left and right. ``claimed`` gives other values of some
    fields; ``claimed_leaf`` is the leaf of the row with them.
    """
    values = {c: F.col(c) for c in fields}
    leaf = digest(*[field(v) for v in values.values()])
    other = digest(*[field(v) for v in (values | (claimed or {})).values()]) if claimed else leaf
    # a null group sorts before all others, as text too
    group = F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit(""))
    leaves = stage(docs.select(group.alias("_g"), F.col(id_col).alias("_id"), leaf.alias("_node"), other.alias("_other")), "leaves")
    row = F.struct("_id", F.when(F.col("_other") != F.col("_node"), F.col("_other")).alias("_other")).alias("_row")
    rounds = _tree(_placed(leaves, ["_id", "_node"], "placed").select("_g", "_pos", "_size", "_node", row), fan, height, "blocks")
    subroots = rounds[-1].select(F.lit("").alias("_g"), F.col("_g").alias("_group"), F.element_at("_levels", -1).cast("string").alias("_node"))
    groups = _tree(_placed(subroots, ["_group"], "groups").select("_g", "_pos", "_size", "_node", F.col("_group").alias("_row")), fan, height, "subroots")
    root = groups[-1].select("_g", F.element_at("_levels", -1).cast("string").alias("root"),
                             F.array().cast("array<struct<left:string,right:string>>").alias("_path"))
    top = stage(_paths(groups, root, fan, height).select(F.col("_m._row").alias("_g"), F.col("_m._node").alias("subroot"), "root", "_path"), "top")
    out = _paths(rounds, top, fan, height)
    return out.select(F.col("_m._row._id").alias("id"), F.col("_m._node").alias("leaf"), F.coalesce("_m._row._other", "_m._node").alias("claimed_leaf"),
                      "subroot", "root", F.col("_path").alias("path"))


def proof(path: Column) -> Column:
    """H of the siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), "").cast("binary"), 256)


def fold(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its path lead to."""
    return F.aggregate(path, leaf, lambda node, p: digest(p["left"], node, p["right"]))


def query(spark, sf_dir: str) -> DataFrame:
    """Proof of every document, checked with the leaf of the document as tampered with."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    found = manifest(docs, claimed={"n_chars": F.col("n_chars") + F.when(hit, 1).otherwise(0)})
    folded = fold(F.col("claimed_leaf"), F.col("path"))
    out = found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


_LEAF = " || ".join(f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in FIELDS)
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, x: list_reduce(list_prepend(xor(crc, x), range(8)), lambda r, k: xor(r >> 1, 3988292384 * (r & 1)))), 4294967295)"""
ORACLE_SQL = f"""
WITH RECURSIVE h AS (SELECT *, coalesce({_CRC} % 7 = 0, false) AS hit FROM documents),
l AS (SELECT doc_id, lang, sha256({_LEAF}) AS leaf, sha256({_LEAF.replace('n_chars', '(n_chars + hit::INT)')}) AS other FROM h),
d AS (SELECT row_number() OVER () AS id, *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY lang) AS n FROM l),
up AS (SELECT lang, 0 AS level, pos, leaf AS node, n FROM d
  UNION ALL SELECT lang, level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM up WHERE n > 1 GROUP BY lang, level, pos // 2, n),
s AS (SELECT lang, node, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM up WHERE n = 1),
top AS (SELECT 0 AS level, pos, node, n FROM s
  UNION ALL SELECT level + 1, pos // 2, sha256(string_agg(node, '' ORDER BY pos)), (n + 1) // 2 FROM top WHERE n > 1 GROUP BY level, pos // 2, n),
f AS (SELECT id, lang, 0 AS level, pos, n, other AS node, '' AS proof FROM d
  UNION ALL SELECT f.id, f.lang, f.level + 1, f.pos // 2, (f.n + 1) // 2,
    sha256(CASE WHEN f.pos % 2 = 0 THEN f.node || coalesce(u.node, '') ELSE u.node || f.node END), f.proof || coalesce(u.node, '')
  FROM f LEFT JOIN up AS u ON u.lang IS NOT DISTINCT FROM f.lang AND u.level = f.level AND u.pos = xor(f.pos, 1) WHERE f.n > 1),
g AS (SELECT f.id, 0 AS level, s.pos, s.n, f.node, f.proof FROM f JOIN s ON s.lang IS NOT DISTINCT FROM f.lang WHERE f.n = 1
  UNION ALL SELECT g.id, g.level + 1, g.pos // 2, (g.n + 1) // 2,
    sha256(CASE WHEN g.pos % 2 = 0 THEN g.node || coalesce(u.node, '') ELSE u.node || g.node END), g.proof || coalesce(u.node, '')
  FROM g LEFT JOIN top AS u ON u.level = g.level AND u.pos = xor(g.pos, 1) WHERE g.n > 1)
SELECT d.doc_id, d.leaf, s.node AS subroot, t.node AS root, sha256(g.proof) AS proof_sha256, g.node AS folded_root, g.node = t.node AS verified
FROM d JOIN s ON s.lang IS NOT DISTINCT FROM d.lang JOIN g ON g.id = d.id AND g.n = 1 CROSS JOIN (SELECT node FROM top WHERE n = 1) AS t
"""
