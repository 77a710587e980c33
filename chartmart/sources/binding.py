"""Binding of the driver's TPC-H-like tables to the warehouse's input shapes.

The driver's tables are a star of orders/lineitem, not chart files, so every query first
derives chart-shaped all-string rows from them (FIXTURES.md §3). The derivation is a
plain DataFrame plan over the *whole* tables: lineitem joined to part, supplier, nation
and region; nation and region are fixed 25- and 5-row tables and are broadcast on that
bound, the join strategy for part and supplier is left to Catalyst/AQE (size-based).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmart.schemas import CHART_COLUMNS, RELEASE_COLUMNS
from chartmart.session import table_path

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
          "embeddings", "pages", "benchmark", "labels", "conversations")

# Fixed sizes of the two fixed TPC-H code tables (they do not grow with the scale factor).
FIXED_SIZE_TABLES = {"region": 5, "nation": 25}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def _s(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("string")


def _dmy(d: Column) -> Column:
    """dd-MM-yyyy text of a date, built field by field (same text on every engine)."""
    return F.concat(
        F.lpad(F.dayofmonth(d).cast("string"), 2, "0"), F.lit("-"),
        F.lpad(F.month(d).cast("string"), 2, "0"), F.lit("-"),
        F.year(d).cast("string"),
    )


def chart_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """35 all-string columns, one row per lineitem plus exact copies for 1 in 20 tracks.

    Built-in traps: 15-char prefixes, NULL uri, rank 0, genre '0' and NULL, bad and
    decimal streams, bad weeks, exact duplicates, two genres per artist.
    """
    # the day alone is shuffled, not the time
    li = (read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", F.col("l_shipdate").cast("date").alias("ship_d")))
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size", "p_retailprice")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # part and supplier grow with the data: Catalyst/AQE pick broadcast or shuffle from their
    # sizes. nation and region are fixed-size code tables, joined last as broadcasts.
    j = (li.join(p, li.l_partkey == p.p_partkey)
         .join(s, F.col("l_suppkey") == F.col("s_suppkey"))
         .join(F.broadcast(n), F.col("s_nationkey") == F.col("n_nationkey"))
         .join(F.broadcast(r), F.col("n_regionkey") == F.col("r_regionkey"))
         .withColumn("rel_d", F.date_add(F.lit("1995-01-01").cast("date"), (F.col("p_partkey") % 2500).cast("int"))))
    # emitted in the same pass (no second evaluation of the joins): exact copies for 1 in 20 tracks, and for another
    # 1 in 20 restated rows that differ in a column the fact leaves out, so that the fact repeats but not the chart
    copies = F.when((F.col("p_partkey") % 20 == 0) & (F.col("l_orderkey") % 10 == 0), F.array(F.lit(0), F.lit(1))).when(
        (F.col("p_partkey") % 20 == 10) & (F.col("l_orderkey") % 10 == 5), F.array(F.lit(0), F.lit(2)))
    k = j.withColumn("_copy", F.explode(F.coalesce(copies, F.array(F.lit(0)))))

    ok, pk, sk, size = F.col("l_orderkey"), F.col("p_partkey"), F.col("s_suppkey"), F.col("p_size")
    qty = _s(F.col("l_quantity").cast("int"))
    cols = {
        "uri": F.when(ok % 101 == 0, F.lit(None).cast("string")).when(
            ok % 103 == 0, F.concat(F.lit("catalog:track:"), _s(pk))).otherwise(F.concat(F.lit("catalog:tracks:"), _s(pk))),
        "rank": _s(F.col("l_linenumber") % 7),
        "artist_names": F.concat(F.col("s_name"), F.lit(", "), F.col("p_brand")),
        "artists_num": F.lit("2"),
        "artist_individual": F.col("s_name"),
        "artist_id": F.concat(F.lit("catalog:artist:"), _s(sk)),
        "artist_genre": (F.when(sk % 10 == 0, F.lit("0")).when(sk % 10 == 1, F.lit(None).cast("string"))
                         .when(size > 40, F.lit("alt")).otherwise(F.lit("main"))),
        "artist_img": F.concat(F.lit("http://img.example/"), _s(sk)),
        "collab": F.lit("1"),
        "track_name": F.col("p_name"),
        "release_date": _dmy(F.col("rel_d")),
        "album_num_tracks": _s(size),
        "album_cover": F.concat(F.lit("http://cover.example/"), _s(pk)),
        "source": F.col("p_brand"),
        "peak_rank": _s("l_linenumber"),
        "previous_rank": _s(F.col("l_linenumber") + 1),
        "weeks_on_chart": _s(ok % 40),
        "streams": (F.when(ok % 97 == 0, F.lit("n/a")).when(ok % 97 == 1, F.lit(""))
                    .when(ok % 97 == 2, F.concat(qty, F.lit(".7"))).otherwise(qty)),
        "week": F.when(ok % 89 == 0, F.lit("bad-date")).otherwise(_dmy(F.col("ship_d"))),
        "danceability": F.concat(F.lit("0."), F.lpad(_s(size), 2, "0")),
        "energy": F.concat(F.lit("0."), F.lpad(_s(size % 10), 2, "0")),
        "key": _s(size % 12),
        "mode": _s(size % 2),
        "loudness": F.concat(F.lit("-"), _s(size % 30), F.lit(".5")),
        "speechiness": F.lit("0.1"),
        "acousticness": F.lit("0.2"),
        "instrumentalness": F.lit("0"),
        "liveness": F.lit("0.3"),
        "valence": F.lit("0.4"),
        "tempo": _s("p_retailprice"),
        "duration": _s(size * 1000),
        "country": F.col("n_name"),
        "region": F.col("r_name"),
        "language": F.concat(F.lit("lang"), _s("r_regionkey")),
        "pivot": F.when(F.col("_copy") == 2, F.lit("1")).otherwise(F.lit("0")),
    }
    return k.select(*[cols[c].alias(c) for c in CHART_COLUMNS])


def release_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """13 all-string columns, one row per part; release days 01..28-11-2024, '2024' as a bad date."""
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    n_supp = sup.count()  # one scalar: the supplier count that spreads parts over suppliers
    pk = F.col("p_partkey")
    j = part.join(sup, F.col("s_suppkey") == pk % F.lit(n_supp))
    cols = {
        "uri": F.concat(F.lit("catalog:tracks:"), _s(pk)),
        "artist_names": F.concat(F.col("s_name"), F.lit(", "), F.col("p_brand")),
        "artists_num": F.when(pk % 5 == 0, F.lit("2")).otherwise(F.lit("1")),
        "artist_individual": F.col("s_name"),
        "artist_id": _s("s_suppkey"),
        "artist_genre": F.when(pk % 4 == 0, F.lit("new wave")).otherwise(F.lit("main")),
        "artist_img": F.concat(F.lit("http://img.example/new/"), _s("s_suppkey")),
        "collab": F.when(pk % 5 == 0, F.lit("1")).otherwise(F.lit("0")),
        "track_name": F.col("p_name"),
        "release_date": F.when(pk % 50 == 7, F.lit("2024")).otherwise(
            F.concat(F.lpad(_s(1 + pk % 28), 2, "0"), F.lit("-11-2024"))),
        "album_num_tracks": _s("p_size"),
        "album_cover": F.concat(F.lit("http://cover.example/new/"), _s(pk)),
        "region": F.lit("Global"),
    }
    # exact copies for 1 in 40 parts
    twice = j.withColumn("_copy", F.explode(F.when(pk % 40 == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))))
    return twice.select(*[cols[c].alias(c) for c in RELEASE_COLUMNS])


# --- the same two derivations as portable SQL, used as leading CTEs of the DuckDB oracle ---

CHART_RAW_SQL = """
WITH j AS (
  SELECT l.*, p.*, s.*, n.*, r.*,
         DATE '1995-01-01' + CAST(p_partkey % 2500 AS INT) AS rel_d,
         CAST(l_shipdate AS DATE) AS ship_d
  FROM lineitem l
  JOIN part p ON l_partkey = p_partkey
  JOIN supplier s ON l_suppkey = s_suppkey
  JOIN nation n ON s_nationkey = n_nationkey
  JOIN region r ON n_regionkey = r_regionkey
), k AS (
  SELECT j.*, '0' AS pv FROM j
  UNION ALL
  SELECT j.*, '0' AS pv FROM j WHERE p_partkey % 20 = 0 AND l_orderkey % 10 = 0
  UNION ALL
  SELECT j.*, '1' AS pv FROM j WHERE p_partkey % 20 = 10 AND l_orderkey % 10 = 5
)
SELECT
  CASE WHEN l_orderkey % 101 = 0 THEN NULL WHEN l_orderkey % 103 = 0 THEN 'catalog:track:' || CAST(p_partkey AS STRING)
       ELSE 'catalog:tracks:' || CAST(p_partkey AS STRING) END AS uri,
  CAST(l_linenumber % 7 AS STRING) AS "rank",
  s_name || ', ' || p_brand AS artist_names,
  '2' AS artists_num,
  s_name AS artist_individual,
  'catalog:artist:' || CAST(s_suppkey AS STRING) AS artist_id,
  CASE WHEN s_suppkey % 10 = 0 THEN '0' WHEN s_suppkey % 10 = 1 THEN NULL
       WHEN p_size > 40 THEN 'alt' ELSE 'main' END AS artist_genre,
  'http://img.example/' || CAST(s_suppkey AS STRING) AS artist_img,
  '1' AS collab,
  p_name AS track_name,
  lpad(CAST(day(rel_d) AS STRING),2,'0') || '-' || lpad(CAST(month(rel_d) AS STRING),2,'0') || '-' || CAST(year(rel_d) AS STRING) AS release_date,
  CAST(p_size AS STRING) AS album_num_tracks,
  'http://cover.example/' || CAST(p_partkey AS STRING) AS album_cover,
  p_brand AS source,
  CAST(l_linenumber AS STRING) AS peak_rank,
  CAST(l_linenumber + 1 AS STRING) AS previous_rank,
  CAST(l_orderkey % 40 AS STRING) AS weeks_on_chart,
  CASE WHEN l_orderkey % 97 = 0 THEN 'n/a' WHEN l_orderkey % 97 = 1 THEN ''
       WHEN l_orderkey % 97 = 2 THEN CAST(CAST(l_quantity AS INT) AS STRING) || '.7'
       ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS streams,
  CASE WHEN l_orderkey % 89 = 0 THEN 'bad-date' ELSE
  lpad(CAST(day(ship_d) AS STRING),2,'0') || '-' || lpad(CAST(month(ship_d) AS STRING),2,'0') || '-' || CAST(year(ship_d) AS STRING) END AS "week",
  '0.' || lpad(CAST(p_size AS STRING),2,'0') AS danceability,
  '0.' || lpad(CAST(p_size % 10 AS STRING),2,'0') AS energy,
  CAST(p_size % 12 AS STRING) AS "key",
  CAST(p_size % 2 AS STRING) AS "mode",
  '-' || CAST(p_size % 30 AS STRING) || '.5' AS loudness,
  '0.1' AS speechiness, '0.2' AS acousticness, '0' AS instrumentalness, '0.3' AS liveness, '0.4' AS valence,
  CAST(p_retailprice AS STRING) AS tempo,
  CAST(p_size * 1000 AS STRING) AS duration,
  n_name AS country, r_name AS region, 'lang' || CAST(r_regionkey AS STRING) AS "language", pv AS pivot
FROM k
"""

RELEASE_RAW_SQL = """
SELECT
  'catalog:tracks:' || CAST(p_partkey AS STRING) AS uri,
  s_name || ', ' || p_brand AS artist_names,
  CASE WHEN p_partkey % 5 = 0 THEN '2' ELSE '1' END AS artists_num,
  s_name AS artist_individual,
  CAST(s_suppkey AS STRING) AS artist_id,
  CASE WHEN p_partkey % 4 = 0 THEN 'new wave' ELSE 'main' END AS artist_genre,
  'http://img.example/new/' || CAST(s_suppkey AS STRING) AS artist_img,
  CASE WHEN p_partkey % 5 = 0 THEN '1' ELSE '0' END AS collab,
  p_name AS track_name,
  CASE WHEN p_partkey % 50 = 7 THEN '2024' ELSE
  lpad(CAST(1 + p_partkey % 28 AS STRING),2,'0') || '-11-2024' END AS release_date,
  CAST(p_size AS STRING) AS album_num_tracks,
  'http://cover.example/new/' || CAST(p_partkey AS STRING) AS album_cover,
  'Global' AS region
FROM part
CROSS JOIN (SELECT count(*) AS n_supp FROM supplier) c
JOIN supplier ON s_suppkey = p_partkey % n_supp
CROSS JOIN (SELECT unnest([0, 1]) AS again) x
WHERE again = 0 OR p_partkey % 40 = 3
"""


# --- nested search pages and artist records for the weekly load (FIXTURES.md §3, "Others") ---

PAGE_SIZE = 50  # items per landed search page


def _supplier_count(spark: SparkSession, sf_dir: str) -> int:
    return read_table(spark, sf_dir, "supplier").count()


def page_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per (page_id, item struct). Every part is one track item; 1 in 20 tracks is
    returned again on a second page (a track found by two searches)."""
    n_supp = _supplier_count(spark, sf_dir)
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_size")
    sup = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    pk = F.col("p_partkey")
    s1 = sup.select(F.col("s_suppkey").alias("a1_key"), F.col("s_name").alias("a1_name"))
    s2 = sup.select(F.col("s_suppkey").alias("a2_key"), F.col("s_name").alias("a2_name"))
    j = (part.withColumn("a1", pk % n_supp)
         .withColumn("a2", F.when(pk % 5 == 0, (pk + 1) % n_supp))
         .join(s1, F.col("a1") == F.col("a1_key"))
         .join(s2, F.col("a2") == F.col("a2_key"), "left"))
    artist = lambda name, key: F.struct(F.col(name).alias("name"), F.concat(F.lit("a"), _s(key)).alias("id"))
    artists = F.when(F.col("a2_key").isNull(), F.array(artist("a1_name", "a1_key"))).otherwise(
        F.array(artist("a1_name", "a1_key"), artist("a2_name", "a2_key")))
    release = (F.when(pk % 50 == 7, F.lit("2024")).when(pk % 50 == 8, F.lit("2024-11"))
               .otherwise(F.concat(F.lit("2024-11-"), F.lpad(_s(1 + pk % 28), 2, "0"))))
    images = F.when(pk % 9 == 0, F.array().cast("array<struct<url:string>>")).otherwise(
        F.array(F.struct(F.concat(F.lit("http://cover.example/"), _s(pk)).alias("url"))))
    item = F.struct(
        F.concat(F.lit("catalog:tracks:"), _s(pk)).alias("uri"),
        F.col("p_name").alias("name"),
        F.struct(release.alias("release_date"), F.col("p_size").cast("bigint").alias("total_tracks"),
                 F.col("p_brand").alias("label"), images.alias("images")).alias("album"),
        artists.alias("artists"))
    once = j.select(F.floor(pk / PAGE_SIZE).cast("bigint").alias("page_id"), item.alias("item"))
    again = j.filter(pk % 20 == 0).select((-1 - F.floor(pk / PAGE_SIZE)).cast("bigint").alias("page_id"),
                                          item.alias("item"))
    return once.unionByName(again)


def pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search pages of at most PAGE_SIZE items: {tracks: {items: [...]}} (a bounded group per page)."""
    items = page_items(spark, sf_dir)
    return (items.groupBy("page_id").agg(F.collect_list("item").alias("items"))
            .select(F.struct(F.col("items")).alias("tracks")))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search pages as JSON texts with their number; by its remainder of 7, a page is cut short (3), has no
    list of items (6), names a market (5), or counts an album's tracks in words (1)."""
    items = page_items(spark, sf_dir).groupBy("page_id").agg(F.collect_list("item").alias("items"))
    page = items.select(F.pmod("page_id", F.lit(7)).alias("kind"), F.to_json(F.struct(
        F.col("page_id").alias("page"), F.struct("items").alias("tracks"))).alias("text"))
    kind, text = F.col("kind"), F.col("text")
    return page.select(
        F.when(kind == 3, F.expr("substring(text, 1, length(text) - 5)"))
        .when(kind == 6, F.regexp_replace(text, r'"items":\[.*$', '"items":"gone"}}'))
        .when(kind == 5, F.regexp_replace(text, r"\}$", ',"market":"US"}'))
        .when(kind == 1, F.regexp_replace(text, r'"total_tracks":\d+', '"total_tracks":"many"'))
        .otherwise(text).alias("value"))


def artist_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artist detail records {id, genres[], images[]} derived from suppliers."""
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey")
    sk = F.col("s_suppkey")
    genres = (F.when(sk % 5 == 0, F.array(F.lit("US pop"), F.lit("dance")))
              .when(sk % 5 == 1, F.array(F.lit("K-pop")))
              .when(sk % 5 == 2, F.array().cast("array<string>"))
              .when(sk % 5 == 3, F.array(F.lit("us pop"), F.lit("indie")))
              .otherwise(F.array(F.lit("US K-pop"))))
    images = F.when(sk % 6 == 0, F.array().cast("array<struct<url:string>>")).otherwise(
        F.array(F.struct(F.concat(F.lit("http://img.example/a/"), _s(sk)).alias("url"))))
    once = s.select("s_suppkey", F.concat(F.lit("a"), _s(sk)).alias("id"), genres.alias("genres"), images.alias("images"))
    # one artist in seven is landed twice
    return once.unionByName(once.filter(sk % 7 == 0)).drop("s_suppkey")


def customer_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Two loads of a customer source for the history snapshot: the first (customers up to
    90% of the highest key, updated 2024-01-01), the second (every customer except 1 in 11,
    balance raised by one and updated 2024-02-01 for 1 in 7)."""
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                                     "c_mktsegment")
    max_key = c.agg(F.max("c_custkey")).first()[0]
    first = (c.filter(F.col("c_custkey") < F.lit(0.9 * max_key))
             .withColumn("updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz")))
    changed = F.col("c_custkey") % 7 == 0
    second = (c.filter(F.col("c_custkey") % 11 != 0)
              .withColumn("c_acctbal", F.when(changed, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
              .withColumn("updated_at", F.when(changed, F.lit("2024-02-01 00:00:00"))
                          .otherwise(F.lit("2024-01-01 00:00:00")).cast("timestamp_ntz")))
    return first, second
