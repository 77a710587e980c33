"""Equivalent ANSI SQL (DuckDB dialect) of every registered query, for the correctness gate.

Each stage is a named CTE; a query lists the final SELECT and the CTEs it needs, and
``with_ctes`` prepends them in dependency order. Surrogate keys are
``ROW_NUMBER() OVER (ORDER BY <natural columns> NULLS FIRST)``, which the Spark key step
reproduces without a global sort.
"""

from __future__ import annotations

from chartmart.operators.clean import CHART_COMPARE, CHART_SPEC, RELEASE_COMPARE, RELEASE_SPEC, WEEKLY_SPEC, CleanSpec
from chartmart.operators.dims import ARTIST_NATURAL, AUDIO_MEASURES, COUNTRY_NATURAL, DAY_NAMES, TRACK_NATURAL
from chartmart.plans.flows import HIST_AS_OF, MERGE_AS_OF, RELEASE_LOAD_TS, RUN_DATE, WEEKLY_AS_OF
from chartmart.schemas import CHART_COLUMNS, FACT_COLUMNS, RELEASE_COLUMNS
from chartmart.sources.binding import CHART_RAW_SQL, RELEASE_RAW_SQL


def q(c: str) -> str:
    return f'"{c}"'


def cols(names) -> str:
    return ", ".join(q(c) for c in names)


def order_nulls_first(names) -> str:
    return ", ".join(f"{q(c)} ASC NULLS FIRST" for c in names)


def sql_int(c: str) -> str:
    return f"TRY_CAST(ROUND(TRY_CAST({c} AS DECIMAL(38,10))) AS BIGINT)"


def sql_date(c: str, iso: bool = False) -> str:
    if iso:
        return (f"CASE WHEN regexp_full_match({c}, '\\d{{4}}-\\d{{2}}-\\d{{2}}') "
                f"THEN CAST(try_strptime({c}, '%Y-%m-%d') AS DATE) END")
    return (f"CASE WHEN regexp_full_match({c}, '\\d{{2}}-\\d{{2}}-\\d{{4}}') "
            f"THEN CAST(try_strptime({c}, '%d-%m-%Y') AS DATE) END")


def clean_select(spec: CleanSpec, source: str, extra: str = "") -> str:
    parts = []
    for name, rule in spec.rules:
        c = f"CAST({q(name)} AS VARCHAR)"
        if rule == "str":
            e = c
        elif rule == "strip":
            e = f"substring({q(name)}, {spec.prefix_len + 1})"
        elif rule == "int":
            e = sql_int(c)
        elif rule == "float":
            e = f"TRY_CAST({c} AS DOUBLE)"
        elif rule == "date":
            e = sql_date(c)
        elif rule == "iso_date":
            e = sql_date(c, iso=True)
        else:
            raise ValueError(rule)
        parts.append(f"{e} AS {q(name)}")
    if extra:
        parts.append(extra)
    return f"SELECT {', '.join(parts)} FROM {source}"


def purge_sql(source: str, keys, compare) -> str:
    on = " AND ".join(f"d.{q(k)} = s.{q(k)}" for k in keys)
    return (f"SELECT s.* FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM ("
            f"SELECT DISTINCT {cols(keys)} FROM {source} GROUP BY {cols(compare)} HAVING count(*) > 1) d "
            f"WHERE {on})")


def avg6(expr: str) -> str:
    """Exact AVG rounded half-up to 6 decimals: integer arithmetic on the exactly summed
    DECIMAL(38,12) values (DuckDB would otherwise divide in DOUBLE)."""
    total = f"CAST(SUM(CAST({expr} AS DECIMAL(38,12))) * 1000000000000 AS HUGEINT)"
    n = f"CAST(COUNT({expr}) AS HUGEINT)"
    return (f"CASE WHEN COUNT({expr}) = 0 THEN NULL ELSE CAST(sign({total}) * ((2 * abs({total}) + {n} * 1000000) "
            f"// (2 * {n} * 1000000)) AS DOUBLE) / 1000000.0 END")


def round6(expr: str) -> str:
    """A double rounded half-up to 6 decimals by way of DECIMAL(38,12)."""
    return f"CAST(round(CAST({expr} AS DECIMAL(38,12)), 6) AS DOUBLE)"


def ts(v: str | None) -> str:
    return "CAST(NULL AS TIMESTAMP)" if v is None else f"TIMESTAMP '{v}'"


def keyed(source: str, natural, key: str, start: str = "0") -> str:
    return (f"SELECT CAST({start} + ROW_NUMBER() OVER (ORDER BY {order_nulls_first(natural)}) AS BIGINT) AS {q(key)}, "
            f"{cols(natural)} FROM {source}")


def _dim_date() -> str:
    name = " ".join(f"WHEN {i} THEN '{d}'" for i, d in enumerate(DAY_NAMES, start=1))
    dow = "(dayofweek(d) + 1)"
    return f"""SELECT CAST(i + 1 AS BIGINT) AS date_key, strftime(d, '%Y-%m-%d') AS full_date,
  CAST(year(d) AS INTEGER) AS "year", CAST(quarter(d) AS INTEGER) AS "quarter", CAST(month(d) AS INTEGER) AS "month",
  strftime(d, '%B') AS month_name, CAST(week(d) AS INTEGER) AS "week", CAST(dayofyear(d) AS INTEGER) AS day_of_year,
  CAST(day(d) AS INTEGER) AS day_of_month, CAST({dow} AS INTEGER) AS day_of_week,
  CASE {dow} {name} END AS day_name, {dow} IN (1, 7) AS is_weekend
FROM (SELECT i, CAST(DATE '1990-01-01' + CAST(i AS INTEGER) AS DATE) AS d FROM range(13149) t(i))"""


def _fact_raw(lookup: str = "all") -> str:
    def dim(name, nat, key, cast=None):
        n = f"CAST({q(nat)} AS DATE)" if cast else q(nat)
        if lookup == "first":
            return f"(SELECT {n} AS nat, min({q(key)}) AS {q(key)} FROM {name} GROUP BY 1)"
        return f"(SELECT {n} AS nat, {q(key)} FROM {name})"
    return f"""SELECT dt.track_key, da.artist_key, dc.country_key, dd.date_key, md."rank", md.peak_rank,
  md.previous_rank, md.weeks_on_chart, md.streams,
  CAST(md.streams AS DOUBLE) / CAST(NULLIF(md."rank", 0) AS DOUBLE) AS popularity_score
FROM chart_purged md
LEFT JOIN {dim('dim_track', 'uri', 'track_key')} dt ON md.uri = dt.nat
LEFT JOIN {dim('dim_artist', 'artist_id', 'artist_key')} da ON md.artist_id = da.nat
LEFT JOIN {dim('dim_country', 'country', 'country_key')} dc ON md.country = dc.nat
LEFT JOIN {dim('dim_date', 'full_date', 'date_key', cast=True)} dd ON md."week" = dd.nat"""


def _artist_rows(source: str) -> str:
    return (f"SELECT artist_id, artist_individual AS artist_name, artist_genre, artist_img FROM {source} "
            f"WHERE artist_id IS NOT NULL AND artist_genre <> '0'")


def _dim_artist_from(rows: str) -> str:
    return (f"SELECT artist_key, {cols(ARTIST_NATURAL)}, {ts(HIST_AS_OF)} AS effective_start_date, "
            f"{ts(None)} AS effective_end_date, TRUE AS is_current FROM ({keyed(f'({rows})', ARTIST_NATURAL, 'artist_key')})")


def _dim_track_from(rows: str) -> str:
    return (f"SELECT track_key, {cols(TRACK_NATURAL)}, {ts(HIST_AS_OF)} AS effective_start_date "
            f"FROM ({keyed(f'(SELECT * FROM ({rows}) WHERE release_date IS NOT NULL)', TRACK_NATURAL, 'track_key')})")


def _latest(source: str, key: str, order) -> str:
    o = ", ".join(f"{q(c)} DESC NULLS LAST" for c in order)
    return (f"SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {q(key)} ORDER BY {o}) AS rn "
            f"FROM {source} WHERE release_date = DATE '{RUN_DATE}') WHERE rn = 1")


def _merge_artist(target: str, on_stale: str = "skip") -> str:
    src = _latest("release_purged", "artist_id",
                  ["release_date", "load_timestamp", "uri", "artist_individual", "artist_genre", "artist_img"])
    consumed = "m" if on_stale == "insert" else "hit"
    return f"""(WITH src AS ({src}),
j AS (SELECT t.*, s.artist_id AS s_id, s.artist_genre AS s_genre, s.artist_individual AS s_name,
        s.artist_img AS s_img, s.load_timestamp AS s_ts
      FROM {target} t LEFT JOIN src s ON t.artist_id = s.artist_id AND t.artist_genre = s.artist_genre),
f AS (SELECT *, (s_id IS NOT NULL AND s_genre IS NOT NULL) AS hit,
        (s_id IS NOT NULL AND s_genre IS NOT NULL AND COALESCE(effective_start_date < s_ts, FALSE)) AS m FROM j),
used AS (SELECT DISTINCT s_id, s_genre FROM f WHERE {consumed}),
ins AS (SELECT artist_id, artist_individual AS artist_name, artist_genre, artist_img FROM src s
        WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.s_id = s.artist_id AND u.s_genre = s.artist_genre))
SELECT artist_key, artist_id, CASE WHEN m THEN s_name ELSE artist_name END AS artist_name, artist_genre,
       CASE WHEN m THEN s_img ELSE artist_img END AS artist_img,
       CASE WHEN m THEN {ts(MERGE_AS_OF)} ELSE effective_start_date END AS effective_start_date,
       effective_end_date, is_current FROM f
UNION ALL
SELECT artist_key, {cols(ARTIST_NATURAL)}, {ts(None)} AS effective_start_date, {ts(None)} AS effective_end_date,
       TRUE AS is_current
FROM ({keyed('ins', ARTIST_NATURAL, 'artist_key', f'(SELECT max(artist_key) FROM {target})')}))"""


def _merge_track(target: str, on_stale: str = "skip") -> str:
    src = _latest("release_purged", "uri",
                  ["release_date", "load_timestamp", "track_name", "album_cover", "album_num_tracks", "artist_id"])
    consumed = "m" if on_stale == "insert" else "hit"
    return f"""(WITH src AS ({src}),
j AS (SELECT t.*, s.uri AS s_uri, s.track_name AS s_track, s.album_cover AS s_cover,
        s.album_num_tracks AS s_n, s.load_timestamp AS s_ts
      FROM {target} t LEFT JOIN src s ON t.uri = s.uri AND t.track_name = s.track_name),
f AS (SELECT *, (s_uri IS NOT NULL AND s_track IS NOT NULL) AS hit,
        (s_uri IS NOT NULL AND s_track IS NOT NULL AND COALESCE(effective_start_date < s_ts, FALSE)) AS m FROM j),
used AS (SELECT DISTINCT s_uri, s_track FROM f WHERE {consumed}),
ins AS (SELECT {cols(TRACK_NATURAL)} FROM src s
        WHERE NOT EXISTS (SELECT 1 FROM used u WHERE u.s_uri = s.uri AND u.s_track = s.track_name))
SELECT track_key, uri, track_name, release_date,
       CASE WHEN m THEN s_cover ELSE album_cover END AS album_cover,
       CASE WHEN m THEN s_n ELSE album_num_tracks END AS album_num_tracks,
       CASE WHEN m THEN {ts(MERGE_AS_OF)} ELSE effective_start_date END AS effective_start_date FROM f
UNION ALL
SELECT track_key, {cols(TRACK_NATURAL)}, {ts(MERGE_AS_OF)} AS effective_start_date
FROM ({keyed('ins', TRACK_NATURAL, 'track_key', f'(SELECT max(track_key) FROM {target})')}))"""


WEEKLY_ITEMS_SQL = f"""
WITH n AS (SELECT count(*) AS n_supp FROM supplier),
p AS (SELECT p_partkey, p_name, p_brand, p_size, p_partkey % n_supp AS a1,
             CASE WHEN p_partkey % 5 = 0 THEN (p_partkey + 1) % n_supp END AS a2 FROM part, n),
j AS (SELECT p.*, s1.s_name AS a1_name, s2.s_name AS a2_name, s2.s_suppkey AS a2_key
      FROM p JOIN supplier s1 ON s1.s_suppkey = p.a1 LEFT JOIN supplier s2 ON s2.s_suppkey = p.a2),
one AS (
  SELECT 'catalog:tracks:' || CAST(p_partkey AS VARCHAR) AS uri, p_name AS track_name,
    CASE WHEN p_partkey % 50 = 7 THEN '2024' WHEN p_partkey % 50 = 8 THEN '2024-11'
         ELSE '2024-11-' || lpad(CAST(1 + p_partkey % 28 AS VARCHAR), 2, '0') END AS release_date,
    CAST(p_size AS BIGINT) AS album_num_tracks,
    CASE WHEN p_partkey % 9 = 0 THEN NULL ELSE 'http://cover.example/' || CAST(p_partkey AS VARCHAR) END AS album_cover,
    p_brand AS source,
    CASE WHEN a2_key IS NULL THEN a1_name ELSE a1_name || ', ' || a2_name END AS artist_names,
    CAST(CASE WHEN a2_key IS NULL THEN 1 ELSE 2 END AS BIGINT) AS artists_num,
    a1_name AS artist_individual, 'a' || CAST(a1 AS VARCHAR) AS artist_id,
    CAST(CASE WHEN a2_key IS NULL THEN 0 ELSE 1 END AS BIGINT) AS collab,
    p_partkey
  FROM j)
SELECT * EXCLUDE (p_partkey) FROM one
UNION ALL
SELECT * EXCLUDE (p_partkey) FROM one WHERE p_partkey % 20 = 0
"""

ARTIST_ATTR_SQL = """
SELECT 'a' || CAST(s_suppkey AS VARCHAR) AS _artist_id,
  CASE s_suppkey % 5 WHEN 0 THEN 'US pop, dance' WHEN 1 THEN 'K-pop' WHEN 2 THEN ''
       WHEN 3 THEN 'us pop, indie' ELSE 'US K-pop' END AS artist_genre,
  CASE WHEN s_suppkey % 6 = 0 THEN NULL ELSE 'http://img.example/a/' || CAST(s_suppkey AS VARCHAR) END AS artist_img
FROM supplier
"""

_COUNTRY_SQL = ("CASE WHEN contains(artist_genre, 'US') THEN 'United States' "
                "WHEN contains(artist_genre, 'K-pop') THEN 'South Korea' ELSE 'Global' END")

_WEEK_WINDOW = (f"(length(release_date) = 10 AND {sql_date('release_date', iso=True)} "
                f"BETWEEN DATE '{WEEKLY_AS_OF}' - INTERVAL 7 DAY AND DATE '{WEEKLY_AS_OF}' - INTERVAL 1 DAY)")

CTES: dict[str, tuple[str, list[str]]] = {
    "chart_raw": (CHART_RAW_SQL, []),
    "release_raw": (RELEASE_RAW_SQL, []),
    "chart_clean": (clean_select(CHART_SPEC, "chart_raw"), ["chart_raw"]),
    "chart_purged": (purge_sql("chart_clean", ["uri"], CHART_COMPARE), ["chart_clean"]),
    "release_clean": (clean_select(RELEASE_SPEC, "release_raw", f"{ts(RELEASE_LOAD_TS)} AS load_timestamp"),
                      ["release_raw"]),
    "release_purged": (purge_sql("release_clean", ["uri"], RELEASE_COMPARE), ["release_clean"]),
    "dim_artist": (_dim_artist_from(f"{_artist_rows('chart_purged')} UNION {_artist_rows('release_purged')}"),
                   ["chart_purged", "release_purged"]),
    "dim_artist_hist": (_dim_artist_from(f"SELECT DISTINCT * FROM ({_artist_rows('chart_purged')})"),
                        ["chart_purged"]),
    "dim_track": (_dim_track_from(f"SELECT {cols(TRACK_NATURAL)} FROM chart_purged UNION "
                                  f"SELECT {cols(TRACK_NATURAL)} FROM release_purged"),
                  ["chart_purged", "release_purged"]),
    "dim_track_hist": (_dim_track_from(f"SELECT DISTINCT {cols(TRACK_NATURAL)} FROM chart_purged"),
                       ["chart_purged"]),
    "dim_country": (keyed(f"(SELECT DISTINCT {cols(COUNTRY_NATURAL)} FROM chart_purged)", COUNTRY_NATURAL,
                          "country_key"), ["chart_purged"]),
    "dim_audio_features": (keyed(f"(SELECT DISTINCT uri, {cols(AUDIO_MEASURES)} FROM chart_purged)",
                                 ["uri", *AUDIO_MEASURES], "audio_features_key"), ["chart_purged"]),
    "dim_date": (_dim_date(), []),
    "fact_raw": (_fact_raw("all"), ["chart_purged", "dim_track", "dim_artist", "dim_country", "dim_date"]),
    "fact": (purge_sql("fact_raw", ["track_key", "artist_key", "country_key", "date_key"], FACT_COLUMNS),
             ["fact_raw"]),
    "artist_raw": ("SELECT artist_key, CAST(SUM(streams) AS BIGINT) AS total_streams, avg(\"rank\") AS avg_rank, "
                   "avg(popularity_score) AS avg_popularity FROM fact GROUP BY artist_key", ["fact"]),
    "artist_streams": (f"SELECT artist_key, CAST(SUM(streams) AS BIGINT) AS total_streams, "
                       f"{avg6(q('rank'))} AS avg_rank, {avg6('popularity_score')} AS avg_popularity "
                       f"FROM fact GROUP BY artist_key", ["fact"]),
    "weekly": (f"SELECT date_key, CAST(SUM(streams) AS BIGINT) AS total_streams, {avg6(q('rank'))} AS avg_rank "
               f"FROM fact GROUP BY date_key", ["fact"]),
    "by_name": (f"SELECT da.artist_name, CAST(SUM(a.total_streams) AS BIGINT) AS total_streams, "
                f"{avg6('a.avg_rank')} AS avg_rank, {avg6('a.avg_popularity')} AS avg_popularity "
                f"FROM artist_raw a LEFT JOIN dim_artist da ON a.artist_key = da.artist_key GROUP BY da.artist_name",
                ["artist_raw", "dim_artist"]),
    "weekly_items": (WEEKLY_ITEMS_SQL, []),
    "artist_attr": (ARTIST_ATTR_SQL, []),
    "weekly_enriched": (f"SELECT i.*, a.artist_genre, a.artist_img, {_COUNTRY_SQL} AS country FROM weekly_items i "
                        f"LEFT JOIN artist_attr a ON i.artist_id = a._artist_id", ["weekly_items", "artist_attr"]),
    "weekly_raw": (f"SELECT {cols([c for c in RELEASE_COLUMNS if c != 'region'])}, 'Global' AS region "
                   f"FROM weekly_enriched WHERE {_WEEK_WINDOW}", ["weekly_enriched"]),
    "weekly_clean": (clean_select(WEEKLY_SPEC, "weekly_raw"), ["weekly_raw"]),
}


def with_ctes(final: str, needs: list[str]) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in CTES[n][1]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return final
    body = ",\n".join(f"{n} AS (\n{CTES[n][0]}\n)" for n in order)
    return f"WITH {body}\n{final}"


STALE_TARGET = f"(SELECT * REPLACE ({ts('2030-01-01 00:00:00')} AS effective_start_date) FROM dim_artist_hist)"

CUSTOMER_COLS = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment", "updated_at"]
SNAPSHOT_AS_OF = ["2024-01-02 00:00:00", "2024-02-02 00:00:00", "2024-03-02 00:00:00"]


def _snap_first(cur: str, keys=("c_custkey",)) -> str:
    key = " || '|' || ".join(f"CAST({k} AS VARCHAR)" for k in keys)
    return (f"SELECT {cols(CUSTOMER_COLS)}, md5({key} || '|' || CAST(updated_at AS VARCHAR)) "
            f"AS scd_id, updated_at AS scd_updated_at, updated_at AS valid_from, {ts(None)} AS valid_to FROM {cur}")


def _snap_step(prev: str, cur: str, as_of: str, keys=("c_custkey",)) -> str:
    on = " AND ".join(f"o.{k} = c.{k}" for k in keys)
    o_cols = ", ".join(f"o.{q(c)}" for c in CUSTOMER_COLS)
    return f"""SELECT * FROM {prev} WHERE valid_to IS NOT NULL
UNION ALL
SELECT {o_cols}, o.scd_id, o.scd_updated_at, o.valid_from,
  CASE WHEN c.c_custkey IS NOT NULL AND c.updated_at > o.scd_updated_at THEN c.updated_at
       WHEN c.c_custkey IS NULL THEN {ts(as_of)} END AS valid_to
FROM (SELECT * FROM {prev} WHERE valid_to IS NULL) o LEFT JOIN {cur} c ON {on}
UNION ALL
SELECT * FROM ({_snap_first(f"(SELECT c.* FROM {cur} c LEFT JOIN (SELECT * FROM {prev} WHERE valid_to IS NULL) o "
                            f"ON {on} WHERE o.c_custkey IS NULL OR c.updated_at > o.scd_updated_at)", keys)})"""


_CUST = "(SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer)"
SNAP_V1 = (f"(SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM {_CUST} "
           f"WHERE c_custkey * 10 < 9 * (SELECT max(c_custkey) FROM customer))")
SNAP_V2 = (f"(SELECT c_custkey, c_name, c_nationkey, CASE WHEN c_custkey % 7 = 0 THEN c_acctbal + 1 ELSE c_acctbal END "
           f"AS c_acctbal, c_mktsegment, CASE WHEN c_custkey % 7 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE "
           f"TIMESTAMP '2024-01-01 00:00:00' END AS updated_at FROM {_CUST} WHERE c_custkey % 11 <> 0)")
SNAP_FULL = f"(SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM {_CUST})"
SNAP_GONE = f"(SELECT * FROM {SNAP_FULL} WHERE c_custkey % 11 <> 0)"


def _report_sql() -> str:
    def nn(t, c, name):
        return (f"SELECT '{name}' AS check_name, CAST(count(*) AS BIGINT) AS failures, count(*) <> 0 AS should_warn, "
                f"count(*) <> 0 AS should_error FROM {t} WHERE {q(c)} IS NULL")

    def uq(t, c, name):
        return (f"SELECT '{name}' AS check_name, CAST(count(*) AS BIGINT) AS failures, count(*) <> 0 AS should_warn, "
                f"count(*) <> 0 AS should_error FROM (SELECT {q(c)} FROM {t} WHERE {q(c)} IS NOT NULL "
                f"GROUP BY {q(c)} HAVING count(*) > 1)")

    def ty(name):
        return f"SELECT '{name}' AS check_name, CAST(0 AS BIGINT) AS failures, FALSE AS should_warn, FALSE AS should_error"

    a, w = "streams_popularity_artist", "weekly_trend_analysis"
    parts = [nn("by_name", "artist_name", f"not_null_{a}_artist_name"), uq("by_name", "artist_name", f"unique_{a}_artist_name"),
             nn("by_name", "total_streams", f"not_null_{a}_total_streams"), ty(f"type_number_{a}_total_streams"),
             ty(f"type_number_{a}_avg_rank"), ty(f"type_number_{a}_avg_popularity"),
             nn("weekly", "date_key", f"not_null_{w}_date_key"), uq("weekly", "date_key", f"unique_{w}_date_key"),
             nn("weekly", "total_streams", f"not_null_{w}_total_streams"), ty(f"type_number_{w}_total_streams"),
             ty(f"type_number_{w}_avg_rank")]
    return "\nUNION ALL\n".join(parts)


FACT_DIMS = {"track_key": "dim_track", "artist_key": "dim_artist", "country_key": "dim_country", "date_key": "dim_date"}
DIM_COLUMNS = {"dim_artist": ("artist_key", ARTIST_NATURAL), "dim_track": ("track_key", ["uri", "track_name", "album_cover"]),
               "dim_country": ("country_key", COUNTRY_NATURAL), "dim_date": ("date_key", ["full_date", "day_name"]),
               "dim_audio_features": ("audio_features_key", ["uri"])}


def _tall(dim: str, source: str) -> str:
    """(dim, key, value): the text columns of a dimension in one string, so that all fit one table."""
    key, names = DIM_COLUMNS[dim]
    text = " || '|' || ".join(f"coalesce({q(c)}, '~')" for c in names)
    return f"SELECT '{dim}' AS dim, {key} AS key, {text} AS value FROM {source}"


def oracle_queries() -> dict[str, str]:
    chart_cols = cols(CHART_COLUMNS)
    s: dict[str, str] = {}
    s["land_as_strings"] = with_ctes(
        "SELECT " + ", ".join(f"NULLIF({q(c)}, '') AS {q(c)}" for c in CHART_COLUMNS) + " FROM chart_raw",
        ["chart_raw"])
    s["scan_csv_format"] = ("SELECT CAST(doc_id AS VARCHAR) AS doc_id, NULLIF(text, '') AS text, "
                            "NULLIF(lang, '') AS lang, NULLIF(source, '') AS source, "
                            "CAST(n_chars AS VARCHAR) AS n_chars FROM documents")
    s["clean_chart"] = with_ctes("SELECT * FROM chart_clean", ["chart_clean"])
    s["clean_release"] = with_ctes("SELECT * FROM release_clean", ["release_clean"])
    s["strip_prefix"] = with_ctes(
        "SELECT uri AS raw_uri, substring(uri, 16) AS uri, artist_id AS raw_artist_id, "
        "substring(artist_id, 16) AS artist_id, substring(uri, length(uri) - strpos(reverse(uri), ':') + 2) AS track_id "
        "FROM chart_raw", ["chart_raw"])
    s["try_cast_int"] = with_ctes(
        f"SELECT streams AS raw_streams, {sql_int('streams')} AS streams, \"rank\" AS raw_rank, "
        f"{sql_int(q('rank'))} AS \"rank\" FROM chart_raw", ["chart_raw"])
    s["try_cast_float"] = with_ctes(
        "SELECT danceability AS raw_danceability, TRY_CAST(danceability AS DOUBLE) AS danceability, "
        "tempo AS raw_tempo, TRY_CAST(tempo AS DOUBLE) AS tempo, loudness AS raw_loudness, "
        "TRY_CAST(loudness AS DOUBLE) AS loudness FROM chart_raw", ["chart_raw"])
    s["try_parse_date"] = with_ctes(
        f"SELECT src, raw_value, {sql_date('raw_value')} AS value FROM ("
        f"SELECT 'chart' AS src, \"week\" AS raw_value FROM chart_raw UNION ALL "
        f"SELECT 'release' AS src, release_date AS raw_value FROM release_raw)", ["chart_raw", "release_raw"])
    s["safe_ratio"] = with_ctes(
        "SELECT streams, \"rank\", CAST(streams AS DOUBLE) / CAST(NULLIF(\"rank\", 0) AS DOUBLE) AS popularity_score "
        "FROM chart_clean", ["chart_clean"])
    s["filter_null_semantics"] = with_ctes(
        "SELECT artist_id, artist_genre, count(*) AS n_rows FROM chart_clean "
        "WHERE artist_id IS NOT NULL AND artist_genre <> '0' GROUP BY artist_id, artist_genre", ["chart_clean"])
    s["purge_dups_single_key"] = with_ctes("SELECT * FROM chart_purged", ["chart_purged"])
    s["purge_dups_tuple_key"] = with_ctes("SELECT * FROM fact", ["fact"])
    s["anti_join_null_keys"] = with_ctes("SELECT * FROM chart_purged WHERE uri IS NULL", ["chart_purged"])
    s["flag_duplicates"] = with_ctes(
        f"SELECT uri, CAST(SUM(n - 1) AS BIGINT) AS n_copies FROM (SELECT uri, count(*) AS n FROM chart_clean "
        f"GROUP BY {cols(CHART_COMPARE)} HAVING count(*) > 1) GROUP BY uri", ["chart_clean"])
    s["drop_exact_duplicates"] = (
        "SELECT doc_id, text, lang, source, n_chars FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY text "
        "ORDER BY doc_id) AS rn FROM documents) WHERE rn = 1")
    s["latest_per_key"] = (
        "SELECT event_id, ts, user_id, event_type, value, props FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY "
        "user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS rn FROM events) WHERE rn = 1")
    s["union_distinct"] = with_ctes(
        f"{_artist_rows('chart_purged')} UNION {_artist_rows('release_purged')}", ["chart_purged", "release_purged"])
    s["surrogate_key"] = keyed("(SELECT DISTINCT p_name, p_brand, p_type FROM part)", ["p_name", "p_brand", "p_type"],
                               "part_key")
    for d in ("dim_artist", "dim_track", "dim_country", "dim_date", "dim_audio_features"):
        s[d] = with_ctes(f"SELECT * FROM {d}", [d])
    s["dim_audio_features_double_strip"] = with_ctes(keyed(
        f"(SELECT substring(uri, 16) AS uri, {cols(AUDIO_MEASURES)} FROM "
        f"(SELECT DISTINCT uri, {cols(AUDIO_MEASURES)} FROM chart_purged))",
        ["uri", *AUDIO_MEASURES], "audio_features_key"), ["chart_purged"])
    s["keep_one_chart"] = with_ctes(
        f"SELECT {cols(CHART_COLUMNS)} FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY {cols(CHART_COMPARE)} "
        f"ORDER BY \"rank\" ASC NULLS FIRST) AS rn FROM chart_clean) WHERE rn = 1", ["chart_clean"])
    s["fact_date_lookup"] = with_ctes(
        "SELECT c.uri, c.\"week\", d.date_key, d.day_name FROM chart_clean c LEFT JOIN dim_date d "
        "ON c.\"week\" = CAST(d.full_date AS DATE)", ["chart_clean", "dim_date"])
    s["chart_calendar"] = with_ctes(
        "SELECT c.uri, c.\"week\" AS chart_week, d.* FROM chart_clean c LEFT JOIN dim_date d "
        "ON c.\"week\" = CAST(d.full_date AS DATE)", ["chart_clean", "dim_date"])
    s["weekend_releases"] = with_ctes(
        "SELECT d.\"year\", d.\"quarter\", d.month_name, d.day_name, count(*) AS n_releases, min(d.full_date) AS first_date "
        "FROM release_clean r JOIN dim_date d ON r.release_date = CAST(d.full_date AS DATE) WHERE d.is_weekend GROUP BY 1, 2, 3, 4",
        ["release_clean", "dim_date"])
    s["fact_star_join"] = with_ctes("SELECT * FROM fact_raw", ["fact_raw"])
    s["fact_star_join_first"] = with_ctes(_fact_raw("first"),
                                          ["chart_purged", "dim_track", "dim_artist", "dim_country", "dim_date"])
    s["fact_build"] = with_ctes("SELECT * FROM fact", ["fact"])
    s["base_fact"] = with_ctes(f"SELECT {cols(FACT_COLUMNS)} FROM fact", ["fact"])
    s["weekly_trend"] = with_ctes("SELECT * FROM weekly", ["weekly"])
    s["artist_streams"] = with_ctes("SELECT * FROM artist_streams", ["artist_streams"])
    s["artist_popularity_by_key"] = with_ctes(
        # equal averages may differ in their last bits by the order of summation, so rows are compared after rounding
        f"SELECT DISTINCT artist_name, total_streams, {round6('avg_rank')} AS avg_rank, {round6('avg_popularity')} AS avg_popularity FROM ("
        "SELECT DISTINCT da.artist_name, a.total_streams, a.avg_rank, a.avg_popularity FROM artist_raw a "
        "LEFT JOIN dim_artist da ON a.artist_key = da.artist_key WHERE da.artist_name IS NOT NULL)",
        ["artist_raw", "dim_artist"])
    s["artist_popularity_by_name"] = with_ctes("SELECT * FROM by_name", ["by_name"])
    s["incremental_slice"] = with_ctes(f"SELECT * FROM release_purged WHERE release_date = DATE '{RUN_DATE}'",
                                       ["release_purged"])
    s["merge_upsert_artist"] = with_ctes(f"SELECT * FROM {_merge_artist('dim_artist_hist')}",
                                         ["dim_artist_hist", "release_purged"])
    s["merge_upsert_artist_stale_insert"] = with_ctes(
        f"SELECT * FROM {_merge_artist(STALE_TARGET, 'insert')}",
        ["dim_artist_hist", "release_purged"])
    s["merge_upsert_track"] = with_ctes(f"SELECT * FROM {_merge_track('dim_track_hist')}",
                                        ["dim_track_hist", "release_purged"])
    # data-quality checks
    s["dq_not_null"] = with_ctes(
        "SELECT 'not_null_fact_artist_key' AS check_name, CAST(count(*) AS BIGINT) AS failures, count(*) != 0 AS "
        "should_warn, count(*) != 0 AS should_error FROM fact WHERE artist_key IS NULL", ["fact"])
    s["dq_unique"] = with_ctes(
        "SELECT artist_name AS unique_field, count(*) AS n_records FROM dim_artist WHERE artist_name IS NOT NULL "
        "GROUP BY artist_name HAVING count(*) > 1", ["dim_artist"])
    s["dq_report"] = with_ctes(_report_sql(), ["weekly", "by_name"])
    s["dq_primary_key"] = with_ctes("SELECT uri, artist_id, count(*) AS n_records FROM chart_clean GROUP BY uri, artist_id "
                                    "HAVING count(*) > 1 OR uri IS NULL OR artist_id IS NULL", ["chart_clean"])
    s["dq_foreign_key"] = ("SELECT d.doc_id, d.lang, d.source FROM documents d WHERE d.doc_id IS NOT NULL AND NOT EXISTS "
                           "(SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
    s["dq_fact_foreign_keys"] = with_ctes(" UNION ALL ".join(
        f"SELECT 'fk_{k}' AS check_name, count(*) FILTER (WHERE f.{k} IS NOT NULL AND d.{k} IS NULL) AS failures, "
        f"count(*) FILTER (WHERE f.{k} IS NULL) AS without_key FROM fact f LEFT JOIN {d} d ON f.{k} = d.{k}" for k, d in FACT_DIMS.items()),
        ["fact", *FACT_DIMS.values()])
    s["dq_fanout"] = with_ctes("SELECT artist_id, count(*) AS n_rows FROM dim_artist GROUP BY artist_id "
                               "HAVING count(*) > 1", ["dim_artist"])
    # weekly load
    s["flatten_release_pages"] = with_ctes("SELECT * FROM weekly_items", ["weekly_items"])
    paged = ("SELECT *, ((page_id % 7) + 7) % 7 AS kind FROM (SELECT *, CASE WHEN copy = 1 THEN p ELSE -1 - p END AS page_id FROM ("
             "SELECT *, CAST(split_part(uri, ':', 3) AS BIGINT) // 50 AS p, row_number() OVER (PARTITION BY uri) AS copy FROM weekly_items))")
    s["variant_items"] = with_ctes(
        f"SELECT * EXCLUDE (p, copy, kind) REPLACE (CASE WHEN kind <> 1 THEN album_num_tracks END AS album_num_tracks), "
        f"CASE WHEN kind = 5 THEN 'US' END AS market FROM ({paged}) WHERE kind NOT IN (3, 6)", ["weekly_items"])
    s["variant_quarantine"] = with_ctes(
        f"SELECT DISTINCT page_id, CASE kind WHEN 3 THEN 'not JSON' ELSE 'no items' END AS reason FROM ({paged}) WHERE kind IN (3, 6)", ["weekly_items"])
    s["array_flatten_names"] = with_ctes(
        "SELECT uri, artist_names, artists_num, artist_individual, artist_id FROM weekly_items", ["weekly_items"])
    s["collab_flag"] = with_ctes("SELECT uri, artists_num, collab FROM weekly_items", ["weekly_items"])
    s["enrich_artist"] = with_ctes(
        "SELECT uri, artist_id, artist_genre, artist_img FROM weekly_enriched", ["weekly_enriched"])
    s["infer_country"] = with_ctes("SELECT uri, artist_genre, country FROM weekly_enriched", ["weekly_enriched"])
    s["rolling_week_filter"] = with_ctes("SELECT * FROM weekly_raw", ["weekly_raw"])
    s["clean_weekly"] = with_ctes("SELECT * FROM weekly_clean", ["weekly_clean"])
    s["run_weekly_load"] = with_ctes(purge_sql("weekly_clean", ["uri"], RELEASE_COLUMNS), ["weekly_clean"])
    # end-to-end runs
    s["run_chart_clean"] = s["purge_dups_single_key"]
    s["run_release_clean"] = with_ctes("SELECT * FROM release_purged", ["release_purged"])
    s["run_fact"] = s["fact_build"]
    s["stream_dedup"] = "SELECT DISTINCT user_id, event_type FROM events"
    snap1 = f"({_snap_first(SNAP_V1)})"
    s["scd2_snapshot"] = f"SELECT * FROM ({_snap_step(snap1, SNAP_V2, SNAPSHOT_AS_OF[1])})"
    h1 = f"({_snap_first(SNAP_FULL)})"
    h2 = f"({_snap_step(h1, SNAP_GONE, SNAPSHOT_AS_OF[1])})"
    s["scd2_hard_delete"] = f"SELECT * FROM ({_snap_step(h2, SNAP_FULL, SNAPSHOT_AS_OF[2])})"
    s["stream_upsert"] = s["merge_upsert_artist"]
    s["stream_release_load"] = with_ctes("SELECT DISTINCT * FROM weekly_clean", ["weekly_clean"])
    two = ("c_custkey", "c_nationkey")
    r1 = f"({_snap_first(SNAP_V1, two)})"
    r2 = f"({_snap_step(r1, SNAP_V2, SNAPSHOT_AS_OF[1], two)})"
    s["run_snapshot"] = f"SELECT * FROM ({_snap_step(r2, SNAP_FULL, SNAPSHOT_AS_OF[2], two)})"
    s["snapshot_colocated"] = s["run_snapshot"]
    mixed = (f"(SELECT * REPLACE (CASE WHEN track_key % 3 = 0 THEN {ts('2030-01-01 00:00:00')} WHEN track_key % 3 = 1 THEN {ts(None)} "
             f"ELSE effective_start_date END AS effective_start_date) FROM dim_track_hist)")
    s["merge_upsert_track_stale_insert"] = with_ctes(f"SELECT * FROM {_merge_track(mixed, 'insert')}", ["dim_track_hist", "release_purged"])
    s["run_dimensions"] = with_ctes(" UNION ALL ".join(_tall(d, d) for d in DIM_COLUMNS), list(DIM_COLUMNS))
    s["run_incremental_dims"] = with_ctes(
        f"{_tall('dim_artist', _merge_artist('dim_artist_hist'))} UNION ALL {_tall('dim_track', _merge_track('dim_track_hist'))}",
        ["dim_artist_hist", "dim_track_hist", "release_purged"])
    s["run_marts"] = with_ctes(
        "SELECT 'weekly_trend' AS mart, CAST(date_key AS VARCHAR) AS name, total_streams, avg_rank FROM weekly UNION ALL "
        "SELECT 'artist_popularity_by_name', artist_name, total_streams, avg_rank FROM by_name", ["weekly", "by_name"])
    s["write_tables"] = ("SELECT o_orderkey, o_custkey, o_orderstatus, (SELECT count(*) FROM orders WHERE o_orderstatus <> 'F') AS written "
                         "FROM orders")
    # stored tables
    s["merge_bucketed_artist"] = s["stream_merge"] = s["merge_upsert_artist"]
    s["merge_bucketed_track"] = s["merge_upsert_track"]
    s["purge_appended_loads"] = s["purge_dups_single_key"]
    s["model_marts"] = s["run_marts"]
    s["ensure_table"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders"
    s["dq_report_compiled"] = s["dq_report"]
    s["weekly_trend_incremental"], s["artist_streams_incremental"] = s["weekly_trend"], s["artist_streams"]
    s["fact_skew_lookup"] = with_ctes(
        "SELECT c.*, d.track_key FROM (SELECT CASE WHEN \"rank\" % 3 = 0 THEN (SELECT min(uri) FROM dim_track) ELSE uri END AS uri, \"rank\", streams "
        "FROM chart_purged) c LEFT JOIN dim_track d ON c.uri = d.uri", ["chart_purged", "dim_track"])
    s["reload_failed"] = "SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS failed, 4 AS version, count(*) OVER () AS of_two FROM orders"
    s["reload_conflict"] = "SELECT o_orderkey, o_custkey, o_orderstatus, 1 AS conflicts FROM orders WHERE o_orderstatus IN ('O', 'P')"
    s["sequence_keys"] = ("SELECT row_number() OVER (ORDER BY load, p_partkey) AS part_key, p_partkey, p_name, p_size, load FROM "
                          "(SELECT *, CASE WHEN p_size <= 20 THEN 0 WHEN p_size <= 40 THEN 1 ELSE 2 END AS load FROM part WHERE p_size > 0)")
    s["stream_dedup_state"] = "SELECT DISTINCT user_id, event_type, 0::BIGINT AS n_late FROM events"
    s["stream_late_rows"] = ("SELECT event_id, user_id, event_id % 10 = 0 AND ts <= (SELECT date_trunc('milliseconds', max(ts)) FROM events WHERE event_id % 10 <> 0) "
                             "- INTERVAL 1 DAY AS late FROM events")
    return s
