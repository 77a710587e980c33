import datetime as dt

from chartmart.operators.clean import CHART_COMPARE, CHART_SPEC, RELEASE_SPEC, WEEKLY_SPEC, clean
from chartmart.schemas import CHART_COLUMNS, RAW_CHART, RELEASE_COLUMNS


def raw_chart_row(**over):
    base = {c: "1" for c in CHART_COLUMNS}
    base.update(uri="catalog:tracks:77", artist_id="catalog:artist:5", release_date="01-02-2020",
                week="31-12-2020", danceability="0.5", artist_genre="main")
    base.update(over)
    return tuple(base[c] for c in CHART_COLUMNS)


def test_chart_clean_types_and_traps(spark):
    df = spark.createDataFrame([raw_chart_row(streams="12.7", rank="0"), raw_chart_row(streams="n/a", week="2020-12-31")],
                               RAW_CHART)
    out = clean(df, CHART_SPEC)
    assert out.columns == CHART_COLUMNS
    types = dict(out.dtypes)
    assert types["rank"] == "bigint" and types["danceability"] == "double" and types["week"] == "date"
    r = sorted(out.collect(), key=lambda x: x["streams"] is None)
    assert r[0]["uri"] == "77" and r[0]["artist_id"] == "5" and r[0]["streams"] == 13 and r[0]["rank"] == 0
    assert r[0]["week"] == dt.date(2020, 12, 31) and r[0]["release_date"] == dt.date(2020, 2, 1)
    assert r[1]["streams"] is None and r[1]["week"] is None


def test_compare_columns_leave_out_rank():
    assert "rank" not in CHART_COMPARE and len(CHART_COMPARE) == 34


def test_release_spec_keeps_artist_id_and_weekly_uses_iso():
    rules = dict(RELEASE_SPEC.rules)
    assert rules["uri"] == "strip" and rules["artist_id"] == "str" and rules["release_date"] == "date"
    w = dict(WEEKLY_SPEC.rules)
    assert w["uri"] == "str" and w["release_date"] == "iso_date" and list(w) == RELEASE_COLUMNS
