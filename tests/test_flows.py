"""End-to-end runs M1-M7 on the smallest scale, through the named-table catalog."""
import os
import tempfile

from pyspark.sql import functions as F

from chartmart.operators.dims import build_dim_date
from chartmart.plans import flows
from chartmart.plans import registry as R
from chartmart.sources import binding as B
from chartmart.sources.catalog import Catalog
from chartmart.sources.files import write_csv
from conftest import SF_SMALL


def test_end_to_end_runs(spark):
    root = tempfile.mkdtemp(prefix="chartmart-e2e-")
    cat = Catalog(spark, root)
    chart_csv, release_csv = os.path.join(root, "in/chart"), os.path.join(root, "in/release")
    write_csv(B.chart_raw(spark, SF_SMALL), chart_csv)
    write_csv(B.release_raw(spark, SF_SMALL), release_csv)

    chart = cat.write("raw.music_chart_cleaned", flows.run_historical_chart(spark, chart_csv))            # M1
    release = cat.write("raw.music_release_cleaned", flows.run_historical_release(spark, release_csv),      # M2
                        partition_by=["release_date"])
    assert chart.count() == R.chart_purged(spark, SF_SMALL).count()

    dims = flows.run_dimensions(spark, chart, release)                                                     # M3
    assert set(dims) == {"dim_artist", "dim_track", "dim_country", "dim_date", "dim_audio_features"}
    for name, d in dims.items():
        key = d.columns[0]
        assert d.count() == d.select(key).distinct().count(), name                                        # keys unique
    dims2 = flows.run_incremental_dims(dims, release)                                                      # M4
    assert dims2["dim_artist"].count() >= dims["dim_artist"].count()

    fact = cat.write("raw.fact_music_streams", flows.run_fact(chart, dims2))                               # M5
    assert fact.columns[:4] == ["track_key", "artist_key", "country_key", "date_key"]
    cust = B.read_table(spark, SF_SMALL, "customer").withColumn(
        "updated_at", F.lit("2024-01-01 00:00:00").cast("timestamp_ntz"))
    marts = flows.run_marts(fact, dims2["dim_artist"], None, cust, ["c_custkey"])                          # M6
    report = {r["check_name"]: r["failures"] for r in marts["report"].collect()}
    assert report["unique_weekly_trend_analysis_date_key"] == 0
    assert report["not_null_weekly_trend_analysis_date_key"] in (0, 1)
    assert marts["snapshot"].count() == cust.count()
    cat.write("analytics.weekly_trend_analysis", marts["weekly_trend"])
    assert cat.table("analytics.weekly_trend_analysis").count() == marts["weekly_trend"].count()

    pages, artists = R.landed_pages(spark, SF_SMALL)
    weekly = flows.run_weekly_load(pages, artists)                                                          # M7
    assert weekly.filter(F.col("release_date").isNull()).count() == 0
    assert build_dim_date(spark).count() == 13149


def test_catalog_names(spark):
    cat = Catalog(spark, "/x")
    assert cat.location("raw.t") == "/x/raw/t"
    try:
        cat.location("t")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_catalogs_with_same_names_do_not_collide(spark):
    a, b = Catalog(spark, tempfile.mkdtemp(prefix="cat-a-")), Catalog(spark, tempfile.mkdtemp(prefix="cat-b-"))
    a.write("analytics.same", spark.range(3), bucket_by=(2, ["id"]))
    b.write("analytics.same_plain", spark.range(5))
    b.write("analytics.same", spark.range(5))  # plain parquet under b's root
    assert a.table("analytics.same").count() == 3  # the session entry is a's bucketed table
    assert b.table("analytics.same").count() == 5
