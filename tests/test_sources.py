import os
import tempfile

import pytest
from pyspark.sql import types as T

from chartmart.operators.weekly import enrich_artist, flatten_pages, weekly_rows
from chartmart.schemas import ARTIST_RECORD, PAGE
from chartmart.sources.files import FileFormat, scan_csv

S3 = T.StructType([T.StructField(c, T.StringType()) for c in ("a", "b", "c")])


def write(text):
    d = tempfile.mkdtemp(prefix="chartmart-test-")
    with open(os.path.join(d, "f.csv"), "w") as fh:
        fh.write(text)
    return d


def test_csv_quotes_commas_newlines_and_empty(spark):
    d = write('h1,h2,h3\n"x, y","line1\nline2","say ""hi"""\n1,,""\n')
    got = [tuple(r) for r in scan_csv(spark, d, S3, FileFormat(multi_line=True)).collect()]
    assert got == [("x, y", "line1\nline2", 'say "hi"'), ("1", None, None)]
    assert not FileFormat().multi_line  # by default a record is a line and large files are split


def test_csv_short_row_fails(spark):
    d = write("h1,h2,h3\n1,2\n")
    with pytest.raises(Exception):
        scan_csv(spark, d, S3, FileFormat()).collect()


def test_flatten_and_enrich_pages(spark):
    page = {"tracks": {"items": [
        {"uri": "u1", "name": "t1", "album": {"release_date": "2024-11-10", "total_tracks": 3, "label": "L",
                                              "images": []},
         "artists": [{"name": "A", "id": "a1"}, {"name": "B", "id": "b1"}]},
        {"uri": "u2", "name": "t2", "album": {"release_date": "2024", "total_tracks": 1}, "artists": [{"name": "C", "id": "c1"}]},
    ]}}
    pages = spark.createDataFrame([page], PAGE)
    items = flatten_pages(pages)
    r = {x["uri"]: x for x in items.collect()}
    assert (r["u1"]["artist_names"], r["u1"]["artists_num"], r["u1"]["collab"], r["u1"]["album_cover"]) == \
        ("A, B", 2, 1, None)
    assert r["u2"]["album_cover"] is None and r["u2"]["source"] is None and r["u2"]["collab"] == 0
    artists = spark.createDataFrame([{"id": "a1", "genres": ["US K-pop"], "images": []},
                                     {"id": "c1", "genres": [], "images": [{"url": "img"}]}], ARTIST_RECORD)
    e = {x["uri"]: x for x in enrich_artist(items, artists).collect()}
    assert (e["u1"]["artist_genre"], e["u1"]["artist_img"], e["u1"]["country"]) == ("US K-pop", None, "United States")
    assert (e["u2"]["artist_genre"], e["u2"]["artist_img"], e["u2"]["country"]) == ("", "img", "Global")
    week = weekly_rows(enrich_artist(items, artists), "2024-11-15").collect()
    assert [x["uri"] for x in week] == ["u1"]


def test_csv_round_trip_keeps_edge_whitespace(spark):
    from chartmart.sources.files import write_csv

    df = spark.createDataFrame([("  lead", "trail  ", 'q"uote, and\nnewline')], S3)
    path = os.path.join(tempfile.mkdtemp(prefix="chartmart-rt-"), "out")
    write_csv(df, path)
    assert [tuple(r) for r in scan_csv(spark, path, S3, FileFormat(multi_line=True)).collect()] == [("  lead", "trail  ", 'q"uote, and\nnewline')]
