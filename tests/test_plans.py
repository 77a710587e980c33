"""Physical-plan properties: pruning, pushdown, join strategies, no single-task windows."""
import contextlib
import io
import re

from chartmart.operators.fact import build_fact
from chartmart.operators.upsert import select_run_date
from chartmart.plans import registry as R
from conftest import SF_SMALL


def explained(df, run: bool = True) -> str:
    """Formatted plan text; after a run the adaptive plan shows its final form."""
    if run:
        df.collect()
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_fact_scan_is_column_pruned_and_lookups_broadcast(spark):
    chart = R.chart_purged(spark, SF_SMALL)
    d = R.all_dims(spark, SF_SMALL, chart)
    text = explained(build_fact(chart, d["dim_track"], d["dim_artist"], d["dim_country"], d["dim_date"]))
    widest = max(len(s.split(",")) for s in re.findall(r"ReadSchema: struct<([^>]*)>", text))
    assert widest <= 9  # 9 of the 35 cleaned columns are read
    final = text.split("== Initial Plan ==")[0]
    assert "SortMergeJoin" not in final and final.count("BroadcastHashJoin") >= 4


def test_run_date_slice_prunes_partitions(spark):
    rel = R.release_purged(spark, SF_SMALL)
    text = explained(select_run_date(rel, "release_date", "2024-11-15"), run=False)
    assert re.search(r"PartitionFilters: \[.*release_date.*2024-11-15", text)


def test_purge_and_latest_have_no_window(spark):
    for key in ("purge_dups_single_key", "latest_per_key", "drop_exact_duplicates"):
        assert "Window" not in explained(R.queries()[key](spark, SF_SMALL)), key
