"""Typed cleaning projection: all-string landing rows -> typed rows in one ``select``."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartmart.functions import strip_prefix, try_date, try_float, try_int
from chartmart.schemas import CHART_COLUMNS, RELEASE_COLUMNS

# Rule names: "str" pass-through, "strip" drop the 15-char prefix, "int" try-int with
# rounding, "float" try-double, "date" strict dd-MM-yyyy, "iso_date" strict yyyy-MM-dd.


@dataclass(frozen=True)
class CleanSpec:
    rules: tuple[tuple[str, str], ...]
    prefix_len: int = 15
    extra: dict[str, Column] = field(default_factory=dict)

    def columns(self) -> list[str]:
        return [c for c, _ in self.rules]


def _rule(name: str, rule: str, prefix_len: int) -> Column:
    c = F.col(name)
    if rule == "str":
        out = c.cast("string")
    elif rule == "strip":
        out = strip_prefix(c, prefix_len)
    elif rule == "int":
        out = try_int(c.cast("string"))
    elif rule == "float":
        out = try_float(c.cast("string"))
    elif rule == "date":
        out = try_date(c.cast("string"), "dd-MM-yyyy")
    elif rule == "iso_date":
        out = try_date(c.cast("string"), "yyyy-MM-dd")
    else:
        raise ValueError(f"unknown clean rule {rule!r}")
    return out.alias(name)


def clean(df: DataFrame, spec: CleanSpec, **extra: Column) -> DataFrame:
    """One narrow projection; no shuffle, fully inside whole-stage codegen."""
    cols = [_rule(n, r, spec.prefix_len) for n, r in spec.rules]
    cols += [v.alias(k) for k, v in {**spec.extra, **extra}.items()]
    return df.select(*cols)


_INT = {"rank", "artists_num", "collab", "album_num_tracks", "peak_rank", "previous_rank", "weeks_on_chart",
        "streams", "key", "mode", "duration", "pivot"}
_FLOAT = {"danceability", "energy", "loudness", "speechiness", "acousticness", "instrumentalness", "liveness",
          "valence", "tempo"}
_DATE = {"release_date", "week"}


def _spec(columns: list[str], strip: set[str], date_rule: str = "date") -> CleanSpec:
    rules = []
    for c in columns:
        if c in strip:
            rules.append((c, "strip"))
        elif c in _INT:
            rules.append((c, "int"))
        elif c in _FLOAT:
            rules.append((c, "float"))
        elif c in _DATE:
            rules.append((c, date_rule))
        else:
            rules.append((c, "str"))
    return CleanSpec(tuple(rules))


# Chart file: uri and artist_id lose their prefix. Release file: only uri does (ids are bare).
# Weekly rows: no prefix strip, ISO dates.
CHART_SPEC = _spec(CHART_COLUMNS, {"uri", "artist_id"})
RELEASE_SPEC = _spec(RELEASE_COLUMNS, {"uri"})
WEEKLY_SPEC = _spec(RELEASE_COLUMNS, set(), date_rule="iso_date")

# Duplicate comparison of the chart table: every column except rank.
CHART_COMPARE = [c for c in CHART_COLUMNS if c != "rank"]
RELEASE_COMPARE = list(RELEASE_COLUMNS)
