"""Column functions: all built-in Spark expressions, so they stay inside whole-stage codegen.

Spark 4 runs with ANSI mode on, where plain ``cast``/``to_date`` raise on bad input; every
parse here uses a ``try_`` form so a bad value becomes NULL.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_prefix(c: ColumnOrName, n: int | None = 15, sep: str | None = None) -> Column:
    """Drop a fixed-width prefix (``substring(s, n+1)``, literal by position) or,
    with ``sep``, everything up to the last separator."""
    c = _col(c)
    if sep is not None:
        return F.substring_index(c, sep, -1)
    return F.substring(c, n + 1, 2147483647)


def try_int(c: ColumnOrName) -> Column:
    """Integer parse that rounds decimals like a warehouse TRY_CAST to INTEGER does:
    '12.7' -> 13, '-12.5' -> -13, ' 7 ' -> 7, '1e3' -> 1000, 'n/a' and '' -> NULL."""
    return F.round(_col(c).try_cast("decimal(38,10)"), 0).try_cast("bigint")


def try_float(c: ColumnOrName) -> Column:
    return _col(c).try_cast("double")


def try_date(c: ColumnOrName, fmt: str = "dd-MM-yyyy") -> Column:
    """Strict date parse; any string not in ``fmt`` gives NULL."""
    return F.try_to_date(_col(c), fmt)


def safe_ratio(num: ColumnOrName, den: ColumnOrName) -> Column:
    """``num / NULLIF(den, 0)`` as a double; a zero denominator gives NULL, never an error."""
    return _col(num).cast("double") / F.nullif(_col(den), F.lit(0)).cast("double")


def collab_flag(n_artists: ColumnOrName) -> Column:
    return F.when(_col(n_artists) > 1, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


# Genre substrings that name a country, tested in this order, case-sensitive.
COUNTRY_BY_GENRE = [("US", "United States"), ("K-pop", "South Korea")]
DEFAULT_COUNTRY = "Global"


def infer_country(genre: ColumnOrName) -> Column:
    """First genre substring that matches names the country; otherwise 'Global'."""
    g = _col(genre)
    expr = None
    for needle, country in COUNTRY_BY_GENRE:
        hit = F.coalesce(g.contains(needle), F.lit(False))
        expr = F.when(hit, F.lit(country)) if expr is None else expr.when(hit, F.lit(country))
    return expr.otherwise(F.lit(DEFAULT_COUNTRY))


def names_of(arr: ColumnOrName, field: str = "name") -> Column:
    """Array of structs -> array of one field."""
    return F.transform(_col(arr), lambda x: x[field])


def join_names(arr: ColumnOrName, field: str = "name", sep: str = ", ") -> Column:
    return F.array_join(names_of(arr, field), sep)


def first_or_null(arr: ColumnOrName) -> Column:
    """First element of an array, NULL when the array is empty or NULL (null-safe under ANSI)."""
    return F.get(_col(arr), 0)


def released_in_last_days(c: ColumnOrName, as_of: date | str | Column, n: int = 7) -> Column:
    """True when an ISO ``yyyy-MM-dd`` string is exactly one of the ``n`` days before ``as_of``
    (``as_of`` itself excluded). Year- or month-only strings never match."""
    as_of_col = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    s = _col(c)
    d = F.try_to_date(s, "yyyy-MM-dd")
    full = F.length(s) == 10
    return F.coalesce(full & d.between(F.date_sub(as_of_col, n), F.date_sub(as_of_col, 1)), F.lit(False))
