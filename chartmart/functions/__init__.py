from chartmart.functions.scalar import (  # noqa: F401
    COUNTRY_BY_GENRE,
    collab_flag,
    first_or_null,
    infer_country,
    join_names,
    names_of,
    released_in_last_days,
    safe_ratio,
    strip_prefix,
    try_date,
    try_float,
    try_int,
)
