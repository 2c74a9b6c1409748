from starloom.functions.scalars import (  # noqa: F401
    blank_to_null,
    code_prefix,
    decade_group,
    is_blank,
    iso_utc,
    landing_stamp,
    or_zero,
    pct_diff,
    sex_code,
    size_mb,
    surrogate_key,
    trimmed_or,
    type_token,
    year_label,
    year_range,
)
