"""Column expressions. All of them are built-in functions, so they stay inside generated code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str

# Fixed values.
KEY_NULL_TOKEN = "_dbt_utils_surrogate_key_null_"
KEY_SEPARATOR = "-"
SEX_PREFIX = "SEX_"
SEX_CODES = ("MLE", "FMLE", "BTSX")


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def blank_to_null(c: ColumnLike) -> Column:
    """Trim spaces; what is left empty becomes NULL."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def trimmed_or(c: ColumnLike, default: str) -> Column:
    return F.coalesce(blank_to_null(c), F.lit(default))


def is_blank(c: ColumnLike) -> Column:
    """NULL or empty. Spaces count as content here, unlike in :func:`blank_to_null`."""
    return _col(c).isNull() | (_col(c) == "")


def surrogate_key(*cols: ColumnLike) -> Column:
    """MD5 over the text of the fields; a NULL field hashes as a fixed token."""
    parts = [F.coalesce(_col(c).cast("string"), F.lit(KEY_NULL_TOKEN)) for c in cols]
    return F.md5(parts[0] if len(parts) == 1 else F.concat_ws(KEY_SEPARATOR, *parts))


def year_label(year: ColumnLike) -> Column:
    return _col(year).cast("string")


def decade_group(year: ColumnLike) -> Column:
    """Four labels; everything from 2020 on, and a missing year, falls in the last one."""
    y = _col(year)
    return (
        F.when(y < 2000, "before_2000").when(y < 2010, "2000s").when(y < 2020, "2010s").otherwise("2020s")
    )


def year_range(lo: Column, hi: Column) -> Column:
    return F.concat(lo.cast("string"), F.lit("–"), hi.cast("string"))


def code_prefix(c: ColumnLike, sep: str = "_") -> Column:
    """The text before the first separator, or all of it if there is none."""
    return F.split_part(_col(c), F.lit(sep), F.lit(1))


def sex_code(c: ColumnLike, codes: tuple[str, ...] = SEX_CODES, prefix: str = SEX_PREFIX) -> Column:
    """Drop the dimension prefix and keep only known codes; anything else is NULL."""
    raw = _col(c)
    bare = F.when(raw.startswith(prefix), F.replace(raw, F.lit(prefix), F.lit(""))).otherwise(raw)
    return F.when(bare.isin(*codes), bare)


def or_zero(c: ColumnLike) -> Column:
    return F.coalesce(_col(c), F.lit(0))


def pct_diff(base: ColumnLike, other: ColumnLike) -> Column:
    """Difference in percent of ``base``. Against a zero base it is 0 or 100, never a division."""
    a, b = _col(base).cast("double"), _col(other).cast("double")
    against_zero = F.when(b == 0, F.lit(0.0)).otherwise(F.lit(100.0))
    return F.when(a == 0, against_zero).otherwise(F.try_divide(F.abs(a - b), a) * 100)


def type_token(c: ColumnLike) -> Column:
    """First word of a type name, in lower case."""
    return F.split_part(F.lower(_col(c)), F.lit(" "), F.lit(1))


def size_mb(n_bytes: ColumnLike) -> Column:
    return F.round(_col(n_bytes) / F.lit(1024 * 1024), 2)


def iso_utc(ts: ColumnLike) -> Column:
    """ISO-8601 text; the session time zone has to be UTC."""
    return F.date_format(_col(ts), "yyyy-MM-dd'T'HH:mm:ssxxx")


def landing_stamp(ts: ColumnLike) -> Column:
    return F.date_format(_col(ts), "yyyyMMdd_HHmmss")
