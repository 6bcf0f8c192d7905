"""Column expressions (``Column -> Column``), all built-in so they stay inside codegen."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values (must equal the reference's output for parity) -----------------------
# Surrogate keys: MD5 over the key parts joined with "-", a NULL part written as this text
# (the public dbt_utils generate_surrogate_key convention).
SURROGATE_KEY_SEPARATOR = "-"
SURROGATE_KEY_NULL = "_dbt_utils_surrogate_key_null_"
# Label used for missing borough / zip / vehicle values in dimensions and rollups.
UNKNOWN_LABEL = "Unknown"
# ----------------------------------------------------------------------------------------

# Row fingerprint used as the deterministic tie-break of keep-latest dedupe (our rule).
# Parts carry their length, so no two different rows share the text that is hashed.
FINGERPRINT_SEPARATOR = "|"
FINGERPRINT_NULL = "~"
FINGERPRINT_SHORT = 64          # values of fewer characters have the text of their length looked up


def col_(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c: str | Column, to: str) -> Column:
    """Cast that yields NULL instead of failing the job (ANSI mode raises on bad text)."""
    return col_(c).try_cast(to)


def empty_to_null(c: str | Column) -> Column:
    """``NULLIF(c, '')``."""
    return F.nullif(col_(c), F.lit(""))


def sentinel_to_null(c: str | Column, sentinel=0) -> Column:
    """``CASE WHEN c = sentinel THEN NULL ELSE c END`` — NULL and NaN pass through unchanged."""
    c = col_(c)
    return F.when(c == F.lit(sentinel), None).otherwise(c)


def non_negative(c: str | Column) -> Column:
    """``CASE WHEN c < 0 THEN NULL ELSE c END``."""
    c = col_(c)
    return F.when(c < 0, None).otherwise(c)


def compose_timestamp(date: str | Column, time: str | Column, time_format: str = "H:mm",
                      default_time: str = "0:00") -> Column:
    """Date plus a free-text time of day as ``TIMESTAMP_NTZ``; unparsable time -> NULL.

    Blank or missing time falls back to ``default_time``. The time text is parsed on its own
    (``try_to_timestamp`` with the time-only pattern lands on 1970-01-01 in the session zone,
    where no daylight-saving gap exists) and its wall-clock fields are put on the date, so the
    result does not depend on the session time zone.
    """
    d = col_(date)
    t = F.coalesce(F.nullif(F.trim(col_(time)), F.lit("")), F.lit(default_time))
    parsed = F.try_to_timestamp(t, F.lit(time_format))
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d),
                                F.hour(parsed), F.minute(parsed), F.second(parsed))


def null_safe_sum(cols) -> Column:
    """``COALESCE(a,0) + COALESCE(b,0) + …``."""
    return reduce(add, [F.coalesce(col_(c), F.lit(0)) for c in cols])


def filled_count(*cols) -> Column:
    """Number of non-NULL values among ``cols`` (INT)."""
    return reduce(add, [col_(c).isNotNull().cast("int") for c in cols])


def label(c: str | Column, text: str = UNKNOWN_LABEL) -> Column:
    """``COALESCE(c, 'Unknown')``."""
    return F.coalesce(col_(c), F.lit(text))


def surrogate_key(*cols, length_prefixed: bool = False) -> Column:
    """MD5 hex over the NULL-safe, separator-joined text of ``cols``.

    With the default separator ``('a-b','c')`` and ``('a','b-c')`` collide; the optional
    length-prefixed variant (``len:value`` per part) is unambiguous but not parity-compatible.
    """
    parts = [F.coalesce(col_(c).cast("string"), F.lit(SURROGATE_KEY_NULL)) for c in cols]
    if length_prefixed:
        parts = [F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts]
    return F.md5(F.concat_ws(SURROGATE_KEY_SEPARATOR, *parts))


def row_fingerprint(*cols) -> Column:
    """MD5 of the raw values as ``length:value`` joined with ``|`` (NULL as ``~``): a total
    order of different rows, so a retried dedupe keeps the same one."""
    parts: list[Column] = []
    for i, c in enumerate(cols):
        t, sep = col_(c).cast("string"), FINGERPRINT_SEPARATOR if i else ""
        # what stands before a short value is one of a few texts: looked up, not written out for every row
        short = F.split(F.lit(",".join(f"{sep}{n}:" for n in range(FINGERPRINT_SHORT))), ",")
        other = (F.when(t.isNull(), sep + FINGERPRINT_NULL)
                 .otherwise(F.concat(F.lit(sep), F.length(t).cast("string"), F.lit(":"))))
        # concat_ws leaves out NULL, so of a NULL value only its mark is joined: one copy of the text
        parts += [F.coalesce(F.get(short, F.length(t)), other), t]
    return F.md5(F.concat_ws("", *parts))


def rate_per_100(numerator: str | Column, denominator: str | Column, scale: int = 2) -> Column:
    """``ROUND(num * 100.0 / den, 2)`` as DOUBLE.

    ``100.0`` is a DECIMAL literal as in SQL, so the rounding is exact decimal HALF_UP
    (SQL would type the result DECIMAL(27,2)); the result is then cast to DOUBLE.
    """
    return F.round(col_(numerator) * F.lit(Decimal("100.0")) / col_(denominator),
                   scale).cast("double")


def month_start_label(year: str | Column, month: str | Column) -> Column:
    """``yyyy-MM-01`` text of the first day of the month."""
    return F.date_format(F.make_date(col_(year), col_(month), F.lit(1)), "yyyy-MM-dd")
