"""Scalar column functions (all JVM-side expressions, no Python UDF).

Each helper builds a ``Column`` from Spark built-ins so it stays inside
whole-stage codegen.  Semantics follow the reference's string/date helpers, with
the fixes listed in SURVEY §2.13.
"""

from __future__ import annotations

from typing import Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

# date/time text formats used by the reference.
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATEKEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
# Lenient parse pattern: one-letter fields accept 1 or 2 digits ("2024-01-01 7:05:09").
TIME_PARSE_FORMAT = "yyyy-M-d H:m:s"


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- ratios


def idiv(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Integral division (SQL ``a div b``), exact on bigint."""
    return F.call_function("div", _c(a), _c(b))


def ratio(n: ColumnOrName, d: ColumnOrName, scale: int = 2) -> Column:
    """Round-half-up of the exact rational ``n / d`` to ``scale`` decimals; NULL if d = 0.

    Integer rule ``((2·10^s·n + d) div (2·d)) / 10^s`` — exact for non-negative
    integers, and identical in DuckDB; never ``round(double)``, whose tie handling
    differs between engines.
    """
    n, d = _c(n).cast("bigint"), _c(d).cast("bigint")
    p = 10**scale
    q = idiv(F.lit(2 * p) * n + d, F.lit(2) * d)
    return F.when(d == 0, F.lit(None).cast("double")).otherwise(q.cast("double") / F.lit(float(p)))


# ---------------------------------------------------------------- strings


def is_empty(s: ColumnOrName) -> Column:
    """NULL or ''."""
    s = _c(s)
    return s.isNull() | (s == F.lit(""))


def is_not_empty(s: ColumnOrName) -> Column:
    """neither NULL nor ''."""
    return ~is_empty(s)


def trim_comma(s: ColumnOrName) -> Column:
    """drop one leading and one trailing comma."""
    return F.regexp_replace(_c(s), r"\A,|,\z", "")


def zero_pad2(s: ColumnOrName) -> Column:
    """keep a 2-character string, else prefix one ``0`` (``'123'`` → ``'0123'``)."""
    s = _c(s)
    return F.when(F.length(s) == 2, s).otherwise(F.concat(F.lit("0"), s))


def _segments(s: Column, delim: str) -> Column:
    # Java String.split drops trailing empty strings: strip trailing delimiters.
    esc = "\\" + delim if delim in "|.^$*+?()[]{}\\" else delim
    return F.split(F.regexp_replace(s, f"(?:{esc})+\\z", ""), esc)


def kv_get(s: ColumnOrName, field: str, delim: str = "|") -> Column:
    """value of ``field`` in ``k=v<delim>k=v``; first well-formed match; NULL if none.

    A segment counts only when it splits into exactly two parts on ``=`` (after
    Java's trailing-empty rule), so ``field=`` (empty value) never matches.
    """
    segs = _segments(_c(s), delim)
    parts = F.transform(segs, lambda x: F.split(F.regexp_replace(x, r"=+\z", ""), "="))
    hits = F.filter(parts, lambda p: (F.size(p) == 2) & (p[0] == F.lit(field)))
    return F.try_element_at(F.try_element_at(hits, F.lit(1)), F.lit(2))


def kv_set(s: ColumnOrName, field: str, value: ColumnOrName, delim: str = "|") -> Column:
    """replace the first ``field=...`` segment by ``field=value``; unknown key → unchanged."""
    segs = _segments(_c(s), delim)
    names = F.transform(segs, lambda x: F.split(x, "=")[0])
    pos = F.array_position(names, F.lit(field))
    new_seg = F.concat(F.lit(field + "="), _c(value) if not isinstance(value, str) else F.lit(value))
    replaced = F.transform(segs, lambda x, i: F.when(i + 1 == pos, new_seg).otherwise(x))
    return F.array_join(replaced, delim)


def kv_encode(pairs: list[tuple[str, ColumnOrName]], delim: str = "|") -> Column:
    """Encode columns as ``k=v<delim>k=v`` (NULL value prints as empty)."""
    return F.concat_ws(
        delim, *[F.concat(F.lit(k + "="), F.coalesce(_c(v).cast("string"), F.lit(""))) for k, v in pairs]
    )


def split_longs(s: ColumnOrName, sep: str = ",") -> Column:
    """comma list → ``array<bigint>``; blanks and non-numbers are skipped."""
    parts = F.split(_c(s), sep)
    return F.filter(F.transform(parts, lambda x: F.trim(x).try_cast("bigint")), lambda x: x.isNotNull())


def join_sorted(arr: ColumnOrName, sep: str = ",") -> Column:
    """Sorted array → delimited string (arrays are kept as arrays until output)."""
    return F.array_join(F.array_sort(_c(arr)), sep)


# ---------------------------------------------------------------- dates


def parse_time(s: ColumnOrName) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text → timestamp_ntz; NULL on a parse error."""
    return F.try_to_timestamp(_c(s), F.lit(TIME_PARSE_FORMAT)).cast("timestamp_ntz")


def parse_date_key(s: ColumnOrName) -> Column:
    """``yyyyMMdd`` → date; NULL on a parse error."""
    return F.try_to_timestamp(_c(s), F.lit(DATEKEY_FORMAT)).cast("date")


def format_time(ts: ColumnOrName) -> Column:
    """F10."""
    return F.date_format(_c(ts), TIME_FORMAT)


def format_date(ts: ColumnOrName) -> Column:
    """F10."""
    return F.date_format(_c(ts), DATE_FORMAT)


def format_date_key(ts: ColumnOrName) -> Column:
    """F10."""
    return F.date_format(_c(ts), DATEKEY_FORMAT)


def format_time_minute(ts: ColumnOrName) -> Column:
    """minute key ``yyyyMMddHHmm``."""
    return F.date_format(_c(ts), MINUTE_KEY_FORMAT)


def date_hour(ts: ColumnOrName) -> Column:
    """``yyyy-MM-dd_HH``."""
    return F.date_format(_c(ts), DATE_HOUR_FORMAT)


def time_before(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a < b`` on parsed times; false if either does not parse."""
    return F.coalesce(parse_time(a) < parse_time(b), F.lit(False))


def time_after(a: ColumnOrName, b: ColumnOrName) -> Column:
    """``a > b`` on parsed times; false if either does not parse."""
    return F.coalesce(parse_time(a) > parse_time(b), F.lit(False))


def seconds_between(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Whole seconds ``a - b`` of two timestamps (truncated toward zero)."""
    return F.timestamp_diff("SECOND", _c(b), _c(a))


def time_minus(a: ColumnOrName, b: ColumnOrName) -> Column:
    """F8: seconds between two time strings; 0 if either does not parse."""
    return F.coalesce(seconds_between(parse_time(a), parse_time(b)), F.lit(0).cast("bigint"))


def today() -> Column:
    """F9."""
    return F.current_date()


def yesterday() -> Column:
    """F9."""
    return F.date_sub(F.current_date(), 1)


def millis_to_time(ms: ColumnOrName) -> Column:
    """epoch milliseconds → timestamp (an instant)."""
    return F.timestamp_millis(_c(ms).cast("bigint"))
