"""Column expressions for parsing and normalising landed values.

Every helper returns a ``Column`` built from Spark built-ins, so it stays inside
whole-stage codegen; none of them is a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F



def epoch() -> Column:
    """The 1970-01-01 00:00:00 UTC sentinel ("missing time")."""
    return F.lit("1970-01-01 00:00:00").cast("timestamp")

SECONDS_PER_DAY = 86400

# The datetime layouts a conformed CSV cell may use, tried in this
# order (day-first before month-first, so 01/02/2024 is 1 February).  A trailing
# "Z" is tried first against the two ISO layouts with the Z removed.
ISO_Z_LAYOUTS = ["yyyy-M-d'T'H:m:s", "yyyy-M-d'T'H:m:s.SSSSSS"]
DATETIME_LAYOUTS = [
    "yyyy-M-d H:m:s",
    "yyyy-M-d H:m:s.SSSSSS",
    "yyyy-M-d'T'H:m:s",
    "yyyy-M-d'T'H:m:s.SSSSSS",
    "yyyy-M-d",
    "d/M/yyyy H:m:s",
    "d/M/yyyy",
    "M/d/yyyy H:m:s",
    "M/d/yyyy",
]

# Owner fields that mean "unknown".
UNKNOWN_OWNER = ["", "<nil>"]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_cast(c, to: str) -> Column:
    """Cast that yields NULL instead of failing (ANSI ``try_cast``)."""
    return col_of(c).try_cast(to)


def sentinel_to_null(c, sentinels=UNKNOWN_OWNER, lower: bool = True) -> Column:
    """Sentinel strings → NULL, everything else (optionally) lowercased."""
    c = col_of(c)
    kept = F.lower(c) if lower else c
    return F.when(c.isin(*sentinels), F.lit(None).cast("string")).otherwise(kept)


def parse_datetime_layouts(c) -> Column:
    """Multi-layout datetime parse; NULL when no layout matches or input empty."""
    c = F.trim(col_of(c).cast("string"))
    z_free = F.regexp_replace(c, "Z$", "")
    z_tries = [F.try_to_timestamp(z_free, F.lit(fmt)) for fmt in ISO_Z_LAYOUTS]
    tries = [F.try_to_timestamp(c, F.lit(fmt)) for fmt in DATETIME_LAYOUTS]
    parsed = F.coalesce(
        F.when(c.endswith("Z"), F.coalesce(*z_tries)),
        *tries,
    )
    return F.when(c == "", F.lit(None).cast("timestamp")).otherwise(parsed)


def best_effort_timestamp(c) -> Column:
    """ISO text (``T``/space separator, ``Z`` or ``UTC`` suffix, offsets) or unix
    seconds of 9 or 10 digits → timestamp, else NULL."""
    c = F.trim(col_of(c).cast("string"))
    cleaned = F.regexp_replace(c, r"\s+UTC$", "")
    # Only text that begins with a year is given to the lenient cast: it would take
    # a bare time of day as today's.
    dated = F.when(cleaned.rlike(r"^\d{4}(-|$)"), F.try_to_timestamp(cleaned))
    unix = F.when(cleaned.rlike(r"^\d{9,10}$"), F.timestamp_seconds(try_cast(cleaned, "bigint")))
    return F.coalesce(unix, dated, parse_datetime_layouts(cleaned))


def iso_or_epoch(c) -> Column:
    """ISO-8601 → UTC timestamp; missing or unparseable → the epoch sentinel."""
    return F.coalesce(best_effort_timestamp(c), epoch())


def iso_or_null(c) -> Column:
    """ISO-8601 → UTC timestamp; missing → NULL (the close-date rule)."""
    return best_effort_timestamp(c)


def unix_or_epoch(c) -> Column:
    """Unix seconds → UTC timestamp; ≤ 0, missing or invalid → epoch."""
    secs = try_cast(col_of(c).cast("string"), "double")
    return F.when(secs > 0, F.timestamp_seconds(secs.cast("bigint"))).otherwise(epoch())


def unix_or_null(c) -> Column:
    """Unix seconds (int or float) → UTC timestamp; invalid → NULL (row gets rejected)."""
    secs = try_cast(col_of(c).cast("string"), "double")
    ok = secs.isNotNull() & (F.abs(secs) < F.lit(253402300800.0))
    return F.when(ok, F.timestamp_micros((secs * F.lit(1_000_000)).cast("bigint")))


def millis_to_date(c) -> Column:
    """Unix milliseconds → UTC calendar date."""
    return F.to_date(F.timestamp_millis(col_of(c).cast("bigint")))


def boundary_day(seconds) -> Column:
    """Snap unix seconds to the nearest UTC midnight, half-even at noon."""
    days = F.bround(col_of(seconds).cast("double") / F.lit(float(SECONDS_PER_DAY)), 0)
    return F.date_from_unix_date(days.cast("int"))


def utc_midnight_seconds(d) -> Column:
    """Unix seconds of 00:00 UTC on date ``d``."""
    return F.unix_date(col_of(d).cast("date")).cast("bigint") * SECONDS_PER_DAY


def month_start(d) -> Column:
    """First day of the month (``toStartOfMonth``)."""
    return F.trunc(col_of(d).cast("date"), "MM")


def lenient_int(c) -> Column:
    """Integer or 0: numbers truncate toward zero, text must be an integer literal
    (``3.7`` as text is none).  Spaces around a literal are allowed."""
    c = col_of(c)
    text = F.trim(c.cast("string"))
    literal = F.when(text.rlike(r"^[+-]?[0-9]+$"), try_cast(text, "bigint"))
    number = F.when(F.typeof(c) != "string", try_cast(try_cast(text, "double"), "bigint"))
    return F.coalesce(literal, number, F.lit(0).cast("bigint"))


def lenient_double(c) -> Column:
    return F.coalesce(try_cast(col_of(c).cast("string"), "double"), F.lit(0.0))


def or_default(c, default) -> Column:
    """``x or default``: NULL, '' and 0 all fall through to the default."""
    c = col_of(c)
    d = F.lit(default)
    if isinstance(default, str):
        return F.when(c.isNull() | (c.cast("string") == ""), d).otherwise(c.cast("string"))
    return F.when(c.isNull() | (c == F.lit(0)), d).otherwise(c)


def json_text(j, path: str, missing: str = "") -> Column:
    """Scalar at a JSON path as text, ``missing`` when absent (``JSONExtractString``)."""
    return F.coalesce(F.get_json_object(col_of(j), path), F.lit(missing))


def coin_key(chain, address) -> Column:
    """``chain:address`` lookup key, both parts lowercased."""
    return F.concat_ws(":", F.lower(F.trim(col_of(chain))), F.lower(F.trim(col_of(address))))
