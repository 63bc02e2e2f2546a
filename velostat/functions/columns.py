"""Column expressions for cleaning, parsing and the domain keys.

Every function maps Columns to a Column built from Spark built-ins, so the work
stays inside whole-stage codegen; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from velostat.schema import NY_TZ

# Fixed values (must equal the reference's): timestamp text formats, tried in
# this order before a plain cast.  Written as Spark datetime patterns; single
# letters accept one or two digits (y: any number; '25' is the year 25) and
# SSSSSS accepts one to six fraction digits.
TIMESTAMP_PATTERNS = (
    "y-M-d H:m:s",
    "y-M-d H:m:s.SSSSSS",
    "M/d/y H:m:s",
    "M/d/y H:m",
)
# An ISO date at 24:00 is the next midnight.
END_OF_DAY = r"^([0-9]{4}-[0-9]{1,2}-[0-9]{1,2})[ T]24:00(?::00(?:\.0*)?)?$"

# Fixed value (must equal the reference's): what counts as a numeric station id.
NUMERIC_STATION_ID = r"^[0-9]+(\.[0-9]+)?$"
DOTTED_STATION_ID = r"^[0-9]+\.[0-9]+$"

# Fixed value (must equal the reference's): placeholder for absent proxy parts.
UNKNOWN = "unknown"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c: Column | str) -> Column:
    """Trim spaces on both sides; empty text becomes NULL (tabs and newlines stay)."""
    return F.nullif(F.trim(_col(c).cast("string")), F.lit(""))


def safe_double(c: Column | str) -> Column:
    """Cleaned text to DOUBLE, NULL when it does not parse."""
    return clean_text(c).try_cast("double")


def safe_bigint(c: Column | str) -> Column:
    """Text to BIGINT the way a lenient SQL cast does it: decimals and
    exponents are accepted and rounded half away from zero ('2.5' -> 3,
    '-2.5' -> -3, '1e3' -> 1000); junk and overflow give NULL."""
    text = _col(c)
    exact = F.round(text.try_cast("decimal(38,18)"), 0)
    # exponent forms ('0e38', '1.5e2') take the DOUBLE parse, as a SQL cast does
    scientific = F.round(text.try_cast("double"), 0)
    return F.when(text.rlike("[eE]"), scientific.try_cast("bigint")).otherwise(exact.try_cast("bigint"))


def parse_local_timestamp(c: Column | str) -> Column:
    """Wall-clock text to TIMESTAMP_NTZ trying each pattern, then a plain cast.

    Parsed values are cast to NTZ under the session's UTC zone, so no wall
    clock falls into a gap.  An ISO date at 24:00 gives the next midnight."""
    text = _col(c)
    attempts = [F.try_to_timestamp(text, F.lit(p)).cast("timestamp_ntz") for p in TIMESTAMP_PATTERNS]
    attempts.append(text.try_cast("timestamp_ntz"))
    next_day = F.date_add(F.nullif(F.regexp_extract(text, END_OF_DAY, 1), F.lit("")).try_cast("date"), 1)
    attempts.append(next_day.cast("timestamp_ntz"))
    return F.coalesce(*attempts)


def local_to_utc(local: Column | str, tz: str = NY_TZ) -> Column:
    """Naive local wall clock -> instant (TIMESTAMP).

    In the autumn fold a wall clock occurs twice; the later instant (standard
    time) is taken.  Wall clocks in the spring gap move forward by the gap.
    ``to_utc_timestamp`` reads the wall clock through the session zone, which
    ``configure_session`` pins to UTC."""
    local = _col(local).cast("timestamp_ntz")
    first = F.to_utc_timestamp(local.cast("timestamp"), tz)
    later = F.timestamp_add("HOUR", F.lit(1), first)
    in_fold = utc_to_local(later) == local
    return F.when(in_fold, later).otherwise(first)


def utc_to_local(instant: Column | str, tz: str = NY_TZ) -> Column:
    """Instant (TIMESTAMP) or UTC wall clock (NTZ) -> naive local wall clock.

    ``from_utc_timestamp`` (with the session zone at UTC) is several times
    faster than ``convert_timezone`` on the same rows."""
    return F.from_utc_timestamp(_col(instant).cast("timestamp"), tz).cast("timestamp_ntz")


def seconds_between(start: Column | str, end: Column | str) -> Column:
    """Number of second boundaries crossed from start to end (00:00:00.9 to
    00:00:01.1 is 1), not the truncated elapsed time."""
    return F.unix_seconds(_col(end).cast("timestamp")) - F.unix_seconds(_col(start).cast("timestamp"))


def derive_duration(raw_text: Column | str, started: Column | str, ended: Column | str) -> Column:
    """Trip seconds: the cleaned duration text when present (NULL if it does not
    parse: there is no fallback), otherwise the boundary count between the times."""
    raw_text, started, ended = _col(raw_text), _col(started), _col(ended)
    return (
        F.when(raw_text.isNotNull(), safe_bigint(raw_text))
        .when(started.isNotNull() & ended.isNotNull(), seconds_between(started, ended))
        .otherwise(F.lit(None).cast("bigint"))
    )


def member_from_usertype(usertype: Column | str) -> Column:
    """Legacy user types: subscriber -> member, customer -> casual, others lower-cased."""
    lowered = F.lower(_col(usertype))
    return (
        F.when(lowered == "subscriber", F.lit("member"))
        .when(lowered == "customer", F.lit("casual"))
        .otherwise(lowered)
    )


def normalize_station_id(c: Column | str, strict: bool = False) -> Column:
    """Collapse format variants of a numeric station id ('5980.10' -> '5980.1').

    The default trims trailing zeros and then dots from any numeric-looking id,
    so integers lose zeros too ('100' -> '1', '0' -> ''), exactly as the
    original query does.  ``strict=True`` only touches ids with a fraction."""
    c = _col(c)
    pattern = DOTTED_STATION_ID if strict else NUMERIC_STATION_ID
    trimmed = F.rtrim(F.rtrim(c, F.lit("0")), F.lit("."))
    return F.when(c.rlike(pattern), trimmed).otherwise(c)


def rider_proxy_key(
    member_casual: Column | str,
    rideable_type: Column | str,
    start_station_id: Column | str,
    end_station_id: Column | str,
) -> Column:
    """The text the rider proxy hashes: four parts joined by '|', NULL -> 'unknown'."""
    parts = [F.coalesce(_col(p), F.lit(UNKNOWN)) for p in (member_casual, rideable_type, start_station_id, end_station_id)]
    return F.concat_ws("|", *parts)


def rider_proxy_id(
    member_casual: Column | str,
    rideable_type: Column | str,
    start_station_id: Column | str,
    end_station_id: Column | str,
) -> Column:
    """md5 hex of the proxy key (no persistent rider id exists in the data)."""
    return F.md5(rider_proxy_key(member_casual, rideable_type, start_station_id, end_station_id))


def hour_label(hour: Column | str) -> Column:
    """'07:00' style label for an hour number."""
    return F.concat(F.lpad(_col(hour).cast("string"), 2, "0"), F.lit(":00"))


def rounded_ratio(numerator: Column | str, denominator: Column | str, places: int) -> Column:
    """numerator / denominator rounded half up to ``places`` decimals, exactly.

    Works on DECIMAL(38,0) integers so the rounding sees the true quotient (a
    DOUBLE average rounds its binary value).  Inputs must be non-negative
    integers with a positive denominator; the result is DOUBLE."""
    scale = 10**places
    num = _col(numerator).cast("decimal(38,0)") * F.lit(2 * scale) + _col(denominator).cast("decimal(38,0)")
    den = _col(denominator).cast("decimal(38,0)") * F.lit(2)
    quotient = (num - F.pmod(num, den)) / den
    return (quotient.cast("bigint") / F.lit(scale)).cast("double")
