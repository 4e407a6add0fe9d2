"""Event-time text, windows and lateness as column expressions on epoch micros."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sightline.schemas import WINDOW_US

_SECOND = 1_000_000

# What nearly every record looks like; anything else takes the general path.
_COMMON = r"^(?!0000)\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(?:\.\d{1,6})?Z\z"

# White space as the general text strip understands it.
_SPACE = r"[\s\x0B\x1C-\x1F\x85\xA0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000]+"
_EDGES = rf"\A{_SPACE}|{_SPACE}\z"

# ISO-8601 dates: extended or basic, calendar or week; a week date may leave the
# day out. The time follows after any one character that is not a digit, or any
# character at all after a calendar date. One stray character may precede the
# offset, unless it follows a fraction of fewer than six digits.
_CALENDAR = r"(?:(\d{4})-(\d\d)-(\d\d)|(\d{4})(\d\d)(\d\d))"
_WEEK = r"(?:(\d{4})-W(\d\d)(?:-(\d)(?!\d))?|(\d{4})W(\d\d)(\d)?(?!\d))"
_FRACTION = r"(?:[.,](\d+))?"
_CLOCK = rf"(?:(\d\d)(?::(\d\d)(?::(\d\d))?)?{_FRACTION}|(\d\d)(\d\d)(\d\d)?{_FRACTION})"
_STRAY = r"(?:(?<!\d[.,]\d{1,5})[^\dZ+-])?"
_ISO = rf"(?s)\A(?:{_CALENDAR}|{_WEEK})(?:.{_CLOCK}(?:{_STRAY}([+-]){_CLOCK})?)?\z"

# Rewrites a match as fields: calendar year, month, day; week year, week, day;
# hour, minute, second, fraction; offset sign, hour, minute, second, fraction.
_FIELDS = (
    "$1$4|$2$5|$3$6|$7$10|$8$11|$9$12|$13$17|$14$18|$15$19|$16$20"
    "|$21|$22$26|$23$27|$24$28|$25$29"
)




def _let(name: str, value: str, body: str) -> str:
    """SQL for ``body`` with ``name`` bound to ``value``, which is computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _number(group: int, default: int = 0) -> str:
    return f"coalesce(try_cast(f[{group}] AS INT), {default})"


def _fraction(group: int) -> str:
    return f"CAST(rpad(left(f[{group}], 6), 6, '0') AS INT)"


# The fields as numbers. Week 1 is the week that holds January 4th.
_NUMBERS = f"""struct(
  concat(f[0], f[3]) AS year,
  unix_date(try_cast(concat_ws('-', f[0], f[1], f[2]) AS DATE)) AS date,
  unix_date(date_trunc('week', try_cast(concat(f[3], '-01-04') AS DATE))::DATE) AS first_monday,
  {_number(4)} AS week, {_number(5, 1)} AS weekday,
  {_number(6)} AS h, {_number(7)} AS m, {_number(8)} AS s, {_fraction(9)} AS us,
  if(f[10] = '-', -1, 1) AS sign,
  {_number(11)} * 3600 + {_number(12)} * 60 + {_number(13)} AS offset, {_fraction(14)} AS offset_us)"""

# A week belongs to the year of its Thursday.
_WEEK_DATE = """CASE WHEN p.week >= 1 AND p.weekday BETWEEN 1 AND 7
  AND year(date_from_unix_date(p.first_monday + p.week * 7 - 4)) = CAST(p.year AS INT)
  THEN p.first_monday + p.week * 7 + p.weekday - 8 END"""

_MICROS = f"""CASE WHEN p.year <> '0000' AND p.h < 24 AND p.m < 60 AND p.s < 60 AND p.offset < 86400 THEN
  (coalesce(p.date, {_WEEK_DATE}) * 86400L + p.h * 3600 + p.m * 60 + p.s - p.sign * p.offset)
  * 1000000 + p.us - p.sign * p.offset_us END"""

_SPLIT = rf"split(regexp_replace(z, r'{_ISO}', '{_FIELDS}'), r'\|', -1)"
_ZONED = rf"regexp_replace(regexp_replace(<text>, r'{_EDGES}', ''), r'Z\z', '+00:00')"
_GENERAL = _let(
    "z",
    _ZONED,
    f"CASE WHEN z RLIKE r'{_ISO}' THEN " + _let("f", _SPLIT, _let("p", _NUMBERS, _MICROS)) + " END",
)
_YEARS_1_TO_9999 = f"BETWEEN {-62_135_596_800 * _SECOND} AND {253_402_300_800 * _SECOND - 1}"
_EVENT_TIME = rf"""CASE WHEN <text> RLIKE r'{_COMMON}' THEN unix_micros(try_cast(<text> AS TIMESTAMP))
  ELSE {_let("us", _GENERAL, f"CASE WHEN us {_YEARS_1_TO_9999} THEN us END")} END"""


def event_time_us(column: str) -> Column:
    """ISO-8601 text in the named column to UTC epoch micros, null when it does not parse.

    One trailing ``Z`` means UTC, and so does a missing offset. Text in the common
    form is cast; only other text goes through the general grammar.
    """
    return F.expr(_EVENT_TIME.replace("<text>", column))


def iso_z(us: Column) -> Column:
    """Epoch micros as ``…Z`` text; the fraction appears only when it is non-zero."""
    ts = F.timestamp_micros(us)
    return F.when(
        us % _SECOND == 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).otherwise(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"))


def window_start_us(us: Column, width_us: int = WINDOW_US) -> Column:
    """Start of the epoch-aligned tumbling window that holds ``us``."""
    return us - F.pmod(us, F.lit(width_us))


def window_end_us(us: Column, width_us: int = WINDOW_US) -> Column:
    """End (exclusive) of the window that holds ``us``."""
    return window_start_us(us, width_us) + F.lit(width_us)


def now_z() -> Column:
    """Processing time as ISO text, for the wall-clock fields of outputs."""
    return iso_z(F.unix_micros(F.current_timestamp()))
