"""Day-first date parsing, year ranges and age at year end.

Accepted shapes (anything else is null and counted as lost):

* day first, four-digit year: ``d/M/yyyy`` or ``d-M-yyyy``
* year first: ``yyyy-MM-dd`` or ``yyyy/MM/dd``

either alone or with a time after a space or ``T``: ``H:mm``, ``H:mm:ss``,
fractions of a second, and ``a. m.``/``p. m.`` (``am``, ``PM``).  Two-digit
years stay null, and so do impossible dates (31/02) and times.

The result is a ``timestamp_ntz`` that does not depend on the session time
zone.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from formlens.functions.text import strip_ws

_TIME = r"([01]?\d|2[0-3]):[0-5]\d:[0-5]\d"
DMY_RE = r"^\d{1,2}/\d{1,2}/\d{4}( " + _TIME + ")?$"
ISO_RE = r"^\d{4}-\d{2}-\d{2}( " + _TIME + ")?$"

# Rewriting of the rarer shapes into the two above, in order: (pattern, replacement) on lower-case text.
# The same in Java and RE2, so both engines share them.
REWRITES = [
    (r"^(\d{1,2})-(\d{1,2})-(\d{4})", r"$1/$2/$3"),
    (r"^(\d{4})/(\d{2})/(\d{2})", r"$1-$2-$3"),
    (r"^([0-9/-]+)t(\d)", r"$1 $2"),
    (r"\s*([ap])\.?\s?m\.?$", r" $1m"),
    (r"^([0-9/-]+ \d{1,2}:\d{2})( [ap]m)?$", r"$1:00$2"),
]
# After those: date and time, fraction, half of the day.
FRACTION_RE = r"^([0-9/-]+ \d{1,2}:\d{2}:\d{2})[.,](\d{1,6})\d*( [ap]m)?$"
HALF_RE = r"^([0-9/-]+ )(\d{1,2})(:\d{2}:\d{2}) ([ap])m$"


def _seconds_of_day(s: Column) -> Column:
    """Seconds after midnight of the ``H:mm:ss`` part (0 when absent)."""
    parts = F.split(F.substring_index(s, " ", -1), ":")
    h, m, sec = (F.try_element_at(parts, F.lit(i)).try_cast("int") for i in (1, 2, 3))
    return F.when(s.contains(" "), h * 3600 + m * 60 + sec).otherwise(F.lit(0))


def _usual(s: Column) -> Column:
    """Timestamp of the two usual shapes, else null."""
    day = F.substring_index(s, " ", 1)
    date = (
        F.when(s.rlike(DMY_RE), F.try_to_date(day, "d/M/yyyy"))
        .when(s.rlike(ISO_RE), F.try_to_date(day, "yyyy-MM-dd"))
    )
    return F.timestamp_add("SECOND", _seconds_of_day(s), date.cast("timestamp_ntz"))


def _bind(value: Column, use) -> Column:
    """``use(value)`` with ``value`` computed once, outside the generated code of the row."""
    return F.transform(F.array(value), use)[0]


def _rarer(s: Column) -> Column:
    """Timestamp of the other shapes: rewritten to a usual one."""
    t = F.lower(s)
    for pattern, replacement in REWRITES:
        t = F.regexp_replace(t, pattern, replacement)

    def whole(t: Column) -> Column:
        """Without fraction and half of the day."""
        hour = F.regexp_extract(t, HALF_RE, 2).try_cast("int")
        of_day = F.when((hour >= 1) & (hour <= 12), hour % 12 + F.when(F.regexp_extract(t, HALF_RE, 4) == "p", 12).otherwise(0))
        clock = F.concat(F.regexp_extract(t, HALF_RE, 1), of_day.cast("string"), F.regexp_extract(t, HALF_RE, 3))
        return _bind(F.when(t.rlike(HALF_RE), clock).otherwise(t), _usual)

    def exact(t: Column) -> Column:
        micros = F.rpad(F.regexp_extract(t, FRACTION_RE, 2), 6, "0").try_cast("int")
        return F.timestamp_add("MICROSECOND", F.coalesce(micros, F.lit(0)), _bind(F.regexp_replace(t, FRACTION_RE, "$1$3"), whole))

    return _bind(t, exact)


def parse_day_first(c: Column) -> Column:
    """Text -> timestamp_ntz by the shapes above; else null.

    The shape (and the time-of-day ranges) is checked by one regex per
    format; the calendar date is validated by ``try_to_date`` (so 31/02 is
    null); the time of day is added as seconds.  The rarer shapes are only
    tried on values that the two usual ones leave null.
    """
    s = strip_ws(c.cast("string"))
    return F.coalesce(_usual(s), F.when(s.rlike(r"^\d{1,4}[-/]\d"), _rarer(s)))


def year_end(year: Column | int) -> Column:
    y = year if isinstance(year, Column) else F.lit(int(year))
    return F.make_timestamp_ntz(y, F.lit(12), F.lit(31), F.lit(0), F.lit(0), F.lit(0))


def in_year(ts: Column, year: int) -> Column:
    """``year(ts) = year`` written as a range, so it can be pushed to a scan."""
    lo = F.lit(f"{int(year):04d}-01-01 00:00:00").cast("timestamp_ntz")
    hi = F.lit(f"{int(year) + 1:04d}-01-01 00:00:00").cast("timestamp_ntz")
    return (ts >= lo) & (ts < hi)


def age_at_year_end(birth: Column, year: Column | int) -> Column:
    """Whole years of 365.25 days between birth and 31 December 00:00.

    Elapsed days are floored including the time of day; births after the
    cutoff (also later on the same day) give null.
    """
    cutoff = year_end(year)
    micros = F.timestamp_diff("MICROSECOND", birth, cutoff)
    days = F.floor(micros / F.lit(86400000000.0))
    return F.when(birth <= cutoff, F.floor(days / F.lit(365.25)).cast("double"))
