"""Free-form publication dates to UTC.

The text is rewritten to ISO with built-in string functions and cast with `try_cast`, so an
unreadable date is NULL and neither the session zone nor the JVM's locale matters. Accepted:

* ISO: `2024-01-02`, `2024-01-02T03:04`, `2024-01-02 03:04:05.678`, `2024/01/02`, `20240102T030405`
* RFC 822: `Tue, 02 Jan 2024 03:04:05`, weekday and seconds optional, two-digit years
* US long: `January 2, 2024 at 3:04 PM`, and US short: `01/02/2024 03:04:05`, `01.02.2024`
* asctime: `Tue Jan  2 03:04:05 2024`
* any of these with the clock in front: `10:36 28.9.2003`, `3:04 PM Jan 2 2024`, `10:36:28 UTC, 2024-01-02`
* a month alone, which is its first day: `Jan 2024`, `2024-01`

Short dates are month first, unless the first number can only be a day. A clock may be an hour with AM
or PM. Each comes with an optional zone: `Z`, `UTC`, `+0200`, `+02:00`, `-05`, or a zone name. No zone means UTC.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidewire.functions.basics import bind, literal_map
from tidewire.functions.text import strip

# RFC 822 zone names in minutes from UTC.
ZONE_MINUTES = {
    "EST": -300, "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480,
    "PDT": -420,
}
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec")

_WEEKDAY = r"(?:(?:mon|tue|wed|thu|fri|sat|sun)[a-z]*\.?,?\s+)?"
_MONTH = r"(jan|feb|mar|apr|may|jun|jul|aug|sep|oct|nov|dec)[a-z]*\.?"
_TIME = r"\d{1,2}:\d{2}(?::\d{2}(?:\.\d{1,6})?\d*)?"
_CLOCK = rf"(?:,?(?:\s+at)?[\st]+({_TIME}|\d{{1,2}}(?=\s*[ap]m))\s*(am|pm)?)?"
# Forms that are first put into the order of one of those below.
_REORDERED = (
    (rf"(?i)^({_TIME})\s*(am|pm)?\s*(z|utc|gmt|[+-]\d{{2}}:?\d{{2}})?,?\s+(?:on\s+)?(\S.*)$", "$4 $1 $2 $3"),
    (rf"(?i)^{_MONTH},?\s+(\d{{4}})$", "$1 1, $2"),
    (r"^(\d{4})-(0[1-9]|1[0-2])$", "$1-$2-01"),
    (rf"(?i)^{_WEEKDAY}{_MONTH}\s+(\d{{1,2}})\s+({_TIME})\s+(\d{{4}})$", "$1 $2, $4 $3"),
    (r"^(\d{4})(\d{2})(\d{2})$", "$1-$2-$3"),
    (r"(?i)^(\d{4})(\d{2})(\d{2})[t ]?(\d{2})(\d{2})(\d{2})", "$1-$2-$3 $4:$5:$6"),
    (r"(?i)^(\d{4})(\d{2})(\d{2})[t ](\d{2})(\d{2})", "$1-$2-$3 $4:$5"),
)
_ZONE = r"\s*(z|[a-z]{2,5}|(?:utc|gmt)?[+-]\d{1,2}:?(?:\d{2})?)?$"
# form -> where its year, month and day are; the clock, AM/PM and zone are groups 4 to 6.
_FORMS = (
    (r"(\d{4})[-/](\d{1,2})[-/](\d{1,2})", "$1", "$2", "$3"),
    (rf"(\d{{1,2}})[\s-]+{_MONTH},?[\s-]+(\d{{4}}|\d{{2}})", "$3", "$2", "$1"),
    (rf"{_MONTH}\s+(\d{{1,2}})(?:st|nd|rd|th)?,?\s+(\d{{4}})", "$3", "$1", "$2"),
    (r"(\d{1,2})[/.](\d{1,2})[/.](\d{4})", "$3", "$1", "$2"),
)
_MARK = "\x01"


def _parts(text: Column) -> Column:
    """[year, month, day, clock, half, zone] of a readable date; other texts give another length.

    A matching form rewrites the text to marked parts, on which the forms after it fail at once.
    """
    for pattern, ordered in _REORDERED:
        text = F.rtrim(F.regexp_replace(text, pattern, ordered))
    for form, year, month, day in _FORMS:
        pattern = f"(?i)^{_WEEKDAY}{form}{_CLOCK}{_ZONE}"
        text = F.regexp_replace(text, pattern, _MARK.join((year, month, day, "$4", "$5", "$6")))
    return F.split(text, _MARK, -1)


def _year(text: Column) -> Column:
    short = text.try_cast("int")
    return F.when(F.length(text) == 4, text).otherwise(
        (short + F.when(short < 69, 2000).otherwise(1900)).cast("string")
    )


def _month(text: Column) -> Column:
    names = literal_map({name: f"{i:02d}" for i, name in enumerate(MONTHS, 1)})
    return F.coalesce(F.try_element_at(names, F.lower(F.substring(text, 1, 3))), F.lpad(text, 2, "0"))


def _clock(clock: Column, half: Column) -> Column:
    hour = F.split_part(clock, F.lit(":"), F.lit(1)).try_cast("int")
    shifted = (
        F.when((F.lower(half) == "pm") & (hour < 12), hour + 12)
        .when((F.lower(half) == "am") & (hour == 12), F.lit(0))
        .otherwise(hour)
    )
    tail = F.when(F.contains(clock, F.lit(":")), F.substring(clock, F.instr(clock, ":"), F.length(clock))).otherwise(":00")
    return F.when(clock == "", F.lit("00:00")).otherwise(
        F.concat(F.lpad(shifted.cast("string"), 2, "0"), tail)
    )


def _offset_minutes(zone: Column, legacy_zone_names: bool) -> Column:
    sign = F.when(F.contains(zone, F.lit("-")), -1).otherwise(1)
    digits = F.regexp_replace(zone, "[^0-9]", "")
    padded = F.when(F.length(digits) <= 2, F.concat(F.lpad(digits, 2, "0"), F.lit("00"))).otherwise(
        F.lpad(digits, 4, "0")
    )
    numeric = sign * (
        F.substring(padded, 1, 2).try_cast("int") * 60 + F.substring(padded, 3, 2).try_cast("int")
    )
    named = F.lit(0) if legacy_zone_names else F.coalesce(
        F.try_element_at(literal_map(ZONE_MINUTES), F.upper(zone)), F.lit(0)
    )
    return F.when(zone.rlike("[0-9]"), numeric).otherwise(named)


def parse_date(text: Column, legacy_zone_names: bool = False) -> Column:
    """TIMESTAMP_NTZ in UTC, or NULL. `legacy_zone_names` reads `EST` and the like as UTC."""
    def read(parts: Column) -> Column:
        year, month, day, clock, half, zone = (F.get(parts, F.lit(n)) for n in range(6))
        swapped = (month.try_cast("int") > 12) & (day.try_cast("int") <= 12)
        month, day = F.when(swapped, day).otherwise(month), F.when(swapped, month).otherwise(day)
        date = F.concat_ws("-", _year(year), _month(month), F.lpad(day, 2, "0"))
        local = F.concat(date, F.lit(" "), _clock(clock, half)).try_cast("timestamp_ntz")
        offset = F.make_dt_interval(F.lit(0), F.lit(0), _offset_minutes(zone, legacy_zone_names))
        return F.when(F.size(parts) == 6, F.when(zone == "", local).otherwise(local - offset))

    return bind(_parts(strip(text)), read)
