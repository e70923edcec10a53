"""Date text to `yyyy-MM-dd`: one layout per column, taken from its first value."""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

# What the parts of a date look like. y year, t two digits of a year, m month (l: one that cannot be a
# day), d day, M D with two digits, b short and B long month name.
NAMES = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November",
         "December")
SHAPES = {
    "y": r"\d{4}", "t": r"\d{2}", "m": r"\d{1,2}", "l": r"(?:0?[1-9]|1[0-2])", "d": r"\d{1,2}", "M": r"\d{2}",
    "D": r"\d{2}", "b": f"(?i:{'|'.join(n[:3] for n in NAMES)})", "B": f"(?i:{'|'.join(NAMES)})",
}
PARTS = {"t": "y", "l": "m", "M": "m", "b": "m", "B": "m", "D": "d"}  # which part of a date a letter is
# Date layouts, in the order in which the first value is held against them.
DATE_LAYOUTS = (
    "{y}-{m}-{d}", "{y}/{m}/{d}", "{y}.{m}.{d}", "{y}-{b}-{d}", "{y}{M}{D}", "{y}-{m}",
    "{l}-{d}-{y}", "{l}/{d}/{y}", "{l}.{d}.{y}", "{d}-{m}-{y}", "{d}/{m}/{y}", "{d}.{m}.{y}",
    "{b} {d} {y}", "{b} {d}, {y}", "{B} {d} {y}", "{B} {d}, {y}",
    "{d}-{b}-{y}", "{d} {b} {y}", "{d}/{b}/{y}", "{d} {B} {y}",
    "{y}", "{b} {y}", "{B} {y}", "{m}/{y}", "{d}-{b}-{t}",
)
WEEKDAY = "(?i:(?:Mon|Tues?|Wed(?:nes)?|Thu(?:rs)?|Fri|Sat(?:ur)?|Sun)(?:day)?),? "
# Times that may follow a date.
HOUR, HOUR_12, SIXTY = r"(?:[01]?\d|2[0-3])", r"(?:0?[1-9]|1[0-2])", r"[0-5]?\d"
TIME_LAYOUTS = (
    "",
    f" {HOUR}",
    f" {HOUR}:{SIXTY}",
    f" {HOUR}:{SIXTY}:{SIXTY}",
    rf" {HOUR}:{SIXTY}:{SIXTY}\.\d{{1,6}}",
    f" {HOUR_12}:{SIXTY}:{SIXTY} [APap][Mm]",
    f"T{HOUR}:{SIXTY}",
    f"T{HOUR}:{SIXTY}:{SIXTY}",
    rf"T{HOUR}:{SIXTY}:{SIXTY}\.\d{{1,6}}",
    r"[T ](?:[01]\d|2[0-3])[0-5]\d[0-5]\d",
)
# Layouts tried per value, in this order, when the first value has none of those above.
ANY_TIME = rf"(?:[T ]{HOUR}:{SIXTY}(?::{SIXTY}(?:\.\d+)?)?(?: [APap][Mm])?|[T ]\d{{6}})?"
FALLBACK_LAYOUTS = (
    "{y}-{m}-{d}", "{y}/{m}/{d}", "{y}{M}{D}", "{m}/{d}/{y}", "{d}/{m}/{y}", "{m}-{d}-{y}", "{d}-{m}-{y}",
    "{m}/{d}/{t}", "{d}/{m}/{t}", "{b} {d} {y}", "{b} {d}, {y}", "{B} {d}, {y}", "{d} {b} {y}", "{d} {B} {y}",
    "{d}-{b}-{y}", "{d}/{b}/{y}", "{d}-{b}-{t}", "{y}", "{y}-{m}", "{b} {y}", "{B} {y}", "{m}/{y}",
)
# The calendar days a 64-bit nanosecond timestamp covers in full.
EARLIEST, LATEST = "1677-09-22", "2262-04-11"
YEARS_INSIDE = r"(?:16(?:7[89]|[89]\d)|1[7-9]\d\d|2[01]\d\d|22[0-5]\d|226[01])"  # the years of which all days are covered
OFFSET = r"(?: ?(?:Z|UTC|GMT)|[+-]\d{2}(?::?\d{2})?)"
NANOSECONDS_PER_DAY = 86_400_000_000_000


class Layout(NamedTuple):
    date: str
    time_shape: str
    has_offset: bool


def _shape(date: str, year: str | None = None) -> str:
    """The pattern of a date layout; `year` in place of that of any year."""
    return re.sub(r"\{(\w)\}", lambda part: year if year and part.group(1) == "y" else SHAPES[part.group(1)],
                  date.replace(".", r"\."))


def guess_layout(value: str) -> Layout | None:
    """The layout of one date text, or None if it has none of the known ones."""
    year = re.search(r"\d{4}", value)
    if year and not 1678 <= int(year.group()) <= 2261:
        return None
    for date in DATE_LAYOUTS:
        for time_shape in TIME_LAYOUTS:
            if time_shape.startswith("[T ]") and date != "{y}{M}{D}" or time_shape and "{d}" not in date and "{D}" not in date:
                continue
            zone = f"(?P<zone>{OFFSET})?" if ":" in time_shape or time_shape[:1] == "[" else "(?P<zone>$)?"
            found = re.fullmatch(f"(?:{WEEKDAY})?{_shape(date)}{time_shape}{zone}", value)
            if found:
                return Layout(date, time_shape, bool(found["zone"]))
    return None


def utc_offset(c: Column) -> Column:
    """The `+hhmm` offset a timestamp text ends in, else null. `Z`, `UTC` and `GMT` count as `+0000`."""
    mark = F.ltrim(F.regexp_extract(c, rf":\d{{1,2}}(?:\.\d+)?({OFFSET})$", 1))
    digits = F.rpad(F.replace(mark, F.lit(":"), F.lit("")), 5, "0")
    return F.when(mark.isin("Z", "UTC", "GMT"), "+0000").when(mark != "", digits)


def _parts(c: Column, date: str, rest: str) -> Column:
    """Year, month and day of a text of this layout, cut out by place and joined by hyphens."""
    letters = re.findall(r"\{(\w)\}", date)
    if date == "{y}{M}{D}":
        return F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    mark = re.sub(r"\{\w\}|,", "", date)[:1]

    def last(cell: Column) -> Column:
        """Without the time that may stand behind, or, where any time may, an offset alone."""
        if rest.startswith(ANY_TIME):
            return F.regexp_extract(cell, r"^[\d-]*\d", 0)
        return F.substring_index(F.substring_index(cell, " ", 1), "T", 1)

    if date == "{y}-{m}-{d}" and not rest.startswith(ANY_TIME):
        return last(c)
    cells = [F.substring_index(F.substring_index(c, mark, k), mark, -1) if mark else c for k in range(1, len(letters) + 1)]
    cells[-1] = last(cells[-1])
    parts = {PARTS.get(x, x): _number(cell, x) for x, cell in zip(letters, cells)}
    return F.concat_ws("-", *[parts.get(x, F.lit("1")) for x in "ymd"])


def _day_text(c: Column, date: str, rest: str) -> Column:
    """The day of a text of this layout as `yyyy-MM-dd`, else null: one match, then its parts are cut out by place.

    Each expression stands once for the common case, as what is repeated inside of conditions is evaluated again.
    """
    plain = c.rlike(rf"(?s)^{_shape(date, YEARS_INSIDE)}{rest}\z")
    day = _parts(c, date, rest).try_cast("date").cast("string")
    # a weekday, which ends with the first space, or a year of which not all days count
    other = c.rlike(rf"(?s)^(?:{WEEKDAY})?{_shape(date)}{rest}\z")
    bare = F.when(c.rlike(f"^{WEEKDAY}"), F.substring(c, F.instr(c, F.lit(" ")) + 1, F.length(c))).otherwise(c)
    odd = _parts(bare, date, rest).try_cast("date")
    counted = odd.between(F.lit(EARLIEST).cast("date"), F.lit(LATEST).cast("date"))
    return F.when(plain, day).when(other, F.when(counted, odd.cast("string")))


def _number(cell: Column, letter: str) -> Column:
    """One part of a date as digits."""
    if letter == "y":
        return F.substring(cell, 1, 4)
    if letter == "t":
        return F.concat(F.when(cell <= "68", "20").otherwise("19"), cell)
    if letter in "bB":
        place = F.instr(F.lit("".join(n[:3].lower() for n in NAMES)), F.lower(F.substring(cell, 1, 3)))
        return ((place + 2) / 3).cast("int").cast("string")
    return F.replace(cell, F.lit(","), F.lit(""))


def date_text(c: Column, layout: Layout | None) -> Column:
    """Values of that layout as `yyyy-MM-dd`, all others null. Offsets keep the date as written.

    Parts of a date are cut out by place where a pattern matches, and put in order, so that a plain cast reads them:
    parsing by a formatter is several times slower, and a failed parse costs a hundred times a failed match.
    """
    if layout is None:
        text = F.trim(c)
        rest = {date: f"{ANY_TIME}{OFFSET}?" if "d}" in date.lower() else "" for date in FALLBACK_LAYOUTS}
        return F.coalesce(*[_day_text(text, date, rest[date]) for date in FALLBACK_LAYOUTS])
    return _day_text(c, layout.date, layout.time_shape + (OFFSET if layout.has_offset else ""))


def epoch_date_text(c: Column) -> Column:
    """A number read as nanoseconds since 1970, as `yyyy-MM-dd`."""
    ns = c.try_cast("bigint")
    day = F.expr(f"{NANOSECONDS_PER_DAY}L")
    days = ((ns - F.pmod(ns, day)) / day).cast("int")
    return F.date_add(F.lit("1970-01-01").cast("date"), days).cast("string")
