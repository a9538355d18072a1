"""Column functions that turn dirty text into typed values; bad text gives NULL.

None of them raises in ANSI mode, depends on the session time zone or leaves the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.strip() removes.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

# Texts read as true and false.
TRUE_TEXTS = ("1", "true", "y", "yes")
FALSE_TEXTS = ("0", "false", "n", "no")

# How English month names begin.
MONTH_NAMES = ("JAN", "FEB", "MAR", "APR", "MAY", "JUN", "JUL", "AUG", "SEP", "OCT", "NOV", "DEC")

_CLOCK = r"\d{1,2}:\d{1,2}(?::\d{1,2}(?:\.\d{1,9})?)?"
ISO_SHAPE = rf"^\s*\d{{4}}-\d{{1,2}}-\d{{1,2}}(?:[ T]{_CLOCK})?\s*$"
MONTH_FIRST_SHAPE = rf"^\s*(\d{{1,2}})/(\d{{1,2}})/(\d{{4}})((?: {_CLOCK})?)\s*$"


def without_null_tokens(text: Column, tokens: Iterable[str]) -> Column:
    return F.when(~text.isin(*dict.fromkeys(tokens)), text)


def strip_text(text: Column) -> Column:
    """Trimmed text, NULL when nothing is left."""
    return F.nullif(F.btrim(text, F.lit(WHITESPACE)), F.lit(""))


def parse_timestamp(text: Column, formats: Iterable[tuple[str, str]] = ()) -> Column:
    """Timestamp without zone from ISO or month-first text, or from other shapes.

    ``formats`` are tried in order on texts of neither shape: a pattern for the date and its
    replacement in the form year-month-day. There the month may be an English
    name, the time may be on a 12-hour clock, and after a zone (Z or an offset) the time is in UTC.

    The shape is tested because a bare cast would also take partial dates such as ``2020``.
    """
    turned = F.regexp_replace(text, MONTH_FIRST_SHAPE, "$3-$1-$2$4")
    year_first = F.when(F.contains(text, F.lit("/")), turned).otherwise(text)
    plain = F.regexp_extract(year_first, ISO_SHAPE, 0).try_cast("timestamp_ntz")
    formats = list(formats)
    # Texts without a digit are no dates; only the rest is worth the longer way.
    return F.coalesce(plain, F.when(text.rlike(r"\d"), _parse_other(text, formats))) if formats else plain


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _parse_other(text: Column, formats: list[tuple[str, str]]) -> Column:
    """The text is rewritten step by step; a date that was read starts with ``=``, so no later format takes it.

    What a step looks at more than once is bound, and the rarer steps run only on the texts that need them: on long tables
    each pattern counts.
    """
    names = "|".join(MONTH_NAMES)
    shape = rf"^=(\d{{4}}-\d{{1,2}}-\d{{1,2}})(?:[ T]+({_CLOCK})\s*([AP]M)?\s*(Z|[+-]\d\d:?\d\d)?)?$"

    def numbered(word: Column) -> Column:
        turned = word
        for number, name in enumerate(MONTH_NAMES, start=1):
            turned = F.regexp_replace(turned, rf"\b{name}[A-Z]*", f"M{number}")
        return F.when(word.rlike(rf"\b(?:{names})"), turned).otherwise(word)

    def shaped(word: Column) -> Column:
        for pattern, replacement in formats:
            word = F.regexp_replace(word, rf"^{pattern}(?=$|[ T])", f"={replacement}")
        word = F.regexp_replace(word, r"^(=[\d-]+)T(\d\d)(\d\d)(\d\d)?(?![\d:])", "$1 $2:$3:$4")
        word = F.regexp_replace(word, r":(?!\d)", "")
        # Day, clock, half and zone of a text of the shape; any other keeps its "=" or never had one.
        return F.when(word.startswith("="), F.regexp_replace(word, shape, "$1|$2|$3|$4"))

    def read(parts: Column) -> Column:
        day, clock, half, zone = (F.get(parts, F.lit(place)) for place in range(4))
        local = F.concat_ws(" ", day, F.nullif(clock, F.lit(""))).try_cast("timestamp_ntz")
        hour = F.substring_index(clock, ":", 1).try_cast("int")
        later = hour % 12 + F.when(half == "PM", 12).otherwise(0) - hour
        hours, rest = F.substring(zone, 2, 2).try_cast("int"), F.right(zone, F.lit(2)).try_cast("int")
        ahead = F.coalesce(hours * 60 + rest, F.lit(0)) * F.when(zone.startswith("-"), -1).otherwise(1)
        shift = F.when(half == "", 0).when(hour.between(1, 12), later)
        moved = local + F.make_dt_interval(hours=shift, mins=-ahead)
        return F.when((half == "") & zone.isin("", "Z"), local).otherwise(moved)

    def of_shape(word: Column) -> Column:
        return F.when(~word.startswith("="), _bound(F.split(word, r"\|"), read))

    return _bound(_bound(_bound(F.upper(F.btrim(text, F.lit(WHITESPACE))), numbered), shaped), of_shape)


def parse_date(text: Column, formats: Iterable[tuple[str, str]] = ()) -> Column:
    """Date from the same texts; a time of day is dropped."""
    return parse_timestamp(text, formats).cast("date")


def parse_number(text: Column) -> Column:
    return text.try_cast("decimal(18,4)")


def parse_flag(text: Column) -> Column:
    word = F.lower(F.btrim(text, F.lit(WHITESPACE)))
    return F.when(word.isin(*TRUE_TEXTS), True).when(word.isin(*FALSE_TEXTS), False)


def is_junk_id(employee_id: Column, junk_ids: Iterable[str]) -> Column:
    """Missing or blank, known to be junk, or one digit repeated four times or more.

    One pattern for all, so that the column is looked at once in a filter.
    """
    known = "".join(f"{re.escape(junk_id)}|" for junk_id in junk_ids)
    pattern = rf"^[{WHITESPACE}]*(?:{known}(\d)\1{{3,}})?[{WHITESPACE}]*$"
    return F.coalesce(employee_id.rlike(pattern), F.lit(True))
