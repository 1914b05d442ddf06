"""Column -> Column building blocks. All of them stay inside whole-stage codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tenure.config import FIRST_DAY, LAST_DAY
from tenure.schemas import PRICE

# The characters that count as padding (every Unicode white space character
# and the four ASCII separators).
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

FAR_FUTURE = "9999-12-31"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Text of printable ASCII without blanks: nothing to strip.
_COMPACT = "^[\\x21-\\x7e]+\\z"  # $ would also match before a last line break


def strip(c: Column | str) -> Column:
    """Remove padding on both sides; plain ``trim`` would leave tabs.

    Most ids, dates and prices are compact and skip the costlier trim with a character set.
    """
    c = _col(c)
    return F.when(c.rlike(_COMPACT), c).otherwise(F.trim(c, F.lit(WHITESPACE)))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def is_blank(c: Column | str) -> Column:
    """Null or empty; true or false, never null."""
    return F.coalesce(_col(c) == "", F.lit(True))


def correct(c: Column | str, corrections: Iterable[tuple[str, str]]) -> Column:
    """Replace values that match a key exactly, keep all others."""
    c = _col(c)
    pairs = list(corrections)
    if not pairs:
        return c
    out = F.when(c == pairs[0][0], pairs[0][1])
    for wrong, right in pairs[1:]:
        out = out.when(c == wrong, right)
    return out.otherwise(c)


# The patterns and formats below are fixed values: they define which texts are dates.
ISO_FORMAT = "yyyy-MM-dd"
_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_PADDING = "[" + "".join(f"\\x{{{ord(ch):x}}}" for ch in WHITESPACE) + "]*"
_COMPACT_DAY = f"^{_DAY}\\z"
_PADDED_DAY = f"^{_PADDING}({_DAY}){_PADDING}\\z"


def _iso_day(c: Column) -> Column:
    """The pattern is needed because a bare cast would accept ``2024`` as a date."""
    padded = F.regexp_extract(c, _PADDED_DAY, 1)
    return F.when(c.rlike(_COMPACT_DAY), c.try_cast("date")).otherwise(padded.try_cast("date"))


def parse_date(c: Column | str, formats: Iterable[str]) -> Column:
    """First format that fits the stripped text with a day in range, else null (never raises).

    ISO days are matched and cast, which is about three times as fast as parsing with a
    format, and a bad text costs no Java exception.
    """
    c = _col(c)
    parsers = [in_range(_iso_day(c) if fmt == ISO_FORMAT else F.try_to_date(strip(c), fmt)) for fmt in formats]
    return parsers[0] if len(parsers) == 1 else F.coalesce(*parsers)


def in_range(day: Column) -> Column:
    """The day, null outside the days that count as dates; so the far future is free as a mark."""
    return F.when(day.between(F.lit(FIRST_DAY).cast("date"), F.lit(LAST_DAY).cast("date")), day)


def _is_number(text: str) -> bool:
    try:
        float(text)
    except ValueError:
        return False
    return True


def parse_price(c: Column | str, corrections: Iterable[tuple[str, str]] = ()) -> Column:
    """Decimal of the stripped, corrected text, or null (see also price_out_of_range).

    The decimal cast rejects ``30d``, ``nan`` and ``inf`` by itself and ignores blanks, so
    most values need the cast only; the rest is stripped and corrected.
    """
    c = _col(c)
    pairs = list(corrections)
    slow = correct(strip(c), pairs).try_cast(PRICE)
    if any(_is_number(wrong) for wrong, _ in pairs):
        return slow
    return F.coalesce(c.try_cast(PRICE), slow)


_NUMBER = "^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?\\z"


def price_out_of_range(c: Column | str, corrections: Iterable[tuple[str, str]] = ()) -> Column:
    """A number too large for the price type: not wrong, but nothing to compute with."""
    text = correct(strip(_col(c)), list(corrections))
    return F.coalesce(text.rlike(_NUMBER) & text.try_cast(PRICE).isNull(), F.lit(False))


def stop_at_price(c: Column | str) -> Column:
    """Of the price type, but raises: a price that is too large must not vanish from a sum."""
    return F.raise_error(F.format_string("price_out_of_range: monthly_price '%s' is too large", _col(c))).cast(PRICE)


def country_code(c: Column | str) -> Column:
    return blank_to_null(F.upper(strip(c)))


def plan_name(c: Column | str) -> Column:
    return F.lower(strip(c))


def month_key(d: Column | str) -> Column:
    return F.date_format(_col(d), "yyyy-MM")


def month_start(d: Column | str) -> Column:
    return F.trunc(_col(d), "MM")


def month_end(d: Column | str) -> Column:
    return F.last_day(_col(d))


def months_later(d: Column | str, months: int) -> Column:
    """Calendar months ahead, the day clamped to the end of the target month."""
    return F.add_months(_col(d), months)


def open_end(d: Column | str) -> Column:
    """The end date, an open end standing after every real date."""
    return F.coalesce(_col(d), F.lit(FAR_FUTURE).cast("date"))


def shown_end(d: Column | str) -> Column:
    """The end date as text, an open end as ``active``."""
    return F.coalesce(_col(d).cast("string"), F.lit("active"))


def is_active(end: Column | str) -> Column:
    return _col(end).isNull()


def money(c: Column) -> Column:
    return F.round(c, 2).cast("double")


def rate(part: Column, whole: Column, places: int = 4) -> Column:
    return F.round(F.try_divide(part.cast("double"), whole.cast("double")), places)
