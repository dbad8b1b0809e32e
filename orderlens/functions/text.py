"""Column to column cleaning rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from orderlens.constants import CITY_ALIASES, NA_TOKENS


def na_to_null(c: Column) -> Column:
    return F.when(~c.isin(*NA_TOKENS), c)


def clean_text(c: Column) -> Column:
    """Trim, collapse runs of white space, and turn blank or 'nan'-like text into NULL."""
    s = F.trim(F.regexp_replace(c, r"(?U)\s+", " "))
    return F.when(~s.isin("", "nan", "NaN", "None"), s)


#: all characters that are white space to Unicode, as in (?U)\s
WHITE = "".join(map(chr, (*range(0x9, 0xE), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))


def strip(c: Column) -> Column:
    """Without white space of any kind at both ends. Numbers and dates are stripped several times a row: no pattern is matched."""
    return F.btrim(c, F.lit(WHITE))


def to_number(c: Column) -> Column:
    """A decimal number, with an exponent if need be; any other text is NULL (a cast alone would take type suffixes)."""
    s = strip(c)
    return F.when(s.rlike(r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"), s.try_cast("double"))


def title_case(c: Column) -> Column:
    """Each run of letters with a capital first letter."""
    runs = F.regexp_extract_all(c, F.lit(r"(\p{L}+|[^\p{L}]+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.lower(w.substr(F.lit(2), F.length(w))))), "")


def upper_code(c: Column) -> Column:
    return F.upper(clean_text(c))


def truncate_time(c: Column, length: int) -> Column:
    return F.substring(c, 1, length)


def digits_or_null(c: Column, n: int, strip_sign: bool = False) -> Column:
    """Text of exactly n digits, after a trailing '.0' (and a sign) is cut off."""
    s = F.regexp_replace(strip(c), r"\.0$", "")
    if strip_sign:
        s = F.regexp_replace(s, r"^-+", "")
    return F.when(s.rlike(rf"^\d{{{n}}}$"), s)


def city_alias(key: Column) -> Column:
    pairs = [F.lit(x) for kv in CITY_ALIASES.items() for x in kv]
    return F.create_map(*pairs)[key]


def shape_of(c: Column) -> Column:
    """9 for a digit, a for a letter: the form of a value."""
    return F.regexp_replace(F.regexp_replace(c, r"\d", "9"), "[A-Za-z]", "a")
