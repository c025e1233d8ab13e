"""Scalar functions on recognised text; all are plain Columns.

Patterns use (?U): digits, spaces and letters are Unicode's, not ASCII's.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACE = r"[\s\x1c-\x1f]"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Without Unicode white space at both ends."""
    return F.regexp_replace(text, f"(?U)^{_SPACE}+|{_SPACE}+$", "")


def has(text: Column, keyword: str) -> Column:
    """The text holds the keyword, whatever its case; null holds nothing."""
    return F.coalesce(F.lower(text).contains(keyword.lower()), F.lit(False))


def has_any(text: Column, keywords: list[str]) -> Column:
    out = F.lit(False)
    for k in keywords:
        out = out | has(text, k)
    return out


def matches(text: Column, pattern: str) -> Column:
    return F.coalesce(text.rlike("(?U)" + pattern), F.lit(False))


def group(text: Column, pattern: str, index: int = 1) -> Column:
    """A group of the first match, or null."""
    return F.when(matches(text, pattern), F.regexp_extract(text, "(?U)" + pattern, index))


def first_integer(text: Column) -> Column:
    return group(text, r"(\d+)")


def integers(text: Column) -> Column:
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(r"(?U)(\d+)"), 1)


def words(text: Column) -> Column:
    """Runs of non-space, as an array."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), f"(?U){_SPACE}+"), lambda w: w != "")


def pad2(text: Column) -> Column:
    """At least two characters, zeros to the left; longer texts stay."""
    return F.when(F.char_length(text) < 2, F.lpad(text, 2, "0")).otherwise(text)


def repair_slash(text: Column) -> Column:
    """A digit, one of I l | ∣, a digit: the middle is a slash. Twice, as matches may share a digit."""
    once = F.regexp_replace(text, r"([0-9])[Il|∣]([0-9])", "$1/$2")
    return F.regexp_replace(once, r"([0-9])[Il|∣]([0-9])", "$1/$2")


# Letters, Latin and Cyrillic, and the digits that recognition takes them for.
DIGIT_SHAPES = ("OSZgЗОБ", "0529308")


def repair_digits(text: Column) -> Column:
    """Where a digit occurs, letters of the shape of digits are digits."""
    return F.when(matches(text, r"\d"), F.translate(text, *DIGIT_SHAPES)).otherwise(text)


def blank_number(text: Column, slashes: bool = True, digits: bool = True) -> Column:
    """(value, corrected): a number of the form ddd/dd after repairs, zeros added; null if it has no such form.

    Only repairs count as corrections, added zeros do not.
    """
    def form(fixed: Column) -> Column:
        left, right = (F.regexp_extract(fixed, r"(?U)^(\d{1,3})/(\d{1,2})$", i) for i in (1, 2))
        value = F.concat(F.lpad(left, 3, "0"), F.lit("/"), F.lpad(right, 2, "0"))
        return F.when(matches(fixed, r"^\d{1,3}/\d{1,2}$"), F.struct(value.alias("value"), (fixed != text).alias("corrected")))

    slashed = repair_slash(text) if slashes else text
    return let(slashed, lambda s: let(repair_digits(s) if digits else s, form))


def insert_slash(text: Column) -> Column:
    """Three digits and one or two more, without a slash: the slash goes between them."""
    return F.when(matches(text, r"^\d{3}\d{1,2}$"), F.regexp_replace(text, r"(?U)^(\d{3})(\d{1,2})$", "$1/$2")).otherwise(text)


def date_of_parts(parts: Column) -> Column:
    """Day, month and year of three numbers or more as DD/MM/YYYY; null of fewer. A year may be two numbers."""
    def made(p: Column) -> Column:
        n, third = F.size(p), F.get(p, F.lit(2))
        joined = F.concat(third, F.get(p, F.lit(3)))
        year = F.when(F.char_length(third) == 4, third).when(n >= 4, joined).otherwise(third)
        full = let(year, lambda y: F.when(F.char_length(y) == 2, F.concat(F.lit("20"), y)).otherwise(y))
        return F.when(n >= 3, F.concat_ws("/", pad2(F.get(p, F.lit(0))), pad2(F.get(p, F.lit(1))), full))

    return let(parts, made)


def date_of_cells(parts: Column, default_year: str = "2025") -> Column:
    """The same of two numbers or more: a missing year is default_year; null where the ranges are not those of a date."""
    def made(p: Column) -> Column:
        n, third = F.size(p), F.get(p, F.lit(2))
        length = F.char_length(third)
        odd = F.when(n >= 4, F.concat(third, F.get(p, F.lit(3)))).when(length >= 2, F.concat(F.lit("20"), F.substring(third, 1, 2))).otherwise(default_year)
        year = F.when(n < 3, default_year).when(length == 2, F.concat(F.lit("20"), third)).when(length == 4, third).otherwise(odd)
        date = F.concat_ws("/", pad2(F.get(p, F.lit(0))), pad2(F.get(p, F.lit(1))), year)
        return let(date, lambda d: F.when((n >= 2) & valid_slash_date(d), d))

    return let(parts, made)


def valid_slash_date(text: Column) -> Column:
    """DD/MM/YYYY with day 1-31, month 1-12, year 2000-2100; no calendar."""
    part = lambda i: F.regexp_extract(text, r"^(\d{2})/(\d{2})/(\d{4})$", i).try_cast("int")
    ranges = part(1).between(1, 31) & part(2).between(1, 12) & part(3).between(2000, 2100)
    return F.coalesce(text.rlike(r"^\d{2}/\d{2}/\d{4}$") & ranges, F.lit(False))


def check_dotted_date(text: Column) -> Column:
    """(valid, message) for DD.MM.YYYY by the calendar."""
    part = lambda i: F.regexp_extract(text, r"^(\d{1,2})\.(\d{1,2})\.(\d{4})$", i).try_cast("int")
    real = F.to_date(F.try_to_timestamp(F.concat_ws("-", F.lpad(part(3).cast("string"), 4, "0"), part(2), part(1)), F.lit("yyyy-M-d"))).isNotNull()
    message = (
        F.when(~F.coalesce(text.rlike(r"^\d{1,2}\.\d{1,2}\.\d{4}$"), F.lit(False)), "Date must be in DD.MM.YYYY format")
        .when(~part(2).between(1, 12), F.concat(F.lit("Invalid month: "), part(2)))
        .when(~part(1).between(1, 31), F.concat(F.lit("Invalid day: "), part(1)))
        .when(~real, "Invalid date: day is out of range for month")
    )
    return F.struct(message.isNull().alias("valid"), message.alias("message"))


def check_number(text: Column, decimals: bool = True) -> Column:
    """(valid, message) for digits, with a fraction where decimals are allowed."""
    ok = matches(strip(text), r"^\d+\.?\d*$" if decimals else r"^\d+$")
    return F.struct(ok.alias("valid"), F.when(~ok, "Must be a valid number" if decimals else "Must be a valid integer").alias("message"))


def next_file_name(name: Column, drop: str, suffix: str) -> Column:
    """File name of the next stage: the stem without ``drop`` at its end, then suffix."""
    stem = F.regexp_replace(name, r"\.[^.]*$", "")
    return F.concat(F.regexp_replace(stem, f"{drop}$", ""), F.lit(suffix))


def looks_like_name(text: Column) -> Column:
    """One to four words, one of them all letters; not digits alone, two characters at least."""
    w = words(text)
    return (F.char_length(text) >= 2) & ~matches(text, r"^\d+$") & F.size(w).between(1, 4) & F.exists(w, lambda x: x.rlike(r"^\p{L}+$"))


def looks_signed(text: Column) -> Column:
    """Two to four words, one of them beginning in upper case."""
    w = words(text)
    return F.size(w).between(2, 4) & F.exists(w, lambda x: x.rlike(r"^\p{Lu}"))


def capitalised(text: Column) -> Column:
    return F.exists(words(text), lambda x: x.rlike(r"^\p{Lu}"))
