"""Lenient parsing of text columns: a bad value turns into NULL, never an error."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Spellings of "no value" in table cells, compared in upper case.
MISSING_TOKENS = ["", "-", "–", "NA", "N/A"]

_DIGITS = r"\d+(?:_\d+)*"
_NUMBER = rf"^[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:[eE][+-]?{_DIGITS})?|(?i:inf|infinity))$"
_WHITE_SPACE = "".join(chr(point) for point in range(0x3001) if chr(point).isspace())
_CLOCK = r"^\d{4}-\d.*\d:\d"
_ZONE = r".*(?:[zZ]|[+-]\d{2}(?::?\d{2})?)$"


def col_of(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def bind(value: Column | str, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once however often the body names it.

    For costly values only: the lambda keeps its projection out of whole-stage code.
    """
    return F.get(F.transform(F.array(col_of(value)), body), F.lit(0))


def strip(value: Column | str) -> Column:
    """Trim any Unicode white space, where SQL ``trim`` only knows the blank."""
    return F.btrim(col_of(value), F.lit(_WHITE_SPACE))


def blank_to_null(value: Column | str) -> Column:
    return F.nullif(col_of(value), F.lit(""))


def default_if_blank(value: Column | str, default: str) -> Column:
    return F.coalesce(blank_to_null(value), F.lit(default))


def parse_year(value: Column | str) -> Column:
    """Digits-only text to int; anything else, or a number beyond int, to NULL."""
    text = col_of(value)
    return F.when(text.rlike("^[0-9]+$"), text.try_cast("int"))


def nan_to_null(value: Column | str) -> Column:
    number = col_of(value)
    return F.when(~F.isnan(number), number)


def parse_number(value: Column | str) -> Column:
    """Text to double. The gate keeps out forms only the JVM accepts, such as ``1d``."""
    text = strip(col_of(value).cast("string"))
    return F.when(text.rlike(_NUMBER), F.replace(text, F.lit("_"), F.lit("")).try_cast("double"))


def parse_cell_number(value: Column | str) -> Column:
    """As ``parse_number`` for table cells: missing tokens and thousands commas."""
    text = strip(value)
    return F.when(
        ~F.upper(text).isin(MISSING_TOKENS),
        parse_number(F.replace(text, F.lit(","), F.lit(""))),
    )


def parse_utc_timestamp(value: Column | str) -> Column:
    """ISO text to timestamp; text without a zone means UTC whatever the session says."""
    text = strip(value)
    zoned = (
        F.when(text.rlike(_CLOCK + _ZONE), text)
        .when(text.rlike(_CLOCK), F.concat(text, F.lit("Z")))
        .when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.concat(text, F.lit("T00:00:00Z")))
    )
    return zoned.try_cast("timestamp")


def guarded_ratio(numerator: Column | str, denominator: Column | str, scale: float = 1.0) -> Column:
    """``numerator * scale / denominator`` where the denominator is above zero, else NULL."""
    num, den = col_of(numerator), col_of(denominator)
    return F.when(den > 0, num * F.lit(scale) / den)
