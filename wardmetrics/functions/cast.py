"""Forgiving casts from text cells to typed columns."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Cells that mean "no value" in the source files.
NULL_TOKENS = ("", "nan", "None", "null", "[x]", "[c]", "[z]", "-")

# Further cells a pandas CSV reader takes as missing.
READER_NULL_TOKENS = (
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND",
    "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "n/a",
)

# Blanks cut from both ends of a cell, spreadsheet blanks such as U+00A0 included.
BLANKS = " \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"

_CLOCK = r"\d{2}:\d{2}(?::\d{2}(?:\.\d{1,9})?)?"

# Dates with the year first, by dashes or slashes, with a clock and a zone or not.
YEAR_FIRST = rf"^\d{{4}}([-/])\d{{1,2}}\1\d{{1,2}}(?:[ T]{_CLOCK})?$"
YEAR_FIRST_ZONED = rf"^\d{{4}}([-/])\d{{1,2}}\1\d{{1,2}}[ T]{_CLOCK} ?(?:Z|[+-]\d{{2}}:?\d{{2}})$"

# Dates with the year last: two numbers whose order is a matter of the source, a year of four or two digits, a clock or not.
YEAR_LAST = rf"^(\d{{1,2}})([-/])(\d{{1,2}})\2(\d{{4}}|\d{{2}})((?: {_CLOCK})?)$"

# Dates with the month's name: the shape keeps the parser from throwing on every row of another one.
NAMED_MONTHS = (
    (r"^\d{1,2} [A-Za-z]{3} \d{4}$", "d MMM yyyy"),
    (r"^\d{1,2} [A-Za-z]{4,9} \d{4}$", "d MMMM yyyy"),
)

DAY_FIRST, MONTH_FIRST = "day", "month"

# Possible orders of a year-last date as bits.
_DAY_BIT, _MONTH_BIT = 1, 2

TIME_PATTERN = r"^([01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9]$"

# Logical type names a layout may use, and the Spark type each one yields.
LOGICAL_TYPES = {
    "STRING": "string",
    "INTEGER": "bigint",
    "FLOAT": "double",
    "DATE": "date",
    "DATETIME": "timestamp_ntz",
    "TIMESTAMP": "timestamp_ntz",
    "TIME": "string",
}


def clean_text(raw: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text, null where the whole cell is a null token (case counts)."""
    trimmed = F.btrim(raw, F.lit(BLANKS))
    return F.when(~trimmed.isin(*tokens), trimmed)


def text_to_float(text: Column, scientific: bool = False) -> Column:
    """Number with every character but digits, dot and minus dropped first."""
    stripped = F.regexp_replace(text, "[^0-9.-]", "").try_cast("double")
    if scientific:
        plain = F.when(text.rlike(r"^[+-]?[0-9]+(\.[0-9]*)?[eE][+-]?[0-9]+$"), text.try_cast("double"))
        return F.coalesce(plain, stripped)
    return stripped


def text_to_integer(text: Column, scientific: bool = False) -> Column:
    """:func:`text_to_float` rounded half to even."""
    return F.rint(text_to_float(text, scientific)).try_cast("bigint")


def text_to_timestamp(text: Column, order: str | Column = DAY_FIRST) -> Column:
    """Date or date-time text; text of no known shape, and days that do not exist, become null.

    ``order`` says how a year-last date is read: ``day`` or ``month`` first, the
    same for all rows or a column of it. Two-digit years are 1969 to 2068. A time
    with a zone is told in the session's.
    """
    dashed = F.replace(text, F.lit("/"), F.lit("-"))
    # As a cast reads zones: behind the seconds, without a blank, with a colon.
    zoned = F.regexp_replace(dashed, r"([ T]\d{2}:\d{2}) ?(Z|[+-]\d{2}:?\d{2})$", "$1:00$2")
    zoned = F.regexp_replace(F.regexp_replace(zoned, r" (Z|[+-]\d{2}:?\d{2})$", "$1"), r"([+-]\d{2}):?(\d{2})$", "$1:$2")

    def year_last(turned: str) -> Column:
        whole = F.regexp_replace(text, YEAR_LAST, turned)
        full = F.regexp_replace(F.regexp_replace(whole, r"^(69|[7-9]\d)-", "19$1-"), r"^(\d{2})-", "20$1-")
        return full.try_cast("timestamp_ntz")

    day, month = year_last("$4-$3-$1$5"), year_last("$4-$1-$3$5")
    if isinstance(order, Column):
        last = F.when(order == MONTH_FIRST, month).otherwise(day)
    else:
        last = month if order == MONTH_FIRST else day
    named = [F.when(text.rlike(shape), F.try_to_timestamp(text, F.lit(pattern)).cast("timestamp_ntz")) for shape, pattern in NAMED_MONTHS]
    return (
        F.when(text.rlike(YEAR_FIRST), dashed.try_cast("timestamp_ntz"))
        .when(text.rlike(YEAR_LAST), last)
        .when(text.rlike(YEAR_FIRST_ZONED), zoned.try_cast("timestamp").cast("timestamp_ntz"))
        .otherwise(F.coalesce(*named))
    )


def possible_orders(text: Column) -> Column:
    """Bits of the orders a year-last date may have been written in; all of them for any other text, null for null."""
    first, second = (F.regexp_extract(text, YEAR_LAST, group).cast("int") for group in (1, 3))
    day = F.when(first.between(1, 31) & second.between(1, 12), F.lit(_DAY_BIT)).otherwise(F.lit(0))
    month = F.when(first.between(1, 12) & second.between(1, 31), F.lit(_MONTH_BIT)).otherwise(F.lit(0))
    return F.when(text.rlike(YEAR_LAST), day + month).when(text.isNotNull(), F.lit(_DAY_BIT + _MONTH_BIT))


def order_of(bits: Column, seen: Column) -> Column:
    """Name of what is left of the possible orders after ``seen`` year-last dates: ``day``, ``month``, ``either``, ``neither`` or null."""
    return (
        F.when(seen == 0, F.lit(None).cast("string")).when(bits == _DAY_BIT, F.lit(DAY_FIRST)).when(bits == _MONTH_BIT, F.lit(MONTH_FIRST))
        .when(bits == _DAY_BIT + _MONTH_BIT, F.lit("either")).otherwise(F.lit("neither"))
    )


def text_to_time(text: Column) -> Column:
    """``HH:mm:ss`` text, or null when it is no such time."""
    return F.when(text.rlike(TIME_PATTERN), text)


def cast_text(text: Column, logical_type: str, scientific: bool = False, on_unknown: str = "error", order: str | Column = DAY_FIRST) -> Column:
    """Cast text that :func:`clean_text` has cleaned already; ``order`` is that of year-last dates."""
    if logical_type == "STRING":
        return text
    if logical_type == "INTEGER":
        return text_to_integer(text, scientific)
    if logical_type == "FLOAT":
        return text_to_float(text, scientific)
    if logical_type == "DATE":
        return text_to_timestamp(text, order).cast("date")
    if logical_type in ("DATETIME", "TIMESTAMP"):
        return text_to_timestamp(text, order)
    if logical_type == "TIME":
        return text_to_time(text)
    if on_unknown == "string":
        return text
    raise ValueError(f"unknown column type {logical_type!r}; use one of {sorted(LOGICAL_TYPES)}")


def clean_cast(
    raw: Column,
    logical_type: str,
    tokens: Sequence[str] = NULL_TOKENS,
    scientific: bool = False,
    on_unknown: str = "error",
) -> Column:
    """Cast a text cell to a logical type; a cell that does not parse becomes null.

    Over many columns use :func:`cast_columns`, which cleans each cell once.
    """
    return cast_text(clean_text(raw, tokens), logical_type, scientific, on_unknown)


def cast_columns(
    df: DataFrame, types: Mapping[str, str], tokens: Sequence[str] = NULL_TOKENS, scientific: bool = False,
    orders: Mapping[str, str | Column] | None = None,
) -> DataFrame:
    """Cast text columns in place: one stage cleans the cells, the next one casts them.

    ``orders`` names the order of year-last dates by column; day first where it says nothing.
    """
    cleaned = df.withColumns({name: clean_text(F.col(f"`{name}`"), tokens) for name in types})
    return cleaned.withColumns({
        name: cast_text(F.col(f"`{name}`"), kind, scientific, order=(orders or {}).get(name, DAY_FIRST)) for name, kind in types.items() if kind != "STRING"
    })
