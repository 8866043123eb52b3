"""Text cells to typed values, and the type a column of text cells has.

Each rule is a pair: what makes a cell valid, and its value. The same pairs serve
inference (every cell valid), strict conversion (an invalid cell stops the write) and
quarantine (an invalid cell moves its row aside).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

# Cells read as null (case matters, spaces are not trimmed).
NULL_TOKENS = ["", "NULL", "null", "NA", "na", "N/A"]

# Cells read as booleans.
TRUE_TOKENS = ["true", "True", "TRUE", "1", "yes", "Yes", "YES"]
FALSE_TOKENS = ["false", "False", "FALSE", "0", "no", "No", "NO"]

# Inference accepts fewer words: a yes/no column is text unless typed otherwise.
_INFERRED_BOOLEANS = ["true", "True", "TRUE", "1", "false", "False", "FALSE", "0"]

# Spaces and tabs around a number do not count. The patterns are stricter than the casts,
# which take +5, 1d or hexadecimals, and come first, as a cast that fails is slow.
_BIGINT = r"^[ \t]*-?0*\d{1,19}[ \t]*$"
_DOUBLE = r"^[ \t]*-?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:nan|inf|infinity))[ \t]*$"
_DATE = r"^\d{4}-\d{2}-\d{2}$"
_TIME = r"^\d{2}:\d{2}(:\d{2}(\.\d{1,9})?)?$"
_TIMESTAMP = r"^\d{4}-\d{2}-\d{2}([ T]\d{2}(:\d{2}(:\d{2}(\.\d{1,9})?)?)?)?$"


@dataclass(frozen=True)
class NullTokens:
    tokens: tuple[str, ...] = tuple(NULL_TOKENS)

    def apply(self, cell: Column) -> Column:
        return F.when(~cell.isin(list(self.tokens)), cell)

    def never_values(self) -> bool:
        """Whether no token could be read as a number, a boolean or a date, so that it
        is enough to look for tokens among the cells that do not convert."""
        words = {w.lower() for w in TRUE_TOKENS + FALSE_TOKENS} | {"nan", "inf", "infinity"}
        return not any(
            any(ch.isdigit() for ch in t) or t.strip(" \t-").lower() in words for t in self.tokens
        )


def _bigint(cell: Column) -> Column:
    return F.when(cell.rlike(_BIGINT), cell.try_cast("bigint"))


def _double(cell: Column) -> Column:
    return F.when(cell.rlike(_DOUBLE), cell.try_cast("double"))


def _boolean(cell: Column) -> Column:
    return F.when(cell.isin(TRUE_TOKENS), True).when(cell.isin(FALSE_TOKENS), False)


def _date(cell: Column) -> Column:
    return F.when(cell.rlike(_DATE), cell.try_cast("date"))


def _timestamp(cell: Column) -> Column:
    # An hour alone ("2008-01-01 10") needs its minutes before the cast reads it.
    full = F.when(F.length(cell) == 13, F.concat(cell, F.lit(":00"))).otherwise(cell)
    return F.when(cell.rlike(_TIMESTAMP), full.try_cast("timestamp_ntz"))


_CONVERT = {
    "string": lambda cell: cell,
    "bigint": _bigint,
    "double": _double,
    "boolean": _boolean,
    "date": _date,
    "timestamp_ntz": _timestamp,
}


def convert(cell: Column, type_name: str) -> Column:
    """Typed value of a text cell; null for an invalid one (nulls stay null)."""
    return _CONVERT[type_name](cell)


def invalid(cell: Column, type_name: str) -> Column:
    """True for a filled cell that has no value of the type."""
    if type_name == "string":
        return F.lit(False)
    return cell.isNotNull() & convert(cell, type_name).isNull()


# The first of these that every filled cell of a column fits is the column's type; a
# column that fits none is text, and only an empty column fits "null".
INFERENCE_ORDER = ["null", "bigint", "boolean", "date", "time", "timestamp_ntz", "double"]

_BIT = {name: 1 << i for i, name in enumerate(INFERENCE_ORDER)}


def fitting_types(cell: Column) -> Column:
    """The types one cell fits, as bits in inference order.

    Cheap and common shapes are tried first, and a cell has only one of them.
    """
    number = _BIT["bigint"] | _BIT["double"]
    word = cell.isin(_INFERRED_BOOLEANS)
    return (
        F.when(cell.isNull(), sum(_BIT.values()))
        .when(_bigint(cell).isNotNull(), F.when(word, number | _BIT["boolean"]).otherwise(number))
        .when(word, _BIT["boolean"])
        .when(_date(cell).isNotNull(), _BIT["date"] | _BIT["timestamp_ntz"])
        .when(cell.rlike(_TIME), _BIT["time"])
        .when(_timestamp(cell).isNotNull(), _BIT["timestamp_ntz"])
        .when(cell.rlike(_DOUBLE), _BIT["double"])
        .otherwise(0)
    )


def first_type(bits: int | None) -> str:
    """Type of a column from the bits all its cells have in common."""
    if bits is None:
        return "null"
    return next((name for name in INFERENCE_ORDER if bits & _BIT[name]), "string")
