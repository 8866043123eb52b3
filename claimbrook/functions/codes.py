"""Medical codes spread over numbered columns (HCPCS_CD_1, HCPCS_CD_2, ...)."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def block(columns: list[str], prefix: str) -> list[str]:
    """Columns named prefix_<number>, by number."""
    pattern = re.compile(re.escape(prefix) + r"_(\d+)")
    found = [(int(m.group(1)), c) for c in columns if (m := pattern.fullmatch(c))]
    return [name for _, name in sorted(found)]


def normalise_code(code: Column, width: int | None = None) -> Column:
    """A code as a label: text, never a number; zeros in front only on request."""
    text = code.cast("string")
    if width is None:
        return text
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def pack_codes(columns: list[str]) -> Column:
    """The filled code columns of a row as one array."""
    return F.array_compact(F.array(*[F.col(c) for c in columns]))


def distinct_codes(columns: list[str]) -> Column:
    return F.array_distinct(pack_codes(columns))


def has_any_code(columns: list[str], codes: list) -> Column:
    """True when any of the code columns holds one of the codes; never null."""
    hits = [F.coalesce(F.col(c).isin(codes), F.lit(False)) for c in columns]
    return reduce(lambda a, b: a | b, hits, F.lit(False))
