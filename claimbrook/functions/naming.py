"""Which columns are codes by their name, and the stored type of every column."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

# Any of these inside a lower-cased column name marks a code.
CODE_TOKENS = ["_id", "_cd", "npi", "upin", "hcpcs", "icd_", "ndc", "oscar", "betos"]

# Code columns that none of the tokens above would find.
CODE_NAMES = ["clm_line_num", "carr_num", "prov_spclty"]

# Inferred type -> (semantic, stored type). Times of day and all-null columns are text.
_STORED = {
    "bigint": ("integer", T.LongType()),
    "double": ("float", T.DoubleType()),
    "boolean": ("boolean", T.BooleanType()),
    "date": ("date", T.DateType()),
    "timestamp_ntz": ("timestamp", T.TimestampNTZType()),
}


@dataclass(frozen=True)
class CodePolicy:
    """Names and name parts that make a column a code; both can be extended."""

    names: frozenset[str] = field(default_factory=lambda: frozenset(CODE_NAMES))
    tokens: tuple[str, ...] = tuple(CODE_TOKENS)

    def with_names(self, *more: str) -> CodePolicy:
        return CodePolicy(self.names | {m.lower() for m in more}, self.tokens)

    def is_code(self, column: str) -> bool:
        lowered = column.lower()
        return lowered in self.names or any(token in lowered for token in self.tokens)


DEFAULT_POLICY = CodePolicy()


def rule_for(column: str, inferred: str, policy: CodePolicy = DEFAULT_POLICY) -> T.StructField:
    """Stored field of a column: code by name first, then by inferred type."""
    if policy.is_code(column):
        semantic, stored = "string_code", T.StringType()
    else:
        semantic, stored = _STORED.get(inferred, ("text", T.StringType()))
    return T.StructField(column, stored, True, {"semantic": semantic})


def schema_for(
    header: list[str], inferred: dict[str, str], policy: CodePolicy = DEFAULT_POLICY
) -> T.StructType:
    """Stored schema in header order."""
    return T.StructType([rule_for(c, inferred.get(c, "null"), policy) for c in header])


def semantic_of(f: T.StructField) -> str:
    return f.metadata.get("semantic", "text")
