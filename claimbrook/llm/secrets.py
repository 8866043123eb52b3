"""Secrets: named patterns, and character entropy in a sliding window.

Nulls and empty texts give no spans; repeated rows give repeated rows; the input's other
columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimbrook.llm.common import join_spans, matches

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{14,}"
HEX = r"[0-9a-f]{16,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
WINDOW = 20
# Bits per character a window has to reach, by the class its characters belong to. Twenty
# random digits have 3.0 on average; run-together words of the given texts have 3.58 at most.
LEAST_BITS = {"digits": 2.8, "hex": 3.0, "letters": 3.7, "mixed": 3.7}
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"


def _sequence(start: str, more: str) -> str:
    """`start` and as much of `more` as follows."""
    return start + "".join(f"(?:{c}" for c in more) + ")?" * len(more)


# Pairs and runs of letters that words of the Latin alphabet do not have.
UNWORDED = (
    r"q(?!u)[a-z]|[bdfghjkmpqtvwxz]q|[bcdfghjkmpqstvwxz]x|x[bdfgjkmnrsvwxz]|j[bcdfghjklmnpqrstvwxz]|[cfghkmpqtvwxyz]j"
    r"|v[bcdfghjkmnpqtwxz]|[jqx]v|w[cgjkmpqvxz]|z[cfjqx]|[jqvx]z|k[cgjqxz]|c[bdfgjmnpvwxz]|[aeiou]{5}|[bcdfghjklmnpqrstvwxz]{8}"
)
# What looks random and is not secret. Only windows that hold such a piece are left out;
# what stands beside it is scored.
ALLOWED = [
    r"(?<![0-9A-Za-z])[0-9a-fA-F]{8}(?:-[0-9a-fA-F]{4}){3}-[0-9a-fA-F]{12}(?![0-9A-Za-z])",
    r"(?i:example|placeholder|changeme|lorem|x{4,}|" + _sequence("abcdefg", "hijklmnopqrstuvwxyz") + ")",
    _sequence("0123456", "789"),
    # A word between other signs: of one case, capitalised or in camel case.
    r"(?<![0-9A-Za-z])(?=[A-Za-z]{4})(?![A-Za-z]*?(?i:" + UNWORDED + r"))"
    r"(?:[A-Z]+|[A-Z]?[a-z]+(?:[A-Z][a-z]+){0,30})(?![0-9A-Za-z])",
]


def window_bits(text: Column, window: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits a character) of any window of `text`.

    The counts of one window become those of the next by one step up and one down.
    """
    power = F.array(*[F.lit(0.0 if c < 2 else c * math.log2(c)) for c in range(window + 2)])

    def index(i: Column) -> Column:
        return F.when(i < 1, F.lit(0)).otherwise(_place(text, i))

    zero = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET)).alias("n"), F.lit(0.0).alias("s"), F.lit(0.0).alias("best")
    )

    def step(state: Column, i: Column) -> Column:
        into, out = index(i), index(i - window)
        up = F.element_at(state["n"], into)
        grown = F.transform(state["n"], lambda c, k: c + F.when(k + 1 == into, 1).otherwise(0))
        s = state["s"] + F.element_at(power, up + 2) - F.element_at(power, up + 1)
        down = F.when(out > 0, F.element_at(grown, F.greatest(out, F.lit(1)))).otherwise(0)
        shrunk = F.transform(grown, lambda c, k: c - F.when(k + 1 == out, 1).otherwise(0))
        s = s + F.when(out > 0, F.element_at(power, F.greatest(down, F.lit(1))) - F.element_at(power, F.greatest(down, F.lit(1)) + 1)).otherwise(0.0)
        bits = F.when(i >= window, F.lit(math.log2(window)) - s / window).otherwise(0.0)
        return F.struct(shrunk.alias("n"), s.alias("s"), F.greatest(state["best"], bits).alias("best"))

    return F.aggregate(F.sequence(F.lit(1), F.char_length(text)), zero, step, lambda s: s["best"])


def _place(text: Column, i: Column) -> Column:
    return F.call_function("locate", F.substring(text, i, F.lit(1)), F.lit(ALPHABET))


def _least(text: Column) -> Column:
    return (
        F.when(text.rlike(r"^[0-9]+$"), LEAST_BITS["digits"])
        .when(text.rlike(r"^[0-9a-fA-F]+$"), LEAST_BITS["hex"])
        .when(text.rlike(r"^[A-Za-z]+$"), LEAST_BITS["letters"])
        .otherwise(LEAST_BITS["mixed"])
    )


def pieces(text: Column, window: int = WINDOW) -> Column:
    """The parts of a candidate that are scored, each against the bits of its own class.

    What stands between allowed pieces, and the runs of digits and of hex digits in it;
    digits in groups count without what joins them.
    """
    between = F.split(text, "|".join(ALLOWED), -1)
    runs = lambda p, c: F.regexp_extract_all(p, F.lit(f"[{c}]{{{window},}}"), F.lit(0))
    own = lambda p: F.when(p.rlike(r"^[0-9/_=+-]+$"), F.regexp_replace(p, r"[/_=+-]", "")).otherwise(p)
    long = F.filter(between, lambda p: F.char_length(p) >= window)
    parts = F.flatten(F.transform(long, lambda p: F.concat(F.array(own(p)), runs(p, "0-9"), runs(p, "0-9a-fA-F"))))
    return F.array_distinct(F.filter(parts, lambda p: F.char_length(p) >= window))


def find_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with `base` and `spans`: arrays of (kind, rank, start, end, match)."""
    whole = F.coalesce(F.col(text), F.lit(""))
    assign = F.filter(
        matches(whole, ASSIGN, "assign", 0), lambda s: F.char_length(F.regexp_extract(s["match"], ASSIGN, 2)) >= 12
    )
    base = F.concat(assign, matches(whole, ACCESS, "access", 1), matches(whole, HEX, "hex", 2))
    order = lambda spans: F.transform(
        F.array_sort(F.transform(spans, lambda s: F.struct(s["start"], s["rank"], s["end"], s["kind"], s["match"]))),
        lambda s: F.struct(s["kind"], s["rank"], s["start"], s["end"], s["match"]),
    )
    found = docs.withColumn("__base", base).withColumn("__more", matches(whole, CANDIDATE, "entropy", 3))
    more = F.filter(
        F.col("__more"),
        lambda c: ~F.exists(F.col("__base"), lambda b: (b["start"] <= c["start"]) & (b["end"] >= c["end"]))
        & F.exists(pieces(c["match"]), lambda p: window_bits(p) >= _least(p)),
    )
    return found.withColumn("base", order(F.col("__base"))).withColumn(
        "spans", order(F.concat(F.col("__base"), more))
    ).drop("__base", "__more")


def digest(found: DataFrame) -> DataFrame:
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(join_spans(F.col("base")), 256).alias("base_sha256"),
        join_spans(F.col("spans")).alias("spans"),
    )
