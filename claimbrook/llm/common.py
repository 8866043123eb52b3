"""Shared pieces: words, stage tables, spans found by regular expressions, components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimbrook.session import scratch

WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stage(df: DataFrame, label: str) -> DataFrame:
    """The rows written to the shared scratch folder and read again: cuts the lineage."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def matches(text: Column, pattern: str, kind: str, rank: int) -> Column:
    """All leftmost non-overlapping matches with code-point positions.

    The pieces between matches come from split, the matches from regexp_extract_all, and
    running lengths give the positions, so a text is passed twice and nothing is looped
    over in Python.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.split(text, pattern, -1)
    none = F.array().cast("array<struct<kind:string,rank:int,start:int,end:int,match:string>>")
    start = F.struct(F.lit(0).alias("at"), none.alias("out"))

    def step(state: Column, pair: Column) -> Column:
        begin = state["at"] + F.char_length(pair["b"])
        end = begin + F.char_length(pair["m"])
        span = F.struct(
            F.lit(kind).alias("kind"), F.lit(rank).alias("rank"), begin.alias("start"), end.alias("end"), pair["m"].alias("match")
        )
        return F.struct(end.alias("at"), F.concat(state["out"], F.array(span)).alias("out"))

    pairs = F.zip_with(found, F.slice(between, F.lit(1), F.size(found)), lambda m, b: F.struct(b.alias("b"), m.alias("m")))
    return F.when(F.size(found) == 0, none).otherwise(F.aggregate(pairs, start, step, lambda s: s["out"]))


def join_spans(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined in the given order."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def components(edges: DataFrame, label: str) -> DataFrame:
    """(node, component) of every node in `edges` (a, b): its smallest reachable id.

    Large-star and small-star rounds, each written to the shared folder. A hub's rows are
    joined with one row, so Spark's skew handling can split them.
    """
    now = stage(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), label
    )
    mark = None
    while True:
        both = now.select("a", "b").union(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        small_low = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(small_low, "a")
        small = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(joined.select("a", F.col("m").alias("b")))
        now = stage(small.where("a <> b").distinct(), label)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    return now.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("component"))
