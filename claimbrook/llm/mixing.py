"""Mixing sources to target weights by a min-cost flow.

Documents are aggregated by the set of sources they belong to. Each set offers its words
once at cost 1 and again at cost 3 (convex: a repeat is only bought when first uses are
spent); the flow routes them to the sources' targets. Within a set, a seeded hash orders
the documents, and running sums turn the routed words into words taken from each one.

A null or wordless text has size 0 and is taken 0 times; a null source is a source of its
own; repeated rows each count; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimbrook.llm.common import WORD, stage

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
REPEATS = 2
BUCKETS = 1024


def targets(sizes: list[int], weights: list[float], share: float = SHARE, cap: float = REPEATS) -> list[float]:
    """Words due to each source: shares by weight, stopped at cap times its size, the rest dealt again."""
    left, open_, out = share * sum(sizes), list(range(len(sizes))), [0.0] * len(sizes)
    while open_:
        total = sum(weights[i] for i in open_)
        over = [i for i in open_ if left * weights[i] / total > cap * sizes[i]]
        if not over:
            for i in open_:
                out[i] = left * weights[i] / total
            break
        for i in over:
            out[i] = float(cap * sizes[i])
            left -= out[i]
            open_.remove(i)
    return out


def flow(offers: list[tuple[frozenset[int], int]], quotas: list[int], repeats: int = REPEATS) -> list[int]:
    """Words to take from each offer (member sources, words) so that quotas fill at least cost.

    Successive cheapest paths over offers and sources; the k-th use of a word costs 2k - 1.
    Offers are the distinct membership patterns, so the graph does not grow with the rows.
    """
    used = [0] * len(offers)
    sent: dict[tuple[int, int], int] = {}
    need = list(quotas)
    while True:
        # Bellman-Ford from the offers with words left to the sources with quota left.
        cost = [2 * (u // n) + 1 if n and u < repeats * n else float("inf") for u, (_, n) in zip(used, offers)]
        at_offer, at_source = list(cost), [float("inf")] * len(quotas)
        back_o: list[int | None] = [None] * len(offers)
        back_s: list[int | None] = [None] * len(quotas)
        moved = True
        while moved:
            moved = False
            for o, (members, _) in enumerate(offers):
                for s in members:
                    if at_offer[o] < at_source[s]:
                        at_source[s], back_s[s], moved = at_offer[o], o, True
                    if sent.get((o, s), 0) and at_source[s] < at_offer[o]:
                        at_offer[o], back_o[o], moved = at_source[s], s, True
        ends = [s for s in range(len(quotas)) if need[s] > 0 and at_source[s] < float("inf")]
        if not ends:
            return used
        end = min(ends, key=lambda s: (at_source[s], s))
        path, s = [], end
        while True:
            o = back_s[s]
            path.append((o, s, 1))
            if back_o[o] is None:
                break
            s = back_o[o]
            path.append((o, s, -1))
        size = offers[o][1]
        amount = min(need[end], size - used[o] % size, *[sent[(a, b)] for a, b, d in path if d < 0])
        for a, b, d in path:
            sent[(a, b)] = sent.get((a, b), 0) + d * amount
        used[o] += amount
        need[end] -= amount


def mix(
    docs: DataFrame, key: str = "doc_id", text: str = "text", sources: str = "source",
    weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, seed: int = 1,
) -> DataFrame:
    """(key, size, source_size, target, taken) of every row.

    `sources` is a name, or an array of names for documents that belong to several; then
    source_size and target are sums over them. Only sums per pattern and per pattern and
    hash bucket are ordered; the running sum over single documents is taken within the one
    bucket where a pattern's words end.
    """
    member = F.col(sources)
    if docs.schema[sources].dataType.simpleString() == "string":
        member = F.array(member)
    sized = stage(
        docs.select(
            F.col(key).alias("id"),
            F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.array_sort(F.array_distinct(F.coalesce(member, F.array(F.lit(None).cast("string"))))).alias("members"),
        )
        .withColumn("hash", F.xxhash64(F.lit(seed), "id"))
        .withColumn("bucket", F.pmod("hash", F.lit(BUCKETS)).cast("int")),
        "mix",
    )
    patterns = sized.groupBy("members").agg(F.sum("size").alias("n")).collect()
    names = sorted({m for p in patterns for m in p["members"]}, key=lambda m: (m is None, m or ""))
    place = {m: i for i, m in enumerate(names)}
    offers = [(frozenset(place[m] for m in p["members"]), p["n"]) for p in patterns]
    sizes = [sum(n for members, n in offers if i in members) for i in range(len(names))]
    due = targets(sizes, [weights[i % len(weights)] for i in range(len(names))], share)
    take = flow(offers, [round(d) for d in due])
    spark = docs.sparkSession
    plan = spark.createDataFrame(
        [
            (list(p["members"]), t // p["n"] if p["n"] else 0, t % p["n"] if p["n"] else 0,
             sum(sizes[i] for i in members), float(sum(due[i] for i in members)))
            for p, (members, _), t in zip(patterns, offers, take)
        ],
        "members array<string>, whole long, part long, source_size long, target double",
    )
    # A null element never equals itself in a join, so patterns meet by their JSON text.
    mark = F.to_json(F.struct("members"))
    plan = plan.withColumn("mark", mark).drop("members")
    before = Window.partitionBy("mark").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sized.groupBy(mark.alias("mark"), "bucket").agg(F.sum("size").alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .join(plan, "mark")
        .withColumn("left", F.col("part") - F.col("before"))
        .select("mark", "bucket", "whole", "source_size", "target", F.col("left"), (F.col("left").between(1, F.col("n") - 1)).alias("edge"))
    )
    dealt = sized.withColumn("mark", mark).join(starts, ["mark", "bucket"])
    run = Window.partitionBy("mark", "bucket").orderBy("hash", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    inside = dealt.where("edge").withColumn("ahead", F.coalesce(F.sum("size").over(run), F.lit(0)))
    extra = F.greatest(F.lit(0), F.least(F.col("size"), F.col("left") - F.col("ahead")))
    columns = lambda more: [F.col("id").alias(key), "size", "source_size", "target", (F.col("whole") * F.col("size") + more).cast("long").alias("taken")]
    return inside.select(*columns(extra)).unionByName(
        dealt.where("not edge").select(*columns(F.when(F.col("left") > 0, F.col("size")).otherwise(0)))
    )
