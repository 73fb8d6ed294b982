"""Mixing sources to target shares of a token budget, with a cap on repetition.

Method: temperature mixing under the limit of repetition. Every source takes its target share as far as its passes
reach. What the others lack is spread by tempered weights, ``room ** (1 - a) * target ** a``: at a = 1 in proportion to
the targets, at a = 0 to what the sources still have. The exponent is bisected to the greatest at which no source
passes its limit. The weights are realised by block permutations: whole passes over a source, then one partial pass in
pseudo-random order that stops at the budget. Without targets, :func:`tempered` gives weights of a target entropy.

All of it runs on tables of one row a source; single numbers come to the driver.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quirework.functions.tokens import token_count
from quirework.runtime import join_groups, materialize

#: Pieces the documents of a source are laid into for its partial pass, so no source is one task.
BUCKETS = 4096
#: Exponents tried in one job, and jobs; each narrows the bracket to one of so many parts.
TRIED, ROUNDS = 32, 5


def sized(documents: DataFrame) -> DataFrame:
    """(doc_id, source, tokens) of every document; a null or empty text has none."""
    return documents.select("doc_id", "source", token_count("text").cast("long").alias("tokens"))


def source_totals(documents: DataFrame) -> DataFrame:
    """(source, docs, tokens), one row per source; documents without one are in the row of null."""
    return sized(documents).groupBy("source").agg(
        F.count(F.lit(1)).alias("docs"), F.coalesce(F.sum("tokens"), F.lit(0)).cast("long").alias("tokens")
    )


def tempered(tokens: dict[str, int], entropy: float, steps: int = 60) -> tuple[dict[str, float], float]:
    """Weights ``share ** a`` and the exponent a in [0, 1] at which their entropy is ``entropy``.

    Entropy falls as a grows; outside the range the nearer end is taken. Sources without tokens weigh 0.
    """
    live = {s: n for s, n in tokens.items() if n > 0}
    if not live:
        return dict.fromkeys(tokens, 0.0), 1.0
    total = sum(live.values())

    def at(a: float) -> dict[str, float]:
        w = {s: (n / total) ** a for s, n in live.items()}
        z = sum(w.values())
        return {s: x / z for s, x in w.items()}

    low, high = 0.0, 1.0
    for _ in range(steps):
        mid = (low + high) / 2
        h = -sum(x * math.log(x) for x in at(mid).values())
        low, high = (mid, high) if h > entropy else (low, mid)
    a = (low + high) / 2
    return dict.fromkeys(tokens, 0.0) | at(a), a


def _spread(room: Column, target: Column, a: Column | float) -> Column:
    """Tempered weight of a source, before it is normalised; 0 without room or target."""
    a = F.lit(float(a)) if isinstance(a, (int, float)) else a
    return F.when((room > 0) & (target > 0), F.pow(room, 1 - a) * F.pow(target, a)).otherwise(F.lit(0.0))


def exponent(sources: DataFrame, lack: float) -> float:
    """The greatest exponent in [0, 1] at which ``lack`` tokens, spread over ``sources`` (target_share, room), fit into the room."""
    room, target = F.col("room"), F.col("target_share")
    open_ = sources.where("room > 0 and target_share > 0").select("room", "target_share")
    low, high = 0.0, 1.0
    for k in range(ROUNDS + 1):
        tried = [1.0] if k == 0 else [low + (high - low) * i / TRIED for i in range(1, TRIED)]
        sums = [F.sum(_spread(room, target, a)) for a in tried]
        most = [F.max(_spread(room, target, a) / room) for a in tried]
        row = open_.agg(*sums, *most).first()
        for i, a in enumerate(tried):
            z, top = row[i], row[len(tried) + i]
            if not z or lack * top / z <= 1 + 1e-12:
                low = max(low, a)
            else:
                high = min(high, a)
        if low >= high:
            break
    return low


def plan(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """One row per target: what its source has, could give at most, should give and will give.

    (source, target_share, max_repeats, docs, tokens, budget, wanted, most, short, take, exponent).
    ``short`` is true where max_repeats passes over the whole source fall short of its share.
    ``exponent`` is that of the weights by which what these lack is spread; where all other sources together have no
    room for it, all give what they can. Sources with a share of 0 take part in nothing. Repeated targets of one source
    count once; null sources among the targets are ignored, null shares and repeats are 0.
    """
    totals = materialize(source_totals(documents), "totals")
    goal = targets.where("source is not null").groupBy("source").agg(
        F.coalesce(F.max("target_share"), F.lit(0.0)).alias("target_share"),
        F.coalesce(F.max("max_repeats"), F.lit(0)).alias("max_repeats"),
        F.coalesce(F.max("budget_ratio"), F.lit(0.0)).alias("budget_ratio"),
    )
    all_tokens = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    d = goal.join(totals, "source", "left").select("source", "target_share", "max_repeats", "budget_ratio", zero("docs"), zero("tokens"))
    ratio = d.agg(F.coalesce(F.max("budget_ratio"), F.lit(0.0))).first()[0]
    most = F.col("max_repeats") * F.col("tokens")
    d = d.withColumns({
        "budget": F.lit(ratio * all_tokens), "wanted": F.col("target_share") * F.lit(ratio * all_tokens), "most": most,
        "short": most < F.col("target_share") * F.col("budget_ratio") * F.lit(all_tokens),
    })
    d = d.withColumn("room", F.when(F.col("target_share") > 0, F.greatest(F.lit(0.0), F.col("most") - F.col("wanted"))).otherwise(F.lit(0.0)))
    d = materialize(d, "sources")
    lack, room = d.agg(F.coalesce(F.sum(F.greatest(F.lit(0.0), F.col("wanted") - F.col("most"))), F.lit(0.0)), F.coalesce(F.sum("room"), F.lit(0.0))).first()
    a = exponent(d, lack) if 0 < lack < room else (1.0 if lack <= 0 else 0.0)
    weight = _spread(F.col("room"), F.col("target_share"), a)
    z = d.agg(F.sum(weight)).first()[0] or 1.0
    more = F.least(F.col("room"), weight / F.lit(z) * lack) if lack < room else F.col("room")
    take = F.when(F.col("target_share") > 0, F.least(F.col("most").cast("double"), F.col("wanted")) + more).otherwise(F.lit(0.0))
    return d.select(
        "source", "target_share", "max_repeats", "docs", "tokens", "budget", "wanted", "most", "short", take.alias("take"), F.lit(a).alias("exponent")
    )


def mix(documents: DataFrame, planned: DataFrame, seed: int = 0) -> DataFrame:
    """(doc_id, source, tokens, repeats): how often each document enters the mix of a :func:`plan`.

    Documents that don't enter it are left out.

    A source gives ``floor(take / tokens)`` whole passes and, of one more pass in the order of a
    seeded hash, the documents before the rest of its budget is used up. No document enters more than
    max_repeats times. The running sum is taken over bucket totals first and within buckets after,
    so a source that holds a third of the rows is no single task.
    """
    p = planned.select("source", "max_repeats", F.col("tokens").alias("source_tokens"), "take", "docs")
    all_docs = planned.agg(F.coalesce(F.sum("docs"), F.lit(0))).first()[0]
    d = (
        join_groups(sized(documents), p, "source", "docs", all_docs)
        .withColumn("h", F.xxhash64("doc_id", F.lit(seed)))
        .withColumn("bucket", F.pmod(F.col("h"), F.lit(BUCKETS)))
        .withColumn("passes", F.when(F.col("source_tokens") > 0, F.floor(F.col("take") / F.col("source_tokens"))).otherwise(F.lit(0)))
        .withColumn("rest", F.col("take") - F.col("passes") * F.col("source_tokens"))
    )
    by_bucket = d.groupBy("source", "bucket").agg(F.sum("tokens").alias("n"))
    w = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    before = by_bucket.select("source", "bucket", F.coalesce(F.sum("n").over(w), F.lit(0)).alias("before"))
    inner = Window.partitionBy("source", "bucket").orderBy("h", "doc_id", "tokens").rowsBetween(Window.unboundedPreceding, 0)
    run = d.join(before, ["source", "bucket"]).withColumn("upto", F.col("before") + F.sum("tokens").over(inner))
    return (
        run.withColumn(
            "repeats",
            F.least(
                F.col("passes") + F.when(F.col("upto") <= F.col("rest"), 1).otherwise(0), F.col("max_repeats")
            ).cast("int"),
        )
        .where("repeats > 0")
        .select("doc_id", "source", "tokens", "repeats")
    )


def shares(documents: DataFrame, targets: DataFrame, seed: int = 0) -> DataFrame:
    """(source, target_share, mixed_docs, mixed_tokens, actual_share, short) of the mix made."""
    planned = plan(documents, targets)
    made = mix(documents, planned, seed).groupBy("source").agg(
        F.sum("repeats").alias("mixed_docs"), F.sum(F.col("tokens") * F.col("repeats")).alias("mixed_tokens")
    )
    return (
        planned.join(made, "source", "left")
        .withColumn("all_mixed", F.sum("mixed_tokens").over(Window.partitionBy(F.lit(0))))
        .select(
            "source", "target_share", F.coalesce("mixed_docs", F.lit(0)).alias("mixed_docs"),
            F.coalesce("mixed_tokens", F.lit(0)).alias("mixed_tokens"),
            F.round(F.coalesce(F.col("mixed_tokens") / F.col("all_mixed"), F.lit(0.0)), 6).alias("actual_share"), "short",
        )
    )


def short_sources(documents: DataFrame, targets: DataFrame) -> DataFrame:
    """Sources that can't reach their share."""
    return plan(documents, targets).where("short").select("source")
