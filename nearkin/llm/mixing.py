"""Mixing sources by temperature: weights are token shares to a power, realised as permutations of blocks on a budget.

The exponent lies between 0 (all sources alike) and 1 (as they come) and is bisected until the weights have a target
entropy, or until no source is repeated more often than a limit. Each source is cut into blocks by a seeded hash. Epoch
after epoch its blocks are put in a new seeded order and taken until the source's budget is used up; of the block in
which that happens, the documents that still fit in are taken in hash order.

Budgets of sources are whole tokens, and only integers are compared. Where no budget is given, no source's is below its
tokens, so that rounding costs no document.

A mix that would repeat a source more than MAX_EPOCHS times is refused. A null source is a source of its own, a null token count counts as 0. A source without tokens has no weight: it is left
out where a budget is given, and taken once where none is, except that a table without any tokens has no entropy to meet and
gives no rows for one. Repeated rows are documents of their own. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from nearkin.llm.quality import unused
from nearkin.plans.scale import fits_broadcast, written

PROBES = 16
MAX_EPOCHS = 10_000


@dataclass
class Mix:
    rows: DataFrame
    weights: DataFrame
    exponent: float
    budget: float


def bisect_exponent(totals: DataFrame, goal, rounds: int = 8) -> float:
    """The largest exponent in [0, 1] whose measure is still `above` (see goal), by nested intervals.

    Each round measures PROBES exponents between the bounds in one aggregation over the table of sources, so that no
    source reaches the driver.
    """
    low, high = 0.0, 1.0
    for _ in range(rounds):
        probes = [low + (high - low) * (i + 1) / (PROBES + 1) for i in range(PROBES)]
        flags = totals.agg(*[goal(a).alias(f"p{i}") for i, a in enumerate(probes)]).first()
        above = [a for i, a in enumerate(probes) if flags[f"p{i}"]]
        below = [a for i, a in enumerate(probes) if not flags[f"p{i}"]]
        low, high = max(above, default=low), min(below, default=high)
    return (low + high) / 2


def entropy_above(target: float):
    """Is the entropy (in nats) of the weights at an exponent above the target? It falls as the exponent grows."""
    def goal(a: float) -> Column:
        x, log = F.pow("share", F.lit(a)), F.log("share")
        return F.log(F.sum(x)) - a * F.sum(x * log) / F.sum(x) > target
    return goal


def repetition_above(limit: float, budget_share: float | None):
    """Is some source repeated more often than the limit? With no budget given, the budget is the least that takes every
    document once."""
    def goal(a: float) -> Column:
        times = F.pow("share", F.lit(a - 1))
        scale = budget_share / F.sum(F.pow("share", F.lit(a))) if budget_share else 1 / F.min(times)
        return F.max(times) * scale > limit
    return goal


def temperature_mix(
    df: DataFrame, source_col: str, tokens: Column, *, entropy: float | None = None, repetition_limit: float | None = None,
    budget: float | None = None, block_tokens: int = 200_000, seed: int = 11,
) -> Mix:
    """rows: the rows of df as often as they are taken, with mix_epoch and mix_block (the block's place in its
    epoch's order) to sort by. weights: source, tokens, weight, budget. Give a target entropy or a repetition limit.

    `budget` is in tokens; without it, it is the least for which every document is taken at least once.
    """
    n, source, block, order = (unused(df, x) for x in ("_tokens", "_source", "_block", "_order"))
    epoch, rank = unused(df, "mix_epoch"), unused(df, "mix_block")
    simple = [F.col(f"`{c}`") for c, kind in df.dtypes if kind.split("(")[0] in ("bigint", "int", "string", "double", "date")]
    marked = df.withColumn(n, F.coalesce(tokens.cast("bigint"), F.lit(0))) \
        .withColumn(source, F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit("null"))) \
        .withColumn(order, F.xxhash64(F.lit(seed), *simple))
    sources = written(marked.groupBy(source).agg(F.sum(n).alias("tokens")))
    totals = sources.where(F.col("tokens") > 0)
    whole = totals.agg(F.coalesce(F.sum("tokens"), F.lit(0))).first()[0]
    shares = totals.withColumn("share", F.col("tokens") / F.lit(float(max(whole, 1))))
    budget_share = budget / max(whole, 1) if budget else None
    goal = entropy_above(entropy) if entropy is not None else repetition_above(repetition_limit, budget_share)
    exponent = bisect_exponent(shares, goal) if whole else 1.0
    norm, least = shares.agg(F.sum(F.pow("share", F.lit(exponent))), F.min(F.pow("share", F.lit(exponent - 1)))).first()
    spent = budget if budget else float(whole) * norm / least if whole else 0.0
    weighed = shares.select(source, "tokens", (F.pow("share", F.lit(exponent)) / F.lit(norm or 1.0)).alias("weight"))
    if not budget and (whole or entropy is None):
        weighed = weighed.unionAll(sources.where(F.col("tokens") <= 0).select(source, "tokens", F.lit(0.0)))
    # what lies within rounding of a whole number of tokens is that number
    share_of = F.floor(F.col("weight") * F.lit(float(spent)) * (1 + 1e-12) + 1e-6)
    weights = written(weighed.select(
        "*", F.greatest(F.ceil(F.col("tokens") / block_tokens), F.lit(1)).alias("blocks"),
        (share_of if budget else F.greatest("tokens", share_of)).alias("budget")))

    most = weights.agg(F.max(F.col("budget") / F.greatest("tokens", F.lit(1)))).first()[0] or 0
    if most > MAX_EPOCHS:
        raise ValueError(f"a source would be repeated {most:.0f} times: give a budget, or a target nearer to the sources' own shares")

    small = fits_broadcast(weights, F.length(source) * 4 + 64)
    count = unused(df, "_blocks")
    blocks_of = weights.select(source, F.col("blocks").alias(count))
    placed = marked.join(F.broadcast(blocks_of) if small else blocks_of, source) \
        .withColumn(block, F.pmod(F.col(order), F.col(count))).drop(count)
    sizes = written(placed.groupBy(source, block).agg(F.sum(n).alias("size")))
    epochs = weights.select(source, "budget", F.explode(F.sequence(
        F.lit(0), F.expr("greatest(budget - 1, 0) div greatest(tokens, 1)").cast("int"))).alias("epoch"), "tokens")
    turns = sizes.join(epochs, source).withColumn("turn", F.xxhash64(F.lit(seed), source, "epoch", block))
    by_turn = Window.partitionBy(source, "epoch").orderBy("turn", block)
    taken = turns.withColumn("rank", F.row_number().over(by_turn).cast("int")) \
        .withColumn("before", F.col("epoch") * F.col("tokens") + F.sum("size").over(by_turn) - F.col("size"))
    open_yet = (F.col("before") < F.col("budget")) | (F.col("epoch") == 0) & (F.col("before") <= F.col("budget"))
    plan = written(taken.where(open_yet).select(
        source, block, F.col("epoch").alias(epoch), F.col("rank").alias(rank),
        F.when(F.col("before") + F.col("size") > F.col("budget"), F.col("budget") - F.col("before")).alias(unused(df, "_left"))))
    left = unused(df, "_left")
    rows = placed.join(F.broadcast(plan) if fits_broadcast(plan, F.length(source) * 4 + 64) else plan, [source, block])
    within = Window.partitionBy(source, block, epoch).orderBy(order, *simple).rowsBetween(Window.unboundedPreceding, 0)
    partly = rows.where(F.col(left).isNotNull()).withColumn(block, F.sum(n).over(within)).where(F.col(block) <= F.col(left))
    columns = [F.col(f"`{c}`") for c in df.columns] + [F.col(epoch), F.col(rank)]
    both = rows.where(F.col(left).isNull()).select(*columns).unionAll(partly.select(*columns))
    shown = weights.select(
        F.when(F.col(source) != "null", F.expr(f"substring({source}, 2)")).alias("source"), "tokens", "weight", "budget")
    return Mix(both, shown, exponent, spent)
