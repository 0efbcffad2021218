"""Mixing sources by temperature: weights are token shares raised to an exponent.

An exponent of 1 keeps the natural shares, 0 makes all sources equal. The exponent is
found by sectioning: each round puts a grid of exponents on the table of sources, one
grouped sum gives the entropy and the largest repetition at each, and the section that
holds the target is cut again. No list of sources ever reaches the driver.

Weights become budgets of tokens. A source with a budget of several times its tokens is
read in several epochs; every epoch has its own permutation: rows are dealt to blocks
of about ``BLOCK_ROWS`` by a hash of seed, epoch and row and ordered by it inside a block, so
the running sum that ends the last epoch is taken per block and over the sums of
blocks, never over a whole source in one task. Rows carry their block and their place in
it: read by epoch, block and place, the blocks of all sources alternate at random.

Cases: a null source is a source of its own; rows without tokens cost nothing and are
taken once; an epoch ends before the row that would exceed the budget; equal rows may
stand for each other; if not even natural shares keep the repetition limit, they are
used; no rows give no rows; other columns pass through unless named like the new ones.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from matchforge.llm.common import stage

BLOCK_ROWS = 1024
GRID = 32
ROUNDS = 6
# Exponents searched for a target entropy; the repetition limit only needs 0 to 1.
LARGEST = 8.0


def source_totals(rows: DataFrame) -> DataFrame:
    """``key``, ``tokens`` and ``docs`` of each source with tokens."""
    return rows.groupBy("key").agg(F.sum("n_tokens").alias("tokens"), F.count(F.lit(1)).alias("docs")).where("tokens > 0")


def _grid(totals: DataFrame, whole: int, low: float, high: float) -> list:
    """Entropy and largest repetition of the whole corpus at GRID + 1 exponents from low to high."""
    points = [low + (high - low) * i / GRID for i in range(GRID + 1)]
    share = F.col("tokens") / F.lit(whole)
    rows = totals.select(F.log(share).alias("lp"), F.explode(F.array(*map(F.lit, points))).alias("a"))
    power = F.exp(F.col("a") * F.col("lp"))
    sums = rows.groupBy("a").agg(
        F.sum(power).alias("z"), F.sum(power * F.col("lp")).alias("zl"), F.max(F.exp((F.col("a") - 1) * F.col("lp"))).alias("top"))
    found = sums.select("a", (F.log("z") - F.col("a") * F.col("zl") / F.col("z")).alias("entropy"), (F.col("top") / F.col("z")).alias("repeat"))
    return found.orderBy("a").collect()


def _section(totals: DataFrame, whole: int, high: float, enough) -> float:
    """The smallest exponent in [0, high] from which on ``enough`` holds, else ``high``."""
    low = 0.0
    for step in range(ROUNDS):
        grid = _grid(totals, whole, low, high)
        if enough(grid[0]):
            return grid[0].a
        at = next((i for i, g in enumerate(grid) if enough(g)), None)
        if at is None:
            return high
        low, high = grid[at - 1].a, grid[at].a
    return high


def solve_exponent(totals: DataFrame, whole: int, budget: int, target_entropy: float | None, max_repeat: float | None) -> float:
    """The flattest exponent whose entropy is at most ``target_entropy`` (in nats) and
    whose repetition of any source is at most ``max_repeat``."""
    exponent = 0.0 if target_entropy is not None or max_repeat is not None else 1.0
    if target_entropy is not None:
        exponent = _section(totals, whole, LARGEST, lambda g: g.entropy <= target_entropy)
    if max_repeat is not None and exponent < 1:
        exponent = max(exponent, _section(totals, whole, 1.0, lambda g: g.repeat * budget / whole <= max_repeat))
    return exponent


def mix_sources(
    docs: DataFrame, n_tokens: Column, source: str = "source", budget: int | None = None,
    target_entropy: float | None = None, entropy_share: float | None = None, max_repeat: float | None = None,
    seed: int = 0, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Rows of ``docs`` once per epoch in which they are taken, with ``n_tokens``, ``epoch``, ``block`` and ``place``.

    ``budget`` is in tokens, by default those of ``docs``. ``entropy_share`` states the
    target as a share of the entropy of equal weights.
    """
    inner = ["_key", "_block", "_last", "_rest", "_at", "_before", "_epochs", "_blocks"]
    rows = docs.drop("epoch", "n_tokens", "block", "place", *inner).withColumns({
        "n_tokens": F.coalesce(n_tokens, F.lit(0)).cast("long"),
        "_key": F.coalesce(F.concat(F.lit("s"), F.col(source).cast("string")), F.lit("null"))})
    rows = stage(rows, "mixing")
    totals = stage(source_totals(rows.withColumnRenamed("_key", "key")), "sources")
    summed = totals.agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("n")).first()
    named = [F.col(c).cast("string") for c in docs.columns if c in ("doc_id", "text", source)]

    def permuted(some: DataFrame, blocks: Column) -> DataFrame:
        """Rows with an epoch, dealt to blocks of their source and put in order there."""
        place = F.xxhash64(F.lit(seed), "epoch", *named)
        return some.withColumn("place", place).withColumn("_block", F.pmod(F.xxhash64(F.lit(seed + 1), "place"), blocks)).withColumn(
            "block", F.xxhash64(F.lit(seed + 2), "epoch", "_key", "_block"))

    if not summed.tokens:
        return permuted(rows.withColumn("epoch", F.lit(0)), F.lit(1).cast("long")).drop("_key", "_block")
    whole = summed.tokens
    budget = whole if budget is None else budget
    if entropy_share is not None:
        target_entropy = entropy_share * math.log(summed.n)
    exponent = solve_exponent(totals, whole, budget, target_entropy, max_repeat)

    power = F.exp(F.lit(exponent) * F.log(F.col("tokens") / F.lit(whole)))
    z = totals.agg(F.sum(power)).first()[0]
    due = F.floor(power / F.lit(z) * F.lit(budget)).cast("long")
    plan = totals.withColumn("due", due).select(
        F.col("key").alias("_key"), F.expr("due div tokens").cast("int").alias("_last"), F.expr("due % tokens").alias("_rest"),
        F.ceil(F.col("docs") / block_rows).cast("long").alias("_blocks"))

    paid = rows.where("n_tokens > 0").join(plan, "_key")
    whole_epochs = permuted(paid.where("_last > 0").withColumn("epoch", F.explode(F.expr("sequence(0, _last - 1)"))), F.col("_blocks"))
    out = [*rows.columns, "epoch", "block", "place"]
    # the last epoch of each source ends where its budget does
    cut = permuted(paid.where("_rest > 0").withColumn("epoch", F.col("_last")), F.col("_blocks"))
    before = Window.partitionBy("_key").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    sums = cut.groupBy("_key", "_block").agg(F.sum("n_tokens").alias("s")).select(
        "_key", "_block", F.coalesce(F.sum("s").over(before), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_key", "_block").orderBy("place").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    narrow = cut.withColumn("_at", F.sum("n_tokens").over(inside)).join(sums, ["_key", "_block"])
    last = narrow.where(F.col("_before") + F.col("_at") <= F.col("_rest"))
    free = permuted(rows.where("n_tokens = 0").withColumn("epoch", F.lit(0)), F.lit(1).cast("long"))
    return whole_epochs.select(*out).unionByName(last.select(*out)).unionByName(free.select(*out)).drop("_key")
