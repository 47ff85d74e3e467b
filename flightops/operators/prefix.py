"""Exact distributed prefix sums and ranks without a single-task window.

A running total over an ordered timeline is split in two levels:

* inside a *block* (a day of minutes, a score bucket, ...): a window
  partitioned by (keys, block) -- its size is bounded by the block width;
* across blocks: the per-block totals (one row per (keys, block), a table
  that is tiny next to the data) get their own running total, joined back.

prefix(x) = offset(block(x)) + running sum inside block(x).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join on ``keys`` where null matches null (group keys may be null)."""
    if not keys:
        # one-row side (totals): an equi-join on a constant, broadcast by size
        one = "_const_key"
        return left.withColumn(one, F.lit(1)).join(right.withColumn(one, F.lit(1)), one, how).drop(one)
    ren = {k: f"_r_{k}" for k in keys}
    r = right.withColumnsRenamed(ren)
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(ren[k]))
        cond = c if cond is None else cond & c
    return left.join(r, cond, how).drop(*ren.values())


def exclusive_prefix(tl: DataFrame, keys: list[str], order, values: list[str],
                     block: Column, prefix: str = "prior_", null_safe: bool = True) -> DataFrame:
    """Add ``prefix+v`` = sum of v over earlier rows (strictly smaller ``order``)
    of the same ``keys``; ``tl`` must hold one row per (keys, order)."""
    t = tl.withColumn("_blk", block)
    order = order if isinstance(order, (list, tuple)) else [order]
    w_in = (Window.partitionBy(*keys, "_blk").orderBy(*order)
            .rowsBetween(Window.unboundedPreceding, -1))
    t = t.withColumns({f"_in_{v}": F.coalesce(F.sum(v).over(w_in), F.lit(0)) for v in values})
    totals = t.groupBy(*keys, "_blk").agg(*[F.sum(v).alias(f"_bt_{v}") for v in values])
    w_blk = (Window.partitionBy(*keys).orderBy("_blk")
             .rowsBetween(Window.unboundedPreceding, -1))
    offsets = totals.select(*keys, "_blk", *[
        F.coalesce(F.sum(f"_bt_{v}").over(w_blk), F.lit(0)).alias(f"_off_{v}") for v in values])
    j = null_safe_join(t, offsets, keys + ["_blk"]) if null_safe else t.join(offsets, keys + ["_blk"])
    return j.select(*tl.columns, *[(F.col(f"_off_{v}") + F.col(f"_in_{v}")).alias(f"{prefix}{v}")
                                   for v in values])


def block_rolling(tl: DataFrame, keys: list[str], order: str, values: list[str], width: int,
                  prefix: str = "roll_") -> DataFrame:
    """Sum of v over rows with order in [x - width, x - 1] (left-closed window
    that ends just before x). Rows are bucketed by floor(order / width); each
    bucket also receives a copy of the previous bucket, so every frame lies
    inside one (keys, bucket) partition of at most 2 * width distinct orders."""
    b = F.floor(F.col(order) / F.lit(width))
    own = tl.withColumn("_b", b).withColumn("_own", F.lit(True))
    prev = tl.withColumn("_b", b + 1).withColumn("_own", F.lit(False))
    both = own.unionByName(prev)
    w = Window.partitionBy(*keys, "_b").orderBy(order).rangeBetween(-width, -1)
    out = both.withColumns({f"{prefix}{v}": F.coalesce(F.sum(v).over(w), F.lit(0)) for v in values})
    return out.filter("_own").drop("_b", "_own")
