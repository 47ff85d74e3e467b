"""Exact chronological train / validation / test split.

Rows are ordered by (date, scheduled time) with a unique flight key breaking
ties; the first int(n * train_pct) rows are train, the next int(n * val_pct)
validation, the rest test. Two boundaries say it all, so every row is labelled
by comparing it with them, without a join or a sort of the table:

1. counts per (date, time) slot, and the number of rows in earlier slots by
   the two-level prefix (block = date), give the slot of each boundary and the
   number of its rows that come before (two rows reach the driver);
2. the key at that position of the slot is found by dealing the slot's keys by
   range to as many partitions as their number asks for, counting each, and
   ranking only the one that holds the position. Any key type, any slot size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalar as S
from ..functions.scalar import col
from ..session import stage_table
from . import prefix as P

#: Keys of one range partition while a boundary inside a slot is looked for.
SLOT_KEYS = 100_000


def split_sizes(n: int, train_pct: float, val_pct: float) -> tuple[int, int, int]:
    if n == 0:
        raise ValueError("cannot split an empty dataset")
    if train_pct <= 0 or val_pct <= 0 or train_pct + val_pct >= 1.0:
        raise ValueError(f"invalid split fractions train={train_pct} val={val_pct}")
    n_train, n_val = int(n * train_pct), int(n * val_pct)
    n_test = n - n_train - n_val
    if min(n_train, n_val, n_test) == 0:
        raise ValueError(f"split produced an empty part: {n_train}/{n_val}/{n_test}")
    return n_train, n_val, n_test


def chronological_split(df: DataFrame, key: str = "flight_id", date_col: str = "flight_date",
                        time_col: str | None = "scheduled_dep_time", train_pct: float = 0.70,
                        val_pct: float = 0.15, slot_keys: int = SLOT_KEYS) -> DataFrame:
    """``df`` plus ``split`` in {train, val, test}. Null dates come first, null times last in their date."""
    slot = [date_col] + ([time_col] if time_col and time_col in df.columns else [])
    slots = df.groupBy(*[col(c) for c in slot]).agg(F.count(F.lit(1)).cast("long").alias("_cnt"))
    n = slots.agg(F.sum("_cnt")).first()[0] or 0
    n_train, n_val, _ = split_sizes(int(n), train_pct, val_pct)
    order = [F.col(c).asc_nulls_last() for c in slot[1:]] or [F.lit(1)]
    # rows in earlier slots: running total inside a date + offset over dates
    starts = P.exclusive_prefix(slots, [], order, ["_cnt"], F.col(date_col), prefix="_start")
    bounds = [n_train, n_train + n_val]
    holds = [(F.col("_start_cnt") <= b) & (F.col("_start_cnt") + F.col("_cnt") > b) for b in bounds]
    met = starts.filter(holds[0] | holds[1]).collect()  # the one or two slots of the boundaries
    before = []
    for b in bounds:
        at = next(r for r in met if r["_start_cnt"] <= b < r["_start_cnt"] + r["_cnt"])
        values = [at[c] for c in slot]
        first = _key_at(df, slot, values, key, b - at["_start_cnt"], at["_cnt"], slot_keys)
        before.append(_earlier(slot, values, key, first))
    return df.withColumn("split", F.when(before[0], "train").when(before[1], "val").otherwise("test"))


def _same(slot: list[str], values: list) -> Column:
    out = F.lit(True)
    for c, v in zip(slot, values):
        out = out & col(c).eqNullSafe(F.lit(v))
    return out


def _earlier(slot: list[str], values: list, key: str, first) -> Column:
    """Rows in front of the boundary: an earlier date, an earlier time of its date, or an earlier key of its slot."""
    date, day = col(slot[0]), values[0]
    out = (date.isNull() | (date < F.lit(day))) if day is not None else F.lit(False)
    if len(slot) > 1:
        time, t = col(slot[1]), values[1]
        out = out | (date.eqNullSafe(F.lit(day)) & (time.isNotNull() if t is None else time < F.lit(t)))
    if first is not None:
        out = out | (_same(slot, values) & (col(key) < F.lit(first)))
    return F.coalesce(out, F.lit(False))


def _key_at(df: DataFrame, slot: list[str], values: list, key: str, position: int, size: int, slot_keys: int):
    """Key at a 0-based position of a slot; None for the first, which no key precedes."""
    if position == 0:
        return None
    parts = max(1, -(-size // slot_keys))
    keys = (df.filter(_same(slot, values)).select(col(key).alias("_k")).repartitionByRange(parts, "_k")
            .withColumn("_p", F.spark_partition_id()))
    keys = stage_table(keys, "slot_keys")
    for row in keys.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).orderBy("_p").toLocalIterator():
        if position < row["n"]:
            rank = F.row_number().over(Window.orderBy("_k"))  # one range partition of about slot_keys rows
            return keys.filter(F.col("_p") == row["_p"]).withColumn("_r", rank).filter(F.col("_r") == position + 1).first()["_k"]
        position -= row["n"]
    raise ValueError("the table changed while it was split")


def split_summary(split_df: DataFrame, date_col: str = "flight_date", target: str = "delay_target") -> DataFrame:
    total = F.sum("records").over(Window.partitionBy())   # over the three summary rows
    return (split_df.groupBy("split").agg(
        F.count(F.lit(1)).cast("long").alias("records"),
        F.min(col(date_col)).alias("min_date"), F.max(col(date_col)).alias("max_date"),
        S.round_half_even(F.avg(col(target).cast("double")) * 100, 2).alias("delay_rate_pct"))
        .withColumn("pct", S.round_half_even(F.col("records") * 100.0 / total, 2)))


def split_overlaps(split_df: DataFrame, date_col: str = "flight_date") -> DataFrame:
    """M2 warnings: for train->val and val->test, whether the earlier part's
    last date is later than the next part's first date (one aggregate)."""
    d, s = col(date_col), F.col("split")
    r = split_df.agg(*[F.max(F.when(s == p, d)).alias(f"{p}_max") for p in ("train", "val")],
                     *[F.min(F.when(s == p, d)).alias(f"{p}_min") for p in ("val", "test")])
    return r.select(F.lit("train_val").alias("boundary"), (F.col("train_max") > F.col("val_min")).alias("overlap"),
                    F.col("train_max").alias("left_max"), F.col("val_min").alias("right_min")).unionByName(
        r.select(F.lit("val_test").alias("boundary"), (F.col("val_max") > F.col("test_min")).alias("overlap"),
                 F.col("val_max").alias("left_max"), F.col("test_min").alias("right_min")))
