"""Exact positions in a global order, without a window that sees more than one range.

Rows are dealt into ranges of the order by sampled bounds, sorted inside each
range and written with their range and place. What is counted is one narrow row
a (group, range); its running totals say where each range begins, so

    position(row) = rows of the group in earlier ranges + place inside the range.

Ranges follow the data, not the width of the values: outliers and crowded values
change the bounds, not the sizes. Rows equal in the whole order share a range,
so heavy ties are counted first and ranked once, with ``weight``.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage_table

#: A side of so many narrow rows may be broadcast.
BROADCAST_ROWS = 1_000_000


class Ranked:
    """``rows``: the given columns with _range and _place. ``spans``: one row a (group, range) with the
    number of rows (or weight) _rows, and _before, that of the group's earlier ranges."""

    def __init__(self, rows: DataFrame, spans: DataFrame, group: list[str], weight: str | None):
        self.rows, self.spans, self.group, self.weight = rows, spans, group, weight

    def totals(self) -> DataFrame:
        """(group, _total)."""
        return self.spans.groupBy(*self.group).agg(F.sum("_rows").alias("_total"))

    def _inside(self, value: str | None) -> Column:
        """What precedes a row inside its (group, range)."""
        w = Window.partitionBy(*self.group, "_range").orderBy("_place")
        if value is None:
            return F.col("_place") - F.col("_first")
        return F.coalesce(F.sum(value).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))

    def _met(self, rows: DataFrame, spans: DataFrame) -> DataFrame:
        small = spans.withColumnsRenamed({c: f"_s_{c}" for c in [*self.group, "_range"]})
        if small.count() <= BROADCAST_ROWS:
            small = F.broadcast(small)
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_s_{c}")) for c in self.group],
                    F.col("_range") == F.col("_s__range"))
        return rows.join(small, on).drop(*[f"_s_{c}" for c in [*self.group, "_range"]])

    def with_position(self, name: str = "_pos") -> DataFrame:
        """The rows with their 0-based position in the group (with a weight: the weight of all earlier rows)."""
        met = self._met(self.rows, self.spans)
        return (met.withColumn(name, (F.col("_before") + self._inside(self.weight)).cast("long"))
                .drop("_range", "_place", "_first", "_rows", "_before"))

    def exclusive_prefix(self, values: list[str], prefix: str = "prior_", totals: str | None = None) -> DataFrame:
        """The rows with ``prefix + v`` = sum of v over the group's earlier rows, for every v of ``values``
        (and, with ``totals``, ``totals + v`` = the group's sum)."""
        sums = self.rows.groupBy(*self.group, "_range").agg(*[F.sum(v).alias(f"_b_{v}") for v in values])
        whole = Window.partitionBy(*self.group)
        before = whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
        named = {f"_o_{v}": F.coalesce(F.sum(f"_b_{v}").over(before), F.lit(0)) for v in values}
        if totals is not None:
            named |= {totals + v: F.sum(f"_b_{v}").over(whole) for v in values}
        met = self._met(self.rows, sums.withColumns(named).drop(*[f"_b_{v}" for v in values]))
        done = met.withColumns({prefix + v: F.col(f"_o_{v}") + self._inside(v) for v in values})
        return done.drop("_range", "_place", *[f"_o_{v}" for v in values])

    def at(self, wanted: DataFrame, want: str = "_want") -> DataFrame:
        """For each row of ``wanted`` (group, _want and more): the row of the group that covers position _want.

        Only the ranges that hold a wanted position are read; a wanted position outside the group gives no row.
        """
        named = wanted.withColumnsRenamed({c: f"_w_{c}" for c in self.group})
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in self.group],
                    (F.col(want) >= F.col("_before")) & (F.col(want) < F.col("_before") + F.col("_rows")))
        hit = self.spans.join(F.broadcast(named) if named.count() <= BROADCAST_ROWS else named, on)
        hit = stage_table(hit.drop(*[f"_w_{c}" for c in self.group]), "wanted")
        held = self._met(self.rows, hit.select(*self.group, "_range", "_first", "_before").distinct())
        held = held.withColumn("_from", F.col("_before") + self._inside(self.weight))
        held = held.withColumn("_to", F.col("_from") + (F.col(self.weight) if self.weight else F.lit(1)))
        picks = hit.select(*self.group, "_range", *[c for c in wanted.columns if c not in self.group])
        picks = picks.withColumnsRenamed({c: f"_w_{c}" for c in [*self.group, "_range"]})
        on = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_w_{c}")) for c in [*self.group, "_range"]],
                    (F.col(want) >= F.col("_from")) & (F.col(want) < F.col("_to")))
        return held.join(F.broadcast(picks) if picks.count() <= BROADCAST_ROWS else picks, on).drop(
            *[f"_w_{c}" for c in [*self.group, "_range"]], "_range", "_place", "_first", "_before", "_from", "_to")


def ranked(df: DataFrame, group: list[str], order: list[Column], weight: str | None = None,
           name: str = "ranked", partitions: int | None = None) -> Ranked:
    """Rank ``df`` inside the groups of columns ``group`` (at least one; a null is a group) by the sort columns ``order``.

    ``partitions`` is the number of ranges; without it the session's shuffle partitions, joined where small.
    """
    by = [*[F.col(c).asc_nulls_first() for c in group], *order]
    dealt = df.repartitionByRange(partitions, *by) if partitions else df.repartitionByRange(*by)
    rows = stage_table(dealt.sortWithinPartitions(*by).withColumns({
        "_range": F.spark_partition_id(), "_place": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))}), name)
    size = F.sum(weight) if weight else F.count(F.lit(1))
    spans = rows.groupBy(*group, "_range").agg(F.min("_place").alias("_first"), size.cast("long").alias("_rows"))
    before = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    spans = spans.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0)))
    return Ranked(rows, stage_table(spans, f"{name}_spans"), group, weight)
