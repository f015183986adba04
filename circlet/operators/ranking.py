"""Row numbers over whole tables and whole groups, without a window that sorts a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from circlet.durable import materialize

_LOW = (1 << 33) - 1  # part of a monotonically increasing id that counts rows of a partition


def numbered(table: DataFrame, order: list[Column | str], name: str) -> DataFrame:
    """Adds the row number (from 1) of the whole table in ``order``.

    Ranges of the order go to tasks, each sorts its own, and what a task counts starts after the rows of the ranges before
    it. The only ordered window runs over one row for each range.
    """
    at = "_at"
    placed = materialize(table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(at, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(at, 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    number = F.col("_before") + F.col(at).bitwiseAND(F.lit(_LOW)) + 1
    return placed.join(F.broadcast(offsets), part == F.col("_part")).withColumn(name, number).drop(at, "_part", "_before")


def numbered_in_groups(table: DataFrame, groups: list[str], order: list[Column | str], name: str) -> DataFrame:
    """Adds the row number (from 1) in each group: the number in the table less that before the group's first row.

    A group of any size spreads over the ranges; the first numbers are one row for each group. Null groups are groups.
    """
    whole = numbered(table, [*groups, *order], name)
    firsts = whole.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]).agg((F.min(name) - 1).alias("_first"))
    same = [F.col(g).eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(groups)]
    condition = same[0]
    for other in same[1:]:
        condition = condition & other
    return whole.join(firsts, condition).withColumn(name, (F.col(name) - F.col("_first")).cast("int")).select(*table.columns, name)


def last_known(table: DataFrame, order: list[Column | str], value: str, out: str) -> DataFrame:
    """Adds the last value that is not null at or before each row, in the order of the whole table.

    Ranges of the order go to tasks. What a range begins with comes from the ones before it, through one row for each range.
    """
    placed = materialize(table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "carried")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    inside = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, W.currentRow)
    known = F.col(value).isNotNull()
    ends = placed.groupBy("_part").agg(F.max_by(F.when(known, F.col(value)), F.when(known, F.col("_at"))).alias("_end"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = ends.select(F.col("_part").alias("_p"), F.last("_end", ignorenulls=True).over(before).alias("_carry"))
    local = F.last(value, ignorenulls=True).over(inside)
    both = placed.withColumn("_local", local).join(F.broadcast(carried), F.col("_part") == F.col("_p"))
    return both.withColumn(out, F.coalesce("_local", "_carry")).drop("_at", "_part", "_p", "_local", "_carry")


def running_max(table: DataFrame, order: list[Column | str], value: str, out: str) -> DataFrame:
    """Adds the largest value before each row in the order of the whole table (null at the first), by ranges as ``last_known``."""
    placed = materialize(table.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id()), "carried")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    inside = W.partitionBy("_part").orderBy("_at").rowsBetween(W.unboundedPreceding, -1)
    tops = placed.groupBy("_part").agg(F.max(value).alias("_top"))
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    carried = tops.select(F.col("_part").alias("_p"), F.max("_top").over(before).alias("_carry"))
    both = placed.withColumn("_local", F.max(value).over(inside)).join(F.broadcast(carried), F.col("_part") == F.col("_p"))
    return both.withColumn(out, F.greatest("_local", "_carry")).drop("_at", "_part", "_p", "_local", "_carry")
