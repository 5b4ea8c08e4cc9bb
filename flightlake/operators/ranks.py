"""Running totals, dense keys and exact quantiles without a one-task window."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flightlake.session import staged


def running_totals(df: DataFrame, order: str, weights: list[str], name: str) -> DataFrame:
    """Add `<weight>_before`: the sum of `weight` over all rows with a smaller `order`.

    `order` must be distinct (aggregate first).  Rows are range-partitioned and
    written with their partition number; a second pass adds each partition's
    offset, a table with one row per partition.
    """
    part = "_part"
    saved = staged(
        df.repartitionByRange(order).withColumn(part, F.spark_partition_id()), name
    )
    sums = saved.groupBy(part).agg(*[F.sum(w).alias(w) for w in weights])
    ahead = Window.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        part, *[F.coalesce(F.sum(w).over(ahead), F.lit(0)).alias(f"_{w}") for w in weights]
    )
    inside = Window.partitionBy(part).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = {
        f"{w}_before": F.coalesce(F.sum(w).over(inside), F.lit(0)) + F.col(f"_{w}")
        for w in weights
    }
    # at most one offset row per shuffle partition
    joined = saved.join(F.broadcast(offsets), part)
    return joined.withColumns(before).drop(part, *[f"_{w}" for w in weights])


def exact_quantiles(df: DataFrame, value: str, shares: dict[str, float], name: str) -> DataFrame:
    """One row of interpolated quantiles, exact for any number of distinct values.

    `percentile` keeps every distinct value of a group in one buffer; that is
    fine for whole minutes but not for model errors.  Here the value/count
    histogram stays distributed and each quantile picks the rows at its rank.
    """
    return weighted_quantiles(df.withColumn("_one", F.lit(1)), value, "_one", shares, name)


def weighted_quantiles(df: DataFrame, value: str, weight: str, shares: dict[str, float], name: str) -> DataFrame:
    """`exact_quantiles` where a row stands for `weight` rows."""
    histogram = df.filter(F.col(value).isNotNull()).groupBy(value).agg(F.sum(weight).alias("rows"))
    ranked = running_totals(histogram, value, ["rows"], name)
    total = ranked.agg(F.sum("rows")).first()[0] or 0
    picks, results = [], []
    for label, share in shares.items():
        position = share * max(total - 1, 0)
        low = int(position)
        high = min(low + 1, max(total - 1, 0))
        for tag, rank in (("low", low), ("high", high)):
            holds = (F.col("rows_before") <= rank) & (F.col("rows_before") + F.col("rows") > rank)
            picks.append(F.max(F.when(holds, F.col(value))).alias(f"{label}_{tag}"))
        gap = F.col(f"{label}_high") - F.col(f"{label}_low")
        results.append((F.col(f"{label}_low") + gap * (position - low)).alias(label))
    return ranked.agg(*picks).select(*results)


def grouped_medians(histogram: DataFrame, keys: list[str], value: str, weight: str, result: str, name: str) -> DataFrame:
    """(keys, result): the interpolated median of each group of a (keys, value, weight) histogram.

    Exact for any number of distinct values, with no buffer of a group's values.  The histogram
    is range-partitioned by keys and value, so a hot group lies over many tasks, and written with
    its partition number.  A piece is a group's part in one partition; the rows of the pieces say
    which of them hold a middle rank, and only those are ranked.  Null values are left out, null
    keys are a group; a group without values has no row.
    """
    part, rows = "_part", F.col("_rows")
    counted = histogram.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("_rows"))
    saved = staged(counted.repartitionByRange(*keys, value).withColumn(part, F.spark_partition_id()), name)
    group = Window.partitionBy(*keys)
    ahead = group.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    pieces = saved.groupBy(*keys, part).agg(F.sum(rows).alias("_piece")).withColumns(
        {"_before": F.coalesce(F.sum("_piece").over(ahead), F.lit(0)), "_total": F.sum("_piece").over(group)}
    )
    low, high = F.expr("(_total - 1) div 2"), F.expr("_total div 2")

    def holds(rank: Column, before: Column, size: Column) -> Column:
        return (before <= rank) & (rank < before + size)

    middle = pieces.filter(reduce(lambda a, b: a | b, [holds(r, F.col("_before"), F.col("_piece")) for r in (low, high)]))
    named = staged(middle.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(part).alias("_in"), "_before", "_total"), f"{name}_pieces")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys], F.col(part) == F.col("_in"))
    inside = Window.partitionBy(*keys, part).orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    place = F.col("_before") + F.coalesce(F.sum(rows).over(inside), F.lit(0))
    ranked = saved.join(named, same).withColumn("_place", place)
    at = [F.max(F.when(holds(r, F.col("_place"), rows), F.col(value).cast("double"))) for r in (low, high)]
    return ranked.groupBy(*keys).agg(((at[0] + at[1]) / 2).alias(result))


def dense_keys(table: DataFrame, row_id: str, key: str, after: int = 0) -> tuple[DataFrame, int]:
    """Rows of a table written in order, with a dense `key` from after + 1, and how many they are.

    `row_id` was stored by `monotonically_increasing_id` at the sorted write: the task in its high
    bits, the position in its low 33.  A key is the position plus the rows of the tasks before it.
    No row is shuffled: the offsets have one row per task of that write and are broadcast as such.
    """
    task = F.shiftrightunsigned(row_id, 33)
    counts = table.groupBy(task.alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = staged(counts.withColumn("_offset", F.coalesce(F.sum("_rows").over(ahead), F.lit(0))), "task_offsets")
    place = F.col(row_id).bitwiseAND(F.lit((1 << 33) - 1))
    keyed = table.join(F.broadcast(offsets.select("_task", "_offset")), task == F.col("_task"))
    rows = offsets.agg(F.coalesce(F.sum("_rows"), F.lit(0))).first()[0]
    return keyed.withColumn(key, F.col("_offset") + place + after + 1).drop("_task", "_offset", row_id), rows
