"""Ranks, running totals and exact quantiles for groups of any size.

``Window.partitionBy(group)`` sorts a whole group in one task.  When one group
may hold a third of the rows this does not scale, so positions are derived from
a range-partitioned sort: rows are spread by (group, order columns), numbered
inside each range partition, and the per-partition totals (one row per group
and partition) give the offsets.  The sorted rows are written once, which also
freezes the partition numbers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roispark.session import materialize


TASK_LIMIT = 100


def ranked(df: DataFrame, keys: list[str], order: list[Column | str],
           rank: str = "rn", total: str | None = "n") -> DataFrame:
    """Add the 1-based position of each row in its group and the group size.

    ``order`` should be unique inside a group: it makes the result repeatable
    and lets the range partitioner split a group that holds one hot value.
    """
    columns = [F.col(k) for k in keys] + [F.col(o) if isinstance(o, str) else o for o in order]
    placed = materialize(
        df.repartitionByRange(*columns)
        .sortWithinPartitions(*columns)
        .withColumn("_row", F.monotonically_increasing_id())
    ).withColumn("_part", F.shiftright("_row", 33))
    pieces = placed.groupBy(*keys, "_part").agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    per_group = Window.partitionBy(*keys)
    before = F.sum("_size").over(
        per_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    # At most one row per group and range partition.  Written, so that its true size
    # decides whether the sorted rows must be shuffled once more for this join.
    offsets = materialize(pieces.select(
        *keys, "_part",
        (F.coalesce(before, F.lit(0)) - F.col("_first") + 1).alias("_shift"),
        F.sum("_size").over(per_group).alias("_total"),
    ))
    out = placed.join(offsets, [*keys, "_part"]).withColumn(rank, F.col("_row") + F.col("_shift"))
    if total:
        out = out.withColumn(total, F.col("_total"))
    return out.drop("_row", "_part", "_shift", "_total")


def first_rows(df: DataFrame, groups: list[str], order: list[str], size: int,
               salts: int = 256) -> DataFrame:
    """The first ``size`` rows of each group in ``order`` (unique inside a group).

    For a small ``size`` Spark itself limits every group inside each task before the
    shuffle.  A larger one is taken in two levels, the best of every salted
    sub-group first, so that the last step sees ``salts * size`` rows at most.
    """
    salted = df.withColumn("_salt", F.pmod(F.hash(*order), F.lit(salts)))
    for partition in ([groups] if size <= TASK_LIMIT else ([*groups, "_salt"], groups)):
        rank = F.row_number().over(Window.partitionBy(*partition).orderBy(*order))
        salted = salted.withColumn("_rank", rank).where(F.col("_rank") <= size).drop("_rank")
    return salted.drop("_salt")


def value_positions(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Distinct values with multiplicity and position: ``(keys, value, times, below, n)``.

    ``below`` counts the rows of the group with a smaller value.  Equal values
    collapse in the map-side combine, so a hot value costs one row.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("times"))
    placed = materialize(
        counts.repartitionByRange(*[F.col(k) for k in keys], F.col(value))
        .withColumn("_part", F.spark_partition_id()))
    per_group = Window.partitionBy(*keys)
    pieces = placed.groupBy(*keys, "_part").agg(F.sum("times").alias("_size"))
    offsets = pieces.select(
        *keys, "_part",
        F.coalesce(F.sum("_size").over(
            per_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)).alias("_before"),
        F.sum("_size").over(per_group).alias("n"),
    )
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(
        Window.unboundedPreceding, -1)
    return (
        placed.withColumn("_inside", F.coalesce(F.sum("times").over(inside), F.lit(0)))
        .join(offsets, [*keys, "_part"])
        .select(*keys, value, "times", (F.col("_before") + F.col("_inside")).alias("below"), "n")
    )


def running_totals(df: DataFrame, keys: list[str], value: str, counts: list[str]) -> DataFrame:
    """``df`` (one row per ``keys`` and ``value``) with ``<count>_below``: the sums over smaller values of the group.

    As in ``value_positions``, a group is spread over range partitions and their totals give the offsets.
    """
    order = [F.col(k) for k in keys] + [F.col(value)]
    placed = materialize(df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()))
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = placed.groupBy(*keys, "_part").agg(*[F.sum(c).alias(f"_all_{c}") for c in counts]).select(
        *keys, "_part", *[F.coalesce(F.sum(f"_all_{c}").over(before), F.lit(0)).alias(f"_before_{c}") for c in counts])
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    within = placed.select("*", *[F.coalesce(F.sum(c).over(inside), F.lit(0)).alias(f"_inside_{c}") for c in counts])
    return within.join(pieces, [*keys, "_part"]).select(
        *df.columns, *[(F.col(f"_before_{c}") + F.col(f"_inside_{c}")).alias(f"{c}_below") for c in counts])


def quantile_columns(value: str, probs: dict[str, float | Column]) -> list[Column]:
    """Aggregates over ``value_positions`` rows: exact linear-interpolation quantiles.

    The value at 0-based position i is the largest value with ``below <= i``.
    """
    out = []
    for name, p in probs.items():
        p = F.lit(p) if isinstance(p, (int, float)) else p
        position = (F.col("n") - 1) * p
        low = F.max(F.when(F.col("below") <= F.floor(position), F.col(value)))
        high = F.max(F.when(F.col("below") <= F.ceil(position), F.col(value)))
        share = F.max(position - F.floor(position))
        out.append((low + (high - low) * share).alias(name))
    return out


def group_quantiles(df: DataFrame, keys: list[str], value: str,
                    probs: dict[str, float]) -> DataFrame:
    """One row per group with an exact quantile column per entry of ``probs``."""
    clean = df.where(F.col(value).isNotNull() & ~F.isnan(value))
    return value_positions(clean, keys, value).groupBy(*keys).agg(*quantile_columns(value, probs))
