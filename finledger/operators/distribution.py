"""Exact quantiles and ranks inside groups of any size.

Spark's ``percentile`` keeps a group's values in one task, and a ranking window sorts a group in one task. Here a group is
reduced to its distinct values with counts, and these are sorted across all tasks by range partitioning, so a large group
spans many of them. The rows and values before each part of a group follow from the sizes of its parts; a rank or a
quantile then only looks inside a part. There is one way for every size, and missing values keep their rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from finledger.session import materialise


def _same(left: str, right: str, keys: list[str]) -> Column:
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(f"{left}.{key}").eqNullSafe(F.col(f"{right}.{key}"))
    return condition


def _attach(df: DataFrame, small: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Join on keys that may be NULL; columns of ``small`` that are not keys are added."""
    added = [c for c in small.columns if c not in keys]
    joined = df.alias("l").join(small.alias("r"), _same("l", "r", keys), how)
    return joined.select("l.*", *[F.col(f"r.{c}") for c in added])


def _sorted_values(df: DataFrame, keys: list[str], value: str) -> tuple[DataFrame, DataFrame]:
    """Distinct values with counts (``_n``) by part (``_part``), and for each part of a group the rows and values before
    it and in the whole group. NULL is the lowest value. A group has at most as many parts as there are tasks."""
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("_n"))
    ordered = counted.repartitionByRange(*keys, value).withColumn("_part", F.spark_partition_id())
    placed = materialise(ordered, "sorted_values")
    whole = Window.partitionBy(*keys)
    before = whole.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*keys, "_part").agg(F.sum("_n").alias("_rows"), F.count("*").alias("_distinct"))
    sizes = sizes.withColumns(
        {
            "_rows_before": F.coalesce(F.sum("_rows").over(before), F.lit(0)),
            "_values_before": F.coalesce(F.sum("_distinct").over(before), F.lit(0)),
            "_total": F.sum("_rows").over(whole),
            "_values": F.sum("_distinct").over(whole),
        }
    )
    return placed, sizes


def group_quantiles(df: DataFrame, keys: list[str], value: str, wanted: dict[str, float]) -> DataFrame:
    """Continuous quantiles (linear interpolation) of ``value`` per group; ``wanted`` maps output name to probability.

    Missing values do not count; a group without values has no row. Only the parts that hold a wanted position are
    looked into.
    """
    placed, sizes = _sorted_values(df.filter(F.col(value).isNotNull()), keys, value)
    positions = {name: p * (F.col("_total") - 1) for name, p in wanted.items()}
    end = F.col("_rows_before") + F.col("_rows")
    hit = F.lit(False)
    for position in positions.values():
        for index in (F.floor(position), F.ceil(position)):
            hit = hit | ((F.col("_rows_before") <= index) & (index < end))
    chosen = sizes.filter(hit).select(*keys, "_part", "_rows_before", "_total")
    inside = Window.partitionBy(*keys, "_part").orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = _attach(placed, chosen, [*keys, "_part"]).withColumn(
        "_last", F.col("_rows_before") + F.sum("_n").over(inside) - 1
    )
    first = F.col("_last") - F.col("_n") + 1

    def at(index: Column) -> Column:
        return F.max(F.when((first <= index) & (index <= F.col("_last")), F.col(value)))

    picks = []
    for name, position in positions.items():
        picks += [at(F.floor(position)).alias(f"_lo_{name}"), at(F.ceil(position)).alias(f"_hi_{name}")]
    ends = ranked.groupBy(*keys, "_total").agg(*picks)
    return ends.select(
        *keys,
        *[
            (
                F.col(f"_lo_{name}")
                + (F.col(f"_hi_{name}") - F.col(f"_lo_{name}")) * (positions[name] - F.floor(positions[name]))
            ).alias(name)
            for name in wanted
        ],
    )


def group_median(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    return group_quantiles(df, keys, value, {name: 0.5})


def group_ranks(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Adds ``_dense_desc`` (dense rank, highest first) and ``_percent`` (percent rank, lowest first) per group.

    Missing values are last from above and first from below, as in a ranking window.
    """
    placed, sizes = _sorted_values(df, keys, value)
    inside = Window.partitionBy(*keys, "_part").orderBy(F.col(value).asc_nulls_first())
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("_rows_before") + F.coalesce(F.sum("_n").over(before), F.lit(0))
    ranked = _attach(placed, sizes, [*keys, "_part"]).select(
        *keys,
        value,
        (F.col("_values") - F.col("_values_before") - F.row_number().over(inside) + 1).cast("int").alias("_dense_desc"),
        F.when(F.col("_total") > 1, below / (F.col("_total") - 1)).otherwise(0.0).alias("_percent"),
    )
    return _attach(df, ranked, [*keys, value])


def group_positions(df: DataFrame, keys: list[str], order: list[str], name: str, top: int | None = None) -> DataFrame:
    """Adds the position of a row in its group (1 first) by ``order``, ascending; up to ``top`` where it is given.

    The rows themselves are range partitioned, so a large group is sorted by many tasks.
    """
    ordered = df.repartitionByRange(*keys, *order).withColumn("_part", F.spark_partition_id())
    placed = materialise(ordered, "positions")
    before = Window.partitionBy(*keys).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(*keys, "_part").agg(F.count("*").alias("_rows"))
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")
    inside = Window.partitionBy(*keys, "_part").orderBy(*order)
    position = (F.col("_before") + F.row_number().over(inside)).cast("int")
    numbered = _attach(placed, sizes, [*keys, "_part"]).withColumn(name, position).drop("_part", "_before")
    return numbered if top is None else numbered.filter(F.col(name) <= top)


def describe_group(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Count, mean, standard deviation, extremes and quartiles per group."""
    moments = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.count(value).alias("N"),
        F.avg(value).alias("MEDIA"),
        F.stddev_samp(value).alias("DESVIO"),
        F.min(value).alias("MINIMO"),
        F.max(value).alias("MAXIMO"),
    )
    quartiles = group_quantiles(df, keys, value, {"P25": 0.25, "P50": 0.5, "P75": 0.75})
    return _attach(moments, quartiles, keys)


def fractional_rank(df: DataFrame, keys: list[str], value: str, name: str) -> DataFrame:
    """Average rank of a value divided by the number of values of its group; NULL stays NULL.

    For summary tables: a group holds a row per sector.
    """
    present = Window.partitionBy(*keys, F.col(value).isNotNull())
    ties = Window.partitionBy(*keys, value)
    average = F.rank().over(present.orderBy(value)) + (F.count("*").over(ties) - 1) / F.lit(2.0)
    return df.withColumn(name, F.when(F.col(value).isNotNull(), average / F.count("*").over(present)))


def clip_to_quantiles(df: DataFrame, keys: list[str], value: str, name: str, low: float, high: float) -> DataFrame:
    """``value`` limited to its group's low and high quantile, under a new name."""
    bounds = group_quantiles(df, keys, value, {"_lo": low, "_hi": high})
    joined = _attach(df, bounds, keys, "left")
    clipped = F.when(F.col(value).isNotNull(), F.least(F.greatest(value, "_lo"), F.col("_hi")))
    return joined.withColumn(name, clipped).drop("_lo", "_hi")
