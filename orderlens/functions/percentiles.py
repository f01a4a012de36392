"""Exact percentiles without bringing a whole group into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of a group's value range; bounds what the running sums see.
BUCKETS = 4096


def value_counts(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, value, n): how often each value occurs in each group, NULLs left out."""
    return (df.select(*keys, F.col(value).cast("double").alias("value")).filter(F.col("value").isNotNull())
            .groupBy(*keys, "value").agg(F.count("*").alias("n")))


def exact_percentile(df: DataFrame, keys: list[str], value: str, fraction: float, buckets: int = BUCKETS,
                     name: str = "percentile") -> DataFrame:
    """Interpolated percentile (SQL ``percentile_cont``) of ``value`` for each group, NULLs ignored."""
    rows = df.select(*keys, F.col(value).cast("double").alias("_value"), F.lit(1).cast("bigint").alias("_n"))
    return _percentile(rows.filter(F.col("_value").isNotNull()), keys, fraction, buckets, name)


def percentile_of_counts(counted: DataFrame, keys: list[str], fraction: float, buckets: int = BUCKETS,
                         name: str = "percentile") -> DataFrame:
    """The same from (keys, value, n)."""
    rows = counted.select(*keys, F.col("value").cast("double").alias("_value"), F.col("n").alias("_n"))
    return _percentile(rows, keys, fraction, buckets, name)


def _same(keys: list[str]) -> Column:
    """Null-safe equality of the keys and their copies ``_k_*``."""
    on = F.lit(True)
    for key in keys:
        on = on & F.col(key).eqNullSafe(F.col(f"_k_{key}"))
    return on


def _percentile(rows: DataFrame, keys: list[str], fraction: float, buckets: int, name: str) -> DataFrame:
    """Histogram first: a group may hold any share of the rows, and its values may all differ.

    The range of each group is cut into ``buckets`` parts and counted with map-side combine, so what is shuffled are
    buckets, not rows. Running counts over a group's buckets tell which one or two hold the wanted ranks; only the values
    of those are counted and put in order.
    """
    copies = [F.col(k).alias(f"_k_{k}") for k in keys]
    ends = rows.groupBy(*keys).agg(F.min("_value").alias("_min"), F.max("_value").alias("_max")).select(
        *copies, "_min", "_max")
    part = F.floor((F.col("_value") - F.col("_min")) / (F.col("_max") - F.col("_min")) * buckets)
    bucket = F.when(F.col("_max") > F.col("_min"), F.least(part, F.lit(buckets - 1))).otherwise(F.lit(0))
    placed = rows.join(ends, _same(keys)).select(*keys, "_value", "_n", bucket.cast("int").alias("_bucket"))

    by_bucket = Window.partitionBy(*keys).orderBy("_bucket")
    position = F.lit(float(fraction)) * (F.col("_total") - 1)
    wanted = (placed.groupBy(*keys, "_bucket").agg(F.sum("_n").alias("_n"))
              .withColumn("_upto", F.sum("_n").over(by_bucket))
              .withColumn("_total", F.sum("_n").over(Window.partitionBy(*keys)))
              .withColumn("_low", F.floor(position)).withColumn("_high", F.ceil(position))
              .filter((F.col("_upto") > F.col("_low")) & (F.col("_upto") - F.col("_n") <= F.col("_high")))
              .select(*copies, F.col("_bucket").alias("_wanted"), (F.col("_upto") - F.col("_n")).alias("_before"),
                      "_low", "_high", (position - F.col("_low")).alias("_weight")))

    inside = Window.partitionBy(*keys, "_bucket").orderBy("_value")
    counted = (placed.join(wanted, _same(keys) & (F.col("_bucket") == F.col("_wanted")))
               .groupBy(*keys, "_bucket", "_value", "_before", "_low", "_high", "_weight").agg(F.sum("_n").alias("_n")))
    ranked = (counted.withColumn("_last", F.col("_before") + F.sum("_n").over(inside) - 1)
              .withColumn("_first", F.col("_last") - F.col("_n") + 1))

    def at(rank: str) -> Column:
        return F.max(F.when((F.col("_first") <= F.col(rank)) & (F.col("_last") >= F.col(rank)), F.col("_value")))

    return (ranked.groupBy(*keys).agg(at("_low").alias("_v_low"), at("_high").alias("_v_high"),
                                      F.max("_weight").alias("_w"))
            .select(*keys, (F.col("_v_low") + (F.col("_v_high") - F.col("_v_low")) * F.col("_w")).alias(name)))
