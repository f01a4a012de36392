"""Profiles and data-quality checks. Every check is a small report; a suite collects them with their verdicts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.measures import count_where
from orderlens.schemas import STAR_KEYS
from orderlens.sources.star import Star


def _stack(frames: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


# ---------------------------------------------------------------- profiles


def null_profile(df: DataFrame, table: str) -> DataFrame:
    """One row per column that has NULLs, or a single row without a column name; one pass whatever the width."""
    names = df.columns
    counted = df.agg(F.count("*").alias("rows"),
                     *[count_where(F.col(f"`{c}`").isNull()).alias(f"n{i}") for i, c in enumerate(names)])
    entries = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"n{i}").alias("nulls"))
                        for i, c in enumerate(names)])
    found = F.filter(entries, lambda e: e["nulls"] > 0)
    none = F.array(F.struct(F.lit(None).cast("string").alias("column_name"), F.lit(0).cast("bigint").alias("nulls")))
    return counted.select(F.lit(table).alias("table_name"), F.col("rows").alias("row_count"),
                          F.lit(len(names)).alias("column_count"),
                          F.inline(F.when(F.size(found) > 0, found).otherwise(none)))


def sample_rows(df: DataFrame, n: int = 3, order: list[str] | None = None) -> DataFrame:
    """A few rows to look at: the first by ``order``, or any."""
    return df.orderBy(*order).limit(n) if order else df.limit(n)


def row_counts(tables: dict[str, DataFrame], total: str | None = "TOTAL") -> DataFrame:
    """Rows of every table, and their sum."""
    counts = _stack([df.agg(F.count("*").alias("n")).select(F.lit(name).alias("table_name"), "n")
                     for name, df in tables.items()])
    if total is None:
        return counts
    return counts.rollup("table_name").agg(F.sum("n").alias("n")).select(
        F.coalesce("table_name", F.lit(total)).alias("table_name"), "n")


def duplicate_profile(df: DataFrame, keys: list[str], table: str) -> DataFrame:
    """Rows of a table and rows beyond the first of their key (NULL keys are equal to each other)."""
    groups = df.groupBy(*keys).agg(F.count("*").alias("n"))
    return groups.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"),
                      F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicate_rows")).select(
        F.lit(table).alias("table_name"), F.lit(",".join(keys)).alias("key_columns"), "row_count", "duplicate_rows")


def duplicate_profiles(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    return _stack([duplicate_profile(df, keys, name) for name, (df, keys) in tables.items()])


def join_inflation(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """How many rows a left join would add, without building it: matches are counted per key on the right first."""
    counts = right.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("matches"))
    joined = left.select(key).groupBy(key).agg(F.count("*").alias("rows")).join(counts, key, "left")
    sums = joined.agg(F.sum("rows").alias("left_rows"),
                      F.sum(F.col("rows") * F.coalesce("matches", F.lit(1))).alias("joined_rows"))
    return sums.select("left_rows", "joined_rows", (F.col("joined_rows") - F.col("left_rows")).alias("inflation"))


def with_payment_totals(orders: DataFrame, payments: DataFrame) -> DataFrame:
    """Orders with payment sum and count; payments are aggregated first, so the join cannot add rows."""
    totals = payments.groupBy("order_id").agg(F.sum("payment_value").alias("payment_total"),
                                              F.count("payment_sequential").alias("n_payments"))
    return orders.join(totals, "order_id", "left")


# ---------------------------------------------------------------- checks on the star


def row_count_check(star: Star, expected: dict[str, int | Column | None]) -> DataFrame:
    """(table_name, n, expected, ok). A number, or a scalar of the plan; ``None`` expects only that the table is not
    empty."""
    counts = row_counts({name: star.tables()[name] for name in expected}, total=None)
    wanted = F.create_map(*[v for name, n in expected.items()
                            for v in (F.lit(name), F.lit(-1 if n is None else n).cast("bigint"))])
    with_wanted = counts.withColumn("w", wanted[F.col("table_name")].cast("bigint"))
    return with_wanted.select("table_name", "n", F.when(F.col("w") >= 0, F.col("w")).alias("expected"),
                              F.when(F.col("w") >= 0, F.col("n") == F.col("w")).otherwise(F.col("n") > 0).alias("ok"))


def _outside(first_day: str, end_day: str) -> Column:
    ts = F.col("purchase_ts")
    return (ts < F.lit(first_day).cast("timestamp_ntz")) | (ts >= F.lit(end_day).cast("timestamp_ntz"))


def _null_keys() -> list[Column]:
    return [count_where(F.col("purchase_ts").isNull()).alias("null_ts"),
            count_where(F.col("price").isNull()).alias("null_price"),
            count_where(F.col("customer_id").isNull()).alias("null_cust"),
            count_where(F.col("customer_delivery_ts").isNotNull() & F.col("delivery_days").isNull())
            .alias("delivered_wo_days")]


def _impossible(slow_days: int) -> list[Column]:
    days = F.col("delivery_days")
    return [count_where(days < 0).alias("negative_days"),
            count_where(days > slow_days).alias(f"slow_over_{slow_days}d_info")]


def date_range(star: Star, first_day: str, end_day: str) -> DataFrame:
    """First and last purchase day and the items bought outside [first_day, end_day)."""
    ts = F.col("purchase_ts")
    return star.fact_orders.agg(F.min(ts).cast("date").alias("min_d"), F.max(ts).cast("date").alias("max_d"),
                                count_where(_outside(first_day, end_day)).alias("out_of_range"))


def null_keys(star: Star) -> DataFrame:
    return star.fact_orders.agg(*_null_keys())


def impossible_values(star: Star, slow_days: int = 90) -> DataFrame:
    return star.fact_orders.agg(*_impossible(slow_days))


def duplicate_keys(star: Star) -> DataFrame:
    """Number of key values that occur more than once, for five tables."""
    names = {"fact_orders": "dup_fact", "dim_customers": "dup_cust", "dim_products": "dup_prod",
             "dim_reviews": "dup_rev", "dim_date": "dup_dt"}
    counts = {alias: star.tables()[name].groupBy(*STAR_KEYS[name]).agg(F.count("*").alias("n"))
              .agg(count_where(F.col("n") > 1)).scalar() for name, alias in names.items()}
    spark = star.fact_orders.sparkSession
    return spark.range(1).select(*[value.alias(alias) for alias, value in counts.items()])


def orphans(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child rows without a parent. The child's keys are counted first, so a hot key is one row in the join."""
    keys = child.groupBy(F.col(key).alias("k")).agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_key or key).alias("k"))
    return keys.join(parents, "k", "left_anti").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("orphans"))


def referential_integrity(star: Star) -> DataFrame:
    """Items whose customer, product or seller is unknown. One read of the fact: its foreign keys are counted together,
    each marked with its kind, and meet the keys of all three parents in one join."""
    pairs = {"orphan_cust": (star.dim_customers, "customer_id"), "orphan_prod": (star.dim_products, "product_id"),
             "orphan_sell": (star.dim_sellers, "seller_id")}
    marked = F.array(*[F.struct(F.lit(alias).alias("kind"), F.col(key).cast("string").alias("k"))
                       for alias, (_, key) in pairs.items()])
    keys = star.fact_orders.select(F.inline(marked)).groupBy("kind", "k").agg(F.count("*").alias("n"))
    parents = _stack([parent.select(F.lit(alias).alias("kind"), F.col(key).cast("string").alias("k"))
                      for alias, (parent, key) in pairs.items()])
    orphaned = keys.join(parents, ["kind", "k"], "left_anti")
    return orphaned.agg(*[F.coalesce(F.sum(F.when(F.col("kind") == alias, F.col("n"))), F.lit(0)).alias(alias)
                          for alias in pairs])


def join_cardinality(star: Star, items: DataFrame) -> DataFrame:
    """The fact must have exactly the rows of the item table: no fan-out, no orphan items."""
    counts = row_counts({"fact_orders": star.fact_orders, "order_items": items}, total=None)
    fact, source = F.col("table_name") == "fact_orders", F.col("table_name") == "order_items"
    return counts.agg(F.sum(F.when(fact, F.col("n"))).alias("fact_rows"),
                      F.sum(F.when(source, F.col("n"))).alias("item_rows")).withColumn(
        "ok", F.col("fact_rows") == F.col("item_rows"))


def _metrics(report: DataFrame, checks: dict[str, dict[str, int | None]], more: list[Column] | None = None) -> DataFrame:
    """A one-row report as (check_name, metric, value, expected, ok); ``None`` marks a metric that is only shown. ``more``
    are further rows as structs."""
    rows = (more or []) + [F.struct(F.lit(check).alias("check_name"), F.lit(metric).alias("metric"),
                     F.col(metric).cast("bigint").alias("value"), F.lit(want).cast("bigint").alias("expected"),
                     (F.lit(True) if want is None else F.col(metric) == F.lit(want)).alias("ok"))
            for check, expected in checks.items() for metric, want in expected.items()]
    return report.select(F.inline(F.array(*rows)))


def _zero(*metrics: str) -> dict[str, int | None]:
    return dict.fromkeys(metrics, 0)


def row_wise_metrics(first_day: str, end_day: str) -> list[Column]:
    """Count and row-wise checks of the fact as aggregates, for one pass over it."""
    return [F.count(F.lit(1)).alias("fact_orders"), count_where(_outside(first_day, end_day)).alias("out_of_range"),
            *_null_keys(), *_impossible(90)]


def check_suite(star: Star, expected_rows: dict[str, int | None], first_day: str, end_day: str,
                items: DataFrame | None = None, measured: DataFrame | None = None) -> DataFrame:
    """All checks as one table: (check_name, metric, value, expected, ok).

    The fact is read three times: for its count and all row-wise checks, for its keys, and for its foreign keys. ``measured``
    is the one row of ``row_wise_metrics`` where those are known already, and the first of these reads is saved.
    """
    others = {name: n for name, n in expected_rows.items() if name != "fact_orders"}
    counts = [row_count_check(star, others).select(
        F.lit("row counts").alias("check_name"), F.col("table_name").alias("metric"), F.col("n").alias("value"),
        "expected", "ok")] if others else []
    row_wise = star.fact_orders.agg(*row_wise_metrics(first_day, end_day)) if measured is None else measured
    checks = {"date range": _zero("out_of_range"),
              "nulls in key columns": _zero("null_ts", "null_price", "null_cust", "delivered_wo_days"),
              "delivery days": {"negative_days": 0, "slow_over_90d_info": None}}
    if items is not None:
        row_wise = row_wise.withColumn("missing_or_extra", F.col("fact_orders") - items.agg(F.count("*")).scalar())
        checks["join cardinality"] = _zero("missing_or_extra")
    wanted = expected_rows.get("fact_orders")
    size = F.col("fact_orders")
    fact_row = F.struct(F.lit("row counts").alias("check_name"), F.lit("fact_orders").alias("metric"),
                        size.alias("value"), F.lit(wanted).cast("bigint").alias("expected"),
                        (size > 0 if wanted is None else size == F.lit(wanted)).alias("ok"))
    parts = [
        *counts,
        _metrics(row_wise, checks, [fact_row] if "fact_orders" in expected_rows else []),
        _metrics(duplicate_keys(star), {"duplicate keys": _zero("dup_fact", "dup_cust", "dup_prod", "dup_rev", "dup_dt")}),
        _metrics(referential_integrity(star),
                 {"referential integrity": _zero("orphan_cust", "orphan_prod", "orphan_sell")}),
    ]
    return _stack(parts)


def verdict(suite: DataFrame) -> DataFrame:
    """PASS or FAIL of every check, and of all of them."""
    checks = suite.rollup("check_name").agg(F.bool_and("ok").alias("ok"))
    return checks.select(F.coalesce("check_name", F.lit("ALL")).alias("check_name"),
                         F.when(F.col("ok"), "PASS").otherwise("FAIL").alias("result"))


# ---------------------------------------------------------------- checks on training data


def forbidden_features(features: list[str], forbidden: set[str]) -> None:
    """Refuses features that are known only after the purchase."""
    leaked = sorted(set(features) & forbidden)
    if leaked:
        raise ValueError(f"features known only after the purchase: {', '.join(leaked)}")


def class_balance(labelled: DataFrame, label: str = "is_late") -> DataFrame:
    """Rows, late rows, late share in percent and whether accuracy alone would mislead (not between 1 and 50 percent)."""
    counts = labelled.agg(F.count("*").alias("n"), F.sum(F.col(label).cast("bigint")).alias("late"))
    rate = F.try_divide(F.lit(100.0) * F.col("late").cast("double"), F.col("n").cast("double"))
    return counts.select("n", "late", F.round(rate, 1).alias("late_rate_pct"),
                         (~((rate > 1) & (rate < 50))).alias("imbalanced"))
