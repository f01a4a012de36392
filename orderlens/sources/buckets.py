"""The fact laid out in buckets by order id: order grain and joins on orders need no shuffle of items.

Every bucket is one file in order of order id, so ``groupBy("order_id", ...)`` finds an order's items in one task already.
Use it where most reports go to order grain; for date filters that should skip files the layout by months (``write_star``) is
the better one. A bucket is read by one task, so an order that holds a large share of all items belongs in the other layout.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from orderlens.sources.star import Star, write_dimensions

BUCKETS, KEY = 64, "order_id"


def _table(folder: str) -> str:
    """The name of the folder's fact in the session's catalogue."""
    return f"fact_orders_{hashlib.sha256(folder.encode()).hexdigest()[:16]}"


def write_bucketed_star(star: Star, folder: str, buckets: int = BUCKETS) -> None:
    """Dimensions as they are, the fact in ``buckets`` files by order id. ``folder`` is new."""
    write_dimensions(star, folder)
    fact = star.fact_orders
    (fact.repartition(buckets, KEY).write.bucketBy(buckets, KEY).sortBy(KEY).option("path", f"{folder}/fact_orders")
     .saveAsTable(_table(folder)))
    fact.sparkSession.createDataFrame([(buckets, fact.schema.simpleString()[7:-1])], "buckets int, columns string").coalesce(
        1).write.json(f"{folder}/layout")


def open_bucketed_star(spark: SparkSession, folder: str) -> Star:
    """The star in that layout, also in another session than the one that wrote it."""
    def fact() -> DataFrame:
        name = _table(folder)
        if not spark.catalog.tableExists(name):
            layout = spark.read.schema("buckets int, columns string").json(f"{folder}/layout").first()
            spark.sql(f"CREATE TABLE {name} ({layout['columns'].replace(':', ' ')}) USING parquet CLUSTERED BY ({KEY}) "
                      f"SORTED BY ({KEY}) INTO {layout['buckets']} BUCKETS LOCATION '{folder}/fact_orders'")
        return spark.table(name)

    return Star({name: (lambda n=name: spark.read.parquet(f"{folder}/{n}")) for name in Star.NAMES} | {"fact_orders": fact})
