"""The star schema as a set of DataFrames, and its Parquet layout."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.schemas import STAR
from orderlens.session import shuffles_removed


class Frames(Mapping[str, DataFrame]):
    """Named DataFrames, each made when it is first asked for: a report plans only the tables it reads."""

    def __init__(self, makers: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._makers, self._made = dict(makers), {}

    def __getitem__(self, name: str) -> DataFrame:
        if name not in self._made:
            maker = self._makers[name]
            self._made[name] = maker if isinstance(maker, DataFrame) else maker()
        return self._made[name]

    def __iter__(self) -> Iterator[str]:
        return iter(self._makers)

    def __len__(self) -> int:
        return len(self._makers)


class Star:
    """The seven tables of the star; dimensions come before the fact."""

    NAMES = ("dim_customers", "dim_products", "dim_sellers", "dim_reviews", "dim_payments", "dim_date", "fact_orders")

    def __init__(self, frames: Mapping[str, DataFrame | Callable[[], DataFrame]]):
        self._frames = Frames({name: frames[name] for name in self.NAMES})

    def __getattr__(self, name: str) -> DataFrame:
        if name in Star.NAMES:
            return self._frames[name]
        raise AttributeError(name)

    def tables(self) -> Mapping[str, DataFrame]:
        return self._frames

    def with_fact(self, fact: DataFrame) -> Star:
        makers: dict = {name: (lambda n=name: self._frames[n]) for name in self.NAMES}
        return Star({**makers, "fact_orders": fact})


def register(star: Star) -> None:
    """Make the tables visible to ``spark.sql``."""
    for name, frame in star.tables().items():
        frame.createOrReplaceTempView(name)


def write_dimensions(star: Star, folder: str) -> None:
    for name, frame in star.tables().items():
        if name != "fact_orders":
            with shuffles_removed(frame.sparkSession):
                frame.write.mode("overwrite").parquet(f"{folder}/{name}")


def purchase_month() -> Column:
    return F.floor(F.col("purchase_date_key") / 100).cast("int")


def write_star(star: Star, folder: str) -> None:
    """Full refresh, dimensions first. The fact is split into purchase months, so date filters skip whole folders.

    Rebalancing brings a month's rows together for few, evenly sized files; at run time small months share a task and a
    busy month, or an order with very many items, is cut into several.
    """
    write_dimensions(star, folder)
    fact = star.fact_orders.withColumn("purchase_month", purchase_month()).hint("rebalance", "purchase_month")
    with shuffles_removed(fact.sparkSession):
        fact.write.mode("overwrite").partitionBy("purchase_month").parquet(f"{folder}/fact_orders")


def read_star(spark: SparkSession, folder: str, with_schema: bool = False) -> Star:
    """Scan the published tables; ``with_schema`` enforces the text-id schema of the raw files."""
    def scan(name: str) -> DataFrame:
        reader = spark.read
        if with_schema:
            reader = reader.schema(STAR[name])
        return reader.parquet(f"{folder}/{name}")

    return Star({name: (lambda n=name: scan(n)) for name in Star.NAMES})
