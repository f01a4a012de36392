"""Small documents with everything that may go wrong, for the tests of the text operators."""

from pyspark.sql import DataFrame, SparkSession

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, digest string, key long, ids string, "
          "start long, row long, kind string, label int")
PROSE = ("The committee met on Tuesday to discuss the new water supply and agreed to ask the council for a report on costs "
         "before the summer. Nobody expected the answer to arrive so soon, or to be so short.")
LONG = " ".join(f"word{i % 977} and{i % 31}" for i in range(30_000))


def rows() -> list[tuple]:
    texts = [(1, PROSE), (2, PROSE.replace(" ", "  \n")), (3, None), (4, ""), (5, "   "), (None, PROSE), (7, LONG),
             (8, LONG + " end"), (9, "unique text"), (9, "unique text"), (9, "other text, same id"), (None, None),
             (12, "x" * 50_000), (13, "ünïcödé 日本語 😀 ́ text"), (14, PROSE.upper()), (15, "a"), (16, "\x00 zero")]
    return [(i, t, None if n % 3 else "en", "s", None, "d", n, "ids", n, n, "k", 1) for n, (i, t) in enumerate(texts)]


def documents(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


def empty(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], SCHEMA)


def plain(frame: DataFrame) -> list[tuple]:
    return sorted((tuple(r) for r in frame.collect()), key=repr)
