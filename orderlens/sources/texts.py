"""Text inputs derived from the test tables: markdown documents, questions, and replies with evidence."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.routing import ACCEPTANCE
from orderlens.sources.commerce import table

# A question for every order: the acceptance questions, the last one with the year {year} the order was placed in, and a
# few more.
QUESTIONS = [question.replace("2019", "{year}") for _, question in ACCEPTANCE] + [
    "How much money did repeat customers spend in {year}?",
    "Explain the top product category of 2017",
    "Combien de colis en {year} ?",
    "Is payroll part of total sales?",
]
YEARS = ("1996", "1997", "1998")


def markdown(spark: SparkSession, folder: str) -> DataFrame:
    """Whole documents as markdown: short lines become sections, lines become paragraphs, English ones get a title."""
    sections = F.regexp_replace("text", "(?md)^(.{1,60})$", "## $1")
    body = F.replace(sections, F.lit("\n"), F.lit("\n\n"))
    title = F.when(F.col("lang") == "en", F.concat(F.lit("# "), F.col("source"), F.lit("\n\n"))).otherwise(F.lit(""))
    return table(spark, folder, "documents").select("doc_id", F.concat(title, body).alias("text"))


def questions(spark: SparkSession, folder: str) -> DataFrame:
    """(question_id, question): every user turn, and one question for every order."""
    turns = table(spark, folder, "conversations").filter("role = 'user'").select(
        F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("question_id"), F.col("text").alias("question"))
    template = F.element_at(F.array(*[F.lit(q) for q in QUESTIONS]),
                            (F.col("o_orderkey") % len(QUESTIONS) + 1).cast("int"))
    asked = table(spark, folder, "orders").select(
        F.concat_ws("-", F.lit("o"), "o_orderkey").alias("question_id"),
        F.replace(template, F.lit("{year}"), F.year("o_orderdate").cast("string")).alias("question"))
    return turns.unionByName(asked)


# Replies; {a} amount, {g} amount with grouping, {y} year, {c} customer key.
REPLIES = [
    "ANSWER:\nThe order value was {a} BRL [E1].\n\nCITATIONS:\n<E1>\n",
    "ANSWER: It was {g} BRL [E1] in {y}. 46% of late delivered orders got one star [E2].\nCITATIONS: E1 E2",
    "It was about {c}00.5 BRL [E9] and 46% of them were late [E4] .",
    "ANSWER: Value {a}【E1】, see ［ E2 ］.\nCITATIONS:\nE1\nE3",
    "ANSWER:\n1. {a} BRL\n2. 12% of it; 5% of 3% of those returned\nCITATIONS:\nE2 E2 E1",
    "answer: I do not have this information for {y}. citations: ",
    "ANSWER: We don’t have data [E2] [E7] , late 7% of all reviewed orders, 0{c}% of\norders.\nCITATIONS: E1, E7, E8",
    "No evidence.",
]


def amount_texts() -> tuple[Column, Column]:
    """The order total as plain and as grouped text, from whole cents."""
    cents = F.round(F.col("o_totalprice") * 100).cast("bigint")
    whole = F.floor(cents / 100).cast("bigint")
    fraction = F.lpad((cents % 100).cast("string"), 2, "0")
    grouped = F.concat_ws(",", F.floor(whole / 1000).cast("bigint").cast("string"),
                          F.lpad((whole % 1000).cast("string"), 3, "0"))
    return (F.concat_ws(".", whole.cast("string"), fraction), F.concat_ws(".", grouped, fraction))


def answers(spark: SparkSession, folder: str) -> DataFrame:
    """(id, question, raw, evidence): a reply for every order, with two evidence blocks."""
    plain, grouped = amount_texts()
    year, customer = F.year("o_orderdate").cast("string"), F.col("o_custkey").cast("string")
    raw = F.element_at(F.array(*[F.lit(r) for r in REPLIES]), (F.col("o_orderkey") % len(REPLIES) + 1).cast("int"))
    for mark, value in (("{a}", plain), ("{g}", grouped), ("{y}", year), ("{c}", customer)):
        raw = F.replace(raw, F.lit(mark), value)

    def block(label: str, content: Column) -> Column:
        return F.struct(F.lit(label).alias("label"), content.alias("content"))

    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("What was the order worth in "), year, F.lit("?")).alias("question"),
        raw.alias("raw"),
        F.array(block("SQL: order value", F.concat(F.lit("order_value="), plain, F.lit(", customer="), customer)),
                block("DOC: Reviews", F.concat(F.lit("In "), year, F.lit(" 046% of late delivered orders got one star.")))
                ).alias("evidence"))
