"""Documents to titled chunks of about 500 characters.

Chunks are cut in one Arrow pass that reads a document's paragraphs once, in order, and keeps only the open chunk: the work
grows with the text, however many paragraphs a document has. Titles and sections of single positions are column expressions.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import scratch_path, shuffles_removed

# Chunk size, the length up to which a chunk is left whole (10% more), and the length of a fragment.
MAX_CHARS, WHOLE, FRAGMENT = 500, 550, 80
# Characters that end a line, and white space, as Unicode defines them.
LINE_ENDS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"
WHITE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
         "\u2028\u2029\u202f\u205f\u3000")
BLANK_LINE = f"\n[{WHITE}]*\n"


def stripped(text: Column) -> Column:
    return F.trim(text, F.lit(WHITE))


def document_title(text: Column, fallback: Column) -> Column:
    """The first line starting with ``# ``, else the fallback."""
    heading = f"(?:^|[{LINE_ENDS}])# ([^{LINE_ENDS}]*)"
    return F.when(text.rlike(heading), stripped(F.regexp_extract(text, heading, 1))).otherwise(fallback)


def section_heads(text: Column) -> Column:
    """Offset and title of every line starting with ``## ``, in order."""
    parts = F.split(text, f"(?<=[{LINE_ENDS}])(?=## )")
    start = F.struct(F.lit(0).alias("offset"), F.array().cast("array<struct<offset:int,title:string>>").alias("heads"))

    def step(seen: Column, part: Column) -> Column:
        title = stripped(F.regexp_extract(part, f"^## ([^{LINE_ENDS}]*)", 1))
        head = F.array(F.struct(seen["offset"].alias("offset"), title.alias("title")))
        heads = F.when(part.startswith("## "), F.concat(seen["heads"], head)).otherwise(seen["heads"])
        return F.struct((seen["offset"] + F.length(part)).alias("offset"), heads.alias("heads"))

    return F.aggregate(parts, start, step, lambda seen: seen["heads"])


def section_at(heads: Column, position: Column) -> Column:
    """Title of the last head at or before a position; empty when there is none."""
    before = F.filter(heads, lambda h: h["offset"] <= position)
    return F.coalesce(F.try_element_at(before, F.lit(-1))["title"], F.lit(""))


_BLANK_LINE, _HEAD = re.compile(BLANK_LINE), re.compile(f"(?:^|(?<=[{LINE_ENDS}]))## ([^{LINE_ENDS}]*)")


def packed(text: str) -> Iterator[tuple[str, int]]:
    """Paragraphs joined up to the chunk size, with the position of the first. Positions add two characters per paragraph,
    whatever separated them."""
    opened, size, start, at = [], 0, 0, 0
    for paragraph in _paragraphs(text):
        body = paragraph.strip(WHITE)
        if body:
            if opened and size + 2 + len(body) > MAX_CHARS:
                yield "\n\n".join(opened), start
                opened = []
            if not opened:
                size, start = -2, at
            opened.append(body)
            size += 2 + len(body)
        at += len(body) + 2
    if opened:
        yield "\n\n".join(opened), start


def _paragraphs(text: str) -> Iterator[str]:
    at = 0
    for gap in _BLANK_LINE.finditer(text):
        yield text[at:gap.start()]
        at = gap.end()
    yield text[at:]


def pieces(chunks: Iterable[tuple[str, int]]) -> Iterator[tuple[str, int]]:
    """Chunks that are too long become pieces of the chunk size."""
    for body, start in chunks:
        for at in range(0, len(body), MAX_CHARS) if len(body) > WHOLE else (0,):
            yield body[at:at + MAX_CHARS] if len(body) > WHOLE else body, start


def without_fragments(chunks: Iterable[tuple[str, int]]) -> Iterator[tuple[str, int]]:
    """Fragments join the chunk before them where the result stays short enough."""
    last = None
    for body, start in chunks:
        if last and len(body) < FRAGMENT and len(last[0]) + 2 + len(body) <= WHOLE:
            last = f"{last[0]}\n\n{body}", last[1]
        else:
            if last:
                yield last
            last = body, start
    if last:
        yield last


def _sectioned(text: str) -> Iterator[tuple[str, str]]:
    """Section and content of a document's chunks: the section is the last head at or before the chunk's start."""
    heads = [(m.start(), m[1].strip(WHITE)) for m in _HEAD.finditer(text)]
    offsets = [at for at, _ in heads]
    for body, start in without_fragments(pieces(packed(text))):
        n = bisect_right(offsets, start)
        yield heads[n - 1][1] if n else "", body


#: Chunks of an Arrow batch that the cutting hands on.
BATCH = 4096


def chunk_documents(documents: DataFrame, key: str, text: str = "text", fallback_title: str | None = None) -> DataFrame:
    """(key, chunk_no, title, section, label, content): chunks numbered from 0 within their document. A document without
    text has none."""
    kind = documents.schema[key].dataType.simpleString()
    fallback = F.col(fallback_title) if fallback_title else F.col(key).cast("string")
    titled = documents.select(F.col(key), document_title(F.col(text), fallback).alias("title"), F.col(text).alias("text")).filter(
        "text IS NOT NULL")

    def cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, numbers, sections, contents = [], [], [], []
            for row, value in enumerate(batch.column("text")):
                for number, (section, content) in enumerate(_sectioned(value.as_py())):
                    rows.append(row), numbers.append(number), sections.append(section), contents.append(content)
                    if len(rows) == BATCH:
                        yield made(batch, rows, numbers, sections, contents)
                        rows, numbers, sections, contents = [], [], [], []
            if rows:
                yield made(batch, rows, numbers, sections, contents)

    def made(batch, rows, numbers, sections, contents) -> pa.RecordBatch:
        of = pa.array(rows, pa.int32())
        return pa.RecordBatch.from_arrays([batch.column(key).take(of), pa.array(numbers, pa.int32()),
                                           batch.column("title").take(of), pa.array(sections), pa.array(contents)],
                                          names=[key, "chunk_no", "title", "section", "content"])

    chunks = titled.mapInArrow(cut, f"`{key}` {kind}, chunk_no int, title string, section string, content string")
    label = F.when(F.col("section") == "", F.col("title")).otherwise(F.concat_ws(" › ", "title", "section"))
    return chunks.select(key, "chunk_no", "title", "section", label.alias("label"), "content")


def _written(frame: DataFrame, name: str) -> DataFrame:
    path = scratch_path(frame.sparkSession, name)
    with shuffles_removed(frame.sparkSession):
        frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def document_offsets(counts: DataFrame, key: str, parts: int | None = None) -> DataFrame:
    """For (key, n): the number of chunks in all documents before each, in key order.

    A running sum over all documents without one task seeing them all: documents are placed in key ranges, the ranges
    are fixed by a small table in the shared folder, sums run inside each range and over the few range totals. There are
    as many ranges as shuffle partitions unless told otherwise.
    """
    spark = counts.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = _written(counts.repartitionByRange(parts, key).withColumn("_range", F.spark_partition_id()), "ranges")
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    totals = (ranged.groupBy("_range").agg(F.sum("n").alias("_n"))  # one row per range
              .select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base")))
    inside = Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)
    return (ranged.join(totals, "_range")
            .select(key, (F.col("_base") + F.coalesce(F.sum("n").over(inside), F.lit(0))).alias("offset")))


def build_corpus(documents: DataFrame, key: str, text: str = "text", fallback_title: str | None = None,
                 parts: int | None = None) -> DataFrame:
    """All chunks with a corpus-wide ``chunk_id``: 0, 1, 2, ... by document key, then chunk number.

    The documents are read and cut once: the chunks are written to the shared folder, and counts and numbers come from
    there. Where any unique key will do, ``(key, chunk_no)`` of ``chunk_documents`` needs no second step.
    """
    chunks = _written(chunk_documents(documents, key, text, fallback_title), "chunks")
    offsets = document_offsets(chunks.groupBy(key).agg(F.count("*").alias("n")), key, parts)
    return chunks.join(offsets, key).select((F.col("offset") + F.col("chunk_no")).alias("chunk_id"), key, "chunk_no",
                                            "title", "section", "label", "content")
