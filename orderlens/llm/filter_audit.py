"""Audit of how five filters interact, over a sparse document-term matrix.

1. Tasks cut their documents into shards of a fixed amount of text and write each as compressed sparse rows over the
   shard's own words: where each document's entries begin, the words' codes, their counts.
2. The shards' words are merged into one dictionary: the id of a word is the first place it has in any shard. A word has
   one place per shard, so even the most common one brings at most one row for every ``SHARD_BYTES`` of text.
3. Each shard meets the ids that its words have from other shards and is encoded anew: now columns mean the same in all.
4. Row sums are words, nonzero counts are distinct words: they decide filters A and B. C and D were counted when the text
   was read; E compares digests and keeps the rows whose doc_id is the smallest of their text.
5. Documents shrink to counts per (part, set of failed filters). From these come the documents that pass any set of
   filters, and every order and step is a difference of two such numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.group_ops import PandasCogroupedOps

from orderlens.llm.common import id_text, pieces, stored

#: Bytes of text in a shard, unless a document alone is longer.
SHARD_BYTES = 1 << 23
#: Bits of a word's id for its code in a shard and for the shard in its task; the rest are the task's.
CODE_BITS, MADE_BITS = 30, 12
FILTERS = "ABCDE"
#: A wants so many words, B this share of distinct words and C at most this share of capitals, in percent.
WORDS, DISTINCT_PERCENT, CAPITALS_PERCENT = 200, 50, 2
CAPITALS, SIGNS = bytes(range(65, 91)), b"#$%&*|"
#: Bytes of UTF-8 that go on with a character.
LATER_BYTES = bytes(range(0x80, 0xC0))


def _shard_schema(kind: str, entries: str) -> str:
    return (f"shard long, doc_id array<{kind}>, part array<string>, digest array<binary>, capitals array<boolean>, "
            f"signs array<boolean>, first array<int>, {entries}")


def planes(values: np.ndarray) -> bytes:
    """32-bit integers as four planes, all lowest bytes first: high planes of small numbers are zeros, which compress."""
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(4, -1).T).view("<u4").ravel()


def _marks(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """For each text whether it fails C and whether it fails D."""
    def without(data: bytes, some: bytes) -> int:
        return len(data.translate(None, some))

    each = [t.as_py() for t in texts]
    capitals = np.array([len(t) - without(t, CAPITALS) for t in each], np.int64)
    points = np.array([without(t, LATER_BYTES) for t in each], np.int64)
    return 100 * capitals > CAPITALS_PERCENT * points, np.array([len(t) > without(t, SIGNS) for t in each], bool)


def _entries(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct words of the texts, and their compressed sparse rows: where each text begins, codes, counts."""
    split = pc.ascii_split_whitespace(texts.view(pa.large_string()))  # white space at an end leaves an empty word
    words = split.flatten()
    text = np.repeat(np.arange(len(texts), dtype=np.int64), split.value_lengths().to_numpy())
    real = pc.greater(pc.binary_length(words), 0)
    coded = words.filter(real).dictionary_encode()
    keys = np.sort(text[real.to_numpy(zero_copy_only=False)] << 32 | coded.indices.to_numpy())
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.empty(0, np.int64)
    first = np.searchsorted(keys[new] >> 32, np.arange(len(texts) + 1))
    return (coded.dictionary.cast(pa.large_binary()).cast(pa.binary()), first.astype(np.int32),
            (keys[new] & 0xFFFFFFFF).astype(np.int32), np.diff(np.append(new, len(keys))).astype(np.int32))


def local_shards(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """One row per shard: its words, and its documents as compressed sparse rows over the places of these words."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    texts = docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"),
                        F.coalesce("text", F.lit("")).cast("binary").alias("text"))
    texts = texts.withColumn("digest", F.unhex(F.sha2("text", 256)))
    schema = _shard_schema(kind, "words array<binary>, columns binary, counts binary")

    def build(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        for batch in pieces(batches, size=shard_bytes):
            column = batch.column("text").cast(pa.large_binary())
            words, first, columns, counts = _entries(column)
            if made >> MADE_BITS or len(words) >> CODE_BITS or task >> 63 - MADE_BITS - CODE_BITS:
                raise ValueError("more tasks, shards in a task or words in a shard than a word's id has bits for")
            capitals, signs = _marks(column)
            lists = [batch.column("doc_id"), batch.column("part"), batch.column("digest"), pa.array(capitals),
                     pa.array(signs), pa.array(first), words]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(task << MADE_BITS | made) << CODE_BITS]), *(pa.ListArray.from_arrays([0, len(x)], x) for x in lists),
                 pa.array([planes(columns)], pa.binary()), pa.array([planes(counts)], pa.binary())],
                names=["shard", "doc_id", "part", "digest", "capitals", "signs", "first", "words", "columns", "counts"])
            made += 1

    return stored(texts.mapInArrow(build, schema), "local-shards")


def word_ids(shards: DataFrame) -> DataFrame:
    """word, at (shard plus the word's code in it) and id, the smallest ``at`` of the word anywhere.

    A running first value over a word's places in order: nothing is gathered, and a word has one place in every shard.
    """
    places = shards.select(F.posexplode("words").alias("code", "word"), "shard").select(
        "word", (F.col("shard") + F.col("code")).alias("at"))
    so_far = Window.partitionBy("word").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    return places.withColumn("id", F.first("at").over(so_far))


def _encoded(shard: pa.Table, known: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Global ids and counts of a shard's entries; ``known`` has the words whose id is from another shard."""
    columns, counts = (from_planes(shard.column(c)[0].as_py()) for c in ("columns", "counts"))
    base = shard.column("shard")[0].as_py()
    ids = base + np.arange(int(columns.max()) + 1 if len(columns) else 0, dtype=np.int64)
    ids[known.column("at").to_numpy() - base] = known.column("id").to_numpy()
    return ids[columns], counts


def _meet(docs: DataFrame, shard_bytes: int) -> tuple[DataFrame, PandasCogroupedOps]:
    """The dictionary, and each local shard together with the ids that its words have from other shards."""
    shards = local_shards(docs, shard_bytes)
    ids = word_ids(shards)
    of = F.col("at") - F.col("at").bitwiseAND(F.lit((1 << CODE_BITS) - 1))
    others = ids.filter("id <> at").select(of.alias("of"), "at", "id")
    return (ids.filter("id = at").select("word", "id"),
            shards.drop("words").groupBy("shard").cogroup(others.groupBy("of")))


def document_terms(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """The document-term matrix of ``docs``: the dictionary (word, id) and its shards.

    A shard holds whole documents: doc_id, part, digest, capitals and signs have one entry each, ``first`` one more; the
    entries of document i are columns[first[i]:first[i + 1]], distinct ids of the dictionary, and their counts.
    """
    dictionary, met = _meet(docs, shard_bytes)

    def encode(shard: pa.Table, known: pa.Table) -> pa.Table:
        ids, counts = _encoded(shard, known)
        for name, values in (("columns", ids), ("counts", counts.astype(np.int32))):
            lists = pa.ListArray.from_arrays([0, len(values)], pa.array(values))
            shard = shard.set_column(shard.schema.get_field_index(name), name, lists)
        return shard

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dictionary, met.applyInArrow(encode, _shard_schema(kind, "columns array<long>, counts array<int>"))


def document_flags(docs: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """doc_id, part, digest and the failures a, b, c, d: one row per document, read off the matrix shard by shard."""
    def decide(shard: pa.Table, known: pa.Table) -> pa.Table:
        ids, counts = _encoded(shard, known)
        lists = {c: shard.column(c).combine_chunks().flatten() for c in ("doc_id", "part", "digest", "capitals", "signs", "first")}
        first = lists["first"].to_numpy()
        words = np.diff(np.concatenate(([0], np.cumsum(counts, dtype=np.int64)))[first])
        distinct = np.diff(np.concatenate(([0], np.cumsum(ids >= 0)))[first])
        return pa.table({"doc_id": lists["doc_id"], "part": lists["part"], "digest": lists["digest"],
                         "a": words < WORDS, "b": 100 * distinct < DISTINCT_PERCENT * words,
                         "c": lists["capitals"], "d": lists["signs"]})

    kind = docs.schema["doc_id"].dataType.simpleString()
    return _meet(docs, shard_bytes)[1].applyInArrow(
        decide, f"doc_id {kind}, part string, digest binary, a boolean, b boolean, c boolean, d boolean")


def failed_sets(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """part, failed (bit i for filter i), n, good, toxic: documents of each part that fail exactly these filters."""
    rows = stored(document_flags(docs, shard_bytes), "flags").withColumn("id", id_text("doc_id"))
    smallest = rows.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).select("digest", id_text("doc_id").alias("id"),
                                                                                 F.lit(True).alias("smallest"))
    known = (labels.groupBy(id_text("doc_id").alias("id")).agg(F.max(F.expr("quality <=> 1")).alias("good"),
                                                               F.max(F.expr("toxic <=> 1")).alias("toxic"))
             .filter("id <> ''"))
    rows = rows.join(smallest, ["digest", "id"], "left").join(known, "id", "left")
    fails = [F.col(c) for c in "abcd"] + [F.col("smallest").isNull()]
    failed = sum((f.cast("int") * (1 << i) for i, f in enumerate(fails)), F.lit(0))
    return rows.groupBy("part", failed.alias("failed")).agg(
        F.count("*").alias("n"), F.count_if("good").alias("good"), F.count_if("toxic").alias("toxic"))


def orders() -> list[tuple[str, int, str, int, int]]:
    """(order, step, filter, filters before the step as bits, filters after it) of all orders."""
    steps = []
    for order in map("".join, permutations(FILTERS)):
        done = 0
        for step, name in enumerate(order, 1):
            steps.append((order, step, name, done, done | 1 << FILTERS.index(name)))
            done = steps[-1][-1]
    return steps


def audit(docs: DataFrame, labels: DataFrame, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """part, filter_order, step and counts of documents: kept, removed, redundant, unique_fails, good_lost, toxic_lost,
    shapley. One row for every part (source, null as empty) and every step of every order of the five filters.

    Filters see whole texts, null as empty. E fails if a row with a smaller doc_id has the same text: a null doc_id is the
    largest, and rows that share doc_id and text do not fail by each other. A document is good or toxic if any label row of
    its doc_id says so; a null doc_id has no label. Repeated rows count repeatedly. Other columns are ignored; an empty
    table gives an empty result.
    """
    cells = stored(failed_sets(docs, labels, shard_bytes), "failed-sets")
    # A cell passes every set of filters that holds none of those it fails.
    passing = F.filter(F.sequence(F.lit(0), F.lit(31)), lambda s: s.bitwiseAND(F.col("failed")) == 0)
    counts = ["n", "good", "toxic"]
    passed = (cells.select("part", F.explode(passing).alias("filters"), *counts).groupBy("part", "filters")
              .agg(*(F.sum(c).alias(c) for c in counts)))
    alone = cells.groupBy("part").agg(*(F.coalesce(F.sum(F.when(F.col("failed") == 1 << i, F.col("n"))), F.lit(0)).alias(f)
                                        for i, f in enumerate(FILTERS)))
    sums = (passed.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("filters", F.struct(*counts))))
                                       .alias("passed"))  # 32 entries at most
            .join(alone, "part"))
    listed = F.array(*[F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(f).alias("name"),
                                F.lit(before).alias("before"), F.lit(after).alias("after"))
                       for o, s, f, before, after in orders()])
    steps = sums.select("*", F.inline(listed))

    def at(filters: Column, what: str) -> Column:
        return F.coalesce(F.col("passed")[filters][what], F.lit(0))

    def lost(what: str) -> Column:
        return at(F.col("before"), what) - at(F.col("after"), what)

    bit = F.col("after") - F.col("before")
    steps = steps.select(
        "part", "filter_order", "step", "name", at(F.col("after"), "n").alias("kept"), lost("n").alias("removed"),
        (at(F.lit(0), "n") - at(bit, "n")).alias("fails"),
        F.element_at(F.create_map(*[x for f in FILTERS for x in (F.lit(f), F.col(f))]), F.col("name"))
        .alias("unique_fails"), lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"))
    everywhere = Window.partitionBy("part", "name")  # 120 rows
    return steps.select("part", "filter_order", "step", "kept", "removed",
                        (F.col("fails") - F.col("removed")).alias("redundant"), "unique_fails", "good_lost", "toxic_lost",
                        F.sum("removed").over(everywhere).alias("shapley"))
