"""Benchmark decontamination by latent semantic retrieval.

1. Passages are windows of two and of four blocks of sixteen words, one starting at every block of every document. Inverse
   document frequencies of hashed terms are counted over all blocks of all documents.
2. A randomised SVD of TF-IDF passages gives the latent space: the matrix of all words of all benchmark items and of all
   documents, a row for each run of up to four blocks, is multiplied batch by batch in the tasks, partial products are
   summed by ranges of terms, and only the thin factors meet on the driver.
3. Each passage's cosine with every item (a bounded block of items at a time) yields candidates. For them the longest
   common subsequence of words decides; where the item's ``answer`` column gives an answer, that must be there too. So
   moved, cut and reworded copies are found, and chance resemblance is not.

A document and all its passages are searched in one task, in pieces of bounded size; nothing is shuffled but term counts.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm.common import pieces, stored, whole_texts
from orderlens.llm.vectext import Words, flat_bytes, split_words

#: Hashed terms, dimensions of the space, extra ones while it is fitted, words of a block, blocks of a passage.
TERMS, RANK, EXTRA, BLOCK, PASSAGES = 1 << 16, 64, 8, 16, (2, 4)
#: Documents and passages of each whose weight all passages of the corpus have together in the fit, however many they are;
#: ranges that partial products are summed by; items searched in one go, which bounds the broadcast.
SAMPLE_DOCS, SAMPLE_EACH, RANGES, ITEMS = 2048, 4, 64, 10_000
#: Weight of the items' own passages while the space is fitted, so that its directions tell items apart.
ITEM_WEIGHT = 4.0
#: Cosine of a candidate; share of an item's words in the common subsequence; the same of a given answer; items shorter
#: than this must occur word by word.
COSINE, SHARE, ANSWER, SHORT = 0.6, 0.7, 0.5, 8


def term_ids(words: Words) -> np.ndarray:
    return (words.hashes >> np.uint64(24)).astype(np.int64) & (TERMS - 1)


def block_starts(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """First word of each block, and the first block of each document (one more entry than documents)."""
    counts = -(-np.diff(words.first) // BLOCK)
    first = np.concatenate(([0], np.cumsum(counts)))
    inner = np.arange(first[-1]) - np.repeat(first[:-1], counts)
    return np.repeat(words.first[:-1], counts) + inner * BLOCK, first


def first_of_runs(*columns: np.ndarray) -> np.ndarray:
    """Where a run of rows that are equal in all columns begins."""
    fresh = np.ones(len(columns[0]), bool)
    fresh[1:] = np.any([c[1:] != c[:-1] for c in columns], axis=0)
    return fresh


def term_weights(docs: DataFrame) -> np.ndarray:
    """Inverse document frequency of every hashed term over all blocks of all documents."""
    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, blocks = np.zeros(TERMS + 1, np.int64), 0
        for batch in pieces(batches, size=1 << 19):
            words = split_words(batch.column("text"))
            starts, _ = block_starts(words)
            block = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words.hashes))))
            # A term counts once a block: a stable sort by term brings its repeats within a block together.
            terms = term_ids(words).astype(np.uint16)
            order = np.argsort(terms, kind="stable")
            terms, block = terms[order], block[order]
            found[:TERMS] += np.bincount(terms[first_of_runs(terms, block)], minlength=TERMS)
            blocks += len(starts)
        found[TERMS] = blocks
        used = np.flatnonzero(found)
        yield pa.RecordBatch.from_pydict({"term": used, "blocks": found[used]})

    counted = whole_texts(docs).select("text").mapInArrow(count, "term bigint, blocks bigint")
    table = counted.groupBy("term").agg(F.sum("blocks").alias("blocks")).toArrow()  # at most TERMS + 1 rows
    blocks = np.zeros(TERMS + 1)
    blocks[table.column("term").to_numpy()] = table.column("blocks").to_numpy()
    return np.log(1 + blocks[TERMS] / np.maximum(blocks[:TERMS], 1)).astype(np.float32)


def passage_starts(words: Words) -> np.ndarray:
    """First word of each passage when every document is cut into the fewest runs of up to four blocks, about equally long."""
    starts, first = block_starts(words)
    blocks = np.diff(first)
    runs = -(-blocks // max(PASSAGES))
    run = np.arange(runs.sum()) - np.repeat(np.cumsum(runs) - runs, runs)
    return starts[np.repeat(first[:-1], runs) + run * np.repeat(blocks, runs) // np.maximum(np.repeat(runs, runs), 1)]


def packed_lists(ends: np.ndarray, values: np.ndarray) -> pa.Array:
    """Runs of ``values`` that end at ``ends``, each as its bytes."""
    places = np.append(0, ends).astype(np.int32) * np.int32(values.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(places), pa.py_buffer(values)])


def unpacked(column: pa.Array, kind: type) -> tuple[np.ndarray, np.ndarray]:
    """The values of all rows one after the other and where each row ends, from an array column or from bytes of ``kind``."""
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False), np.cumsum(np.diff(column.offsets.to_numpy()))
    data, offsets = flat_bytes(column)
    return data.view(kind), offsets[1:] // np.dtype(kind).itemsize


def passage_rows(texts: DataFrame, idf: np.ndarray, packed: bool = False) -> DataFrame:
    """terms, weights: TF-IDF rows of length 1 of the passages that all texts are cut into; every word is in one.

    ``packed`` rows hold the bytes of 16-bit terms and 32-bit weights: arrays are copied element by element on their way
    from Python to files and back.
    """
    shared = texts.sparkSession.sparkContext.broadcast(idf)

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=1 << 19):
            words = split_words(batch.column("text"))
            starts = passage_starts(words)
            if not len(starts):
                continue
            passage = np.repeat(np.arange(len(starts)), np.diff(np.append(starts, len(words.hashes))))
            terms = term_ids(words).astype(np.uint16)
            order = np.argsort(terms, kind="stable")
            terms, passage = terms[order], passage[order]
            once = np.flatnonzero(first_of_runs(terms, passage))
            weights = np.diff(np.append(once, len(terms))) * shared.value[terms[once]]
            terms, passage = terms[once], passage[once]
            norm = np.sqrt(np.bincount(passage, weights.astype(np.float64) ** 2, len(starts)))
            order = np.argsort(passage.astype(np.uint16) if len(starts) < 2 ** 16 else passage, kind="stable")
            weights = (weights / norm[passage])[order].astype(np.float32)
            terms, ends = terms[order], np.cumsum(np.bincount(passage, minlength=len(starts)))
            if packed:
                yield pa.RecordBatch.from_pydict({"terms": packed_lists(ends, terms), "weights": packed_lists(ends, weights)})
                continue
            places = pa.array(np.append(0, ends).astype(np.int32))
            yield pa.RecordBatch.from_pydict({
                "terms": pa.ListArray.from_arrays(places, pa.array(terms.astype(np.int32))),
                "weights": pa.ListArray.from_arrays(places, pa.array(weights))})

    kinds = "terms binary, weights binary" if packed else "terms array<int>, weights array<float>"
    return texts.select("text").mapInArrow(make, kinds)


def add_gram(total: np.ndarray, factor: np.ndarray, terms: np.ndarray, weights: np.ndarray, ends: np.ndarray) -> None:
    """Adds A'A times ``factor`` to ``total`` for sparse rows that lie one after the other and end at ``ends``. No term comes
    twice in a row."""
    at = 0
    for end in ends.tolist():
        term, weight = terms[at:end], weights[at:end]
        part = factor.take(term, axis=0)
        np.multiply(weight[:, None], weight @ part, out=part)
        part += total.take(term, axis=0)
        total[term] = part
        at = end


def gram_product(rows: DataFrame, factor: np.ndarray) -> np.ndarray:
    """A'A times ``factor``, where A has the given sparse rows, packed or not: each task multiplies its rows, the parts are
    summed by ranges of terms. A part is as large as the factor, so a task takes the rows of several files where there are many."""
    shared = rows.sparkSession.sparkContext.broadcast(factor.astype(np.float32))
    width, step = factor.shape[1], TERMS // RANGES
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, rows.rdd.getNumPartitions() // 8)

    def multiply(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((TERMS, width), np.float32)
        for batch in batches:
            (terms, ends), (weights, _) = unpacked(batch.column("terms"), np.uint16), unpacked(batch.column("weights"), np.float32)
            add_gram(total, shared.value, terms.astype(np.int64), weights.astype(np.float32), ends)
        parts = [total[r * step: (r + 1) * step] for r in range(RANGES)]
        used = [r for r in range(RANGES) if parts[r].any()]
        yield pa.RecordBatch.from_pydict({"range": pa.array(used, pa.int32()),
                                          "part": pa.array([parts[r].tobytes() for r in used], pa.binary())})

    def add(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        total = np.sum([np.frombuffer(p, np.float32) for p in group["part"]], axis=0, dtype=np.float32)
        return pd.DataFrame({"range": [key[0]], "part": [total.tobytes()]})

    summed = rows.coalesce(tasks).mapInArrow(multiply, "range int, part binary").groupBy("range").applyInPandas(
        add, "range int, part binary")
    out = np.zeros((TERMS, width), np.float32)
    table = summed.toArrow()  # RANGES rows of fixed size
    for r, part in zip(table.column("range").to_pylist(), table.column("part")):
        out[r * step: (r + 1) * step] = np.frombuffer(part.as_buffer(), np.float32).reshape(step, width)
    shared.destroy()  # the sums are here; else the driver keeps each factor until its garbage is collected
    return out


def first_factor(width: int) -> np.ndarray:
    """Normal numbers from a fixed seed, drawn by ranges of terms: all at once in double precision would be twice as large."""
    draw, step = np.random.default_rng(3), TERMS // RANGES
    return np.concatenate([draw.standard_normal((step, width)).astype(np.float32) for _ in range(RANGES)])


def orthonormal(tall: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns, by ranges of rows: those bases, turned by the basis of their stacked triangles.
    At once, the driver would hold several copies in double precision."""
    step, width = len(tall) // RANGES, tall.shape[1]
    parts = [np.linalg.qr(tall[a: a + step]) for a in range(0, len(tall), step)]
    turns = np.linalg.qr(np.concatenate([triangle for _, triangle in parts]))[0]
    out = np.empty_like(tall)
    for n, (basis, _) in enumerate(parts):
        np.matmul(basis, turns[n * width: (n + 1) * width], out=out[n * step: (n + 1) * step])
    return out


def latent_space(docs: DataFrame, items: DataFrame, idf: np.ndarray) -> np.ndarray:
    """Weighted right singular vectors (TERMS, RANK): a passage's coordinates are the sum of its terms' rows.

    Randomised range finding from a fixed seed, one multiplication by A'A to sharpen it, then the eigenvectors of the
    projected matrix. Strong directions are shrunk, in the way of a ridge whose strength is one item's passage: else those
    of the languages and of common words would make all passages look alike.
    All passages of all documents together weigh as much as a fixed number of them, so the items keep their directions
    however large the corpus is.
    """
    corpus = stored(passage_rows(whole_texts(docs), idf, packed=True), "passages")
    own = stored(passage_rows(whole_texts(items.withColumnRenamed("item_id", "doc_id")), idf, packed=True), "item-passages")
    share = min(1.0, SAMPLE_DOCS * SAMPLE_EACH / max(corpus.count(), 1))

    def product(factor: np.ndarray) -> np.ndarray:
        total = gram_product(corpus, factor)
        total *= np.float32(share)
        more = gram_product(own, factor)
        more *= np.float32(ITEM_WEIGHT ** 2)
        total += more
        return total

    basis = orthonormal(product(first_factor(RANK + EXTRA)))
    projected = basis.T @ product(basis)
    squares, vectors = (x[..., ::-1][..., :RANK] for x in np.linalg.eigh((projected + projected.T) / 2))
    table = basis @ (vectors / np.sqrt(np.maximum(squares, 0) + ITEM_WEIGHT ** 2)).astype(np.float32)
    table *= idf[:, None]
    return table


def common_length(masks: dict[int, int], size: int, words: list[int]) -> int:
    """Length of the longest common subsequence of a text of ``size`` words, given as the bits where each word stands, and
    ``words``: one addition of integers per shared word."""
    row = full = (1 << size) - 1
    for word in words:
        mask = masks.get(word)
        if mask:
            hit = row & mask
            row = (row + hit) | (row - hit)
    return size - (row & full).bit_count()


def word_masks(words: list[int]) -> dict[int, int]:
    masks: dict[int, int] = {}
    for i, word in enumerate(words):
        masks[word] = masks.get(word, 0) | 1 << i
    return masks


@dataclass
class Index:
    """A block of items: ids, unit coordinates of each item and of the passages of long ones with the item they belong to,
    word hashes and answers (empty where none is given)."""

    ids: list
    table: np.ndarray
    places: np.ndarray
    owners: np.ndarray
    words: list[list[int]]
    answers: list[list[int]]

    def __post_init__(self) -> None:
        self.masks = [word_masks(w) for w in self.words]
        self.known = [np.unique(np.array(w, np.uint64)) for w in self.words]
        self.answer_masks = [word_masks(a) for a in self.answers]

    def share(self, item: int, words: np.ndarray) -> float:
        """Share of the item's words in its common subsequence with ``words``; 0 if a given answer is not there."""
        size, answer, known = len(self.words[item]), self.answers[item], self.known[item]
        if size < SHORT:
            wanted, words = self.words[item], words.tolist()
            return float(any(words[i: i + size] == wanted for i in range(len(words) - size + 1)))
        # Only words of the item are in the subsequence, so with too few of them its length need not be known.
        shared = words[known[np.minimum(np.searchsorted(known, words), len(known) - 1)] == words]
        if len(shared) / size < SHARE:
            return 0.0
        share = common_length(self.masks[item], size, shared.tolist()) / size
        if share < SHARE or common_length(self.answer_masks[item], len(answer), words.tolist()) < ANSWER * len(answer):
            return 0.0
        return share

    def matches(self, column: pa.Array) -> dict[tuple[int, int], tuple[float, float]]:
        """(row, item) to (share, cosine) for the rows of a text column that contain an item."""
        words = split_words(column)
        starts, first = block_starts(words)
        if not len(starts) or not len(self.ids):
            return {}
        ids, word_ends = term_ids(words), np.append(starts[1:], len(words.hashes))
        doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
        sums = np.empty((len(starts), self.table.shape[1]), np.float32)
        for a in range(0, len(starts), 256):
            word = starts[a: a + 256, None] + np.arange(BLOCK)
            rows = self.table.take(ids[np.minimum(word, len(ids) - 1)], axis=0)
            rows[word >= word_ends[a: a + 256, None]] = 0  # the last block of a document is shorter
            rows.sum(axis=1, out=sums[a: a + 256])
        found: dict[tuple[int, int], tuple[float, float]] = {}
        window, have = sums, 1
        for size in PASSAGES:
            while have < size:  # a window twice as long is a window and the one after it, as far as the document goes
                longer = window.copy()
                follows = np.flatnonzero(doc[have:] == doc[:-have]) if have < len(doc) else np.zeros(0, int)
                longer[follows] += window[follows + have]
                window, have = longer, 2 * have
            # Windows that end early repeat the end of a longer one, but for those that hold a whole short document.
            at = np.flatnonzero((np.arange(len(doc)) + size <= first[doc + 1]) | (np.arange(len(doc)) == first[doc]))
            self._search(words, starts, word_ends, first, doc, at, size, window[at], found)
        return found

    def _search(self, words, starts, word_ends, first, doc, at, size, vectors, found) -> None:
        norm = np.linalg.norm(vectors, axis=1)
        vectors = vectors / np.maximum(norm, 1e-9)[:, None]
        for a in range(0, len(at), 1024):
            cosine = vectors[a: a + 1024] @ self.places.T
            near: dict[tuple[int, int], float] = {}
            window, place = np.divmod(np.flatnonzero(cosine >= COSINE), cosine.shape[1])
            for pair, value in zip(zip(window.tolist(), self.owners[place].tolist()), cosine[window, place].tolist()):
                near[pair] = max(near.get(pair, value), value)
            for (window, item), value in near.items():
                block = at[a + window]
                row, reach = int(doc[block]), len(self.words[item])
                last = min(block + size, first[row + 1]) - 1
                low = max(words.first[row], starts[block] - reach)
                high = min(words.first[row + 1], word_ends[last] + reach)
                share = self.share(item, words.hashes[low:high])
                if share:
                    best = (share, value)
                    found[row, item] = max(found.get((row, item), best), best)


class ItemBlocks:
    """The items in blocks of about ITEMS, each made when it is asked for; items without a word are left out.

    The driver and the tasks hold one block at a time, whatever the number of items.
    """

    def __init__(self, items: DataFrame, table: np.ndarray):
        answer = F.coalesce(F.col("answer").cast("string"), F.lit("")) if "answer" in items.columns else F.lit("")
        blocks = -(-items.count() // ITEMS)
        self.table, self.blocks = table, blocks
        self.rows = stored(items.select("item_id", F.coalesce("text", F.lit("")).alias("text"), answer.alias("answer"))
                           .withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(max(blocks, 1)))), "items")

    def __len__(self) -> int:
        return self.blocks

    def __iter__(self) -> Iterator[Index]:
        for block in range(self.blocks):
            yield self._index(self.rows.filter(F.col("block") == block).orderBy("item_id", "text").toArrow())

    def _index(self, part: pa.Table) -> Index:
        texts, answers = (split_words(part.column(c).combine_chunks()) for c in ("text", "answer"))
        ids, each = term_ids(texts), [slice(a, b) for a, b in zip(texts.first[:-1], texts.first[1:])]
        kept = [i for i, s in enumerate(each) if s.stop > s.start]
        cuts = passage_starts(texts)
        parts = [(n, words) for n, i in enumerate(kept) for words in _parts(each[i], cuts)]
        places = np.array([self.table[ids[words]].sum(axis=0) for _, words in parts], np.float32).reshape(len(parts), -1)
        places /= np.maximum(np.linalg.norm(places, axis=1), 1e-9)[:, None]
        words = [texts.hashes[each[i]].tolist() for i in kept]
        given = [answers.hashes[answers.first[i]: answers.first[i + 1]].tolist() for i in kept]
        owners = np.array([n for n, _ in parts], np.int64)
        return Index([part.column("item_id")[i].as_py() for i in kept], self.table, places, owners, words, given)


def _parts(whole: slice, cuts: np.ndarray) -> list[slice]:
    """The words of an item and, where it is longer than a passage, those of its passages: no window is like a long item."""
    ends = [*cuts[np.searchsorted(cuts, whole.start): np.searchsorted(cuts, whole.stop)].tolist(), whole.stop]
    return [whole, *(slice(a, b) for a, b in zip(ends, ends[1:]) if len(ends) > 2)]


def build(docs: DataFrame, items: DataFrame) -> ItemBlocks:
    """Term weights over all documents, the latent space, and the items in it."""
    idf = term_weights(docs)
    return ItemBlocks(items, latent_space(docs, items, idf))


def _search(docs: DataFrame, index: Index, schema: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=1 << 19):
            rows = [(row, shared.value.ids[item], *best)
                    for (row, item), best in sorted(shared.value.matches(batch.column("text")).items())]
            if rows:
                at, ids, shares, cosines = zip(*rows)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column("doc_id").take(pa.array(at)), "item_id": pa.array(ids),
                    "lcs_share": pa.array(shares, pa.float64()), "cosine": pa.array(cosines, pa.float64())})

    return whole_texts(docs).mapInArrow(search, schema)


def contaminated(docs: DataFrame, items: DataFrame, indexes: ItemBlocks | None = None) -> DataFrame:
    """doc_id, item_id, lcs_share, cosine: a row for each row of ``docs`` and benchmark item that it contains.

    Every passage of every whole text is searched, in one pass for each block of items; with several blocks the passes are
    stored one after the other. Null and empty texts contain nothing, nor do items without a word. Repeated documents and
    items are answered each by itself; null ids are carried along. Other columns are ignored; with an empty table on either
    side the result is empty.
    """
    kinds = docs.schema["doc_id"].dataType.simpleString(), items.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, lcs_share double, cosine double"
    indexes = build(docs, items) if indexes is None else indexes
    found = docs.sparkSession.createDataFrame([], schema)
    for index in indexes:
        if len(indexes) == 1:
            return _search(docs, index, schema)
        found = found.unionByName(stored(_search(docs, index, schema), "found"))
    return found


def drop_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no benchmark item; searched on the fly, without a shuffle. With
    several blocks of items what is left is stored after each but the last."""
    indexes = build(docs, items)
    for n, index in enumerate(indexes, 1):
        docs = _without(docs, index)
        docs = stored(docs, "clean") if n < len(indexes) else docs
    return docs


def _without(docs: DataFrame, index: Index) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, size=1 << 19):
            keep = np.ones(batch.num_rows, bool)
            keep[[row for row, _ in shared.value.matches(batch.column("text"))]] = False
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(search, docs.schema)


def benchmark(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/benchmark.parquet")
