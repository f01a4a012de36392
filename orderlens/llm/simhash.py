"""SimHash near-dedup with bit-sliced comparison.

Fingerprints are made in Arrow batches. Only distinct fingerprints are compared. Two fingerprints at most ``radius`` bits
apart agree on at least ``blocks - radius`` of ``blocks`` bit blocks, so they meet in the bucket of at least one choice of
that many blocks: no link is missed. Buckets larger than ``bucket_rows`` are cut into parts that meet pair by pair in
different tasks. Inside a bucket the fingerprints lie as vertical bit planes, 64 of them in a word; carry-save counters add
up the differing bits of 64 pairs at once, and words in which every pair is beyond the radius are abandoned. A task
returns a spanning forest of its links, never all pairs. Components come from alternating stars on stored edge tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import id_text, pieces, stored, whole_texts

WORDS, SEED, RADIUS = 4, 42, 4
BLOCKS, BUCKET_ROWS = 6, 8192
#: (query, word) pairs compared at once, and the number of bits after which hopeless words are abandoned.
TILES, ABANDON_AFTER = 1 << 15, (24, 32, 48)


def fingerprint(text: bytes, words: int = WORDS) -> int:
    """64-bit SimHash of the UTF-8 text: bit i is set if it is set in over half the hashes of its word shingles."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    ends = np.cumsum(np.fromiter(map(len, tokens), np.int64, len(tokens)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    size = min(words, len(tokens))
    starts, ends = starts[: len(tokens) - size + 1], ends[size - 1:]
    votes = np.zeros(64, np.int64)
    for at in range(0, len(starts), 1 << 15):
        hashes = np.array([xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in
                           zip(starts[at: at + (1 << 15)].tolist(), ends[at: at + (1 << 15)].tolist())], np.uint64)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        votes += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * votes > len(starts), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS, *extra: str) -> DataFrame:
    """doc_id, the named extra columns, fp (the 64 bits as a signed long): one row per row of ``docs``; null text counts as
    empty, fp 0."""
    texts = whole_texts(docs, *extra).withColumn("text", F.col("text").cast("binary"))
    names = ["doc_id", *extra]

    def make(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            values = np.array([fingerprint(t, words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([*map(batch.column, names), pa.array(values.view(np.int64))],
                                             names=[*names, "fp"])

    kinds = ", ".join(f"{n} {docs.schema[n].dataType.simpleString()}" for n in names)
    return texts.mapInArrow(make, f"{kinds}, fp bigint")


def bit_planes(values: np.ndarray) -> np.ndarray:
    """Vertical form: plane b, word w has bit b of the values 64w to 64w + 63. The length is a multiple of 64."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.ascontiguousarray(np.packbits(bits.T, axis=1, bitorder="little")).view(np.uint64)


def near_pairs(values: np.ndarray, starts: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs i < j within one group of ``values`` (group g is starts[g] to starts[g + 1]) at most ``radius`` apart.

    Every group starts a new word of 64 lanes. A tile is one value against one word of its group.
    """
    sizes = np.diff(starts)
    group_words = -(-sizes // 64)
    first_word = np.concatenate(([0], np.cumsum(group_words)))
    lane = np.arange(len(values)) - np.repeat(starts[:-1] - first_word[:-1] * 64, sizes)
    owner = np.full(first_word[-1] * 64, -1, np.int64)
    owner[lane] = np.arange(len(values))
    padded = np.zeros(len(owner), np.uint64)
    padded[lane] = values
    planes = bit_planes(padded)
    filled = np.packbits(owner >= 0, bitorder="little").view(np.uint64)
    tiles = np.repeat(group_words, sizes)
    tile_ends = np.cumsum(tiles)
    base = np.repeat(first_word[:-1], sizes)
    query_at = 0
    while query_at < len(values):
        begin = tile_ends[query_at] - tiles[query_at]
        stop = max(query_at + 1, int(np.searchsorted(tile_ends, begin + TILES, side="right")))
        query = np.repeat(np.arange(query_at, stop), tiles[query_at:stop])
        word = np.arange(len(query)) - np.repeat(tile_ends[query_at:stop] - tiles[query_at:stop] - begin,
                                                 tiles[query_at:stop]) + base[query]
        query_at = stop
        ahead = (word + 1) * 64 > lane[query]  # the others hold smaller indices only
        query, word = query[ahead], word[ahead]
        close = np.zeros(len(query), np.uint64)
        counters = [np.zeros(len(query), np.uint64) for _ in range(radius.bit_length() + 1)]
        here = np.arange(len(query))
        for bit in range(64):
            asked = np.uint64(0) - ((values[query] >> np.uint64(bit)) & np.uint64(1))
            carry = planes[bit][word] ^ asked
            for k in range(len(counters) - 1):  # carry-save: one adder per binary digit of the distance
                counters[k], carry = counters[k] ^ carry, counters[k] & carry
            counters[-1] |= carry
            if bit + 1 in ABANDON_AFTER or bit == 63:
                alive = ~_beyond(counters, radius) & filled[word]
                keep = alive != 0
                if bit == 63:
                    close[here] = alive
                elif not keep.all():
                    query, word, here = query[keep], word[keep], here[keep]
                    counters = [c[keep] for c in counters]
        tile, at = np.nonzero(np.unpackbits(close[here].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
        left, right = query[tile], owner[word[tile] * 64 + at]
        wanted = left < right
        yield left[wanted], right[wanted]


def _beyond(counters: list[np.ndarray], radius: int) -> np.ndarray:
    """Lanes whose counted distance is over the radius: a comparison of binary digits, highest first."""
    over, equal = counters[-1].copy(), ~counters[-1]
    for k in range(len(counters) - 2, -1, -1):
        if radius >> k & 1:
            equal &= counters[k]
        else:
            over |= equal & counters[k]
            equal &= ~counters[k]
    return over


def spanning_links(values: np.ndarray, starts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Links (index, smallest index of its component) that connect what near_pairs connects, fewer than the values."""
    root = np.arange(len(values))
    for left, right in near_pairs(values, starts, radius):
        while True:
            a, b = root[left], root[right]
            apart = a != b
            if not apart.any():
                break
            left, right, a, b = left[apart], right[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while not np.array_equal(root[root], root):
                root = root[root]
    linked = np.flatnonzero(root != np.arange(len(values)))
    return linked, root[linked]


def block_masks(blocks: int, radius: int) -> list[int]:
    """Bit masks of all choices of ``blocks - radius`` of the blocks into which 64 bits are cut."""
    cuts = [64 * i // blocks for i in range(blocks + 1)]
    parts = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [sum(chosen) for chosen in combinations(parts, blocks - radius)]


def blocks_for(rows: int, radius: int = RADIUS, bucket: int = 64) -> int:
    """How many blocks ``rows`` fingerprints want: more blocks leave more bits that must agree, so buckets of about
    ``bucket`` unlike fingerprints, for more choices of blocks."""
    blocks = max(BLOCKS, radius + 1)
    while rows > bucket << 64 * (blocks - radius) // blocks and blocks < radius + 6:
        blocks += 1
    return blocks


def links(prints: DataFrame, radius: int = RADIUS, blocks: int | None = None, bucket_rows: int = BUCKET_ROWS) -> DataFrame:
    """u, v: links that connect all distinct fingerprints of ``prints`` (column fp) at most ``radius`` bits apart."""
    masks = block_masks(blocks or blocks_for(prints.count(), radius), radius)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    keyed = prints.select("fp", F.posexplode(F.array(*[F.lit(m).cast("long") for m in signed])).alias("choice", "mask"))
    keyed = keyed.select("fp", "choice", F.col("fp").bitwiseAND(F.col("mask")).alias("part"))
    # Large buckets are cut into parts; every two parts of a bucket meet in a task of their own.
    large = (keyed.groupBy("choice", "part").count().filter(F.col("count") > bucket_rows)
             .select("choice", "part", F.ceil(F.col("count") / bucket_rows).cast("int").alias("parts")))
    dealt = (keyed.join(large, ["choice", "part"], "left")
             .withColumn("mine", F.pmod(F.xxhash64("fp"), F.coalesce("parts", F.lit(1))).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("parts", F.lit(1)) - 1)))
             .select("fp", "choice", "part", F.least("mine", "other").alias("a"), F.greatest("mine", "other").alias("b")))
    keys = ["choice", "part", "a", "b"]
    sorted_groups = dealt.repartition(*keys).sortWithinPartitions(*keys)

    def compare(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            rows = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype(np.int64) for c in [*keys, "fp"]])
            rows = np.concatenate([*kept, rows], axis=1)
            cut = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(axis=0)) + 1
            last = int(cut[-1]) if len(cut) else 0
            yield from _compared(rows[:, :last], radius)
            kept = [rows[:, last:]]
        for rows in kept:
            yield from _compared(rows, radius)

    return sorted_groups.mapInArrow(compare, "u bigint, v bigint").distinct()


def _compared(rows: np.ndarray, radius: int) -> Iterator[pa.RecordBatch]:
    """The links of whole groups, given as columns choice, part, a, b, fp in group order."""
    if not rows.shape[1]:
        return
    new = np.concatenate(([True], (rows[:4, 1:] != rows[:4, :-1]).any(axis=0)))
    starts = np.append(np.flatnonzero(new), rows.shape[1])
    paired = np.repeat(np.diff(starts) > 1, np.diff(starts))
    values, sizes = rows[4][paired], np.diff(starts)[np.diff(starts) > 1]
    found, root = spanning_links(values.view(np.uint64), np.concatenate(([0], np.cumsum(sizes))), radius)
    yield pa.RecordBatch.from_arrays([pa.array(values[found]), pa.array(values[root])], names=["u", "v"])


#: A node with more than one in so many of all rows is a hub; there are fewer hubs than this.
HUBS = 1024


def _with(rows: DataFrame, lowest: DataFrame, total: int) -> DataFrame:
    """Rows (u, v) with ``m`` of their u from ``lowest`` (u, m, n: rows of u in ``rows``).

    Hubs are broadcast: since each has over ``total / HUBS`` rows, there are fewer than HUBS, and their rows stay where they
    are. No task of the join of the others gets more rows of one node than that.
    """
    hubs = lowest.filter(F.col("n") > total / HUBS).select("u", F.col("m").alias("hub_m"))
    marked = rows.join(F.broadcast(hubs), "u", "left")
    others = marked.filter("hub_m IS NULL").drop("hub_m").join(lowest.select("u", "m"), "u")
    return marked.filter("hub_m IS NOT NULL").select("u", "v", F.col("hub_m").alias("m")).unionByName(
        others.select("u", "v", "m"))


def components(edges: DataFrame) -> DataFrame:
    """node, root for every node of the edges (u, v): root is the smallest node that can be reached.

    Alternating large and small stars; each round is stored, so lineage stays short and a lost executor costs a round.
    """
    def signature(frame: DataFrame) -> tuple:
        return tuple(frame.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first())

    rows = stored(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).filter("u <> v")
                  .distinct(), "links")
    seen = signature(rows)
    while seen[0]:
        both = rows.unionByName(rows.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"), F.count("*").alias("n"))
        large = _with(both, lowest, 2 * seen[0]).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large, "links")
        below = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = (_with(large, below, seen[0]).select(F.inline(F.array(
            F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))))
            .filter("u <> v").distinct())
        rows = stored(small, "links")
        now = signature(rows)
        if now == seen:
            break
        seen = now
    return rows.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        rows.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _linked(docs: DataFrame, words: int, radius: int, *extra: str) -> tuple[DataFrame, DataFrame]:
    """Two tables: doc_id, the named extra columns and fp, one row per row of ``docs``; and fp, root, component_id."""
    rows = stored(fingerprints(docs, words, *extra), "fingerprints")
    prints = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "distinct-fingerprints")
    roots = stored(components(links(prints, radius)), "components")
    members = prints.join(roots, F.col("fp") == F.col("node"), "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root"))
    lowest = members.groupBy("root").agg(F.min("first_id").alias("component_id"))
    return rows, members.join(lowest, "root").select("fp", "root", "component_id")


def near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row per row of ``docs``.

    component_id is the smallest doc_id among all rows whose fingerprints are connected by steps of at most ``radius``
    bits, the row itself included; it is null only where all of them have a null doc_id. Null and empty texts have
    fingerprint zero, which links like any other. Repeated rows appear repeatedly. Other columns are ignored; an empty
    table gives an empty result.
    """
    rows, named = _linked(docs, words, radius)
    return rows.join(named, "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                                         "component_id")


def drop_near_duplicates(docs: DataFrame, words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns, of which one per component remains: the row of its smallest doc_id.

    Of several rows of a component with that doc_id the one with the smallest text stays. Components are told apart by
    their fingerprints, so unrelated texts with one doc_id, or without any, each stay.
    """
    keyed = docs.withColumns({"__digest": F.sha2(F.coalesce("text", F.lit("")), 256), "__id": id_text("doc_id")})
    rows, named = _linked(keyed, words, radius, "__digest")
    first = (rows.join(named, "fp").filter("doc_id <=> component_id")
             .select("__digest", id_text("doc_id").alias("__id"), F.col("root").alias("__root")).distinct())
    order = "row_number() OVER (PARTITION BY __root ORDER BY text NULLS FIRST)"
    return (keyed.join(first, ["__digest", "__id"]).withColumn("__n", F.expr(order)).filter("__n = 1")
            .drop("__digest", "__id", "__root", "__n"))
