import re

import cases
import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from orderlens.llm import simhash as op


def by_hand(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    shingles = [" ".join(words[i:i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(ids, prints, radius=4):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    lowest = {}
    for i, doc_id in enumerate(ids):
        if doc_id is not None:
            lowest[find(i)] = min(doc_id, lowest.get(find(i), doc_id))
    return sorted(((ids[i], f"{prints[i]:016x}", lowest.get(find(i))) for i in range(len(ids))), key=repr)


@given(st.text(alphabet="aB é\t\n\x0b\x1c日", max_size=60))
@settings(max_examples=300, deadline=None)
def test_fingerprint(text):
    assert op.fingerprint(text.encode()) == by_hand(text)


@pytest.mark.parametrize("radius", [0, 1, 3, 4, 7])
def test_bit_sliced_pairs(radius):
    draw = np.random.default_rng(1)
    values = draw.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = [np.bitwise_or.reduce(np.uint64(1) << draw.integers(0, 64, (k, 40)).astype(np.uint64)) for k in range(1, 9)]
    values = np.concatenate([values, *(values ^ f for f in flips)])
    draw.shuffle(values)
    for starts in ([0, len(values)], [0, 1, 2, 66, 131, 300, len(values)]):
        found = {p for a, b in op.near_pairs(values, np.array(starts), radius) for p in zip(a.tolist(), b.tolist())}
        group = np.searchsorted(starts, np.arange(len(values)), side="right")
        assert found == {(i, j) for j in range(len(values)) for i in range(j) if group[i] == group[j]
                         and int(values[i] ^ values[j]).bit_count() <= radius}


def test_edge_cases(spark):
    rows = cases.rows()
    assert cases.plain(op.near_duplicates(cases.documents(spark))) == groups(
        [r[0] for r in rows], [by_hand(r[1]) for r in rows])
    assert op.near_duplicates(cases.empty(spark)).collect() == []
    kept = op.drop_near_duplicates(cases.documents(spark))
    assert kept.columns == cases.documents(spark).columns
    members = {}
    for g in groups(list(range(len(rows))), [by_hand(r[1]) for r in rows]):
        members.setdefault(g[2], []).append(rows[g[0]][0])
    wanted = [min(ids, key=lambda i: (i is None, i)) for ids in members.values()]  # one row per component, not per id
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(wanted, key=repr)


def test_chains_and_split_buckets(spark):
    """Steps of four bits that lead far, and buckets cut into parts, lose no link."""
    prints, value = [], 0
    for step in range(12):
        prints.append(value)
        value ^= 0b1111 << 4 * step
    prints += [0xF0F0 << 40, (0xF0F0 << 40) ^ 1]
    frame = spark.createDataFrame([(p - (1 << 64) if p >> 63 else p,) for p in prints], "fp long")
    for bucket in (8192, 2):
        found = {(r["node"], r["root"]) for r in op.components(op.links(frame, 4, bucket_rows=bucket)).collect()}
        assert found == {(p, 0) for p in prints[:12]} | {(p, prints[12]) for p in prints[12:]}


def test_a_hub_is_answered_without_a_join(spark, monkeypatch):
    """A node with most of all links, chains beside it, and whatever number of hubs."""
    rows = [(0, i) for i in range(1, 400)] + [(1000 + i, 1001 + i) for i in range(30)] + [(399, 2000), (2000, 2001)]
    edges = spark.createDataFrame(rows, "u long, v long").repartition(5)
    wanted = {i: 0 for i in range(400)} | {2000: 0, 2001: 0} | {1000 + i: 1000 for i in range(31)}
    for hubs in (1, 4, 1024, 10**9):
        monkeypatch.setattr(op, "HUBS", hubs)
        assert {r["node"]: r["root"] for r in op.components(edges).collect()} == wanted


def test_blocks_follow_the_number_of_fingerprints():
    counts = [op.blocks_for(n) for n in (0, 10**6, 10**8, 10**9, 10**10, 10**11, 10**14)]
    assert counts == sorted(counts) and counts[0] == 6 and counts[-1] > 6
    for blocks in (6, 7, 8):
        masks = op.block_masks(blocks, 4)
        draw = np.random.default_rng(blocks)
        for _ in range(200):  # whatever four bits differ, some choice of blocks agrees
            flipped = sum(1 << int(b) for b in draw.choice(64, 4, replace=False))
            assert any(flipped & m == 0 for m in masks)


@pytest.mark.parametrize("blocks", [7, 8])
def test_more_blocks_find_the_same_links(spark, blocks):
    draw = np.random.default_rng(blocks)
    base = [int(x) for x in draw.integers(0, 1 << 62, 30)]
    prints = base + [b ^ sum(1 << int(i) for i in draw.choice(60, draw.integers(1, 7), replace=False)) for b in base * 3]
    frame = spark.createDataFrame([(p,) for p in set(prints)], "fp long")
    assert cases.plain(op.components(op.links(frame, blocks=blocks))) == cases.plain(op.components(op.links(frame)))


def test_test_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    assert cases.plain(op.near_duplicates(docs)) == groups([r[0] for r in rows], [by_hand(r[1]) for r in rows])


def test_components_of_equal_ids_each_keep_a_row(spark):
    """One row per component stays, the smallest by doc_id and text, also where rows share a doc_id or have none."""
    rows = [r[:2] for r in cases.rows()] + [(None, "alone without an id"), (None, "another text that has no id either")]
    rows += [(5, "zebras graze in the far valley"), (3, "a near copy of a kept row"), (5, "a near  copy of a kept row")]
    prints = [by_hand(t) for _, t in rows]
    linked = {i: {j for j, p in enumerate(prints) if (prints[i] ^ p).bit_count() <= 4} for i in range(len(rows))}
    while (wider := {i: set().union(*(linked[j] for j in near)) for i, near in linked.items()}) != linked:
        linked = wider
    wanted = {min((rows[j] for j in near), key=lambda r: (r[0] is None, r[0] or 0, r[1] or "")) for near in linked.values()}
    assert len(wanted) == len(set(map(frozenset, linked.values())))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = op.drop_near_duplicates(docs).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)
    kept = op.drop_near_duplicates(cases.documents(spark)).select("doc_id", "text").collect()
    assert [r["text"] for r in kept if r["doc_id"] == 9].count("other text, same id") == 1
    assert [r["text"] for r in kept if r["doc_id"] == 9].count("unique text") == 1
