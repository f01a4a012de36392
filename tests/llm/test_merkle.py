import hashlib
import zlib

import cases
import pytest
from pyspark.sql import functions as F

from orderlens.llm import merkle as op
from orderlens.llm.queries import op13_merkle


def h(*inputs):
    return hashlib.sha256("".join(inputs).encode()).hexdigest()


def leaf(row, more=0):
    doc_id, text, lang, source, n_chars = row
    n_chars = None if n_chars is None else n_chars + more
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels(nodes, arity):
    """All levels of a tree; and for a node the siblings of each level, left and right."""
    found = [nodes]
    while len(found[-1]) > 1:
        found.append([h(*found[-1][i:i + arity]) for i in range(0, len(found[-1]), arity)])
    return found


def siblings(tree, at, arity):
    for below in tree[:-1]:
        run = at - at % arity
        yield below[run:at], below[at + 1:run + arity]
        at //= arity


def by_hand(rows, tampered, arity=2):
    groups = {}
    for row in rows:
        groups.setdefault(row[2], []).append(row)
    names = sorted(groups, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in names:
        groups[lang].sort(key=lambda r: (r[0] is None, r[0] or 0, leaf(r)))
    trees = {lang: levels([leaf(r) for r in groups[lang]], arity) for lang in names}
    top = levels([trees[lang][-1][0] for lang in names], arity)
    out = []
    for n, lang in enumerate(names):
        for at, row in enumerate(groups[lang]):
            path = [*siblings(trees[lang], at, arity), *siblings(top, n, arity)]
            digest = leaf(row, 1 if tampered(row) else 0)
            for left, right in path:
                digest = h(*left, digest, *right)
            out.append((row[0], leaf(row), trees[lang][-1][0], top[-1][0], h(*(s for l, r in path for s in (*l, *r))),
                        digest, digest == top[-1][0]))
    return sorted(out, key=repr)


def sevenths(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0


def wide(rows):
    return [(r[0], r[1], r[2], r[3], r[4]) for r in rows]


@pytest.mark.parametrize("arity,block", [(2, 4096), (2, 4), (3, 9), (4, 5), (2, 2)])
def test_edge_cases(spark, arity, block):
    docs = cases.documents(spark)
    rows = wide(docs.select("doc_id", "text", "lang", "source", "n_chars").collect())
    got = op.manifest(docs, op.tamper_sign(F.col("doc_id")), arity, block)
    assert cases.plain(got) == by_hand(rows, sevenths, arity)
    assert op.manifest(cases.empty(spark), None, arity, block).collect() == []


def test_lone_leaves_null_counts_and_no_rows_lost(spark):
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    rows = [(7 * i, f"t{i}", ["de", "en", "é", None, "", "zz"][min(i % 9, 5)], "s", None if i % 4 == 0 else 2**63 - 1 - i % 2)
            for i in range(1, 60)] + [(1, "alone", "solo", None, 3)]
    docs = spark.createDataFrame(rows, schema).repartition(5)
    for block in (2, 8, 64):
        got = op.manifest(docs, F.col("doc_id") % 2 == 0, 2, block)
        assert cases.plain(got) == by_hand(rows, lambda r: r[0] % 2 == 0)
    one = docs.filter("doc_id = 1")
    (row,) = op.manifest(one).collect()
    assert row["leaf"] == row["subroot"] == row["root"] == row["folded_root"] and row["verified"]
    assert row["proof_sha256"] == hashlib.sha256(b"").hexdigest()


def test_a_third_of_the_rows_repeated(spark):
    """Equal rows are leaves of their own; they spread over the ranges."""
    rows = [(5, "same", "en", "s", 4)] * 40 + [(i, f"t{i}", "en", "s", i) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(7)
    assert cases.plain(op.manifest(docs, None, 2, 8)) == by_hand(rows, lambda r: False)


def test_states_before_slots_are_not_changed_by_folding():
    part = op.Block([h(str(i)).encode() for i in range(11)], 4, None)
    for at in range(11):
        assert part.fold(at, part.levels[0][at]) == part.root
        assert part.fold(at, b"x" * 64) != part.root
    assert part.fold(3, part.levels[0][3]) == part.root
    with pytest.raises(ValueError):
        op.shape(1, 8)


def test_test_table(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = wide(docs.select("doc_id", "text", "lang", "source", "n_chars").collect())
    wanted = by_hand(rows, sevenths)
    assert cases.plain(op13_merkle(spark, small)) == wanted
    assert sum(not r[-1] for r in wanted) > 5
