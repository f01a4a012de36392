"""Merkle manifest of a dataset: leaves per document, a tree per language, a root over the trees.

H is the lower-case hex SHA-256 of the inputs one after the other, digests as hex text. A tree is cut into blocks of
``arity ** height`` neighbouring nodes. A task holds one block: each parent in it keeps the hash state it had before every
child slot. Folding a leaf copies the state of its slot, adds the replacement and the siblings to the right, and goes on
with the parent's digest; the siblings to the left are never hashed again. The blocks' roots are the nodes of the next
round, until one node is left per tree; then the same rounds run over the trees' roots. On the way back down every block
gets the path from its root to the root of all, as the text of left and right siblings per step, so its task folds all of
its leaves up to the end. No task holds more than a block and one path, and every round is stored.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.llm.common import numbered, stored

#: Children of a parent, and nodes of a block at most.
ARITY, BLOCK = 2, 4096
#: Documents whose crc32 this divides are tampered with in the audit.
TAMPER = 7
PATH = "array<struct<left: string, right: string>>"


def leaf_digest(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """H of the fields, each ``-`` if null, else the number of its UTF-8 bytes, ``:`` and the field."""
    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*map(field, (doc_id, source, lang, n_chars, text))), 256)


class Block:
    """The part of a tree over neighbouring nodes: digests by level, and each parent's state before each child slot."""

    def __init__(self, nodes: list[bytes], arity: int, height: int | None):
        """``height`` levels of parents, or as many as lead to a single node."""
        self.arity, self.levels, self.states = arity, [nodes], []
        while len(self.levels[-1]) > 1 if height is None else len(self.states) < height:
            below, digests, kept = self.levels[-1], [], []
            for at in range(0, len(below), arity):
                state, before = hashlib.sha256(), []
                for child in below[at:at + arity]:
                    before.append(state.copy())
                    state.update(child)
                digests.append(state.hexdigest().encode())
                kept.append(before)
            self.levels.append(digests)
            self.states.append(kept)

    @property
    def root(self) -> bytes:
        return self.levels[-1][0]

    def steps(self, at: int) -> list[tuple[bytes, bytes]]:
        """The siblings of node ``at`` and of its ancestors, left and right of them, level by level."""
        found = []
        for below in self.levels[:-1]:
            run = at - at % self.arity
            found.append((b"".join(below[run:at]), b"".join(below[at + 1:run + self.arity])))
            at //= self.arity
        return found

    def fold(self, at: int, digest: bytes) -> bytes:
        """The block's root if node ``at`` had this digest."""
        for below, states in zip(self.levels, self.states):
            parent, slot = divmod(at, self.arity)
            state = states[parent][slot].copy()
            state.update(digest + b"".join(below[at + 1:(parent + 1) * self.arity]))
            digest, at = state.hexdigest().encode(), parent
        return digest


def shape(arity: int, block: int) -> tuple[int, int]:
    """Nodes and height of the largest full block of at most ``block`` nodes."""
    if arity < 2 or block < arity:
        raise ValueError("a parent has two children at least, and a block holds them")
    height = 1
    while arity ** (height + 1) <= block:
        height += 1
    return arity ** height, height


def _block(nodes: pa.Table, arity: int, block: int) -> tuple[pa.Table, Block]:
    """The rows in order of position, and the part of the tree over their digests."""
    nodes = nodes.sort_by("position")
    nodes_each, height = shape(arity, block)
    whole = nodes.column("size")[0].as_py() <= nodes_each
    return nodes, Block([d.encode() for d in nodes.column("digest").to_pylist()], arity, None if whole else height)


def climb(leaves: DataFrame, arity: int = ARITY, block: int = BLOCK) -> list[DataFrame]:
    """From nodes (tree, position, size, digest) of all trees, the nodes of every round up to one node per tree.

    The first table is ``leaves`` itself. A tree that is down to one node keeps it.
    """
    nodes_each = shape(arity, block)[0]

    def root(key: tuple, nodes: pa.Table) -> pa.Table:
        size = nodes.column("size")[0].as_py()
        return pa.table({"tree": [key[0].as_py()], "position": [key[1].as_py()], "size": [-(-size // nodes_each)],
                         "digest": [_block(nodes, arity, block)[1].root.decode()]})

    levels = [leaves]
    while True:
        nodes = levels[-1].select("tree", "position", "size", "digest").withColumn("chunk", _chunk(nodes_each))
        levels.append(stored(nodes.groupBy("tree", "chunk")
                             .applyInArrow(root, "tree string, position long, size long, digest string"), "merkle-nodes"))
        if (levels[-1].agg(F.max("size")).first()[0] or 1) == 1:
            return levels


def _chunk(nodes_each: int) -> Column:
    return F.floor(F.col("position") / nodes_each).cast("long")


def descend(levels: list[DataFrame], tops: DataFrame, arity: int = ARITY, block: int = BLOCK) -> DataFrame:
    """The paths of all nodes of ``levels[1]``: tree, chunk, path and the columns of ``tops`` that come with it.

    ``tops`` has tree, path, subroot and root of each tree's last node.
    """
    nodes_each = shape(arity, block)[0]
    paths = tops.select("tree", F.lit(0).cast("long").alias("chunk"), "path", "subroot", "root")

    def inner(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, part = _block(nodes, arity, block)
        upper = above.column("path")[0].as_py()
        path = [[{"left": a.decode(), "right": b.decode()} for a, b in part.steps(i)] + upper for i in range(len(nodes))]
        return pa.table({"tree": nodes.column("tree"), "chunk": nodes.column("position"),
                         "path": pa.array(path, above.schema.field("path").type),
                         **{c: pa.array([above.column(c)[0].as_py()] * len(nodes)) for c in ("subroot", "root")}})

    for nodes in reversed(levels[1:-1]):
        keyed = nodes.withColumn("chunk", _chunk(nodes_each))
        paths = stored(keyed.groupBy("tree", "chunk").cogroup(paths.groupBy("tree", "chunk"))
                       .applyInArrow(inner, f"tree string, chunk long, path {PATH}, subroot string, root string"),
                       "merkle-paths")
    return paths


def manifest(docs: DataFrame, tampered: Column | None = None, arity: int = ARITY, block: int = BLOCK) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified: one row per row of ``docs``.

    Leaves of one language (null is a language of its own) ascend by doc_id, a null doc_id last, rows of one doc_id by their
    digest. Every ``arity`` neighbours (the last run may be shorter) become their H until one node is left, the subroot; a
    lone leaf is its own. Subroots in order of language, null first and else by UTF-8 bytes, give the root the same way.
    proof_sha256 is the H of all siblings from the leaf up to the root. folded_root is what the leaf folds to when its
    document is checked; where ``tampered`` holds (null counts as no) n_chars is one more by then, null stays null.
    verified tells whether it equals the root. Null fields have their own mark in a leaf, so null and empty text differ.
    Repeated rows are leaves of their own. Other columns are ignored; an empty table gives an empty result.
    """
    fields = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars", "text")]
    changed = [F.col("n_chars").cast("decimal(20,0)") + 1 if c == 3 else f for c, f in enumerate(fields)]
    tampered = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    rows = stored(docs.select(
        "doc_id", F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("")).alias("tree"), leaf_digest(*fields).alias("digest"),
        F.when(tampered, leaf_digest(*changed)).alias("changed"), F.monotonically_increasing_id().alias("copy")), "leaves")
    order = [F.col("doc_id").asc_nulls_last(), F.col("digest"), F.col("copy")]  # copy spreads repeated rows
    leaves = numbered(rows, order, "tree", "leaves").drop("copy")
    levels = climb(leaves, arity, block)
    subroots = levels[-1].select(F.lit("").alias("tree"), F.col("tree").alias("lang"), "digest")
    trees = climb(stored(numbered(subroots, [F.col("lang")], "tree", "subroots"), "subroots"), arity, block)
    root = trees[-1].select("tree", F.array().cast(PATH).alias("path"), F.col("digest").alias("subroot"),
                            F.col("digest").alias("root"))
    tops = language_paths(trees, root, arity, block)
    return _checked(leaves, descend(levels, tops, arity, block), arity, block)


def language_paths(trees: list[DataFrame], root: DataFrame, arity: int, block: int) -> DataFrame:
    """tree, path, subroot and root of each language's last node: its path through the tree over the subroots."""
    nodes_each = shape(arity, block)[0]

    def inner(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, part = _block(nodes, arity, block)
        upper = above.column("path")[0].as_py()
        path = [[{"left": a.decode(), "right": b.decode()} for a, b in part.steps(i)] + upper for i in range(len(nodes))]
        return pa.table({"tree": nodes.column("lang"), "path": pa.array(path, above.schema.field("path").type),
                         "subroot": nodes.column("digest"),
                         "root": pa.array([above.column("root")[0].as_py()] * len(nodes))})

    paths = descend(trees, root, arity, block)
    return stored(trees[0].withColumn("chunk", _chunk(nodes_each)).groupBy("tree", "chunk")
                  .cogroup(paths.groupBy("tree", "chunk"))
                  .applyInArrow(inner, f"tree string, path {PATH}, subroot string, root string"), "merkle-paths")


def _checked(leaves: DataFrame, paths: DataFrame, arity: int, block: int) -> DataFrame:
    kind = leaves.schema["doc_id"].dataType.simpleString()
    schema = (f"doc_id {kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string, "
              "verified boolean")

    def check(nodes: pa.Table, above: pa.Table) -> pa.Table:
        nodes, part = _block(nodes, arity, block)
        subroot, root = (above.column(c)[0].as_py() for c in ("subroot", "root"))
        upper, outer = [], b""
        for step in above.column("path")[0].as_py():  # the ancestors' states, left siblings hashed once for the block
            upper.append((hashlib.sha256(step["left"].encode()), step["right"].encode()))
            outer += (step["left"] + step["right"]).encode()
        proofs, folded = [], []
        for at, (leaf, other) in enumerate(zip(part.levels[0], nodes.column("changed").to_pylist())):
            proof = hashlib.sha256(b"".join(a + b for a, b in part.steps(at)) + outer)
            digest = part.fold(at, other.encode() if other else leaf)
            for before, right in upper:
                state = before.copy()
                state.update(digest + right)
                digest = state.hexdigest().encode()
            proofs.append(proof.hexdigest())
            folded.append(digest.decode())
        same = [subroot] * len(folded), [root] * len(folded)
        return pa.table({"doc_id": nodes.column("doc_id"), "leaf": nodes.column("digest"), "subroot": pa.array(same[0]),
                         "root": pa.array(same[1]), "proof_sha256": proofs, "folded_root": folded,
                         "verified": [f == root for f in folded]})

    keyed = leaves.withColumn("chunk", _chunk(shape(arity, block)[0]))
    return (keyed.groupBy("tree", "chunk").cogroup(paths.groupBy("tree", "chunk")).applyInArrow(check, schema))


def tamper_sign(doc_id: Column, every: int = TAMPER) -> Column:
    """Whether ``every`` divides the unsigned crc32 of the decimal doc_id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % every == 0
