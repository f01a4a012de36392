"""Token ids of whole texts from a byte-level tokenizer file, as the tokenizers library gives them.

The library cuts a text into pieces by a fixed pattern and encodes each piece by itself. Pieces repeat, so each is encoded
by the library once per worker and remembered, within a bound. Texts that the fast form of the pattern does not cover
(letters outside Latin-1, special tokens) go to the library whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

import pyarrow as pa  # noqa: E402
from pyspark.sql import DataFrame  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

from orderlens.llm.bpe import byte_symbols  # noqa: E402
from orderlens.llm.common import Memo, int_lists, pieces, whole_texts  # noqa: E402

#: Remembered pieces in each Python worker.
PIECES = 1_000_000
#: The piece pattern of byte-level vocabularies for Latin-1 text: letters, digits, contractions, symbols, white space.
_SPACE, _LETTER, _DIGIT = r"\t-\r \x85\xa0", "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼½¾"
LATIN_PIECES = re.compile(f" ?[{_LETTER}]+| ?[{_DIGIT}]+|'s|'t|'re|'ve|'m|'ll|'d| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|"
                          f"[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+")


class ByteEncoder:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tool = Tokenizer.from_str(json.dumps(spec))
        self.tool.no_truncation()
        self.tool.no_padding()
        self.special = re.compile("|".join(re.escape(t["content"]) for t in spec["added_tokens"]) or r"(?!)")
        cut = spec["pre_tokenizer"] or {}
        self.plain = (spec["normalizer"] is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True)
                      and not cut.get("add_prefix_space"))
        self.model = self.tool.model
        self.symbols = dict(enumerate(byte_symbols()))
        self.token_bytes = [i.to_bytes(4, "little") for i in range(self.tool.get_vocab_size())]
        self.known = Memo(self.piece, PIECES)

    def by_library(self, text: str) -> bytes:
        ids = self.tool.encode(text, add_special_tokens=False).ids
        return b"".join([i.to_bytes(4, "little") for i in ids])

    def piece(self, text: str) -> bytes:
        """The ids of one piece, from the library's model; it reads bytes as printable symbols."""
        if text.isascii() and text.isprintable():
            symbols = text.replace(" ", self.symbols[32])
        else:
            symbols = text.encode().decode("latin-1").translate(self.symbols)
        return b"".join([self.token_bytes[t.id] for t in self.model.tokenize(symbols)])

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as little-endian 32-bit integers."""
        if self.plain and not ("<" in text and self.special.search(text)):
            try:
                text.encode("latin-1")
                return b"".join(map(self.known.__getitem__, LATIN_PIECES.findall(text)))
            except UnicodeEncodeError:
                pass
        return self.by_library(text)


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteEncoder:
    """One encoder per Python worker and file."""
    return ByteEncoder(path)


def counts(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens: the encoded length of each row's whole text; null counts as empty, of length 0."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in pieces(batches):
            sizes = [len(tool.encode(t)) // 4 for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sizes, pa.int64())],
                                             names=["doc_id", "n_tokens"])

    return whole_texts(docs).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens bigint")


def with_end(texts: DataFrame, path: str, end_id: int) -> DataFrame:
    """doc_id, ids (with ``end_id`` appended) and first, the number of ids of the rows before in the same partition.

    Rows keep their order; ``texts`` has doc_id and a text that is not null.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool, end, before = encoder(path), end_id.to_bytes(4, "little"), 0
        for batch in pieces(batches):
            parts = [tool.encode(t) + end for t in batch.column("text").to_pylist()]
            first = []
            for part in parts:
                first.append(before)
                before += len(part) // 4
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(first, pa.int64()), int_lists(parts)],
                                             names=["doc_id", "first", "ids"])

    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(run, f"doc_id {kind}, first bigint, ids array<int>")
