"""Exact BPE encoding by backtracking, and decoding by an offset table.

A word is a string of symbols: one per byte, the last one marked as a word end. An Aho-Corasick automaton over all tokens
gives the longest token that starts at each place. The encoder takes it, goes to the next place, and steps back to the
next shorter token where two neighbours are not compatible. Two neighbouring tokens are compatible if merging their bytes
in rank order never joins across the border; answers are kept in a table. A row of valid tokens whose neighbours are all
compatible is the one result of the merges, and each place is left for good at most once, so time is linear in the word.
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator
from functools import cached_property, lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from orderlens.llm.common import Memo, int_lists, pieces, whole_texts

#: Bounds of the caches in each Python worker.
WORDS, PAIRS = 250_000, 300_000
NEVER = 1 << 62
#: The word pattern of the vocabulary, and the same for lower-case Latin-1 text. Other texts are normalised and cut into
#: words by the tokenizer file's own rules, since libraries differ in the Unicode version their letters are from.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|"
                         "[^\t-\r \x85\xa0a-zªµºß-öø-ÿ0-9²³¹¼½¾]+")


@lru_cache(maxsize=1)
def byte_symbols() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies: printable Latin-1 as it is, the rest from U+0100."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in plain else chr(next(others)) for b in range(256)]


class Encoder:
    """Encoder and decoder of one tokenizer file whose words end in a marked symbol."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.mark = model["end_of_word_suffix"]
        self.ids: dict[str, int] = {self._symbols(t): i for t, i in model["vocab"].items()}
        names = {i: t for t, i in model["vocab"].items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = re.compile("(" + ("|".join(map(re.escape, self.special)) or "(?!)") + ")")
        self.simple = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"] == WORD_PATTERN
        self.path = path
        self.token_bytes = {i: i.to_bytes(4, "little") for i in [*self.ids.values(), *self.special.values()]}
        self.size = {i: len(s) for s, i in self.ids.items()}
        self._merge_tables(model["merges"])
        self.automaton = ahocorasick.Automaton()
        for symbols, token in self.ids.items():
            if token in self.valid:
                self.automaton.add_word(symbols, (token, len(symbols)))
        self.automaton.make_automaton()
        self.shorter = {i: next((self.ids[s[:n]] for n in range(len(s) - 1, 0, -1)
                                 if self.ids.get(s[:n]) in self.valid), -1) for s, i in self.ids.items()}
        self.pairs = Memo(lambda pair: not self._joins(*pair, NEVER), PAIRS)
        self.words = Memo(self.encode_word, WORDS)
        self.others = Memo(self.encode_symbols, WORDS // 4)
        table = [names.get(i, "").encode() + b" " for i in range(max(names) + 1)]
        self.table = np.frombuffer(b"".join(table), np.uint8)
        self.offsets = np.cumsum([0, *map(len, table)])

    def _symbols(self, token: str) -> str:
        """Symbols of a token as written in the file; a marked last symbol becomes one private character."""
        if token.endswith(self.mark) and token != self.mark:
            token = token[: -len(self.mark)]
            return token[:-1] + chr(0xE000 + ord(token[-1]))
        return token

    def _merge_tables(self, merges: list) -> None:
        """rank: of each pair; split: the parts and rank of each merged token; valid: tokens that their own text yields."""
        self.rank: dict[tuple[int, int], int] = {}
        self.split: dict[int, tuple[int, int, int]] = {}
        made: set[int] = set()
        for order, merge in enumerate(merges):
            left, right = (self.ids[self._symbols(part)] for part in
                           (merge if isinstance(merge, list) else merge.split(" ")))
            token = self.ids[self._symbols(merge[0] + merge[1]) if isinstance(merge, list) else
                             self._symbols(merge.replace(" ", "", 1))]
            self.rank[left, right] = order
            if token not in self.split:
                self.split[token] = left, right, order
        self.valid = {t for t, n in self.size.items() if n == 1}
        for token, (left, right, order) in self.split.items():
            if left in self.valid and right in self.valid and not self._joins(left, right, order):
                made.add(token)
                self.valid.add(token)

    def _joins(self, left: int, right: int, until: int) -> bool:
        """Whether rank-order merging joins a part at the end of ``left`` with one at the start of ``right`` before
        both tokens are complete and before rank ``until``. Of equal ranks the left one goes first."""
        x, x_end = left, until
        while True:
            y, y_end = right, until
            while True:
                order = self.rank.get((x, y))
                if order is not None and order < x_end and order <= y_end and order < until:
                    return True
                if y not in self.split:
                    break
                y, _, y_end = self.split[y]
            if x not in self.split:
                return False
            _, x, x_end = self.split[x]

    def encode_word(self, word: str) -> bytes:
        """Token ids of one word (normalised, without white space) as little-endian 32-bit integers."""
        symbols = byte_symbols()
        if word.isascii() and word.isprintable():
            text = word[:-1] + chr(0xE000 + ord(word[-1]))
        else:
            data = word.encode()
            text = "".join([symbols[b] for b in data[:-1]]) + chr(0xE000 + ord(symbols[data[-1]]))
        return self.encode_symbols(text)

    def encode_symbols(self, text: str) -> bytes:
        """The same for a word given as symbols."""
        whole = self.ids.get(text)
        if whole in self.valid:
            return self.token_bytes[whole]
        longest = [0] * len(text)
        for end, (token, size) in self.automaton.iter(text):
            longest[end - size + 1] = token
        dead = bytearray(len(text) + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        size, shorter, pairs = self.size, self.shorter, self.pairs
        while True:
            end = at + size[token]
            if not dead[end] and (not out or pairs[out[-1], token]):
                out.append(token)
                at = end
                if at == len(text):
                    return b"".join([self.token_bytes[t] for t in out])
                token = longest[at]
                continue
            token = shorter[token]
            if token < 0:
                dead[at] = 1
                token = out.pop()
                at -= size[token]

    def encode(self, text: str) -> bytes:
        """Token ids of a whole text: special tokens as they stand, the rest normalised and cut into words."""
        if "<" in text and self.special_pattern.search(text):
            return b"".join(self.token_bytes[self.special[p]] if p in self.special else self.encode(p)
                            for p in self.special_pattern.split(text))
        if self.simple:
            try:
                text.encode("latin-1")
                return b"".join(map(self.words.__getitem__, LATIN_WORDS.findall(text.lower())))
            except UnicodeEncodeError:
                pass
        normalise, cut = self.rules
        return b"".join([self.others[w[:-1] + chr(0xE000 + ord(w[-1]))] for w, _ in cut(normalise(text))])

    @cached_property
    def rules(self) -> tuple:
        """The file's own normaliser and word cutter; loaded by workers that meet a text outside Latin-1."""
        tool = Tokenizer.from_file(self.path)
        return tool.normalizer.normalize_str, tool.pre_tokenizer.pre_tokenize_str

    def decode(self, ids: pa.ListArray) -> pa.StringArray:
        """Tokens as written in the file, joined by a space: slices of one buffer, placed by the offset table."""
        ends = ids.offsets.to_numpy().astype(np.int64)
        tokens = ids.values.to_numpy(zero_copy_only=False)
        starts, sizes = self.offsets[tokens], np.diff(self.offsets)[tokens]
        filled = ends[1:] > ends[:-1]
        sizes[ends[1:][filled] - 1] -= 1  # no space after a document's last token
        out = np.concatenate(([0], np.cumsum(sizes)))
        place = np.repeat(starts - out[:-1], sizes) + np.arange(out[-1])
        return pa.StringArray.from_buffers(len(ids), pa.py_buffer(out[ends].astype(np.int32).tobytes()),
                                           pa.py_buffer(self.table[place].tobytes()))


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker and file."""
    return Encoder(path)


def encode(docs: DataFrame, path: str, decoded: bool = False) -> DataFrame:
    """doc_id, ids array<int>, and with ``decoded`` the text that the ids decode to: one row per row of ``docs``.

    path: a tokenizer file that every executor can read. Null text counts as empty and gives no ids and an empty decoded
    text. Texts are encoded whole whatever their length. Rows with null or repeated doc_id are encoded like any other;
    other columns are ignored; an empty table gives an empty result.
    """
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in pieces(batches):
            ids = int_lists([tool.encode(t) for t in batch.column("text").to_pylist()])
            columns = {"doc_id": batch.column("doc_id"), "ids": ids}
            yield pa.RecordBatch.from_pydict(columns | ({"decoded": tool.decode(ids)} if decoded else {}))

    kind = docs.schema["doc_id"].dataType.simpleString()
    return whole_texts(docs).mapInArrow(run, f"doc_id {kind}, ids array<int>" + ", decoded string" * decoded)


def decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id, text from doc_id, ids; null ids count as none."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = encoder(path)
        for batch in batches:
            ids = int_lists([np.array(x or [], "<i4").tobytes() for x in batch.column("ids").to_pylist()])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "text": tool.decode(ids)})

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")
