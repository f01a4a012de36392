"""Words of many texts at once: NumPy over the bytes of an Arrow column, no Python object per word."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa

#: Multiplier of the polynomial hash, and two of the finishing mix.
BASE, MIX1, MIX2 = np.uint64(0x9E3779B97F4A7C15 | 1), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
#: What undoes the multiplier; it is odd, so there is one.
INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))


@dataclass
class Words:
    """The words of a batch: hash of each, and first[d] to first[d + 1] are those of document d."""

    hashes: np.ndarray
    first: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def flat_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a text column in one array, and the offsets of its rows; null reads as empty."""
    column = column.fill_null("").cast(pa.large_binary())
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, np.int64)[column.offset: column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[offsets[0]: offsets[-1]], offsets - offsets[0]


def _byte_table(change) -> np.ndarray:
    return np.array([change(b) for b in range(256)], np.uint8)


LOWER = _byte_table(lambda b: b + 32 if 65 <= b <= 90 else b)
#: 1 for bytes of words: ASCII letters and digits, and all bytes of other characters.
WORD_BYTE = _byte_table(lambda b: b >= 128 or chr(b).isalnum())
#: 1 for bytes that are not ASCII white space.
SOLID_BYTE = _byte_table(lambda b: not (b == 32 or 9 <= b <= 13))
#: Kind of a byte in a word shape: upper, lower (with all other scripts), digit, or the symbol itself.
SHAPE = _byte_table(lambda b: 65 if 65 <= b <= 90 else 97 if b >= 128 or 97 <= b <= 122 else 48 if 48 <= b <= 57 else b)


def mapped(data: np.ndarray, table: np.ndarray) -> np.ndarray:
    """The table's entry for every byte, in an array that may be written to."""
    return np.frombuffer(bytearray(data).translate(table.tobytes()), np.uint8)


def lower(data: np.ndarray) -> np.ndarray:
    """Lower-case ASCII and the capitals of the Latin-1 block in UTF-8 (C3 80 to C3 9E, without the times sign)."""
    out = mapped(data, LOWER)
    if len(out) > 1:
        second = np.flatnonzero(out[:-1] == 0xC3) + 1
        second = second[(out[second] >= 0x80) & (out[second] <= 0x9E) & (out[second] != 0x97)]
        out[second] += 32
    return out


def _powers(count: int, base: np.uint64 = BASE) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(max(count - 1, 0), base))), dtype=np.uint64)


#: Bytes for which the powers are kept; the batches of ``common.pieces`` are of that size or shorter, but for single texts.
KEPT = 1 << 20


@cache
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _powers(KEPT), _powers(KEPT, INVERSE)


def mixed(values: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    values = (values ^ (values >> np.uint64(30))) * MIX1
    values = (values ^ (values >> np.uint64(27))) * MIX2
    return values ^ (values >> np.uint64(31))


def _runs(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of runs of ``inside`` that do not cross a document border, and the first run of each document."""
    size = len(inside)
    border = np.zeros(size + 1, bool)
    border[offsets] = True
    before, after = np.empty(size, bool), np.empty(size, bool)
    before[:1], before[1:] = True, ~inside[:-1]
    after[-1:], after[:-1] = True, ~inside[1:]
    starts = np.flatnonzero(inside & (before | border[:-1]))
    ends = np.flatnonzero(inside & (after | border[1:])) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of bytes: the polynomial of its bytes is a difference of running sums over all bytes, set
    back to the run's start. Integers wrap around, so that is exact."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = len(data)
    powers, back = _kept_powers() if size <= KEPT else (_powers(size), _powers(size, INVERSE))
    sums = np.zeros(size + 1, np.uint64)
    codes = data.astype(np.uint64)
    codes += np.uint64(1)
    codes *= powers[:size]
    np.cumsum(codes, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * back[starts])


def split_words(column: pa.Array, longest: int | None = None) -> Words:
    """Lower-case words of letters and digits; ``longest`` hashes only so many leading bytes of each."""
    data, offsets = flat_bytes(column)
    data = lower(data)
    starts, ends, first = _runs(mapped(data, WORD_BYTE).view(bool), offsets)
    return Words(run_hashes(data, starts, ends if longest is None else np.minimum(ends, starts + longest)), first)


def split_shapes(column: pa.Array) -> tuple[Words, Words]:
    """Tokens between white space, by hash of the token and by hash of its shape: runs of one kind count once."""
    data, offsets = flat_bytes(column)
    starts, ends, first = _runs(mapped(data, SOLID_BYTE).view(bool), offsets)
    kinds = mapped(data, SHAPE)
    keep = np.ones(len(kinds), bool)
    keep[1:] = kinds[1:] != kinds[:-1]
    keep[starts] = True
    kept_before = np.concatenate(([0], np.cumsum(keep)))
    shapes = run_hashes(kinds[keep], kept_before[starts], kept_before[ends])
    return Words(run_hashes(data, starts, ends), first), Words(shapes, first)


def grouped_counts(doc: np.ndarray, feature: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (doc, feature) with their counts, in that order; feature is below ``width``."""
    keys, counts = np.unique(doc.astype(np.int64) * width + feature.astype(np.int64), return_counts=True)
    return keys // width, keys % width, counts
