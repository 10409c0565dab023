"""Words of whole Arrow text columns as 64-bit numbers, without a Python loop over words.

A word is a maximal run of characters other than space and U+0009 to U+000D. In UTF-8
those six are single bytes, so words are found and hashed on the column's bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are taken in portions of about so many bytes: it bounds the work arrays.
PORTION_BYTES = 2_000_000

_SPACES = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)
_BYTE_BASE = 0x9E3779B97F4A7C15
_WORD_BASE = 0xD6E8FEB86659FD93


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers; one to one."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@lru_cache(maxsize=8)
def _powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``base`` and of its inverse modulo 2**64."""
    inverse = pow(base, -1, 1 << 64)
    out = []
    for b in (base, inverse):
        factors = np.full(size, b, np.uint64)
        factors[0] = 1
        out.append(np.multiply.accumulate(factors))
    return out[0], out[1]


def powers(base: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """As many powers as asked for, cut from a table of the next power of two."""
    up, down = _powers(base, 1 << max(12, (size - 1).bit_length()))
    return up[:size], down[:size]


@lru_cache(maxsize=2)
def _byte_values(lower: bool) -> np.ndarray:
    values = np.arange(1, 257, dtype=np.uint64)
    if lower:
        values[65:91] = values[97:123]
    values = mix(values * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
    values[list(_SPACES)] = 0
    return values


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, starts, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(starts, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


class Words:
    """The words of a portion of texts.

    ``hashes``: one 64-bit number a word; ``bounds``: where each text's words begin in it,
    with one more entry at the end; ``starts``, ``ends``: the words' places in ``data``.
    """

    def __init__(self, texts: pa.Array, lower: bool = False) -> None:
        data, offsets = text_bytes(texts)
        values = _byte_values(lower)[data]
        solid = values != 0
        n = len(data)
        first = np.zeros(n + 1, bool)
        first[offsets] = True
        before = np.concatenate([[False], solid[:-1]]) if n else np.zeros(0, bool)
        starts = np.flatnonzero(solid & (~before | first[:n]))
        after = np.concatenate([solid[1:], [False]]) if n else np.zeros(0, bool)
        ends = np.flatnonzero(solid & (~after | first[1:])) + 1
        if len(starts):
            up, down = powers(_BYTE_BASE, n)
            sums = np.add.reduceat(values * up, starts)
            self.hashes = mix(sums * down[starts])
        else:
            self.hashes = np.zeros(0, np.uint64)
        self.data, self.offsets, self.starts, self.ends = data, offsets, starts, ends
        self.bounds = np.searchsorted(starts, offsets)

    @property
    def counts(self) -> np.ndarray:
        """Words of each text."""
        return np.diff(self.bounds)

    @property
    def texts(self) -> np.ndarray:
        """For each word, the number of its text in the portion."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A number for each run of ``width`` consecutive entries, text borders left aside."""
    n = len(hashes)
    if n < width:
        return np.zeros(0, np.uint64)
    up, down = powers(_WORD_BASE, n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hashes * up, dtype=np.uint64)])
    return mix((sums[width:] - sums[:-width]) * down[: n - width + 1] + np.uint64(width))


def runs(words: Words, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of each run of ``width`` words that lies in one text; start counts words."""
    rolled = rolling(words.hashes, width)
    if not len(rolled):
        return np.zeros(0, np.int64), rolled
    owner = words.texts
    inside = owner[: len(rolled)] == owner[width - 1 :]
    starts = np.flatnonzero(inside)
    return starts, rolled[starts]


def whole_hash(words: Words, text: int) -> np.uint64:
    """One number for all the words of a text."""
    part = words.hashes[words.bounds[text] : words.bounds[text + 1]]
    return rolling(part, len(part))[0]


def portions(batch: pa.RecordBatch, column: str, size: int = PORTION_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into slices whose texts have about ``size`` bytes; one text is never cut."""
    if not batch.num_rows:
        return
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    totals = np.cumsum(lengths)
    at = 0
    while at < batch.num_rows:
        base = totals[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(totals, base + size, side="right")))
        yield batch.slice(at, end - at)
        at = end


def lists(values: np.ndarray, bounds: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column from flat values and the places where each list begins."""
    return pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(values, kind))


def signed(values: np.ndarray) -> np.ndarray:
    """The same bits as Spark's signed long."""
    return values.view(np.int64)
