"""Words of many texts at once: runs of bytes other than space and U+0009 to U+000D."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def raw_bytes(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts in a row and where each begins (one bound more than texts)."""
    raw = raw.cast(pa.large_binary())
    bounds = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset : raw.offset + len(raw) + 1]
    buffer = raw.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[bounds[0] : bounds[-1]] if buffer is not None else np.zeros(0, np.uint8)
    return data, bounds - bounds[0]


def per_text(flags: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """How many flags are set in each text."""
    return np.diff(np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])[bounds])


@dataclass
class Words:
    """Word k is ``distinct[index[k]]``; text d holds words ``bounds[d]`` to ``bounds[d + 1]``."""

    distinct: pa.Array
    index: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    @property
    def text(self) -> np.ndarray:
        """The text of each word."""
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def split_words(raw: pa.Array, lower: bool = False) -> Words:
    """``lower`` turns A-Z into a-z and leaves other letters."""
    data, bounds = raw_bytes(raw)
    space = IS_SPACE[data]
    kept = data[~space]
    if not len(kept):
        return Words(pa.array([], pa.large_binary()), np.zeros(0, np.int64), np.zeros(len(bounds), np.int64))
    if lower:
        kept = kept.copy()
        kept[(kept >= 0x41) & (kept <= 0x5A)] += 32
    begins = ~space
    begins[1:] &= space[:-1]
    inside = bounds[:-1][np.diff(bounds) > 0]  # a text's first byte begins a word whatever stood before
    begins[inside] = ~space[inside]
    at = np.flatnonzero(begins)
    place = np.concatenate([[0], np.cumsum(~space)])
    offsets = np.append(place[at], len(kept)).astype(np.int64)
    coded = pa.Array.from_buffers(pa.large_binary(), len(at), [None, pa.py_buffer(offsets), pa.py_buffer(kept)]).dictionary_encode()
    return Words(coded.dictionary, coded.indices.to_numpy(zero_copy_only=False).astype(np.int64), np.searchsorted(at, bounds))
