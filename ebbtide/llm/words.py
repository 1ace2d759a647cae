"""Words of Arrow text columns as numpy arrays.

A text column is handled as its UTF-8 buffer: word starts and ends are byte
positions, and every word gets a 64-bit hash, all without Python strings.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes handled at once; one longer text is handled alone.
SLICE_BYTES = 1 << 20

IDENTITY = np.arange(256, dtype=np.uint8)
LOWER = IDENTITY.copy()
LOWER[65:91] += 32

#: Words are runs of anything but space and the controls \t \n \v \f \r.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = False

#: Words are runs of digits, a-z (after lower-casing) and everything beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[0x30:0x3A] = ALNUM[0x61:0x7B] = ALNUM[0x80:] = True

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_KEEP = np.array([(1 << (8 * k)) - 1 for k in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit scramble."""
    h = (h ^ (h >> np.uint64(30))) * _M2
    h = (h ^ (h >> np.uint64(27))) * _M3
    return h ^ (h >> np.uint64(31))


@dataclass
class Words:
    data: np.ndarray  # the UTF-8 bytes of the texts, after mapping
    text_at: np.ndarray  # where each text starts in data, and its end
    start: np.ndarray  # first byte of each word
    end: np.ndarray  # byte past each word
    first: np.ndarray  # index of each text's first word, and the number of words

    def hashes(self) -> np.ndarray:
        return span_hashes(self.data, self.start, self.end)

    def text_of(self) -> np.ndarray:
        """The text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def text_slices(batch: pa.RecordBatch, column: str = "text", limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Consecutive rows of the batch with their text bytes and text offsets."""
    i = batch.schema.get_field_index(column)
    texts = pc.fill_null(batch.column(i).cast(pa.large_binary()), b"")
    if not len(texts):
        return
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2], np.uint8) if texts.buffers()[2] is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, side="right")) - 1)
        to = min(to, len(texts))
        yield batch.slice(at, to - at), data[offsets[at] : offsets[to]], offsets[at : to + 1] - offsets[at]
        at = to


def split(data: np.ndarray, text_at: np.ndarray, is_word: np.ndarray, mapping: np.ndarray | None = None) -> Words:
    """Words of consecutive texts; no word reaches over the end of its text."""
    if mapping is not None:
        data = mapping[data]
    n = len(data)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = is_word[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    cuts = text_at[(text_at > 0) & (text_at < n)]
    begins[cuts] = inside[cuts]
    ends = np.zeros(n + 1, dtype=bool)
    ends[1:] = inside[:-1] & ~inside[1:]
    ends[cuts] = inside[cuts - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends)
    return Words(data, text_at, start, end, np.searchsorted(start, text_at))


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans, eight bytes at a step."""
    if not len(start):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = end - start
    h = mix((eight[start] & _KEEP[np.minimum(left, 8)]) + left.astype(np.uint64) * _M1)
    more = np.flatnonzero(left > 8)
    at = 8
    while len(more):
        h[more] = mix(h[more] * _M1 + (eight[start[more] + at] & _KEEP[np.minimum(left[more] - at, 8)]))
        at += 8
        more = more[left[more] > at]
    return h


def gram_hashes(h: np.ndarray, k: int) -> np.ndarray:
    """Hashes of all k consecutive entries of ``h`` (at their first entry)."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, k, np.uint64)
    for j in range(k):
        out = out * _M1 + h[j : j + n]
        out ^= out >> np.uint64(29)
    return mix(out)
