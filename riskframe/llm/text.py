"""Words and hashes of whole texts, many documents at a time.

Everything here works on the UTF-8 bytes of an Arrow column inside a Spark task. A slice of rows
is cut so that the work arrays stay a few megabytes, whatever the batch; one document longer than
a slice is a slice of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# The white space that parts words (space and 0x09-0x0D).
WHITE = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)

SLICE_BYTES = 1 << 18
# Odd multipliers of the two rolling hashes (any odd numbers do).
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93)

IS_WORD = np.ones(256, bool)
IS_WORD[list(WHITE)] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
# ASCII letters and digits and every byte of a longer code point.
IS_ALNUM = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of a 64-bit hash over all others."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0x7FB5D329728EA185)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x81DADEF4BC2DD44D)
    h ^= h >> np.uint64(33)
    return h


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of ``base`` and of its inverse modulo 2**64."""
    up, down = _POWERS.get(base, (np.ones(0, np.uint64), np.ones(0, np.uint64)))
    if len(up) < n:
        size = max(n, SLICE_BYTES + 1)
        inverse = pow(base, -1, 1 << 64)
        factors = lambda x: np.cumprod(np.r_[np.uint64(1), np.full(size - 1, x, np.uint64)])
        up, down = _POWERS[base] = factors(base), factors(inverse)
    return up[:n], down[:n]


def prefix_hash(data: np.ndarray, base: int = MULTIPLIERS[0]) -> np.ndarray:
    """Running polynomial sums of the bytes; ``span_hash`` turns them into hashes of spans."""
    up, _ = powers(base, len(data))
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up, out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = MULTIPLIERS[0]) -> np.ndarray:
    """64-bit hash of the bytes from ``start`` to ``end``, whatever their place."""
    _, down = powers(base, len(prefix))
    return mix((prefix[end] - prefix[start]) * down[start] + (end - start).astype(np.uint64))


def binary_of(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a string or binary column and the n + 1 offsets; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if isinstance(column, pa.ChunkedArray):  # no rows
        column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    n = len(column)
    if not n or offsets is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, most: int = SLICE_BYTES, rows: int = 1 << 30) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``most`` bytes and ``rows`` rows, one row at least."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + most, side="right")) - 1)
        high = min(high, low + rows, n)
        yield low, high
        low = high


def sliced(column: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """First row, end row, bytes and offsets of each slice of a column."""
    data, offsets = binary_of(column)
    for low, high in slices(offsets):
        at = offsets[low : high + 1]
        yield low, high, data[at[0] : at[-1]], at - at[0]


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = IS_WORD) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of every word, and the number of the first word of each document (n + 1)."""
    n = len(data)
    if not n:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    inside = is_word[data]
    before = np.zeros(n, bool)
    before[1:] = inside[:-1]
    before[offsets[:-1][offsets[:-1] < n]] = False
    after = np.zeros(n, bool)
    after[:-1] = inside[1:]
    after[offsets[1:][offsets[1:] > 0] - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return span_hash(prefix_hash(data), starts, ends)


def gram_hashes(words: np.ndarray, k: int, base: int = MULTIPLIERS[0]) -> np.ndarray:
    """Hash of the ``k`` words from each word on, over the joined documents (see ``gram_starts``)."""
    n = max(0, len(words) - k + 1)
    h = np.zeros(n, np.uint64)
    for j in range(k):
        h = h * np.uint64(base) + words[j : j + n]
    return mix(h)


def owner_of(first: np.ndarray) -> np.ndarray:
    """Document of each word, from the numbers of the first words."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def gram_starts(first: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Words at which ``k`` words of one document begin, and the document of each."""
    room = np.maximum(np.diff(first) - k + 1, 0)
    owner = np.repeat(np.arange(len(room)), room)
    ahead = np.cumsum(room) - room
    return np.arange(len(owner)) - ahead[owner] + first[:-1][owner], owner


def covered(length: int, starts: np.ndarray, width: int) -> np.ndarray:
    """True where any span of ``width`` that begins at ``starts`` lies."""
    change = np.bincount(starts, minlength=length + 1) - np.bincount(starts + width, minlength=length + 1)
    return np.cumsum(change[:length]) > 0


def member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    """True for the values in the sorted array ``ordered``."""
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.searchsorted(ordered, values)
    at[at == len(ordered)] = 0
    return ordered[at] == values
