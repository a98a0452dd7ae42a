"""Array helpers for text inside tasks: words, rolling hashes and window minima of whole batches.

Texts of a batch lie behind each other in one UTF-8 buffer, so one array operation treats many
documents. Hashes are 64 bits wide and depend on content alone, never on place or task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
CHUNK_BYTES = 1 << 20
_BASE = U64(0x9E3779B97F4A7C15 | 1)
_INVERSE = U64(pow(int(_BASE), -1, 1 << 64))
_BYTE_VALUES = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_powers = {"up": np.ones(1, U64), "down": np.ones(1, U64)}

SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
NOT_SPACE = ~SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
ALNUM = np.ones(256, bool)
ALNUM[:0x30] = ALNUM[0x3A:0x41] = ALNUM[0x5B:0x61] = ALNUM[0x7B:0x80] = False


def buffer_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts and where each begins (one more entry for the end); null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    binary = pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type)
    texts = pc.fill_null(texts.cast(pa.large_binary() if binary else pa.large_string()), b"" if binary else "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def chunks(
    batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Batches cut between rows to about ``limit`` bytes of text; a longer text comes alone."""
    for batch in batches:
        buf, at = buffer_of(batch.column(text))
        row = 0
        while row < batch.num_rows:
            end = max(row + 1, int(np.searchsorted(at, at[row] + limit, "right")) - 1)
            yield batch.slice(row, end - row), buf[at[row] : at[end]], at[row : end + 1] - at[row]
            row = end


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over all output bits (a bijection on 64 bits)."""
    h = h ^ (h >> U64(33))
    h = h * U64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U64(33))
    h = h * U64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U64(33))


def _power(kind: str, n: int) -> np.ndarray:
    if len(_powers[kind]) < n:
        base = _BASE if kind == "up" else _INVERSE
        steps = np.full(max(n, CHUNK_BYTES + 1), base, U64)
        steps[0] = U64(1)
        grown = np.multiply.accumulate(steps)
        if n > 16 * CHUNK_BYTES:  # one huge text must not stay in a worker's memory
            return grown[:n]
        _powers[kind] = grown
    return _powers[kind][:n]


class RangeHash:
    """Hashes of any ranges of a sequence of 64-bit values, from running sums."""

    def __init__(self, values: np.ndarray):
        n = len(values)
        self.sums = np.zeros(n + 1, U64)
        np.cumsum(values * _power("up", n), out=self.sums[1:])
        self.down = _power("down", n + 1)

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        raw = (self.sums[end] - self.sums[start]) * self.down[start]
        return mix(raw ^ ((end - start).astype(U64) * U64(0xD6E8FEB86659FD93)))

    def grams(self, k: int) -> np.ndarray:
        """Hash of every range of length k."""
        n = len(self.sums) - k
        if n <= 0:
            return np.zeros(0, U64)
        raw = (self.sums[k:] - self.sums[:n]) * self.down[:n]
        return mix(raw ^ (np.full(1, k, U64) * U64(0xD6E8FEB86659FD93)))


def byte_hash(buf: np.ndarray) -> RangeHash:
    return RangeHash(_BYTE_VALUES[buf])


class Words:
    """Words of all texts of a buffer: maximal runs of bytes for which ``table`` holds."""

    def __init__(self, buf: np.ndarray, at: np.ndarray, table: np.ndarray):
        inside = table[buf]
        edge = np.zeros(len(buf) + 1, bool)
        edge[at] = True
        before = np.zeros(len(buf), bool)
        before[1:] = inside[:-1]
        before &= ~edge[:-1]
        after = np.zeros(len(buf), bool)
        after[:-1] = inside[1:]
        after &= ~edge[1:]
        self.buf = buf
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, at)
        self.count = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.count)), self.count)

    def hashes(self, lower: bool = False) -> np.ndarray:
        """One hash per word, of its bytes (A-Z lower-cased where asked)."""
        if not len(self):
            return np.zeros(0, U64)
        return byte_hash(LOWER[self.buf] if lower else self.buf)(self.start, self.end)


def inside_windows(first: np.ndarray, length: int) -> np.ndarray:
    """Starts of all windows of ``length`` symbols that do not leave their document."""
    total = int(first[-1])
    starts = np.arange(max(total - length + 1, 0))
    if not len(starts):
        return starts
    # The end of the document that holds each start, where it has a whole window.
    left = np.maximum(np.diff(first) - length + 1, 0)
    ok = np.zeros(total + 1, np.int64)
    has = left > 0
    np.add.at(ok, first[:-1][has], 1)
    np.add.at(ok, first[:-1][has] + left[has], -1)
    return starts[np.cumsum(ok)[: len(starts)] > 0]


def window_min(keys: np.ndarray, width: int) -> np.ndarray:
    """Smallest key of every run of ``width`` keys."""
    n = len(keys)
    if n < width:
        return np.zeros(0, keys.dtype)
    padded = np.full(-(-n // width) * width, np.iinfo(keys.dtype).max, keys.dtype)
    padded[:n] = keys
    blocks = padded.reshape(-1, width)
    forward = np.minimum.accumulate(blocks, axis=1).ravel()
    backward = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(backward[: n - width + 1], forward[width - 1 : n])


def paths(
    gram: np.ndarray, first: np.ndarray, length: int, k: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of neighbouring windows that share their least k-gram.

    Returns first and last window start of each run and the place of its k-gram. Which k-gram of
    a window is least depends on the window's content alone (ties: the leftmost), so equal windows
    anywhere have equal k-grams at equal distances.
    """
    windows = inside_windows(first, length)
    if not len(windows):
        empty = np.zeros(0, np.int64)
        return empty, empty, empty
    place = U64(0xFFFFFFFF)
    keys = (gram & ~place) | np.arange(len(gram), dtype=U64)
    anchor = (window_min(keys, length - k + 1)[windows] & place).astype(np.int64)
    new = np.ones(len(windows), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (windows[1:] != windows[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(windows)) - 1
    return windows[head], windows[tail], anchor[head]


def covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of n places lie in any of the (start, end) rows."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, spans[:, 0], 1)
    np.add.at(marks, spans[:, 1], -1)
    return np.cumsum(marks[:n]) > 0


def signed(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))
