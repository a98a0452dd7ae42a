"""Periodic runs of words by internal pattern matching.

A run of period q and four periods or more holds a block of L = 2^k words, q <= L < 2q, that starts
at a multiple of L / 2, and its copy q words on. As the block holds a whole period, the copy is the
block's next occurrence: so one query per block, for the next occurrence in the window
behind it, finds every period. Occurrences of a block are an interval of the suffix array; the next
one is the range successor of the block's place there, asked of a wavelet tree. The step between
the two occurrences is the candidate period of their progression; common prefixes and suffixes of
the two places, read from the ranks of dyadic blocks, give the run's ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from lakeops.llm.common import as_documents, named
from lakeops.llm.scan import NOT_SPACE, Words, chunks

LEAST = 6
PERIODS = 4
FAR = np.iinfo(np.int32).max


class Factors:
    """Dyadic blocks of a sequence whose last symbol occurs once.

    ``rank[k][i]`` is the first place, in suffix order, of the suffixes that begin with the 2^k
    symbols at i, so equal blocks have equal ranks and fill one interval of the suffix array.
    """

    def __init__(self, symbols: np.ndarray, longest: int):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(n, np.int64)
        rank[order] = _first_of_group(symbols[order])
        self.rank = [rank]
        while (1 << (len(self.rank) - 1)) < longest:
            self.rank.append(self._doubled(rank := self.rank[-1], 1 << (len(self.rank) - 1)))
        self.order = np.argsort(self.rank[-1], kind="stable")

    @staticmethod
    def _doubled(rank: np.ndarray, reach: int) -> np.ndarray:
        """Ranks by twice as many symbols; only blocks that have equals yet are sorted again."""
        n = len(rank)
        tied = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)
        after = np.where(tied + reach < n, rank[np.minimum(tied + reach, n - 1)] + 1, 0)
        keys = rank[tied] * (n + 1) + after
        order = np.argsort(keys, kind="stable")
        keys, tied = keys[order], tied[order]
        out = rank.copy()
        out[tied] = rank[tied] + _first_of_group(keys) - _first_of_group(rank[tied])
        return out

    def interval(self, level: int, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where the suffix array holds the occurrences of the blocks at these places."""
        rank = self.rank[level]
        low = rank[at]
        return low, low + np.bincount(rank, minlength=len(rank))[low]

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common prefix of the suffixes at i and j (i < j)."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            same = self.rank[k][i + length] == self.rank[k][j + length]
            length[same] += 1 << k
        return length

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common suffix of what comes before i and j (i < j)."""
        length = np.zeros(len(i), np.int64)
        for k in range(len(self.rank) - 1, -1, -1):
            a, b = i - length - (1 << k), j - length - (1 << k)
            same = (a >= 0) & (self.rank[k][np.maximum(a, 0)] == self.rank[k][np.maximum(b, 0)])
            length[same] += 1 << k
        return length


def _first_of_group(ordered: np.ndarray) -> np.ndarray:
    """For each of some ordered keys the place of the first equal one."""
    new = np.ones(len(ordered), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    return np.maximum.accumulate(np.where(new, np.arange(len(ordered)), 0))


class WaveletTree:
    """Order of the values in any range of an array, by bits from the highest to the lowest."""

    def __init__(self, values: np.ndarray):
        self.bits = range(int(len(values)).bit_length() - 1, -1, -1)
        self.zeros = []
        for bit in self.bits:
            one = (values >> bit) & 1 > 0
            self.zeros.append(np.concatenate([[0], np.cumsum(~one)]))
            values = np.concatenate([values[~one], values[one]])

    def smaller(self, low: np.ndarray, high: np.ndarray, than: np.ndarray) -> np.ndarray:
        """How many values of each range are smaller than a bound."""
        count = np.zeros(len(low), np.int64)
        for bit, zeros in zip(self.bits, self.zeros):
            up = (than >> bit) & 1 > 0
            a, b = zeros[low], zeros[high]
            count += np.where(up, b - a, 0)
            low, high = np.where(up, zeros[-1] + low - a, a), np.where(up, zeros[-1] + high - b, b)
        return count

    def at_order(self, low: np.ndarray, high: np.ndarray, k: np.ndarray) -> np.ndarray:
        """The k-th smallest value of each range, from 0."""
        value = np.zeros(len(low), np.int64)
        for bit, zeros in zip(self.bits, self.zeros):
            a, b = zeros[low], zeros[high]
            up = k >= b - a
            value += np.where(up, 1 << bit, 0)
            k = np.where(up, k - (b - a), k)
            low, high = np.where(up, zeros[-1] + low - a, a), np.where(up, zeros[-1] + high - b, b)
        return value

    def successor(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        """The smallest value of each range that is at least a bound, else ``FAR``."""
        before = self.smaller(low, high, bound)
        some = before < high - low
        out = np.full(len(low), FAR, np.int64)
        out[some] = self.at_order(low[some], high[some], before[some])
        return out


def _stretches(symbols: np.ndarray, doc: np.ndarray, longest: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Level, first and end of stretches that alone can lie in a run of a period in (L / 2, L].

    In a run, all words but the last q occur again within q words. So at least three periods of
    words, neighbours of one another, have their next equal word within L.
    """
    n = len(symbols)
    order = np.argsort(symbols, kind="stable")
    gap = np.full(n, FAR, np.int64)
    near = (symbols[order[1:]] == symbols[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    gap[order[:-1][near]] = (order[1:] - order[:-1])[near]
    level = 0
    while (length := 1 << level) <= longest // 2 or level == 0:
        least = length // 2 + 1
        inside = np.zeros(n + 2, np.int8)
        inside[1:-1] = gap <= length
        edges = np.diff(inside)
        first, end = np.flatnonzero(edges > 0), np.flatnonzero(edges < 0)
        enough = end - first >= max(LEAST, PERIODS * least) - least
        if enough.any():
            yield level, first[enough], end[enough]
        level += 1


def _blocks(first: np.ndarray, end: np.ndarray, length: int) -> np.ndarray:
    """Starts, multiples of half a block, of all blocks inside the stretches."""
    step = max(1, length // 2)
    a = -(-first // step)
    count = np.maximum((end - length) // step - a + 1, 0)
    offset = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
    return (np.repeat(a, count) + offset) * step


def find_runs(symbols: np.ndarray, doc: np.ndarray, longest: int) -> np.ndarray:
    """Rows (start, end, period) of all runs, each once.

    ``symbols`` holds all documents, each ended by a symbol of its own; ``doc`` numbers them.
    """
    stretches = list(_stretches(symbols, doc, longest))
    if not stretches:
        return np.zeros((0, 3), np.int64)
    factors = Factors(symbols, longest)
    tree = WaveletTree(factors.order)
    found = []
    for level, first, end in stretches:
        at = _blocks(first, end, 1 << level)
        following = tree.successor(*factors.interval(level, at), at + 1)
        period = following - at
        near = (period <= 1 << level) & (2 * period > 1 << level)
        at, following, period = at[near], following[near], period[near]
        start = at - factors.backward(at, following)
        stop = following + factors.forward(at, following)
        enough = stop - start >= np.maximum(LEAST, PERIODS * period)
        found.append(np.stack([start, stop, period], 1)[enough])
    return np.unique(np.concatenate(found), axis=0)


def _runs_of_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, at in chunks(batches, "text"):
        words = Words(buf, at, NOT_SPACE)
        _, symbols = np.unique(words.hashes(), return_inverse=True)
        doc = words.doc
        longest = int(words.count.max(initial=0))
        # Only documents in which a run is possible at all are looked at closer.
        possible = np.zeros(rows.num_rows, bool)
        for _, first, _ in _stretches(symbols, doc, longest):
            possible[doc[first]] = True
        runs = np.zeros((0, 3), np.int64)
        owner = np.zeros(0, np.int64)
        chosen = np.flatnonzero(possible)
        if len(chosen):
            sizes = words.count[chosen] + 1  # and the symbol that ends a document
            begin = np.cumsum(sizes) - sizes
            total = int(sizes.sum())
            joined = len(symbols) + np.arange(total)
            place = np.arange(total) - np.repeat(begin, sizes)
            text = place < np.repeat(sizes - 1, sizes)
            joined[text] = symbols[(np.repeat(words.first[chosen], sizes) + place)[text]]
            runs = find_runs(joined, np.repeat(np.arange(len(chosen)), sizes), int(sizes.max()))
            part = np.searchsorted(begin, runs[:, 0], "right") - 1
            owner = chosen[part]
            runs = runs - np.stack([begin[part], begin[part], np.zeros(len(part), np.int64)], 1)
        order = np.lexsort((runs[:, 2], runs[:, 0], owner))
        runs, owner = runs[order], owner[order]
        ends = np.searchsorted(owner, np.arange(rows.num_rows + 1)).astype(np.int32)
        fields = [pa.array(runs[:, 0]), pa.array(runs[:, 1] - runs[:, 0]), pa.array(runs[:, 2])]
        listed = pa.ListArray.from_arrays(
            pa.array(ends), pa.StructArray.from_arrays(fields, ["start", "length", "period"])
        )
        base = words.first[owner]
        marks = np.zeros(len(words) + 1, np.int64)
        np.add.at(marks, base + runs[:, 0] + runs[:, 2], 1)
        np.add.at(marks, base + runs[:, 1], -1)
        kept = np.cumsum(marks[:-1]) == 0
        yield pa.RecordBatch.from_arrays(
            [rows.column("id"), pa.array(words.count), listed, pa.array(_joined(words, kept, at), pa.binary())],
            ["id", "n_words", "runs", "collapsed"],
        )


def _joined(words: Words, kept: np.ndarray, at: np.ndarray) -> list[bytes]:
    """The kept words of each text with one space between them."""
    doc = words.doc
    inside = np.zeros(len(words.buf) + 1, np.int64)
    np.add.at(inside, words.start[kept], 1)
    np.add.at(inside, words.end[kept], -1)
    out = np.cumsum(inside[:-1]) > 0
    mine = doc[kept]
    followed = np.zeros(len(mine), bool)
    followed[:-1] = mine[1:] == mine[:-1]
    gaps = words.end[kept][followed]  # white space, as another word of the text follows
    out[gaps] = True
    raw = words.buf.copy()
    raw[gaps] = 32
    sums = np.concatenate([[0], np.cumsum(out)])[at]
    whole = raw[out].tobytes()
    return [whole[a:b] for a, b in zip(sums[:-1].tolist(), sums[1:].tolist())]


def periodic_runs(documents: DataFrame, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``n_words``, ``runs`` and ``collapsed`` of every text.

    Words lie between ASCII white space and are numbered from 0. A run is a stretch of words whose
    smallest period is ``period``, of at least six words and four periods, that no neighbouring word
    extends; ``runs`` holds ``start``, ``length`` and ``period`` by start, then period. ``collapsed``
    joins, by one space, the words that no run contains after its first period.

    A null or blank text has no words, no runs and an empty ``collapsed``. One row per input row,
    each judged by itself, so repeated rows give equal rows; a null id comes back as null. Runs may
    overlap; equal stretches have one smallest period, so there are no ties. An empty table gives an
    empty result; further columns are ignored. A task holds some 1 MB of texts at a time, or one
    longer text, with 8 bytes per word and doubling.
    """
    found = as_documents(documents, id_name, text).mapInArrow(
        _runs_of_documents,
        "id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary",
    )
    return found.select(named(name=id_name), "n_words", "runs", found["collapsed"].cast("string").alias("collapsed"))
