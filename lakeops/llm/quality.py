"""Quality rules: counts of a text and its repetition, measured by a suffix array over its words.

The suffixes of each document are sorted by ranks that double their depth and are refined only
where they still tie. Neighbours in that order give the longest common prefixes; their intervals
are the maximal repeated word sequences.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import as_documents, named
from lakeops.llm.scan import NOT_SPACE, U64, Words, byte_hash, chunks, mix

SYMBOLS = np.zeros(256, bool)
SYMBOLS[list(b"#*$%&|<>")] = True


@dataclass(frozen=True)
class Rules:
    """Limits: a text fails beyond any of them."""

    min_words: int = 50
    max_repeat_percent: int = 50  # words in 3-word windows that occur again
    min_repeat: int = 8  # words of a repeated sequence that counts as a span
    max_covered_percent: int = 30  # words in such spans
    max_longest_percent: int = 20  # longest repeated sequence against the words of the text
    longest_allowed: int = 30  # a repeated sequence of so many words passes in any text


def suffix_ranks(symbols: np.ndarray, first: np.ndarray) -> list[np.ndarray]:
    """Ranks of all suffixes by their first 1, 2, 4, ... symbols; the last level has no ties.

    ``symbols`` are those of all documents, ``first`` says where each begins. A rank counts the
    suffixes before it, so suffixes of different documents never share one.
    """
    n = len(symbols)
    doc = np.repeat(np.arange(len(first) - 1), np.diff(first))
    end = first[1:][doc] if n else np.zeros(0, np.int64)
    order = np.lexsort((symbols, doc))
    new = np.ones(n, bool)
    new[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (doc[order[1:]] != doc[order[:-1]])
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    levels = [rank]
    tied = _tied(order, new)
    depth = 1
    while len(tied):
        following = np.zeros(len(tied), np.int64)
        more = tied + depth < end[tied]
        following[more] = rank[tied[more] + depth] + 1
        order = np.lexsort((following, rank[tied]))
        base, second = rank[tied][order], following[order]
        head = np.ones(len(tied), bool)
        head[1:] = base[1:] != base[:-1]
        new = head.copy()
        new[1:] |= second[1:] != second[:-1]
        index = np.arange(len(tied))
        group = np.maximum.accumulate(np.where(head, index, 0))
        rank = rank.copy()
        rank[tied[order]] = base + np.maximum.accumulate(np.where(new, index, 0)) - group
        levels.append(rank)
        tied = _tied(tied[order], new)
        depth *= 2
    return levels


def _tied(order: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Of suffixes in order, those whose rank another one has too; ``new`` marks first ones."""
    last = np.append(new[1:], True)
    return order[~(new & last)]


def repeat_lengths(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each place the length of the longest sequence from there that its document repeats.

    That is the larger of the common prefixes with both neighbours in suffix order.
    """
    n = len(symbols)
    levels = suffix_ranks(symbols, first)
    order = np.empty(n, np.int64)
    order[levels[-1]] = np.arange(n)
    a, b = order[:-1], order[1:]
    size = np.zeros(max(n - 1, 0), np.int64)
    # All but the tie-free level, from long to short: equal ranks mean equal symbols to that depth.
    for level in range(len(levels) - 2, -1, -1):
        i, j = a + size, b + size
        inside = (i < n) & (j < n)
        same = np.zeros(len(size), bool)
        same[inside] = levels[level][i[inside]] == levels[level][j[inside]]
        size += same * (1 << level)
    longest = np.zeros(n, np.int64)
    longest[a] = size
    longest[b] = np.maximum(longest[b], size)
    return longest


def _sum_by(flags: np.ndarray, at: np.ndarray) -> np.ndarray:
    return np.diff(np.concatenate([[0], np.cumsum(flags)])[at])


def _covered(first_symbol: np.ndarray, sizes: np.ndarray, n: int) -> np.ndarray:
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, first_symbol, 1)
    np.add.at(marks, first_symbol + sizes, -1)
    return np.cumsum(marks[:n]) > 0


def repeated_lines(buf: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Per text the lines with a word that equal an earlier line of it."""
    cut = np.flatnonzero(buf == 10)
    edges = np.unique(np.concatenate([at, cut, cut + 1]))
    start, end = edges[:-1], edges[1:]
    words = np.concatenate([[0], np.cumsum(NOT_SPACE[buf])])
    keep = words[end] > words[start]
    start, end = start[keep], end[keep]
    doc = np.searchsorted(at, start, "right") - 1
    key = byte_hash(buf)(start, end) ^ mix(doc.astype(U64) + U64(1))
    _, index = np.unique(key, return_index=True)
    again = np.ones(len(key), bool)
    again[index] = False
    return np.bincount(doc[again], minlength=len(at) - 1)


def measure(buf: np.ndarray, at: np.ndarray, rules: Rules) -> dict[str, np.ndarray]:
    """Counts and verdicts of all texts of a buffer."""
    words = Words(buf, at, NOT_SPACE)
    _, symbols = np.unique(words.hashes(), return_inverse=True)
    longest = repeat_lengths(symbols, words.first)
    n = words.count
    three = np.flatnonzero(longest >= 3)
    repeated = _sum_by(_covered(three, np.full(len(three), 3), len(words)), words.first)
    spans = np.flatnonzero(longest >= rules.min_repeat)
    covered = _sum_by(_covered(spans, longest[spans], len(words)), words.first)
    top = np.zeros(len(n), np.int64)
    np.maximum.at(top, words.doc, longest)
    failed = (n < rules.min_words) | (100 * repeated > rules.max_repeat_percent * n)
    bad = (100 * covered > rules.max_covered_percent * n) | (
        (top > rules.longest_allowed) & (100 * top > rules.max_longest_percent * n)
    )
    return {
        "n_words": n,
        "word_chars": _sum_by(NOT_SPACE[buf] & ((buf & 0xC0) != 0x80), at),
        "n_symbols": _sum_by(SYMBOLS[buf], at),
        "n_dup_lines": repeated_lines(buf, at),
        "n_repeat_words": repeated,
        "covered_words": covered,
        "longest_repeat": top,
        "base_failed": failed,
        "kept": ~failed & ~bad,
    }


def keep_good(documents: DataFrame, text: str = "text", rules: Rules = Rules()) -> DataFrame:
    """The rows, with all their columns, that :func:`judge` would keep."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, text):
            yield rows.filter(pa.array(measure(buf, at, rules)["kept"]))

    return documents.mapInArrow(run, documents.schema)


def judge(
    documents: DataFrame, id_name: str = "doc_id", text: str = "text", rules: Rules = Rules()
) -> DataFrame:
    """Counts, repetition and verdict of every text.

    Words are runs of bytes other than ASCII white space. Returns ``doc_id``, ``n_words``,
    ``word_chars`` (code points in words), ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``,
    ``covered_words`` and ``longest_repeat`` (of repeated sequences of ``rules.min_repeat`` words or
    more), ``base_failed`` and ``kept``.

    One row per input row, repeated ids included; a null or empty text has no words and fails, a
    null id stays null. A text of any length is measured whole. An empty table gives an empty
    result; further columns are ignored. No shuffle takes place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, "text"):
            found = measure(buf, at, rules)
            yield pa.RecordBatch.from_arrays([rows.column("id"), *map(pa.array, found.values())], ["id", *found])

    measured = as_documents(documents, id_name, text).mapInArrow(
        run,
        "id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
        "covered_words long, longest_repeat long, base_failed boolean, kept boolean",
    )
    return measured.select(named(), *measured.columns[1:])
