"""Byte-level BPE with word ends: encoding by a segment tree over the ranks of adjacent pairs.

The distinct words of a batch are merged side by side. Each word has a segment tree whose leaves
are the ranks of its adjacent pairs and whose root yields the lowest rank, leftmost first. A merge
changes three leaves, each in as many steps as the tree is high, until no pair can be merged.
"""

from __future__ import annotations

import json
import unicodedata
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import as_documents, named
from lakeops.llm.scan import U64, RangeHash, chunks, mix

NONE = np.iinfo(np.int64).max
# Word endings the tokenizer splits off after an apostrophe, in order of precedence.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")
# Code points that count as white space.
SPACES = (9, 10, 11, 12, 13, 32, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)
OTHER, LETTER, NUMBER, BLANK = 0, 1, 2, 3


@cache
def char_kinds() -> np.ndarray:
    kinds = np.full(0x110000, OTHER, np.uint8)
    for code in range(0x110000):
        group = unicodedata.category(chr(code))[0]
        if group == "L":
            kinds[code] = LETTER
        elif group == "N":
            kinds[code] = NUMBER
    kinds[list(SPACES)] = BLANK
    return kinds


@cache
def byte_letters() -> list[str]:
    """The character that stands for each byte: itself where printable, else the next free one."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Tokenizer:
    """Vocabulary and merges of a ``tokenizers`` file of this kind (BPE with an end-of-word mark)."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        vocab, mark = model["vocab"], model["end_of_word_suffix"]
        letters = byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.final = np.array([vocab[c + mark] for c in letters], np.int64)
        pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        keys = np.array([vocab[a] << 32 | vocab[b] for a, b in pairs], np.int64)
        self.result = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order.astype(np.int64)
        self.likely = np.zeros(1 << 20, bool)
        self.likely[self._slot(keys)] = True
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        tokens = {i: t for t, i in vocab.items()} | {i: t for t, i in self.special.items()}
        spelled = [f"{tokens.get(i, '')} ".encode() for i in range(max(tokens) + 1)]
        self.spelled = np.frombuffer(b"".join(spelled), np.uint8)
        self.spelled_size = np.array([len(t) for t in spelled], np.int64)
        self.spelled_at = np.cumsum(self.spelled_size) - self.spelled_size

    @staticmethod
    def _slot(keys: np.ndarray) -> np.ndarray:
        return (mix(keys.astype(U64)) >> U64(44)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ranks of pairs of token ids, ``NONE`` where they do not merge."""
        keys = left << 32 | right
        out = np.full(len(keys), NONE, np.int64)
        some = np.flatnonzero(self.likely[self._slot(keys)])
        at = np.minimum(np.searchsorted(self.keys, keys[some]), len(self.keys) - 1)
        hit = self.keys[at] == keys[some]
        out[some[hit]] = self.ranks[at[hit]]
        return out

    def merge(self, words: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of words of the same height of tree, and how many each word has.

        ``words`` has a row of bytes per word, filled up behind its ``sizes`` bytes.
        """
        n, width = words.shape
        row = np.arange(n)
        ids = self.inner[words]
        ids[row, sizes - 1] = self.final[words[row, sizes - 1]]
        place = np.arange(width)
        following = np.where(place + 1 < sizes[:, None], place + 1, width)
        before = np.broadcast_to(place - 1, (n, width)).copy()
        alive = place < sizes[:, None]
        tree = np.full((n, 2 * width), NONE, np.int64)
        paired = place[:-1] + 1 < sizes[:, None]
        ranks = self.rank(ids[:, :-1][paired], ids[:, 1:][paired])
        where = np.broadcast_to(place[:-1], paired.shape)[paired]
        leaves = np.full((n, width), NONE, np.int64)
        leaves[:, :-1][paired] = np.where(ranks == NONE, NONE, ranks * width + where)
        tree[:, width:] = leaves
        level = width
        while level > 1:
            pairs = tree[:, level : 2 * level].reshape(n, level // 2, 2)
            level //= 2
            tree[:, level : 2 * level] = pairs.min(axis=2)

        flat = tree.ravel()
        every_id, every_next, every_before, living = ids.ravel(), following.ravel(), before.ravel(), alive.ravel()
        active = np.flatnonzero(tree[:, 1] != NONE)
        while len(active):
            base, top = active * width, active * 2 * width
            root = flat[top + 1]
            at = root % width
            gone = every_next[base + at]
            every_id[base + at] = self.result[root // width]
            living[base + gone] = False
            after = every_next[base + gone]
            every_next[base + at] = after
            left = every_before[base + at]
            more, some = after < width, left >= 0
            every_before[base[more] + after[more]] = at[more]
            # The two pairs the new token is part of; its right part's own pair is gone.
            one = np.concatenate([base[more] + at[more], base[some] + left[some]])
            two = np.concatenate([base[more] + after[more], base[some] + at[some]])
            ranks = self.rank(every_id[one], every_id[two])
            leaf = one % width
            value = np.where(ranks == NONE, NONE, ranks * width + leaf)
            flat[top + width + gone] = NONE
            flat[top[~more] + width + at[~more]] = NONE
            tops = one // width * (2 * width)
            flat[tops + width + leaf] = value
            tops = np.concatenate([tops, top, top[~more]])
            node = np.concatenate([leaf, gone, at[~more]]) + width
            while node[0] > 1:
                node >>= 1
                below = tops + 2 * node
                flat[tops + node] = np.minimum(flat[below], flat[below + 1])
            active = active[flat[top + 1] != NONE]
        return ids[alive], alive.sum(axis=1)

    def encode_words(self, buf: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token ids of all words, given as byte ranges, and how many each word has."""
        sizes = end - start
        counts = np.zeros(len(sizes), np.int64)
        done = []
        height = np.ceil(np.log2(np.maximum(sizes, 2))).astype(int)
        for h in np.unique(height).tolist():
            width = 1 << h
            some = np.flatnonzero(height == h)
            for part in np.array_split(some, -(-len(some) * width // (1 << 17))):
                at = np.minimum(start[part][:, None] + np.arange(width), len(buf) - 1)
                ids, counts[part] = self.merge(buf[at], sizes[part])
                done.append((part, ids))
        flat = np.empty(counts.sum(), np.int64)
        heads = np.cumsum(counts) - counts
        for part, ids in done:
            flat[ranges(heads[part], counts[part])] = ids
        return flat, counts

    def spell(self, ids: np.ndarray, at: np.ndarray) -> pa.Array:
        """Texts of the tokens between the places ``at``, joined by a space."""
        sizes = self.spelled_size[ids]
        last = at[1:][at[1:] > at[:-1]] - 1
        sizes[last] -= 1  # no space behind the last one
        data = self.spelled[ranges(self.spelled_at[ids], sizes)]
        offsets = np.concatenate([[0], np.cumsum(sizes)])[at]
        return pa.LargeStringArray.from_buffers(len(at) - 1, pa.py_buffer(offsets), pa.py_buffer(data)).cast(pa.string())


def ranges(start: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges of these sizes, one range behind the other."""
    ends = np.cumsum(sizes)
    return np.repeat(start - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _normal(text: str) -> str:
    """Composed and lower case, each character by itself."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ")
    return text.lower()


def split_words(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every word of the texts that begin at ``first``.

    Words are runs of letters, single numbers, runs of other signs, and contractions: an
    apostrophe that begins a word takes one of the fixed endings with it.
    """
    n = len(codes)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kinds = char_kinds()[codes]
    new = np.ones(n, bool)
    new[1:] = (kinds[1:] != kinds[:-1]) | (kinds[1:] == NUMBER)
    new[first[first < n]] = True
    start = np.flatnonzero(new)
    end = np.append(start[1:], n)
    real = kinds[start] != BLANK
    start, end = start[real], end[real]
    lone = np.flatnonzero((codes[start[:-1]] == 39) & (end[:-1] - start[:-1] == 1) & (start[1:] == end[:-1]) & (kinds[start[1:]] == LETTER))
    if len(lone):  # an apostrophe right before letters of the same text
        edges = np.zeros(n + 1, bool)
        edges[first] = True
        lone = lone[~edges[start[lone + 1]]]
        taken = np.zeros(len(lone), np.int64)
        for ending in CONTRACTIONS:
            fits = (taken == 0) & (end[lone + 1] - start[lone + 1] >= len(ending))
            for i, sign in enumerate(ending):
                fits &= codes[np.minimum(start[lone + 1] + i, n - 1)] == ord(sign)
            taken[fits] = len(ending)
        end[lone] += taken
        start[lone + 1] += taken
    filled = end > start
    return start[filled], end[filled]


def _pieces(text: str, special: dict[str, int]) -> list[str | int]:
    """Text between special tokens, and the ids of those."""
    out: list[str | int] = []
    at = 0
    while special:
        found = min(((i, -len(s), s) for s in special if (i := text.find(s, at)) >= 0), default=None)
        if found is None:
            break
        out += [text[at : found[0]], special[found[2]]]
        at = found[0] - found[1]
    return [*out, text[at:]]


def encode_batch(tokenizer: Tokenizer, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of all texts, and the place where each text begins (one more for the end)."""
    pieces: list[str] = []
    special: list[tuple[int, int]] = []  # number of pieces before it, id
    heads = [0]  # pieces and special tokens before each text
    for text in texts:
        for piece in _pieces(text, tokenizer.special) if "<|" in text else (text,):
            if isinstance(piece, int):
                special.append((len(pieces), piece))
            else:
                pieces.append(_normal(piece))
        heads.append(len(pieces))
    joined = "".join(pieces)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
    start, end = split_words(codes, first)
    hashed = RangeHash(mix(codes.astype(U64) + U64(1)))(start, end)
    _, index, words = np.unique(hashed, return_index=True, return_inverse=True)
    sizes = 1 + (codes >= 0x80).astype(np.int64) + (codes >= 0x800) + (codes >= 0x10000)
    byte = np.concatenate([[0], np.cumsum(sizes)])
    buf = np.frombuffer(joined.encode("utf-8", "surrogatepass"), np.uint8)
    flat, counts = tokenizer.encode_words(buf, byte[start[index]], byte[end[index]])
    at = np.searchsorted(start, first)
    begin = at[heads]
    if special:  # each is a word of one token between the pieces
        between = np.array([n for n, _ in special])
        words = np.insert(words, at[between], len(counts) + np.arange(len(special)))
        begin = begin + np.searchsorted(between, heads, "left")
        flat = np.concatenate([flat, [i for _, i in special]])
        counts = np.concatenate([counts, np.ones(len(special), np.int64)])
    many = counts[words]
    ids = flat[ranges((np.cumsum(counts) - counts)[words], many)]
    return ids, np.concatenate([[0], np.cumsum(many)])[begin]


@cache
def _load(path: str) -> Tokenizer:
    return Tokenizer(path)


def encode(documents: DataFrame, path: str, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id``, ``ids`` (array of token ids) and ``decoded`` (the tokens joined by a space).

    ``path`` names a tokenizer file that every machine has. Special tokens spelled out in a text
    become their ids; nothing is added, cut or filled up.

    One row per input row, repeated ids included; a null or blank text has no tokens; a null id
    stays null. Texts and words of any length are encoded whole. An empty table gives an empty
    result; further columns are ignored. No shuffle takes place.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _load(path)
        for rows, _, _ in chunks(batches, "text"):
            ids, at = encode_batch(tokenizer, rows.column("text").to_pylist())
            lists = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), pa.array(ids.astype(np.int32)))
            yield pa.RecordBatch.from_arrays([rows.column("id"), lists, tokenizer.spell(ids, at)], ["id", "ids", "decoded"])

    encoded = as_documents(documents, id_name, text).mapInArrow(run, "id long, ids array<int>, decoded string")
    return encoded.select(named(), "ids", "decoded")


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """Replace column ``ids`` by the text of its tokens, joined by a space; null stays null."""
    others = [c for c in encoded.columns if c != ids]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = _load(path)
        for batch in batches:
            lists = batch.column(ids)
            sizes = np.nan_to_num(lists.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
            at = np.concatenate([[0], np.cumsum(sizes)])
            texts = tokenizer.spell(lists.flatten().to_numpy().astype(np.int64), at)
            texts = pc.if_else(lists.is_valid(), texts, None)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in others), texts], [*others, name])

    schema = encoded.select(*[F.col(f"`{c}`") for c in others], F.lit("").cast("string").alias(name)).schema
    return encoded.mapInArrow(run, schema)
