"""Passages of benchmark items inside documents, by a prefix-filtered set join.

An item's window counts as contained only with all its shingles, so its necessary prefix in the
order of rarity is one shingle: the one that documents hold least often. Documents are joined to
windows on that shingle alone; bounds on place and length and then the window's words decide.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import as_documents, named
from lakeops.llm.scan import ALNUM, LOWER, U64, RangeHash, Words, chunks, signed

WINDOW = 10
SHINGLE = 3
# Bytes of benchmark text that tasks hold at once; a larger benchmark is taken in several passes.
BLOCK_BYTES = 8 << 20


class Windows:
    """The distinct windows of some items, with the shingles and the items of each."""

    def __init__(self, texts: list[str], labels: list[str | None], window: int, shingle: int):
        raw = [t.encode() for t in texts]
        at = np.concatenate([[0], np.cumsum([len(t) for t in raw])]).astype(np.int64)
        words = Words(np.frombuffer(b"".join(raw), np.uint8), at, ALNUM)
        hashed = RangeHash(words.hashes(lower=True))
        text = LOWER[words.buf].tobytes()
        found: dict[bytes, int] = {}
        items: list[set[str]] = []
        self.size, self.hash, self.tokens = [], [], []
        for item, n in enumerate(words.count.tolist()):
            size = min(window, n)
            for start in range(words.first[item], words.first[item + 1] - size + 1) if n else ():
                spelled = b" ".join(text[words.start[i] : words.end[i]] for i in range(start, start + size))
                if spelled not in found:
                    found[spelled] = len(items)
                    items.append(set())
                    k = min(shingle, size)
                    begin = np.arange(start, start + size - k + 1)
                    self.size.append(size)
                    self.hash.append(hashed(np.array([start]), np.array([start + size]))[0])
                    self.tokens.append(hashed(begin, begin + k))
                if labels[item] is not None:
                    items[found[spelled]].add(labels[item])
        self.words = list(found)
        self.items = [sorted(x) for x in items]
        self.all_tokens = np.unique(np.concatenate(self.tokens)) if self.tokens else np.zeros(0, U64)
        self.shingles = sorted({min(shingle, n) for n in self.size})

    def rarest(self, counts: dict[int, int]) -> dict[str, np.ndarray]:
        """Rarest shingle of each window that can occur: its hash, place, window; sorted by hash."""
        token, offset, window = [], [], []
        for i, tokens in enumerate(self.tokens):
            seen = np.array([counts.get(t, 0) for t in tokens.view(np.int64).tolist()])
            if seen.min() > 0:  # a shingle no document holds rules the window out
                best = int(seen.argmin())
                token.append(tokens[best])
                offset.append(best)
                window.append(i)
        order = np.argsort(np.array(token, U64), kind="stable")
        return {
            "token": np.array(token, U64)[order],
            "offset": np.array(offset, np.int64)[order],
            "window": np.array(window, np.int64)[order],
        }


def _grams(hashed: RangeHash, words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and starts of the shingles of k words inside documents."""
    grams = hashed.grams(k)
    start = np.arange(len(grams))
    ok = start + k <= words.first[np.searchsorted(words.first, start, "right")] if len(grams) else np.zeros(0, bool)
    return grams[ok], start[ok]


def _present(values: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Places of values found in a sorted table."""
    low = table[np.minimum(np.searchsorted(table, values), len(table) - 1)]
    return np.flatnonzero(low == values)


class _Filter:
    """A bitmap that settles most lookups before the search in a sorted table."""

    def __init__(self, table: np.ndarray, bits: int = 20):
        self.table, self.shift = table, U64(64 - bits)
        self.map = np.zeros(1 << bits, bool)
        self.map[(table >> self.shift).astype(np.int64)] = True

    def __call__(self, values: np.ndarray) -> np.ndarray:
        likely = np.flatnonzero(self.map[(values >> self.shift).astype(np.int64)])
        return likely[_present(values[likely], self.table)] if len(self.table) else likely[:0]


def _count_tokens(tokens, shingles: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = _Filter(tokens.value)
        total = np.zeros(len(tokens.value), np.int64)
        for _, buf, at in chunks(batches, "text"):
            words = Words(buf, at, ALNUM)
            hashed = RangeHash(words.hashes(lower=True))
            for k in shingles:
                grams, _ = _grams(hashed, words, k)
                hits = grams[lookup(grams)]
                total += np.bincount(np.searchsorted(lookup.table, hits), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([signed(lookup.table[some]), pa.array(total[some])], ["token", "n"])

    return run


def _search(x: dict, buf: np.ndarray, at: np.ndarray) -> tuple[Words, list[list[tuple[int, int, int]]]]:
    """Words of the texts and, per text, the word spans of windows found and which they are."""
    lookup = _Filter(x["token"])
    words = Words(buf, at, ALNUM)
    hashed = RangeHash(words.hashes(lower=True))
    hit: list[list[tuple[int, int, int]]] = [[] for _ in range(len(at) - 1)]
    for k in x["shingles"] if len(lookup.table) else ():
        grams, places = _grams(hashed, words, k)
        near = lookup(grams)
        low = np.searchsorted(lookup.table, grams[near])
        many = np.searchsorted(lookup.table, grams[near], "right") - low
        entry = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        window = x["window"][entry]
        start = np.repeat(places[near], many) - x["offset"][entry]
        end = start + x["size"][window]
        doc = np.searchsorted(words.first, np.repeat(places[near], many), "right") - 1
        fits = (start >= words.first[doc]) & (end <= words.first[doc + 1])
        start, end, window, doc = start[fits], end[fits], window[fits], doc[fits]
        same = hashed(start, end) == x["hash"][window]
        for s, e, w, d in zip(*(v[same].tolist() for v in (start, end, window, doc))):
            spelled = (LOWER[buf[a:b]].tobytes() for a, b in zip(words.start[s:e].tolist(), words.end[s:e].tolist()))
            if b" ".join(spelled) == x["words"][w]:
                base = int(words.first[d])
                hit[d].append((s - base, e - base, w))
    return words, hit


def _find_windows(shared):
    kind = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = shared.value
        for rows, buf, at in chunks(batches, "text"):
            words, hit = _search(x, buf, at)
            spans = [[{"a": s, "b": e} for s, e in sorted({(s, e) for s, e, _ in found})] for found in hit]
            items = [sorted({i for _, _, w in found for i in x["items"][w]}) for found in hit]
            yield pa.RecordBatch.from_arrays(
                [rows.column("id"), rows.column("version"), pa.array(words.count), pa.array(spans, kind), pa.array(items, pa.list_(pa.string()))],
                ["id", "version", "n_words", "spans", "items"],
            )

    return run


def _indexes(
    docs: DataFrame, benchmark: DataFrame, item_name: str, item_text: str, window: int, shingle: int, block_bytes: int
) -> Iterator:
    """Broadcast windows of the benchmark, block by block, each with its shingles' counts in ``docs``."""
    context = docs.sparkSession.sparkContext
    texts = benchmark.select(
        F.col(f"`{item_name}`").cast("string").alias("item"),
        F.coalesce(F.col(f"`{item_text}`").cast("string"), F.lit("")).alias("words"),
    )
    total = texts.agg(F.coalesce(F.sum(F.octet_length("words") + 64), F.lit(0))).first()[0]
    blocks = max(1, -(-int(total) // block_bytes))
    for block in range(blocks):
        part = texts.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block).collect()
        windows = Windows([r.words for r in part], [r.item for r in part], window, shingle)
        tokens = context.broadcast(windows.all_tokens)
        counted = (
            docs.select("text")
            .mapInArrow(_count_tokens(tokens, windows.shingles), "token long, n long")
            .groupBy("token")
            .agg(F.sum("n"))
            .collect()  # at most one row for each shingle of the block
        )
        yield context.broadcast(
            windows.rarest({token: n for token, n in counted})
            | {
                "size": np.array(windows.size, np.int64),
                "hash": np.array(windows.hash, U64),
                "words": windows.words,
                "items": windows.items,
                "shingles": windows.shingles,
            }
        )


def drop_contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item_name: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows, with all their columns, that hold no window of a benchmark item."""

    def clean(shared):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for rows, buf, at in chunks(batches, text):
                _, hit = _search(shared.value, buf, at)
                yield rows.filter(pa.array([not found for found in hit], pa.bool_()))

        return run

    docs = documents.select(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"))
    kept = documents
    for shared in _indexes(docs, benchmark, item_name, item_text, window, shingle, block_bytes):
        kept = kept.mapInArrow(clean(shared), documents.schema)
    return kept


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    item_name: str = "item_id",
    item_text: str = "text",
    window: int = WINDOW,
    shingle: int = SHINGLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Words of documents that lie in windows of benchmark items.

    Words are runs of ASCII letters (lower-cased), digits and non-ASCII characters. A window is
    ``window`` words of an item in a row; an item of fewer words, but not none, is one window.
    Returns ``doc_id``, ``n_words``, ``n_hit``, ``items`` (ids of items with occurring windows, as
    sorted strings), ``spans`` (word spans of the occurrences) and ``contaminated``.

    One row per input row, repeated ids included. A null text has no words; a null id stays null;
    an item without an id still marks words but is not listed. Empty tables give no hits or no
    rows; further columns are ignored. Tasks hold at most about ``block_bytes`` of the benchmark:
    its size is measured, and a larger one is taken in several passes over the documents.
    """
    docs = as_documents(documents, id_name, text).withColumn("version", F.xxhash64("text"))
    passes = [
        docs.mapInArrow(
            _find_windows(shared),
            "id long, version long, n_words long, spans array<struct<a: long, b: long>>, items array<string>",
        )
        for shared in _indexes(docs, benchmark, item_name, item_text, window, shingle, block_bytes)
    ]
    found = passes[0]
    if (blocks := len(passes)) > 1:
        for more in passes[1:]:
            found = found.unionAll(more)
        found = found.groupBy("id", "version", "n_words").agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            (F.count("*") / blocks).cast("int").alias("rows"),
        )
        found = found.withColumn("row", F.explode(F.sequence(F.lit(1), F.col("rows"))))
    # Spans come sorted by start: each adds what lies beyond the ends before it.
    reach = F.aggregate(
        "spans",
        F.struct(F.lit(0).cast("long").alias("end"), F.lit(0).cast("long").alias("n")),
        lambda acc, s: F.struct(
            F.greatest(acc["end"], s["b"]).alias("end"),
            (acc["n"] + F.greatest(F.lit(0).cast("long"), s["b"] - F.greatest(acc["end"], s["a"]))).alias("n"),
        ),
    )["n"]
    return found.select(
        named(), "n_words", reach.alias("n_hit"), "items", "spans", (F.size("spans") > 0).alias("contaminated")
    )
