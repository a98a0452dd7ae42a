"""Removal of repeated word sequences through a compacted de Bruijn graph.

An edge is a window of ``length`` words, joining the nodes of its first and its last
``length - 1`` words. Neighbouring edges that share their least k-gram form a path piece, which is
known by two hashes. Equal pieces compact into one by an aggregate; a piece that does not
branch (its k-gram lies in no other piece) is settled by a join on them alone. Where paths branch,
one copy of each piece is taken apart into its edges, and the edges are compacted the same way.
Each compacted piece or edge carries the coordinates of its earliest source.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import as_documents, kept_table, named
from lakeops.llm.scan import NOT_SPACE, RangeHash, Words, chunks, covered, paths, signed

LENGTH = 20
GRAM = 6


def _find_paths(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, "text"):
            words = Words(buf, at, NOT_SPACE)
            hashed = RangeHash(words.hashes())
            grams = hashed.grams(gram)
            first, last, anchor = paths(grams, words.first, length, gram)
            if not len(first):
                continue
            doc = np.searchsorted(words.first, first, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [
                    signed(grams[anchor]),
                    signed(hashed(first, last + length)),
                    pa.array(rows.column("id").to_numpy()[doc]),
                    pa.array((first - words.first[doc]).astype(np.int32)),
                    pa.array((last - first + 1).astype(np.int32)),
                ],
                ["gram", "path", "id", "start", "n"],
            )

    return run


def _split_paths(length: int):
    """The edges of the wanted path pieces of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, "text"):
            words = Words(buf, at, NOT_SPACE)
            hashed = RangeHash(words.hashes())
            wanted = rows.column("wanted")
            flat = wanted.flatten()
            doc = np.repeat(np.arange(rows.num_rows), wanted.value_lengths().to_numpy())
            n = flat.field("n").to_numpy().astype(np.int64)
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            doc = np.repeat(doc, n)
            start = np.repeat(flat.field("start").to_numpy().astype(np.int64), n) + step
            fits = start + length <= words.count[doc]
            doc, start = doc[fits], start[fits]
            begin = words.first[doc] + start
            yield pa.RecordBatch.from_arrays(
                [
                    signed(hashed(begin, begin + length)),
                    pa.array(rows.column("id").to_numpy()[doc]),
                    pa.array(start.astype(np.int32)),
                ],
                ["edge", "id", "start"],
            )

    return run


def repeated_spans(docs: DataFrame, length: int = LENGTH, gram: int = GRAM) -> DataFrame:
    """Columns ``id``, ``a``, ``b``: word spans whose windows occur earlier (they may overlap)."""
    marks = docs.mapInArrow(_find_paths(length, gram), "gram long, path long, id long, start int, n int")
    twice = marks.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    known = kept_table(marks.join(twice, "gram", "left_semi"), "graph-paths")
    where = F.struct("id", "start", "n")
    pieces = kept_table(
        known.groupBy("gram", "path").agg(F.min(where).alias("source"), F.max(where).alias("last")),
        "graph-pieces",
    )
    again = pieces.where("source <> last").select(
        "gram", "path", F.col("source.id").alias("id0"), F.col("source.start").alias("start0")
    )
    whole = (
        known.join(again, ["gram", "path"])
        .where("id <> id0 OR start <> start0")
        .select("id", F.col("start").alias("a"), (F.col("start") + F.col("n") - 1 + length).alias("b"))
    )
    branching = pieces.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1")
    wanted = (
        pieces.select("gram", "source.*")
        .join(branching, "gram", "left_semi")
        .groupBy("id")
        .agg(F.collect_list(F.struct("start", "n")).alias("wanted"))
    )
    edges = kept_table(
        docs.join(wanted, "id").mapInArrow(_split_paths(length), "edge long, id long, start int"),
        "graph-edges",
    )
    place = F.struct("id", "start")
    compact = (
        edges.groupBy("edge")
        .agg(F.min(place).alias("source"), F.max(place).alias("last"))
        .where("source <> last")
        .select("edge", F.col("source.id").alias("id0"), F.col("source.start").alias("start0"))
    )
    later = (
        edges.join(compact, "edge")
        .where("id <> id0 OR start <> start0")
        .select("id", F.col("start").alias("a"), (F.col("start") + length).alias("b"))
    )
    return whole.unionAll(later)


def _cut_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, at in chunks(batches, "text"):
        words = Words(buf, at, NOT_SPACE)
        spans = rows.column("spans")
        flat = spans.flatten()
        sizes = np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        doc = np.repeat(np.arange(rows.num_rows), sizes)
        limit = words.first[1:][doc]
        begin = np.minimum(words.first[doc] + flat.field("a").to_numpy(), limit)
        end = np.minimum(words.first[doc] + flat.field("b").to_numpy(), limit)
        gone = covered(np.stack([begin, end], 1), len(words))
        # Kept words with one space behind each: a gap of bytes between words shrinks to one.
        size = (words.end - words.start + 1) * ~gone
        source = np.repeat(words.start, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
        out = np.append(buf, np.uint8(32))[source]
        out[np.cumsum(size[~gone]) - 1] = 32
        ends = np.concatenate([[0], np.cumsum(size)])[words.first]
        raw = out.tobytes()
        texts = [raw[a : max(a, b - 1)] for a, b in zip(ends[:-1].tolist(), ends[1:].tolist())]
        removed = np.concatenate([[0], np.cumsum(gone)])[words.first]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("id"),
                pa.array(words.count),
                pa.array(np.diff(removed)),
                pa.array(texts, pa.binary()).cast(pa.string()),
            ],
            ["id", "n_words", "n_removed", "kept"],
        )


def remove_repeated_words(
    documents: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    gram: int = GRAM,
) -> DataFrame:
    """Texts without the words of sequences of ``length`` or more words that occurred earlier.

    Words are runs of bytes other than ASCII white space, unchanged. Earlier means a smaller id, or
    in the same document an earlier start; sequences are judged on the input and never cross
    documents. Returns ``doc_id``, ``n_words``, ``n_removed`` and ``kept`` (kept words joined by one
    space).

    A null text has no words; texts of fewer words than ``length`` stay. Rows that repeat an id
    count as one document: they do not match each other, and what is removed from one is removed
    from all. A null id is one id of its own, before all others. An empty table gives an empty
    result; further columns are ignored.
    """
    docs = as_documents(documents, id_name, text)
    spans = repeated_spans(docs, length, gram)
    by_doc = spans.groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    cut = docs.join(by_doc, "id", "left").mapInArrow(
        _cut_words, "id long, n_words long, n_removed long, kept string"
    )
    return cut.select(named(), "n_words", "n_removed", "kept")
