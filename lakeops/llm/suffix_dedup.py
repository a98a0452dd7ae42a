"""Removal of long byte strings that occur more than once, by suffix arrays over candidate texts.

Equal strings of ``length`` bytes contain the same least k-gram at the same distance. Runs of
neighbouring strings with one such k-gram travel as two hashes; equal runs need nothing more. Only
where a k-gram lies in different runs (the borders of repeats) do the bytes themselves
travel, one copy of each run, and a suffix array over them finds for every suffix its previous
and next smaller positions in suffix order and thereby its longest earlier match.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import as_documents, kept_table, named
from lakeops.llm.scan import byte_hash, chunks, covered, paths, signed

LENGTH = 200
GRAM = 64
ARRAY_BYTES = 1 << 20
# Text a task hashes at once; each byte takes some 120 more in arrays.
SCAN_BYTES = 1 << 19
STEP = 1 << 16
# Different runs around one k-gram that one suffix array takes together (6 MB of text, as a run has
# at most 2 * LENGTH - GRAM bytes); more are matched by hash.
CROWD = (6 << 20) // (2 * LENGTH - GRAM)


def suffix_order(text: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix array and ranks by the first ``depth`` bytes of each suffix, equal ones by place.

    Ranks double their depth round by round; a last round of overlapping halves ends at
    exactly ``depth``. Suffixes shorter than that are left out.
    """
    n = len(text) - depth + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    reach = 1
    rank = text.astype(np.int64)
    while reach < depth:
        step = min(reach, depth - reach)
        if reach < 4:  # packed bytes are their own ranks
            rank = (rank[:-step] << (8 * step)) | (rank[step:] & ((1 << (8 * step)) - 1))
        else:
            rank = _dense((rank[:-step].astype(np.int64) << 32) | rank[step:])
        reach += step
        if reach == 4:
            rank = _dense(rank)
    order = np.argsort(rank, kind="stable")
    return order, rank


def _dense(keys: np.ndarray) -> np.ndarray:
    order = np.argsort(keys)
    keys = keys[order]
    new = np.zeros(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    out = np.empty(len(keys), np.int32)
    out[order] = np.cumsum(new, dtype=np.int32)
    return out


def smaller_neighbours(order: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Previous and next smaller positions in suffix order, -1 where there is none."""
    n = len(order)
    before, after = np.full(n, -1, np.int64), np.full(n, -1, np.int64)
    stack: list[int] = []
    for at in range(0, n, STEP):  # a list of all places would take four times the array
        for place in order[at : at + STEP].tolist():
            while stack and stack[-1] > place:
                after[stack.pop()] = place
            if stack:
                before[place] = stack[-1]
            stack.append(place)
    return before, after


def earlier_matches(text: np.ndarray, starts: np.ndarray, length: int) -> np.ndarray:
    """For each window the index of an earlier one with the same ``length`` bytes, or -1.

    Window i starts at ``starts[i]``. Its longest previous factor is the longer of the matches with
    the previous and the next smaller index in suffix order; only whether that reaches
    ``length`` matters, which is when the ranks to that depth are equal.
    """
    _, rank = suffix_order(text, length)
    rank = rank[starts]
    found = np.full(len(starts), -1, np.int64)
    for neighbour in smaller_neighbours(np.argsort(rank, kind="stable")):
        hit = (neighbour >= 0) & (rank == rank[neighbour])
        found[hit] = neighbour[hit]
    return found


def _find_paths(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, "text", SCAN_BYTES):
            hashed = byte_hash(buf)
            grams = hashed.grams(gram)
            first, last, anchor = paths(grams, at, length, gram)
            if not len(first):
                continue
            doc = np.searchsorted(at, first, "right") - 1
            ids = rows.column("id").to_numpy()
            yield pa.RecordBatch.from_arrays(
                [
                    signed(grams[anchor]),
                    signed(hashed(first, last + length)),
                    pa.array(ids[doc]),
                    pa.array((first - at[doc]).astype(np.int32)),
                    pa.array((last - first + 1).astype(np.int32)),
                ],
                ["gram", "path", "id", "start", "n"],
            )

    return run


def _cut_pieces(length: int):
    """Bytes of the wanted runs of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, "text"):
            wanted = rows.column("wanted")
            flat = wanted.flatten()
            doc = np.repeat(np.arange(rows.num_rows), wanted.value_lengths().to_numpy())
            start = flat.field("start").to_numpy().astype(np.int64)
            n = flat.field("n").to_numpy()
            begin = at[doc] + start
            end = np.minimum(begin + n - 1 + length, at[doc + 1])
            raw = buf.tobytes()
            pieces = [raw[a:b] for a, b in zip(begin.tolist(), end.tolist())]
            ids = rows.column("id").to_numpy()[doc]
            yield pa.RecordBatch.from_arrays(
                [flat.field("gram"), pa.array(ids), flat.field("start"), flat.field("crowded"), pa.array(pieces, pa.binary())],
                ["gram", "id", "start", "crowded", "piece"],
            )

    return run


def _windows_of(sizes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Piece and offset of every whole window of pieces of these sizes."""
    count = np.maximum(sizes - length + 1, 0)
    piece = np.repeat(np.arange(len(sizes)), count)
    offset = np.arange(len(piece)) - np.repeat(np.cumsum(count) - count, count)
    return piece, offset


def _runs(ids: np.ndarray, start: np.ndarray, length: int) -> pa.RecordBatch:
    """Spans of window starts, neighbouring ones joined."""
    order = np.lexsort((start, ids))
    ids, start = ids[order], start[order]
    new = np.ones(len(ids), bool)
    new[1:] = (ids[1:] != ids[:-1]) | (start[1:] > start[:-1] + 1)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(ids)) - 1
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids[head]),
            pa.array(start[head].astype(np.int32)),
            pa.array((start[tail] + length).astype(np.int32)),
        ],
        ["id", "a", "b"],
    )


def _match_pieces(length: int, keep_first: bool):
    """Suffix arrays over whole groups of pieces that share a k-gram (rows come sorted by it)."""

    def repeated(table: pa.Table) -> pa.RecordBatch | None:
        table = table.sort_by([("id", "ascending"), ("start", "ascending")])
        pieces = table.column("piece").combine_chunks()
        offsets = np.frombuffer(pieces.buffers()[1], np.int32)[pieces.offset : pieces.offset + len(pieces) + 1].astype(np.int64)
        text = np.frombuffer(pieces.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        piece, offset = _windows_of(np.diff(offsets), length)
        if len(piece) < 2:
            return None
        ids = table.column("id").to_numpy()[piece]
        start = table.column("start").to_numpy()[piece].astype(np.int64) + offset
        match = earlier_matches(text, offsets[piece] + offset, length)
        later = np.flatnonzero(match >= 0)
        # One document may have come in repeated rows: its windows do not match themselves.
        other = (ids[later] != ids[match[later]]) | (start[later] != start[match[later]])
        later = later[other]
        hit = later if keep_first else np.concatenate([later, match[later]])
        return _runs(ids[hit], start[hit], length) if len(hit) else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            at = 0
            grams = batch.column("gram").to_numpy()
            ends = np.append(np.flatnonzero(grams[1:] != grams[:-1]) + 1, batch.num_rows)
            for end in ends.tolist():
                part = batch.slice(at, end - at)
                if held and size >= ARRAY_BYTES and held[-1].column("gram")[-1].as_py() != grams[at]:
                    if (found := repeated(pa.Table.from_batches(held))) is not None:
                        yield found
                    held, size = [], 0
                held.append(part)
                size += int(np.diff(np.frombuffer(part.column("piece").buffers()[1], np.int32)[part.column("piece").offset :][: part.num_rows + 1]).sum())
                at = end
        if held and (found := repeated(pa.Table.from_batches(held))) is not None:
            yield found

    return run


def _hash_windows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, "piece_text"):
            piece, offset = _windows_of(np.diff(at), length)
            begin = at[piece] + offset
            yield pa.RecordBatch.from_arrays(
                [
                    signed(byte_hash(buf)(begin, begin + length)),
                    pa.array(rows.column("id").to_numpy()[piece]),
                    pa.array((rows.column("start").to_numpy()[piece] + offset).astype(np.int32)),
                ],
                ["window", "id", "start"],
            )

    return run


def repeated_spans(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, keep_first: bool = True, crowd: int = CROWD
) -> DataFrame:
    """Columns ``id``, ``a``, ``b``: byte spans of repeated strings (they may overlap).

    ``docs`` has ``id`` and ``text`` (see :func:`as_documents`).
    """
    marks = docs.mapInArrow(_find_paths(length, gram), "gram long, path long, id long, start int, n int")
    marks = kept_table(marks, "suffix-marks")
    twice = marks.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    known = kept_table(marks.join(twice, "gram", "left_semi"), "suffix-runs")
    where = F.struct("id", "start", "n")
    classes = kept_table(
        known.groupBy("gram", "path").agg(F.min(where).alias("first"), F.max(where).alias("last")),
        "suffix-classes",
    )
    again = classes.where("first <> last").select("gram", "path", F.col("first.id").alias("id0"), F.col("first.start").alias("start0"))
    whole = known.join(again, ["gram", "path"])
    if keep_first:
        whole = whole.where("id <> id0 OR start <> start0")
    whole = whole.select("id", F.col("start").alias("a"), (F.col("start") + F.col("n") - 1 + length).alias("b"))

    heads = classes.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1")
    wanted = (
        classes.select("gram", "first.*")
        .join(heads, "gram")
        .groupBy("id")
        .agg(F.collect_list(F.struct("gram", "start", "n", (F.col("k") > crowd).alias("crowded"))).alias("wanted"))
    )
    pieces = docs.join(wanted, "id").mapInArrow(
        _cut_pieces(length), "gram long, id long, start int, crowded boolean, piece binary"
    )
    spans = "id long, a int, b int"
    matched = (
        pieces.where("NOT crowded")
        .select("gram", "id", "start", "piece")
        .repartition("gram")
        .sortWithinPartitions("gram")
        .mapInArrow(_match_pieces(length, keep_first), spans)
    )
    windows = pieces.where("crowded").select("id", "start", F.col("piece").alias("piece_text"))
    windows = windows.mapInArrow(_hash_windows(length), "window long, id long, start int")
    place = F.struct("id", "start")
    ends = windows.groupBy("window").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first <> last")
    crowded = windows.join(ends, "window")
    if keep_first:
        crowded = crowded.where("id <> first.id OR start <> first.start")
    crowded = crowded.select("id", F.col("start").alias("a"), (F.col("start") + length).alias("b"))
    return whole.unionAll(matched).unionAll(crowded)


def _cut_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows, buf, at in chunks(batches, "text"):
        spans = rows.column("spans")
        flat = spans.flatten()
        sizes = np.nan_to_num(spans.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        doc = np.repeat(np.arange(rows.num_rows), sizes)
        begin = np.minimum(at[doc] + flat.field("a").to_numpy(), at[doc + 1])
        end = np.minimum(at[doc] + flat.field("b").to_numpy(), at[doc + 1])
        gone = covered(np.stack([begin, end], 1), len(buf))
        edge = gone.copy()
        edge[1:] &= ~gone[:-1]
        first = at[:-1][at[:-1] < len(buf)]
        edge[first] = gone[first]
        sums = np.concatenate([[0], np.cumsum(gone)])
        heads = np.concatenate([[0], np.cumsum(edge)])
        kept = buf[~gone].tobytes()
        left = at - sums[at]
        yield pa.RecordBatch.from_arrays(
            [
                rows.column("id"),
                pa.array(np.diff(at)),
                pa.array(sums[at[1:]] - sums[at[:-1]]),
                pa.array(heads[at[1:]] - heads[at[:-1]]),
                pa.array([kept[a:b] for a, b in zip(left[:-1].tolist(), left[1:].tolist())], pa.binary()),
            ],
            ["id", "n_bytes", "n_removed", "n_spans", "kept"],
        )


def remove_repeats(
    documents: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    length: int = LENGTH,
    keep_first: bool = True,
    gram: int = GRAM,
    crowd: int = CROWD,
) -> DataFrame:
    """Texts without byte strings of ``length`` or more that occur elsewhere too.

    With ``keep_first`` the occurrence with the smallest id, and there the earliest start, stays;
    otherwise all occurrences go. Strings are judged on the input and never cross documents.
    Returns ``doc_id``, ``n_bytes``, ``n_removed``, ``n_spans`` (maximal removed runs) and ``kept``
    (binary, as a cut may fall inside a character).

    A null text is empty; texts shorter than ``length`` stay. Rows that repeat an id count as one
    document: they do not match each other, and what is removed from one is removed from all. A
    null id is one id of its own, before all others. An empty table gives an empty result; further
    columns are ignored.
    """
    docs = as_documents(documents, id_name, text)
    spans = repeated_spans(docs, length, gram, keep_first, crowd)
    by_doc = spans.groupBy("id").agg(F.collect_list(F.struct("a", "b")).alias("spans"))
    cut = docs.join(by_doc, "id", "left").mapInArrow(
        _cut_out, "id long, n_bytes long, n_removed long, n_spans long, kept binary"
    )
    return cut.select(named(), "n_bytes", "n_removed", "n_spans", "kept")
