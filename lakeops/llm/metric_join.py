"""Near-duplicate vectors by an exact range join around pivots.

On unit vectors a cosine of c is the distance r = sqrt(2 - 2c). Pivots drawn from the data cut a
label's vectors into cells of the nearest pivot. A vector v in the cell of p can have a partner in
the cell of q only if the bisector of p and q is within r of v; the triangle inequality makes that
|v - q|^2 - |v - p|^2 <= 2 r |p - q|. So v is copied to those cells alone, and every cell sees all
partners of its own vectors and joins by itself: numbers of links and one tree of links leave a
cell, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.common import NO_ID, components, kept_table, named
from lakeops.llm.vectors import finite, matrix_of, numbers, unit
from lakeops.operators.joins import join_dimension

# Vectors a cell is meant to hold, pivots of a label and of all labels: the model's size bounds.
CELL = 16_384
PIVOTS = 8
MAX_PIVOTS = 8_192
# A label up to this size is one cell.
ONE_CELL = 256
# Own and foreign vectors of a tile, the part of a cell that one task takes at once.
TILE = 4_096
ROWS_AT_ONCE = 512
SLACK = 1e-9


def pivot_counts(sizes: list[tuple[str, int]], cell: int, pivots: int, one_cell: int) -> dict[str, int]:
    """Pivots of each label, largest labels first, at most ``MAX_PIVOTS`` of all together."""
    counts: dict[str, int] = {}
    left = MAX_PIVOTS
    for group, size in sizes:
        if size <= one_cell or left < 2:
            continue
        share = max(pivots, MAX_PIVOTS * size // max(1, sum(n for _, n in sizes)))
        counts[group] = min(max(pivots, -(-size // cell)), share, left)
        left -= counts[group]
    return counts


def _assign(model, reach: float):
    """Home cell and all cells each vector has to be seen in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = batch.column("group").to_pylist()
            rows_of: dict[str, list[int]] = {}
            for row, group in enumerate(groups):
                rows_of.setdefault(group, []).append(row)
            home = np.zeros(batch.num_rows, np.int32)
            row, cell = [np.arange(batch.num_rows)], [home]
            for group, rows in rows_of.items():
                if group not in model.value:
                    continue
                pivots, apart = model.value[group]
                at = np.array(rows)
                cosine = unit(matrix_of(batch.column("vector").take(pa.array(at)))) @ pivots.T
                near = cosine.argmax(axis=1)
                home[at] = near
                # |v - q|^2 - |v - p|^2 = 2 (v.p - v.q) for unit vectors.
                gap = cosine[np.arange(len(at)), near][:, None] - cosine
                seen = gap <= reach * apart[near] + SLACK
                seen[np.arange(len(at)), near] = False
                i, q = np.nonzero(seen)
                row.append(at[i])
                cell.append(q.astype(np.int32))
            row, cell = np.concatenate(row), np.concatenate(cell)
            order = np.argsort(row, kind="stable")  # the home cell of a row stays its first
            ends = np.searchsorted(row[order], np.arange(batch.num_rows + 1)).astype(np.int32)
            cells = pa.ListArray.from_arrays(pa.array(ends), pa.array(cell[order]))
            yield pa.RecordBatch.from_arrays([*batch.columns, cells], [*batch.schema.names, "cells"])

    return run


def _merge(label: np.ndarray, row: int, others: np.ndarray) -> None:
    """Give all nodes that hang together with a row and its partners one label."""
    found = np.unique(np.append(label[others], label[row]))
    if len(found) > 1:
        label[np.isin(label, found)] = found[0]


def _join_tile(least: float):
    """Links of a tile's own vectors and, for each linked vector, the least id it hangs together with."""

    def run(tile: pa.Table) -> pa.Table:
        ids = tile.column("id").to_numpy()
        mark = tile.column("mark").to_numpy()
        copies = tile.column("copies").to_numpy()
        vectors = unit(matrix_of(tile.column("vector").combine_chunks()))
        own = np.flatnonzero(tile.column("own").to_numpy())
        met = np.flatnonzero(tile.column("met").to_numpy())
        links = np.zeros(len(ids), np.int64)
        label = np.arange(len(ids))
        linked = np.zeros(len(ids), bool)
        for at in range(0, len(own), ROWS_AT_ONCE):
            rows = own[at : at + ROWS_AT_ONCE]
            hit = vectors[rows] @ vectors[met].T >= least
            hit &= rows[:, None] != met[None, :]
            links[rows] = hit @ copies[met]
            for i in np.flatnonzero(hit.any(axis=1)).tolist():
                others = met[hit[i]]
                linked[rows[i]] = True
                linked[others] = True
                _merge(label, rows[i], others)
        root = np.full(len(ids), np.iinfo(np.int64).max)
        np.minimum.at(root, label, ids)
        out = np.flatnonzero(linked)
        return pa.table(
            {"id": ids[out], "mark": mark[out], "links": links[out], "root": root[label[out]]}
        )

    return run


def _tiles(own: Column, n_own: Column, n_all: Column, tile: int) -> Column:
    """Tiles (``i``, ``j``) of a cell that need a vector: its part of the own ones against all met ones and back."""
    parts_i, parts_j = F.ceil(n_own / tile).cast("int"), F.ceil(n_all / tile).cast("int")
    i = F.pmod(F.xxhash64("id", "mark"), parts_i).cast("int")
    j = F.pmod(F.xxhash64("mark", "id"), parts_j).cast("int")

    def at(x: Column, y: Column, is_own: Column) -> Column:
        return F.struct(x.alias("i"), y.alias("j"), is_own.alias("own"), (y == j).alias("met"))

    every_i = F.sequence(F.lit(0), parts_i - 1)
    every_j = F.sequence(F.lit(0), parts_j - 1)
    as_met = F.transform(every_i, lambda x: at(x, j, own & (x == i)))
    as_own = F.transform(F.filter(every_j, lambda y: own & (y != j)), lambda y: at(i, y, F.lit(True)))
    return F.concat(as_met, as_own)


def link_vectors(
    embeddings: DataFrame,
    id_name: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    least: float = 0.98,
    cell: int = CELL,
    pivots: int = PIVOTS,
    one_cell: int = ONE_CELL,
    tile: int = TILE,
) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id`` and ``kept`` of every row.

    Two vectors of one label (not null) and one length are linked when their cosine, in doubles,
    is at least ``least`` (above 0). ``n_links`` counts the other rows a row is linked with,
    ``component_id`` is the least id reachable by links, and ``kept`` says that it is the row's own.

    A vector that is null, empty, zero or holds a null or non-finite entry, and a row without a
    label, are linked with nothing. Equal vectors of a label count as one point with many copies, so
    a repeated row links to its repetitions. Rows that share an id are one vertex of the
    components. A null id is the least of all ids and comes back as null. An empty table gives an
    empty result; further columns are ignored.

    Pivots are vectors of a bounded sample: those with the smallest hashes, at most ``MAX_PIVOTS`` in
    all, on the driver and in a broadcast. They decide only where vectors meet; every vector is
    dealt to cells and no link is lost. A cell with more than ``tile`` vectors is joined in tiles.
    """
    if not 0 < least <= 1:
        raise ValueError("the least cosine must be above 0 and at most 1")
    reach = math.sqrt(2 - 2 * least)
    given = embeddings.select(
        F.coalesce(F.col(f"`{id_name}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(f"`{label}`").cast("string").alias("label"),
        numbers(embeddings, vector).alias("vector"),
    )
    usable = finite(F.col("vector")) & F.exists("vector", lambda x: x != 0) & F.col("label").isNotNull()
    group = F.concat_ws(":", F.size("vector").cast("string"), "label")
    digests = [F.xxhash64("vector").alias("mark"), F.xxhash64(F.lit(1), "vector").alias("mark2")]
    rows = given.select("id", F.when(usable, group).alias("group"), "vector")
    points = rows.where(F.col("group").isNotNull()).groupBy("group", "vector")
    points = points.agg(F.min("id").alias("id"), F.count("*").alias("copies"))
    points = kept_table(points.select("id", "group", *digests, "copies", "vector"), "range-points")

    # At most MAX_PIVOTS / pivots labels and twice MAX_PIVOTS vectors come to the driver.
    top = points.groupBy("group").count().where(F.col("count") > one_cell)
    top = top.orderBy(F.desc("count"), "group").limit(MAX_PIVOTS // pivots)
    sizes = [(r["group"], r["count"]) for r in top.collect()]
    model = points.sparkSession.sparkContext.broadcast(
        _pivots(points, dict(sizes), pivot_counts(sizes, cell, pivots, one_cell))
    )
    schema = f"{points.schema.simpleString()[7:-1].replace(',', ', ')}, cells:array<int>"
    dealt = kept_table(points.mapInArrow(_assign(model, reach), f"struct<{schema}>"), "range-cells")
    spread = dealt.select("id", "mark", "group", "copies", "vector", F.posexplode("cells").alias("place", "cell"))
    own = F.col("place") == 0

    members = spread.groupBy("group", "cell").agg(F.count_if(own).alias("n_own"), F.count("*").alias("n_all"))
    crowded = kept_table(members.where(F.col("n_all") > tile), "range-crowded")
    placed = join_dimension(spread, crowded.withColumnRenamed("group", "g").withColumnRenamed("cell", "c"), {"group": "g", "cell": "c"})
    # A cell of other labels' vectors alone joins nothing, and needs no tile.
    tiles = _tiles(own, F.greatest(F.coalesce("n_own", F.lit(1)), F.lit(1)), F.coalesce("n_all", F.lit(1)), tile)
    found = kept_table(
        placed.withColumn("tile", F.explode(tiles))
        .select("group", "cell", "tile.*", "id", "mark", "copies", "vector")
        .groupBy("group", "cell", "i", "j")
        .applyInArrow(_join_tile(least), "id long, mark long, links long, root long"),
        "range-links",
    )
    roots = components(found.select(F.col("id").alias("a"), F.col("root").alias("b")))
    counted = found.groupBy("id", "mark").agg(F.sum("links").alias("links"))
    classes = (
        points.drop("vector")
        .join(counted, ["id", "mark"], "left")
        .join(roots, "id", "left")
        .select(
            "group",
            "mark",
            "mark2",
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("root"),
        )
    )
    out = rows.select("id", "group", *digests).join(classes, ["group", "mark", "mark2"], "left")
    out = out.withColumn("root", F.coalesce("root", "id"))
    return out.select(
        named(name=id_name),
        F.coalesce("n_links", F.lit(0).cast("long")).alias("n_links"),
        named("root", "component_id"),
        (F.col("id") == F.col("root")).alias("kept"),
    )


def _pivots(points: DataFrame, sizes: dict[str, int], counts: dict[str, int]) -> dict[str, tuple]:
    """Pivots of each label, as unit vectors, and the distances between them."""
    if not counts:
        return {}
    # About twice the wanted number of each label has a hash below its bound.
    spark = points.sparkSession
    bounds = [(g, -(2**63) + min(2**64 - 1, 2**64 * 2 * k // sizes[g])) for g, k in counts.items()]
    bounds = spark.createDataFrame(bounds, "group string, bound long")
    drawn = points.join(F.broadcast(bounds), "group").where(F.xxhash64("mark") <= F.col("bound"))
    sample: dict[str, list] = {}
    for row in drawn.orderBy(F.xxhash64("mark")).limit(3 * MAX_PIVOTS).select("group", "vector").toLocalIterator():
        sample.setdefault(row["group"], []).append(row["vector"])
    out = {}
    for group, vectors in sample.items():
        chosen = unit(np.array(vectors[: counts[group]], np.float64))
        squares = np.maximum(2 - 2 * (chosen @ chosen.T), 0)
        out[group] = (chosen, np.sqrt(squares))
    return out
