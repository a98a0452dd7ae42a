"""Whitening of vectors on whole-number grids, each distinct vector worked on once.

Equal grid vectors are one class with a count. The fit takes each class once, or as often as its
count says; exact sums and a centred product of matrices per task add up to a covariance, whose
eigenvectors turn every class into components of variance one. A join gives them back to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from lakeops.llm.common import NO_ID, kept_table, named
from lakeops.llm.vectors import finite, numbers

SCALE = 256
COMPONENTS = 4
WIDTHS = {2: np.int16, 4: np.int32, 8: np.int64}
HALF = 1 << 32
TOP = float(2**63 - 1024)


def _grid(scale: float):
    """Whole numbers floor(scale * c) of each vector, in the fewest bytes that hold all of them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = vectors.value_lengths().to_numpy().astype(np.int64)
            if not len(sizes):
                continue
            flat = vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            with np.errstate(over="ignore"):
                x = np.clip(np.floor(scale * flat), -TOP, TOP).astype(np.int64)
            first = np.cumsum(sizes) - sizes
            low, high = np.minimum.reduceat(x, first), np.maximum.reduceat(x, first)
            parts, order = [], []
            left = np.ones(len(sizes), bool)
            for width, kind in WIDTHS.items():
                bounds = np.iinfo(kind)
                rows = left & (low >= bounds.min) & (high <= bounds.max)
                left &= ~rows
                raw = x[np.repeat(rows, sizes)].astype(kind)
                ends = np.concatenate([[0], np.cumsum(sizes[rows]) * width]).astype(np.int32)
                buffers = [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(raw.tobytes())]
                parts.append(pa.Array.from_buffers(pa.binary(), int(rows.sum()), buffers))
                order.append(np.flatnonzero(rows))
            back = np.argsort(np.concatenate(order), kind="stable")
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(sizes.astype(np.int32)), pa.concat_arrays(parts).take(pa.array(back))],
                ["id", "size", "x"],
            )

    return run


def _matrices(batch: pa.RecordBatch, size: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows of each width and their grid vectors."""
    packed = batch.column("x")
    lengths = np.array([len(raw) for raw in packed.to_pylist()]) // size
    for width, kind in WIDTHS.items():
        rows = np.flatnonzero(lengths == width)
        if len(rows):
            raw = b"".join(packed.take(pa.array(rows)).to_pylist())
            yield rows, np.frombuffer(raw, kind).reshape(len(rows), size).astype(np.int64)


def _sums(size: int):
    """Weight and sums of every dimension, as halves of 32 bits, which add up exactly."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        high, low = np.zeros(size, object), np.zeros(size, object)
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            for rows, x in _matrices(batch, size):
                w = weight[rows]
                if w.max() > 1 << 16:
                    w = w.astype(object)  # products of halves and weights must not wrap
                high += (w @ (x >> 32)).astype(object)
                low += (w @ (x & (HALF - 1))).astype(object)
        total = high * HALF + low
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.arange(size, dtype=np.int32)),
                pa.array([int(s) // HALF for s in total], pa.int64()),
                pa.array([int(s) % HALF for s in total], pa.int64()),
            ],
            ["i", "high", "low"],
        )

    return run


def _products(size: int, mean: np.ndarray):
    """Sums over a task of the products of centred entries, upper triangle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((size, size))
        for batch in batches:
            weight = batch.column("weight").to_numpy()
            for rows, x in _matrices(batch, size):
                centred = x - mean
                total += (centred * weight[rows][:, None]).T @ centred
        i, j = np.triu_indices(size)
        columns = [pa.array(i.astype(np.int32)), pa.array(j.astype(np.int32)), pa.array(total[i, j])]
        yield pa.RecordBatch.from_arrays(columns, ["i", "j", "v"])

    return run


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int]:
    """Exact sum over dimensions of (n * x - S)^2 for each row."""
    if not x.size:
        return [0] * len(x)
    most = n * max(abs(int(x.min())), abs(int(x.max()))) + max(map(abs, sums))
    if most * most * x.shape[1] < 1 << 63:
        off = n * x - np.array(sums, np.int64)
        return (off * off).sum(axis=1).tolist()
    off = n * x.astype(object) - np.array(sums, object)
    return (off * off).sum(axis=1).tolist()


def _whiten(size: int, n: int, sums: list[int], mean: np.ndarray, turn: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            off: list[int | None] = [None] * batch.num_rows
            out = np.zeros((batch.num_rows, turn.shape[1]))
            for rows, x in _matrices(batch, size):
                for row, value in zip(rows.tolist(), deviations(x, n, sums)):
                    off[row] = value if value < 10**38 else None
                out[rows] = (x - mean) @ turn
            ends = (np.arange(batch.num_rows + 1) * turn.shape[1]).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("x"),
                    batch.column("weight"),
                    pa.array(off, pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel())),
                ],
                ["x", "weight", "deviation", "whitened"],
            )

    return run


def _directions(covariance: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """Largest eigenvalues and their unit vectors, the entry of greatest size positive.

    Directions without variance, up to rounding, cannot be whitened and are left out.
    """
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1], vectors[:, ::-1]
    some = int((values > max(values[0], 0) * len(values) * np.finfo(float).eps).sum())
    take = min(components, some)
    values, vectors = values[:take], vectors[:, :take]
    largest = np.abs(vectors).argmax(axis=0)
    return values, vectors * np.sign(vectors[largest, np.arange(take)])


def whiten(
    embeddings: DataFrame,
    id_name: str = "vec_id",
    vector: str = "embedding",
    scale: float = SCALE,
    components: int = COMPONENTS,
    by_count: bool = False,
) -> DataFrame:
    """Whitened components of every usable vector, one row per vector and component.

    A vector's entries c become whole numbers x = floor(scale * c). The fit takes every distinct x
    once, or with ``by_count`` as often as it occurs; n is the number of vectors fitted and S their
    sum. Returns ``vec_id``, ``component`` (from 1, by falling eigenvalue of the covariance of divisor
    n), ``n``, ``deviation`` (decimal: sum over dimensions of (n x - S)^2, exact; null beyond 38
    digits), ``whitened``, ``explained`` (the eigenvalue's part of the trace) and ``identity_error``
    (largest entry of the whitened covariance minus the identity).

    Vectors that are null, empty or hold a null or non-finite entry are dropped, as are those of
    another length than the commonest one (ties: the longer). Numbers beyond 64 bits become the
    largest that fit. Directions without variance give no component, so one distinct vector, or an
    empty table, gives no rows. Equal eigenvalues keep an arbitrary but common choice of directions. Repeated
    rows give equal rows; a null id comes back as null; further columns are ignored.

    The driver sees sums and covariance of the dimensions, whatever the number of rows: up to some
    thousand dimensions.
    """
    given = embeddings.select(
        F.coalesce(F.col(f"`{id_name}`").cast("long"), F.lit(NO_ID)).alias("id"),
        numbers(embeddings, vector).alias("vector"),
    )
    rows = given.where(finite(F.col("vector"))).mapInArrow(_grid(scale), "id long, size int, x binary")
    rows = kept_table(rows, "whitening-rows")
    sizes = rows.groupBy("size").agg(F.count("*").alias("rows")).orderBy(F.desc("rows"), F.desc("size"))
    first = sizes.first()
    size = first["size"] if first else 1
    rows = rows.where(F.col("size") == size).select("id", "x")

    weight = F.count("*") if by_count else F.lit(1).cast("long")
    classes = kept_table(rows.groupBy("x").agg(weight.alias("weight")), "whitening-classes")
    n = classes.agg(F.coalesce(F.sum("weight"), F.lit(0))).first()[0]
    if not n:
        return _components(rows, _nothing(classes), id_name, 0, [], 0.0)
    exact = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    halves = classes.mapInArrow(_sums(size), "i int, high long, low long").groupBy("i").agg(*exact).orderBy("i")
    sums = [int(r["high"]) * HALF + int(r["low"]) for r in halves.collect()]
    mean = np.array([s / n for s in sums])

    products = classes.mapInArrow(_products(size, mean), "i int, j int, v double")
    total = products.groupBy("i", "j").agg(F.sum("v").alias("v")).toArrow()
    i, j = total.column("i").to_numpy(), total.column("j").to_numpy()
    covariance = np.zeros((size, size))
    covariance[i, j] = covariance[j, i] = total.column("v").to_numpy() / n
    values, vectors = _directions(covariance, components)

    found = classes.mapInArrow(
        _whiten(size, n, sums, mean, vectors / np.sqrt(values)),
        "x binary, weight long, deviation decimal(38,0), whitened array<double>",
    )
    found = kept_table(found, "whitening-classes")
    error = _identity_error(found, n, len(values))
    explained = (values / np.trace(covariance)).tolist()
    return _components(rows, found.select("x", "deviation", "whitened"), id_name, n, explained, error)


def _nothing(classes: DataFrame) -> DataFrame:
    return classes.selectExpr(
        "x", "cast(null AS decimal(38,0)) AS deviation", "cast(array() AS array<double>) AS whitened"
    )


def _identity_error(found: DataFrame, n: int, components: int) -> float:
    """Largest entry of the fitted vectors' whitened covariance minus the identity."""
    if not components:
        return 0.0
    each = range(components)
    weight = F.col("weight")
    means = found.agg(*[F.sum(weight * F.col("whitened")[c]) / n for c in each]).first()
    centred = [F.col("whitened")[c] - F.lit(means[c]) for c in each]
    pairs = [(a, b) for a in each for b in each if a <= b]
    sums = found.agg(*[F.sum(weight * centred[a] * centred[b]) / n for a, b in pairs]).first()
    return max(abs(value - (a == b)) for (a, b), value in zip(pairs, sums))


def _components(
    rows: DataFrame, classes: DataFrame, id_name: str, n: int, explained: list[float], error: float
) -> DataFrame:
    """One row per given vector and component, from its class."""
    share = F.array(*map(F.lit, explained)) if explained else F.array().cast("array<double>")
    return (
        rows.join(classes, "x")
        .select("id", "deviation", F.posexplode("whitened").alias("place", "whitened"))
        .select(
            named(name=id_name),
            (F.col("place") + 1).cast("int").alias("component"),
            F.lit(n).cast("long").alias("n"),
            "deviation",
            "whitened",
            F.get(share, F.col("place")).alias("explained"),
            F.lit(error).cast("double").alias("identity_error"),
        )
    )
