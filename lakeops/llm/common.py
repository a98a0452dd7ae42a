"""Frames shared by the operators: documents by id, written tables, kept candidates, components."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeops.session import shared_dir

NO_ID = -(1 << 63)
BITMAP_BITS = 1 << 23


def as_documents(df: DataFrame, id_name: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns ``id`` and ``text`` alone: a null id becomes ``NO_ID`` and a null text empty.

    Other columns are left out, so their names cannot clash with an operator's own.
    """
    return df.select(
        F.coalesce(F.col(f"`{id_name}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.coalesce(F.col(f"`{text}`").cast("string"), F.lit("")).alias("text"),
    )


def named(column: str = "id", name: str = "doc_id") -> Column:
    """The id as it was given."""
    return F.when(F.col(column) != NO_ID, F.col(column)).alias(name)


def kept_table(df: DataFrame, name: str) -> DataFrame:
    """Write a frame once to the folder all machines share and read it back.

    Cuts the lineage where several branches read the same rows: a lost executor costs no
    recomputation, and joins see plain scans, whose hot keys adaptive execution can split.
    """
    folder = shared_dir(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


class Bitmap:
    """A bitmap of fixed size, one hashed bit per id, that goes to all tasks.

    It drops nearly all other rows before an exchange; the join after it is exact, however full the
    bitmap is. ``place`` is the column that :meth:`pick` takes out again.
    """

    place = "__place"

    def __init__(self, ids: DataFrame):
        at = F.pmod(F.xxhash64("id"), F.lit(BITMAP_BITS))
        words = (
            ids.select(at.alias("place"))
            .selectExpr("cast(place div 32 as int) AS word", "shiftleft(1L, cast(place % 32 as int)) AS bit")
            .groupBy("word")
            .agg(F.bit_or("bit").alias("bits"))
            .collect()  # at most BITMAP_BITS / 32 rows
        )
        table = np.zeros(BITMAP_BITS // 32, np.uint32)
        for word, bits in words:
            table[word] = bits
        self.shared = ids.sparkSession.sparkContext.broadcast(table)

    @classmethod
    def placed(cls, docs: DataFrame) -> DataFrame:
        return docs.withColumn(cls.place, F.pmod(F.xxhash64("id"), F.lit(BITMAP_BITS)).cast("long"))

    def pick(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of batches with places the rows whose bit is set, as they were given."""
        for batch in batches:
            *columns, at = batch.columns
            at = at.to_numpy()
            hit = (self.shared.value[at >> 5] >> (at & 31).astype(np.uint32)) & 1 > 0
            yield pa.RecordBatch.from_arrays(columns, batch.schema.names[:-1]).filter(pa.array(hit))


def kept_documents(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose ``id`` is among ``ids``, most others dropped before the exchange."""
    bitmap = Bitmap(ids)
    picked = Bitmap.placed(docs).mapInArrow(bitmap.pick, docs.schema)
    return picked.join(ids.select("id").distinct(), "id", "left_semi")


def components(edges: DataFrame) -> DataFrame:
    """Columns ``id`` and ``root``: the least id reachable over the edges (``a``, ``b``).

    Only ids with an edge appear. Large-star and small-star steps take turns until the edges
    no longer change; every step is an aggregate and a join over written tables, so nothing but a
    pair of numbers reaches the driver.
    """
    edges = kept_table(
        edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "edges",
    )
    state = None
    while True:
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = (
            both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).unionAll(least.where("m < u").select("u", F.col("m").alias("v")))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        ).unionAll(least.select("u", F.col("m").alias("v")))
        edges = kept_table(small.where("u <> v").distinct(), "edges")
        now = edges.agg(
            F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0))
        ).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    members = edges.select(F.col("u").alias("id"), F.col("v").alias("root"))
    return members.unionAll(edges.select(F.col("v").alias("id"), F.col("v").alias("root")).distinct())
