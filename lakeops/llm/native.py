"""Column expressions shared by the operators that run without Python."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F

BLOCK = 64


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, computed once per row however often the body names it."""
    return F.transform(F.array(value), body)[0]


def running_starts(items: Column, size: Callable[[Column], Column]) -> Column:
    """For each item of an array the sum of the sizes before it.

    Sums within blocks, then over blocks: building an array item by item copies it each time,
    which must stay cheap for arrays of any length.
    """

    def sums(sizes: Column, start: Column) -> Column:
        grown = F.aggregate(
            sizes,
            F.struct(start.alias("next"), F.array().cast("array<long>").alias("starts")),
            lambda acc, n: F.struct(
                (acc["next"] + n).alias("next"),
                F.concat(acc["starts"], F.array(acc["next"])).alias("starts"),
            ),
        )
        return grown["starts"]

    zero = F.lit(0).cast("long")
    last = F.greatest(F.size(items) - 1, F.lit(0))
    blocks = F.transform(
        F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int")),
        lambda b: F.transform(F.slice(items, b * BLOCK + 1, F.lit(BLOCK)), lambda x: size(x).cast("long")),
    )
    return let(
        blocks,
        lambda parts: F.flatten(
            F.zip_with(
                parts,
                sums(F.transform(parts, lambda p: F.aggregate(p, zero, lambda a, n: a + n)), zero),
                sums,
            )
        ),
    )


def unused(columns: list[str], name: str) -> str:
    """``name``, longer where a column is called so already, in any letter case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


PAGE = 1024


def pages_of(text: Column) -> Column:
    """The text in pages of :data:`PAGE` characters, from which :func:`part` cuts in time free of the place."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PAGE}}}"), F.lit(0))


def part(pages: Column, start: Column, end: Column) -> Column:
    """Characters from ``start`` up to ``end`` (at least ``start``), both from 0.

    ``substring`` of the whole text counts characters from its beginning each time.
    """
    first = F.floor(start / PAGE)
    count = F.floor(end / PAGE) - first + 1
    # A place at the very end lies behind the last page.
    near = F.array_join(F.slice(pages, (first + 1).cast("int"), count.cast("int")), "")
    return F.substring(near, (start - first * PAGE + 1).cast("int"), (end - start).cast("int"))


def in_chunks(items: Column) -> Column:
    """The items in arrays of :data:`BLOCK`; one empty array where there are none."""
    last = F.greatest(F.size(items) - 1, F.lit(0))
    return F.transform(
        F.sequence(F.lit(0), F.floor(last / BLOCK).cast("int")), lambda b: F.slice(items, b * BLOCK + 1, F.lit(BLOCK))
    )


def scan(items: Column, start: Column, step: Callable[[Column, Column], Column], kind: str) -> Column:
    """What ``step`` adds for each item in turn, as one array of type ``kind``.

    ``step`` takes the state and an item and returns a struct of the next ``state`` and an array
    ``added``. Arrays grow chunk by chunk, as adding to a long array copies it.
    """

    def one(acc: Column, item: Column) -> Column:
        return let(
            step(acc["state"], item),
            lambda s: F.struct(s["state"].alias("state"), F.concat(acc["added"], s["added"]).alias("added")),
        )

    def many(acc: Column, chunk: Column) -> Column:
        fresh = F.struct(acc["state"].alias("state"), F.array().cast(kind).alias("added"))
        return let(
            F.aggregate(chunk, fresh, one),
            lambda s: F.struct(s["state"].alias("state"), F.concat(acc["added"], s["added"]).alias("added")),
        )

    begin = F.struct(start.alias("state"), F.array().cast(kind).alias("added"))
    return F.aggregate(in_chunks(items), begin, many)["added"]
