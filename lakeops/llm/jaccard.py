"""Links between texts whose word shingles overlap, through an R-tree over group counts.

Every shingle falls into one of ``GROUPS`` groups by its hash, and a set is the point of its
counts per group. Two sets share at most the sum of the smaller counts, and the sets below two
tree nodes at most the sum of the smaller corners, so nodes whose corners stay below the
overlap a link needs are left out together. Points meet by their rarest shingles: linked sets
share one of them, which deals the points out to blocks, each with its own tree. Surviving pairs
are verified on the sets themselves.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from lakeops.llm.common import Bitmap, as_documents, components, kept_documents, kept_table, named
from lakeops.llm.scan import NOT_SPACE, U64, RangeHash, Words, chunks, mix, signed

GROUPS = 64
RARITY_BITS = 18
LEAF = 48
# Members of a block that one task takes together; a larger block is dealt out in cells.
CROWD = 4096


def shingles(buf: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts, sorted within each text, and where each begins.

    A text of fewer words than ``k``, but not none, has one shingle of all its words.
    """
    words = Words(buf, at, NOT_SPACE)
    hashed = RangeHash(words.hashes(lower=True))
    start = np.arange(len(words))
    doc = words.doc
    left = words.first[1:][doc] - start
    short = (start == words.first[doc]) & (left < k)
    whole = left >= k
    use = whole | short
    start, doc = start[use], doc[use]
    tokens = hashed(start, start + np.minimum(left[use], k))
    order = np.lexsort((tokens, doc))
    tokens, doc = tokens[order], doc[order]
    new = np.ones(len(tokens), bool)
    new[1:] = (tokens[1:] != tokens[:-1]) | (doc[1:] != doc[:-1])
    tokens, doc = tokens[new], doc[new]
    return tokens, np.searchsorted(doc, np.arange(len(at)))


def _count_shingles(k: int):
    """Shingles per hashed bucket, in rows of 1,024 buckets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << RARITY_BITS, np.int64)
        for _, buf, at in chunks(batches, "text"):
            tokens, _ = shingles(buf, at, k)
            total += np.bincount((tokens >> U64(64 - RARITY_BITS)).astype(np.int64), minlength=len(total))
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    return run


def _digests(tokens: np.ndarray, first: np.ndarray) -> list[pa.Array]:
    """Two sums over each set, equal for equal sets."""
    sums = [np.concatenate([np.zeros(1, U64), np.cumsum(x)]) for x in (tokens, mix(tokens ^ U64(0x5851F42D4C957F2D)))]
    return [signed(s[first[1:]] - s[first[:-1]]) for s in sums]


def _sizes(k: int):
    """Size and digest of each text's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, "text"):
            tokens, first = shingles(buf, at, k)
            columns = [rows.column("id"), pa.array(np.diff(first)), *_digests(tokens, first)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n", "s1", "s2"])

    return run


def _profile(k: int, percent: int, rarity, bitmap: Bitmap):
    """Size, digest, group counts and necessary rarest shingles of the sets of texts in the bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(bitmap.pick(batches), "text"):
            tokens, first = shingles(buf, at, k)
            n = np.diff(first)
            doc = np.repeat(np.arange(len(n)), n)
            groups = np.bincount(doc * GROUPS + (tokens & U64(GROUPS - 1)).astype(np.int64), minlength=len(n) * GROUPS)
            often = rarity.value[(tokens >> U64(64 - RARITY_BITS)).astype(np.int64)]
            order = np.lexsort((tokens, often, doc))
            need = np.where(n > 0, n - -(-percent * n // 100) + 1, 0)
            rank = np.arange(len(tokens)) - np.repeat(first[:-1], n)
            prefix = tokens[order][rank < np.repeat(need, n)]
            ends = np.concatenate([[0], np.cumsum(need)]).astype(np.int32)
            steps = pa.array((np.arange(len(n) + 1) * GROUPS).astype(np.int32))
            yield pa.RecordBatch.from_arrays(
                [
                    rows.column("id"),
                    pa.array(n),
                    *_digests(tokens, first),
                    pa.ListArray.from_arrays(steps, pa.array(groups.astype(np.int32))),
                    pa.ListArray.from_arrays(pa.array(ends), signed(prefix)),
                ],
                ["id", "n", "s1", "s2", "groups", "prefix"],
            )

    return run


def _sets(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows, buf, at in chunks(batches, "text"):
            tokens, first = shingles(buf, at, k)
            lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), signed(tokens))
            yield pa.RecordBatch.from_arrays([rows.column("id"), lists], ["id", "tokens"])

    return run


class Tree:
    """R-tree over points of one block; nodes keep their upper corner and smallest set size."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray, labels: np.ndarray, leaf: int = LEAF):
        self.points, self.sizes, self.labels = points, sizes, labels
        self.leaf = leaf
        self.nodes: list[tuple] = []
        self.root = self._build(np.arange(len(points)))

    def _build(self, members: np.ndarray) -> int:
        children = ()
        if len(members) > self.leaf:
            part = self.points[members]
            axis = int(np.argmax(part.max(axis=0) - part.min(axis=0)))
            order = members[np.argsort(part[:, axis], kind="stable")]
            half = len(order) // 2
            children = (self._build(order[:half]), self._build(order[half:]))
        labels = self.labels[members]
        one = labels[0] if (labels == labels[0]).all() else None
        self.nodes.append((self.points[members].max(axis=0), int(self.sizes[members].min()), one, children, members))
        return len(self.nodes) - 1

    def join(self, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Members of node pairs that may hold links, both leaves."""
        todo = [(self.root, self.root)]
        while todo:
            a, b = todo.pop()
            (top_a, least_a, one_a, below_a, members_a), (top_b, least_b, one_b, below_b, members_b) = self.nodes[a], self.nodes[b]
            if one_a is not None and one_a == one_b:
                continue  # linked already
            if a != b and np.minimum(top_a, top_b).sum() * (100 + percent) < percent * (least_a + least_b):
                continue
            if not below_a and not below_b:
                yield members_a, members_b
            elif a == b:
                left, right = below_a
                todo += [(left, left), (right, right), (left, right)]
            elif below_a and (not below_b or len(members_a) >= len(members_b)):
                todo += [(x, b) for x in below_a]
            else:
                todo += [(a, x) for x in below_b]


def _pairs_within(starts: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All pairs (i < j) within small blocks of rows."""
    later = np.repeat(starts + sizes, sizes) - 1 - np.concatenate([np.arange(s, s + m) for s, m in zip(starts, sizes)])
    i = np.repeat(np.concatenate([np.arange(s, s + m) for s, m in zip(starts, sizes)]), later)
    ends = np.cumsum(later)
    return i, i + 1 + np.arange(len(i)) - np.repeat(ends - later, later)


def _search_blocks(percent: int):
    """Pairs of unlike label within each block (rows come sorted by block) that may be linked."""

    def survivors(t: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        ok = ((t["salt"][i] != t["salt"][j]) | t["inner"][i]) & _compatible(t, i, j, percent)
        i, j = i[ok], j[ok]
        keep = np.zeros(len(i), bool)
        for a in range(0, len(i), 1 << 16):
            part = slice(a, a + (1 << 16))
            shared = np.minimum(t["groups"][i[part]], t["groups"][j[part]]).sum(axis=1)
            keep[part] = shared * (100 + percent) >= percent * (t["n"][i[part]] + t["n"][j[part]])
        return i[keep], j[keep]

    def search(batches: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches).combine_chunks()
        t = {c: table.column(c).to_numpy() for c in ("block", "id", "label", "n", "pos", "salt", "inner")}
        t["groups"] = table.column("groups").combine_chunks().flatten().to_numpy().reshape(-1, GROUPS)
        starts = np.flatnonzero(np.append(True, t["block"][1:] != t["block"][:-1]))
        sizes = np.diff(np.append(starts, len(t["block"])))
        found = []
        small = sizes <= LEAF
        if small.any():
            found.append(survivors(t, *_pairs_within(starts[small], sizes[small])))
        for start, size in zip(starts[~small].tolist(), sizes[~small].tolist()):
            rows = slice(start, start + size)
            tree = Tree(t["groups"][rows], t["n"][rows], t["label"][rows])
            for a, b in tree.join(percent):
                i, j = np.repeat(a, len(b)), np.tile(b, len(a))
                once = i < j if a is b else np.ones(len(i), bool)
                found.append(survivors(t, start + i[once], start + j[once]))
        i = np.concatenate([x for x, _ in found])
        j = np.concatenate([x for _, x in found])
        a, b = t["id"][i], t["id"][j]
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], ["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_blocks(batches, "block"):
            yield from search(whole)

    return run


def _whole_blocks(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[list[pa.RecordBatch]]:
    """Batches of rows sorted by block, regrouped so that no block is cut."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        blocks = batch.column(column).to_numpy()
        cut = int(np.searchsorted(blocks, blocks[-1]))  # the last block may go on
        if cut or (held and held[-1].column(column)[-1].as_py() != blocks[0]):
            yield [*held, batch.slice(0, cut)] if cut else held
            held = []
        held.append(batch.slice(cut))
    if held:
        yield held


def _compatible(t: dict[str, np.ndarray], i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Whether rows of a block may be linked by label, size and place of the shared shingle.

    The first shingle two sets share leaves them only what comes after it in both, so some block
    of a linked pair passes.
    """
    n, m = t["n"][i], t["n"][j]
    rest = np.minimum(n - t["pos"][i], m - t["pos"][j])
    return (
        (t["label"][i] != t["label"][j])
        & (t["id"][i] != t["id"][j])
        & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
        & (rest * (100 + percent) >= percent * (n + m))
    )


def _thin_blocks(percent: int):
    """Rows of small blocks that have a compatible row in their block; of others all rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in _whole_blocks(batches, "token"):
            table = pa.Table.from_batches(whole).combine_chunks()
            t = {c: table.column(c).to_numpy() for c in ("token", "id", "label", "n", "pos")}
            starts = np.flatnonzero(np.append(True, t["token"][1:] != t["token"][:-1]))
            sizes = np.diff(np.append(starts, len(t["token"])))
            small = sizes <= LEAF
            keep = np.repeat(~small, sizes)
            if small.any():
                i, j = _pairs_within(starts[small], sizes[small])
                ok = _compatible(t, i, j, percent)
                keep[i[ok]] = keep[j[ok]] = True
            yield from table.filter(pa.array(keep)).to_batches()

    return run


def _fits(percent: int, n: Column, m: Column, most: Column) -> Column:
    """Whether sets of these sizes with at most so many common shingles can be linked."""
    return (100 * F.least(n, m) >= percent * F.greatest(n, m)) & (most * (100 + percent) >= percent * (n + m))


def verified(docs: DataFrame, pairs: DataFrame, k: int, percent: int) -> DataFrame:
    """Of pairs (``a``, ``b``) of ids those whose sets overlap enough; each set moves once a side."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    sets = kept_documents(docs, ids).dropDuplicates(["id"]).mapInArrow(_sets(k), "id long, tokens array<long>")
    sets = kept_table(sets, "jaccard-sets")
    first = sets.select(F.col("id").alias("a"), F.col("tokens").alias("ta"))
    second = sets.select(F.col("id").alias("b"), F.col("tokens").alias("tb"))
    both = pairs.join(first, "a").join(second, "b")
    shared = F.size(F.array_intersect("ta", "tb")).cast("long")
    total = F.size("ta") + F.size("tb")
    return both.where(shared * (100 + percent) >= percent * total).select("a", "b")


def link_documents(
    documents: DataFrame,
    id_name: str = "doc_id",
    text: str = "text",
    k: int = 3,
    percent: int = 90,
    crowd: int = CROWD,
) -> DataFrame:
    """``doc_id``, ``n_shingles`` and ``component_id`` of every text.

    A text's set holds its distinct shingles of ``k`` words (A-Z lower-cased, split at ASCII white
    space); a text of fewer words has one shingle. Two texts are linked when the intersection is at
    least ``percent`` hundredths of the union. ``component_id`` is the least id reachable by links.

    A null, empty or blank text has no shingles and is linked with nothing. One row per input row;
    rows that repeat an id and a text give equal rows, and rows of one id with different texts are
    judged each by its own text, of which pairs verify one. A null id is the least of all ids and
    comes back as null. An empty table gives an empty result; further columns are ignored.

    Equal sets count once. Each remaining set is first tied to the least id it may be linked with;
    the tree then searches only pairs that those links leave in different components. So
    thousands of near copies cost one pair each, and no link between components is missed.
    """
    spark = documents.sparkSession
    docs = as_documents(documents, id_name, text)
    counted = (
        docs.mapInArrow(_count_shingles(k), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toArrow()
    )  # at most 2 ** RARITY_BITS rows
    often = np.zeros(1 << RARITY_BITS, np.int64)
    often[counted.column("bucket").to_numpy()] = counted.column("n").to_numpy()
    rarity = spark.sparkContext.broadcast(often)
    sizes = kept_table(docs.mapInArrow(_sizes(k), "id long, n long, s1 long, s2 long"), "jaccard-sizes")
    classes = kept_table(
        sizes.where("n > 0").groupBy("n", "s1", "s2").agg(F.min("id").alias("id")), "jaccard-classes"
    )
    profiles = Bitmap.placed(docs).mapInArrow(
        _profile(k, percent, rarity, Bitmap(classes)),
        "id long, n long, s1 long, s2 long, groups array<int>, prefix array<long>",
    )
    points = kept_table(
        profiles.join(classes, ["id", "n", "s1", "s2"]).dropDuplicates(["id"]).select("id", "n", "groups", "prefix"),
        "jaccard-points",
    )
    vectors = points.select("id", "n", "groups")
    dealt = points.select("id", "n", F.posexplode("prefix").alias("pos", "token"))
    shared = dealt.groupBy("token").agg(F.count("*").alias("members")).where("members > 1")
    met = kept_table(dealt.join(shared, "token"), "jaccard-blocks")
    heads = met.groupBy("token").agg(F.min(F.struct("id", "n", "pos")).alias("head"))

    left = vectors.select(F.col("id").alias("a"), F.col("groups").alias("ga"))
    right = vectors.select(F.col("id").alias("b"), F.col("groups").alias("gb"))
    head = F.col("head")
    rest = F.least(head["n"] - head["pos"], F.col("n") - F.col("pos"))
    least = F.aggregate(F.zip_with("ga", "gb", lambda x, y: F.least(x, y)), F.lit(0), lambda acc, x: acc + x)
    nearest = (
        met.join(heads, "token")
        .where((F.col("id") != head["id"]) & _fits(percent, head["n"], F.col("n"), rest))
        .select(head["id"].alias("a"), F.col("id").alias("b"), head["n"].alias("na"), F.col("n").alias("nb"))
        .distinct()
        .join(left, "a")
        .join(right, "b")
        .where(_fits(percent, F.col("na"), F.col("nb"), least))
        .groupBy("b")
        .agg(F.min("a").alias("a"))
    )
    tried = kept_table(nearest.select("a", "b"), "jaccard-pairs")
    links = kept_table(verified(docs, tried, k, percent), "jaccard-links")
    labels = components(links)

    placed = (
        met.select("token", "id", "n", "pos", "members")
        .join(labels, "id", "left")
        .select("token", "id", "n", "pos", "members", F.coalesce("root", "id").alias("label"))
    )
    small = placed.where(F.col("members") <= crowd)
    thin = small.repartition("token").sortWithinPartitions("token").mapInArrow(_thin_blocks(percent), small.schema)
    cells = F.ceil(F.col("members") / crowd).cast("int")
    searched = (
        thin.unionAll(placed.where(F.col("members") > crowd))
        .select("*", cells.alias("cells"), F.pmod(F.xxhash64("id"), cells).cast("int").alias("salt"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)))
        .select(
            "id",
            "n",
            "pos",
            "label",
            "salt",
            (F.col("salt") == F.col("other")).alias("inner"),
            F.xxhash64("token", F.least("salt", "other"), F.greatest("salt", "other")).alias("block"),
        )
        .join(vectors.select("id", "groups"), "id")
        .select("block", "id", "label", "n", "pos", "salt", "inner", "groups")
        .repartition("block")
        .sortWithinPartitions("block")
        .mapInArrow(_search_blocks(percent), "a long, b long")
        .distinct()
    )
    found = kept_table(searched.join(tried, ["a", "b"], "left_anti"), "jaccard-pairs")
    links = links.unionAll(verified(docs, found, k, percent))
    roots = components(links)
    members = (
        classes.join(roots, "id", "left")
        .select("n", "s1", "s2", F.coalesce("root", "id").alias("root"))
    )
    out = sizes.join(members, ["n", "s1", "s2"], "left")
    out = out.withColumn("root", F.coalesce("root", "id"))
    return out.select(named(), F.col("n").alias("n_shingles"), named("root", "component_id"))
