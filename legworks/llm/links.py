"""Links between items that share a bucket: cells of bounded size, and their classes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from legworks.llm.common import in_few_files, staged


def cells(rows: DataFrame, max_rows: int, max_weight: int, n_rows: int | None = None) -> DataFrame:
    """Buckets of two or more items, cut into cells that one task can compare.

    ``rows``: bucket, item (a pair at most once) and weight.  A bucket over
    ``max_rows`` or ``max_weight`` is dealt into blocks by item, with a cell for each
    pair of blocks, so every pair of its items meets in exactly one cell and
    no pair is written out.  Columns of the result: cell, bucket, item, side (block within
    the cell; pairs are taken across sides, or all if ``across`` is false) and
    ``others``, the item's shared buckets in order, by which a pair that shares several
    buckets is counted in the smallest only.  With ``n_rows``, the number of ``rows``, few rows
    come in few partitions.
    """
    sizes = (rows.groupBy("bucket").agg(F.count("*").alias("n"), F.sum("weight").alias("w"))
             .where("n > 1")
             .select("bucket", F.ceil(F.greatest(F.col("n") / max_rows, F.col("w") / max_weight))
                     .cast("int").alias("blocks")))
    shared = staged(rows.join(sizes, "bucket").select("bucket", "item", "blocks"), "shared",
                    n_rows)
    others = shared.groupBy("item").agg(F.sort_array(F.collect_list("bucket")).alias("others"))
    block = F.pmod(F.xxhash64("item", "bucket"), F.col("blocks")).cast("int")
    found = (shared.join(others, "item")
             .withColumn("block", block)
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
             .select(F.when(F.col("blocks") == 1, F.col("bucket")).otherwise(
                         F.xxhash64("bucket", F.least("block", "other"),
                                    F.greatest("block", "other"))).alias("cell"),
                     "bucket", "item", (F.col("block") > F.col("other")).alias("side"),
                     (F.col("block") != F.col("other")).alias("across"), "others"))
    # a large bucket's items come once for each of its blocks
    return found if n_rows is None else in_few_files(
        found, shared.agg(F.sum("blocks")).head()[0] or 0)


def open_pairs(group: pa.Table) -> np.ndarray:
    """Matrix of the pairs that this cell has to compare: each pair once (i < j), across
    sides if it is a cell of two blocks, and in no smaller bucket that both items are in.
    """
    n = group.num_rows
    todo = np.triu(np.ones((n, n), bool), 1)
    if group.column("across")[0].as_py():
        side = group.column("side").to_numpy(zero_copy_only=False)
        todo &= side[:, None] != side[None, :]
    bucket = group.column("bucket")[0].as_py()
    by_other: dict[int, list[int]] = {}
    for i, others in enumerate(group.column("others").to_pylist()):
        for b in others:
            if b >= bucket:
                break
            by_other.setdefault(b, []).append(i)
    for rows in by_other.values():
        if len(rows) > 1:
            todo[np.ix_(rows, rows)] = False
    return todo


def summary(items: list[int], links: np.ndarray, weights: np.ndarray) -> list[tuple]:
    """(item, root, links) of the items with links: links counts the partners' weights, the root is
    the smallest item among those that the links connect."""
    i, j = np.nonzero(links)
    if not len(i):
        return []
    root = list(range(len(items)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in zip(i.tolist(), j.tolist(), strict=True):
        a, b = find(a), find(b)
        if a != b:
            if items[a] > items[b]:
                a, b = b, a
            root[b] = a
    count = (np.bincount(i, weights[j], len(items)) + np.bincount(j, weights[i], len(items)))
    return [(items[k], items[find(k)], int(count[k])) for k in np.flatnonzero(count)]


def components(edges: DataFrame, max_rounds: int = 100) -> DataFrame:
    """Smallest member of each node's connected component: node, root.

    ``edges``: a, b (long), staged or cheap to count.  Alternating stars: every node hands its larger
    neighbours to its smallest one, then its smaller neighbours, until nothing
    changes.  Each round joins edges with one row per node; a hub's edges are
    split by Spark's handling of skewed joins.  The rounds grow with the
    logarithm of the longest chain.
    """
    edges = edges.where("a <> b")
    now = staged(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
                 .distinct(), "edges", edges.count())

    def stars(pairs: DataFrame, large: bool) -> DataFrame:
        # neighbours in both directions, or only the smaller ones
        both = pairs.union(pairs.select(F.col("v").alias("u"), F.col("u").alias("v"))) \
            if large else pairs
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn(
            "m", F.least("u", "m"))
        out = both.join(least, "u")
        if large:
            out = out.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        else:
            out = out.select(F.col("v").alias("u"), F.col("m").alias("v")).union(
                least.select("u", F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    state, rows = None, now.count()
    for _ in range(max_rounds):
        now = staged(stars(stars(now, True), False), "edges", rows)
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v") % 1_000_003)).head()
        if seen == state:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(
                now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        state, rows = seen, seen[0]
    raise RuntimeError(f"no fixed point after {max_rounds} rounds")
