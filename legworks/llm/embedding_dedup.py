"""Near-duplicate embeddings: a small-world graph per shard, every shard queried by every row."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from legworks.llm.common import map_groups, sample_by_hash, small_side, staged
from legworks.llm.hnsw import Graph
from legworks.llm.links import components

SIMILAR = 0.95
SLACK = 1e-4                   # by which single precision may miss; what it finds is verified
RECALL = 0.995                 # of the audits of a shard
BEAM = 32                      # where audits begin; doubled until they pass
LEAST_SHARDS, SHARD_ROWS = 4, 32_768
PART_ROWS, PARTS = 16_384, 8   # queries that a task puts to a shard: four times as many if these are more parts
AUDITS, TURNED = 1_024, 256    # audit queries: rows of the table, and rows of the shard turned
CHUNK = 512                    # queries at a time
MAX_BROADCAST = 10_000

INDEX = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("place", T.IntegerType()),
    T.StructField("item", T.LongType()), T.StructField("weight", T.LongType()),
    T.StructField("unit", T.ArrayType(T.DoubleType())), T.StructField("links", T.BinaryType()),
    T.StructField("beam", T.IntegerType()), T.StructField("recall", T.DoubleType())])
LINKS = T.StructType([T.StructField("item", T.LongType()), T.StructField("root", T.LongType()),
                      T.StructField("links", T.LongType())])


def _vectors(rows: DataFrame) -> DataFrame:
    """vec_id, item (a hash of the components; null if the row can't link) and unit vector."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    links = F.col("embedding").isNotNull() & sound & F.exists(x, lambda v: v != 0)
    plain = F.transform(x, lambda v: v + F.lit(0.0))        # one kind of zero
    scaled = F.transform("plain", lambda v: v / F.array_max(F.transform("plain", F.abs)))
    norm = F.sqrt(F.aggregate("scaled", F.lit(0.0), lambda a, v: a + v * v))
    return (rows.select(F.col("vec_id").cast("long"), F.when(links, plain).alias("plain"))
            .select("vec_id", "plain", F.when(F.col("plain").isNotNull(), F.xxhash64("plain"))
                    .alias("item"), scaled.alias("scaled")).withColumn("norm", norm)
            .select("vec_id", "item", F.transform(
                "scaled", lambda v: v / F.col("norm")).alias("unit")))


def _units(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _audited(graph: Graph, asked: np.ndarray, similar: float, recall: float, seed: int
             ) -> tuple[int, float]:
    """The beam, widened until audits pass, and the recall they found with it.

    Audits compare what a search finds with all rows: for rows of the table as they are, and for
    rows of the shard turned so far that they are just similar enough.
    """
    x = graph.x
    rng = np.random.default_rng(seed % (1 << 63))
    base = x[rng.integers(0, len(x), min(TURNED, len(x)))].astype(np.float64)
    aside = rng.normal(size=base.shape)
    aside -= (aside * base).sum(axis=1, keepdims=True) * base
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    near = min(1.0, similar + 0.002)
    turned = np.where(size > 0, near * base + np.sqrt(1 - near * near) * aside
                      / np.where(size > 0, size, 1), base)
    sets = []
    for queries in (asked, turned):
        q = np.ascontiguousarray(queries, np.float32)
        true = np.zeros(len(q), np.int64)
        for who, _ in graph.compared(q, similar):
            true += np.bincount(who, minlength=len(q))
        sets.append((q[true > 0], true[true > 0]))
    width = BEAM
    while True:
        worst = 1.0
        for q, true in sets:
            if len(q):
                found = np.zeros(len(q))
                for lo in range(0, len(q), CHUNK):
                    part = q[lo:lo + CHUNK]
                    for who, _ in graph.pairs(part, similar, width):
                        found[lo:lo + CHUNK] += np.bincount(who, minlength=len(part))
                worst = min(worst, (found / true).mean(), found.sum() / true.sum())
        if worst >= recall or 4 * width >= len(x):
            return width, float(worst)
        width *= 2


def _indexer(similar: float, recall: float):
    def build(group: pa.Table) -> list[tuple]:
        audit = group.column("audit").to_numpy()
        own = group.filter(pa.array(~audit)).sort_by("item")
        x = _units(own.column("unit"))
        asked = group.filter(pa.array(audit)).sort_by("item")
        shard = group.column("shard")[0].as_py()
        graph = Graph(x)
        width, found = _audited(graph, _units(asked.column("unit")) if asked.num_rows else x[:0],
                                similar, recall, abs(shard))
        n = len(x)
        return list(zip([shard] * n, range(n), own.column("item").to_pylist(),
                        own.column("weight").to_pylist(), x, graph.dumps(), [width] * n, [found] * n,
                        strict=True))

    return build


def index(items: DataFrame, similar: float = SIMILAR, recall: float = RECALL) -> DataFrame:
    """A graph per shard, as a written table with a row per item and its links, so that no row is as
    large as a shard; a shard has about ``SHARD_ROWS`` rows at most.

    ``items``: item, weight, unit, shard, dims, n_shards.  Rows are dealt to shards by hash.
    """
    asked = sample_by_hash(items.select("item", "unit", "dims"), ["item"], AUDITS)
    shards = items.select("shard", "dims").distinct()
    audits = (asked.join(shards, "dims").select("shard", "item", "unit")
              .withColumn("weight", F.lit(0).cast("long")).withColumn("audit", F.lit(True)))
    rows = (items.select("shard", "item", "unit", "weight").withColumn("audit", F.lit(False))
            .unionByName(audits))
    n = shards.count()
    return staged(map_groups(rows, "shard", _indexer(similar, recall), INDEX, tasks=max(1, 8 * n),
                             held_rows=1), "vector-index")


def _forest(a: np.ndarray, b: np.ndarray, n: int) -> np.ndarray:
    """The smallest node that each of ``n`` nodes is connected with by the edges a, b."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new


class _Asked:
    """A shard's graph while a part of the table queries it, and what the links connect so far."""

    def __init__(self, own: list[pa.RecordBatch], similar: float):
        def joined(name: str) -> np.ndarray:
            return np.concatenate([b.column(name).to_numpy(zero_copy_only=False) for b in own])

        self.similar, self.beam = similar, own[0].column("beam")[0].as_py()
        self.items, self.weights = joined("item"), joined("weight")
        self.units = np.concatenate([_units(b.column("unit")) for b in own])
        self.graph = Graph.loads(self.units, [r for b in own for r in b.column("links").to_pylist()])
        self.label = np.arange(len(self.items))

    def answer(self, items: np.ndarray, x: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """item, an item that it links to, and its links' weight, of the queries with links."""
        for who, row in self.graph.pairs(x, self.similar - SLACK, self.beam):
            sure = np.concatenate([np.zeros(0, bool), *(
                np.einsum("ij,ij->i", x[who[k:k + 50_000]], self.units[row[k:k + 50_000]])
                >= self.similar for k in range(0, len(who), 50_000))])
            sure &= self.items[row] != items[who]
            who, row = who[sure], row[sure]
            if len(who):
                links = np.bincount(who, self.weights[row], len(items)).astype(np.int64)
                one = np.zeros(len(items), np.int64)
                one[who] = row
                self._connect(one[who], row)
                asked = np.flatnonzero(links)
                yield items[asked], self.items[one[asked]], links[asked]

    def _connect(self, a: np.ndarray, b: np.ndarray) -> None:
        """Rows that one query links to get the same label."""
        a, b = self.label[a], self.label[b]
        apart = a != b
        nodes, at = np.unique(np.concatenate([a[apart], b[apart]]), return_inverse=True)
        half, lowest = len(at) // 2, np.arange(len(self.label))
        lowest[nodes] = nodes[_forest(at[:half], at[half:], len(nodes))]
        self.label = lowest[self.label]

    def connected(self) -> tuple[np.ndarray, ...]:
        """As from ``answer``: the shard's rows that the links connect, with one of them, and no links."""
        some = np.flatnonzero(self.label != np.arange(len(self.label)))
        return self.items[some], self.items[self.label[some]], np.zeros(len(some), np.int64)


def _linker(similar: float):
    schema = to_arrow_schema(LINKS)

    def told(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, own, asked = None, [], None         # a cell, its graph's rows, and the graph
        for batch in batches:
            cell = batch.column("cell").to_numpy()
            query = batch.column("place").is_null().to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((cell[1:] != cell[:-1]) | (query[1:] != query[:-1])) + 1
            edges = [0, *cuts.tolist(), len(cell)] if len(cell) else []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                part = batch.slice(lo, hi - lo)
                if cell[lo] != now:
                    if asked is not None:
                        yield told(asked.connected())
                    now, own, asked = cell[lo], [], None
                if not query[lo]:
                    own.append(part)
                    continue
                if asked is None:
                    asked, own = _Asked(own, similar), []
                for at in range(0, part.num_rows, CHUNK):
                    some = part.slice(at, CHUNK)
                    for columns in asked.answer(some.column("item").to_numpy(),
                                                _units(some.column("unit"))):
                        yield told(columns)
        if asked is not None:
            yield told(asked.connected())

    return run


def near_vectors(items: DataFrame, similar: float = SIMILAR, recall: float = RECALL) -> DataFrame:
    """item, root, links: rows of items with a link, and another item of the same class; links counts
    partners' weights, and an item's are the sum of its rows'."""
    graphs = index(items, similar, recall)
    shards = items.select("shard", "dims", "n_parts").distinct()
    part = F.explode(F.sequence(F.lit(0), F.col("n_parts") - 1)).alias("part")
    cell = F.xxhash64("shard", "part").alias("cell")
    shards = staged(shards, "vector-shards")
    of_graph = graphs.join(small_side(shards.select("shard", "n_parts"), MAX_BROADCAST), "shard")
    of_graph = of_graph.select("*", part).select(cell, "place", "item", "weight", "unit", "links",
                                                 "beam")
    asked = (items.select("item", "unit", "dims", F.pmod(F.xxhash64("item", F.lit("part")),
                                                         "n_parts").cast("int").alias("part"))
             .join(small_side(shards.select("shard", "dims"), MAX_BROADCAST), "dims")
             .select(cell, "item", "unit"))
    rows = of_graph.unionByName(asked, allowMissingColumns=True)
    tasks = 4 * int(shards.agg(F.sum("n_parts")).head()[0] or 0)
    return staged(rows.repartition(max(1, tasks), "cell")
                  .sortWithinPartitions("cell", F.col("place").asc_nulls_last())
                  .mapInArrow(_linker(similar), LINKS), "vector-links")


def embedding_dedup(vectors: DataFrame, similar: float = SIMILAR, recall: float = RECALL
                    ) -> DataFrame:
    """Vectors whose cosine with another is ``similar`` or more, in classes.

    Equal vectors are one item.  Items are dealt by hash to shards of bounded size, each
    with a hierarchical navigable small-world graph in a written table.  Each
    shard's beam is doubled until audits against all of its rows reach ``recall``: for a sample of the
    table's items (``AUDITS``, the only sample: all rows are indexed and all are
    queries), and for rows turned to be just similar enough.  Every item then queries every
    shard; a query whose beam ends full of links is compared with the whole shard, so a
    dense group of near copies loses none.  Cosines are verified in double
    precision.  Links leave a task as counts and a spanning forest, and classes
    are connected components.

    A vector that is null, empty or zero, or holds a null or non-finite component, links
    with nothing.  Vectors of different lengths don't link.  Rows that repeat a vector
    link with each other; a row that repeats another's vec_id is a row of its own.  The smallest
    vec_id ignores nulls; a class without any has a null component_id.  An empty table gives no
    rows.  Other columns are ignored.

    Returns vec_id, n_links (other rows linked directly), component_id (the smallest vec_id
    reachable by links) and kept (whether they are equal, nulls alike).
    """
    rows = staged(_vectors(vectors), "vectors")
    items = (rows.where("item IS NOT NULL").groupBy("item")
             .agg(F.first("unit").alias("unit"), F.count("*").alias("weight"),
                  F.min("vec_id").alias("first"))
             .withColumn("dims", F.size("unit")))
    items = staged(items, "vector-items")
    dealt = items.groupBy("dims").agg(F.count("*").alias("n")).select(
        "dims", F.greatest(F.lit(LEAST_SHARDS), F.ceil(F.col("n") / SHARD_ROWS)).cast("int")
        .alias("n_shards"), F.greatest(
            F.least(F.lit(PARTS), F.ceil(F.col("n") / PART_ROWS)),
            F.ceil(F.col("n") / (4 * PART_ROWS))).cast("int").alias("n_parts"))
    dealt = items.join(small_side(staged(dealt, "vector-dims"), MAX_BROADCAST), "dims").withColumn(
        "shard", F.xxhash64("dims", F.pmod(F.xxhash64("item"), "n_shards")))
    found = near_vectors(staged(dealt, "vector-dealt"), similar, recall)
    roots = components(found.select(F.col("item").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("item").agg(F.sum("links").alias("links"))
    known = (items.select("item", "first", "weight").join(links, "item", "left")
             .join(roots, F.col("item") == F.col("node"), "left")
             .withColumn("root", F.coalesce("root", "item")))
    ids = known.groupBy("root").agg(F.min("first").alias("component_id"))
    verdict = known.join(ids, "root").select(
        "item", "component_id",
        (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    return (rows.select("vec_id", "item").join(verdict, "item", "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.when(F.col("item").isNull(), F.col("vec_id"))
                    .otherwise(F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id"))))
