"""Hard negatives: Hilbert-ordered blocks of vectors, read as their zone maps allow."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from legworks.llm.common import small_side, staged

SCALE = 256                    # a component x counts as floor(SCALE * x)
LARGEST = 1 << 24              # of such a component, so that scores fit a long
BLOCK_ROWS, GROUP_ROWS, PAGE_ROWS = 256, 256, 512      # vectors, anchors, zone maps of a row
CURVE_DIMS, CURVE_BITS = 32, 4                         # dimensions of most spread, bits of each
POSITIVES, NEGATIVES = 5, 5
WINDOW = (4, 5)                # of the positive's score, as a fraction: the least negative score
MAX_BROADCAST = 512            # groups of anchors
NONE = np.iinfo(np.int64).min + 1      # no score; its negative is a long, too
HELD_GROUPS = 256              # groups whose best rows a task holds before it hands them on

LONG, INT, BIN = T.LongType(), T.IntegerType(), T.BinaryType()


def _schema(**kinds: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(k, v) for k, v in kinds.items()])


BLOCK = _schema(block=LONG, ids=BIN, has_id=BIN, labels=BIN, anchors=BIN, vectors=BIN, lo=BIN,
                hi=BIN, label_lo=LONG, label_hi=LONG)
ANCHOR = _schema(at=LONG, vec_id=LONG, label=LONG, vector=BIN, floor=LONG)
GROUP = _schema(group=LONG, at=BIN, ids=BIN, labels=BIN, vectors=BIN, floors=BIN)
PAGE = _schema(blocks=BIN, lo=BIN, hi=BIN, label_lo=BIN, label_hi=BIN)
PLAN = _schema(block=LONG, group=LONG, wanted=BIN)
WINDOWS = T.StructType([*GROUP, T.StructField("targets", BIN)])
BEST = _schema(group=LONG, anchor=INT, anchor_id=LONG, window=INT, score=LONG, vec_id=LONG,
               has_id=T.BooleanType(), at=LONG)


def _longs(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.int64)


def _batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    arrow = to_arrow_schema(schema)
    cols = list(zip(*rows, strict=True)) if rows else [()] * len(arrow)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)], schema=arrow)


def curve_keys(values: np.ndarray, bits: int) -> np.ndarray:
    """Place of each row of ``values`` (dimensions of ``bits`` bits) on the Hilbert curve, as rows of
    bytes that sort like the places.

    From the highest bit down, each dimension's bit tells how the rest of the cube is turned:
    the lower bits of the first dimension are flipped or swapped with the dimension's own.  The
    Gray code of what is left, its bits interleaved, is the place.
    """
    x = values.astype(np.int64).T.copy()
    for high in range(bits - 1, 0, -1):
        low = (1 << high) - 1
        for i in range(len(x)):
            up = (x[i] >> high & 1).astype(bool)
            swap = np.where(up, 0, (x[0] ^ x[i]) & low)
            x[0] ^= np.where(up, low, swap)
            x[i] ^= swap
    for i in range(1, len(x)):
        x[i] ^= x[i - 1]
    turn = np.zeros(x.shape[1], np.int64)
    for high in range(bits - 1, 0, -1):
        turn ^= np.where(x[-1] >> high & 1, (1 << high) - 1, 0)
    x ^= turn
    planes = [(x >> b & 1).astype(np.uint8) for b in range(bits - 1, -1, -1)]
    return np.packbits(np.concatenate(planes).T, axis=1)


def _whole(vectors: DataFrame, anchor: Column) -> DataFrame:
    """vec_id, label, vector (whole numbers) and is_anchor of the rows that take part."""
    x = F.col("embedding").cast("array<double>")
    sound = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    scaled = F.transform(x, lambda v: F.least(F.greatest(
        F.floor(F.least(F.greatest(v, F.lit(-1e12)), F.lit(1e12)) * SCALE), F.lit(-LARGEST)),
        F.lit(LARGEST)).cast("int"))
    return (vectors.where(F.col("label").isNotNull() & F.col("embedding").isNotNull() & sound)
            .select(F.col("vec_id").cast("long"), F.col("label").cast("long"),
                    scaled.alias("vector"), F.coalesce(anchor, F.lit(False)).alias("is_anchor")))


def _spread(rows: DataFrame) -> list:
    """(dim, lo, hi, variance) of each dimension: as many rows as a vector has components."""
    return (rows.select(F.posexplode("vector").alias("dim", "x")).groupBy("dim")
            .agg(F.min("x").alias("lo"), F.max("x").alias("hi"), F.var_pop("x").alias("var"))
            .collect())


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """A row for each vector; one that is shorter than others ends in zeros."""
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(lengths), dims), np.int32)
    row = np.repeat(np.arange(len(lengths)), lengths)
    start = np.cumsum(lengths) - lengths
    out[row, np.arange(len(flat)) - np.repeat(start, lengths)] = flat
    return out


def _block_rows(dims: int) -> Callable:
    """Packs sorted rows into blocks with their zone maps."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, part, held = 0, TaskContext.get().partitionId(), []

        def packed(table: pa.Table) -> pa.RecordBatch:
            nonlocal seq
            table = table.combine_chunks()
            x = _matrix(table.column("vector").chunk(0), dims)
            ids, labels = table.column("vec_id"), table.column("label").to_numpy()
            row = (part << 24 | seq, ids.fill_null(0).to_numpy().tobytes(),
                   ids.is_valid().to_numpy().tobytes(), labels.tobytes(),
                   table.column("is_anchor").to_numpy().tobytes(), x.tobytes(),
                   x.min(axis=0).tobytes(), x.max(axis=0).tobytes(), int(labels.min()),
                   int(labels.max()))
            seq += 1
            return _batch([row], BLOCK)

        for batch in batches:
            if batch.num_rows:
                held.append(pa.Table.from_batches([batch]))
            while sum(t.num_rows for t in held) >= BLOCK_ROWS:
                table = pa.concat_tables(held)
                yield packed(table.slice(0, BLOCK_ROWS))
                held = [table.slice(BLOCK_ROWS)] if table.num_rows > BLOCK_ROWS else []
        if held:
            yield packed(pa.concat_tables(held))

    return run


def write_blocks(rows: DataFrame, dims: int, spread: list) -> DataFrame:
    """The rows in Hilbert order, cut into blocks that carry per-dimension least and largest values.

    Written as Parquet in the shared scratch folder: a row is a block.  Rows on the same
    place of the curve are parted by vec_id, so equal vectors fill as many blocks as they need.
    """
    used = sorted(sorted(spread, key=lambda r: (-r["var"], r["dim"]))[:CURVE_DIMS],
                  key=lambda r: r["dim"])
    at = np.array([r["dim"] for r in used], np.int64)
    lo = np.array([r["lo"] for r in used], np.int64)
    width = np.array([r["hi"] - r["lo"] + 1 for r in used], np.int64)
    schema = T.StructType([*rows.schema.fields, T.StructField("place", BIN)])
    arrow = to_arrow_schema(schema)

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("vector"), dims)[:, at].astype(np.int64)
            cell = np.clip(((x - lo) << CURVE_BITS) // width, 0, (1 << CURVE_BITS) - 1)
            keys = [k.tobytes() for k in curve_keys(cell, CURVE_BITS)] if len(at) else (
                [b""] * len(x))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(keys, pa.binary())],
                                             schema=arrow)

    order = ["place", "vec_id", "label", "vector"]
    return staged(rows.mapInArrow(placed, schema).repartitionByRange(*order)
                  .sortWithinPartitions(*order).drop("place")
                  .mapInArrow(_block_rows(dims), BLOCK), "hn-blocks")


class _Block:
    """A block's arrays; its rows stand in the order of their ids, rows without one last."""

    def __init__(self, row: dict, dims: int):
        self.has_id = np.frombuffer(row["has_id"], bool)
        self.anchors = np.frombuffer(row["anchors"], bool)
        self.ids, self.labels = _longs(row["ids"]), _longs(row["labels"])
        self.x = np.frombuffer(row["vectors"], np.int32).reshape(-1, dims)
        self.at = row["block"] * BLOCK_ROWS + np.arange(len(self.x))
        self.order = np.lexsort((self.at, self.ids, ~self.has_id))
        for name in ("has_id", "anchors", "ids", "labels", "x", "at"):
            setattr(self, name, getattr(self, name)[self.order])


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows: by floating point where that holds them."""
    if not a.size or not b.size:
        return np.zeros((len(a), len(b)), np.int64)
    top = int(np.abs(a.astype(np.int64)).max()) * int(np.abs(b.astype(np.int64)).max())
    if top * a.shape[1] < 1 << 53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(a: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interval arithmetic: least and largest score of each row of ``a`` in each zone."""
    up, down = np.maximum(a, 0), np.minimum(a, 0)
    return scores(up, lo) + scores(down, hi), scores(up, hi) + scores(down, lo)


def _anchors(blocks: DataFrame, dims: int, positives: int) -> DataFrame:
    """The anchors with their place, and the score that their own block's positives reach at least."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block, out = _Block(row, dims), []
                wanted = np.flatnonzero(block.anchors)
                s = scores(block.x[wanted], block.x)
                for k, i in enumerate(wanted.tolist()):
                    same = block.labels == block.labels[i]
                    same[i] = False
                    best = np.sort(s[k][same])[::-1]
                    floor = int(best[positives - 1]) if len(best) >= positives else NONE
                    out.append((int(block.at[i]), int(block.ids[i]), int(block.labels[i]),
                                block.x[i].tobytes(), floor))
                yield _batch(out, ANCHOR)

    return blocks.mapInArrow(run, ANCHOR)


def _groups(anchors: DataFrame) -> DataFrame:
    """Anchors that are near on the curve, ``GROUP_ROWS`` to a row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, part, held = 0, TaskContext.get().partitionId(), []

        def packed(rows: list[dict]) -> pa.RecordBatch:
            nonlocal seq
            longs = [np.array([r[k] for r in rows], np.int64).tobytes()
                     for k in ("at", "vec_id", "label", "floor")]
            seq += 1
            return _batch([(part << 24 | seq, *longs[:3], b"".join(r["vector"] for r in rows),
                            longs[3])], GROUP)

        for batch in batches:
            held += batch.to_pylist()
            while len(held) >= GROUP_ROWS:
                yield packed(held[:GROUP_ROWS])
                held = held[GROUP_ROWS:]
        if held:
            yield packed(held)

    return staged(anchors.repartitionByRange("at").sortWithinPartitions("at")
                  .mapInArrow(run, GROUP), "hn-groups")


def _pages(blocks: DataFrame) -> DataFrame:
    """The zone maps of all blocks, at most ``PAGE_ROWS`` to a row, in the order of the curve."""
    within = F.floor(F.col("block").bitwiseAND((1 << 24) - 1) / PAGE_ROWS)
    zones = (blocks.groupBy(F.shiftright("block", 24), within)
             .agg(F.sort_array(F.collect_list(F.struct("block", "lo", "hi", "label_lo", "label_hi")))
                  .alias("zones")).select("zones"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for zones in batch.column("zones").to_pylist():
                longs = [np.array([z[k] for z in zones], np.int64).tobytes()
                         for k in ("block", "label_lo", "label_hi")]
                out.append((longs[0], b"".join(z["lo"] for z in zones),
                            b"".join(z["hi"] for z in zones), *longs[1:]))
            yield _batch(out, PAGE)

    return staged(zones.mapInArrow(run, PAGE), "hn-pages")


def _plan(groups: DataFrame, pages: DataFrame, dims: int, wants: Callable) -> DataFrame:
    """block, group and the anchors of the group (row numbers) whose windows must read the block.

    ``wants``: matrix of anchors and zones from the group's row, the bounds and label ranges.
    Every group of anchors meets every page of zone maps, none of the rows themselves.
    """
    n = max(1, pages.count())
    met = (groups.withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
           .join(pages.withColumn("slot", F.pmod(F.xxhash64("blocks"), F.lit(n)).cast("int")),
                 "slot").drop("slot"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                lo, hi = (np.frombuffer(row[k], np.int32).reshape(-1, dims) for k in ("lo", "hi"))
                x = np.frombuffer(row["vectors"], np.int32).reshape(-1, dims)
                need = wants(row, *bounds(x, lo, hi), _longs(row["label_lo"]),
                             _longs(row["label_hi"]))
                yield _batch([(b, row["group"], np.flatnonzero(need[:, k]).astype(
                    np.int32).tobytes()) for k, b in enumerate(_longs(row["blocks"]).tolist())
                    if need[:, k].any()], PLAN)

    return met.mapInArrow(run, PLAN)


class _Best:
    """The best rows of each anchor and window of a group, of all blocks met so far."""

    def __init__(self, names: np.ndarray, windows: int, keep: int):
        shape = len(names), windows, keep
        self.names = names.tolist()
        self.keep, self.score = keep, np.full(shape, NONE, np.int64)
        self.ids, self.at = np.zeros(shape, np.int64), np.zeros(shape, np.int64)
        self.no_id = np.zeros(shape, bool)

    def add(self, rows: np.ndarray, w: int, s: np.ndarray, block: _Block) -> None:
        """``s``: scores of the anchors ``rows`` with the block's rows, ``NONE`` for those outside."""
        # the best of the block; its rows are in the order of ties
        k = min(self.keep, s.shape[1])
        top = np.argsort(-s, axis=1, kind="stable")[:, :k]
        new = {"score": np.take_along_axis(s, top, axis=1), "ids": block.ids[top],
               "at": block.at[top], "no_id": ~block.has_id[top]}
        both = {n: np.concatenate([getattr(self, n)[rows, w], v], axis=1) for n, v in new.items()}
        order = np.lexsort((both["at"], both["ids"], both["no_id"], -both["score"]), axis=1)
        for n, v in both.items():
            getattr(self, n)[rows, w] = np.take_along_axis(v, order[:, :self.keep], axis=1)

    def rows(self, group: int) -> list[tuple]:
        return [(group, a, self.names[a], w, int(self.score[a, w, k]), int(self.ids[a, w, k]),
                 not self.no_id[a, w, k], int(self.at[a, w, k]))
                for a, w, k in np.argwhere(self.score > NONE).tolist()]


def _read(plan: DataFrame, groups: DataFrame, blocks: DataFrame, dims: int, windows: int,
          keep: int, inside: Callable) -> DataFrame:
    """The best rows of each anchor's windows over the planned blocks: group, anchor, window,
    rank, score, vec_id and at.  ``inside``: masks, one per window, of a group's wanted anchors and a
    block's rows, from the group's row, the anchors, the scores and the block."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, _Best] = {}
        for batch in batches:
            for row in batch.to_pylist():
                best = held.get(row["group"])
                if best is None:
                    if len(held) >= HELD_GROUPS:
                        yield _batch([x for g, b in held.items() for x in b.rows(g)], BEST)
                        held.clear()
                    best = held[row["group"]] = _Best(_longs(row["own_ids"]), windows,
                                                               keep)
                block = _Block(row, dims)
                who = np.frombuffer(row["wanted"], np.int32)
                x = np.frombuffer(row["own"], np.int32).reshape(-1, dims)[who]
                s = scores(x, block.x)
                for w, mask in enumerate(inside(row, who, s, block)):
                    some = np.flatnonzero(mask.any(axis=1))
                    if len(some):
                        best.add(who[some], w, np.where(mask[some], s[some], NONE), block)
        yield _batch([x for g, b in held.items() for x in b.rows(g)], BEST)

    own = groups.withColumnsRenamed({"vectors": "own", "ids": "own_ids", "at": "own_at",
                                     "labels": "own_labels"})
    found = (plan.join(blocks, "block").join(small_side(own, MAX_BROADCAST), "group")
             .mapInArrow(run, BEST))
    order = [F.col("score").desc(), F.col("has_id").desc(), F.col("vec_id"), F.col("at")]
    place = F.row_number().over(Window.partitionBy("group", "anchor", "window").orderBy(*order))
    return found.withColumn("rank", place).where(F.col("rank") <= keep).withColumn(
        "vec_id", F.when(F.col("has_id"), F.col("vec_id"))).drop("has_id")


def _with_targets(groups: DataFrame, found: DataFrame, positives: int) -> DataFrame:
    """The groups with the scores of their anchors' positives, ``NONE`` where there are fewer."""
    listed = found.groupBy("group").agg(F.collect_list(F.struct("anchor", "rank", "score"))
                                        .alias("listed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                p = np.full((len(_longs(row["ids"])), positives), NONE, np.int64)
                for r in row["listed"]:
                    p[r["anchor"], r["rank"] - 1] = r["score"]
                out.append((*[row[f.name] for f in GROUP], p.tobytes()))
            yield _batch(out, WINDOWS)

    return staged(groups.join(listed, "group").mapInArrow(run, WINDOWS), "hn-windows")


def hard_negatives(vectors: DataFrame, anchor: Column, positives: int = POSITIVES,
                   negatives: int = NEGATIVES, window: tuple[int, int] = WINDOW) -> DataFrame:
    """For each anchor and each of its positives, the best rows of other labels whose score lies
    in the window below the positive's.

    ``vectors``: vec_id, embedding, label; ``anchor``: a condition on them.  Scores
    are inner products of floor(256 * x); positives are the best other rows of the anchor's label,
    ties by the smaller vec_id.  A negative has another label and a score from ``window``
    (4 / 5) of the positive's up to the positive's.

    Rows are written as blocks in the order of a Hilbert curve, each with its least and largest
    value per dimension and of the label.  Interval arithmetic on these zone maps bounds an anchor's
    scores in a block; the anchor reads the blocks that may hold a positive as good as
    those of its own block, then those that may hold a row of a window.  A task keeps the best rows
    of an anchor and hands on no more; which blocks it reads never changes the result.  Bounds
    tell little on vectors without any structure: nearly all blocks are then read.

    Rows with a null label, a null vector or a null or non-finite component take no part.  A
    component counts as 2^24 at most, so that scores fit a long.  A shorter vector ends in
    zeros.  Repeated rows are rows of their own, as anchors, too; a row with a null vec_id comes
    after those with one at equal scores and is no anchor unless the condition says so.  A hot label
    or vector fills many blocks.  An empty table, or one without anchors, gives no rows.  Other
    columns are ignored.

    Returns anchor_id, positive_id, rank (from 1), negative_id, positive_score and negative_score.
    """
    rows = staged(_whole(vectors, anchor), "hn-rows")
    spread = _spread(rows)
    dims = max(1, len(spread))
    blocks = write_blocks(rows, dims, spread)
    pages = _pages(blocks)
    groups = _groups(_anchors(blocks, dims, positives))

    def as_good(row, least, most, label_lo, label_hi):
        labels, floor = _longs(row["labels"])[:, None], _longs(row["floors"])[:, None]
        return (most >= floor) & (label_lo <= labels) & (labels <= label_hi)

    def same_label(row, who, s, block):
        mask = block.labels == _longs(row["own_labels"])[who][:, None]
        return [mask & (block.at != _longs(row["own_at"])[who][:, None])]

    found = staged(_read(_plan(groups, pages, dims, as_good), groups, blocks, dims, 1, positives,
                         same_label), "hn-positives")

    top, bottom = window
    asked = _with_targets(groups, found, positives)

    def may_hold(row, least, most, label_lo, label_hi):
        labels = _longs(row["labels"])
        p = _longs(row["targets"]).reshape(len(labels), 1, positives)
        known = p > NONE
        hit = known & (most[:, :, None] * bottom >= np.where(known, p, 0) * top) & (
            least[:, :, None] <= p)
        other = (label_lo != labels[:, None]) | (label_hi != labels[:, None])
        return hit.any(axis=2) & other

    def in_window(row, who, s, block):
        p = _longs(row["targets"]).reshape(-1, positives)[who]
        other = block.labels != _longs(row["own_labels"])[who][:, None]
        for w in range(positives):
            t = p[:, w, None]
            known = t > NONE
            yield known & other & (s <= t) & (s * bottom >= np.where(known, t, 0) * top)

    best = staged(_read(_plan(asked, pages, dims, may_hold), asked, blocks, dims, positives,
                        negatives, in_window), "hn-negatives")
    pairs = found.select("group", "anchor", (F.col("rank") - 1).alias("window"),
                         F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    return (best.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
            .join(pairs, ["group", "anchor", "window"])
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                    "negative_score"))
