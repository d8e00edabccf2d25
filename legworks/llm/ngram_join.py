"""Near-duplicate documents: n-gram Jaccard join by chosen paths."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legworks.llm.common import map_groups, map_rows, small_side, staged, text_or_empty
from legworks.llm.links import cells, components, open_pairs, summary

WORDS = 5                      # words of a shingle
SIMILAR = (4, 5)               # Jaccard similarity of links, as a fraction: 0.8
RECALL = 0.999                 # of a pair just at the threshold
DEPTH = 3                      # levels of splitting; larger buckets are then compared in blocks
SMALL = 2500                   # items of a bucket that is not split any more
CELL_ROWS, CELL_TOKENS = 1000, 1_000_000
BINS = 64                      # of the sketch
SIGMAS = 5.0                   # of a sketch's error by which a pair may miss the threshold
MAX_BROADCAST = 1_000_000
SEED = np.uint64(0x9E3779B97F4A7C15)

SIGNATURE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("digest", T.LongType()),
    T.StructField("item", T.LongType()), T.StructField("size", T.IntegerType()),
    T.StructField("sketch", T.BinaryType()),
    T.StructField("paths", T.ArrayType(T.LongType())),      # of the first level
    T.StructField("deeper", T.ArrayType(T.StructType([       # of the others
        T.StructField("level", T.IntegerType()), T.StructField("parent", T.LongType()),
        T.StructField("path", T.LongType())])))])


def runs_for(recall: float, depth: int) -> int:
    """Independent runs until a pair at the threshold is found with ``recall``.

    In each level a pair has one common child path in the mean at least, Poisson
    distributed; it survives ``depth`` levels with the chance below.
    """
    alive = 1.0
    for _ in range(depth):
        alive = 1 - math.exp(-alive)
    return math.ceil(math.log(1 - recall) / math.log(1 - alive))


def mixed(x: np.ndarray) -> np.ndarray:
    """64-bit finalizer: a bijection that scatters its input over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_known: dict[bytes, int] = {}


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of all runs of five words; of all words if they are fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").split()
    if not words:
        return np.zeros(0, np.uint64)
    if len(_known) > 100_000:
        _known.clear()
    hashes = np.empty(len(words), np.uint64)
    for i, w in enumerate(words):
        h = _known.get(w)
        if h is None:
            h = _known[w] = xxhash.xxh64_intdigest(w)
        hashes[i] = h
    n = min(WORDS, len(words))
    rolled = np.full(len(words) - n + 1, n, np.uint64)
    for i in range(n):
        rolled = rolled * np.uint64(0x100000001B3) + mixed(hashes[i:len(words) - n + 1 + i])
    return np.unique(mixed(rolled))


def item_of(tokens: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(tokens.tobytes()) - (1 << 63)


def sketch_of(tokens: np.ndarray) -> bytes:
    """One byte of the smallest hash in each of the bins, 0 for an empty bin."""
    out = np.zeros(BINS, np.uint8)
    if len(tokens):
        step = (1 << 64) // BINS
        at = np.searchsorted(tokens, np.arange(BINS, dtype=np.uint64) * np.uint64(step))
        full = at < np.append(at[1:], len(tokens))
        out[full] = (tokens[at[full]] % np.uint64(255) + np.uint64(1)).astype(np.uint8)
    return out.tobytes()


def chosen_paths(tokens: np.ndarray, runs: int, depth: int) -> list[tuple[list, list]]:
    """(parents, paths) of each level; the parents of the first level are the runs.

    Below every path, a token is chosen if its hash with the path is under
    1 / (0.8 * tokens): two similar sets agree on such a choice once in the mean.
    """
    n = len(tokens)
    if not n:
        return [([], [])] * depth
    limit = np.uint64(min(2 ** 64 - 1, int(2 ** 64 * SIMILAR[1] / (SIMILAR[0] * n))))
    level = mixed(np.arange(1, runs + 1, dtype=np.uint64) * SEED)
    out = []
    wide = max(1, 400_000 // n)   # paths at a time
    for _ in range(depth):
        found, above = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for lo in range(0, len(level), wide):
            h = mixed(tokens[None, :] ^ level[lo:lo + wide, None])
            row, col = np.nonzero(h < limit)
            found.append(mixed(h[row, col] + level[lo + row]))
            above.append(level[lo + row])
        level, above = np.concatenate(found), np.concatenate(above)
        out.append((above.view(np.int64).tolist(), level.view(np.int64).tolist()))
    return out


def signatures(docs: DataFrame, runs: int, depth: int) -> DataFrame:
    def per_batch(cols):
        out = {k: [] for k in SIGNATURE.names}
        out["doc_id"], out["digest"] = cols["doc_id"], cols["digest"]
        for text in cols["text"]:
            tokens = shingles(text)
            levels = chosen_paths(tokens, runs, depth)
            deeper = [{"level": k, "parent": a, "path": b}
                      for k, level in enumerate(levels[1:], 2)
                      for a, b in zip(*level, strict=True)]
            for k, v in (("item", item_of(tokens)), ("size", len(tokens)),
                         ("sketch", sketch_of(tokens)), ("paths", levels[0][1]),
                         ("deeper", deeper)):
                out[k].append(v)
        return out

    text = text_or_empty()
    return map_rows(docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("digest"),
                                text.alias("text")), per_batch, SIGNATURE)


def buckets(sets: DataFrame, depth: int) -> DataFrame:
    """(bucket, item, weight) of the paths at which splitting ends: those of small buckets, and
    those of the last level."""
    level = sets.select("item", "size", F.explode("paths").alias("path"))
    out = None
    for k in range(1, depth + 1):
        if k < depth:
            large = staged(level.groupBy("path").count().where(F.col("count") > SMALL)
                           .select("path"), "large")
            large = small_side(large, MAX_BROADCAST)
            done = level.join(large, "path", "left_anti")
            below = sets.select("item", "size", F.explode(F.filter(
                "deeper", _of_level(k + 1))).alias("p"))
            level = (below.select("item", "size", "p.parent", "p.path")
                     .join(large.withColumnRenamed("path", "parent"), "parent")
                     .select("item", "size", "path"))
        else:
            done = level
        done = done.select(F.col("path").alias("bucket"), "item", F.col("size").alias("weight"))
        out = done if out is None else out.union(done)
    return out


def _of_level(k: int):
    return lambda p: p["level"] == k


def _may_link(group: pa.Table) -> list[tuple]:
    """(cell, item) of the items that have a pair left by sizes and sketches."""
    todo = open_pairs(group)
    size = group.column("size").to_numpy().astype(np.int64)
    top, bottom = SIMILAR
    todo &= (size[:, None] * bottom >= size[None, :] * top) & (
        size[None, :] * bottom >= size[:, None] * top)
    rows = np.flatnonzero(todo.any(axis=1))
    if not len(rows):
        return []
    sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint8).reshape(
        -1, BINS)
    full = sketch > 0
    needed = np.zeros(len(size), bool)
    for i in rows:
        j = np.flatnonzero(todo[i])
        same = ((sketch[j] == sketch[i]) & full[i]).sum(axis=1)
        either = (full[j] | full[i]).sum(axis=1)
        p = top / bottom
        near = j[same >= p * either - SIGMAS * np.sqrt(p * (1 - p) * either)]
        if len(near):
            needed[i] = True
            needed[near] = True
    cell = group.column("cell")[0].as_py()
    items = group.column("item").to_pylist()
    return [(cell, items[k]) for k in np.flatnonzero(needed)]


def _links(group: pa.Table) -> list[tuple]:
    """Links of a cell by the whole sets: shared tokens counted on bit rows."""
    todo = open_pairs(group)
    if not todo.any():
        return []
    sets = [np.frombuffer(b, np.uint64) for b in group.column("tokens").to_pylist()]
    size = np.array([len(s) for s in sets], np.int64)
    top, bottom = SIMILAR
    n = len(sets)
    shared = np.zeros((n, n), np.int32)
    if n == 2:
        shared[0, 1] = len(np.intersect1d(sets[0], sets[1], assume_unique=True))
    else:
        tokens, code, count = np.unique(np.concatenate(sets), return_inverse=True,
                                        return_counts=True)
        order = np.cumsum(count > 1) - 1      # tokens in two sets or more are numbered
        row = np.repeat(np.arange(n), size)
        keep = count[code] > 1
        row, col = row[keep], order[code[keep]]
        for lo in range(0, int(order[-1]) + 1, 1 << 16):
            here = (col >= lo) & (col < lo + (1 << 16))
            width = min(1 << 16, int(order[-1]) + 1 - lo)
            dense = np.zeros((n, -(-width // 64) * 64), np.uint8)
            dense[row[here], col[here] - lo] = 1
            bits = np.packbits(dense, axis=1).view(np.uint64)
            for i in range(n - 1):
                shared[i, i + 1:] += np.bitwise_count(bits[i] & bits[i + 1:]).sum(
                    axis=1, dtype=np.int32)
    linked = todo & (shared * (top + bottom) >= (size[:, None] + size[None, :]) * top)
    return summary(group.column("item").to_pylist(), linked,
                   group.column("texts").to_numpy().astype(np.int64))


def classes(docs: DataFrame, recall: float = RECALL, depth: int = DEPTH) -> DataFrame:
    """A row per document: doc_id, digest (of the text), class_id, n_links, size (of the set)."""
    return _rooted(docs, recall, depth).drop("root")


def _rooted(docs: DataFrame, recall: float, depth: int) -> DataFrame:
    """``classes`` with the class's root, an item: ids may repeat or be null, roots tell apart."""
    runs = runs_for(recall, depth)
    signed = staged(signatures(docs, runs, depth), "signatures")
    rows = signed.select("doc_id", "digest", "item", "size")
    # the smallest id and the texts of each distinct set of shingles
    texts = (rows.where("size > 0").groupBy("item", "digest").agg(F.min("doc_id").alias("first"))
             .groupBy("item").agg(F.min("first").alias("first"),
                                  F.count("*").cast("int").alias("texts")))
    sets = staged(signed.where("size > 0").groupBy("item").agg(
        F.first("size").alias("size"), F.first("sketch").alias("sketch"),
        F.first("paths").alias("paths"), F.first("deeper").alias("deeper"))
        .join(texts, "item"), "sets")

    cell = staged(cells(buckets(sets, depth), CELL_ROWS, CELL_TOKENS), "cells")
    near = staged(map_groups(cell.join(sets.select("item", "size", "sketch"), "item"), "cell",
                             _may_link, T.StructType([T.StructField("cell", T.LongType()),
                                                      T.StructField("item", T.LongType())])),
                  "near")
    wanted = near.select("item").distinct().join(sets.select("item", "first"), "item")
    tokens = _tokens(docs, staged(wanted, "wanted"))
    found = staged(map_groups(
        cell.join(near, ["cell", "item"]).join(sets.select("item", "texts"), "item")
        .join(tokens, "item"), "cell", _links,
        T.StructType([T.StructField("item", T.LongType()), T.StructField("root", T.LongType()),
                      T.StructField("links", T.LongType())])), "links")

    roots = components(found.select(F.col("item").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("item").agg(F.sum("links").alias("links"))
    known = (sets.select("item", "first", "texts").join(links, "item", "left")
             .join(roots, F.col("item") == F.col("node"), "left")
             .withColumn("root", F.coalesce("root", "item")))
    ids = known.groupBy("root").agg(F.min("first").alias("class_id"))
    verdict = known.join(ids, "root").select(
        "item", "root", "class_id",
        (F.coalesce("links", F.lit(0)) + F.col("texts") - 1).alias("n_links"))
    return (rows.join(verdict, "item", "left")
            .select("doc_id", "digest",
                    F.when(F.col("size") > 0, F.col("class_id")).otherwise(F.col("doc_id"))
                    .alias("class_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "size", "root"))


def _tokens(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Whole shingle sets of the wanted items, from one document of each."""
    schema = T.StructType([T.StructField("item", T.LongType()),
                           T.StructField("tokens", T.BinaryType())])

    def per_batch(cols):
        out = {"item": [], "tokens": []}
        for item, text in zip(cols["item"], cols["text"], strict=True):
            tokens = shingles(text)
            if item_of(tokens) == item:  # another text may have the same id
                out["item"].append(item)
                out["tokens"].append(tokens.tobytes())
        return out

    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), text_or_empty().alias("text"))
    texts = rows.join(small_side(wanted, MAX_BROADCAST), F.col("doc").eqNullSafe(F.col("first")))
    return (map_rows(texts.select("item", "text"), per_batch, schema)
            .groupBy("item").agg(F.first("tokens").alias("tokens")))


def ngram_join(docs: DataFrame, recall: float = RECALL, depth: int = DEPTH) -> DataFrame:
    """Documents whose sets of five-word shingles have a Jaccard similarity of 0.8 or more.

    Chosen paths: in each of ``runs_for(recall, depth)`` runs, a set follows the
    tokens that a hash picks, about 1.25 a level; similar sets share a path once
    a level in the mean.  A path that few sets share is compared pair by pair; one that many
    share is split by further tokens, and after ``depth`` levels compared in
    blocks, so no group is too large for a task and none is cut.  A sketch
    first rules out pairs, the rest is decided on whole sets.  Equal sets are
    one item, so copies cost one row each; each pair is counted in one bucket only, and
    links leave a cell as counts and a spanning tree, never as pairs.

    Words part at ASCII white space.  A text of one to four words has one
    shingle of all its words.  Null texts and texts without words are linked to
    nothing, each a class of its own.  Rows with the same text are one text;
    repeated rows give repeated rows.  Sets and paths are 64-bit hashes.  An empty table
    gives no rows.  Columns other than doc_id and text are ignored.

    Returns doc_id, class_id (the smallest doc_id of its connected class) and n_links (other
    distinct texts that are similar or have the same shingles).
    """
    return classes(docs, recall, depth).select("doc_id", "class_id", "n_links")


def first_of_class(docs: DataFrame, recall: float = RECALL, depth: int = DEPTH) -> DataFrame:
    """The documents without those that a class has besides its first (the smallest doc_id, a
    null after all others; of several texts with that id, the smallest digest).

    Decisions go by (doc_id, digest of the text); rows that repeat both are one
    document, and one row of them stays.  Texts without words all stay.
    """
    verdict = staged(_rooted(docs, recall, depth), "classes").where("size > 0")
    keys = ["doc_id", "digest"]
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), *keys)
    first = verdict.groupBy("root").agg(F.min(place).alias("keep"))
    drop = staged(verdict.join(first, "root").where(place != F.col("keep"))
                  .select(*keys).distinct(), "drop")
    again = staged(verdict.groupBy(*keys).count().where("count > 1").select(*keys)
                   .join(drop, keys, "left_anti"), "again")
    mark = "_digest"
    while mark in [c.lower() for c in docs.columns]:
        mark += "_"
    tag = docs.withColumn(mark, F.xxhash64(text_or_empty()))

    def on(side: DataFrame):
        return (tag["doc_id"].cast("long").eqNullSafe(side["doc_id"])
                & (tag[mark] == side["digest"]))

    drop_side = small_side(drop, MAX_BROADCAST)
    kept = tag.join(drop_side, on(drop_side), "left_anti")
    if not again.isEmpty():
        again = small_side(again, MAX_BROADCAST)
        once = kept.join(again, on(again), "left_semi").dropDuplicates(["doc_id", mark])
        kept = kept.join(again, on(again), "left_anti").union(once)
    return kept.drop(mark)
