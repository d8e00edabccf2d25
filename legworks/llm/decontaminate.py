"""Benchmark decontamination by Wu-Manber multi-pattern search over words."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterable
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legworks.llm.common import map_rows, staged

WINDOW = 13
MIN_HIT_PERCENT = 5            # contaminated: 20 * n_hit >= n_words
# Benchmark text that one search table may hold.  A table takes some hundred bytes for each byte of
# text, so this is about 200 MB in each Python worker.
PATTERN_BYTES = 2_000_000

# bytes below 0x80 that are no letter or digit part words; A-Z become a-z
_KEEP = frozenset(b"0123456789abcdefghijklmnopqrstuvwxyz")
_FOLD = bytes(c if c >= 0x80 or c in _KEEP else c + 32 if 65 <= c <= 90 else 32
              for c in range(256))

HITS = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("row", T.LongType()),
    T.StructField("n_words", T.LongType()),
    T.StructField("hits", T.ArrayType(T.IntegerType())),
    T.StructField("items", T.ArrayType(T.StringType()))])
VERDICT = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()), T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType())])


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()


class WuManber:
    """Patterns of one length, in words; blocks of two words (one for single words).

    ``shift`` maps a block to the distance to its last place in any pattern;
    blocks that no pattern has skip ``length - block + 1`` words.  At distance 0
    the hash of the last block picks a bucket of patterns, which are compared.
    """

    def __init__(self, length: int):
        self.length, self.block = length, min(2, length)
        self.shift: dict[tuple, int] = {}
        self.bucket: dict[tuple, dict[tuple, list[str]]] = {}

    def add(self, pattern: tuple[bytes, ...], item: str) -> None:
        b = self.block
        for end in range(b, self.length + 1):
            block = pattern[end - b:end]
            self.shift[block] = min(self.length - end, self.shift.get(block, self.length))
        items = self.bucket.setdefault(pattern[-b:], {}).setdefault(pattern, [])
        if item not in items:
            items.append(item)

    def search(self, words: list[bytes]) -> Iterable[tuple[int, list[str]]]:
        """Start and items of each occurrence."""
        length, b, shift, bucket = self.length, self.block, self.shift, self.bucket
        skip, at, n = length - b + 1, length, len(words)
        while at <= n:
            block = tuple(words[at - b:at])
            step = shift.get(block, skip)
            if step:
                at += step
                continue
            window = tuple(words[at - length:at])
            items = bucket[block].get(window)
            if items:
                yield at - length, items
            at += 1


def tables(items: Iterable[tuple[str, str | None]]) -> list[WuManber]:
    """Search tables of all windows; an item of fewer words is one window of its own length."""
    by_length: dict[int, WuManber] = {}
    for item, text in items:
        words = words_of(text)
        length = min(WINDOW, len(words))
        if length:
            table = by_length.setdefault(length, WuManber(length))
            for i in range(len(words) - length + 1):
                table.add(tuple(words[i:i + length]), item)
    return list(by_length.values())


def merge(spans: Iterable[tuple[int, int]]) -> list[int]:
    """Disjoint runs that cover the spans: start, end, start, end, ..."""
    runs: list[int] = []
    for start, end in sorted(spans):
        if runs and start <= runs[-1]:
            runs[-1] = max(runs[-1], end)
        else:
            runs += [start, end]
    return runs


def find(search: list[WuManber], text: str | None) -> tuple[int, list[int], list[str]]:
    """Words of ``text``, runs of hit words (start, end, start, end, ...), items found."""
    words, spans, items = words_of(text), [], set()
    for table in search:
        for start, found in table.search(words):
            spans.append((start, start + table.length))
            items.update(found)
    return len(words), merge(spans), sorted(items)


def block_count(benchmark: DataFrame, max_bytes: int) -> int:
    """Blocks that the benchmark's items are dealt into: one if their texts hold ``max_bytes`` at
    most, else so many that a block holds half of that in the mean."""
    total = benchmark.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    return 1 if total <= max_bytes else math.ceil(2 * total / max_bytes)


def pattern_block(benchmark: DataFrame, n: int, block: int) -> list[tuple[str, str]]:
    """The distinct items of a block: those whose hash says so.  A block is all of the benchmark that
    is in the driver, or in an executor, at a time."""
    rows = benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"),
                            F.col("text").cast("string").alias("text")).distinct()
    if n > 1:
        rows = rows.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block)
    return [(r["item"], r["text"]) for r in rows.collect()]


def _search(docs: DataFrame, shared) -> DataFrame:
    """Hits of one block of items (broadcast), with the columns of ``HITS``."""
    built: list = []

    def per_batch(cols):
        if not built:
            built.append(tables(shared.value))
        rows = [find(built[0], t) for t in cols["text"]]
        return {"doc_id": cols["doc_id"], "row": cols["row"], "n_words": [r[0] for r in rows],
                "hits": [r[1] for r in rows], "items": [r[2] for r in rows]}

    return map_rows(docs, per_batch, HITS)


def _verdicts(cols: dict[str, list]) -> dict[str, list]:
    out: dict[str, list] = {k: [] for k in VERDICT.names}
    for doc, n, runs, items in zip(cols["doc_id"], cols["n_words"], cols["hits"], cols["items"],
                                   strict=True):
        merged = merge(zip(runs[::2], runs[1::2], strict=True))
        hit = sum(merged[1::2]) - sum(merged[::2])
        items = sorted(set(items))
        digest = hashlib.sha256(",".join(items).encode()).hexdigest()
        for k, v in zip(VERDICT.names, (doc, n, hit, len(items), digest,
                                        hit > 0 and 100 * hit >= MIN_HIT_PERCENT * n),
                        strict=True):
            out[k].append(v)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame,
                  max_pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """Words of each document that lie in a benchmark window, and the items they are from.

    One scan of the documents without a shuffle while the benchmark fits into one
    search table (``max_pattern_bytes`` of text).  A larger benchmark is dealt into blocks
    by hash; they are searched one after the other, a scan for each, and the hits of a
    document are gathered by row.  No more than a block leaves Spark at a time.

    Null and empty texts have no words and are clean.  Items that occur more than
    once count once; a null item_id is the empty string; items without words
    match nothing.  Very long texts are searched whole.  Repeated documents give repeated rows.  Empty tables: no
    documents give no rows, no benchmark gives no hits.  Columns other than
    doc_id, text and item_id are ignored.

    Returns doc_id, n_words, n_hit, n_items, items_sha256, contaminated.
    """
    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"),
                       F.monotonically_increasing_id().alias("row"))
    n, context = block_count(benchmark, max_pattern_bytes), docs.sparkSession.sparkContext
    if n == 1:
        found = _search(rows, context.broadcast(pattern_block(benchmark, 1, 0)))
        return map_rows(found, _verdicts, VERDICT)
    rows = staged(rows, "decontaminate-rows")  # the same row numbers in each scan
    parts = []
    for block in range(n):
        shared = context.broadcast(pattern_block(benchmark, n, block))
        hits = _search(rows, shared)
        # the first scan has a row of every document, the others those with hits
        parts.append(staged(hits if not block else hits.where(F.size("hits") > 0),
                            "decontaminate-hits"))
        shared.destroy()
    found = reduce(DataFrame.union, parts).groupBy("row").agg(
        F.first("doc_id").alias("doc_id"), F.first("n_words").alias("n_words"),
        F.flatten(F.collect_list("hits")).alias("hits"),
        F.flatten(F.collect_list("items")).alias("items"))
    return map_rows(found, _verdicts, VERDICT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame,
                      max_pattern_bytes: int = PATTERN_BYTES) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Null and empty texts stay, as do repeats of clean documents; an empty table stays empty, and
    without a benchmark all documents stay.  A filter on the scan with one search table; with more, the documents are staged with
    row numbers and filtered by the verdicts.
    """
    if block_count(benchmark, max_pattern_bytes) == 1:
        shared = docs.sparkSession.sparkContext.broadcast(pattern_block(benchmark, 1, 0))
        built: list = []

        @F.pandas_udf("boolean")
        def contaminated(texts: pd.Series) -> pd.Series:
            if not built:
                built.append(tables(shared.value))
            found = [find(built[0], t) for t in texts]
            return pd.Series(_verdicts({
                "doc_id": [None] * len(found), "n_words": [f[0] for f in found],
                "hits": [f[1] for f in found], "items": [f[2] for f in found]})["contaminated"],
                dtype=bool)

        return docs.where(~contaminated(F.col("text").cast("string")))
    rows = staged(docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                              F.monotonically_increasing_id().alias("doc_id"), "text"),
                  "decontaminate-docs")
    keep = decontaminate(rows, benchmark, max_pattern_bytes).where(~F.col("contaminated"))
    return rows.join(keep.select("doc_id"), "doc_id").select(
        *[F.col(f"doc.`{c}`").alias(c) for c in docs.columns])
