"""Near-duplicate lines by a segment-partition edit join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from legworks.llm.common import map_groups, small_side, staged, text_or_empty
from legworks.llm.links import cells, components, open_pairs, summary
from legworks.llm.ngram_join import mixed

# Edits of code points within which lines are near duplicates, by the length of the longer one;
# shorter lines are near duplicates if they are equal.
BOUNDS = ((8, 1), (16, 2), (64, 3), (256, 4))
CELL_ROWS, CELL_CHARS = 500, 500_000
MAX_BROADCAST = 1_000_000
HASH_SEED = 42             # that of Spark's xxhash64()
LONG = 4096                # code points up to which a line's places of a character are one number
CLASSES = 64               # of characters, in the counts that rule out pairs
FILTER_PAGES = 1 << 13     # of 4 KB, of a filter: 32 MB in each worker, whatever the table's size
PAGES_AT_ONCE = 128        # that come to the driver in one piece, 2 MB of two filters
SEEN_LINES = 100_000       # line ids by which a task leaves out repeats
SPACES = " \t\n\x0b\x0c\r"    # a line of these alone has no word
SLICE_CHARS = 1 << 18      # code points of lines that are hashed together
BASE = np.uint64(0x9E3779B97F4A7C15 | 1)

KEYS = T.StructType([T.StructField("bucket", T.LongType()), T.StructField("item", T.LongType()),
                     T.StructField("chars", T.IntegerType())])


def bound(length: int, bounds: tuple = BOUNDS) -> int:
    """Edits within which two lines are near duplicates, by the length of the longer one."""
    return max((edits for least, edits in bounds if length >= least), default=0)


def segments(length: int, edits: int) -> list[tuple[int, int]]:
    """Start and length of the edits + 1 even segments of a line; the last are the longer ones."""
    k = edits + 1
    short, longer = length // k, length % k
    out, at = [], 0
    for i in range(k):
        n = short + (i >= k - longer)
        out.append((at, n))
        at += n
    return out


def probes(length: int, edits: int) -> list[tuple[int, int, int, int, bool]]:
    """What a line of ``length`` looks up: (length of the other line, segment, start, size, own).

    Another line of at most this length, within ``edits``, has a segment that occurs
    here unchanged, shifted by less than the edits on its left and, counted from
    the end, on its right.  ``own`` marks the line's own segments, its index entries.
    """
    out = []
    for gap in range(edits + 1):
        if length - gap < edits + 1:
            break
        for i, (at, n) in enumerate(segments(length - gap, edits)):
            low = max(at - i, at + gap - (edits - i), 0)
            high = min(at + i, at + gap + (edits - i), length - n)
            out += [(length - gap, i, p, n, gap == 0 and p == at) for p in range(low, high + 1)]
    return out


def within(a: str, b: str, edits: int) -> bool:
    """Whether the edit distance of ``a`` and ``b`` is at most ``edits``.

    Bit-parallel over the band of 2 * edits + 1 diagonals: a column's vertical
    differences are two words of a bit per row, which slide down by a row a column.
    """
    start, n, m = 0, len(a), len(b)
    if abs(n - m) > edits:
        return False
    while start < min(n, m) and a[start] == b[start]:
        start += 1
    while n > start and m > start and a[n - 1] == b[m - 1]:
        n, m = n - 1, m - 1
    a, b = a[start:n], b[start:m]
    n, m = len(a), len(b)
    if min(n, m) == 0:
        return max(n, m) <= edits
    if n <= edits or m <= edits:
        row = list(range(m + 1))
        for i, x in enumerate(a, 1):
            diagonal, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
        return row[m] <= edits
    places: dict[str, int] = {}
    for i, x in enumerate(a[:LONG]):
        places[x] = places.get(x, 0) | 1 << i
    width = 2 * edits + 1
    mask = (1 << width) - 1
    up, down = (mask << edits) & mask, 0
    distance = edits                     # of the band's lowest row in column 0
    for j, y in enumerate(b, 1):
        at = j - edits - 1               # position in a of the band's first row
        if n <= LONG:
            equal = places.get(y, 0)
            equal = (equal >> at if at >= 0 else equal << -at) & mask
        else:                            # of long lines, only the band is looked at
            equal = sum(1 << k for k in range(max(0, -at), min(width, n - at)) if a[at + k] == y)
        same = equal | down
        diagonal = (((up + (same & up)) ^ up) | same) & mask
        right_up = (down | ~(diagonal | up)) & mask
        right_down = up & diagonal
        if j + edits <= n:
            distance += not diagonal >> 2 * edits & 1
        else:
            last = n - j + edits         # the row of a's last character
            distance += (right_up >> last & 1) - (right_down >> last & 1)
        up = (right_down | ~(diagonal >> 1 | right_up)) & mask
        down = diagonal >> 1 & right_up
    return distance <= edits


def lookups(length: int, bounds: tuple = BOUNDS) -> list[tuple[int, int, int, bool]]:
    """(seed, start, size, own) of the segments of a line: its index entries (own) and probes.

    Probes are those of the line's own bound.  A line just under a length from which the bound grows
    is also indexed by the segments of the larger bound, by which longer lines look it up.
    """
    edits, out = bound(length, bounds), []
    for few in sorted({bound(n, bounds) for n in range(length, length + bounds[-1][1] + 1)}):
        # a longer line with that bound is in reach
        if few and any(bound(n, bounds) == few for n in range(length, length + few + 1)):
            out += [(other << 16 | few << 8 | i, p, size, own)
                    for other, i, p, size, own in probes(length, few) if own or few == edits]
    return out


def code_points(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the base and of its inverse, modulo 2^64."""
    inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
    out = []
    for x in (BASE, inverse):
        steps = np.full(n, x, np.uint64)
        steps[:1] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


class KeyMaker:
    """Hashes of the looked-up substrings of many lines at a time.

    With running sums of code point hashes times powers of an odd base, a substring's hash is a
    difference of two sums, shifted to its start by the inverse power.
    """

    def __init__(self, bounds: tuple, own: bool):
        self.bounds, self.own, self.plans = bounds, own, {}
        self.up, self.down = _powers(0)
        self.hashes = mixed(np.arange(1 << 16, dtype=np.uint64) + BASE)

    def plan(self, length: int) -> tuple[np.ndarray, ...]:
        """Seeds, starts and ends of a line's index entries (``own``) or of its probes."""
        if length not in self.plans:
            if len(self.plans) > 10_000:
                self.plans.clear()
            rows = [x[:3] for x in lookups(length, self.bounds) if x[3] == self.own]
            seed, start, size = np.array(rows, np.int64).reshape(-1, 3).T
            self.plans[length] = mixed(seed.astype(np.uint64) + np.uint64(1)), start, start + size
        return self.plans[length]

    def keys(self, lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(line numbers, hashes) of all lines."""
        points = code_points("".join(lines))
        if len(self.up) < len(points) + 1:
            self.up, self.down = _powers(len(points) + 1)
        if len(points) and points.max() >= len(self.hashes):
            h = mixed(points.astype(np.uint64) + BASE)
        else:
            h = self.hashes[points]
        h *= self.up[:len(points)]
        sums = np.zeros(len(points) + 1, np.uint64)
        np.cumsum(h, out=sums[1:])
        lengths = np.array([len(x) for x in lines])
        # the plan of each length once, and of each line the rows of its length's plan
        sizes, size_of = np.unique(lengths, return_inverse=True)
        plans = [self.plan(n) for n in sizes.tolist()]
        seeds, starts, ends = (np.concatenate(x) for x in zip(*plans, strict=True))
        planned = np.array([len(x[0]) for x in plans])
        counts = planned[size_of]
        who = np.repeat(np.arange(len(lines)), counts)
        ahead = (np.cumsum(planned) - planned)[size_of] - (np.cumsum(counts) - counts)
        row = ahead[who] + np.arange(len(who))
        at = (np.cumsum(lengths) - lengths)[who]
        first = at + starts[row]
        part = (sums[at + ends[row]] - sums[first]) * self.down[first]
        return who, part ^ seeds[row]


def buckets(h: np.ndarray) -> np.ndarray:
    """Names of hashes' buckets, a bijection whose upper bits place them in the filters."""
    return (h * BASE).view(np.int64)


def places(bucket: np.ndarray, pages: int) -> np.ndarray:
    """Where buckets lie in filters of that many pages: a page, and two bits of its 2^15."""
    x = bucket.view(np.uint64)
    page = (x >> np.uint64(50)) % np.uint64(pages)
    return (page << np.uint64(30) | x >> np.uint64(19) & np.uint64((1 << 30) - 1)).view(np.int64)


def slots(h: np.ndarray) -> np.ndarray:
    """Where hashes lie in the filters."""
    return places(buckets(h), FILTER_PAGES)


def slot_of(bucket: str) -> Column:
    """As ``places``, of a column."""
    page = F.shiftrightunsigned(bucket, 50) % F.lit(FILTER_PAGES).cast("long")
    return F.shiftleft(page, 30).bitwiseOR(
        F.shiftrightunsigned(bucket, 19).bitwiseAND(F.lit((1 << 30) - 1).cast("long")))


def in_filter(bits: np.ndarray, slot: np.ndarray) -> np.ndarray:
    def is_set(slot: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (bits[(slot >> 30 << 12) + (at >> 3)] >> (at & 7).astype(np.uint8) & 1).astype(bool)

    # few have the first bit, so the second is looked up for those only
    left = np.flatnonzero(is_set(slot, slot >> 15 & 32_767))
    rest = slot[left]
    out = np.zeros(len(slot), bool)
    out[left[is_set(rest, rest & 32_767)]] = True
    return out


def _keys_of(docs: DataFrame, bounds: tuple, own: bool, pick) -> DataFrame:
    """bucket, item and chars of the keys of all lines that ``pick`` (buckets as an array) keeps.

    Lines are made distinct before they get keys, as far as a task's memory of ids goes.
    """
    least = bounds[0][0] - bounds[0][1]
    arrow = to_arrow_schema(KEYS)
    hash_of = xxhash.xxh64_intdigest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        maker, seen = KeyMaker(bounds, own), set()
        lines, items, held = [], [], 0

        def made() -> pa.RecordBatch:
            item = np.array(items, np.uint64).view(np.int64) & ~np.int64(1)
            who, h = maker.keys(lines)
            bucket = buckets(h)
            keep = pick(bucket)
            who, bucket = who[keep], bucket[keep]
            chars = np.array([len(x) for x in lines], np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(x) for x in (bucket, item[who], chars[who])], schema=arrow)

        for batch in batches:
            for text in batch.column("text").to_pylist():
                for line in text.split("\n"):
                    if len(line) < least or not line.strip(SPACES):
                        continue
                    item = hash_of(line.encode("utf-8", "surrogatepass"), HASH_SEED)
                    if item in seen:
                        continue
                    if len(seen) >= SEEN_LINES:
                        seen.clear()
                    seen.add(item)
                    lines.append(line)
                    items.append(item)
                    held += len(line)
                    if held >= SLICE_CHARS:
                        yield made()
                        lines, items, held = [], [], 0
        if lines:
            yield made()

    return docs.select(text_or_empty().alias("text")).mapInArrow(run, KEYS)


def _filters(slots_of: DataFrame, columns: dict) -> list[np.ndarray]:
    """A filter of the rows that satisfy each of the conditions: pages of 4 KB in which a row's two
    bits are set, merged before and after the shuffle.  ``FILTER_PAGES`` decide the size.

    The merged pages, of fixed size, are dealt into small partitions, which the driver takes one by
    one: adaptive execution would hand them over in a few pieces of 64 MB."""
    first, second = F.shiftright("slot", 15).bitwiseAND(32_767), F.col("slot").bitwiseAND(32_767)
    maps = (slots_of.groupBy(F.shiftright("slot", 30).cast("int").alias("page")).agg(*[
        F.bitmap_construct_agg(F.when(c, at)).alias(f"{n}{i}")
        for n, c in columns.items() for i, at in enumerate((first, second))])
        .repartition(-(-FILTER_PAGES // PAGES_AT_ONCE), "page"))
    out = [np.zeros(FILTER_PAGES * 4096, np.uint8) for _ in columns]
    for row in maps.toLocalIterator():
        at = slice(row["page"] * 4096, (row["page"] + 1) * 4096)
        for bits, name in zip(out, columns, strict=True):
            for i in (0, 1):
                bits[at] |= np.frombuffer(row[f"{name}{i}"], np.uint8)
    return out


def _keys(docs: DataFrame, bounds: tuple) -> tuple[DataFrame, int]:
    """bucket, item, chars and own of the index entries and probes that may meet one another, and
    the number of rows that these are at most.

    A bucket is a hash of the other line's length, its bound, the segment and the substring.
    Filters of fixed size save what meets nothing: a probe needs the slot of an entry, an entry that of
    such a probe or of another line's entry.  What passes by chance meets nothing later.
    """
    context = docs.sparkSession.sparkContext
    entries = staged(_keys_of(docs, bounds, True, lambda bucket: slice(None)), "line-index")
    # whether different lines have an entry in the slot, told by a few bits of their ids
    tag = F.shiftright("item", 20).bitwiseAND(F.lit(0x7FFF).cast("long")).cast("short")
    shared = (entries.select(slot_of("bucket").alias("slot"), tag.alias("tag"))
              .groupBy("slot").agg((F.min("tag") != F.max("tag")).alias("shared")))
    any_entry, shared_entry = _filters(shared, {"one": F.lit(True), "shared": F.col("shared")})
    held = context.broadcast(any_entry)
    del any_entry

    def meets(bits: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        return in_filter(bits, places(bucket, len(bits) >> 12))

    found = staged(_keys_of(docs, bounds, False, lambda bucket: meets(held.value, bucket)),
                   "line-probes")
    held.destroy()
    met, = _filters(found.select(slot_of("bucket").alias("slot")), {"met": F.lit(True)})
    met |= shared_entry
    del held, shared_entry
    wanted = context.broadcast(met)
    del met

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bucket = batch.column("bucket").to_numpy()
            yield batch.filter(pa.array(meets(wanted.value, bucket)))

    return (found.withColumn("own", F.lit(False))
            .union(entries.mapInArrow(indexed, KEYS).withColumn("own", F.lit(True))),
            found.count() + entries.count())


def _shared_keys(keys: DataFrame, n_keys: int) -> DataFrame:
    """bucket, item and chars of the buckets that hold an index entry and a second line.

    Buckets of the same lines become one: a bucket is renamed to the sum of its lines' hashes.
    Buckets are counted before they are brought together with their lines, in a join that
    adaptive execution can split.
    """
    lines = keys.groupBy("bucket", "item").agg(
        F.first("chars").alias("chars"), F.max("own").alias("own"))
    lines = staged(lines, "line-entries", n_keys)
    sizes = (lines.groupBy("bucket").agg(
        F.count("*").alias("n"), F.max("own").alias("indexed"),
        F.sum(F.shiftright(F.xxhash64("item"), 16)).alias("lines"))
        .where("n > 1 AND indexed").select("bucket", "lines"))
    return staged(lines.join(sizes, "bucket").select(F.col("lines").alias("bucket"), "item", "chars")
                  .distinct(), "line-keys", lines.count())


def _near_lines(bounds: tuple):
    def links(group: pa.Table) -> list[tuple]:
        todo = open_pairs(group)
        if not todo.any():
            return []
        lines = group.column("line").to_pylist()
        n = len(lines)
        sizes = np.array([len(x) for x in lines])
        limits = np.array([bound(k, bounds) for k in sizes.tolist()])
        limits = np.maximum(limits[:, None], limits[None, :])
        todo &= np.abs(sizes[:, None] - sizes[None, :]) <= limits
        counts = np.zeros((n, CLASSES), np.int32)
        for i, x in enumerate(lines):
            counts[i] = np.bincount(code_points(x) % CLASSES, minlength=CLASSES)
        linked = np.zeros((n, n), bool)
        for i in np.flatnonzero(todo.any(axis=1)):
            near = np.flatnonzero(todo[i])
            near = near[np.abs(counts[near] - counts[i]).sum(axis=1) <= 2 * limits[i, near]]
            for j in near.tolist():
                linked[i, j] = within(lines[i], lines[j], int(limits[i, j]))
        return summary(group.column("item").to_pylist(), linked, np.ones(n, np.int64))

    return links


LINKS = T.StructType([T.StructField("item", T.LongType()), T.StructField("root", T.LongType()),
                      T.StructField("links", T.LongType())])


def near_lines(docs: DataFrame, bounds: tuple = BOUNDS) -> DataFrame:
    """Links of distinct lines: item (line id), root and links, a row per line and root."""
    shared = _shared_keys(*_keys(docs, bounds))
    n_shared = shared.count()
    cell = staged(cells(shared.withColumnRenamed("chars", "weight"), CELL_ROWS, CELL_CHARS, n_shared),
                  "line-cells")
    wanted = small_side(staged(cell.select("item").distinct(), "line-wanted", n_shared),
                        MAX_BROADCAST)
    texts = (docs.select(F.explode(F.split(text_or_empty(), "\n")).alias("line"))
             .withColumn("item", line_id("line")).join(wanted, "item")
             .groupBy("item").agg(F.first("line").alias("line")))
    # cells of one task each hold few links; these are brought together in few files
    found = (map_groups(cell.join(texts, "item"), "cell", _near_lines(bounds), LINKS)
             .groupBy("item", "root").agg(F.sum("links").alias("links")))
    return staged(found, "line-links", cell.count())


def line_id(line: str):
    return F.xxhash64(line).bitwiseAND(F.lit(-2))


def line_rows(docs: DataFrame) -> DataFrame:
    """Narrow rows of all lines: row, doc_id, line_no and item (null without a word)."""
    lines = docs.select("row", F.col("doc_id").cast("long"),
                        F.posexplode(F.split(text_or_empty(), "\n")).alias("line_no", "line"))
    return lines.select("row", "doc_id", "line_no", F.when(
        F.ltrim("line", F.lit(SPACES)) != "", line_id("line")).alias("item"))


def duplicate_lines(docs: DataFrame, bounds: tuple = BOUNDS) -> DataFrame:
    """Per row of ``docs`` (doc_id, text, row): its lines that are duplicates, and of which documents.

    See ``line_dedup``.
    """
    rows = staged(line_rows(docs), "lines")
    found = near_lines(docs, bounds)
    roots = components(found.select(F.col("item").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("item").agg(F.sum("links").alias("links"))
    place = F.struct("doc_id", "row", "line_no")
    items = (rows.where("item IS NOT NULL").groupBy("item")
             .agg(F.min(place).alias("first"), F.count("*").alias("n"))
             .join(roots, F.col("item") == F.col("node"), "left")
             .where("n > 1 OR root IS NOT NULL")
             .withColumn("root", F.coalesce("root", "item")))
    firsts = items.groupBy("root").agg(F.min("first").alias("kept"))
    repeats = (items.join(firsts, "root").join(links, "item", "left")
               .select("item", F.col("first").alias("item_first"), "kept", "links"))
    judged = rows.join(repeats, "item").withColumn("drop", F.col("kept") != place)
    of_row = judged.groupBy("row").agg(
        F.count_if("drop").alias("n_dropped"),
        F.count_if(F.col("drop") & (F.col("kept") != F.col("item_first"))).alias("n_near"),
        F.sum(F.coalesce("links", F.lit(0))).alias("n_links"),
        F.sort_array(F.collect_list(F.when(F.col("drop"), F.col("line_no")))).alias("dropped"),
        F.sort_array(F.collect_set(F.when(F.col("drop"), F.col("kept.doc_id"))))
        .alias("kept_in"))
    # most lines repeat nothing and are only counted
    counts = rows.groupBy("row").agg(F.first("doc_id").alias("doc_id"),
                                     F.count("item").alias("n_lines"))
    return counts.join(of_row, "row", "left").select(
        "row", "doc_id", "n_lines",
        *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n_dropped", "n_near", "n_links")],
        F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"),
        F.coalesce("kept_in", F.array().cast("array<long>")).alias("kept_in"))


def line_dedup(docs: DataFrame, bounds: tuple = BOUNDS) -> DataFrame:
    """Lines that repeat a line of another place, exactly or within ``bound`` edits.

    The bound follows from the longer line's length: none under 8 code points, one under 16, two
    under 64, three under 256, four beyond (``bounds``).  That is this operator's definition
    of near: a longer line is not allowed more edits than four.

    A line is cut into edits + 1 even segments; a line within that many edits keeps one of
    them whole, at a place that lengths and edits left and right confine.  Segments
    are index entries, substrings at such places are probes; filters of fixed size
    drop those that meet nothing before anything is shuffled.  Lines that share a key are compared in
    cells of bounded size by counts of characters, then by a banded bit-parallel
    distance.  Classes are connected components; a class keeps its first line by
    (doc_id, row, line number).

    Lines part at \\n and count if they have a word; equal lines are one line,
    however often they occur.  Lines are 63-bit hashes.  Null and empty texts have no
    lines.  Very long texts and lines are read whole; a cell's lines are bounded by their
    characters, too.  Rows that repeat are separate places: the first keeps its lines.  An
    empty table gives no rows.  Columns other than doc_id and text are ignored.

    Returns doc_id, n_lines, n_dropped, n_near (dropped for a line that is not equal), n_links
    (other distinct lines near to its lines), dropped (line numbers from 0) and
    kept_in (ids of the documents that keep those lines).
    """
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("row"))
    return duplicate_lines(rows, bounds).drop("row")


def drop_duplicate_lines(docs: DataFrame, bounds: tuple = BOUNDS) -> DataFrame:
    """``docs``, all columns, with the duplicate lines taken out of ``text`` (a null stays null).

    As ``line_dedup``: of rows that repeat, the first keeps its lines; an empty table stays empty.
    """
    columns = [F.col(f"`{c}`") for c in docs.columns]
    rows = staged(docs.select(F.struct(*columns).alias("doc"), "doc_id", "text",
                              F.monotonically_increasing_id().alias("row")), "line-docs")
    drop = duplicate_lines(rows, bounds).where("n_dropped > 0").select("row", "dropped")
    left = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains("dropped", i))
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    return (rows.join(drop, "row", "left").withColumn("clean", text)
            .select(*[F.col("clean").alias(c) if c == "text" else F.col(f"doc.`{c}`")
                      for c in docs.columns]))
