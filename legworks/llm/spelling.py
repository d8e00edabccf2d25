"""Spelling variants: words one edit apart, found in a trie of frequency vectors."""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from legworks.llm.common import small_side, staged
from legworks.llm.ngram_join import mixed

RUN = re.compile("[a-zÀ-ÿ]+")     # after A-Z have been lower-cased
LEAST_CHARS, LEAST_COUNT = 5, 3             # of a word
TYPO_ONE_IN = 97                            # runs of which one loses a code point, by its hash
GROUPS, PARTS = 8, 3                        # coarse letter groups; finer ones in each of them
LEAST_PREFIX = 3                            # coarse groups that, with the length, name a bucket
CELL_WORDS = 20_000                         # of a bucket's words in one trie
LEAF_WORDS = 8                              # a node of so few words is not split any more
HELD_WORDS = 200_000                        # distinct words that a task counts before it hands on
PIECE = 4_096                               # words that descend together
MAX_BROADCAST = 200_000

WORD_N = T.StructType([T.StructField("word", T.StringType()), T.StructField("n", T.LongType())])
HOMES = T.StructType([*WORD_N, T.StructField("bucket", T.LongType()),
                      T.StructField("ahead", T.ArrayType(T.LongType()))])
FOUND = T.StructType([T.StructField("word", T.StringType()), T.StructField("n_near", T.LongType()),
                      T.StructField("best_n", T.LongType()),
                      T.StructField("best", T.StringType())])


def words_of(doc_id: int | None, text: str) -> Counter:
    """The words of a text with their counts.

    The hash of a run depends on the document and the run alone, so it is taken once per distinct
    run; ``crc32`` goes on from the document's part.
    """
    plain = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    before = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    out: Counter = Counter()
    for run, n in Counter(RUN.findall(plain)).items():
        h = zlib.crc32(run.encode(), before)
        if h % TYPO_ONE_IN == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
        if len(run) >= LEAST_CHARS:
            out[run] += n
    return out


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of at least five code points and three occurrences over all documents."""
    schema = to_arrow_schema(WORD_N)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def handed() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                schema=schema)
            held.clear()
            return out

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(),
                                    batch.column("text").to_pylist(), strict=True):
                for word, n in words_of(doc_id, text or "").items():
                    held[word] += n
                if len(held) > HELD_WORDS:
                    yield handed()
        yield handed()

    return (docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
            .mapInArrow(run, WORD_N).groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


def letter_groups(words: DataFrame) -> dict[str, tuple[int, int]]:
    """Coarse and fine group of each letter.

    Letters are dealt to the fine groups by their frequency in the words, to and fro, so that all
    groups are about equally frequent.  There are at most 90 letters, whatever the corpus.
    """
    rows = (words.select(F.explode(F.split("word", "")).alias("letter")).where("letter <> ''")
            .groupBy("letter").count().collect())
    out, fine = {}, GROUPS * PARTS
    for i, row in enumerate(sorted(rows, key=lambda r: (-r["count"], r["letter"]))):
        lap, at = divmod(i, fine)
        g = fine - 1 - at if lap % 2 else at
        out[row["letter"]] = (g % GROUPS, g)
    return out


def prefix_for(n_words: int) -> int:
    """Coarse groups that name a bucket: more of them the more words there are."""
    for prefix in range(LEAST_PREFIX, GROUPS):
        if n_words <= CELL_WORDS * 8 * 3 ** prefix:
            return prefix
    return GROUPS


def steps(prefix: int) -> np.ndarray:
    """Differences of (length, first coarse counts) by which a word one edit away comes later.

    An edit adds one letter, takes one or does both; in the counts that name the bucket, each may
    show or not.  Only differences whose first entry that isn't zero is positive: of two words
    in different buckets, the one in the earlier bucket looks the other up.
    """
    none, unit = np.zeros(prefix, np.int64), np.eye(prefix, dtype=np.int64)
    one = [none, *unit]
    out = {(1, *x.tolist()) for x in one} | {(-1, *(-x).tolist()) for x in one}
    out |= {(0, *(a - b).tolist()) for a in one for b in one}
    return np.array(sorted(x for x in out if x > (0,) * (prefix + 1)), np.int64)


def count_matrix(words: list[str], groups: dict[str, int], width: int) -> np.ndarray:
    """Counts of the letter groups, a row for each word."""
    points = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    table = np.zeros(0x100, np.int64)
    for letter, g in groups.items():
        table[ord(letter)] = g
    row = np.repeat(np.arange(len(words)), [len(w) for w in words])
    return np.bincount(row * width + table[points], minlength=len(words) * width).reshape(
        len(words), width)


def _hashed(keys: np.ndarray) -> np.ndarray:
    rng = np.random.default_rng(13)
    odd = rng.integers(1, 2 ** 63, keys.shape[-1], dtype=np.uint64) | np.uint64(1)
    return mixed((keys.astype(np.uint64) * odd).sum(axis=-1, dtype=np.uint64)).view(np.int64)


def homes(words: DataFrame, groups: dict[str, tuple[int, int]], prefix: int) -> DataFrame:
    """word, n, bucket (its own) and ahead (the later buckets that a near word may be in)."""
    coarse = {k: v[0] for k, v in groups.items()}
    moves, schema = steps(prefix), to_arrow_schema(HOMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 10_000):
                part = batch.slice(at, 10_000)
                texts = part.column("word").to_pylist()
                counts = count_matrix(texts, coarse, GROUPS)[:, :prefix]
                key = np.column_stack([[len(w) for w in texts], counts])
                near = key[:, None, :] + moves[None]
                fits = (near >= 0).all(axis=2)
                ahead = _hashed(near)
                yield pa.RecordBatch.from_arrays(
                    [part.column("word"), part.column("n"), pa.array(_hashed(key)),
                     pa.ListArray.from_arrays(
                         pa.array(np.append(0, np.cumsum(fits.sum(axis=1))), pa.int32()),
                         pa.array(ahead[fits]))], schema=schema)

    return words.mapInArrow(run, HOMES)


def one_edit(a: str, b: str) -> bool:
    """Whether one inserted, deleted or replaced code point turns ``a`` into ``b``."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i:] == b[i + 1:] if len(a) < len(b) else a[i + 1:] == b[i + 1:]


def ends(words: list[str]) -> np.ndarray:
    """First two and last two code points of each word, as two numbers.

    One edit in a word of five code points or more leaves one of the two as it is.
    """
    points = np.frombuffer("".join(w[:2] + w[-2:] for w in words).encode("utf-32-le"),
                           np.uint32).reshape(-1, 2, 2).astype(np.uint64)
    return points[:, :, 0] << np.uint64(32) | points[:, :, 1]


class Trie:
    """Words in the order of their frequency vectors: a node is a range of rows that agree on the
    vector's first counts, its children the ranges by the next count."""

    def __init__(self, vectors: np.ndarray):
        self.order = np.lexsort(vectors.T[::-1])
        self.vectors = np.ascontiguousarray(vectors[self.order].astype(np.int32))

    def within(self, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(queries, words) that may be one edit apart, as arrays of row numbers.

        Depth first, with all queries that reach a node at a time.  A child whose count is above
        a query's takes from its surplus, one whose count is below from its deficit; either
        allows one letter in all.
        """
        width = self.vectors.shape[1]
        queries = queries.astype(np.int32)
        n = len(queries)
        stack = [(0, len(self.vectors), 0, np.arange(n), np.zeros(n, np.int32),
                  np.zeros(n, np.int32))]
        while stack:
            lo, hi, level, who, surplus, deficit = stack.pop()
            if hi - lo <= LEAF_WORDS or level == width:
                left, own = queries[who, level:], self.vectors[lo:hi, level:]
                more = own[None] - left[:, None]
                fits = (np.maximum(more, 0).sum(axis=2) + surplus[:, None] <= 1) & (
                    np.maximum(-more, 0).sum(axis=2) + deficit[:, None] <= 1)
                q, w = np.nonzero(fits)
                if len(q):
                    yield who[q], self.order[lo + w]
                continue
            column = self.vectors[lo:hi, level]
            cuts = [0, *(np.flatnonzero(column[1:] != column[:-1]) + 1).tolist(), hi - lo]
            asked = queries[who, level]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                more = column[a] - asked
                s, d = surplus + np.maximum(more, 0), deficit + np.maximum(-more, 0)
                go = np.flatnonzero((s <= 1) & (d <= 1))
                if len(go):
                    stack.append((lo + a, lo + b, level + 1, who[go], s[go], d[go]))


class _Cell:
    """The trie of a cell's own words, and what its words and those that ask it have found."""

    def __init__(self, groups: dict[str, int]):
        self.groups, self.words, self.n, self.trie = groups, [], [], None
        self.ends = np.zeros((0, 2), np.uint64)
        self.found: dict[str, tuple[int, int, str]] = {}

    def vectors(self, words: list[str]) -> np.ndarray:
        return count_matrix(words, self.groups, GROUPS * PARTS)

    def add(self, words: list[str], n: list[int]) -> None:
        self.words += words
        self.n += n

    def ask(self, words: list[str], n: list[int], among: int | None = None) -> None:
        """Look ``words`` up; with ``among``, they are the cell's own from that row on, and only
        pairs with a later row count."""
        if not self.words:
            return
        if self.trie is None:
            self.trie, self.ends = Trie(self.vectors(self.words)), ends(self.words)
        tips = ends(words)
        for q, w in self.trie.within(self.vectors(words)):
            keep = (tips[q] == self.ends[w]).any(axis=1)
            if among is not None:
                keep &= q + among < w
            for i, j in zip(q[keep].tolist(), w[keep].tolist(), strict=True):
                if one_edit(words[i], self.words[j]):
                    self.note(words[i], self.n[j], self.words[j])
                    self.note(self.words[j], n[i], words[i])

    def note(self, word: str, n: int, other: str) -> None:
        count, m, best = self.found.get(word, (0, 0, ""))
        if n > m or (n == m and other < best):
            m, best = n, other
        self.found[word] = count + 1, m, best

    def finish(self) -> None:
        for at in range(0, len(self.words), PIECE):
            self.ask(self.words[at:at + PIECE], self.n[at:at + PIECE], at)


def near_words(words: DataFrame) -> DataFrame:
    """word, n_near and best (a struct: minus the largest n, then the smallest word that has it).

    ``words``: word (distinct, not null) and n, a staged table.
    """
    groups = letter_groups(words)
    fine = {k: v[1] for k, v in groups.items()}
    placed = staged(homes(words, groups, prefix_for(words.count())), "spelling-homes")
    cells = staged(placed.groupBy("bucket").agg(
        F.ceil(F.count("*") / CELL_WORDS).cast("int").alias("blocks")), "spelling-cells")
    cells = small_side(cells, MAX_BROADCAST)
    block = F.pmod(F.xxhash64("word"), F.col("blocks")).cast("int")
    own = placed.select("word", "n", "bucket").join(cells, "bucket").withColumn("block", block)
    asked = (placed.select("word", "n", F.explode("ahead").alias("bucket")).join(cells, "bucket")
             .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))))
    # words of a bucket that is dealt into blocks ask the later blocks, too
    beside = (own.where("blocks > 1 AND block < blocks - 1").withColumn(
        "block", F.explode(F.sequence(F.col("block") + 1, F.col("blocks") - 1))))
    rows = (own.withColumn("asks", F.lit(False))
            .unionByName(asked.unionByName(beside).withColumn("asks", F.lit(True)))
            .select(F.xxhash64("bucket", "block").alias("cell"), "asks", "word", "n"))
    schema = to_arrow_schema(FOUND)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, key = _Cell(fine), None

        def told() -> pa.RecordBatch:
            cols = list(zip(*[(w, *x) for w, x in cell.found.items()], strict=True)) or [()] * 4
            cell.found = {}
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)

        for batch in batches:
            keys = batch.column("cell").to_numpy()
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]) | (asks[1:] != asks[:-1])) + 1
            edges = [0, *cuts.tolist(), len(keys)] if len(keys) else []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                if keys[lo] != key:
                    cell.finish()
                    yield told()
                    cell, key = _Cell(fine), keys[lo]
                part = batch.slice(lo, hi - lo)
                texts, n = part.column("word").to_pylist(), part.column("n").to_pylist()
                if not asks[lo]:
                    cell.add(texts, n)
                    continue
                for at in range(0, len(texts), PIECE):
                    cell.ask(texts[at:at + PIECE], n[at:at + PIECE])
                    if len(cell.found) > HELD_WORDS:
                        yield told()
        cell.finish()
        yield told()

    found = rows.repartition("cell").sortWithinPartitions("cell", "asks").mapInArrow(run, FOUND)
    return found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"),
        F.min(F.struct((-F.col("best_n")).alias("minus_n"), F.col("best").alias("form")))
        .alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the last of the words that forms lead to.

    ``forms``: word, form.  A form has twice the count of its word at least, so no
    chain comes back.  Each round doubles the steps that a row has gone.
    """
    now = staged(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = now.select(F.col("word").alias("root"), F.col("root").alias("further"))
        now = staged(now.join(on, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"),
            F.col("further").isNotNull().alias("moved")), "spelling-roots")
        if not now.where("moved").limit(1).count():
            return now.select("word", "root")
        now = now.select("word", "root")


def spelling_variants(docs: DataFrame) -> DataFrame:
    """Words of the documents with the more frequent word that each is a variant of.

    Words are the maximal runs of letters (A-Z, a-z, U+00C0 to U+00FF; A-Z lower-cased) of
    whole texts.  Where 97 divides the crc32 of ``<doc_id>:<run>``, the run loses the code point at
    crc32 modulo its length first.  Words under five code points or three
    occurrences are left out.

    Frequency-vector trie: letters form groups, a word is the vector of its groups'
    counts, and a trie holds the vectors count by count.  A search
    descends depth first and may meet one letter too many and one too few on its way;
    leaf words are verified.  The length and the first coarse counts name a bucket: a word
    looks only into the buckets that an edit may lead to, each pair from one side.  A bucket
    of more than ``CELL_WORDS`` words becomes several tries, all of which are asked, so no
    task holds an unbounded group and none is cut.

    Null and empty texts have no words; a null doc_id is hashed as an empty string.  Repeated rows
    count as often as they are there.  Very long texts are read whole.  Ties go to the smaller word
    in code-point order.  An empty table gives no rows.  Columns other than doc_id and text
    are ignored.

    Returns word, form (its near word of largest n if that is at least twice its own, else
    null), root (where forms lead; the word itself without one), n, n_near (words one edit
    away) and form_n (null without a form).
    """
    words = staged(vocabulary(docs), "spelling-words")
    near = (words.join(near_words(words), "word", "left")
            .withColumn("takes", -F.col("best.minus_n") >= 2 * F.col("n")))
    known = staged(near.select(
        "word", F.when(F.col("takes"), F.col("best.form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(F.col("takes"), -F.col("best.minus_n")).alias("form_n")), "spelling-near")
    ends = roots(known.where("form IS NOT NULL"))
    return known.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
