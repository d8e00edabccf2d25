"""Edit join of lines against brute force."""

import random

import numpy as np
from hypothesis import given, settings, strategies as st
from messy import messy_docs, no_docs
from pyspark.sql import functions as F

from legworks.llm import common, line_dedup as L


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


@settings(max_examples=400, deadline=None)
@given(st.text("ab漢", max_size=14), st.text("ab漢", max_size=14), st.integers(1, 3))
def test_banded_distance_and_probes(a, b, edits):
    near = distance(a, b) <= edits
    assert L.within(a, b, edits) == near
    if len(a) < len(b):
        a, b = b, a
    if near and len(b) > edits:     # a near pair shares a key
        own = {(n, i, b[p:p + k]) for n, i, p, k, mine in L.probes(len(b), edits) if mine}
        assert own & {(n, i, a[p:p + k]) for n, i, p, k, _ in L.probes(len(a), edits)}


def edited(rnd, line, n):
    chars = list(line)
    for _ in range(n):
        p = rnd.randrange(len(chars))
        chars[p:p + rnd.choice([0, 1])] = rnd.choice(["", "x", "yz"[:1]])
    return "".join(chars)


def sample(seed=2):
    rnd = random.Random(seed)
    # lines of 5 to 600 characters, some about the lengths from which the bound grows
    base = ["".join(rnd.choice("abcdef ") for _ in range(n)) for n in (
        5, 7, 8, 9, 15, 16, 17, 30, 45, 60, 62, 64, 65, 100, 160, 254, 256, 259, 400, 600)]
    rows = []
    for i in range(60):
        lines = [edited(rnd, rnd.choice(base), rnd.choice([0, 0, 1, 2, 3, 4, 5])) for _ in range(3)]
        rows.append((100 + i, "\n".join([*lines, "tiny"]), "s"))
    return rows


def brute(rows):
    """Rows in order of (doc_id, position): per row dropped lines, near drops, links, keepers."""
    places = {}
    for n, (i, text) in enumerate(rows):
        for k, line in enumerate((text or "").split("\n")):
            if line.encode().split():
                places.setdefault(line, []).append(((i is not None, i or 0), n, k))
    lines = list(places)
    root = {x: x for x in lines}
    links = {x: 0 for x in lines}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for p, a in enumerate(lines):
        for b in lines[p + 1:]:
            limit = L.bound(max(len(a), len(b)))
            if abs(len(a) - len(b)) <= limit and distance(a, b) <= limit:
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    first = {}
    for x in lines:
        r = find(x)
        first[r] = min([*places[x], *([first[r]] if r in first else [])])
    out = []
    for n, (i, text) in enumerate(rows):
        lost, near, linked, count = [], 0, 0, 0
        for k, line in enumerate((text or "").split("\n")):
            if line.encode().split():
                count += 1
                linked += links[line]
                kept = first[find(line)]
                if kept != ((i is not None, i or 0), n, k):
                    lost.append(k)
                    near += kept != min(places[line])
        out.append((str(i), count, len(lost), near, linked, lost))
    return out


def test_lines_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(L, "CELL_ROWS", 4)          # buckets are dealt in blocks
    monkeypatch.setattr(L, "MAX_BROADCAST", 0)      # and lines joined by shuffle
    docs = messy_docs(spark, sample()).coalesce(1)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.n_near, r.n_links, r.dropped)
                 for r in L.line_dedup(docs).collect())
    assert got == sorted(brute(rows))
    assert sum(r[3] for r in got) > 5


def test_texts_without_their_duplicate_lines(spark):
    rows = [(1, "one line of some length\nkeep this other line"),
            (2, "one line of same length\nand a line of its own\none line of some length"),
            (3, None), (4, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumnRenamed(
        "doc_id", "doc_id").selectExpr("doc_id", "text", "'x' AS row", "'y' AS `a.b`")
    out = L.drop_duplicate_lines(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.text for r in out.collect()} == {
        1: rows[0][1], 2: "and a line of its own", 3: None, 4: ""}


def test_no_documents(spark):
    assert L.line_dedup(no_docs(spark)).collect() == []


def test_bounds_by_length(spark):
    rnd = random.Random(7)
    lines = ["page 1 of 9", "page 2 of 9", "no", "on", "1234567", "12345678"]
    for n in (20, 63, 64, 100, 255, 256, 300, 900):        # and the same line after some edits
        base = "".join(rnd.choice("abcdefgh ") for _ in range(n))
        lines += [base, *(edited(rnd, base, k) for k in (L.bound(n), L.bound(n) + 3))]
    docs = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string")
    want = [sum(abs(len(a) - len(b)) <= L.bound(max(len(a), len(b)))
                and distance(a, b) <= L.bound(max(len(a), len(b))) for b in lines if b != a)
            for a in lines]
    got = {r.doc_id: r for r in L.line_dedup(docs).collect()}
    assert [got[i].n_links for i in range(len(lines))] == want
    assert got[1].dropped == [0] and got[3].dropped == [] and got[5].dropped == [0]
    assert sum(w > 0 for w in want) > 10
    assert [L.bound(n) for n in (0, 7, 8, 15, 16, 63, 64, 255, 256, 10 ** 6)] == [
        0, 0, 1, 1, 2, 2, 3, 3, 4, 4]


def keys_by_line(lines, own):
    who, key = L.KeyMaker(L.BOUNDS, own).keys(lines)
    return [key[who == i].tolist() for i in range(len(lines))]


def test_near_lines_share_a_key_of_an_index_entry():
    rnd = random.Random(3)
    near = 0
    for _ in range(600):
        a = "".join(rnd.choice("abcd ") for _ in range(rnd.choice([7, 8, 14, 16, 62, 63, 64, 66, 253,
                                                                  256, 258, 300])))
        b = edited(rnd, a, rnd.randint(0, 4))
        limit = L.bound(max(len(a), len(b)))
        if a == b or not limit or distance(a, b) > limit:
            continue
        near += 1
        entries = [set(x) for x in keys_by_line([a, b], True)]
        looked_up = [e | set(x) for e, x in zip(entries, keys_by_line([a, b], False), strict=True)]
        assert entries[0] & looked_up[1] or entries[1] & looked_up[0]
    assert near > 100


def test_keys_are_hashes_of_substrings():
    lines = ["the same words here", "xx the same words he", "the same words here", "no"]
    for own in (True, False):
        found = keys_by_line(lines, own)
        assert found[0] == found[2] and found[3] == []             # whatever stands around them
        texts = {(seed, lines[0][p:p + n]) for seed, p, n, mine in L.lookups(len(lines[0])) if mine == own}
        assert len(set(found[0])) == len(texts)


def test_a_line_of_a_million_characters(spark):
    long = "".join(random.Random(1).choices("abcdefgh ", k=1_000_000))
    other = long[:400_000] + "X" + long[400_001:]
    apart = long[:1000] + "Y" * 5 + long[1000:999_000] + "Z" * 5 + long[999_000:]
    docs = spark.createDataFrame([(1, long), (2, other), (3, apart)], "doc_id long, text string")
    got = {r.doc_id: (r.n_links, r.n_dropped) for r in L.line_dedup(docs).collect()}
    assert got == {1: (1, 0), 2: (1, 1), 3: (0, 0)}


def test_the_filter_decides_nothing(spark, monkeypatch):
    docs = spark.createDataFrame([(r[0], r[1]) for r in sample(5)], "doc_id long, text string")
    docs = docs.coalesce(1)
    want = sorted(map(tuple, L.line_dedup(docs).select("doc_id", "n_links", "n_dropped").collect()))
    monkeypatch.setattr(L, "FILTER_PAGES", 1)       # many probes pass by chance
    got = sorted(map(tuple, L.line_dedup(docs).select("doc_id", "n_links", "n_dropped").collect()))
    assert got == want and any(n for _, n, _ in want)


def test_filters_reach_the_driver_in_small_pieces(spark, monkeypatch):
    pieces = []
    kind = type(spark.range(1))
    whole = kind.toLocalIterator

    def spied(df, *args, **kw):
        pieces.append(df.rdd.getNumPartitions())
        return whole(df, *args, **kw)

    monkeypatch.setattr(kind, "toLocalIterator", spied)
    h = np.arange(5000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    df = spark.createDataFrame([(int(s), i % 2 == 0) for i, s in enumerate(L.slots(h))],
                               "slot long, even boolean")
    all_of, even = L._filters(df, {"one": F.lit(True), "even": F.col("even")})
    assert pieces == [L.FILTER_PAGES // 128]
    assert L.in_filter(all_of, L.slots(h)).all() and L.in_filter(even, L.slots(h[::2])).all()
    assert L.in_filter(even, L.slots(h[1::2])).mean() < 0.01


def test_lines_are_cut_into_index_entries_once(spark, monkeypatch):
    passes = []
    keys_of = L._keys_of

    def spied(docs, bounds, own, *args):
        passes.append(own)
        return keys_of(docs, bounds, own, *args)

    monkeypatch.setattr(L, "_keys_of", spied)
    docs = spark.createDataFrame([(r[0], r[1]) for r in sample(4)], "doc_id long, text string")
    assert L.line_dedup(docs).agg(F.sum("n_links")).head()[0] > 0
    assert passes == [True, False]


def test_a_bucket_has_one_place_in_rows_and_arrays(spark):
    bucket = L.buckets(np.arange(2000, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    ends = np.array([-1, 0, 1, 2 ** 63 - 1, -2 ** 63, 2 ** 50, -2 ** 50], np.int64)
    bucket = np.concatenate([bucket, ends])
    rows = spark.createDataFrame([(int(b),) for b in bucket], "bucket long")
    got = {r.bucket: r.slot for r in rows.select("bucket", L.slot_of("bucket").alias("slot")).collect()}
    assert [got[int(b)] for b in bucket] == L.places(bucket, L.FILTER_PAGES).tolist()
    assert (bucket < 0).any() and len(set(got.values())) > 1900


def test_rows_without_repeats_and_blank_lines(spark):
    rows = [(1, "a line that comes once\n\n \t\x0b\x0c\r \n \n x"), (2, " \t "), (3, "\n"),
            (4, None), (5, "a line that comes twice"), (6, "a line that comes twice\n\x1f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    got = {r.doc_id: tuple(r)[1:] for r in L.line_dedup(docs).collect()}
    none = (0, 0, 0, [], [])
    assert got == {1: (3, *none), 2: (0, *none), 3: (0, *none), 4: (0, *none), 5: (1, *none),
                   6: (2, 1, 0, 0, [0], [5])}


def test_few_rows_are_staged_in_few_files(spark, monkeypatch):
    """Each file costs processes on the executor; a session may have many shuffle partitions."""
    from legworks.llm import links
    files = []

    def spied(df, name, *args):
        out = common.staged(df, name, *args)
        files.append((name, len(out.inputFiles())))
        return out

    docs = spark.createDataFrame([(r[0], r[1]) for r in sample(6)], "doc_id long, text string")
    docs = docs.coalesce(1)
    columns = ("doc_id", "n_links", "n_dropped", "n_near")
    want = sorted(map(tuple, L.line_dedup(docs).select(*columns).collect()))
    monkeypatch.setattr(L, "staged", spied)
    monkeypatch.setattr(links, "staged", spied)
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions",
                                           "spark.sql.adaptive.coalescePartitions.enabled")}
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "30")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        got = sorted(map(tuple, L.line_dedup(docs).select(*columns).collect()))
        few = [n for _, n in files]
        assert len(few) >= 10 and max(few) == 1
        monkeypatch.setattr(common, "FILE_ROWS", 100)
        files.clear()
        again = sorted(map(tuple, L.line_dedup(docs).select(*columns).collect()))
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert got == want and again == want and any(n for _, n, *_ in want)
    assert 1 < max(n for name, n in files if name == "line-keys") < 30     # and more for more rows
