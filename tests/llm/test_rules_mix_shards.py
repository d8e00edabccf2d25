"""Host rules, source mixing and sharding against plain Python."""

import zlib
from collections import Counter, defaultdict

import pytest
from messy import messy_docs, no_docs

from legworks.llm import host_rules as H, mixing as M
from legworks.llm.sharding import shard


def texts_of(docs):
    return [(r.doc_id, r.text, r.source) for r in docs.select("doc_id", "text", "source").collect()]


def measures(text):
    text = text or ""
    words = [w for w in text.translate({9: 32, 10: 32, 11: 32, 12: 32, 13: 32}).split(" ") if w]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    hit = {p for i in range(len(words) - 2) if windows[tuple(words[i:i + 3])] > 1
           for p in (i, i + 1, i + 2)}
    lines = [x for x in text.split("\n") if x.encode().split()]
    return (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(hit))


def test_measures_of_whole_texts(spark):
    more = [(20, "a b c a b c d " * 3, "s1"), (21, "# x\n# x\n\n| y\ny", "s1"),
            (22, " ".join(f"w{i}" for i in range(60)), "good")]
    docs = messy_docs(spark, more)
    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines,
                  r.n_repeat_words, r.base_failed) for r in H.quality_rules(docs).collect())
    want = []
    for i, t, _ in texts_of(docs):
        m = measures(t)
        want.append((str(i), *m, m[0] < 50 or 100 * m[4] > 50 * m[0]))
    assert got == sorted(want)
    assert H.quality_rules(no_docs(spark)).collect() == []


def test_hosts_are_judged_by_shrunk_rates(spark):
    good, bad = " ".join(f"w{i}" for i in range(60)), "too short"
    rows = [(i, bad if i % 20 else good, "farm") for i in range(400)]          # 95 % fail
    rows += [(1000 + i, good if i % 10 else bad, f"h{i % 20}") for i in range(2000)]
    rows += [(5000, bad, "single"), (5001, good, "single2")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    out = {r.doc_id: r for r in H.quality_rules(docs).collect()}
    assert out[0].host_failed and not out[0].base_failed and not out[0].kept   # goes with its host
    assert not out[5000].host_failed and not out[5000].kept   # one page doesn't damn a host
    assert out[5001].kept and out[1001].kept


def test_targets_are_a_water_level(spark):
    sizes = [("a", 100), ("b", 1000), ("c", 1000), ("d", 10), (None, 500)]
    df = spark.createDataFrame(sizes, "source string, source_size long")
    got = {r.source: r.target for r in M.source_targets(df).collect()}
    weights = dict(zip(["a", "b", "c", "d", None], [5, 2, 1, 5, 2], strict=True))
    limit, want, left, free = {s: 2 * n for s, n in sizes}, {}, 1.5 * 2610, set(weights)
    while True:      # the contract's words: share, stop at the limit, share the excess again
        share = {s: left * weights[s] / sum(weights[x] for x in free) for s in free}
        over = {s for s in free if share[s] > limit[s]}
        if not over:
            want |= share
            break
        for s in over:
            want[s], left = float(limit[s]), left - limit[s]
        free -= over
    assert got == pytest.approx(want)


def test_mix_meets_targets_and_repeats(spark, monkeypatch):
    monkeypatch.setattr(M, "BUCKET_ROWS", 15)
    rows = [(i, " ".join(["w"] * (1 + i * i % 37)), "abc"[i % 3] if i % 7 else None)
            for i in range(10, 500)]
    docs = messy_docs(spark, rows)
    plan = M.mix_plan(docs).collect()
    monkeypatch.setattr(M, "MAX_SOURCES_BROADCAST", 1)     # joins by shuffle give the same
    again = M.mix_plan(docs.repartition(7)).collect()
    assert sorted(map(str, plan)) == sorted(map(str, again))
    assert len(plan) == docs.count()
    taken, by_source = defaultdict(int), {}
    for r in plan:
        assert r.taken in (0, r["size"], 2 * r["size"])
        taken[r.target, r.source_size] += r.taken
    longest = Counter()
    for r in plan:
        longest[r.target, r.source_size] = max(longest[r.target, r.source_size], r["size"])
        by_source[r.target, r.source_size] = r.target
    # within half of a document; copies (equal id and text) go together
    assert all(abs(taken[k] - t) <= longest[k] for k, t in by_source.items())
    mixed = M.mix(docs)
    assert mixed.columns == docs.columns
    copies = Counter((r.doc_id, r.text) for r in mixed.select("doc_id", "text").collect())
    sizes = {(i, t): measures(t)[0] for i, t, _ in texts_of(docs)}
    assert sum(n * sizes[k] for k, n in copies.items()) == sum(r.taken for r in plan)


def test_mix_of_nothing(spark):
    assert M.mix_plan(no_docs(spark)).collect() == []
    empty = spark.createDataFrame([(1, None, "a"), (2, "", None)],
                                  "doc_id long, text string, source string")
    assert [(r["size"], r.taken, r.target) for r in M.mix_plan(empty).collect()] == [(0, 0, 0.0)] * 2


def test_shards_are_contiguous_and_balanced(spark):
    docs = messy_docs(spark, [(100 + i, "x" * (i * 37 % 900), "s") for i in range(400)])
    out = shard(docs, 8).collect()
    rows = {(i, (t or "")) for i, t, _ in texts_of(docs)}
    assert len(out) == docs.count() and {r.law for r in out} == {"bytes"}
    raw = {(i, len(t.encode()) + 1, zlib.crc32(t.encode())) for i, t in rows}
    assert {(r.doc_id, r["size"], r.text_crc32) for r in out} == raw
    by = defaultdict(list)
    for r in out:
        by[r.shard].append(r)
    for rs in by.values():
        assert sorted(r.slot for r in rs) == list(range(len(rs)))
    ordered = sorted(out, key=lambda r: (r.doc_id is not None, r.doc_id or 0))
    assert [r.shard for r in ordered] == sorted(r.shard for r in out)
    total, longest = sum(r["size"] for r in out), max(r["size"] for r in out)
    assert all(abs(sum(r["size"] for r in by[s]) - total / 8) <= longest for s in by)
    even = shard(docs.where("doc_id >= 100"), 8).groupBy("shard").sum("size").collect()
    sums = [r["sum(size)"] for r in even]
    assert len(sums) == 8 and max(sums) - min(sums) <= 2 * 900
    assert shard(no_docs(spark)).collect() == []


def test_samples_by_hash_are_the_smallest(spark):
    from legworks.llm.common import sample_by_hash, small_side
    from pyspark.sql import functions as F

    df = spark.range(60_000).withColumnRenamed("id", "k")
    got = {r.k for r in sample_by_hash(df, ["k"], 500).collect()}
    want = {r.k for r in df.orderBy(F.xxhash64("k"), "k").limit(500).collect()}
    assert got == want and len(got) == 500
    assert sample_by_hash(df.limit(10), ["k"], 500).count() == 10
    hint = lambda d: "ResolvedHint" in d._jdf.queryExecution().analyzed().toString()
    assert hint(small_side(df.limit(10), 10)) and not hint(small_side(df.limit(11), 10))


def test_hosts_join_by_shuffle(spark, monkeypatch):
    docs = messy_docs(spark)
    a = sorted(map(str, H.quality_rules(docs).collect()))
    monkeypatch.setattr(H, "MAX_HOSTS_BROADCAST", 0)
    assert sorted(map(str, H.quality_rules(docs).collect())) == a
