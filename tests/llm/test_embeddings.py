"""Near-duplicate vectors and hard negatives against brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from legworks.llm import embedding_dedup as E
from legworks.llm import hard_negatives as N
from legworks.llm.hnsw import Graph

SCHEMA = "vec_id long, embedding array<float>, label int"


def frame(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    for c in ("item", "unit", "block", "group", "place", "vector", "rank", "a.b", "root"):
        df = df.withColumn(c, F.lit("x"))
    return df


def clustered(seed=1, n=500, dims=16, families=((40, 0.02), (8, 0.05), (3, 0.1))):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    for size, spread in families:
        for _ in range(3):
            x = np.vstack([x, rng.normal(size=dims) + spread * rng.normal(size=(size, dims))])
    x = x[rng.permutation(len(x))].astype(np.float32)
    return [(i, [float(v) for v in r], int(rng.integers(0, 4))) for i, r in enumerate(x)]


ODD = [(9001, None, 1), (9002, [0.0] * 16, 1), (9003, [1.0] * 15 + [None], 1),
       (9004, [1.0] * 15 + [float("nan")], 2), (9005, [float("inf")] + [0.0] * 15, 2),
       (9006, [], 1), (9007, [1.0, 2.0], 1), (9008, [2.0, 4.0], None), (9008, [2.0, 4.0], None),
       (None, [2.0, 4.0], 1), (None, [-3.0, 1.0], 1), (9009, [1e30, -0.0], 0), (9010, [3e30, 0.0], 0)]


def linked(rows, similar=0.95):
    """Links, classes and verdicts by all pairs."""
    unit = []
    for _, v, _ in rows:
        ok = v and all(c is not None and math.isfinite(c) for c in v) and any(v)
        x = np.array(v, np.float64) if ok else None
        unit.append(None if x is None else (x / np.abs(x).max())
                    / np.linalg.norm(x / np.abs(x).max()))
    root, links = list(range(len(rows))), [0] * len(rows)

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(unit):
        for j in range(i):
            b = unit[j]
            if a is not None and b is not None and len(a) == len(b) and a @ b >= similar:
                links[i] += 1
                links[j] += 1
                root[find(i)] = find(j)
    first = {}
    for i, (v, _, _) in enumerate(rows):
        if v is not None:
            first[find(i)] = min(v, first.get(find(i), v))
    return sorted(((v, links[i], first.get(find(i)), v == first.get(find(i)))
                   for i, (v, _, _) in enumerate(rows)), key=repr)


def test_links_and_classes_equal_all_pairs(spark):
    rows = clustered() + ODD
    out = E.embedding_dedup(frame(spark, rows))
    assert out.columns == ["vec_id", "n_links", "component_id", "kept"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    assert got == linked(rows)
    assert sum(r[1] for r in got) > 500


def test_shards_and_parts_find_the_same(spark, monkeypatch):
    monkeypatch.setattr(E, "SHARD_ROWS", 60)
    monkeypatch.setattr(E, "PART_ROWS", 50)
    monkeypatch.setattr(E, "CHUNK", 16)
    monkeypatch.setattr(E, "MAX_BROADCAST", 0)
    rows = clustered(2, 200)
    got = sorted((tuple(r) for r in E.embedding_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == linked(rows)


def test_a_third_of_the_rows_near_one_vector(spark):
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(size=(400, 12)), rng.normal(size=12) + 0.01 * rng.normal(size=(200, 12))])
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x.astype(np.float32))]
    rows += [(1000 + i, rows[-1][1], 0) for i in range(50)]            # and exact copies
    got = sorted((tuple(r) for r in E.embedding_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == linked(rows) and max(r[1] for r in got) == 249


def test_no_vectors(spark):
    for rows in ([], ODD[:6]):
        out = E.embedding_dedup(frame(spark, rows)).collect()
        assert [tuple(r) for r in sorted(out, key=lambda r: r.vec_id)] == [
            (v, 0, v, True) for v, _, _ in rows]


def test_beams_widen_until_audits_pass(spark):
    """Audits against brute force: the recall they report is reached on other queries, too."""
    rng = np.random.default_rng(3)
    x = rng.normal(size=(3000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(x)
    width, recall = E._audited(graph, x[:300], 0.95, E.RECALL, 7)
    assert recall >= E.RECALL and width >= E.BEAM
    aside = rng.normal(size=x.shape)
    aside -= (aside * x).sum(axis=1, keepdims=True) * x
    near = 0.955 * x + math.sqrt(1 - 0.955 ** 2) * aside / np.linalg.norm(aside, axis=1, keepdims=True)
    who, row = graph.within(near, 0.95, width)
    assert (np.bincount(who[who == row], minlength=len(x)) > 0).mean() >= 0.98


def test_no_row_or_step_holds_a_shard(spark, monkeypatch):
    """Graphs are kept and sent a row per item, and a dense group leaves a task as rows per item."""
    monkeypatch.setattr(E, "CHUNK", 16)
    seen = {}

    def kept(items, *args, real=E.near_vectors):
        seen["items"] = items
        seen["found"] = real(items, *args)
        return seen["found"]

    monkeypatch.setattr(E, "near_vectors", kept)
    rng = np.random.default_rng(7)
    x = np.vstack([rng.normal(size=(200, 8)), rng.normal(size=8) + 0.005 * rng.normal(size=(600, 8))])
    rows = [(i, [float(v) for v in r], 0) for i, r in enumerate(x.astype(np.float32))]
    got = sorted((tuple(r) for r in E.embedding_dedup(frame(spark, rows)).collect()), key=repr)
    assert got == linked(rows) and max(r[1] for r in got) >= 599
    graphs = E.index(seen["items"])
    assert graphs.count() == 800                            # not one row per shard
    sizes = [F.max(F.length(c)) for c, kind in graphs.dtypes if kind == "binary"]
    assert all(n <= 4 * 4 * 24 for n in graphs.agg(*sizes).head())   # a node's links, of 4 layers at most
    # each of 4 shards tells at most its own rows and the queries, not a part of them for each step
    assert seen["found"].count() <= 4 * 800 + 800


def test_pairs_come_in_bounded_steps(monkeypatch):
    from legworks.llm import hnsw
    monkeypatch.setattr(hnsw, "PAIR_CELLS", 4000)
    monkeypatch.setattr(hnsw, "BEAM_CELLS", 640)
    rng = np.random.default_rng(8)
    x = rng.normal(size=8) + 0.05 * rng.normal(size=(1000, 8))
    x = np.vstack([x, rng.normal(size=(1000, 8))])[rng.permutation(2000)]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(x)
    parts = list(graph.pairs(x[:200], 0.95, 32))
    assert max(len(q) for q, _ in parts) <= 4000
    assert sum(len(q) for q, _ in parts) == len({(a, b) for q, r in parts for a, b in zip(
        q.tolist(), r.tolist(), strict=True)})
    q, r = graph.within(x[:200], 0.95, 32)
    want = x[:200].astype(np.float32) @ graph.x.T >= 0.95
    dense = want.sum(axis=1) > 500
    assert dense.sum() > 50
    found = np.zeros(want.shape, bool)
    found[q, r] = True
    assert (found[dense] == want[dense]).all() and not (found & ~want).any()


def test_graph_layers_and_links():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(900, 8))
    x[100:200] = x[100]                                  # a dense group has ways out of it
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    graph = Graph(x)
    assert [len(a) for a in graph.layers] == [900, 75, 6]
    again = Graph.loads(x, graph.dumps())
    ids, _ = again.search(x, 1)
    assert (np.einsum("ij,ij->i", x[ids[:, 0]], x) > 0.9999).mean() > 0.98
    for links in graph.layers:
        assert all(len(set(r[r >= 0])) == (r >= 0).sum() for r in links)
        assert not (links == np.arange(len(links))[:, None]).any()
    tiny = Graph(x[:1])
    assert tiny.search(x[:2], 5)[0][:, 0].tolist() == [0, 0]


# ------------------------------------------------------------- hard negatives


def mined(rows, is_anchor, positives=5, negatives=5):
    """The contract read pair by pair; repeated rows are rows of their own."""
    known = []
    for vec_id, v, label in rows:
        if label is not None and v is not None and all(
                c is not None and math.isfinite(c) for c in v):
            limit = N.LARGEST
            known.append((vec_id, label, [min(max(math.floor(256 * c), -limit), limit) for c in v]))
    out = []
    for i, (a, label, x) in enumerate(known):
        if not is_anchor(a):
            continue
        scored = [(-sum(p * q for p, q in zip(x, y)), b is None, b or 0, other)  # noqa: B905
                  for j, (b, other, y) in enumerate(known) if j != i]
        scored.sort()
        for s, none, p, _ in [r for r in scored if r[3] == label][:positives]:
            top = [r for r in scored if r[3] != label and -5 * r[0] >= -4 * s and -r[0] <= -s]
            out += [(a, None if none else p, k, None if no else n, -s, -t)
                    for k, (t, no, n, _) in enumerate(top[:negatives], 1)]
    return sorted(out, key=repr)


@pytest.mark.parametrize("small", [False, True])
def test_negatives_equal_all_pairs(spark, monkeypatch, small):
    if small:
        monkeypatch.setattr(N, "BLOCK_ROWS", 7)
        monkeypatch.setattr(N, "GROUP_ROWS", 3)
        monkeypatch.setattr(N, "PAGE_ROWS", 2)
        monkeypatch.setattr(N, "MAX_BROADCAST", 0)
        monkeypatch.setattr(N, "HELD_GROUPS", 1)
    rnd = random.Random(2)
    rows = [(i, [c / 4 for c in v], label) for i, v, label in clustered(3, 150, 8, ((30, 0.2),))]
    # ties, repeated rows (an anchor among them), shorter vectors, huge components, null ids
    rows += [(200 + i, [0.5] * 8, rnd.randrange(4)) for i in range(40)] + [(100, [0.5] * 8, 1)] * 3
    rows += ODD + [(9300, [1e9] * 8, 1), (9400, [0.25] * 5, 2), (None, [0.5] * 8, 2)]
    df = frame(spark, rows).repartition(3)
    out = N.hard_negatives(df, anchor=F.col("vec_id") % 10 == 0)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score",
                           "negative_score"]
    got = sorted((tuple(r) for r in out.collect()), key=repr)
    # vectors pass through single precision
    single = [(i, v if v is None else [c if c is None else float(np.float32(c)) for c in v], label)
              for i, v, label in rows]
    want = mined(single, lambda i: i is not None and i % 10 == 0)
    assert got == want and len(got) > 300


def test_no_rows_or_anchors(spark):
    some = frame(spark, clustered(1, 20, 4, ()))
    assert N.hard_negatives(some, anchor=F.lit(False)).collect() == []
    assert N.hard_negatives(some.where("vec_id < 0"), anchor=F.lit(True)).collect() == []
    assert N.hard_negatives(frame(spark, [(0, [], 1), (10, [], 2)]), anchor=F.lit(True)).collect() == []


def test_curve_visits_every_cell_by_single_steps():
    for dims, bits in ((2, 3), (3, 2), (4, 2)):
        cells = np.array(np.meshgrid(*[np.arange(1 << bits)] * dims)).reshape(dims, -1).T
        keys = N.curve_keys(cells, bits)
        order = np.lexsort(keys.T[::-1])
        walk = cells[order]
        assert len(np.unique(keys, axis=0)) == len(cells)
        assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


def test_bounds_hold_and_skip_blocks(spark):
    rng = np.random.default_rng(8)
    x = rng.integers(-50, 50, (64, 6)).astype(np.int32)
    a = rng.integers(-50, 50, (10, 6)).astype(np.int32)
    least, most = N.bounds(a, x.min(axis=0)[None], x.max(axis=0)[None])
    s = N.scores(a, x)
    assert (least[:, 0] <= s.min(axis=1)).all() and (most[:, 0] >= s.max(axis=1)).all()
    big = np.full((1, 6), N.LARGEST, np.int32)
    assert N.scores(big, big)[0, 0] == 6 * N.LARGEST ** 2


def test_structured_vectors_read_few_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(6)
    centres = rng.normal(size=(20, 6)) * 40
    rows = [(i, [float(v) for v in centres[i % 20] + rng.normal(size=6)], i % 2) for i in range(800)]
    df = spark.createDataFrame(rows, SCHEMA)
    kept = N.staged(N._whole(df, F.col("vec_id") % 40 == 0), "t")
    spread = N._spread(kept)
    blocks = N.write_blocks(kept, 6, spread)
    groups = N._groups(N._anchors(blocks, 6, 5))
    pages = N._pages(blocks)

    def as_good(row, least, most, label_lo, label_hi):
        return most >= N._longs(row["floors"])[:, None]

    plan = N._plan(groups, pages, 6, as_good).collect()
    asked = sum(len(np.frombuffer(r.wanted, np.int32)) for r in plan)
    anchors = sum(len(N._longs(r.ids)) for r in groups.collect())
    assert anchors == 20 and asked < 0.5 * anchors * blocks.count()
