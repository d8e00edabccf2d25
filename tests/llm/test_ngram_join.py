"""Chosen-path join against brute force over all pairs."""

import random
from itertools import combinations

import numpy as np
import pytest
from messy import messy_docs, no_docs

from legworks.llm import links, ngram_join as J


def words_of(text):
    return (text or "").encode().split()


def shingle_set(text):
    w = words_of(text)
    return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def brute(rows):
    """(doc_id, text) -> (class, links to other texts)."""
    texts = sorted({t or "" for _, t in rows})
    sets = {t: shingle_set(t) for t in texts}
    near = {t: set() for t in texts}
    for a, b in combinations(texts, 2):
        x, y = sets[a], sets[b]
        if x and y and 5 * len(x & y) >= 4 * len(x | y):
            near[a].add(b)
            near[b].add(a)
    ids = {t: [i for i, u in rows if (u or "") == t] for t in texts}
    out = {}
    for t in texts:
        seen, todo = {t}, [t]
        while todo:
            for u in near[todo.pop()] - seen:
                seen.add(u)
                todo.append(u)
        known = [i for u in seen for i in ids[u] if i is not None]
        out[t] = (min(known) if known else None, len(near[t]))
    return {(i, t): out[t or ""] if sets[t or ""] else (i, 0) for i, t in rows}


def corpus(seed, groups, members):
    rnd = random.Random(seed)
    rows, n = [], 100
    shared = " ".join(f"common{i}" for i in range(12))
    for g in range(groups):
        base = [f"g{g}w{rnd.randint(0, 400)}" for _ in range(rnd.choice([30, 80, 160]))]
        for _ in range(members):
            w = list(base)
            for _ in range(rnd.randint(0, 4)):
                w[rnd.randrange(len(w))] = f"new{rnd.randint(0, 9999)}"
            if rnd.random() < 0.3:
                w += shared.split()
            rows.append((n, " ".join(w)))
            n += 1
    return rows + [(n + 1, rows[0][1]), (n + 2, "  " + rows[0][1].replace(" ", "\n"))]


@pytest.mark.parametrize("small,cell", [(2500, 1000), (6, 5)])
def test_classes_and_links_equal_brute_force(spark, monkeypatch, small, cell):
    monkeypatch.setattr(J, "SMALL", small)         # the second case splits and deals in blocks
    monkeypatch.setattr(J, "CELL_ROWS", cell)
    if small < 100:
        monkeypatch.setattr(J, "MAX_BROADCAST", 0)  # and joins by shuffle
    rows = corpus(3, 8, 14)
    docs = messy_docs(spark, [(i, t, "s") for i, t in rows])
    got = J.classes(docs, recall=0.9999).drop("size")
    texts = {(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()}
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    out = J.ngram_join(docs, recall=0.9999).collect()
    assert len(out) == docs.count()
    assert sorted((str(r.doc_id), str(r.class_id), r.n_links) for r in out) == sorted(
        (str(i), str(want[i, t][0]), want[i, t][1]) for i, t in
        [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert got.columns == ["doc_id", "digest", "class_id", "n_links"] and texts


def test_one_document_of_each_class_stays(spark):
    rows = corpus(5, 4, 6)
    docs = messy_docs(spark, [(i, t, "s") for i, t in rows])
    kept = J.first_of_class(docs)
    assert kept.columns == docs.columns
    want = brute([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    expect = sorted({(str(i), t) for (i, t), (c, _) in want.items()
                     if i == c or not words_of(t)}, key=str)
    got = sorted(((str(r.doc_id), r.text) for r in kept.select("doc_id", "text").collect()),
                 key=str)
    assert got == expect


def test_classes_with_equal_or_null_ids_are_apart(spark):
    long = " ".join(f"word{i}" for i in range(60))
    rows = [(1, "A text"), (1, "B text"), (2, "B  text"), (None, "C text"), (None, "D text"),
            (None, "D text"), (None, long), (3, long + " more"), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((str(r.doc_id), r.text) for r in J.first_of_class(docs).collect()))
    assert got == sorted([("1", "A text"), ("1", "B text"), ("None", "C text"), ("None", "D text"),
                          ("3", long + " more"), ("None", "")])


def test_no_documents(spark):
    assert J.ngram_join(no_docs(spark)).collect() == []
    assert J.first_of_class(no_docs(spark)).collect() == []


def test_runs_follow_recall():
    assert J.runs_for(0.999, 3) > J.runs_for(0.9, 3) > J.runs_for(0.9, 1)
    rnd = np.random.default_rng(1)
    found, runs = 0, J.runs_for(0.9, 1)
    for _ in range(300):           # pairs just at the threshold, one level
        tokens = np.unique(rnd.integers(0, 2 ** 63, 180).astype(np.uint64))
        a, b = tokens[:90], np.unique(np.concatenate([tokens[10:90], tokens[90:100]]))
        pa, pb = (set(J.chosen_paths(np.sort(x), runs, 1)[0][1]) for x in (a, b))
        found += bool(pa & pb)
    assert found >= 0.87 * 300


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    got = {r.node: r.root for r in links.components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}}
