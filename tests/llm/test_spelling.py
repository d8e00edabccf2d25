"""Spelling variants against brute force over a small vocabulary."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings, strategies as st
from messy import messy_docs, no_docs

from legworks.llm import spelling as S


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def brute(rows):
    """The contract read word by word."""
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 5 and k >= 3}
    near = {w: [x for x in n if abs(len(x) - len(w)) < 2 and distance(w, x) == 1] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 2 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w

    return sorted((w, form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None)
                  for w in n)


def sample(seed=3):
    rnd = random.Random(seed)
    base = ["".join(rnd.choice("aeinorstà") for _ in range(rnd.randint(5, 9))) for _ in range(25)]
    words = list(base)
    for w in base:
        for _ in range(rnd.randint(0, 5)):
            p = rnd.randrange(len(w))
            w = w[:p] + rnd.choice(["", "x", "é" + w[p]]) + w[p + 1:]
            words.append(w)
    # a chain of forms
    rows = [(999, " ".join(["kettle"] * 20 + ["kettla"] * 8 + ["kottla"] * 3), "s")]
    for i in range(120):
        text = " ".join(rnd.choice([str.upper, str.title, str])(words[int(rnd.random() ** 2 * len(words))])
                        for _ in range(40))
        rows.append((1000 + i, text + " a1b2 Ünïcödé×÷ß", "s"))
    return rows


def test_words_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(S, "CELL_WORDS", 3)         # buckets of several tries
    monkeypatch.setattr(S, "MAX_BROADCAST", 0)      # joined by shuffle
    monkeypatch.setattr(S, "PIECE", 2)
    monkeypatch.setattr(S, "LEAF_WORDS", 1)
    docs = messy_docs(spark, sample())
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    out = S.spelling_variants(docs)
    assert out.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert sorted(tuple(r) for r in out.collect()) == want
    assert sum(w[1] is not None for w in want) > 20
    assert any(w[1] != w[2] for w in want if w[1])          # chains of forms


def test_more_buckets_find_the_same(spark, monkeypatch):
    docs = spark.createDataFrame([(a, b) for a, b, _ in sample(8)], "doc_id long, text string")
    want = sorted(map(tuple, S.spelling_variants(docs).collect()))
    monkeypatch.setattr(S, "prefix_for", lambda n: S.GROUPS)
    assert sorted(map(tuple, S.spelling_variants(docs).collect())) == want


def test_no_documents(spark):
    assert S.spelling_variants(no_docs(spark)).collect() == []


words = st.text("abcé", min_size=1, max_size=9)


@settings(max_examples=300, deadline=None)
@given(words, words)
def test_one_edit(a, b):
    assert S.one_edit(a, b) == (distance(a, b) == 1)
    if distance(a, b) == 1 and min(len(a), len(b)) >= 5:
        x = S.ends([a, b])
        assert (x[0] == x[1]).any()


@settings(max_examples=60, deadline=None)
@given(st.lists(words, min_size=1, max_size=25, unique=True), st.lists(words, min_size=1, max_size=12))
def test_the_trie_misses_no_word_one_edit_away(own, asked):
    groups = {"a": 0, "b": 1, "c": 2, "é": 5}
    trie = S.Trie(S.count_matrix(own, groups, 6))
    met = {(q, w) for a, b in trie.within(S.count_matrix(asked, groups, 6))
           for q, w in zip(a.tolist(), b.tolist(), strict=True)}
    for i, a in enumerate(asked):
        for j, b in enumerate(own):
            more = Counter(a) - Counter(b)
            less = Counter(b) - Counter(a)
            assert ((i, j) in met) == (more.total() <= 1 and less.total() <= 1)


def test_words_one_edit_apart_meet_in_a_bucket():
    rnd = random.Random(5)
    groups = {c: i % S.GROUPS for i, c in enumerate("abcdefghijklmnop")}
    for prefix in (3, 5, 8):
        moves = {tuple(m) for m in S.steps(prefix).tolist()}
        for _ in range(300):
            a = "".join(rnd.choice("abcdefghijklmnop") for _ in range(rnd.randint(5, 10)))
            p = rnd.randrange(len(a))
            b = a[:p] + rnd.choice(["", "k", "b" + a[p]]) + a[p + 1:]
            keys = np.column_stack([[len(a), len(b)],
                                    S.count_matrix([a, b], groups, S.GROUPS)[:, :prefix]])
            step = tuple((keys[1] - keys[0]).tolist())
            back = tuple((keys[0] - keys[1]).tolist())
            assert not any(step) or step in moves or back in moves
