"""The factorization machine and the personal data operator."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from messy import messy_docs, no_docs
from pyspark.sql import functions as F

from legworks.llm import pii as P, toxicity as X


def logits(machine, texts):
    place = {int(t): i for i, t in enumerate(machine.terms)}
    return machine.logits(np.array(sorted({place[int(h)] for h in X.doc_terms(t)
                                           if int(h) in place}), np.int64) for t in texts)


def pair_texts(n, seed):
    """Toxic only if an insult meets a group; either alone is harmless."""
    rnd = random.Random(seed)
    texts, y = [], []
    for _ in range(n):
        insult, group = rnd.random() < 0.5, rnd.random() < 0.5
        words = [f"filler{rnd.randint(0, 60)}" for _ in range(12)]
        words += ["vermin"] * insult + ["settlers"] * group
        rnd.shuffle(words)
        texts.append(" ".join(words))
        y.append(float(insult and group))
    return texts, np.array(y)


def test_machine_learns_an_interaction():
    texts, y = pair_texts(1500, 1)
    machine = X.fit_machine([X.doc_terms(t) for t in texts], y)
    held, truth = pair_texts(500, 2)
    z = logits(machine, held)
    assert ((z > 0) == (truth == 1)).mean() > 0.97
    both, one, other, none = logits(machine, ["vermin settlers", "vermin", "settlers", "plain"])
    assert both > 0.85 and max(one, other, none) < 0
    # no additive score separates the four cases by such a margin at a threshold of 0.7
    assert both - one - other + none > 1


def test_machine_without_two_kinds_of_labels():
    for y in ([], [0.0, 0.0], [1.0]):
        m = X.fit_machine([X.doc_terms("some words")] * len(y), np.array(y))
        assert len(m.terms) == 0
    assert X.fit_machine([], np.array([])).bias < 0


def test_scores_of_documents(spark):
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(10, 400):
        toxic = rnd.random() < 0.3
        words = [f"w{rnd.randint(0, 300)}" for _ in range(30)] + ["scumbag", "moronic"] * toxic
        rows.append((i, " ".join(words), "s"))
        labels.append((i, int(toxic)))
    labels += [(10, labels[0][1]), (None, 1), (11, None), (99999, 1)]
    docs = messy_docs(spark, rows)
    lab = spark.createDataFrame(labels, "doc_id long, toxic int")
    out = X.toxicity(docs, lab).collect()
    assert len(out) == docs.count()
    truth = {i: y for i, y in labels if i and y is not None}
    for r in out:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.7)
        fold = zlib.crc32(str(r.doc_id).encode()) % 3 == 1 if r.doc_id is not None else False
        assert r.held_out == fold
        if r.doc_id in truth:
            assert r.predicted == truth[r.doc_id]
        else:
            assert r.predicted == 0          # null, empty, long and other texts
    # labels of the held-out fold teach nothing
    flipped = lab.withColumn("toxic", F.when(X.is_held_out(F.col("doc_id")), 1 - F.col("toxic"))
                             .otherwise(F.col("toxic")))
    again = {r.doc_id: r.score for r in X.toxicity(docs, flipped).collect()}
    assert all(again[r.doc_id] == pytest.approx(r.score) for r in out)
    kept = X.drop_toxic(docs, lab)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.predicted == 0 for r in out)
    assert X.toxicity(no_docs(spark), lab).collect() == []
    assert all(r.predicted == 0 for r in X.toxicity(docs, lab.where("toxic = 9")).collect())


PATTERNS = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
            "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+",
            "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def passes(kind, match):
    d = re.sub("[^0-9]", "", match)
    if kind == "ip":
        return all(int(x) <= 255 for x in match.split("."))
    if kind == "card":
        doubled = [int(c) * (1 + i % 2) for i, c in enumerate(reversed(d))]
        return 14 <= len(d) <= 19 and sum(v % 10 + v // 10 for v in doubled) % 10 == 0
    return kind == "email" or 10 <= len(d) <= 15


def base_spans(text):
    return sorted((m.start(), n, f"{kind}:{m.start()}:{m.end()}")
                  for n, (kind, p) in enumerate(PATTERNS.items())
                  for m in re.finditer(p, text or "") if passes(kind, m.group()))


TRICKY = [
    "mail a.b@c.d-e.org_x@y.zz, @no.pe and a@b and x@y..z or 🙂 q@w.e.",
    "1.2.3.4.5.6.7.8 and 256.1.1.1 or 0.0.0.255 0001.2.3.4 1.2.3 9.9.9.9",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 378282246310005 5-5 12  34 00000000000000",
    "+1 (555) 010-9999 then +12 and +4930123456 7890123456 +(1) ++1 22 333 4444 5",
    "é漢🙂 4111111111111111 at 10.0.0.1 by z@z.zz +49 30 1234567\nnext 4111111111111111",
    "7 " * 30_000, "1" * 20_000, "a@" * 5000 + "b.c", "x" * 50_000 + "@y.org",
]


def planted(n):
    rnd = random.Random(6)
    rows = []
    for i in range(n):
        d = [rnd.randint(0, 9) for _ in range(15)]
        total = sum((v * 2 - 9 if v > 4 else v * 2) if k % 2 == 0 else v for k, v in enumerate(d))
        card = "".join(map(str, d)) + str(-total % 10)
        rows.append((1000 + i, f"call +1 ({rnd.randint(200, 999)}) {rnd.randint(200, 999)}-"
                               f"{rnd.randint(1000, 9999)} or mail u{i}.x@host{i % 9}.example.com "
                               f"card {card} from 10.{i % 256}.3.{i % 99}", "s"))
    return rows


def test_base_spans_equal_plain_reading(spark):
    rows = [(100 + i, t, "s") for i, t in enumerate(TRICKY)] + planted(120)
    docs = messy_docs(spark, [*rows, (2000, "write to jane.doe (at) mail [dot] org today", "s"),
                              (2001, "on 2024-01-02 we sold 12 of 3456", "s")])
    out = P.pii(docs).collect()
    assert len(out) == docs.count()
    texts = {r.doc_id: r.text for r in docs.select("doc_id", "text").collect()}
    by = {r.doc_id: r for r in out}
    for r in out:
        spans = base_spans(texts[r.doc_id])
        listed = ",".join(s for *_, s in spans)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        for n, kind in enumerate(PATTERNS):
            assert r[f"n_{kind}"] == sum(s[1] == n for s in spans)
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))
    assert by[2000].spans == "email:9:37"      # the trees add an address in disguise
    assert by[2001].spans == ""                # and leave dates and counts alone


def added(n, seed=12):
    """Texts with spans that the base patterns miss, and the spans: (text, {kind:start:end})."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        area, mid, last = rnd.randint(200, 999), rnd.randint(200, 999), rnd.randint(1000, 9999)
        plain = rnd.choice([f"1 ({area}) {mid}-{last}", f"1.{area}.{mid}.{last}", f"1-{area}-{mid}-{last}"])
        wanted = {"phone": [plain], "email": [], "card": []}
        text = f"please call {plain} about it"
        if i % 4 == 0:                 # the base pattern's match runs on into an address
            number = f"+1 ({area}) {mid}-{last}"
            text, wanted["phone"] = f"call {number} 190.{i % 200}.223.204 today", [number]
        elif i % 4 == 1:               # two neighbours
            other = f"1 ({mid}) {area}-{last}"
            text, wanted["phone"] = f"phone {plain} {other} now", [plain, other]
        elif i % 4 == 2:
            name = f"u{i}.x [at] host{i % 9} [dot] example [dot] com"
            text += f" or mail {name} instead"
            wanted["email"] = [name]
        spans = {f"{k}:{text.index(x)}:{text.index(x) + len(x)}" for k, v in wanted.items() for x in v}
        out.append((text, spans))
    return out


CLEAN = ["on 2024-01-02 we sold 12 of 3456 pieces", "see pages 12 34 and 56 of the 1999 report",
         "between 10 20 30 and 40 50 60 of them", "version 1.2.3 of 2021-11-30 10:15", "7 8 9 10 11",
         "a table: 1.5 2.5 3.5 4.5 and 100 200 300"]


def test_added_spans_are_precise_and_found(spark):
    cases = added(80)
    docs = spark.createDataFrame(
        [(i, t) for i, t, _ in planted(400)] + [(5000 + i, t) for i, (t, _) in enumerate(cases)]
        + [(7000 + i, f"{t}, and so on {i}") for i, t in enumerate(CLEAN * 10)],
        "doc_id long, text string")
    out = {r.doc_id: set(r.spans.split(",")) - {""} for r in P.pii(docs).collect()}
    for kind in ("phone", "email"):
        want = {(i, s) for i, (_, spans) in enumerate(cases) for s in spans if s.startswith(kind)}
        base = {(i, s[2]) for i, (t, _) in enumerate(cases) for s in base_spans(t)}
        got = {(i, s) for i in range(len(cases)) for s in out[5000 + i]
               if s.startswith(kind)} - base
        assert not want & base
        precision, recall = len(got & want) / max(1, len(got)), len(got & want) / len(want)
        print(f"added {kind}: {len(want)} planted, precision {precision:.2f}, recall {recall:.2f}")
        assert precision >= 0.8 and recall >= 0.8, (sorted(got - want)[:5], sorted(want - got)[:5])
    assert [s for i in range(len(CLEAN) * 10) for s in out[7000 + i]] == []


def test_proposals_overlap_and_are_settled(spark):
    text = "+1 (826) 555-4081 190.137.223.204 4111 1111 1111 1111"
    runs = P.candidates(spark.createDataFrame([(1, text)], "doc_id long, text string")).where("gen = 'number'")
    spans = P.sub_spans(runs).collect()
    cut = {(r.kind, text[r.start:r.end]) for r in spans}
    assert {("phone", "+1 (826) 555-4081"), ("card", "4111 1111 1111 1111"),
            ("phone", "(826) 555-4081")} <= cut
    assert all(r.raw == text[r.start:r.end] and text[:r.start].endswith(r.before[-5:])
               and text[r.end:].startswith(r.after) for r in spans)
    assert all(7 <= sum(c.isdigit() for c in r.raw) <= 19 for r in spans)
    scored = [(1, 1, 0, "phone", 0, 10, 0.9), (1, 1, 1, "phone", 5, 15, 0.95), (1, 1, 2, "card", 12, 20, 0.5),
              (1, 1, 3, "phone", 16, 30, 0.4), (1, 1, 9, "phone", 50, 60, 0.1), (2, 1, 0, "phone", 0, 10, 0.2)]
    df = spark.createDataFrame(scored, "row long, run int, pos int, kind string, start int, end int, p double")
    kept = {(r.row, r.start) for r in P.settled(df).collect()}
    # the best; what it leaves: the likelier of the rest; and what overlaps nothing
    assert kept == {(1, 5), (1, 16), (1, 50), (2, 0)}


def one_by_one(spans):
    """Proposals taken from the best on, where none taken before overlaps: (row, kind, start, end)."""
    taken = []
    for row, run, kind, start, end, _ in sorted(spans, reverse=True, key=lambda s: (
            s[5], s[4] - s[3], -s[3], s[2])):
        if not any((row, run) == t[:2] and t[3] < end and start < t[4] for t in taken):
            taken.append((row, run, kind, start, end))
    return sorted((row, kind, start, end) for row, _, kind, start, end in taken)


@pytest.mark.parametrize("stretch", [16_384, 64])
def test_chains_of_proposals_are_settled_to_the_end(spark, monkeypatch, stretch):
    monkeypatch.setattr(P, "STRETCH", stretch, raising=False)
    # each overlaps the one before it, which is better: every other one stays
    spans = [(1, 0, "phone", 8 * i, 8 * i + 10, 0.99 - i / 100) for i in range(7)]
    spans += [(2, 5, "phone", 5 + 8 * i, 15 + 8 * i, 0.9) for i in range(60)]         # by ties
    spans += [(3, 0, "phone", 8 * i, 8 * i + 10, 0.5 + i / 1000) for i in range(60)]  # from the right
    rnd = random.Random(4)
    for row in range(4, 8):
        spans += [(row, 30, kind, at, at + rnd.randint(7, 24), rnd.randint(5, 9) / 10)
                  for at in range(30, 900, 3) for kind in rnd.sample(["phone", "card"], rnd.randint(1, 2))]
    spans += [(8, 0, "email", 0, 400, 0.8), (8, 0, "phone", 395, 410, 0.7), (8, 0, "card", 405, 425, 0.6)]
    df = spark.createDataFrame(
        [(*s, 0) for s in spans], "row long, run int, kind string, start int, end int, p double, pos int")
    out = P.settled(df)
    assert out.columns == df.columns
    got = sorted((r.row, r.kind, r.start, r.end) for r in out.collect())
    assert got == one_by_one(spans)
    assert [r[2] // 8 for r in got if r[0] == 1] == [0, 2, 4, 6]
    assert P.settled(df.where("row < 0")).collect() == []


def test_no_personal_data(spark):
    plain = spark.createDataFrame([(1, "nothing here"), (2, None)], "doc_id long, text string")
    assert [(r.spans, r.n_card) for r in P.pii(plain).collect()] == [("", 0)] * 2
    assert P.pii(no_docs(spark)).collect() == []


def test_trees_learn_from_all_base_spans(spark):
    # more matches than a bounded draw would take; equal ones are one weighted example
    n = 30_000
    spans = spark.range(n).select(
        F.col("id").alias("row"), F.col("id").alias("doc_id"), F.lit("ip").alias("kind"),
        F.concat(F.lit("10.0."), F.col("id") % 7, F.lit("."), F.col("id") % 5).alias("raw"),
        F.lit(0).alias("start"), F.lit(8).alias("end"), F.lit("at ").alias("before"),
        F.concat(F.lit(" x"), F.col("id").cast("string")).alias("after"), F.lit("ip").alias("gen"),
        F.when(F.col("id") != 5, True).otherwise(False).alias("base_ok"))
    rows = P.examples(spans)
    by = {(r.label, r.kept): r.n for r in rows.groupBy("label", "kept").agg(
        F.sum("n").alias("n")).collect()}
    assert by[1.0, True] + by[1.0, False] == n - 1
    assert by[0.0, True] + by[0.0, False] == n           # each valid one broken, and the failing one
    assert 0.25 < by[1.0, True] / n < 0.35
    assert rows.count() < 200
    none = spans.where("base_ok IS NULL")
    assert P.fit(none) is None
