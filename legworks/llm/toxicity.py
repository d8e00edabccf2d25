"""Toxicity scores by a factorization machine over hashed terms."""

from __future__ import annotations

import zlib
from collections.abc import Iterable
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from legworks.llm.common import sample_by_hash, text_or_empty
from legworks.llm.decontaminate import words_of

HASH_BITS = 18
PREFIXES = (4, 5)          # of a word's characters; the word itself is a term, too
MAX_TRAIN = 12_000         # labelled rows that the model is fitted on, by hash of doc_id
PRIOR = 3.0                # documents of either kind that every term is taken to be in besides
MAX_TERMS = 8192           # hashed terms in the model, by association with the label
MIN_CHI2, MIN_DOCS, ROWS_A_DOC = 20.0, 3, 2000   # so high that few of all hashed terms pass by chance
FACTORS = 8
BATCH, STEPS, RATE, DECAY = 256, 1500, 0.02, 1e-2
THRESHOLD = 0.7
SEED = 11
FOLDS, HELD_OUT = 3, 1     # fixed by the contract: rows of this remainder are never learnt from


def terms_of(word: bytes) -> list[int]:
    mask = (1 << HASH_BITS) - 1
    chars = word.decode("utf-8", "replace")
    return [zlib.crc32(b"w" + word) & mask,
            *(zlib.crc32(b"p%d" % n + chars[:n].encode()) & mask for n in PREFIXES)]


def doc_terms(text: str | None) -> np.ndarray:
    return np.unique(np.fromiter((t for w in set(words_of(text)) for t in terms_of(w)), np.int32))


@dataclass
class Machine:
    """score = sigmoid(bias + sum w_i + sum_{i<j} <v_i, v_j>) over the active terms of a text."""

    bias: float
    terms: np.ndarray      # hashed terms, sorted
    w: np.ndarray
    v: np.ndarray

    def logits(self, rows: Iterable[np.ndarray]) -> np.ndarray:
        """``rows``: positions in ``terms`` of each text's active terms."""
        out = []
        for at in rows:
            v = self.v[at]
            out.append(self.bias + self.w[at].sum()
                       + 0.5 * ((v.sum(axis=0) ** 2).sum() - (v * v).sum()))
        return np.array(out)


def fit_machine(docs: list[np.ndarray], y: np.ndarray) -> Machine:
    """Adam on the log loss in mini-batches; terms chosen by chi-square on the same rows,
    where rows of the same terms and label count once, so that copies don't vote; linear weights started at half their log odds, or 0 for terms of clean texts."""
    once = {(d.tobytes(), label): i for i, (d, label) in enumerate(zip(docs, y, strict=True))}
    docs, y = [docs[i] for i in once.values()], y[list(once.values())]
    n, toxic = len(y), float(y.sum())
    base = (toxic + 0.5) / (n + 1.0) if n else 0.1
    bias = float(np.log(base / (1 - base)))
    empty = Machine(bias, np.zeros(0, np.int32), np.zeros(0), np.zeros((0, FACTORS)))
    if not 0 < toxic < n:
        return empty
    size = 1 << HASH_BITS
    df = np.zeros(size)
    hits = np.zeros(size)
    for terms, label in zip(docs, y, strict=True):
        df[terms] += 1
        hits[terms] += label
    with np.errstate(divide="ignore", invalid="ignore"):
        chi2 = n * (hits * n - df * toxic) ** 2 / (df * (n - df) * toxic * (n - toxic))
    chi2[(df < max(MIN_DOCS, n // ROWS_A_DOC)) | ~np.isfinite(chi2)] = 0
    best = np.argsort(-chi2, kind="stable")[:MAX_TERMS]
    terms = np.sort(best[chi2[best] >= MIN_CHI2]).astype(np.int32)
    if not len(terms):
        return empty
    place = np.full(size, -1, np.int32)
    place[terms] = np.arange(len(terms))
    rows = [p[p >= 0] for p in (place[d] for d in docs)]

    rng = np.random.default_rng(SEED)
    k = len(terms)
    params = np.zeros((k, FACTORS + 1))
    params[:, 0] = 0.5 * np.maximum(0, np.log(
        (hits[terms] + PRIOR) / (toxic + 1)
        / ((df[terms] - hits[terms] + PRIOR) / (n - toxic + 1))))
    params[:, 1:] = rng.normal(0, 0.05, (k, FACTORS))
    first, second = np.zeros_like(params), np.zeros_like(params)
    order = rng.permutation(n)
    for step in range(1, STEPS + 1):
        at = (step - 1) * BATCH % n
        batch = order[np.arange(at, at + min(BATCH, n)) % n]
        nth = np.repeat(np.arange(len(batch)), [len(rows[b]) for b in batch])
        idx = np.concatenate([rows[b] for b in batch])
        w, v = params[idx, 0], params[idx, 1:]
        total = np.zeros((len(batch), FACTORS))
        np.add.at(total, nth, v)
        z = (bias + np.bincount(nth, w, len(batch))
             + 0.5 * ((total ** 2).sum(1) - np.bincount(nth, (v * v).sum(1), len(batch))))
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[batch]) / len(batch)
        grad = np.zeros_like(params)
        np.add.at(grad, idx, g[nth, None] * np.hstack([np.ones((len(idx), 1)), total[nth] - v]))
        bias -= RATE * g.sum()
        first = 0.9 * first + 0.1 * grad
        second = 0.999 * second + 0.001 * grad * grad
        # weights decay by themselves: as a part of the gradient, the decay would be scaled up
        # to full steps wherever the loss has none left
        params -= RATE * ((first / (1 - 0.9 ** step))
                          / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8) + DECAY * params)
    return Machine(float(bias), terms, params[:, 0], params[:, 1:])


def is_held_out(doc_id: Column) -> Column:
    """Rows that the contract keeps out of training; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame) -> Machine:
    """Fit on at most ``MAX_TRAIN`` labelled rows outside the held-out fold.

    The rows with the smallest hashes of doc_id are taken.  A row without doc_id
    or label teaches nothing; of several labels of an id the largest counts, of
    several texts the one with the smallest digest.  The terms of the chosen rows
    (bounded by ``MAX_TRAIN``) meet in one task, and only the model goes
    to the driver.
    """
    known = labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()
                         & ~is_held_out(F.col("doc_id")))
    chosen = sample_by_hash(known.groupBy("doc_id").agg(F.max("toxic").alias("toxic")),
                            ["doc_id"], MAX_TRAIN)
    texts = (docs.select("doc_id", text_or_empty().alias("text"))
             .join(F.broadcast(chosen), "doc_id"))  # MAX_TRAIN rows at most

    def terms(batches):
        for batch in batches:
            text = batch.column("text").to_pylist()
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "toxic": batch.column("toxic"),
                "terms": pa.array([doc_terms(t).tobytes() for t in text], pa.binary())})

    def fit(batches):
        rows, y = [], []
        for batch in batches:
            rows += [np.frombuffer(t, np.int32) for t in batch.column("terms").to_pylist()]
            y += batch.column("toxic").to_pylist()
        m = fit_machine(rows, np.array([float(v > 0) for v in y]))
        yield pa.RecordBatch.from_pydict(
            {"bias": [m.bias], "terms": [m.terms.tobytes()],
             "w": [m.w.astype(np.float64).tobytes()], "v": [m.v.astype(np.float64).tobytes()]},
            schema=pa.schema([("bias", pa.float64()), ("terms", pa.binary()),
                              ("w", pa.binary()), ("v", pa.binary())]))

    sample = (texts.select("doc_id", F.col("toxic").cast("int"), "text")
              .mapInArrow(terms, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, "
                                 "toxic int, terms binary")
              .groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("terms").alias("terms"))
              .repartition(1).sortWithinPartitions(F.xxhash64("doc_id"), "doc_id")
              .select("toxic", "terms"))
    row = sample.mapInArrow(fit, "bias double, terms binary, w binary, v binary").head()
    if row is None:  # no row to learn from
        return fit_machine([], np.zeros(0))
    return Machine(row.bias, np.frombuffer(row.terms, np.int32), np.frombuffer(row.w),
                   np.frombuffer(row.v).reshape(-1, FACTORS))


def score(text: Column, machine: Machine, spark) -> Column:
    """Score of a text, 0 to 1; null and empty texts score the model's bias alone."""
    shared = spark.sparkContext.broadcast(machine)  # MAX_TERMS terms at most
    known: dict[bytes, tuple[int, ...]] = {}

    @F.pandas_udf("double")
    def scores(texts: pd.Series) -> pd.Series:
        m = shared.value
        place = {int(t): i for i, t in enumerate(m.terms)}

        def active(t):
            found: set[int] = set()
            for w in set(words_of(t)):
                at = known.get(w)
                if at is None:
                    if len(known) > 100_000:
                        known.clear()
                    at = known[w] = tuple(place[h] for h in terms_of(w) if h in place)
                if at:
                    found.update(at)
            return np.array(sorted(found), np.int64)

        z = m.logits(active(t) for t in texts)
        return pd.Series(1 / (1 + np.exp(-np.clip(z, -30, 30))))

    return scores(F.coalesce(text.cast("string"), F.lit("")))


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every document: doc_id, held_out, score, predicted (score >= 0.7).

    Only the text is an input of the score.  Null and empty texts get the base
    score.  Equal texts get equal scores; repeated rows stay.  No labels, or
    labels of one kind only, give every text the base rate, which predicts 0.
    An empty table gives no rows.  Columns other than doc_id and text are ignored.
    """
    machine = train(docs, labels)
    scored = docs.select("doc_id", is_held_out(F.col("doc_id")).alias("held_out"),
                         score(F.col("text"), machine, docs.sparkSession).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the model does not call toxic, with all their columns."""
    machine = train(docs, labels)
    return docs.where(score(F.col("text"), machine, docs.sparkSession) < THRESHOLD)
