"""Quality rules with verdicts on hosts: rule failures by host, shrunk by a beta prior."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from legworks.llm.common import map_rows, small_side, staged

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
MAX_SYMBOLS_PER_WORD = 0.5
MAX_DUP_LINES_PERCENT = 50
HOST_LIMIT = 0.75          # a host goes if a shrunk failure rate is above this
MAX_STRENGTH = 1000.0      # of the prior, in documents
MAX_HOSTS_BROADCAST = 100_000
RULES = ("short", "repeats", "symbols", "dup_lines")

BASE = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
    T.StructField("n_words", T.LongType()), T.StructField("word_chars", T.LongType()),
    T.StructField("n_symbols", T.LongType()), T.StructField("n_lines", T.LongType()),
    T.StructField("n_dup_lines", T.LongType()), T.StructField("n_repeat_words", T.LongType())])


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three words which the list has twice or more."""
    if len(words) < 4:
        return 0
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    pairs = ids[:-1] * len(seen) + ids[1:]
    if len(seen) > 2_000_000:  # keep the product of three below 2 ** 63
        pairs = np.unique(pairs, return_inverse=True)[1]
    _, inverse, counts = np.unique(pairs[:-1] * len(seen) + ids[2:], return_inverse=True,
                                   return_counts=True)
    again = counts[inverse] > 1
    if not again.any():
        return 0
    covered = np.zeros(len(words), bool)
    for shift in range(3):
        covered[shift:len(words) - 2 + shift] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, int, int, int, int, int]:
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at the six ASCII white-space characters only
    lines = [x for x in raw.split(b"\n") if x.strip()]
    letters = b"".join(words)
    return (len(words), len(letters.decode("utf-8", "surrogatepass")),
            len(raw) - len(raw.translate(None, SYMBOLS)),
            len(lines), len(lines) - len(set(lines)), repeated_words(words))


def base_rules(docs: DataFrame) -> DataFrame:
    def per_batch(cols):
        rows = [measure(t) for t in cols["text"]]
        out = dict(zip(BASE.names[2:], zip(*rows, strict=True), strict=True)) if rows else {}
        return {"doc_id": cols["doc_id"], "source": cols["source"],
                **{k: list(out.get(k, ())) for k in BASE.names[2:]}}

    narrow = docs.select(F.col("doc_id").cast("long"), F.col("source").cast("string"),
                         F.col("text").cast("string"))
    n = F.col("n_words")
    return (map_rows(narrow, per_batch, BASE)
            .withColumn("short", n < MIN_WORDS)
            .withColumn("repeats", 100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n)
            .withColumn("symbols", F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n)
            .withColumn("dup_lines",
                        100 * F.col("n_dup_lines") > MAX_DUP_LINES_PERCENT * F.col("n_lines")))


def host_verdicts(base: DataFrame) -> DataFrame:
    """Per host: documents, shrunk failure rate of each rule, host_failed.

    The prior of each rule is a beta law fitted to all hosts by its moments: its
    mean is the failure rate of all documents, its strength follows from the
    variance between hosts beyond what counting alone makes.
    """
    hosts = base.groupBy("source").agg(
        F.count("*").alias("host_docs"),
        *[F.count_if(F.col(r)).alias(f"k_{r}") for r in RULES])
    n = F.col("host_docs")
    moments = hosts.agg(
        F.avg(1 / n).alias("inverse"),
        *[(F.sum(f"k_{r}") / F.sum(n)).alias(f"m_{r}") for r in RULES],
        *[F.var_pop(F.col(f"k_{r}") / n).alias(f"v_{r}") for r in RULES])
    out = hosts.join(F.broadcast(moments))  # a single row
    for r in RULES:
        m, noise = F.col(f"m_{r}"), F.col(f"m_{r}") * (1 - F.col(f"m_{r}"))
        between = F.col(f"v_{r}") - noise * F.col("inverse")
        strength = F.when(between > noise / (MAX_STRENGTH + 1),
                          F.greatest(noise / between - 1, F.lit(1.0))).otherwise(MAX_STRENGTH)
        out = out.withColumn(f"rate_{r}",
                             (F.col(f"k_{r}") + m * strength) / (n + strength))
    worst = F.greatest(*[F.col(f"rate_{r}") for r in RULES])
    return out.select("source", "host_docs", *[f"rate_{r}" for r in RULES],
                      (worst > HOST_LIMIT).alias("host_failed"))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Rules on documents, verdicts on hosts (``source``), joined back to the documents.

    One pass in Python measures each whole text; what follows runs on the
    narrow measures.  A null text has no words (all measures 0) and fails as
    short; a null source is a host of its own.  Repeated rows count as often as
    they occur.  An empty table gives no rows.  Columns other than doc_id, text
    and source are ignored.

    Returns doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    base_failed, host_docs, host_failed and kept.
    """
    base = staged(base_rules(docs), "host-base")
    hosts = small_side(staged(host_verdicts(base), "hosts")
                       .withColumnRenamed("source", "host"), MAX_HOSTS_BROADCAST)
    failed = F.col("short") | F.col("repeats")
    return (base.join(hosts, base["source"].eqNullSafe(hosts["host"]))
            .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                    "n_repeat_words", failed.alias("base_failed"), "host_docs", "host_failed",
                    (~failed & ~F.col("host_failed")).alias("kept")))
