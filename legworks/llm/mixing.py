"""Mixing sources to target weights by weighted sampling with exponential keys."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legworks.llm.common import WORD, small_side, staged, text_or_empty

# Fixed values of the query: source weights (repeating), share of all words, most epochs.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_EPOCHS = 2
SYMBOLS = r"[0-9#*$%&|<>{}=_~^@\\/+]"
BUCKET_ROWS = 2_000       # rows that one sort of the sampling order should hold, about
MAX_SOURCES_BROADCAST = 100_000


def size_of(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def quality(text: Column) -> Column:
    """1 for plain prose, less the larger the share of digits and symbols; never 0."""
    marks = F.regexp_count(text, F.lit(SYMBOLS))
    return F.lit(1.0) / (F.lit(1.0) + F.lit(20.0) * marks / (F.length(text) + F.lit(1)))


def keyed(docs: DataFrame, seed: int) -> DataFrame:
    """``docs`` with size, and the sampling key: an exponential variate over the quality.

    The variate comes from a digest of seed, id and text, so that reruns agree.
    ``mix_source`` is a non-null form of the source, ``mix_tie`` orders equal keys.
    """
    text = text_or_empty()
    tie = F.md5(F.concat_ws(":", F.lit(str(seed)),
                            F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                            F.md5(text)))
    u = (F.conv(F.substring(tie, 1, 13), 16, 10).cast("long") + F.lit(0.5)) / F.lit(float(2 ** 52))
    return docs.select(
        "*", size_of(text).alias("mix_size"),
        F.when(F.col("source").isNull(), "n").otherwise(F.concat(F.lit("s"), "source"))
        .alias("mix_source"),
        tie.alias("mix_tie"), (-F.log(u) / quality(text)).alias("mix_key"))


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE,
                   max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``sizes`` (a row per source: source, source_size) with the target of each.

    Weights go round in code point order, null last.  ``share`` of all words is
    split by weight; a target stops at ``max_epochs`` times the source's size and
    the excess is shared again.  That is a water level: sources sorted by
    limit over weight are at their limit up to the first that the level covers.
    """
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    ranked = (sizes.withColumn("weight", F.element_at(
        F.array(*[F.lit(float(w)) for w in weights]), (nth % len(weights) + 1).cast("int")))
        .withColumn("most", (F.col("source_size") * max_epochs).cast("double")))
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    before = (Window.orderBy((F.col("most") / F.col("weight")), F.col("source").asc_nulls_last())
              .rowsBetween(Window.unboundedPreceding, -1))
    left = (ranked
            .withColumn("words", F.sum("source_size").over(everything) * F.lit(share)
                        - F.coalesce(F.sum("most").over(before), F.lit(0.0)))
            .withColumn("weights", F.sum("weight").over(everything)
                        - F.coalesce(F.sum("weight").over(before), F.lit(0.0)))
            .withColumn("at_most", F.col("most") * F.col("weights")
                        <= F.col("words") * F.col("weight")))
    level = F.max(F.when(~F.col("at_most"), F.struct("weights", "words"))).over(everything)
    return (left.withColumn("level", level)
            .withColumn("target", F.when(F.col("at_most"), F.col("most")).otherwise(
                F.col("weight") * F.col("level.words") / F.col("level.weights"))))


def cuts(rows: DataFrame, **plan) -> DataFrame:
    """Per source: source_size, target, epochs, and the last sampled (key, tie) of the
    fractional epoch (null: none).  ``rows`` are narrow, with the columns of ``keyed``.

    Rows are bucketed by their key (equal shares of the exponential law), so no
    sort holds more than about ``BUCKET_ROWS`` rows, whatever the size of a source;
    bucket totals are prefix-summed and only the bucket in which the budget ends is
    sorted.  A document is in if the budget covers half of it, so a source
    misses its target by half a document at most.  Equal rows (same id, same text)
    share a key and are in or out together.
    """
    stats = rows.groupBy("mix_source").agg(
        F.first("source").alias("source"), F.sum("mix_size").alias("source_size"),
        F.count("*").alias("n"), (F.count("*") / F.sum("mix_key")).alias("rate"))
    sources = staged(source_targets(stats, **plan).select(
        "mix_source", "source", "source_size", "target", "rate",
        F.ceil(F.col("n") / BUCKET_ROWS).alias("buckets"),
        F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size")))
        .otherwise(0).cast("int").alias("epochs")), "mix-sources")
    sources = sources.withColumn("budget", F.col("target") - F.col("epochs") * F.col("source_size"))
    share = F.lit(1.0) - F.exp(-F.col("mix_key") * F.col("rate"))
    bucketed = (rows.select("mix_source", "mix_size", "mix_key", "mix_tie")
                .join(small_side(sources.select("mix_source", "rate", "buckets", "budget"),
                                 MAX_SOURCES_BROADCAST), "mix_source")
                .withColumn("bucket", F.floor(share * F.col("buckets"))))
    upto = Window.partitionBy("mix_source").orderBy("bucket")
    totals = (bucketed.groupBy("mix_source", "bucket").agg(
        F.sum("mix_size").alias("words"), F.first("budget").alias("budget"),
        F.max(F.struct("mix_key", "mix_tie")).alias("last"))
        .withColumn("end", F.sum("words").over(upto)))
    whole = (totals.where(F.col("end") <= F.col("budget"))
             .groupBy("mix_source").agg(F.max("last").alias("cut")))
    crossing = staged(totals.where((F.col("end") > F.col("budget"))
                                   & (F.col("end") - F.col("words") <= F.col("budget"))
                                   & (F.col("words") > 0))
                      .select("mix_source", "bucket", (F.col("end") - F.col("words"))
                              .alias("before")), "mix-crossing")
    within = Window.partitionBy("mix_source", "bucket").orderBy("mix_key", "mix_tie")
    unit = Window.partitionBy("mix_source", "bucket", "mix_key", "mix_tie")
    last = (bucketed.join(small_side(crossing, MAX_SOURCES_BROADCAST), ["mix_source", "bucket"])
            .withColumn("end", F.col("before") + F.sum("mix_size").over(
                within.rangeBetween(Window.unboundedPreceding, Window.currentRow)))
            .withColumn("unit", F.sum("mix_size").over(unit))
            .where(2 * F.col("end") - F.col("unit") <= 2 * F.col("budget"))
            .groupBy("mix_source").agg(F.max(F.struct("mix_key", "mix_tie")).alias("cut")))
    cut = whole.union(last).groupBy("mix_source").agg(F.max("cut").alias("cut"))
    return staged(sources.join(cut, "mix_source", "left")
                  .select("mix_source", "source_size", "target", "epochs", "cut"), "mix-cuts")


def _taken(rows: DataFrame, per_source: DataFrame) -> DataFrame:
    copies = F.col("epochs") + F.when(
        F.col("cut").isNotNull() & (F.struct("mix_key", "mix_tie") <= F.col("cut")), 1).otherwise(0)
    return (rows.join(small_side(per_source, MAX_SOURCES_BROADCAST), "mix_source")
            .withColumn("mix_copies", copies.cast("int")))


def _narrow(docs: DataFrame, seed: int) -> DataFrame:
    return staged(keyed(docs.select("doc_id", "text", "source"), seed).drop("text"), "mix-rows")


def mix_plan(docs: DataFrame, seed: int = 7, **plan) -> DataFrame:
    """What the mix takes of each document: doc_id, size, source_size, target, taken.

    Complete epochs come first; the fraction that is left is a weighted sample
    without replacement.  Null texts and texts without words have size 0 and
    take 0 words; they go along with the epochs.  A null source is a source of
    its own.  Repeated rows are taken alike.  An empty table gives no rows.
    Columns other than doc_id, text and source are ignored.
    """
    rows = _narrow(docs, seed)
    return _taken(rows, cuts(rows, **plan)).select(
        "doc_id", F.col("mix_size").alias("size"), "source_size", "target",
        (F.col("mix_size") * F.col("mix_copies")).cast("long").alias("taken"))


def mix(docs: DataFrame, seed: int = 7, **plan) -> DataFrame:
    """The mixed documents: each row of ``docs`` as often as the mix takes it.

    The texts are read twice and never shuffled (with up to
    ``MAX_SOURCES_BROADCAST`` sources; else they are joined by source).
    """
    per_source = cuts(_narrow(docs, seed), **plan).select("mix_source", "epochs", "cut")
    clear = docs.select(*[F.col(f"`{c}`").alias(f"d_{i}") for i, c in enumerate(docs.columns)],
                        "doc_id", "text", "source")
    return (_taken(keyed(clear, seed), per_source)
            .where("mix_copies > 0")
            .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies"))))
            .select(*[F.col(f"d_{i}").alias(c) for i, c in enumerate(docs.columns)]))
