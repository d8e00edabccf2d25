"""Documents with nulls, empty and very long texts, ties, repeated rows and clashing columns."""

from pyspark.sql import functions as F

CLASHES = ["item", "size", "row", "digest", "bucket", "key", "hits", "score", "shard", "part",
           "_digest", "mix_size", "line", "base", "first", "a.b"]


def messy_docs(spark, more=()):
    words = [f"w{i * i % 977}" for i in range(30_000)]
    rows = [(1, None, "s1"), (2, "", "s1"), (3, " \n\t \r\n", None), (4, " ".join(words), "s2"),
            (5, "a short text", "s2"), (6, "a short text", "s1"), (6, "a short text", "s1"),
            (None, "no id here\nno id here", None), (7, None, None),
            (8, "Ünïcödé ß 漢字 🙂 text\x0bwith\x0call spaces " * 20, "s3"), *more]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    for c in CLASHES:
        docs = docs.withColumn(c, F.lit(f"x{c}"))
    return docs.withColumn("lang", F.lit("en")).withColumn("n_chars", F.length("text").cast("long"))


def no_docs(spark):
    return messy_docs(spark).where("doc_id = -1")
