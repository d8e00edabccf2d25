"""WARC archives of captures, and their index merged into one global order."""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql import types as T

from legworks.llm.common import small_side, staged
from legworks.session import scratch_path

CRLF = "\r\n"
FIRST_CAPTURE = "2024-01-01 00:00:00"   # capture times count seconds from here by page_id
RECORDS_PER_FILE = 20_000
FILE_BYTES = 128_000_000                # of the records of a file, unless it holds a single one
RECORD_CLASSES = (8_192, 131_072, 2_097_152, 33_554_432)   # largest record of a class of sizes
MAX_GROUPS_BROADCAST = 200_000
# Digit alphabets of conv() and of base32.
CONV_DIGITS, BASE32 = "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ENTRY = T.StructType([
    T.StructField("url_key", T.StringType()), T.StructField("capture_time", T.StringType()),
    T.StructField("page_id", T.LongType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("refers_to", T.LongType()), T.StructField("run", T.LongType())])


def base32_of_hex(digest: Column) -> Column:
    """A SHA-1 in hex as bare upper-case base32: 20 bits, five hex digits, at a time."""
    parts = [F.lpad(F.conv(F.substring(digest, at, 5), 16, 32), 4, "0") for at in range(1, 41, 5)]
    return F.translate(F.concat(*parts), CONV_DIGITS, BASE32)


def repeated_payloads(pages: DataFrame) -> DataFrame:
    """group (SHA-1) and original (the smallest page_id) of payloads of two pages or more."""
    payload = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    return staged(pages.select("page_id", F.sha1(payload).alias("group"))
                  .groupBy("group").agg(F.min("page_id").alias("original"),
                                        F.count("*").alias("n"))
                  .where("n > 1").drop("n"), "warc-groups")


def capture_records(pages: DataFrame, groups: DataFrame | None = None) -> DataFrame:
    """One WARC record per page, as the column ``record``.

    Of pages with equal payloads (``groups``; by default those among ``pages``) that with the
    smallest page_id is a response, the others are revisits of it without the payload.  Only
    groups of two or more are joined back: broadcast if they are few, else by a shuffle on the
    digest in which Spark splits a hot digest.
    """
    groups = repeated_payloads(pages) if groups is None else groups
    rows = (pages.select(F.col("page_id").cast("long"),
                         F.coalesce(F.col("url").cast("string"), F.lit("about:blank")).alias("url"),
                         F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"))
            .withColumn("digest", F.sha1(F.encode("html", "UTF-8")))
            .withColumn("bytes", F.octet_length("html"))
            .join(small_side(groups, MAX_GROUPS_BROADCAST), F.col("digest") == F.col("group"),
                  "left")
            .withColumn("revisit", F.col("original").isNotNull()
                        & ~F.col("page_id").eqNullSafe(F.col("original"))))
    http = F.concat(F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}"
                          "Content-Length: "), F.col("bytes"), F.lit(CRLF * 2))
    block = F.when(F.col("revisit"), http).otherwise(F.concat(http, "html"))
    name = lambda c: F.concat(F.lit("<urn:x-page:"), F.coalesce(
        c.cast("string"), F.lit("null")), F.lit(">"))
    when = F.date_format(F.expr(f"timestamp'{FIRST_CAPTURE}' + make_interval(0, 0, 0, 0, 0, 0, "
                                "coalesce(page_id, 0))"), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    # control characters and spaces can't stand in a header line
    url = F.regexp_replace("url", r"[\x00-\x20\x7F]", "%20")
    head = F.concat(
        F.lit(f"WARC/1.1{CRLF}WARC-Type: "),
        F.when(F.col("revisit"), "revisit").otherwise("response"),
        F.lit(f"{CRLF}WARC-Record-ID: "), name(F.col("page_id")),
        F.lit(f"{CRLF}WARC-Target-URI: "), url, F.lit(f"{CRLF}WARC-Date: "), when,
        F.lit(f"{CRLF}WARC-Payload-Digest: sha1:"), base32_of_hex(F.col("digest")),
        F.when(F.col("revisit"), F.concat(
            F.lit(f"{CRLF}WARC-Profile: http://netpreserve.org/warc/1.1/revisit/"
                  f"identical-payload-digest{CRLF}WARC-Refers-To: "), name(F.col("original"))))
        .otherwise(""),
        F.lit(f"{CRLF}Content-Type: application/http;msgtype=response{CRLF}Content-Length: "),
        F.octet_length(block), F.lit(CRLF * 2))
    return rows.select(F.concat(head, block).alias("record"))


def write_warc(pages: DataFrame, path: str) -> None:
    """Write the records as gzip files of at most ``FILE_BYTES`` and ``RECORDS_PER_FILE`` records; a
    larger record has a file of its own.

    Spark's own text writer does it, so a lost task is written again and a file
    appears only when it is whole.  The two line ends that close a record are the separator.
    The writer counts records, so pages are written by classes of their size, each with as many to a
    file as its largest allow; a class without pages costs nothing.
    """
    # what a page's record takes at most
    most = (F.octet_length(F.coalesce(F.col("html").cast("string"), F.lit("")))
            + 3 * F.coalesce(F.octet_length(F.col("url").cast("string")), F.lit(0)) + 2_048)
    none = F.lit(None).cast("int")
    kind = reduce(lambda c, n: c.when(most <= n, n), RECORD_CLASSES, F.when(F.lit(False), none))
    found = [r["kind"] for r in pages.groupBy(kind.alias("kind")).count().collect()]
    groups = repeated_payloads(pages)
    for largest in found or RECORD_CLASSES[:1]:
        held = 1 if largest is None else max(1, min(RECORDS_PER_FILE, FILE_BYTES // largest))
        (capture_records(pages.where(kind.eqNullSafe(F.lit(largest))), groups)
         .write.mode("append").option("compression", "gzip").option("lineSep", CRLF * 2)
         .option("maxRecordsPerFile", held).text(path))


def parse_records(content: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzip file, by Content-Length."""
    unzip, held, at = zlib.decompressobj(31), bytearray(), 0

    def more() -> bool:
        nonlocal at
        data = unzip.unconsumed_tail
        if not data:
            data = content[at:at + (1 << 18)]
            at += len(data)
        out = unzip.decompress(data, 1 << 20)
        held.extend(out)
        return bool(out) or at < len(content)

    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not more():
                if held.strip():
                    raise ValueError("a WARC file ends inside a record's headers")
                return
        lines = held[:end].decode("utf-8", "replace").split(CRLF)
        if not lines[0].startswith("WARC/"):
            raise ValueError(f"no WARC record at {lines[0][:40]!r}")
        headers = dict(x.split(": ", 1) for x in lines[1:])
        stop = end + 4 + int(headers["Content-Length"])
        while len(held) < stop + 4:
            if not more():
                raise ValueError("a WARC file ends inside a record")
        yield headers, bytes(held[end + 4:stop])
        del held[:stop + 4]


def url_key(url: str) -> str:
    """Sort key of a URL: host names from the right, then port, path and query."""
    rest = url.split("://", 1)[-1].split("#", 1)[0]
    host, slash, path = rest.partition("/")
    name, _, port = host.partition(":")
    key = ",".join(reversed(name.lower().split("."))) + (f":{port}" if port else "")
    return f"{key}){slash}{path}"


def entry(headers: dict[str, str], block: bytes) -> tuple:
    """Index entry of a record; a response's digest must be that of its payload."""
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    fields = dict(x.split(": ", 1) for x in http.decode("utf-8", "replace").split(CRLF)[1:])
    size = int(fields["Content-Length"])
    kind = headers["WARC-Type"]
    if kind == "response":
        size = len(payload)
        if base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
            raise ValueError(f"payload of {headers['WARC-Record-ID']} differs from its digest")
    page, other = (None if x in ("", "null") else int(x) for x in (
        headers.get(h, "").removeprefix("<urn:x-page:").removesuffix(">")
        for h in ("WARC-Record-ID", "WARC-Refers-To")))
    return (url_key(headers["WARC-Target-URI"]), headers["WARC-Date"], page, size, digest,
            kind, other)


def order(e: tuple) -> tuple:
    """Null page ids first."""
    return e[0], e[1], e[2] is not None, e[2] or 0


def loser_tree_merge(runs: list[Iterator[tuple]], key: Callable[[tuple], tuple]) -> Iterator[tuple]:
    """k-way merge of sorted runs: inner nodes hold the losers of the matches below them,
    so each row that leaves costs one match a level."""
    k = len(runs)
    if not k:
        return
    heads = [next(r, None) for r in runs]
    keys = [None if h is None else key(h) for h in heads]

    def beats(a: int, b: int) -> bool:
        if keys[a] is None or keys[b] is None:
            return keys[b] is None and (keys[a] is not None or a < b)
        return (keys[a], a) < (keys[b], b)

    loser = [-1] * k

    def replay(leaf: int) -> None:
        winner, node = leaf, (leaf + k) // 2
        while node:
            if loser[node] == -1:  # while the tree is built, the first to come waits
                loser[node] = winner
                return
            if beats(loser[node], winner):
                loser[node], winner = winner, loser[node]
            node //= 2
        loser[0] = winner

    for leaf in range(k):
        replay(leaf)
    while keys[loser[0]] is not None:
        first = loser[0]
        yield heads[first]
        heads[first] = next(runs[first], None)
        keys[first] = None if heads[first] is None else key(heads[first])
        replay(first)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    """Index entries of all archives: each file is a run, sorted by URL key and time."""
    arrow = to_arrow_schema(ENTRY)

    def run(batches):
        for batch in batches:
            for name, content in zip(batch.column("path").to_pylist(), batch.column("content"),
                                     strict=True):
                rows = sorted((entry(h, b) for h, b in parse_records(content.as_py())), key=order)
                nth = zlib.crc32(name.encode())
                for at in range(0, len(rows), 10_000):
                    cols = list(zip(*[(*r, nth) for r in rows[at:at + 10_000]], strict=True))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, f.type) for c, f in zip(cols, arrow, strict=True)],
                        schema=arrow)

    files = (spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
             .select("path", "content"))
    return files.mapInArrow(run, ENTRY)


def merge_index(runs: DataFrame) -> DataFrame:
    """All runs in one order of (url_key, capture_time, page_id), as ``part`` and ``nth``.

    Ranges of the order go to a task each; a task holds its range's share of every
    run and merges the shares with a loser tree.  page_id is part of the range
    key, so a URL with very many captures spreads over several ranges.
    """
    schema = T.StructType([*ENTRY.fields[:-1], T.StructField("nth", T.LongType())])
    arrow = to_arrow_schema(schema)

    def merge(batches):
        shares: dict[int, list[tuple]] = {}
        for batch in batches:
            *cols, run = [c.to_pylist() for c in batch.columns]
            for r, *e in zip(run, *cols, strict=True):
                shares.setdefault(r, []).append(tuple(e))
        out: list[tuple] = []
        for nth, e in enumerate(loser_tree_merge(
                [iter(shares[r]) for r in sorted(shares)], order)):
            out.append((*e, nth))
            if len(out) == 10_000:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow,
                                                         strict=True)], schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)],
                schema=arrow)

    keys = ["url_key", "capture_time", "page_id"]
    return (runs.repartitionByRange(*keys, "run").sortWithinPartitions("run", *keys)
            .mapInArrow(merge, schema).withColumn("part", F.spark_partition_id()))


def archive(pages: DataFrame, path: str | None = None) -> DataFrame:
    """Write a WARC record per page under ``path``, read the archives back, merge their index.

    The payload is the html in UTF-8 (null: empty).  A null url is 'about:blank', a
    null page_id is kept (it is no original unless no other row has the payload).
    Rows that repeat a page_id and payload are all responses if that id is
    the smallest.  Empty payloads form a group as any other.  A very long page has a file of its
    own, which is read as one value (2 GB at most, as a Spark row).  An empty table writes
    no record and gives no rows.  Columns other than page_id, url and html are ignored.

    Returns, in index order within a part: page_id, payload_bytes, payload_digest,
    record_type, refers_to, url_key, capture_time.
    """
    spark = pages.sparkSession
    path = path or scratch_path(spark, "llm-warc")
    write_warc(pages, path)
    index = staged(merge_index(staged(read_index(spark, path), "warc-runs")), "warc-index")
    return index.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to",
                        "url_key", "capture_time")
