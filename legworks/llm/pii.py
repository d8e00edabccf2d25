"""Personal data: candidate spans, boosted trees on format and context, calibrated thresholds.

All of it is DataFrame work in the JVM; the trees are Spark ML's.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from legworks.llm.common import staged, text_or_empty

KINDS = ("email", "ip", "card", "phone")       # in the order of the digest

# The base patterns, written so that matching is linear: a run that fails at its start is not
# tried again from inside, and repeats that can't give anything back don't.
EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++"
         r"(?:\.[A-Za-z0-9-]++)++")
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = r"[0-9](?:[\x20-]?[0-9])++"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"
IP_PART = r"0*(?:25[0-5]|2[0-4][0-9]|1?[0-9]?[0-9])"
# High-recall generators: addresses in disguise, and digits with any separators.
HIDDEN_EMAIL = (r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++\x20?[\[({]\x20?[aA][tT]\x20?[\])}]"
                r"\x20?[A-Za-z0-9-]++(?:(?:\.|\x20?[\[({]\x20?[dD][oO][tT]\x20?[\])}]\x20?)"
                r"[A-Za-z0-9-]++)++")
NUMBER = r"(?<![0-9A-Za-z])[+(]?[0-9][0-9\x20().-]*[0-9]"
CONTEXT = 24               # characters on either side that the trees see
CONTEXT_WORDS = {
    "email": "mail|contact|write|address|courriel|correo",
    "ip": "ip|host|server|login|client",
    "card": "card|visa|credit|cc|payment|carte|karte|tarjeta",
    "phone": "phone|tel|call|mobile|fax|cell|ring|anruf|llama"}
SPAN_GROUPS = 8            # groups of digits that a proposed number has at most
SPAN_DIGITS = (7, 19)      # and the digits that it has
GAP = 3                    # characters between its groups
STRETCH = 16_384           # characters of a run whose overlapping proposals are settled at a time
EXAMPLES_PER_TASK = 50_000 # distinct examples in a partition that the trees are fitted on
TREES, TREE_DEPTH = 20, 3
PRECISION = 0.95           # of the spans over a kind's threshold, on rows kept from fitting
SEED = 5


def _spans_of(gen: str) -> Column:
    """Matches of a generator with the length of the gap before, and the context on either side,
    from the columns of its matches and of what lies between them."""
    gaps = F.col(f"gaps_{gen}")
    return F.transform(f"found_{gen}", lambda m, i: F.struct(
        F.lit(gen).alias("gen"), i.alias("nth"), m.alias("raw"),
        F.length(F.get(gaps, i)).alias("gap"),
        F.right(F.get(gaps, i), F.lit(CONTEXT)).alias("before"),
        F.left(F.get(gaps, i + 1), F.lit(CONTEXT)).alias("after")))


def digits(raw: str | Column) -> Column:
    return F.regexp_replace(raw, "[^0-9]", "")


def luhn(d: str) -> Column:
    """Whether a string of digits passes the Luhn check."""
    value = (f"cast(substring({d}, length({d}) + 1 - i, 1) as int) * (1 + (1 - i % 2))")
    return F.expr(f"aggregate(sequence(1, greatest(length({d}), 1)), 0L, (s, i) -> "
                  f"s + ({value}) % 10 + ({value}) div 10) % 10 = 0")


def candidates(docs: DataFrame) -> DataFrame:
    """All generators' spans: row, doc_id, gen, raw, start, end, before, after, kind, base_ok.

    A document without any keeps a row with a null ``gen``, as does a run of digits and separators
    with too few digits for a number.  Offsets are running sums of gap and match
    lengths, in code points.
    """
    text = F.col("text")
    digit = text.rlike("[0-9]")
    generators = {  # pattern, and what a text must hold for it
        "email": (EMAIL, F.contains(text, F.lit("@"))),
        "ip": (IP, text.rlike(r"[0-9]\.[0-9]")),
        "card": (CARD, digit),
        "phone": (PHONE, F.contains(text, F.lit("+"))),
        "hidden": (HIDDEN_EMAIL, text.rlike(r"[\[({]\x20?[aA][tT]\x20?[\])}]")),
        "number": (NUMBER, digit)}
    rows = docs.select("doc_id", text_or_empty().alias("text"),
                       F.monotonically_increasing_id().alias("row"))
    cut = {}
    for gen, (pattern, needed) in generators.items():
        searched = F.when(needed, text).otherwise("")
        cut[f"found_{gen}"] = F.regexp_extract_all(searched, F.lit(pattern), F.lit(0))
        cut[f"gaps_{gen}"] = F.split(searched, pattern, -1)
    rows = (rows.select("row", "doc_id", *[v.alias(k) for k, v in cut.items()])
            .select("row", "doc_id", F.explode_outer(
                F.concat(*[_spans_of(g) for g in generators])).alias("s"))
            .select("row", "doc_id", "s.*"))
    upto = Window.partitionBy("row", "gen").orderBy("nth").rowsBetween(
        Window.unboundedPreceding, Window.currentRow)
    ends = F.sum(F.col("gap") + F.length("raw")).over(upto)
    n = F.length(digits("raw"))
    kind = (F.when(F.col("gen") == "hidden", "email")
            .when(F.col("gen") == "number", "phone").otherwise(F.col("gen")))
    ok = (F.when(F.col("gen") == "email", True)
          .when(F.col("gen") == "ip", F.col("raw").rlike(rf"^{IP_PART}(\.{IP_PART}){{3}}$"))
          .when(F.col("gen") == "card", F.when(n.between(14, 19), luhn(
              "regexp_replace(raw, '[^0-9]', '')")).otherwise(False))
          .when(F.col("gen") == "phone", n.between(10, 15)))
    return (rows.withColumn("end", ends).withColumn("start", F.col("end") - F.length("raw"))
            .withColumn("kind", kind).withColumn("base_ok", ok)
            .withColumn("gen", F.when((F.col("gen") != "number") | (n >= SPAN_DIGITS[0]), F.col("gen")))
            .drop("gap", "nth"))


def sub_spans(runs: DataFrame) -> DataFrame:
    """Overlapping proposals from runs of digits and separators: row, doc_id, run, pos, kind, raw,
    start, end, before and after.

    From each group of digits on, every number of up to ``SPAN_GROUPS`` groups that has
    ``SPAN_DIGITS`` digits is proposed, as a phone number and, from 13 digits on, as a card number.
    A run may be of any length: its groups become rows, and a window looks a few groups ahead.
    """
    groups = F.regexp_extract_all("raw", F.lit("[0-9]+"), F.lit(0))
    before = F.split("raw", "[0-9]+", -1)
    rows = (runs.select("row", "doc_id", "raw", "start", "before", "after",
                        groups.alias("groups"), before.alias("seps"))
            .select("row", "doc_id", "raw", "start", "before", "after", F.posexplode(F.arrays_zip(
                F.slice("seps", F.lit(1), F.size("groups")).alias("sep"),
                F.col("groups").alias("group"))).alias("pos", "part")))
    run = Window.partitionBy("row", "start").orderBy("pos")
    upto = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    size = F.length("part.group")
    rows = (rows.withColumn("hi", F.sum(F.length("part.sep") + size).over(upto))
            .withColumn("lo", F.col("hi") - size)
            .withColumn("ahead", F.collect_list(F.struct(
                F.col("hi"), size.alias("digits"), F.length("part.sep").alias("gap")))
                .over(run.rowsBetween(0, SPAN_GROUPS - 1))))
    taken = F.transform(F.sequence(F.lit(1), F.size("ahead")), lambda j: F.struct(
        F.get("ahead", j - 1)["hi"].alias("hi"),
        F.aggregate(F.slice("ahead", F.lit(1), j), F.lit(0), lambda n, g: n + g["digits"])
        .alias("digits"),
        F.forall(F.slice("ahead", F.lit(2), j - 1), lambda g: g["gap"] <= GAP).alias("near")))
    least, most = SPAN_DIGITS
    spans = (rows.withColumn("sign", F.length(F.regexp_extract("part.sep", r"\+?\(?$", 0)))
             .withColumn("span", F.explode(F.filter(
                 taken, lambda s: s["near"] & s["digits"].between(least, most))))
             .withColumn("from", F.col("lo") - F.col("sign")).withColumn("to", F.col("span.hi"))
             .withColumn("kind", F.explode(F.filter(F.array(
                 F.when(F.col("span.digits") <= 15, "phone"),
                 F.when(F.col("span.digits") >= 13, "card")), lambda k: k.isNotNull()))))
    raw = F.col("raw")
    return spans.select(
        "row", "doc_id", F.col("start").alias("run"), "pos", "kind",
        raw.substr(F.col("from") + 1, F.col("to") - F.col("from")).alias("raw"),
        (F.col("start") + F.col("from")).alias("start"), (F.col("start") + F.col("to")).alias("end"),
        F.right(F.concat(F.col("before"), F.expr(
            f"substring(raw, greatest(from - {CONTEXT}, 0) + 1, least(from, {CONTEXT}))")),
            F.lit(CONTEXT)).alias("before"),
        F.left(F.concat(raw.substr(F.col("to") + 1, F.lit(CONTEXT)), F.col("after")), F.lit(CONTEXT))
        .alias("after"))


def settled(spans: DataFrame) -> DataFrame:
    """Of accepted, overlapping proposals of a run (with ``p``), the best, then the best of those that
    don't overlap it, and so on until each is either kept or overlaps a better one that is.

    Better is the larger p, then the longer span, then the earlier.  A run is cut into stretches of
    ``STRETCH`` characters (more if it has spans of that size), which are settled on their own.  What may
    overlap a proposal of the next stretch is left open, as is what a better open one overlaps;
    the open ones meet again in stretches cut half a stretch further on, until none is left.  A run
    within a stretch is settled at once.
    """
    run = Window.partitionBy("row", "run")
    left = (spans.withColumn("reach", F.max(F.col("end") - F.col("start")).over(run))
            .withColumn("origin", F.min("start").over(run)))
    kept, turn = [], 0
    while True:
        turned = staged(_settled_once(left, turn % 2), "pii-settled")
        kept.append(turned.where("kept").select(*spans.columns))
        left = turned.where("NOT kept").drop("kept")
        if left.isEmpty():
            return reduce(DataFrame.union, kept)
        turn += 1


def _settled_once(spans: DataFrame, half: int) -> DataFrame:
    """The proposals (with ``reach``, the longest span of their run, and its ``origin``) that are kept or
    left open, and ``kept``, after a turn over stretches cut at multiples of their size, or between these."""
    size = F.greatest(F.lit(STRETCH), 4 * F.col("reach")).cast("long")
    place = F.col("start") - F.col("origin") + half * F.floor(size / 2)
    stretch = F.floor(place / size)
    # an overlapping proposal may be in the stretch before or the one after
    edge = (((stretch > 0) & (place - stretch * size < F.col("reach")))
            | (place + F.col("end") - F.col("start") > (stretch + 1) * size))
    span = F.struct("p", (F.col("end") - F.col("start")).alias("length"),
                    (-F.col("start")).alias("early"), "kind", edge.alias("edge"),
                    *[c for c in spans.columns if c not in ("row", "run", "p", "kind")])
    rows = (spans.groupBy("row", "run", stretch.alias("stretch"))
            .agg(F.sort_array(F.collect_list(span), asc=False).alias("all"),
                 F.min("start").alias("least"), F.max("end").alias("most")))
    free, own, open_ = (F.lit(c) for c in " ko")      # a byte a character of the stretch

    def marks(byte: Column, n: Column) -> Column:
        return F.repeat(byte, n.cast("int")).cast("binary")

    def holds(taken: Column, s: Column, byte: Column) -> Column:
        cells = taken.substr((s["start"] - F.col("least") + 1).cast("int"), s["length"].cast("int"))
        return F.contains(cells, byte.cast("binary"))

    def judged(done: Column, s: Column) -> Column:
        taken = done["taken"]
        out = holds(taken, s, own)
        good = ~out & ~s["edge"] & ~holds(taken, s, open_)
        marked = F.overlay(taken, marks(F.when(good, own).otherwise(open_), s["length"]),
                           (s["start"] - F.col("least") + 1).cast("int"))
        return F.struct(F.when(out, taken).otherwise(marked).alias("taken"),
                        F.when(good, F.concat(done["kept"], F.array(s))).otherwise(done["kept"])
                        .alias("kept"))

    none = F.struct(marks(free, F.col("most") - F.col("least")).alias("taken"),
                    F.filter("all", lambda s: F.lit(False)).alias("kept"))
    told = lambda spans, kept: F.transform(
        spans, lambda s: F.struct(s.alias("s"), F.lit(kept).alias("kept")))
    return (rows.withColumn("done", F.aggregate("all", none, judged))
            .select("row", "run", F.explode(F.concat(
                told(F.col("done.kept"), True),
                told(F.filter("all", lambda s: ~holds(F.col("done.taken"), s, own)), False)))
                .alias("found"))
            .select("row", "run", "found.s.*", "found.kept").select(*spans.columns, "kept"))


def featured(spans: DataFrame) -> DataFrame:
    """``spans`` with a vector of format and context features.

    The marks by which a base pattern knows its kind (the plus, the at sign) are taken out
    first, so that the trees judge what is left: groups, lengths, checks, context.
    """
    plain = F.regexp_replace(F.regexp_replace(
        F.col("raw"), r"\x20?[\[({]\x20?(?i:at)\x20?[\])}]\x20?", "@"),
        r"\x20?[\[({]\x20?(?i:dot)\x20?[\])}]\x20?", ".")
    out = (spans.withColumn("plain", F.regexp_replace(plain, r"^\+", ""))
           .withColumn("digits", digits("plain"))
           .withColumn("groups", F.regexp_extract_all("plain", F.lit("[0-9]+"), F.lit(0))))
    count = lambda p: F.regexp_count("plain", F.lit(p)).cast("double")
    around = F.lower(F.concat_ws(" ", "before", "after"))
    group = lambda at: F.coalesce(F.length(F.get("groups", at)), F.lit(0))
    features = {
        **{f"is_{k}": F.col("kind") == k for k in KINDS},
        "digits": F.length("digits"), "groups": F.size("groups"),
        "first_group": group(F.lit(0)), "last_group": group(F.size("groups") - 1),
        "longest": F.coalesce(F.array_max(F.transform("groups", F.length)), F.lit(0)),
        "largest": F.coalesce(F.array_max(F.transform(
            "groups", lambda g: F.least(F.substring(g, 1, 9).cast("long"), F.lit(999)))),
            F.lit(0)),
        "different": F.size(F.array_distinct(F.split("digits", ""))),
        "luhn": F.when(F.length("digits").between(1, 19), luhn("digits")),
        "length": F.length("plain"), "letters": count("[A-Za-z]"), "spaces": count(r"\x20"),
        "hyphens": count("-"), "dots": count(r"\."), "brackets": count("[()]"),
        "last_label": F.length(F.regexp_extract("plain", r"\.([A-Za-z]+)$", 1)),
        "glued_before": F.col("before").rlike(r"[0-9A-Za-z_=#$]$"),
        "glued_after": F.col("after").rlike(r"^[0-9A-Za-z_=%]"),
        **{f"near_{k}": around.rlike(rf"(?<![a-z])(?:{w})") for k, w in CONTEXT_WORDS.items()},
    }
    cols = [F.coalesce(v.cast("double"), F.lit(0.0)).alias(k) for k, v in features.items()]
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(
        out.select(*spans.columns, *cols)).select(*spans.columns, "features")


def corrupted(raw: Column, kind: Column) -> Column:
    """What is left of a span when its kind's rule is broken: another check digit, a part
    over 255, a number cut short, an address without its last labels."""
    last = ((F.right(raw, F.lit(1)).cast("int") + 1) % 10).cast("string")
    return (F.when(kind == "card", F.concat(F.expr("left(raw, length(raw) - 1)"), last))
            .when(kind == "ip", F.concat(F.lit("9"), F.lpad(raw, F.greatest(
                F.length(raw), F.lit(1)), "0")))
            .when(kind == "phone", F.expr("left(raw, greatest(length(raw) div 2, 1))"))
            .otherwise(F.regexp_replace(raw, r"\..*$", "")))


def disguised(raw: Column, kind: Column) -> list[Column]:
    """Other ways to write a valid span, null where a kind has none: a number without its plus, with
    other separators or without any, an address with its signs in words."""
    number = kind.isin("phone", "card")
    bare = F.regexp_replace(raw, r"[+()]", "")
    return [F.when(number, F.trim(bare)),
            F.when(number, F.regexp_replace(F.trim(bare), r"[\x20.-]+", ".")),
            F.when(number, F.regexp_replace(F.trim(bare), r"[\x20.-]+", "-")),
            F.when(number, digits(raw)),
            F.when(kind == "email", F.regexp_replace(F.regexp_replace(raw, "@", " [at] "),
                                                     r"\.", " [dot] "))]


def merged(raw: Column, kind: Column) -> list[Column]:
    """Spans with wrong ends: a valid number and the beginning of another, or without its last
    group, or its first if too little is left for a number of its own; null for other kinds and for
    numbers of one group."""
    number = kind.isin("phone", "card")
    groups = F.regexp_extract_all(raw, F.lit("[0-9]+"), F.lit(0))
    several = number & (F.size(groups) > 2)
    shorter = F.regexp_replace(raw, r"^[+(]*[0-9]+[)\x20.-]+", "")
    return [F.when(number, F.concat(raw, F.lit(" "), F.coalesce(F.get(groups, F.lit(0)), F.lit("1")))),
            F.when(several, F.regexp_replace(raw, r"[\x20().-]+[0-9]+$", "")),
            F.when(several & ((kind == "card") | (F.length(digits(shorter)) < 10)), shorter)]


def examples(spans: DataFrame) -> DataFrame:
    """What the trees learn from: kind, label, kept (from fitting), x (the features) and n.

    Every match of the base patterns counts: valid ones and their disguised forms as examples,
    failing, corrupted and wrongly cut ones as counterexamples.  Matches and forms with the same
    features are one row with their number ``n``, added up before the shuffle, so what is shuffled and
    fitted on is bounded by the distinct ones.  All forms of a match are kept from fitting together.
    """
    known = (spans.where(F.col("base_ok").isNotNull())
             .withColumn("hash", F.xxhash64("raw", "before", "after"))
             .withColumn("label", F.col("base_ok").cast("double")))
    raw, kind = F.col("raw"), F.col("kind")
    form = lambda r, label: F.struct(r.alias("raw"), label.alias("label"))
    # the match itself, and its other forms if it is valid
    other = [F.when(F.col("base_ok"), form(c, F.lit(label))) for label, forms in (
        (1.0, disguised(raw, kind)), (0.0, [corrupted(raw, kind), *merged(raw, kind)]))
        for c in forms]
    forms = (known.withColumn("form", F.explode(F.filter(
        F.array(form(raw, F.col("label")), *other), lambda f: f["raw"].isNotNull())))
        .withColumn("raw", F.col("form.raw")).withColumn("label", F.col("form.label")).drop("form"))
    return (featured(forms)
            .select("kind", "label", (F.pmod(F.xxhash64("hash"), F.lit(10)) < 3).alias("kept"),
                    vector_to_array("features").alias("x"))
            .groupBy("kind", "label", "kept", "x").agg(F.count("*").cast("double").alias("n")))


def fit(spans: DataFrame) -> tuple[GBTClassificationModel, dict[str, float]] | None:
    """Trees and a threshold per kind; None if the corpus has no base spans to learn from.

    Fitted on the ``examples`` of all matches of the base patterns, each weighted by its number.  A
    kind's threshold is the lowest at which ``PRECISION`` of the rows kept from fitting are
    right.
    """
    rows = staged(examples(spans), "pii-train")
    if rows.agg(F.count_distinct("label")).head()[0] < 2:
        return None
    # a layout that only the examples decide, so that reruns agree
    learnt = rows.where("NOT kept")
    tasks = max(1, math.ceil(learnt.count() / EXAMPLES_PER_TASK))
    learnt = staged(learnt.repartition(tasks, "x").sortWithinPartitions("x", "kind", "label"),
                    "pii-learnt")
    model = GBTClassifier(maxIter=TREES, maxDepth=TREE_DEPTH, seed=SEED, maxBins=32,
                          weightCol="n").fit(
        learnt.select(array_to_vector("x").alias("features"), "label", "n"))
    held = rows.where("kept").withColumn("features", array_to_vector("x"))
    right = (_probability(model, held).withColumn("at", F.floor(F.col("p") * 100))
             .groupBy("kind", "at").agg(F.sum(F.col("label") * F.col("n")).alias("good"),
                                        F.sum("n").alias("n"))
             .collect())  # 4 kinds of 101 steps at most
    limits = {}
    for kind in KINDS:
        good = total = 0
        for r in sorted((r for r in right if r.kind == kind), key=lambda r: -r["at"]):
            good, total = good + r.good, total + r.n
            if good >= PRECISION * total and r["at"] >= 50:
                limits[kind] = r["at"] / 100
    return model, limits


def _probability(model: GBTClassificationModel, rows: DataFrame) -> DataFrame:
    return (model.transform(rows)
            .withColumn("p", F.get(vector_to_array("probability"), F.lit(1)))
            .drop("rawPrediction", "probability", "prediction"))


def find_pii(docs: DataFrame) -> DataFrame:
    """Spans of personal data in whole texts: row, doc_id, and the arrays base and spans.

    Elements are structs of start, order (of the kind), kind and end, sorted.
    """
    found = staged(candidates(docs), "pii-candidates")
    columns = ["row", "doc_id", "kind", "start", "end"]
    proposals = (found.where("gen = 'hidden'").withColumn("run", F.col("start"))
                 .withColumn("pos", F.lit(0))
                 .unionByName(sub_spans(found.where("gen = 'number'")), allowMissingColumns=True))
    fitted = fit(found)
    if fitted is None:
        extra = proposals.select(*columns).limit(0)
    else:
        model, limits = fitted
        limit = reduce(lambda c, k: c.when(F.col("kind") == k, limits[k]), limits,
                       F.when(F.lit(False), 2.0)).otherwise(2.0)
        extra = settled(_probability(model, featured(proposals)).where(F.col("p") >= limit)
                        .select(*columns, "run", "p"))
    rows = (found.where(F.col("gen").isNull() | F.col("base_ok").isNotNull())
            .select(*columns, F.coalesce("base_ok", F.lit(False)).alias("base"),
                    F.lit(False).alias("added"))
            .union(extra.select(*columns, F.lit(False), F.lit(True))))
    order = reduce(lambda c, i: c.when(F.col("kind") == KINDS[i], i), range(1, len(KINDS)),
                   F.when(F.col("kind") == KINDS[0], 0))
    span = F.struct("start", order.alias("order"), "kind", "end")
    # a document's spans are bounded by its own text
    return (rows.groupBy("row").agg(
        F.first("doc_id").alias("doc_id"),
        F.array_sort(F.collect_list(F.when(F.col("base"), span))).alias("base"),
        F.array_sort(F.collect_list(F.when(F.col("added"), span))).alias("added"))
        .withColumn("added", F.filter("added", lambda a: ~F.exists("base", lambda b: (
            b["start"] < a["end"]) & (a["start"] < b["end"]))))
        .select("row", "doc_id", "base", F.array_sort(F.concat("base", "added")).alias("spans")))


def _is(kind: str):
    return lambda x: x == kind


def _listed(spans: str) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def pii(docs: DataFrame) -> DataFrame:
    """Personal data in each document: counts and digest of the base spans, and all spans.

    Base spans are the four patterns' leftmost matches that pass their checks; the
    trees add proposals that overlap none of them: numbers in runs of digits
    and separators (every stretch of a run that may be a number, see ``sub_spans``) and
    addresses in words.  Of overlapping proposals over their kind's threshold, the likelier one
    stays, then the longer, then the earlier.  Null and empty texts have no
    spans; very long texts and runs are searched whole.  Repeated rows stay.  A corpus without
    base spans gets none added.  An empty table gives no rows.  Columns other than doc_id and text are ignored.

    Returns doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans.
    """
    counts = [F.size(F.filter(F.transform("base", lambda s: s["kind"]), _is(k))).cast("long")
              .alias(f"n_{k}") for k in KINDS]
    return find_pii(docs).select(
        "doc_id", *counts, F.sha2(_listed("base"), 256).alias("base_sha256"),
        _listed("spans").alias("spans"))
