"""Mixing sources to target weights by a time-varying curriculum.

Each source has a weight schedule over training time 0 to 1, linear between equally spaced knots.  A source's demand for
words up to time t is its target times the integral of its schedule to t, over the whole integral.  Its documents, in
hash order and repeated as often as the target asks, answer that demand: a copy whose words begin at the c-th word
demanded is trained on at the time t that inverts the demand at c.  Positions of a hot source come from prefix sums over
hash buckets, so no source is one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auctionflow.llm.shared import WORD_PATTERN, bucket_count, staged, with_offsets

#: Weights by the rank of a source, repeating (fixed by the query's contract).
CYCLE = (5.0, 2.0, 1.0)
#: Schedules by the rank of a source, repeating: early, constant and late sources.  Only their shape counts.
SHAPES = ((3.0, 1.0, 1.0), (1.0, 1.0, 1.0), (1.0, 1.0, 3.0))


def measured(docs: DataFrame, whole_rows: bool = False) -> DataFrame:
    """doc_id, source, size (words of the text, null: 0) and h, which gives the order within a source: the md5 of the id,
    for rows without id that of their text, so that they are not one hot key.

    With ``whole_rows`` also row, the whole row as a struct.
    """
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD_PATTERN)), F.lit(0))
    doc = F.col("doc_id").cast("long")
    named = F.coalesce(doc.cast("string"), F.concat(F.lit("text "), F.col("text").cast("string")), F.lit(""))
    row = [F.struct("*").alias("row")] if whole_rows else []
    return docs.select(doc.alias("doc_id"), F.col("source").cast("string").alias("source"), words.cast("long").alias("size"),
                       F.md5(named.cast("binary")).alias("h"), *row)


def sources_of(rows: DataFrame) -> DataFrame:
    """One row a source: source, source_size and n_docs.  A null source is a source like any other."""
    return rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))


def cycled_weights(sources: DataFrame) -> DataFrame:
    """Add weight and schedule by the rank of the source's name in code point order, null last.

    The window is over one row a source, not over documents.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    pick = lambda values, make: F.element_at(F.array(*[make(v) for v in values]), (rank % len(values) + 1).cast("int"))
    return sources.withColumn("weight", pick(CYCLE, F.lit)).withColumn("schedule", pick(SHAPES, lambda v: F.array(*[F.lit(x) for x in v])))


def with_targets(sources: DataFrame, share: float = 1.5, most_repeats: float = 2.0) -> DataFrame:
    """Add target: ``share`` of all sizes by weight; a target stops at ``most_repeats`` times its source's size and the
    excess is shared again by weight until none is above.

    Each round is one aggregate of the sources' table that brings a single row to the driver; the level only rises.
    """
    cap = F.lit(float(most_repeats)) * F.col("source_size")
    total = float(sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = -1.0, -1
    while True:
        above = cap < F.lit(level) * F.col("weight") if capped >= 0 else F.lit(False)
        held, weight, n = sources.agg(F.sum(F.when(above, cap)), F.sum(F.when(~above, F.col("weight"))),
                                      F.count(F.when(above, 1))).first()
        if n == capped or not weight:
            break
        level, capped = (total - (held or 0.0)) / weight, n
    return sources.withColumn("target", F.least(cap, F.greatest(F.lit(level), F.lit(0.0)) * F.col("weight")))


def _time(fraction: Column, schedule: Column) -> Column:
    """The time at which the integral of ``schedule`` reaches ``fraction`` of the whole (0 to 1)."""
    knots = F.size(schedule)
    steps = F.greatest(knots - 1, F.lit(1))
    at = lambda i: F.coalesce(F.get(schedule, i.cast("int")), F.get(schedule, (knots - 1).cast("int")))
    areas = F.transform(F.sequence(F.lit(0), steps - 1), lambda i: (at(i) + at(i + 1)) / 2)
    whole = F.aggregate(areas, F.lit(0.0), lambda a, x: a + x)
    # walk the segments: (segments passed, area left to find)
    start = F.struct(F.lit(0).alias("i"), (fraction * whole).alias("left"), F.lit(False).alias("found"))

    def walk(state: Column, area: Column) -> Column:
        stop = state["found"] | (state["left"] < area) | (state["i"] >= steps - 1)
        return F.struct(F.when(stop, state["i"]).otherwise(state["i"] + 1).alias("i"),
                        F.when(stop, state["left"]).otherwise(state["left"] - area).alias("left"), stop.alias("found"))

    def solve(state: Column) -> Column:
        a, b = at(state["i"]), at(state["i"] + 1)
        # a x + (b - a) x^2 / 2 = left, in the form that also holds for a = b
        root = F.sqrt(F.greatest(a * a + 2 * (b - a) * state["left"], F.lit(0.0)))
        x = F.when(a + root > 0, 2 * state["left"] / (a + root)).otherwise(F.lit(0.0))
        return (state["i"] + F.least(x, F.lit(1.0))) / steps

    return F.aggregate(areas, start, walk, solve)


def assign(rows: DataFrame, sources: DataFrame, rows_per_bucket: int = 50_000, narrow: DataFrame | None = None) -> DataFrame:
    """Training positions of every document: its source's attributes, taken and copies array<struct<copy, words, position>>.

    ``rows`` (as of ``measured``, with any further columns) is read twice; stage it, or give its plain columns, staged, as
    ``narrow``.  ``sources`` has source, source_size, weight, schedule and target.  The words taken from a source are its
    target rounded, the last copy cut.  Documents without words take none; ties and repeated rows follow each other.
    """
    name = [F.coalesce("source", F.lit("")).alias("_source"), F.col("source").isNull().alias("_null")]
    buckets = bucket_count((rows if narrow is None else narrow).count(), rows_per_bucket)
    bucket = F.floor(F.conv(F.substring("h", 1, 7), 16, 10).cast("long") * buckets / 16 ** 7).alias("_bucket")
    keyed = lambda df: df.select("*", *name, bucket)
    extra = sources.select(*name, "source_size", "weight", "schedule", "target").withColumn("_words", F.round("target").cast("long"))
    placed = with_offsets(keyed(rows), ["_source", "_null"], "_bucket", ["h", "doc_id", "size"], F.col("size"), "_before", extra,
                          None if narrow is None else keyed(narrow))
    size = F.col("source_size")
    last = F.when(size > 0, F.floor((F.col("_words") - 1 - F.col("_before")) / size)).otherwise(F.lit(-1)).cast("int")
    start = lambda k: F.col("_before") + k * size
    copies = F.when((last >= 0) & (F.col("size") > 0), F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda k: F.struct(
        k.alias("copy"), F.least("size", F.col("_words") - start(k)).alias("words"),
        _time(start(k) / F.col("_words"), F.col("schedule")).alias("position"))))
    empty = F.array().cast("array<struct<copy:int,words:bigint,position:double>>")
    placed = placed.withColumn("copies", F.coalesce(copies, empty))
    return (placed.withColumn("taken", F.aggregate("copies", F.lit(0).cast("long"), lambda a, x: a + x["words"]))
            .drop("_source", "_null", "_bucket", "_before", "_words", "schedule"))


def training_order(assigned: DataFrame, partitions: int | None = None) -> DataFrame:
    """One row a copy (copy, words, position), range-partitioned and sorted by position."""
    n = partitions or int(assigned.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = assigned.select(*[c for c in assigned.columns if c != "copies"], F.inline("copies"))
    return rows.repartitionByRange(n, "position", "h").sortWithinPartitions("position", "h", "doc_id", "copy")


def targets_of(rows: DataFrame, share: float, most_repeats: float) -> DataFrame:
    """The sources of staged ``rows`` with their cycled weights and targets, staged."""
    return staged(with_targets(staged(cycled_weights(sources_of(rows)), "sources"), share, most_repeats), "targets")


def mix_documents(docs: DataFrame, share: float = 1.5, most_repeats: float = 2.0) -> DataFrame:
    """``assign`` over all ``docs`` with the cycled weights: doc_id, source, size, source_size, target, taken, copies, h."""
    rows = staged(measured(docs), "measured")
    return assign(rows, targets_of(rows, share, most_repeats))


def mixed_documents(docs: DataFrame, share: float = 1.5, most_repeats: float = 2.0) -> DataFrame:
    """The mix itself: a row for each copy that is taken, columns as in ``docs``, in training order.

    A copy that is cut keeps its first words, joined by single spaces; n_chars, where it is a column, follows.
    """
    narrow = staged(measured(docs), "measured")
    assigned = assign(measured(docs, whole_rows=True), targets_of(narrow, share, most_repeats), 5_000, narrow)
    ordered = training_order(assigned.select("doc_id", "h", "size", "copies", "row"))
    words = F.regexp_extract_all(F.col("row.text").cast("string"), F.lit(WORD_PATTERN), F.lit(0))
    cut = F.col("words") < F.col("size")
    text = F.when(cut, F.array_join(F.slice(words, F.lit(1), F.col("words").cast("int")), " ")).otherwise(F.col("row.text"))
    ordered = ordered.select("row", text.alias("_text"), cut.alias("_cut"))
    kind = dict(docs.dtypes)

    def column(c: str) -> Column:
        if c == "text":
            return F.col("_text").alias(c)
        if c == "n_chars":
            return F.when(F.col("_cut"), F.length("_text").cast(kind[c])).otherwise(F.col("row.n_chars")).alias(c)
        return F.col("row")[c].alias(c)

    return ordered.select(*[column(c) for c in docs.columns])
