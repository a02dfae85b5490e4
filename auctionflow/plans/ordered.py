"""Ordered per-key scans that stay parallel when one key is huge.

A window ``partitionBy(key).orderBy(t)`` sends a whole key to one task.  When
one key may hold a large share of all rows (a hot auction, or a handful of
"subtasks" covering everything), that task becomes the job.  These helpers
split such keys into slices of like size:

1. ``groupBy(key).agg(count)`` (partial aggregation) finds keys with more than
   ``rows_per_slice`` rows.  At most ``N / rows_per_slice`` keys qualify.
2. Each hot key is cut at quantiles of its times, as many as its own rows
   need, so an outlier or a burst costs nothing.  Where one time alone fills a slice, its rows are cut again
   at quantiles of the second order column.  ``_slice`` counts the cuts at or
   before a row's (time, second column), so slices are contiguous in the scan
   order; other keys have slice 0.
3. Per slice, a small summary (count, sum, min, max) is computed; an
   exclusive prefix over the slices of a key (one row per slice) gives each
   slice its carry-in.  The row-level window then runs per (key, slice),
   which is the shuffle key of the carry join, so no extra exchange is added.

Without hot keys the only extra work is the count, over the key and time
columns.  Rows whose key or time is NULL have no place in an ordered scan.
They are dropped before anything else, whatever the number of rows
(``placed``).  All steps are built-in SQL operators; the driver sees the hot
keys and their cuts only while both are few, and they then become literals
instead of a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auctionflow.functions.ordering import order_key
from auctionflow.session import ensure_checkpoint_dir

# A slice is sized like one shuffle partition: 4M rows of ~64-100 bytes are a
# few hundred MB, the scale of `session.cluster_conf` partitions.  The hot-key
# table then has at most N / 4M rows (250k at 10^12 rows).
DEFAULT_ROWS_PER_SLICE = 4_000_000
MAX_LITERAL_KEYS = 64   # a flat CASE per row; more keys go through a hash join
MAX_LITERAL_CUTS = 2_048
FAN = 16                # cuts of one node of the search tree
MAX_BROADCAST_CUTS = 500_000  # 16 bytes and a key each: some 20 MB
_LOWEST = -(2 ** 63)


def placed(df: DataFrame, keys: list[str], t_col: str) -> DataFrame:
    """Rows with a key and a time; the others have no place in the scan."""
    for c in [*keys, t_col]:
        df = df.where(F.col(c).isNotNull())
    return df


def fits_a_slice(at_most: DataFrame | int | None, rows_per_slice: int) -> bool:
    """Whether ``at_most`` (a table or a number of rows) is known to fit one slice."""
    if at_most is None:
        return False
    return (at_most if isinstance(at_most, int) else at_most.count()) <= rows_per_slice


def hot_keys(df: DataFrame, keys: list[str], rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
             at_most: DataFrame | int | None = None) -> tuple[DataFrame, int]:
    """Keys with more than ``rows_per_slice`` rows and their count ``_n``; and
    the number of such keys.

    ``at_most`` is a cheaper table with at least as many rows, such as the
    scan that ``df`` aggregates, or their number.  If even all its rows fit
    one slice, no key is hot and the plan behind ``df`` is not run."""
    if df.isStreaming:
        raise ValueError("ordered scans are batch operators; use the streaming processors")
    if fits_a_slice(at_most, rows_per_slice):
        return df.sparkSession.createDataFrame([], df.select(*keys, F.lit(0).cast("long").alias("_n")).schema), 0
    hot = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > F.lit(rows_per_slice))
    # One job in the common case: up to MAX_LITERAL_KEYS hot keys come back
    # as local rows; more are written once and stay a distributed table.
    first = hot.limit(MAX_LITERAL_KEYS + 1).collect()
    if len(first) <= MAX_LITERAL_KEYS:
        return df.sparkSession.createDataFrame(first, hot.schema), len(first)
    ensure_checkpoint_dir(df.sparkSession)
    hot = hot.checkpoint()
    return hot, hot.count()


def _position(t: Column, tie: Column | None) -> Column:
    """Rank of a row in the scan order, as one fixed-width key (NULL ties first)."""
    return order_key(t, F.lit(_LOWEST) if tie is None else F.coalesce(tie.cast("long"), F.lit(_LOWEST)))


def _doublings(parts: Column) -> Column:
    """The least c with 2^c >= ``parts`` (1 at least)."""
    return F.length(F.bin(F.greatest(parts - 1, F.lit(1)).cast("long")))


def _quantiles(df: DataFrame, groups: list[str], value: str, classes: list[int]) -> DataFrame:
    """``groups`` and ``_q``: the quantiles i / 2^c of ``value``, c being the group's own ``_class``.

    One aggregate with a digest per class; a group fills only that of its class, so a digest is as fine as its group needs."""
    each = [F.percentile_approx(F.when(F.col("_class") == c, F.col(value)), [i / 2 ** c for i in range(1, 2 ** c)], max(10_000, 20 * 2 ** c)) for c in classes]
    return df.groupBy(*groups).agg(F.coalesce(*each).cast("array<bigint>").alias("_q"))


def slice_cuts(df: DataFrame, hot: DataFrame, keys: list[str], t_col: str, rows_per_slice: int,
               tie_col: str | None = None) -> DataFrame:
    """``keys`` and ``_cuts``: the ascending positions at which the slices of
    the hot keys begin (all but the first).  A key gets as many slices as its
    own rows need, rounded up to a power of two, so all keys together have at
    most 4 N / ``rows_per_slice``.  No slice has more than about
    ``rows_per_slice`` rows, unless rows agree in both order columns."""
    sized = hot.select(*keys, _doublings(F.ceil(F.col("_n") / rows_per_slice)).alias("_class"))
    classes = sorted(r["_class"] for r in sized.select("_class").distinct().collect())  # 40 at most
    own = df.join(sized, keys)
    marks = _quantiles(own, keys, t_col, classes)
    marks = marks.select(*keys, F.explode("_q").alias("_v")).groupBy(*keys, "_v").agg(F.count("*").alias("_c"))
    if tie_col is not None:
        ensure_checkpoint_dir(df.sparkSession)
        marks = marks.checkpoint()  # small, and read three times
    cuts = marks.select(*keys, _position(F.col("_v"), None).alias("_p"))
    if tie_col is not None and not marks.where("_c > 1").isEmpty():
        # a time that is two quantiles at once fills a slice alone
        full = marks.where("_c > 1").select(*keys, "_v", _doublings(F.col("_c") + 1).alias("_class"))
        within = df.select(*keys, F.col(t_col).alias("_v"), F.col(tie_col).alias("_tie")).join(full, [*keys, "_v"])
        within = _quantiles(within, [*keys, "_v"], "_tie", list(range(1, max(classes) + 1)))
        within = within.select(*keys, "_v", F.explode("_q").alias("_tie"))
        cuts = (cuts.unionByName(full.select(*keys, _position(F.col("_v") + 1, None).alias("_p")))
                    .unionByName(within.select(*keys, _position(F.col("_v"), F.col("_tie")).alias("_p"))))
    return cuts.groupBy(*keys).agg(F.sort_array(F.collect_set("_p")).alias("_cuts"))


def _cuts_before(cuts: list[int], t: Column, tie: Column | None) -> Column:
    """How many of the ascending positions ``cuts`` are at or before a row: a balanced tree of comparisons of longs, which
    stays within generated code."""

    def reached(p: int) -> Column:
        at, second = p // 2 ** 64 - 2 ** 61, p % 2 ** 64 - 2 ** 63
        if tie is None or second == _LOWEST:
            return t >= F.lit(at)
        return (t > F.lit(at)) | ((t == F.lit(at)) & (F.coalesce(tie.cast("long"), F.lit(_LOWEST)) >= F.lit(second)))

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo).cast("long")
        mid = (lo + hi) // 2
        return F.when(reached(cuts[mid]), tree(mid + 1, hi)).otherwise(tree(lo, mid))

    return tree(0, len(cuts))


def apply_slices(df: DataFrame, cuts: DataFrame, n_hot: int, keys: list[str], t_col: str,
                 tie_col: str | None = None) -> DataFrame:
    """Add ``_slice``, the cuts of the row's key at or before it; 0 for
    ordinary keys.  Few cuts become literals; more go through a search tree
    (:func:`_descend`), so no row ever carries all cuts of its key."""
    if n_hot == 0:
        return df.withColumn("_slice", F.lit(0).cast("long"))
    total, most = cuts.agg(F.sum(F.size("_cuts")), F.max(F.size("_cuts"))).first()
    tie = None if tie_col is None else F.col(tie_col)
    if n_hot > MAX_LITERAL_KEYS or (total or 0) > MAX_LITERAL_CUTS:
        return _descend(df, cuts, keys, _position(F.col(t_col), tie), int(total or 0), int(most or 0))
    found = None
    for r in cuts.collect():
        match = None
        for k in keys:
            cond = F.col(k) == F.lit(r[k])
            match = cond if match is None else (match & cond)
        value = _cuts_before([int(c) for c in r["_cuts"]], F.col(t_col), tie)
        found = F.when(match, value) if found is None else found.when(match, value)
    none = F.lit(0).cast("long")
    return df.withColumn("_slice", none if found is None else found.otherwise(none))


def _descend(df: DataFrame, cuts: DataFrame, keys: list[str], position: Column, total: int, most: int) -> DataFrame:
    """Add ``_slice`` by a search tree of the cuts with FAN cuts a node, one column each.

    One join a level (three for 4,096 cuts of a key) on (key, node): a row meets FAN cuts at most, and the node of a row of
    a hot key differs from row to row, so a join that has to shuffle spreads it."""
    depth = 1
    while FAN ** depth < most:
        depth += 1
    each = cuts.select(*keys, F.posexplode("_cuts").alias("_i", "_p"))
    out = df.withColumn("_pos", position).withColumn("_slice", F.lit(0).cast("long"))
    places = [f"_c{j}" for j in range(FAN)]
    for level in reversed(range(depth)):
        step = FAN ** level
        own = each.where(F.col("_i") % step == 0).select(*keys, F.floor(F.col("_i") / (step * FAN)).alias("_slice"), (F.floor(F.col("_i") / step) % FAN).alias("_j"), "_p")
        nodes = own.groupBy(*keys, "_slice").agg(*[F.max(F.when(F.col("_j") == j, F.col("_p"))).alias(c) for j, c in enumerate(places)])
        if total <= MAX_BROADCAST_CUTS:
            nodes = F.broadcast(nodes)
        found = sum((F.when(F.col(c) <= F.col("_pos"), 1).otherwise(0) for c in places), F.lit(0))
        if level:
            found = F.greatest(found - 1, F.lit(0))  # the child whose first cut is the last at or before the row
        out = out.join(nodes, [*keys, "_slice"], "left").withColumn("_slice", (F.col("_slice") * FAN + found).cast("long")).drop(*places)
    return out.select(*df.columns, "_slice")


def add_slices(df: DataFrame, keys: list[str], order_cols: list[str],
               rows_per_slice: int = DEFAULT_ROWS_PER_SLICE,
               at_most: DataFrame | int | None = None) -> tuple[DataFrame, bool]:
    """Add ``_slice`` (0 for ordinary keys).  Returns (df, sliced)."""
    hot, n_hot = hot_keys(df, keys, rows_per_slice, at_most)
    if n_hot == 0:
        return df.withColumn("_slice", F.lit(0).cast("long")), False
    tie = next((c for c in order_cols[1:2] if dict(df.dtypes)[c] in ("bigint", "int", "smallint", "tinyint")), None)
    ensure_checkpoint_dir(df.sparkSession)
    cuts = slice_cuts(df, hot, keys, order_cols[0], rows_per_slice, tie).checkpoint()
    return apply_slices(df, cuts, n_hot, keys, order_cols[0], tie), True


def sequence_numbers(df: DataFrame, keys: list[str], order_cols: list[str], out: str = "_seq",
                     rows_per_slice: int = DEFAULT_ROWS_PER_SLICE, at_most: DataFrame | int | None = None) -> DataFrame:
    """1-based ``row_number`` per ``keys`` in ``order_cols`` order (the first
    order column must be the numeric time), parallel within hot keys.
    ``at_most`` as of :func:`hot_keys`."""
    df = placed(df, keys, order_cols[0])
    sliced, any_hot = add_slices(df, keys, order_cols, rows_per_slice, at_most)
    if not any_hot:
        w = Window.partitionBy(*keys).orderBy(*order_cols)
        return df.withColumn(out, F.row_number().over(w).cast("long"))
    counts = sliced.groupBy(*keys, "_slice").agg(F.count(F.lit(1)).alias("_c"))
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*keys, "_slice", F.coalesce(F.sum("_c").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy(*keys, "_slice").orderBy(*order_cols)
    return (sliced.join(offsets, keys + ["_slice"])
                  .withColumn(out, (F.col("_off") + F.row_number().over(w)).cast("long"))
                  .select(*df.columns, out))


def running_aggregates(df: DataFrame, keys: list[str], order_cols: list[str], value_cols: list[str],
                       rows_per_slice: int = DEFAULT_ROWS_PER_SLICE, at_most: DataFrame | int | None = None) -> DataFrame:
    """Running count / sum / min / max / sum of squares (DECIMAL) of each
    value column per ``keys`` in order, current row included, nulls skipped.
    Adds ``{v}_rcount, {v}_rsum, {v}_rmin, {v}_rmax, {v}_rss``.  ``at_most``
    as of :func:`hot_keys`."""
    df = placed(df, keys, order_cols[0])
    sliced, any_hot = add_slices(df, keys, order_cols, rows_per_slice, at_most)

    def sq(v: str) -> Column:
        return F.col(v).cast("decimal(38,0)") * F.col(v).cast("decimal(38,0)")

    if not any_hot:
        w = Window.partitionBy(*keys).orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
        out = df
        for v in value_cols:
            out = out.select("*", F.count(v).over(w).alias(f"{v}_rcount"), F.sum(v).over(w).alias(f"{v}_rsum"),
                             F.min(v).over(w).alias(f"{v}_rmin"), F.max(v).over(w).alias(f"{v}_rmax"),
                             F.sum(sq(v)).over(w).alias(f"{v}_rss"))
        return out

    parts = []
    for v in value_cols:
        parts += [F.count(v).alias(f"_{v}_c"), F.sum(v).alias(f"_{v}_s"), F.min(v).alias(f"_{v}_lo"),
                  F.max(v).alias(f"_{v}_hi"), F.sum(sq(v)).alias(f"_{v}_ss")]
    summary = sliced.groupBy(*keys, "_slice").agg(*parts)
    before = Window.partitionBy(*keys).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carry = [*keys, "_slice"]
    for v in value_cols:
        carry += [F.coalesce(F.sum(f"_{v}_c").over(before), F.lit(0)).alias(f"_{v}_pc"),
                  F.sum(f"_{v}_s").over(before).alias(f"_{v}_ps"),
                  F.min(f"_{v}_lo").over(before).alias(f"_{v}_plo"),
                  F.max(f"_{v}_hi").over(before).alias(f"_{v}_phi"),
                  F.sum(f"_{v}_ss").over(before).alias(f"_{v}_pss")]
    offsets = summary.select(*carry)
    w = Window.partitionBy(*keys, "_slice").orderBy(*order_cols).rowsBetween(Window.unboundedPreceding, 0)
    out = sliced.join(offsets, keys + ["_slice"])
    for v in value_cols:
        local_s = F.sum(v).over(w)
        local_ss = F.sum(sq(v)).over(w)
        out = out.select(
            "*",
            (F.col(f"_{v}_pc") + F.count(v).over(w)).alias(f"{v}_rcount"),
            _add_nullable(F.col(f"_{v}_ps"), local_s).alias(f"{v}_rsum"),
            F.least(F.col(f"_{v}_plo"), F.min(v).over(w)).alias(f"{v}_rmin"),
            F.greatest(F.col(f"_{v}_phi"), F.max(v).over(w)).alias(f"{v}_rmax"),
            _add_nullable(F.col(f"_{v}_pss"), local_ss).alias(f"{v}_rss"),
        )
    added = [f"{v}_{s}" for v in value_cols for s in ("rcount", "rsum", "rmin", "rmax", "rss")]
    return out.select(*df.columns, *added)


def _add_nullable(a: Column, b: Column) -> Column:
    """a + b where a missing side counts as absent (not as NULL result)."""
    return F.when(a.isNull(), b).when(b.isNull(), a).otherwise(a + b)


def next_marker(rows: DataFrame, markers: DataFrame, keys: list[str], t_col: str, marker_t: str,
                payload: list[str], strict: bool = True,
                rows_per_slice: int = DEFAULT_ROWS_PER_SLICE, at_most: DataFrame | int | None = None) -> DataFrame:
    """As-of lookup forward: for every row, the payload of the first marker of
    the same key with ``marker_t > t`` (``>=`` when ``strict`` is False);
    among markers of equal time the one with the smallest payload hash wins.
    Rows without such a marker get NULLs.  Rows and markers without a key or
    time are dropped.

    Rows and markers are merged into one ordered stream per (key, slice); the
    answer inside a slice is a running ``last(ignorenulls)`` over the stream
    read backwards, and rows past the slice's last marker take the first
    marker of the following slices (an exclusive suffix over the small
    per-slice table).
    """
    rows, markers = placed(rows, keys, t_col), placed(markers, keys, marker_t)
    # hot keys are judged on the rows (the large side); markers take the same
    # slice boundaries.  A sliced scan reads the markers twice, so their plan
    # (a fold) is run once and kept.
    hot, n_hot = hot_keys(rows, keys, rows_per_slice, at_most)
    any_hot = n_hot > 0
    cuts = None
    if any_hot:
        ensure_checkpoint_dir(rows.sparkSession)
        cuts = slice_cuts(rows, hot, keys, t_col, rows_per_slice).checkpoint()
        markers = markers.select(*dict.fromkeys([*keys, marker_t, *payload])).checkpoint()
    r = rows.select("*", F.col(t_col).alias("_t"), F.lit(1).alias("_kind"))
    # At equal t a marker sorts before the row when strict (it must not be
    # found: t < marker_t is required) and after it otherwise.
    mk = markers.select(*keys, F.col(marker_t).alias("_t"),
                        F.lit(0 if strict else 2).alias("_kind"),
                        F.struct(*payload).alias("_m"),
                        F.xxhash64(*payload).alias("_tb"))
    row_cols = [c for c in r.columns if c not in keys + ["_t", "_kind"]]
    m_full = mk.select(*keys, "_t", "_kind", *[F.lit(None).cast(rows.schema[c].dataType).alias(c)
                                                for c in row_cols], "_m", "_tb")
    both = (r.withColumn("_m", F.lit(None).cast(mk.schema["_m"].dataType))
             .withColumn("_tb", F.lit(None).cast("long")).select(*m_full.columns))
    both = both.unionByName(m_full)
    sliced = apply_slices(both, cuts, n_hot, keys, "_t")
    part = keys + (["_slice"] if any_hot else [])
    # a hash of the payload breaks ties between markers of equal time, so the
    # pick is the same in every run (recomputed tasks give identical rows)
    back = (Window.partitionBy(*part).orderBy(F.col("_t").desc(), F.col("_kind").desc(), F.col("_tb").desc())
                  .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    found = sliced.withColumn("_found", F.last("_m", ignorenulls=True).over(back))
    if any_hot:
        k = order_key(F.col("_t") * 4 + F.col("_kind"), "_tb")
        firsts = (sliced.where(F.col("_m").isNotNull())
                        .groupBy(*keys, "_slice")
                        .agg(*[F.min_by(f"_m.{p}", k).alias(f"_f_{p}") for p in payload]))
        # Every slice of a hot key needs the first marker of the slices after
        # it.  The slices are known from the cuts, so the row stream is not read
        # again for them.
        hot_slices = cuts.select(*keys, F.explode(F.sequence(F.lit(0).cast("long"), F.size("_cuts").cast("long"))).alias("_slice"))
        carry_all = _carry_for_all(hot_slices, firsts, keys, payload)
        found = (found.join(carry_all, keys + ["_slice"], "left")
                      .withColumn("_found", F.coalesce("_found", "_carry"))
                      .drop("_carry"))
    out = found.where(F.col("_kind") == 1).select(*keys, *row_cols,
                                                  *[F.col(f"_found.{p}").alias(p) for p in payload])
    return out.drop("_slice") if "_slice" in out.columns else out


def _carry_for_all(slices: DataFrame, firsts: DataFrame, keys: list[str], payload: list[str]) -> DataFrame:
    """For each (key, slice), the first marker of any later slice."""
    cols = [f"_f_{p}" for p in payload]
    has = lambda df, yes: df.withColumn("_has", F.lit(yes))
    none = has(slices.select(*keys, "_slice", *[F.lit(None).cast(firsts.schema[c].dataType).alias(c) for c in cols]), 0)
    # a (key, slice) has one row of firsts at most, so max takes its value
    tagged = none.unionByName(has(firsts, 1)).groupBy(*keys, "_slice").agg(F.max("_has").alias("_has"),
                                                                         *[F.max(c).alias(c) for c in cols])
    marker = F.when(F.col("_has") == 1, F.struct(*[F.col(c).alias(p) for c, p in zip(cols, payload)]))
    after = Window.partitionBy(*keys).orderBy(F.col("_slice").desc()).rowsBetween(Window.unboundedPreceding, -1)
    return tagged.select(*keys, "_slice", F.last(marker, ignorenulls=True).over(after).alias("_carry"))
