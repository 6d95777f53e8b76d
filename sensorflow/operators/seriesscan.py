"""Ordered scans over time series that never hold a whole series in one task.

A plain ``Window.partitionBy(series)`` sends every row of a series to one task; a series
that holds a third of all rows then becomes one giant sort.  Here each series is cut into
calendar buckets (month by default, any monotone function of the order key works) and
the window runs per (series, bucket).  A bucket-level summary — one row per bucket —
carries the state across bucket edges:

* ``lag_columns``      previous row's values (the first row of a bucket takes the last
                       row of the nearest earlier bucket)
* ``known_neighbours`` last non-missing value at/before and first at/after each row
* ``row_index``        1-based position of the row in its whole series

Plan shape: the rows take one hash exchange on (series, bucket) and a sort + window.  The
bucket summary is a second, partial (map-side) hash aggregate over the input columns —
``max_by``/``min_by`` per column keep primitive buffers — so only one row per bucket is
shuffled for it; it gets a small window over buckets and is joined back on (series,
bucket), which is how the windowed rows are already partitioned, so the large side is
not shuffled again (AQE broadcasts the summary when it is small at run time).  Series keys are packed into
one struct so that NULL key values still form their own series, as in a window.
Rows are assumed unique on (series, order keys); callers add a tiebreak column if not.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SK = "__series"
BK = "__bucket"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def month_bucket(col) -> Column:
    """Integer ``yyyymm`` of a date or timestamp: a zone-free, monotone bucket."""
    c = _col(col)
    return F.year(c) * 100 + F.month(c)


def year_bucket(col) -> Column:
    return F.year(_col(col))


def _prepare(df: DataFrame, keys: Sequence[str], order: Sequence, bucket) -> DataFrame:
    sk = F.struct(*[F.col(k) for k in keys]) if keys else F.struct(F.lit(0).alias("_"))
    b = bucket if bucket is not None else month_bucket(_col(order[0]))
    return df.withColumns({SK: sk, BK: b.cast("long")})


def _window(order: Sequence):
    return Window.partitionBy(SK, BK).orderBy(*[_col(o) for o in order])


def _buckets():
    return Window.partitionBy(SK).orderBy(BK)


def _earlier():
    return _buckets().rangeBetween(Window.unboundedPreceding, -1)


def _later():
    # reversed order + preceding frame: O(n) where a following frame would be O(n^2)
    return (Window.partitionBy(SK).orderBy(F.col(BK).desc())
            .rangeBetween(Window.unboundedPreceding, -1))


def _ordering(order: Sequence) -> Column:
    """Single order column as is (hash-aggregatable); several packed in a struct."""
    if len(order) == 1:
        return _col(order[0])
    return F.struct(*[_col(o).alias(f"o{i}") for i, o in enumerate(order)])


def _extreme(fn, value: Column, ordering: Column, known: Column | None = None) -> Column:
    """``max_by``/``min_by`` of one column; rows where ``known`` is false are skipped
    (a NULL ordering is ignored by both aggregates)."""
    o = ordering if known is None else F.when(known, ordering)
    return fn(value, o)


def lag_columns(df: DataFrame, keys: Sequence[str], order: Sequence, cols: Sequence[str],
                bucket: Column | None = None, prefix: str = "prev_") -> DataFrame:
    """Add ``prefix + c`` = value of ``c`` on the previous row of the same series.

    Equivalent to ``F.lag(c).over(Window.partitionBy(keys).orderBy(order))``.
    """
    d = _prepare(df, keys, order, bucket)
    # bucket summary straight from the input: per-column max_by keeps the aggregation
    # buffers primitive, so it runs as a partial hash aggregate before a tiny shuffle
    ordering = _ordering(order)
    last = d.groupBy(SK, BK).agg(
        *[_extreme(F.max_by, F.col(c), ordering).alias("__l_" + c) for c in cols])
    carry = last.select(SK, BK, *[F.lag("__l_" + c).over(_buckets()).alias("__c_" + c)
                                  for c in cols])
    w = _window(order)
    d = d.withColumns({"__first": F.lag(F.lit(1)).over(w).isNull(),
                       **{"__lag_" + c: F.lag(F.col(c)).over(w) for c in cols}})
    d = d.join(carry, [SK, BK], "left")
    out = d.withColumns({prefix + c: F.when(F.col("__first"), F.col("__c_" + c))
                         .otherwise(F.col("__lag_" + c)) for c in cols})
    return out.drop(SK, BK, "__first", *["__lag_" + c for c in cols],
                    *["__c_" + c for c in cols])


def known_neighbours(df: DataFrame, keys: Sequence[str], order: Sequence, value: str,
                     x: Column | None = None, bucket: Column | None = None,
                     prefix: str = "") -> DataFrame:
    """Add the nearest known (non-NULL) ``value`` at/before and at/after each row.

    New columns: ``{prefix}prev_v, {prefix}prev_x, {prefix}next_v, {prefix}next_x`` where
    ``x`` is the position of that known row (a day number, ...), and ``{prefix}x``, the
    row's own.  Without ``x`` positions are row numbers of the series: the row number in its
    bucket plus the rows of earlier buckets, which the same bucket summary counts.
    """
    d = _prepare(df, keys, order, bucket)
    by_row = x is None
    d = d.withColumn("__x", F.row_number().over(_window(order)) if by_row else x)
    v = F.col(value)
    isk = v.isNotNull()
    ordering = _ordering(order)
    summary = d.groupBy(SK, BK).agg(
        _extreme(F.max_by, v, ordering, isk).alias("__lv"),
        _extreme(F.max_by, F.col("__x"), ordering, isk).alias("__lx"),
        _extreme(F.min_by, v, ordering, isk).alias("__fv"),
        _extreme(F.min_by, F.col("__x"), ordering, isk).alias("__fx"),
        F.count(F.lit(1)).alias("__n"))
    if by_row:
        rows_before = F.coalesce(F.sum("__n").over(_earlier()), F.lit(0))
        summary = summary.withColumn("__off", rows_before).withColumns(
            {"__lx": F.col("__lx") + F.col("__off"), "__fx": F.col("__fx") + F.col("__off")})
    else:
        summary = summary.withColumn("__off", F.lit(0))
    lk = F.when(F.col("__lv").isNotNull(), F.struct(F.col("__lv").alias("v"),
                                                   F.col("__lx").alias("x")))
    fk = F.when(F.col("__fv").isNotNull(), F.struct(F.col("__fv").alias("v"),
                                                   F.col("__fx").alias("x")))
    carry = summary.select(SK, BK, "__off",
                           F.last(lk, ignorenulls=True).over(_earlier()).alias("__cp"),
                           F.last(fk, ignorenulls=True).over(_later()).alias("__cn"))
    known = F.when(isk, F.struct(v.alias("v"), F.col("__x").alias("x")))
    off = F.col("__off") if by_row else F.lit(0)
    w = _window(order)
    # next known = last known over the reversed order (a growing frame, O(n) per bucket;
    # a current..unbounded-following frame would be re-aggregated per row)
    w_rev = Window.partitionBy(SK, BK).orderBy(*[_col(o).desc() for o in order])
    d = d.withColumns({
        "__pk": F.last(known, ignorenulls=True)
        .over(w.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
        "__nk": F.last(known, ignorenulls=True)
        .over(w_rev.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    d = d.join(carry, [SK, BK], "left")
    pk, nk, cp, cn = (F.col(c) for c in ("__pk", "__nk", "__cp", "__cn"))
    d = d.withColumns({prefix + "prev_v": F.coalesce(pk["v"], cp["v"]),
                       prefix + "prev_x": F.coalesce(pk["x"] + off, cp["x"]),
                       prefix + "next_v": F.coalesce(nk["v"], cn["v"]),
                       prefix + "next_x": F.coalesce(nk["x"] + off, cn["x"]),
                       prefix + "x": F.col("__x") + off})
    return d.drop(SK, BK, "__x", "__off", "__pk", "__nk", "__cp", "__cn")


def row_index(df: DataFrame, keys: Sequence[str], order: Sequence, name: str = "idx",
              bucket: Column | None = None) -> DataFrame:
    """Add the 1-based row position within the whole series (``row_number``)."""
    d = _prepare(df, keys, order, bucket)
    counts = d.groupBy(SK, BK).agg(F.count(F.lit(1)).alias("__n"))
    offs = counts.select(SK, BK, F.coalesce(F.sum("__n").over(_earlier()), F.lit(0))
                         .alias("__off"))
    w = _window(order)
    d = d.withColumn("__rn", F.row_number().over(w))
    d = d.join(offs, [SK, BK], "left")
    return d.withColumn(name, (F.col("__off") + F.col("__rn")).cast("long")).drop(
        SK, BK, "__rn", "__off")


def linear_fill(df: DataFrame, keys: Sequence[str], order: Sequence, value: str,
                x: Column | None, out: str, bucket: Column | None = None) -> DataFrame:
    """Linear interpolation of ``value`` along ``x`` (the row number if None) inside each
    series, ends held constant.

    Known values are kept; a gap between two known rows is filled on the straight line
    through them; leading/trailing gaps take the nearest known value (``rule = 2``);
    a series without any known value stays NULL.
    """
    d = known_neighbours(df, keys, order, value, x, bucket, prefix="__n_")
    pv, px, nv, nx = (F.col("__n_prev_v"), F.col("__n_prev_x"),
                      F.col("__n_next_v"), F.col("__n_next_x"))
    x = F.col("__n_x")
    interp = pv + (nv - pv) * (x - px).cast("double") / (nx - px).cast("double")
    filled = (F.when(F.col(value).isNotNull(), F.col(value))
              .when(pv.isNotNull() & nv.isNotNull() & (nx != px), interp)
              .when(pv.isNotNull() & nv.isNotNull(), pv)
              .otherwise(F.coalesce(pv, nv)))
    return d.withColumn(out, filled).drop("__n_prev_v", "__n_prev_x", "__n_next_v",
                                          "__n_next_x", "__n_x")
