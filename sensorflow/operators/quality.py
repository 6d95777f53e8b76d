"""Quality control: flags, gross ranges, manual masks and per-series range/spike/flat tests."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorflow.operators.seriesscan import lag_columns


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def qf_mask(value, qf) -> Column:
    """Keep a value only when its own quality flag is 0 (NULL flag -> NULL value)."""
    return F.when(_c(qf) == 0, _c(value))


def any_flag_passes(df: DataFrame, qf_cols: Sequence[str] | None = None,
                    suffix: str = "QF") -> DataFrame:
    """Keep rows where at least one flag column is known and != 1.

    A NULL flag never counts as passing; with no flag columns every row is kept.
    """
    cols = list(qf_cols) if qf_cols is not None else [c for c in df.columns
                                                       if c.endswith(suffix)]
    if not cols:
        return df
    return df.where(reduce(lambda a, b: a | b, [F.col(c) != 1 for c in cols]))


def qf_or_after_date(df: DataFrame, qf: str, time: str, cutoff) -> DataFrame:
    """Keep passed rows, and failed rows dated after ``cutoff`` (kept on purpose)."""
    day = F.to_date(F.col(time))
    return df.where((F.col(qf) == 0) | ((F.col(qf) == 1) & (day > F.lit(cutoff))))


def gross_range(df: DataFrame, ranges: DataFrame, variable: str = "variable",
                value: str = "observed", unknown: str = "null") -> DataFrame:
    """Values outside the inclusive [lo, hi] of their variable become NULL; rows stay.

    Of several ranges of a variable the value has to be inside all.
    ``unknown='null'`` also removes values of variables without a range row (as the
    published targets do); ``'keep'`` leaves them.
    """
    r = (ranges.groupBy(F.col("variable").alias("__gr_var"))
         .agg(F.max("lo").alias("__gr_lo"), F.min("hi").alias("__gr_hi")))
    d = df.join(r, F.col(variable) == F.col("__gr_var"), "left")
    inside = F.col(value).between(F.col("__gr_lo"), F.col("__gr_hi"))
    if unknown == "keep":
        inside = F.when(F.col("__gr_var").isNull(), F.lit(True)).otherwise(inside)
    d = d.withColumn(value, F.when(inside, F.col(value)))
    return d.drop("__gr_var", "__gr_lo", "__gr_hi")


def mask_rules(df: DataFrame, masks: DataFrame, site: str = "site_id",
               variable: str = "variable", time: str = "time",
               value: str = "observed") -> DataFrame:
    """Apply manual mask rules keyed by (site, variable); a value goes when any rule fires.

    The distinct rules of one key are packed into an array (one row per key), so the join
    never multiplies data rows; the rule test is a higher-order ``exists``.
    """
    packed = (masks.groupBy("site_id", "variable")
              .agg(F.collect_set(F.struct("date_from", "date_to", "bad_below",
                                           "bad_above")).alias("__rules"))
              .withColumnRenamed("site_id", "__m_site")
              .withColumnRenamed("variable", "__m_var"))
    d = df.join(packed,
                (F.col(site) == F.col("__m_site")) & (F.col(variable) == F.col("__m_var")),
                "left")
    day = F.to_date(F.col(time))
    v = F.col(value)

    def fires(r: Column) -> Column:
        in_dates = ((r["date_from"].isNull() | (day >= r["date_from"]))
                    & (r["date_to"].isNull() | (day <= r["date_to"])))
        no_bounds = r["bad_below"].isNull() & r["bad_above"].isNull()
        bad_value = (F.coalesce(v < r["bad_below"], F.lit(False))
                     | F.coalesce(v > r["bad_above"], F.lit(False)))
        return in_dates & (no_bounds | bad_value)

    hit = F.coalesce(F.exists(F.col("__rules"), fires), F.lit(False))
    d = d.withColumn(value, F.when(hit, F.lit(None).cast("double")).otherwise(v))
    return d.drop("__m_site", "__m_var", "__rules")


def _num(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def qc_flags(value: Column, prev: Column, lo, hi, spike) -> Column:
    """Three-valued final flag: outside [lo, hi], |change| > spike, or change == 0.

    ``lo``, ``hi`` and ``spike`` are numbers or per-row columns.
    """
    change = value - prev
    return ((F.abs(change) > _num(spike)) | ~value.between(_num(lo), _num(hi))
            | (change == 0))


def qc_series(df: DataFrame, keys: Sequence[str], time="time",
              value: str = "observed", lo=-5.0, hi=40.0, spike=5.0, unknown="keep",
              bucket: Column | None = None, flat_digits: int | None = 9) -> DataFrame:
    """Per-series range / spike / flat-line test on consecutive rows (ordered by time).

    ``time`` is the order key, or a list of order keys (time first, then tiebreaks).
    ``lo``, ``hi``, ``spike`` are numbers or per-row columns (e.g. joined from a
    parameter table), so several sources can be tested in one pass.

    ``unknown='keep'``: a value is removed only when a test is definitely failed.
    ``unknown='reject'``: a value is kept only when every test is definitely passed, so
    the first row of a series and any row after a missing one are removed too.
    ``unknown`` may also be a boolean column (true = keep).  Rows are never dropped, only
    values nulled.  The flat-line test compares values rounded to ``flat_digits`` places:
    the last bits of a mean depend on the order in which its values were added.
    """
    order = [time] if isinstance(time, str) else list(time)
    d = lag_columns(df, keys, order, [value], bucket=bucket, prefix="__prev_")
    v, p = F.col(value), F.col("__prev_" + value)
    if flat_digits is not None:
        change = v - p
        flag = ((F.abs(change) > _num(spike)) | ~v.between(_num(lo), _num(hi))
                | (F.round(v, flat_digits) - F.round(p, flat_digits) == 0))
    else:
        flag = qc_flags(v, p, lo, hi, spike)
    keep = F.when(flag == F.lit(True), F.lit(None).cast("double")).otherwise(v)
    reject = F.when(flag == F.lit(False), v)
    if isinstance(unknown, Column):
        out = F.when(unknown, keep).otherwise(reject)
    elif unknown == "keep":
        out = keep
    elif unknown == "reject":
        out = reject
    else:
        raise ValueError("unknown must be 'keep', 'reject' or a boolean column")
    return d.withColumn(value, out).drop("__prev_" + value)


def qc_by_source(df: DataFrame, params: DataFrame, keys: Sequence[str], time="time",
                 value: str = "observed", source: str = "source") -> DataFrame:
    """Series QC for several sources in one pass, thresholds taken per source.

    ``params`` is the (source, lo, hi, spike, by_depth) table: ``by_depth`` true keeps
    values whose test is unknown.  ``keys`` must include the source column, so every
    source stays its own series; one bucketed scan (one large shuffle) replaces one per
    source.  A row of a source without parameters is an error.
    """
    prm = params.select(
        F.col("source").alias("__q_src"), F.col("lo").alias("__q_lo"),
        F.col("hi").alias("__q_hi"), F.col("spike").alias("__q_spike"),
        F.col("by_depth").alias("__q_keep")).dropDuplicates(["__q_src"])
    d = df.join(prm, F.col(source) == F.col("__q_src"), "left")
    unknown = F.raise_error(F.concat(F.lit("no QC parameters for source "),
                                     F.coalesce(F.col(source), F.lit("NULL")))).cast("boolean")
    d = d.withColumn("__q_keep", F.when(F.col("__q_src").isNull(), unknown)
                     .otherwise(F.col("__q_keep")))
    d = qc_series(d, keys, time, value, lo=F.col("__q_lo"), hi=F.col("__q_hi"),
                  spike=F.col("__q_spike"), unknown=F.col("__q_keep"))
    return d.drop("__q_src", "__q_lo", "__q_hi", "__q_spike", "__q_keep")


def rate_of_change(df: DataFrame, keys: Sequence[str], time="time",
                   value: str = "observed", out: str = "change",
                   bucket: Column | None = None) -> DataFrame:
    """Change from the previous row of the same series (row based, crosses time gaps)."""
    order = [time] if isinstance(time, str) else list(time)
    d = lag_columns(df, keys, order, [value], bucket=bucket, prefix="__prev_")
    return d.withColumn(out, F.col(value) - F.col("__prev_" + value)).drop("__prev_" + value)


def qc_incremental(new: DataFrame, history: DataFrame, keys: Sequence[str],
                   time: str = "time", value: str = "observed", **qc) -> DataFrame:
    """Series QC of what newly arrived rows can change, for a daily refresh.

    New rows may fall between old ones, so each series is tested again from its first new
    row on: the result holds the new rows and the old rows after it, as QC over the full
    history would give them, and is to replace them.  The row before the first new one is
    context, taken with a hash aggregate.  ``history`` holds values as they were before QC;
    only what lies in or before the touched range is read, and NULL keys form series, too.
    ``qc`` takes the keyword arguments of ``qc_series``.
    """
    keys = list(keys)
    first = new.groupBy(*keys).agg(F.min(time).alias("__first"))
    first = first.select(*[F.col(k).alias(f"__n_{k}") for k in keys], "__first")
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__n_{k}")) for k in keys])
    touched = history.join(first, same).drop(*[f"__n_{k}" for k in keys])
    later = touched.where(F.col(time) >= F.col("__first")).drop("__first")
    context = (touched.where(F.col(time) < F.col("__first")).groupBy(*keys)
               .agg(F.max_by(value, time).alias(value), F.max(time).alias(time)))
    rows = new.unionByName(later, allowMissingColumns=True).withColumn("__ctx", F.lit(False))
    u = rows.unionByName(context.withColumn("__ctx", F.lit(True)), allowMissingColumns=True)
    q = qc_series(u, keys, time, value, **qc)
    return q.where(~F.col("__ctx")).drop("__ctx")
