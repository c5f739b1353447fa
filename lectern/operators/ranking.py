"""Exact ranks, running totals and quantiles that survive hot groups.

A window puts a whole group into one task. The functions here count the groups
first (a combined count, no sort) and keep the plain window for those of up to
``split_rows`` rows. Larger groups - or the whole table, when there is no group key -
are range-partitioned by (key, order), ranked per range and shifted by the totals of
the ranges before. Only those per-range totals are broadcast: at most one row per
hot group and range.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from lectern.session import cut_lineage

SPLIT_ROWS = 1_000_000
# the planner prunes a ranking window before its exchange up to this rank
PRUNED_RANK = 1_000
SALTS = 64

_RANGE = "_range"


def _same(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    return reduce(lambda a, b: a & b, (left[a].eqNullSafe(right[b]) for a, b in pairs))


def _range_running_total(df: DataFrame, keys: list[str], order: list[Column], amount: Column, out: str) -> DataFrame:
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = df.repartitionByRange(ranges, *(F.col(k).asc() for k in keys), *order)
    # range bounds are sampled, so the assignment is fixed by a checkpoint
    parts = cut_lineage(parts.withColumn(_RANGE, F.spark_partition_id()).withColumn("_amount", amount))
    running = Window.partitionBy(_RANGE, *keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    earlier = Window.partitionBy(*keys).orderBy(_RANGE).rowsBetween(Window.unboundedPreceding, -1)
    shifts = (
        parts.groupBy(_RANGE, *keys)
        .agg(F.sum("_amount").alias("_sum"))
        .withColumn("_shift", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)))
        .select(F.col(_RANGE).alias("_r"), *(F.col(k).alias(f"_k_{k}") for k in keys), "_shift")
    )
    local = parts.withColumn("_local", F.sum("_amount").over(running))
    on = _same(local, shifts, [(_RANGE, "_r"), *((k, f"_k_{k}") for k in keys)])
    joined = local.join(F.broadcast(shifts), on)
    return joined.select(*df.columns, (F.col("_local") + F.col("_shift")).alias(out))


def running_total(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    amount: Column | None = None,
    out: str = "running_total",
    split_rows: int = SPLIT_ROWS,
) -> DataFrame:
    """Inclusive running sum of ``amount`` (1 by default) per key.

    ``order`` has to be unique within a key.
    """
    keys, order = list(keys), list(order)
    amount = (F.lit(1) if amount is None else amount).cast("bigint")
    window = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    plain = df.withColumn(out, F.sum(amount).over(window))
    if not keys:
        return plain if df.count() <= split_rows else _range_running_total(df, keys, order, amount, out)
    hot = df.groupBy(*keys).count().where(F.col("count") > split_rows).drop("count")
    if hot.isEmpty():
        return plain
    # at most rows / split_rows hot keys
    hot = hot.select(*(F.col(k).alias(f"_h_{k}") for k in keys))
    on = _same(df, hot, [(k, f"_h_{k}") for k in keys])
    cold_rows = df.join(F.broadcast(hot), on, "left_anti").withColumn(out, F.sum(amount).over(window))
    hot_rows = df.join(F.broadcast(hot), on, "left_semi")
    return cold_rows.unionByName(_range_running_total(hot_rows, keys, order, amount, out))


def rank_rows(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """ROW_NUMBER for every row (``order`` unique within the key), as bigint."""
    return running_total(df, keys, order, None, out, split_rows)


def top_k(df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, out: str = "rank") -> DataFrame:
    """The first ``k`` rows per key with their rank.

    Only rank <= k leaves each map task, so a hot key ships k rows per task. Above
    the rank the planner prunes to, a salted first round does the same.
    """
    order = list(order)
    if k > PRUNED_RANK:
        salt = F.pmod(F.xxhash64(*df.columns), F.lit(SALTS))
        first = Window.partitionBy(*keys, "_salt").orderBy(*order)
        df = (
            df.withColumn("_salt", salt)
            .withColumn("_rank", F.row_number().over(first))
            .where(F.col("_rank") <= k)
            .drop("_salt", "_rank")
        )
    ranked = df.withColumn(out, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where(F.col(out) <= k)


def top_n(df: DataFrame, order: Sequence[Column], n: int, out: str = "rank") -> DataFrame:
    """Global top ``n``. Up to ``PRUNED_RANK`` rows: per-task top n, merged in one task; beyond it, ranked by ranges."""
    order = list(order)
    if n > PRUNED_RANK:
        return rank_rows(df, [], order, out).where(F.col(out) <= n)
    best = df.orderBy(*order).limit(n)
    return best.withColumn(out, F.row_number().over(Window.orderBy(*order)))


def dense_index(
    df: DataFrame, order: Sequence[Column], out: str = "index", split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """0-based position in the global order."""
    ranked = rank_rows(df, [], order, out, split_rows)
    return ranked.withColumn(out, F.col(out) - 1)


def cume_dist(df: DataFrame, value: str, out: str, split_rows: int = SPLIT_ROWS) -> DataFrame:
    """Global CUME_DIST with nulls first, from counts per distinct value."""
    counts = cut_lineage(df.groupBy(F.col(value).alias("_value")).agg(F.count("*").alias("_n")))
    run = running_total(counts, [], [F.col("_value").asc_nulls_first()], F.col("_n"), "_upto", split_rows)
    total = counts.agg(F.sum("_n")).first()[0] or 0
    share = run.select("_value", (F.col("_upto") / F.lit(total)).alias(out))
    return df.join(share, df[value].eqNullSafe(share["_value"]), "left").drop("_value")


def value_counts(df: DataFrame, keys: Sequence[str], value: str, *extra: Column) -> DataFrame:
    """Rows (and extra aggregates) per key and distinct value, read from the source once."""
    counted = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("_n"), *extra)
    return cut_lineage(counted)


def counted_quantile(
    counts: DataFrame, keys: Sequence[str], value: str, q: float, out: str, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Interpolated quantile per key of a ``value_counts`` table."""
    keys = list(keys)
    run = running_total(counts, keys, [F.col(value).asc()], F.col("_n"), "_upto", split_rows)
    if keys:
        totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_total"))
        totals = totals.select(*(F.col(k).alias(f"_t_{k}") for k in keys), "_total")
        run = run.join(totals, _same(run, totals, [(k, f"_t_{k}") for k in keys]))
    else:
        run = run.withColumn("_total", F.lit(counts.agg(F.sum("_n")).first()[0] or 0))
    position = F.lit(q) * (F.col("_total") - 1)
    reached = lambda p: F.min(F.when(F.col("_upto") > p, F.col(value)))
    bounds = run.groupBy(*keys).agg(
        reached(F.floor(position)).alias("_low"),
        reached(F.ceil(position)).alias("_high"),
        F.max(position - F.floor(position)).alias("_part"),
    )
    return bounds.select(*keys, (F.col("_low") + (F.col("_high") - F.col("_low")) * F.col("_part")).alias(out))


def grouped_quantile(
    df: DataFrame, keys: Sequence[str], value: str, q: float, out: str, split_rows: int = SPLIT_ROWS
) -> DataFrame:
    """Interpolated quantile of the non-null values per key (one row without keys)."""
    return counted_quantile(value_counts(df, keys, value), keys, value, q, out, split_rows)


def _cut(bins: DataFrame, keys: list[str], bin_: str, take: str, n: int) -> DataFrame:
    """(keys, _cut<n>, _rest<n>): the bin in which the wanted rows of a key run out, and how many are wanted from it."""
    counted = cut_lineage(bins.groupBy(*keys, take, bin_).agg(F.count("*").alias("_n")))
    upto = F.sum("_n").over(Window.partitionBy(*keys).orderBy(bin_).rowsBetween(Window.unboundedPreceding, 0))
    run = counted.withColumn("_upto", upto).where(F.col("_upto") - F.col("_n") < F.col(take))
    last = F.max_by(F.struct(bin_, F.least(F.col(take) - F.col("_upto") + F.col("_n"), F.col("_n")).alias("_r")), bin_)
    return run.groupBy(*keys).agg(last.alias("_l")).select(*keys, F.col(f"_l.{bin_}").alias(f"_cut{n}"), F.col("_l._r").alias(f"_rest{n}"))


def first_rows(df: DataFrame, keys: Sequence[str], wanted: DataFrame, bins: Sequence[Column], order: Sequence[Column]) -> DataFrame:
    """The first rows of each key by ``order``, as many as ``wanted`` (keys, _take) says, without ranking the table.

    ``bins`` are two columns of few values, the first digits of what ``order`` sorts by. Counts by bin, combined in the map
    tasks, give the bin in which the wanted rows run out; counts by the second bin cut that one. Rows before the cut pass a
    filter and never move, only those of the last small bin are ranked. Keys that are null or not wanted give no rows, a key
    with fewer rows gives all; repeated rows count each.
    """
    keys, order = list(keys), list(order)
    named = df.withColumns({"_bin0": bins[0], "_bin1": bins[1]})
    wanted = wanted.where(F.col("_take") > 0).select(*keys, "_take")
    thin = named.select(*keys, "_bin0", "_bin1")
    first = cut_lineage(_cut(thin.join(wanted, keys), keys, "_bin0", "_take", 0))
    inside = thin.join(first, keys).where(F.col("_bin0") == F.col("_cut0"))
    cuts = cut_lineage(first.join(_cut(inside, keys, "_bin1", "_rest0", 1), keys))
    placed = named.join(cuts, keys)
    before = (F.col("_bin0") < F.col("_cut0")) | ((F.col("_bin0") == F.col("_cut0")) & (F.col("_bin1") < F.col("_cut1")))
    on_it = (F.col("_bin0") == F.col("_cut0")) & (F.col("_bin1") == F.col("_cut1"))
    ranked = rank_rows(placed.where(on_it), keys, order, "_place").where(F.col("_place") <= F.col("_rest1"))
    return placed.where(before).select(*df.columns).unionByName(ranked.select(*df.columns))
