"""The user-item graph: k-core, weights, signals and training rows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from lectern.functions.scoring import interaction_weight, is_positive, preference_signal, user_bucket
from lectern.operators.ranking import top_k
from lectern.session import cut_lineage


def catalog_map(catalog: DataFrame) -> DataFrame:
    """Narrow projection of the catalog rows that occur in the interactions."""
    return catalog.where(F.col("interaction_book_id").isNotNull()).select(
        F.col("interaction_book_id").cast("bigint").alias("item_id"),
        F.col("book_id").cast("bigint").alias("local_book_id"),
        F.col("work_id").cast("bigint").alias("work_id"),
        "title",
        "primary_author",
        "primary_genre",
        F.col("is_canonical_edition").cast("boolean").alias("is_canonical_edition"),
        F.col("bayesian_rating").cast("double").alias("bayesian_rating"),
        F.col("ratings_count").cast("bigint").alias("ratings_count"),
    )


def positive_interactions(interactions: DataFrame) -> DataFrame:
    """Read or rated rows with the item id under its graph name."""
    return interactions.where(is_positive()).withColumnRenamed("book_id", "item_id")


def _entity_stats(edges: DataFrame, key: str, average: str, minimum: int) -> DataFrame:
    rated = F.col("rating").cast("int") > 0
    return (
        edges.groupBy(key)
        .agg(
            F.count("*").alias("interaction_count"),
            F.count_if(rated).alias("rating_count"),
            F.avg(F.when(rated, F.col("rating").cast("double"))).alias(average),
        )
        .where(F.col("interaction_count") >= minimum)
    )


def item_stats(edges: DataFrame, minimum: int = 30) -> DataFrame:
    return _entity_stats(edges, "item_id", "average_user_rating", minimum)


def user_stats(edges: DataFrame, minimum: int = 15) -> DataFrame:
    return _entity_stats(edges, "user_id", "average_rating", minimum)


def kcore_semi_join(edges: DataFrame, eligible: DataFrame, key: str) -> DataFrame:
    """Edges whose key is eligible; only the key column of the eligible set travels."""
    return edges.join(eligible.select(key), key, "left_semi")


def interaction_catalog_join(edges: DataFrame, mapped: DataFrame) -> DataFrame:
    """Edges with their catalog ids; a repeated map id repeats the edge."""
    return edges.join(mapped.select("item_id", "local_book_id", "work_id"), "item_id")


# edges are kept by so many buckets of their user and of their item
EDGE_BUCKETS = 64
# tables of changes that are summed up into one
COMPACTED = 16


def _bucket(key: str) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(EDGE_BUCKETS)).cast("int")


def _bucketed(edges: DataFrame, key: str, other: str) -> DataFrame:
    """The edges in a folder for each bucket of ``key``; a hot key's edges are dealt over tasks by the other end."""
    salt = F.pmod(F.xxhash64(other), F.lit(16))
    return cut_lineage(edges.withColumn("_bucket", _bucket(key)).repartition("_bucket", salt), "_bucket")


def _degrees(edges: DataFrame, key: str, sign: Column) -> DataFrame:
    """Per node: edges, rated edges and sum of ratings, each edge counted ``sign`` times."""
    rating = F.col("rating").cast("int")
    rated = lambda amount: F.sum(F.when(rating > 0, amount).otherwise(0))
    return edges.groupBy(key).agg(
        F.sum(sign).alias("edges"), rated(sign).alias("rated"), rated(sign * rating).alias("total")
    )


def _summed(history: list[DataFrame], key: str) -> DataFrame:
    rows = reduce(DataFrame.unionByName, history)
    return rows.groupBy(key).agg(*(F.sum(c).alias(c) for c in ("edges", "rated", "total")))


class _Side:
    """The nodes of one side: their degrees as a first count and the changes since."""

    def __init__(self, key: str, minimum: int, average: str, counted: DataFrame):
        self.key, self.minimum, self.average = key, max(minimum, 1), average
        self.history = [cut_lineage(counted)]
        self.size = self.history[0].where(F.col("edges") >= self.minimum).count()

    def change(self, delta: DataFrame) -> DataFrame:
        """Takes over the changes; gives the nodes that became eligible (1) or ceased to be (-1). Only nodes in ``delta`` are looked at."""
        delta = cut_lineage(delta)
        before = _summed([past.join(delta.select(self.key), self.key, "left_semi") for past in self.history], self.key)
        was = F.coalesce(F.col("_was"), F.lit(0))
        fits = lambda degree: (degree >= self.minimum).cast("int")
        joined = delta.join(before.select(self.key, F.col("edges").alias("_was")), self.key, "left")
        moved = joined.withColumn("sign", fits(was + F.col("edges")) - fits(was)).where(F.col("sign") != 0)
        moved = cut_lineage(moved.select(self.key, "sign"))
        self.history.append(delta)
        if len(self.history) > COMPACTED:
            self.history = [cut_lineage(_summed(self.history, self.key))]
        self.size += moved.agg(F.coalesce(F.sum("sign"), F.lit(0))).first()[0]
        return moved

    def eligible(self) -> DataFrame:
        found = _summed(self.history, self.key).where(F.col("edges") >= self.minimum)
        mean = F.when(F.col("rated") > 0, F.col("total").cast("double") / F.col("rated"))
        return found.select(
            self.key, F.col("edges").alias("interaction_count"), F.col("rated").alias("rating_count"), mean.alias(self.average)
        )


def _sent(edges: DataFrame, moved: DataFrame, by: str, to: str) -> DataFrame | None:
    """Changes of degree that the moved nodes send along their edges; None if no node moved.

    Only the buckets of moved nodes are read, at most ``EDGE_BUCKETS`` numbers reach the driver.
    """
    buckets = [r[0] for r in moved.select(_bucket(by)).distinct().collect()]
    if not buckets:
        return None
    return _degrees(edges.where(F.col("_bucket").isin(buckets)).join(moved, by), to, F.col("sign"))


def _peel(
    edges: DataFrame, recounted: DataFrame, users: DataFrame, min_item: int, min_user: int, max_iter: int | None
) -> tuple[DataFrame, DataFrame]:
    """The refinements of ``kcore_filter`` by what changes: after the first, only nodes that became eligible or ceased to be
    send +1 or -1 along their edges, and only nodes which these reach are looked at again."""
    by_user, by_item = _bucketed(recounted, "user_id", "item_id"), _bucketed(edges, "item_id", "user_id")
    one = F.lit(1)
    items = _Side("item_id", min_item, "average_user_rating", _degrees(kcore_semi_join(by_user, users, "user_id"), "item_id", one))
    kept = items.history[0].where(F.col("edges") >= items.minimum)
    found = _Side("user_id", min_user, "average_rating", _degrees(kcore_semi_join(by_item, kept, "item_id"), "user_id", one))
    now = found.history[0].where(F.col("edges") >= found.minimum).select("user_id")
    gone, come = users.select("user_id").join(now, "user_id", "left_anti"), now.join(users, "user_id", "left_anti")
    moved = cut_lineage(gone.withColumn("sign", F.lit(-1)).unionByName(come.withColumn("sign", one)))
    step, sizes = 1, (items.size, found.size)
    while max_iter is None or step < max_iter:
        delta = _sent(by_user, moved, "user_id", "item_id")
        if delta is None:
            break
        delta = _sent(by_item, items.change(delta), "item_id", "user_id")
        if delta is None:
            break
        moved = found.change(delta)
        step, previous, sizes = step + 1, sizes, (items.size, found.size)
        if sizes == previous:
            break
    return cut_lineage(items.eligible()), cut_lineage(found.eligible())


def kcore_filter(
    interactions: DataFrame,
    mapped: DataFrame,
    min_item: int = 30,
    min_user: int = 15,
    max_iter: int = 2,
    require_mapped: bool = False,
    until_converged: bool = False,
) -> tuple[DataFrame, DataFrame]:
    """Eligible (items, users) with the counts of the step that chose them.

    Items are first counted over mapped edges, users over the edges of those items;
    each refinement recounts items over eligible users (mapped or not, unless
    ``require_mapped``) and users over eligible items. It stops after ``max_iter``
    refinements or once both counts repeat; ``until_converged`` lifts the limit. Beyond
    two refinements only changes are counted (``_peel``).
    """
    edges = cut_lineage(positive_interactions(interactions).select("user_id", "item_id", "rating"))
    catalogued = interaction_catalog_join(edges, mapped).select("user_id", "item_id", "rating")
    recounted = catalogued if require_mapped else edges
    items = cut_lineage(item_stats(catalogued, min_item))
    users = cut_lineage(user_stats(kcore_semi_join(edges, items, "item_id"), min_user))
    if until_converged or max_iter > 2:
        return _peel(edges, recounted, users, min_item, min_user, None if until_converged else max_iter)
    sizes, step = None, 0
    while step < max_iter:
        items = cut_lineage(item_stats(kcore_semi_join(recounted, users, "user_id"), min_item))
        users = cut_lineage(user_stats(kcore_semi_join(edges, items, "item_id"), min_user))
        step += 1
        if step == max_iter:
            break
        previous, sizes = sizes, (items.count(), users.count())
        if sizes == previous:
            break
    return items, users


def implicit_read_count(stats: DataFrame) -> DataFrame:
    return stats.withColumn("implicit_read_count", F.col("interaction_count") - F.col("rating_count"))


def stats_enrich_join(items: DataFrame, mapped: DataFrame) -> DataFrame:
    """Item statistics with their catalog columns (null for unmapped items)."""
    columns = mapped.withColumnRenamed("ratings_count", "catalog_ratings_count")
    return implicit_read_count(items.join(columns, "item_id", "left"))


def filtered_interactions(
    interactions: DataFrame, items: DataFrame, users: DataFrame, mapped: DataFrame, partitions: int = 64
) -> DataFrame:
    """Positive edges inside both eligible sets, mapped and weighted."""
    edges = kcore_semi_join(positive_interactions(interactions), users, "user_id")
    edges = interaction_catalog_join(kcore_semi_join(edges, items, "item_id"), mapped)
    return edges.select(
        F.col("user_id").cast("bigint").alias("user_id"),
        F.col("item_id").cast("bigint").alias("item_id"),
        "local_book_id",
        "work_id",
        F.col("rating").cast("tinyint").alias("rating"),
        F.col("is_read").cast("boolean").alias("is_read"),
        F.col("is_reviewed").cast("boolean").alias("is_reviewed"),
        interaction_weight().alias("interaction_weight"),
        preference_signal().alias("preference_signal"),
        user_bucket("user_id", partitions).alias("user_bucket"),
    )


def positive_only(training: DataFrame) -> DataFrame:
    return training.where(F.col("preference_signal") > 0)


def training_join(filtered: DataFrame, users: DataFrame, items: DataFrame) -> DataFrame:
    """Weighted edges of known users and items."""
    weighted = filtered.where(F.col("interaction_weight") > 0)
    return kcore_semi_join(kcore_semi_join(weighted, users, "user_id"), items, "item_id")


def dedupe_training(training: DataFrame) -> DataFrame:
    """One row per user and item with the strongest weight and signal."""
    return training.groupBy("user_id", "item_id").agg(
        F.max("interaction_weight").alias("interaction_weight"),
        F.max("preference_signal").alias("preference_signal"),
    )


def cap_per_user(training: DataFrame, cap: int = 0) -> DataFrame:
    """The strongest ``cap`` rows of every user; 0 keeps all."""
    if cap <= 0:
        return training
    order = [F.col("interaction_weight").desc(), F.col("preference_signal").desc(), F.col("item_id").asc()]
    return top_k(training, ["user_id"], order, cap, "_rank").drop("_rank")


def training_rows(
    filtered: DataFrame, users: DataFrame, items: DataFrame, cap: int = 0, positive: bool = False
) -> DataFrame:
    joined = training_join(filtered, users, items)
    return cap_per_user(dedupe_training(positive_only(joined) if positive else joined), cap)


def graph_checks(filtered: DataFrame) -> DataFrame:
    """One-pass quality profile of the filtered edges."""
    return filtered.agg(
        F.count("*").alias("rows"),
        F.count_distinct("user_id").alias("users"),
        F.count_distinct("item_id").alias("items"),
        F.min("rating").alias("minimum_rating"),
        F.max("rating").alias("maximum_rating"),
        F.count_if(F.col("interaction_weight") < 0).alias("negative_weights"),
        F.count_if(F.col("preference_signal") < 0).alias("negative_signals"),
    )
