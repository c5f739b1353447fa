"""Interaction graph: statistics, k-core, weights and training rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import scoring
from lectern.operators import interactions as graph
from lectern.plans.catalog_queries import CATALOG_SQL, catalog
from lectern.plans.inputs import Inputs, query, rounded

# thresholds that keep a core at the density of the given tables
MIN_ITEM, MIN_USER, PARTITIONS = 24, 15, 64

_STATS = """COUNT(*) AS interaction_count, COUNT(*) FILTER (rating > 0) AS rating_count,
    AVG(CASE WHEN rating > 0 THEN CAST(rating AS DOUBLE) END)"""
GRAPH_SQL = {
    **CATALOG_SQL,
    "positives": "SELECT *, book_id AS item_id FROM interactions WHERE is_read = 1 OR rating > 0",
    "mapped": """SELECT interaction_book_id AS item_id, book_id AS local_book_id, work_id, title, primary_author,
        primary_genre, is_canonical_edition, bayesian_rating, ratings_count FROM catalog_c WHERE interaction_book_id IS NOT NULL""",
    "items0": f"""SELECT item_id, {_STATS} AS average_user_rating FROM positives JOIN mapped USING (item_id)
        GROUP BY item_id HAVING COUNT(*) >= {MIN_ITEM}""",
    "users0": f"""SELECT user_id, {_STATS} AS average_rating FROM positives WHERE item_id IN (SELECT item_id FROM items0)
        GROUP BY user_id HAVING COUNT(*) >= {MIN_USER}""",
}

#: refinements after which the given tables have long stopped changing
CONVERGED = 16
_CORES = {}
for _step in range(1, CONVERGED + 1):
    _CORES[f"items{_step}"] = f"""SELECT item_id, {_STATS} AS average_user_rating FROM positives
        WHERE user_id IN (SELECT user_id FROM users{_step - 1}) GROUP BY item_id HAVING COUNT(*) >= {MIN_ITEM}"""
    _CORES[f"users{_step}"] = f"""SELECT user_id, {_STATS} AS average_rating FROM positives
        WHERE item_id IN (SELECT item_id FROM items{_step}) GROUP BY user_id HAVING COUNT(*) >= {MIN_USER}"""
GRAPH_SQL.update({name: _CORES[name] for name in ("items1", "users1", "items2", "users2")})
CONVERGED_SQL = {**GRAPH_SQL, **_CORES}
_WEIGHT = """CAST(CASE rating WHEN 5 THEN 1.0 WHEN 4 THEN 0.8 WHEN 3 THEN 0.5 WHEN 2 THEN 0.2 WHEN 1 THEN 0.1
    ELSE CASE WHEN is_read = 1 THEN 0.35 ELSE 0 END END AS FLOAT)"""
_SIGNAL = "CAST(CASE rating WHEN 5 THEN 1.0 WHEN 4 THEN 0.65 WHEN 3 THEN 0.1 WHEN 2 THEN -0.5 WHEN 1 THEN -1.0 ELSE 0 END AS FLOAT)"
GRAPH_SQL["filtered"] = f"""SELECT user_id, item_id, local_book_id, work_id, rating, is_read = 1 AS is_read,
    is_reviewed = 1 AS is_reviewed, {_WEIGHT} AS interaction_weight, {_SIGNAL} AS preference_signal,
    user_id % {PARTITIONS} AS user_bucket
    FROM positives JOIN (SELECT item_id, local_book_id, work_id FROM mapped) USING (item_id)
    WHERE user_id IN (SELECT user_id FROM users2) AND item_id IN (SELECT item_id FROM items2)"""
GRAPH_SQL["training"] = """SELECT user_id, item_id, MAX(interaction_weight) AS interaction_weight,
    MAX(preference_signal) AS preference_signal FROM filtered WHERE interaction_weight > 0 GROUP BY user_id, item_id"""


def mapped(inp: Inputs):
    return graph.catalog_map(catalog(inp))


def core(inp: Inputs):
    return graph.kcore_filter(inp.view("interactions"), mapped(inp), MIN_ITEM, MIN_USER)


def filtered(inp: Inputs):
    books = mapped(inp)
    items, users = graph.kcore_filter(inp.view("interactions"), books, MIN_ITEM, MIN_USER)
    return graph.filtered_interactions(inp.view("interactions"), items, users, books, PARTITIONS), items, users


def training(inp: Inputs, cap: int = 0):
    edges, items, users = filtered(inp)
    return graph.training_rows(edges, users, items, cap)


@query("interaction_weight", f"SELECT user_id, book_id, rating, is_read, {_WEIGHT} AS interaction_weight FROM interactions")
def interaction_weight(inp):
    return inp.view("interactions").select(
        "user_id", "book_id", "rating", "is_read", scoring.interaction_weight().alias("interaction_weight")
    )


@query("preference_signal", f"SELECT user_id, book_id, rating, {_SIGNAL} AS preference_signal FROM interactions")
def preference_signal(inp):
    return inp.view("interactions").select(
        "user_id", "book_id", "rating", scoring.preference_signal().alias("preference_signal")
    )


@query("positive_interaction", "SELECT user_id, item_id, is_read, rating, is_reviewed FROM positives", GRAPH_SQL)
def positive_interaction(inp):
    return graph.positive_interactions(inp.view("interactions"))


@query("user_bucket", "SELECT user_id, user_id % 64 AS user_bucket, COUNT(*) AS edges FROM interactions GROUP BY user_id")
def user_bucket(inp):
    return (
        inp.view("interactions").groupBy("user_id", scoring.user_bucket().alias("user_bucket")).agg(F.count("*").alias("edges"))
    )


@query("item_stats", "SELECT item_id, interaction_count, rating_count, ROUND(average_user_rating, 6) AS average_user_rating FROM items0", GRAPH_SQL)
def item_stats(inp):
    edges = graph.interaction_catalog_join(graph.positive_interactions(inp.view("interactions")), mapped(inp))
    return rounded(graph.item_stats(edges, MIN_ITEM), "average_user_rating")


@query(
    "user_stats",
    f"""SELECT user_id, COUNT(*) AS interaction_count, COUNT(*) FILTER (rating > 0) AS rating_count,
    ROUND(AVG(CASE WHEN rating > 0 THEN CAST(rating AS DOUBLE) END), 6) AS average_rating
    FROM positives GROUP BY user_id HAVING COUNT(*) >= {MIN_USER}""",
    GRAPH_SQL,
)
def user_stats(inp):
    return rounded(graph.user_stats(graph.positive_interactions(inp.view("interactions")), MIN_USER), "average_rating")


@query("kcore_items", "SELECT item_id, interaction_count, rating_count, ROUND(average_user_rating, 6) AS average_user_rating FROM items2", GRAPH_SQL)
def kcore_items(inp):
    return rounded(core(inp)[0], "average_user_rating")


@query("kcore_users", "SELECT user_id, interaction_count, rating_count, ROUND(average_rating, 6) AS average_rating FROM users2", GRAPH_SQL)
def kcore_users(inp):
    return rounded(core(inp)[1], "average_rating")


@query(
    "kcore_filter",
    """SELECT 'items' AS side, COUNT(*) AS kept, CAST(SUM(interaction_count) AS BIGINT) AS interactions FROM items2
    UNION ALL SELECT 'users', COUNT(*), CAST(SUM(interaction_count) AS BIGINT) FROM users2""",
    GRAPH_SQL,
)
def kcore_filter(inp):
    sides = [
        side.agg(F.count("*").alias("kept"), F.sum("interaction_count").alias("interactions")).withColumn("side", F.lit(name))
        for name, side in zip(("items", "users"), core(inp))
    ]
    return sides[0].unionByName(sides[1])


@query(
    "kcore_converged",
    f"""SELECT 'item' AS side, item_id AS id, interaction_count, rating_count, ROUND(average_user_rating, 6) AS average
    FROM items{CONVERGED} UNION ALL SELECT 'user', user_id, interaction_count, rating_count, ROUND(average_rating, 6)
    FROM users{CONVERGED}""",
    CONVERGED_SQL,
)
def kcore_converged(inp):
    """Both sides of the core refined until it stays as it is."""
    items, users = graph.kcore_filter(inp.view("interactions"), mapped(inp), MIN_ITEM, MIN_USER, until_converged=True)
    side = lambda df, name: rounded(
        df.select(F.lit(name).alias("side"), F.col(df.columns[0]).cast("bigint").alias("id"), "interaction_count", "rating_count",
                  F.col(df.columns[3]).alias("average")), "average")
    return side(items, "item").unionByName(side(users, "user"))


@query("kcore_semi_join", "SELECT user_id, item_id, rating FROM positives WHERE item_id IN (SELECT item_id FROM items0)", GRAPH_SQL)
def kcore_semi_join(inp):
    edges = graph.positive_interactions(inp.view("interactions"))
    items = graph.item_stats(graph.interaction_catalog_join(edges, mapped(inp)), MIN_ITEM)
    return graph.kcore_semi_join(edges, items, "item_id").select("user_id", "item_id", "rating")


@query("interaction_catalog_join", "SELECT user_id, item_id, rating, local_book_id, work_id FROM positives JOIN mapped USING (item_id)", GRAPH_SQL)
def interaction_catalog_join(inp):
    joined = graph.interaction_catalog_join(graph.positive_interactions(inp.view("interactions")), mapped(inp))
    return joined.select("user_id", "item_id", "rating", "local_book_id", "work_id")


@query(
    "catalog_map",
    """SELECT item_id, local_book_id, work_id, title, primary_author, primary_genre, is_canonical_edition,
    ROUND(bayesian_rating, 6) AS bayesian_rating, ratings_count FROM mapped""",
    GRAPH_SQL,
)
def catalog_map(inp):
    return rounded(mapped(inp), "bayesian_rating")


@query(
    "stats_enrich_join",
    """SELECT item_id, local_book_id, work_id, title, primary_author, primary_genre, is_canonical_edition,
    ROUND(bayesian_rating, 6) AS bayesian_rating, ratings_count AS catalog_ratings_count, interaction_count, rating_count,
    ROUND(average_user_rating, 6) AS average_user_rating, interaction_count - rating_count AS implicit_read_count
    FROM items2 LEFT JOIN mapped USING (item_id)""",
    GRAPH_SQL,
)
def stats_enrich_join(inp):
    books = mapped(inp)
    items, _ = graph.kcore_filter(inp.view("interactions"), books, MIN_ITEM, MIN_USER)
    return rounded(graph.stats_enrich_join(items, books), "bayesian_rating", "average_user_rating")


@query("implicit_read_count", "SELECT user_id, interaction_count, rating_count, interaction_count - rating_count AS implicit_read_count FROM users2", GRAPH_SQL)
def implicit_read_count(inp):
    return graph.implicit_read_count(core(inp)[1]).drop("average_rating")


@query("filtered_interactions", "SELECT * FROM filtered", GRAPH_SQL)
def filtered_interactions(inp):
    return filtered(inp)[0]


@query(
    "training_join",
    "SELECT user_id, item_id, interaction_weight, preference_signal FROM filtered WHERE interaction_weight > 0",
    GRAPH_SQL,
)
def training_join(inp):
    edges, items, users = filtered(inp)
    return graph.training_join(edges, users, items).select("user_id", "item_id", "interaction_weight", "preference_signal")


@query(
    "positive_only",
    """SELECT user_id, item_id, MAX(interaction_weight) AS interaction_weight, MAX(preference_signal) AS preference_signal
    FROM filtered WHERE interaction_weight > 0 AND preference_signal > 0 GROUP BY user_id, item_id""",
    GRAPH_SQL,
)
def positive_only(inp):
    edges, items, users = filtered(inp)
    return graph.training_rows(edges, users, items, cap=0, positive=True)


@query("dedupe_training", "SELECT * FROM training", GRAPH_SQL)
def dedupe_training(inp):
    edges, items, users = filtered(inp)
    return graph.dedupe_training(graph.training_join(edges, users, items))


@query(
    "cap_per_user",
    """SELECT user_id, item_id, interaction_weight, preference_signal FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id
    ORDER BY interaction_weight DESC, preference_signal DESC, item_id) AS rn FROM training) WHERE rn <= 20""",
    GRAPH_SQL,
)
def cap_per_user(inp):
    return training(inp, 20)


@query(
    "distinct_checks",
    """SELECT COUNT(*) AS rows, COUNT(DISTINCT user_id) AS users, COUNT(DISTINCT item_id) AS items,
    MIN(rating) AS minimum_rating, MAX(rating) AS maximum_rating, COUNT(*) FILTER (interaction_weight < 0) AS negative_weights,
    COUNT(*) FILTER (preference_signal < 0) AS negative_signals FROM filtered""",
    GRAPH_SQL,
)
def distinct_checks(inp):
    return graph.graph_checks(filtered(inp)[0])
