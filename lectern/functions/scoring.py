"""Scores and weights as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, functions as F
from pyspark.sql.window import Window

# Two-sided normal quantiles by confidence level.
Z_SCORES = {
    0.80: 1.2815515655446004,
    0.90: 1.6448536269514722,
    0.95: 1.959963984540054,
    0.98: 2.3263478740408408,
    0.99: 2.5758293035489004,
}

# Model weight and signed signal of a star rating.
RATING_WEIGHT = {5: 1.00, 4: 0.80, 3: 0.50, 2: 0.20, 1: 0.10}
READ_WEIGHT = 0.35
RATING_SIGNAL = {5: 1.00, 4: 0.65, 3: 0.10, 2: -0.50, 1: -1.00}

# Weight of a library entry, by lowest star rating, then by shelf.
LIBRARY_RATING_WEIGHT = {5: 1.00, 4: 0.80, 3: 0.45, 2: -0.45, 1: -1.00}
LIBRARY_SHELF_WEIGHT = {"currently-reading": 0.30, "read": 0.25}
REREAD_STEP = 0.05
REREAD_CAP = 1.25

# Blend of the five-part hybrid score.
HYBRID_WEIGHTS = {
    "collaborative": 0.40,
    "content": 0.30,
    "rating_quality": 0.15,
    "preference_match": 0.10,
    "novelty": 0.05,
}

# Percentile rerank and min-max rerank defaults.
PERCENTILE_WEIGHTS = {"content": 0.45, "collaborative": 0.40, "popularity": 0.10, "novelty": 0.05}
RERANK_WEIGHTS = {"similarity": 0.85, "popularity": 0.10, "quality": 0.05}


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _lookup(key: Column, table: Mapping, default: Column) -> Column:
    """CASE chain over a small fixed table."""
    chain = None
    for match, value in table.items():
        chain = (F if chain is None else chain).when(key == F.lit(match), F.lit(value))
    return chain.otherwise(default)


def shares(weights: Mapping[str, float]) -> dict[str, float]:
    """Non-negative weights divided by their sum."""
    if any(w < 0 for w in weights.values()):
        raise ValueError("weights cannot be negative")
    total = sum(weights.values())
    if total <= 0:
        raise ValueError("at least one weight must be positive")
    return {name: w / total for name, w in weights.items()}


def bayesian_rating(rating, votes, prior_mean, prior_votes) -> Column:
    """Rating shrunk towards ``prior_mean`` by ``prior_votes`` virtual votes."""
    rating, votes = _col(rating).cast("double"), _col(votes).cast("double")
    prior_mean, prior_votes = (F.lit(x) if not isinstance(x, Column) else x for x in (prior_mean, prior_votes))
    seen = votes + prior_votes
    return F.when(rating.isNotNull() & votes.isNotNull(), votes / seen * rating + prior_votes / seen * prior_mean)


def z_score(confidence: float) -> float:
    level = round(confidence, 2)
    if level not in Z_SCORES:
        raise ValueError(f"confidence must be one of {sorted(Z_SCORES)}")
    return Z_SCORES[level]


def wilson_lower_bound(mean_rating, count, confidence: float = 0.95) -> Column:
    """Lower Wilson bound of the mean five-star rating seen as a share of 5."""
    z = z_score(confidence)
    p, n = _col(mean_rating) / F.lit(5.0), _col(count).cast("double")
    centre = p + F.lit(z * z) / (2 * n)
    spread = F.lit(z) * F.sqrt((p * (1 - p) + F.lit(z * z) / (4 * n)) / n)
    return F.when(n > 0, (centre - spread) / (1 + F.lit(z * z) / n))


def novelty_score(count) -> Column:
    count = _col(count).cast("double")
    return F.when(count > 0, 1 / F.ln(count + F.exp(F.lit(1.0)))).otherwise(F.lit(1.0))


def is_positive(is_read="is_read", rating="rating") -> Column:
    return (_col(is_read).cast("int") == 1) | (_col(rating).cast("int") > 0)


def interaction_weight(rating="rating", is_read="is_read") -> Column:
    read = F.when(_col(is_read).cast("int") == 1, F.lit(READ_WEIGHT)).otherwise(F.lit(0.0))
    return _lookup(_col(rating).cast("int"), RATING_WEIGHT, read).cast("float")


def preference_signal(rating="rating") -> Column:
    return _lookup(_col(rating).cast("int"), RATING_SIGNAL, F.lit(0.0)).cast("float")


def user_bucket(user_id="user_id", buckets: int = 64) -> Column:
    return F.pmod(_col(user_id).cast("bigint"), F.lit(buckets))


def library_preference_weight(rating="my_rating", shelf="exclusive_shelf", read_count="read_count") -> Column:
    """Signed weight of a library entry; re-reading raises a positive weight."""
    stars, shelf = F.coalesce(_col(rating).cast("double"), F.lit(0.0)), F.lower(_col(shelf))
    chain = None
    for floor, value in LIBRARY_RATING_WEIGHT.items():
        chain = (F if chain is None else chain).when(stars >= floor, F.lit(value))
    base = chain.otherwise(_lookup(shelf, LIBRARY_SHELF_WEIGHT, F.lit(0.0)))
    reads = F.coalesce(_col(read_count).cast("int"), F.lit(0))
    raised = F.least(base + F.lit(REREAD_STEP) * (reads - 1), F.lit(REREAD_CAP))
    return F.when((reads > 1) & (base > 0), raised).otherwise(base)


def recency_decay(date, reference_date, half_life_days: float = 0.0) -> Column:
    """0.5 ** (age / half life); 1 when switched off or the date is missing."""
    if half_life_days <= 0:
        return F.lit(1.0)
    reference = reference_date if isinstance(reference_date, Column) else F.lit(reference_date).cast("date")
    age = F.greatest(F.datediff(reference, _col(date).cast("date")), F.lit(0))
    return F.coalesce(F.pow(F.lit(0.5), age / F.lit(float(half_life_days))), F.lit(1.0))


def minmax_scale(value, partition_by: Sequence[str]) -> Column:
    """(x - min) / (max - min) within the partition; 0 where it has no spread.

    The partition is one user's candidate pool, bounded by the pool size.
    """
    value = _col(value).cast("double")
    window = Window.partitionBy(*partition_by)
    low, high = F.min(value).over(window), F.max(value).over(window)
    return F.when(high > low, (value - low) / (high - low)).otherwise(F.lit(0.0))


def log_popularity(count="ratings_count") -> Column:
    return F.log1p(F.coalesce(_col(count).cast("double"), F.lit(0.0)))


def hybrid_score(parts: Mapping[str, Column | str], weights: Mapping[str, float] | None = None) -> Column:
    """Weighted sum of the five named parts; the weights must add up to 1."""
    weights = dict(weights or HYBRID_WEIGHTS)
    if abs(sum(weights.values()) - 1.0) > 1e-9:
        raise ValueError(f"hybrid weights must sum to 1, got {sum(weights.values()):.6f}")
    return reduce(lambda a, b: a + b, (F.lit(weights[name]) * _col(parts[name]) for name in weights))


def percentile_rerank(similarity, popularity_percentile, novelty_percentile, weights=None) -> Column:
    share = shares(weights or PERCENTILE_WEIGHTS)
    return (
        F.lit(share["content"] + share["collaborative"]) * _col(similarity)
        + F.lit(share["popularity"]) * _col(popularity_percentile)
        + F.lit(share["novelty"]) * _col(novelty_percentile)
    )
