"""Mixing to target weights: iterative proportional fitting of token weights, then a calibrated sample.

Documents are summed into cells of source, language and topic. The cells' weights are raked in turn to the three marginals
until they fit, and never above the tokens that a cell has. A document stays with its cell's weight over its cell's
tokens as probability, decided by a hash of its id. Everything is DataFrame operations; what repeats works on cells only.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.llm.common import prepare, store

DIMENSIONS = ("source", "language", "topic")


@dataclass(frozen=True)
class Mix:
    """budget: share of all tokens that the sample shall have. A margin's target shares are its token shares to the power
    given here, scaled to 1 (0: all equal, 1: as they are), or ``targets[dimension][value]`` where given."""

    budget: float = 0.5
    powers: dict[str, float] = field(default_factory=lambda: {"source": 0.7, "language": 0.6, "topic": 0.8})
    targets: dict[str, dict[str, float]] = field(default_factory=dict)
    rounds: int = 12
    rounds_per_store: int = 3
    seed: str = "mix"


#: Topics by what a text holds, the first that fits.
TOPICS = (("contact", "@"), ("web", "://"), ("list", " | "), ("paragraphs", "\n"))


def topic_of(text: Column) -> Column:
    """A coarse topic from marks in the text; ``prose`` where none is there."""
    found = F.lit("prose")
    for name, mark in reversed(TOPICS):
        found = F.when(F.contains(text, F.lit(mark)), name).otherwise(found)
    return found


def token_weight(text: Column) -> Column:
    """Tokens of a text, at four bytes each, rounded up."""
    return F.ceil(F.octet_length(text) / 4).cast("bigint")


def chance_of(id_text: Column, seed: str) -> Column:
    """A number in [0, 1) from the first 32 bits of an MD5."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(seed + ":"), id_text)), 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def _rake(cells: DataFrame, dimension: str, targets: str) -> DataFrame:
    margin = Window.partitionBy(dimension)
    scaled = F.when(F.sum("weight").over(margin) > 0, F.col("weight") * F.col(targets) / F.sum("weight").over(margin)).otherwise(F.lit(0.0))
    return cells.withColumn("weight", F.least(scaled, F.col("tokens").cast("double")))


def fit(cells: DataFrame, mix: Mix) -> DataFrame:
    """(source, language, topic, tokens, weight): the raked weights of the cells (source, language, topic, tokens)."""
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    for d in DIMENSIONS:
        own = cells.groupBy(d).agg(F.sum("tokens").alias("own"))
        if d in mix.targets:
            given = F.create_map(*(F.lit(x) for pair in mix.targets[d].items() for x in pair))
            raw = F.coalesce(F.element_at(given, F.col(d)), F.lit(0.0))
        else:
            raw = F.pow(F.col("own") / F.lit(max(total, 1)), F.lit(mix.powers[d]))
        margin = own.select(d, F.when(F.col("own") > 0, raw).otherwise(0.0).alias("raw"))
        whole = margin.agg(F.sum("raw")).first()[0] or 1.0
        target = F.col("raw") / F.lit(float(whole)) * F.lit(total) * F.lit(mix.budget)
        cells = cells.join(margin.select(d, target.alias(f"target_{d}")), d)
    columns = [*DIMENSIONS, "tokens", *(f"target_{d}" for d in DIMENSIONS)]
    cells = store(cells.select(*columns, (F.col("tokens") * F.lit(mix.budget)).cast("double").alias("weight")), "cells")
    for done in range(1, mix.rounds + 1):
        for d in DIMENSIONS:
            cells = _rake(cells, d, f"target_{d}")
        if done % mix.rounds_per_store == 0 or done == mix.rounds:
            cells = store(cells, "raked")
    return cells.select(*DIMENSIONS, "tokens", "weight")


def keyed(docs: DataFrame, text_col: str, source_col: str, lang_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumn("__mix", F.struct(
        F.coalesce(F.col(source_col).cast("string"), F.lit("")).alias("source"), F.coalesce(F.col(lang_col).cast("string"), F.lit("")).alias("language"),
        topic_of(text).alias("topic"), token_weight(text).alias("tokens")))


def mix(
    docs: DataFrame, plan: Mix = Mix(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", lang_col: str = "lang",
) -> DataFrame:
    """The rows with a struct column ``__mixed``: source, language, topic, tokens, probability and kept.

    Null sources and languages are the empty value, null texts are empty; an empty text has no tokens, changes no margin and is
    never sampled. Rows with the same id are kept or dropped together within a cell; all null ids count as one id. An empty
    table gives an empty result.
    """
    prepare(docs.sparkSession)
    marked = keyed(docs, text_col, source_col, lang_col).withColumn(
        "__chance", chance_of(F.coalesce(F.col(id_col).cast("string"), F.lit("")), plan.seed))
    cells = marked.groupBy(*(F.col(f"__mix.{d}").alias(d) for d in DIMENSIONS)).agg(F.sum("__mix.tokens").alias("tokens"))
    fitted = fit(store(cells, "tokens"), plan)
    chance = fitted.select(
        *(F.col(d).alias(f"__{d}") for d in DIMENSIONS),
        F.when(F.col("tokens") > 0, F.round(F.col("weight") / F.col("tokens"), 9)).otherwise(0.0).alias("__probability"))
    joined = marked.join(chance, [F.col(f"__mix.{d}") == F.col(f"__{d}") for d in DIMENSIONS])
    return joined.withColumn("__mixed", F.struct(
        *(F.col(f"__mix.{c}").alias(c) for c in (*DIMENSIONS, "tokens")), F.col("__probability").alias("probability"),
        (F.col("__chance") < F.col("__probability")).alias("kept"))).select(*docs.columns, "__mixed")


def sample(docs: DataFrame, plan: Mix = Mix(), **columns: str) -> DataFrame:
    """The rows that ``mix`` keeps, with their own columns."""
    return mix(docs, plan, **columns).where("__mixed.kept").select(*docs.columns)


def weights(docs: DataFrame, plan: Mix = Mix(), id_col: str = "doc_id") -> DataFrame:
    """(id, source, language, topic, tokens, probability, kept) of every row."""
    return mix(docs, plan, id_col=id_col).select(id_col, "__mixed.*")


def check_sql(plan: Mix = Mix()) -> str:
    """The same mix in SQL: one step of the chain for each raking of one margin."""
    topic = "'prose'"
    for name, mark in reversed(TOPICS):
        literal = "chr(10)" if mark == "\n" else f"'{mark}'"
        topic = f"CASE WHEN contains(coalesce(text, ''), {literal}) THEN '{name}' ELSE {topic} END"
    steps = [f"""
    marked AS (
        SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS language, {topic} AS topic,
               CAST(ceil(strlen(coalesce(text, '')) / 4.0) AS BIGINT) AS tokens,
               CAST(('0x' || substr(md5('{plan.seed}:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 8)) AS BIGINT) / 4294967296.0 AS chance
        FROM documents)""", """
    cells AS (SELECT source, language, topic, CAST(sum(tokens) AS BIGINT) AS tokens FROM marked GROUP BY ALL)"""]
    for d in DIMENSIONS:
        steps.append(f"""
    of_{d} AS (SELECT {d}, pow(sum(tokens) / (SELECT sum(tokens) FROM cells), {plan.powers[d]}) AS raw FROM cells GROUP BY {d}),
    to_{d} AS (SELECT {d}, raw / (SELECT sum(raw) FROM of_{d}) * (SELECT sum(tokens) FROM cells) * {plan.budget} AS target FROM of_{d})""")
    steps.append(f"""
    raked_0 AS (SELECT *, tokens * CAST({plan.budget} AS DOUBLE) AS weight FROM cells)""")
    k = 0
    for _ in range(plan.rounds):
        for d in DIMENSIONS:
            steps.append(f"""
    raked_{k + 1} AS MATERIALIZED (
        SELECT r.* EXCLUDE (weight, whole), least(coalesce(weight * target / nullif(whole, 0), 0), CAST(tokens AS DOUBLE)) AS weight
        FROM (SELECT *, sum(weight) OVER (PARTITION BY {d}) AS whole FROM raked_{k}) r JOIN to_{d} USING ({d}))""")
            k += 1
    return "WITH" + ",".join(steps) + f"""
    SELECT doc_id, m.source, m.language, m.topic, m.tokens,
           CASE WHEN c.tokens > 0 THEN round(c.weight / c.tokens, 9) ELSE 0.0 END AS probability,
           chance < CASE WHEN c.tokens > 0 THEN round(c.weight / c.tokens, 9) ELSE 0.0 END AS kept
    FROM marked m JOIN raked_{k} c ON m.source = c.source AND m.language = c.language AND m.topic = c.topic"""
