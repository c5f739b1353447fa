"""Content documents and TF-IDF in long form: one row per document and term."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.window import Window

from lectern.functions.text import ngrams, tokenize
from lectern.operators.ranking import first_rows, rank_rows, top_n
from lectern.session import cut_lineage


def content_docs_join(catalog: DataFrame, items: DataFrame) -> DataFrame:
    """Canonical, mapped, titled editions that are in the filtered graph."""
    usable = F.col("is_canonical_edition") & F.col("interaction_book_id").isNotNull() & (F.trim("title") != "")
    counts = items.select(F.col("item_id").alias("_item"), "interaction_count")
    return (
        catalog.where(usable)
        .join(counts, F.col("interaction_book_id") == F.col("_item"))
        .withColumnRenamed("interaction_book_id", "item_id")
        .drop("_item")
    )


def content_text(documents: DataFrame, minimum_description: int = 40) -> DataFrame:
    """Weighted text: title x3, author x2, genres x2, description, language and decade."""
    filled = lambda name: F.coalesce(F.col(name), F.lit(""))
    year = F.col("publication_year")
    language = F.concat(F.lit("language_"), F.lower("language_code"))
    decade = F.concat(F.lit("decade_"), (F.floor(year / 10) * 10).cast("int").cast("string"))
    description = F.when(F.length("description") >= minimum_description, F.col("description"))
    return documents.withColumn(
        "content_text",
        F.concat_ws(
            " ",
            *[filled("title")] * 3,
            *[filled("primary_author")] * 2,
            *[filled("genre_names")] * 2,
            F.coalesce(description, F.lit("")),
            F.coalesce(language, F.lit("")),
            F.coalesce(F.when(year.between(1000, 2100), decade), F.lit("")),
        ),
    )


def fit_sample(documents: DataFrame, size: int | str | None = None, key: str = "book_id") -> DataFrame:
    """All non-blank documents, or the ``size`` with the smallest id hash where the caller asks for a sample.

    Counts of hash digits tell where the sample ends, so neither ids nor texts are sorted.
    """
    texts = documents.where(F.length(F.trim("content_text")) > 0).select(key, "content_text")
    if size in (None, "all") or int(size) <= 0:
        return texts
    code = F.md5(F.col(key).cast("string"))
    wanted = texts.sparkSession.range(1).select(F.lit(0).alias("_all"), F.lit(int(size)).cast("bigint").alias("_take"))
    bins = [F.substring(code, 1, 3), F.substring(code, 4, 3)]
    return first_rows(texts.withColumn("_all", F.lit(0)), ["_all"], wanted, bins, [code.asc(), F.col(key).asc()]).drop("_all")


def allocate_sample(counts: DataFrame, key: str, requested: int) -> DataFrame:
    """Rows to draw per stratum: proportional, largest remainder, at most the stratum.

    ``counts`` holds one row per stratum (key, rows); strata are ranked exactly and
    in parallel, however many there are.
    """
    total = counts.agg(F.sum("rows")).first()[0] or 0
    share = F.lit(requested) * F.col("rows") / F.lit(total)
    parts = counts.withColumn("_share", share).withColumn("_base", F.floor("_share").cast("bigint"))
    spare = requested - (parts.agg(F.sum("_base")).first()[0] or 0)
    ranked = rank_rows(parts, [], [(F.col("_share") - F.col("_base")).desc(), F.col(key).asc()], "_order")
    drawn = F.col("_base") + F.when(F.col("_order") <= spare, 1).otherwise(0)
    rows = F.col("rows") if requested >= total else F.least(drawn, F.col("rows"))
    return ranked.select(key, "rows", rows.alias("sample_rows"))


def stratified_sample(df: DataFrame, key: str, row_id: str, requested: int, seed: int = 42) -> DataFrame:
    """Seeded draw without replacement with ``allocate_sample`` rows per stratum."""
    wanted = allocate_sample(df.groupBy(key).agg(F.count("*").alias("rows")), key, requested)
    code = F.xxhash64(F.col(row_id), F.lit(seed))
    bins = [F.shiftright(code, 52), F.shiftright(code, 40).bitwiseAND(F.lit(0xFFF))]
    take = wanted.select(key, F.col("sample_rows").alias("_take"))
    return first_rows(df, [key], take, bins, [code.asc(), F.col(row_id).asc()]).select(*df.columns)


def document_terms(documents: DataFrame, ngram_max: int = 2, text: str = "content_text", key: str = "book_id") -> DataFrame:
    """(document, term, tf).

    The tokens are placed by document before they become terms: that moves each text
    once, where the exploded terms would be a multiple of it, and everything per
    document after it (counts, lengths, packed rows) needs no further exchange. They
    are placed behind the Python step, which the planner takes to undo a placement.
    The partition count is fixed: sized by the texts alone, the planner would merge
    too many of them.
    """
    spark = documents.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism)
    placed = documents.select(key, tokenize(text).alias("_tokens")).repartition(tasks, key)
    terms = placed.select(key, ngrams("_tokens", ngram_max).alias("_t"))
    # explode would add a filter on the array's size that tokenizes every text again
    listed = terms.select(key, F.explode_outer("_t").alias("term")).where(F.col("term").isNotNull())
    return listed.groupBy(key, "term").agg(F.count("*").alias("tf"))


def term_stats(terms: DataFrame) -> DataFrame:
    """Corpus frequency and document frequency per term."""
    return terms.groupBy("term").agg(F.sum("tf").alias("corpus_frequency"), F.count("*").alias("document_frequency"))


def vocabulary(
    stats: DataFrame, documents: int, max_features: int = 100_000, min_df: int = 5, max_df: float = 0.98
) -> DataFrame:
    """Terms inside the document-frequency limits, then the most frequent ones.

    Ties go to the smaller term; ``term_index`` counts from 0 in that order and the
    table holds at most ``max_features`` rows.
    """
    kept = F.col("document_frequency").between(min_df, int(max_df * documents + 1e-9))
    order = [F.col("corpus_frequency").desc(), F.col("term").asc()]
    # counted and ranked: the terms are added up once
    best = top_n(cut_lineage(stats.where(kept)), order, max_features, "_rank")
    idf = F.ln(F.lit(1.0 + documents) / (1 + F.col("document_frequency"))) + 1
    return best.select(
        "term",
        (F.col("_rank") - 1).cast("int").alias("term_index"),
        "corpus_frequency",
        "document_frequency",
        idf.alias("idf"),
    )


@dataclass(frozen=True)
class TfidfModel:
    vocabulary: DataFrame
    documents: int
    ngram_max: int
    max_features: int


def tfidf_fit(
    documents: DataFrame,
    max_features: int = 100_000,
    min_df: int = 5,
    max_df: float = 0.98,
    ngram_max: int = 2,
    sample: int | str | None = None,
    key: str = "book_id",
) -> TfidfModel:
    fitted = fit_sample(documents, sample, key)
    return _fit(document_terms(fitted, ngram_max, key=key), fitted.count(), max_features, min_df, max_df, ngram_max)


def _fit(terms: DataFrame, documents: int, max_features: int, min_df: int, max_df: float, ngram_max: int) -> TfidfModel:
    chosen = cut_lineage(vocabulary(term_stats(terms), documents, max_features, min_df, max_df))
    return TfidfModel(chosen, documents, ngram_max, max_features)


def tfidf_fit_transform(
    documents: DataFrame,
    max_features: int = 100_000,
    min_df: int = 5,
    max_df: float = 0.98,
    ngram_max: int = 2,
    key: str = "book_id",
) -> tuple[TfidfModel, DataFrame]:
    """Fit on all documents and weigh them; every text is tokenized once."""
    fitted = fit_sample(documents, "all", key)
    terms = cut_lineage(document_terms(fitted, ngram_max, key=key))
    model = _fit(terms, fitted.count(), max_features, min_df, max_df, ngram_max)
    return model, tfidf_weights(terms, model.vocabulary, max_features, key)


def tfidf_weights(terms: DataFrame, chosen: DataFrame, max_features: int, key: str = "book_id") -> DataFrame:
    """(1 + ln tf) * idf, brought to unit length per document.

    The vocabulary has at most ``max_features`` rows and goes to the tasks: the terms are a multiple of the texts and
    don't move to meet it.
    """
    raw = terms.join(F.broadcast(chosen.select("term", "term_index", "idf")), "term").withColumn(
        "_raw", (1 + F.ln(F.col("tf").cast("double"))) * F.col("idf")
    )
    # a document has at most max_features rows here
    length = F.sqrt(F.sum(F.col("_raw") * F.col("_raw")).over(Window.partitionBy(key)))
    return raw.select(key, "term", "term_index", (F.col("_raw") / length).alias("weight"))


def tfidf_transform(model: TfidfModel, documents: DataFrame, key: str = "book_id") -> DataFrame:
    terms = document_terms(documents, model.ngram_max, key=key)
    return tfidf_weights(terms, model.vocabulary, model.max_features, key)


def matrix_density(weights: DataFrame, rows: int, columns: int) -> DataFrame:
    """Non-zero cells and their share of rows x columns."""
    return weights.agg(F.count("*").alias("nonzero_values")).select(
        "nonzero_values",
        F.lit(rows).cast("bigint").alias("rows"),
        F.lit(columns).cast("bigint").alias("columns"),
        (F.col("nonzero_values") / F.lit(max(rows * columns, 1))).alias("density"),
    )
