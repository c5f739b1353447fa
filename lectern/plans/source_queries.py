"""Sources and sinks: tables written to the shared folder and read back."""

from __future__ import annotations

import time

from pyspark.sql import functions as F

from lectern.operators.explain import explanation_text
from lectern.operators import interactions as graph, quality as gates, similarity
from lectern.plans.catalog_queries import CATALOG_SQL, catalog
from lectern.operators.library import distribution_counts
from lectern.plans.content_queries import CONTENT_SQL, embedded
from lectern.plans.graph_queries import GRAPH_SQL, MIN_USER, core, filtered, training
from lectern.plans.inputs import Inputs, place, query, r6
from lectern.plans.matching_queries import _LIBRARY, export
from lectern.plans.personal_queries import EXPLAINED, PERSONAL_SQL, TEXT_SQL, profile, recommended, with_best_evidence
from lectern.plans.popularity_queries import POPULARITY_SQL, scored
from lectern.plans.vector_queries import VECTOR_SQL, content_space
from lectern.session import cut_lineage
from lectern.sources import readers, writers


@query("read_jsonl", "SELECT conv_id, turn, role, text FROM {conversations}")
def read_jsonl(inp):
    path = place(inp, "conversations.json.gz")
    rows = inp.table("conversations")
    rows.write.option("compression", "gzip").json(path)
    return readers.read_jsonl(inp.spark, path, rows.schema, partitions=8)


@query("read_interactions", "SELECT user_id, book_id, is_read, rating, is_reviewed FROM interactions")
def read_interactions(inp):
    path = place(inp, "interactions.csv")
    columns = ["is_reviewed", "rating", "user_id", "book_id", "is_read"]
    inp.view("interactions").select(*columns).write.option("header", True).csv(path)
    return readers.read_interactions(inp.spark, path)


@query(
    "read_id_map",
    f"SELECT p_partkey AS book_id_csv, CASE WHEN p_partkey % 10 = 3 THEN NULL ELSE {2**53} + p_partkey END AS book_id FROM {{part}}",
)
def read_id_map(inp):
    path = place(inp, "id_map.csv")
    key = F.col("p_partkey")
    shown = F.when(key % 10 == 3, "unknown").otherwise((F.lit(2**53) + key).cast("string"))
    inp.table("part").select(key.alias("book_id_csv"), shown.alias("book_id")).write.option("header", True).csv(path)
    return readers.read_id_map(inp.spark, path)


@query(
    "read_library_export",
    """SELECT "Book Id" AS book_id, "Title" AS title, "Author" AS author, TRIM("Exclusive Shelf") AS shelf, "My Rating" AS rating, '' AS publisher
    FROM export_rows""",
    {"export_rows": _LIBRARY},
)
def read_library_export(inp):
    path = place(inp, "library.csv")
    shown = export(inp).select(
        "Book Id", F.col("Title").alias(" Title "), "Author", "Exclusive Shelf", "My Rating"
    )
    shown.write.option("header", True).option("ignoreLeadingWhiteSpace", False).csv(path)
    read = readers.read_library_export(inp.spark, path)
    return read.select(
        F.col("Book Id").alias("book_id"), F.col("Title").alias("title"), F.col("Author").alias("author"),
        F.trim("Exclusive Shelf").alias("shelf"), F.col("My Rating").alias("rating"), F.col("Publisher").alias("publisher"),
    )


@query("read_table", "SELECT p_partkey, p_name, p_brand FROM {part}")
def read_table(inp):
    path = place(inp, "part.parquet")
    writers.write_parquet(inp.table("part").select("p_partkey", "p_name", "p_brand"), path)
    return readers.read_table(inp.spark, path)


@query("write_parquet", "SELECT * FROM {orders}")
def write_parquet(inp):
    path = place(inp, "orders")
    writers.write_parquet(inp.table("orders"), path, "zstd")
    return inp.spark.read.parquet(path)


@query("output_policy", "SELECT n_nationkey, n_name FROM {nation}")
def output_policy(inp):
    """A second write is skipped, so the first rows stay."""
    path = place(inp, "nation")
    nations = inp.table("nation").select("n_nationkey", "n_name")
    writers.write_parquet(nations, path)
    writers.write_parquet(nations.withColumn("n_name", F.lit("later")), path, policy="skip")
    return inp.spark.read.parquet(path)


@query(
    "write_partitioned",
    "SELECT user_bucket, COUNT(*) AS rows, COUNT(DISTINCT user_id) AS users FROM (SELECT *, user_id % 64 AS user_bucket FROM positives) GROUP BY user_bucket",
    GRAPH_SQL,
)
def write_partitioned(inp):
    from lectern.functions.scoring import user_bucket

    path = place(inp, "interactions")
    edges = graph.positive_interactions(inp.view("interactions")).withColumn("user_bucket", user_bucket())
    writers.write_partitioned(edges, path, files_per_bucket=2)
    return inp.spark.read.parquet(path).groupBy(F.col("user_bucket").cast("bigint").alias("user_bucket")).agg(
        F.count("*").alias("rows"), F.count_distinct("user_id").alias("users")
    )


@query("write_multi_format", "SELECT vec_id, label FROM {embeddings}")
def write_multi_format(inp):
    """Rows that all three formats give back alike."""
    path = place(inp, "vectors")
    rows = inp.table("embeddings").select("vec_id", "label", "embedding")
    paths = writers.write_multi_format(rows, path, "vectors")
    read = inp.spark.read.parquet(paths["parquet"])
    flat = inp.spark.read.option("header", True).option("escape", '"').schema("vec_id long, label int, embedding string").csv(paths["csv"])
    records = inp.spark.read.schema("vec_id long, label int, embedding array<float>").json(paths["json"])
    keys = ["vec_id", "label"]
    whole = F.to_json("embedding")
    same_csv = read.select(*keys, whole.alias("e")).join(flat.select(*keys, F.col("embedding").alias("e")), [*keys, "e"], "left_semi")
    same_json = records.select(*keys, whole.alias("e"))
    return same_csv.join(same_json, [*keys, "e"], "left_semi").select(*keys)


@query("verify_row_count", "SELECT 'lineitem' AS source, COUNT(*) AS rows FROM {lineitem}")
def verify_row_count(inp):
    path, rows = place(inp, "lineitem"), inp.table("lineitem").select("l_orderkey", "l_partkey")
    found = writers.write_verified(rows, path)
    return inp.spark.createDataFrame([("lineitem", found)], "source string, rows long")


_LINE = "concat_ws(',', l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS BIGINT), l_returnflag, l_linestatus) || chr(10)"


@query(
    "source_inventory",
    f"""WITH files AS (SELECT l_suppkey % 32 AS part, string_agg({_LINE}, '' ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity) AS body
    FROM {{lineitem}} GROUP BY part), digests AS (SELECT part, strlen(body) AS length, CASE WHEN strlen(body) <= 65536 THEN sha256(body)
    ELSE sha256((SELECT string_agg(sha256(substr(body, i * 65536 + 1, 65536)), '' ORDER BY i) FROM range((strlen(body) + 65535) // 65536) t(i))) END AS digest
    FROM files)
    SELECT 'lineitem' AS source, 'FOUND' AS status, COUNT(*) AS files, SUM(length)::BIGINT AS bytes,
    sha256(STRING_AGG(digest, '' ORDER BY LPAD(part::VARCHAR, 2, '0'))) AS sha256, TRUE AS dated FROM digests
    UNION ALL SELECT 'absent', 'MISSING', 0, 0, NULL, FALSE""",
)
def source_inventory(inp):
    """All of lineitem written as text files, one for each remainder of the supplier, listed with the sizes and digests that
    their rows must give (those over 64 KB by ranges), and a source that is not there."""
    path = place(inp, "lineitem.txt")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity"]
    line = F.concat_ws(",", *order[:4], F.col("l_quantity").cast("bigint"), "l_returnflag", "l_linestatus")
    part = F.lpad((F.col("l_suppkey") % 32).cast("string"), 2, "0")
    rows = inp.table("lineitem").withColumns({"part": part, "value": line})
    rows.repartition("part").sortWithinPartitions("part", *order).select("part", "value").write.partitionBy("part").text(path)
    found = writers.source_inventory(inp.spark, {"lineitem": path, "absent": f"{path}-absent"}, range_bytes=1 << 16)
    return found.select("source", "status", "files", "bytes", "sha256", F.col("modified").isNotNull().alias("dated"))


_COLUMNS = """l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(l_quantity AS DECIMAL(18, 4)), CAST(l_extendedprice AS DECIMAL(18, 4)),
    CAST(l_discount AS DECIMAL(18, 4)), CAST(l_tax AS DECIMAL(18, 4)), l_returnflag, l_linestatus"""


@query(
    "content_fingerprint",
    f"""SELECT COUNT(*) AS rows, CAST(SUM(CAST('0x' || substr(md5(concat_ws(chr(31), {_COLUMNS}, epoch_us(l_shipdate))), 1, 8) AS BIGINT)) AS BIGINT)
    AS fingerprint FROM {{lineitem}}""",
)
def content_fingerprint(inp):
    """All columns of lineitem; decimals and microseconds have one spelling in every engine."""
    rows = inp.table("lineitem")
    exact = {c: F.col(c).cast("decimal(18,4)") for c, kind in rows.dtypes if kind == "double"}
    return writers.content_fingerprint(rows.withColumns({**exact, "l_shipdate": F.unix_micros(F.col("l_shipdate").cast("timestamp"))}))


@query(
    "run_metrics",
    """SELECT 'interactions' AS stage, 'rows' AS metric, CAST(COUNT(*) AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM interactions
    UNION ALL SELECT 'interactions', 'users', CAST(COUNT(DISTINCT user_id) AS DOUBLE), NULL FROM interactions
    UNION ALL SELECT 'interactions', 'mean_rating', ROUND(AVG(CAST(rating AS DOUBLE)), 6), NULL FROM interactions
    UNION ALL SELECT 'interactions', 'density', ROUND(COUNT(*) / (COUNT(DISTINCT user_id) * COUNT(DISTINCT book_id)), 6), NULL FROM interactions
    UNION ALL SELECT 'interactions', 'setting.min_item', 24.0, '24' UNION ALL SELECT 'interactions', 'setting.policy', NULL, 'skip'
    UNION ALL SELECT 'interactions', 'seconds', NULL, 'timed'
    UNION ALL SELECT 'interactions', 'rating.' || rating, CAST(COUNT(*) AS DOUBLE), NULL FROM interactions GROUP BY rating
    UNION ALL SELECT 'interactions', 'is_read.' || is_read, CAST(COUNT(*) AS DOUBLE), NULL FROM interactions GROUP BY is_read""",
)
def run_metrics(inp):
    started, rows = time.perf_counter(), inp.view("interactions")
    measured = rows.agg(
        F.count("*").alias("rows"), F.count_distinct("user_id").alias("users"), r6(F.avg("rating")).alias("mean_rating"),
        r6(F.count("*") / (F.count_distinct("user_id") * F.count_distinct("book_id"))).alias("density"),
    )
    shares = distribution_counts(rows, ["rating", "is_read"])
    metrics = writers.run_metrics("interactions", measured, {"min_item": 24, "policy": "skip"}, time.perf_counter() - started, shares)
    # the time differs in every run, so only its presence is compared
    timed = (F.col("metric") == "seconds") & (F.col("value") > 0)
    return metrics.withColumn("text", F.when(timed, "timed").otherwise(F.col("text"))).withColumn("value", F.when(~timed, F.col("value")))


@query(
    "normalize_types",
    f"""SELECT event_id + {2**53} AS book_id, TRY_CAST(TRY_CAST(json_extract_string(props, '$.k') AS DOUBLE) AS BIGINT) AS num_pages,
    value AS average_rating, CASE event_type WHEN 'view' THEN TRUE WHEN 'click' THEN FALSE END AS is_ebook,
    '["' || event_type || '"]' AS authors FROM {{events}}""",
)
def normalize_types(inp):
    ebook = F.when(F.col("event_type") == "view", "True").when(F.col("event_type") == "click", "false").otherwise("maybe")
    raw = inp.table("events").select(
        (F.lit(2**53) + F.col("event_id")).cast("string").alias("book_id"), F.get_json_object("props", "$.k").alias("num_pages"),
        F.col("value").cast("string").alias("average_rating"), ebook.alias("is_ebook"), F.array("event_type").alias("authors"),
    )
    return readers.normalize_types(raw)


@query("align_schema", "SELECT p_partkey, CAST(p_size AS BIGINT) AS p_size, TRY_CAST(p_name AS DOUBLE) AS p_name, CAST(NULL AS VARCHAR) AS missing FROM {part}")
def align_schema(inp):
    target = {"p_partkey": "bigint", "p_size": "bigint", "p_name": "double", "missing": "string"}
    return readers.align_schema(inp.table("part"), target)


_MARKDOWN = f"""SELECT user_id, CAST(rank AS BIGINT) AS rank, '## ' || rank || '. ' || title || chr(10) || chr(10) || '**Author:** ' || primary_author || chr(10)
    || '**Genre:** ' || primary_genre || chr(10) || '**Model:** recommendation score ' || format('{{:.3f}}', recommendation_score)
    || ', hybrid similarity ' || format('{{:.3f}}', hybrid_similarity) || chr(10) || chr(10) || explanation || chr(10) AS markdown
    FROM cited JOIN ({EXPLAINED}) USING (user_id, rank)"""


@query("markdown_report", _MARKDOWN, TEXT_SQL)
def markdown_report(inp):
    """Every recommendation with its explanation by the best evidence."""
    told = with_best_evidence(inp)
    told = told.withColumn("explanation", explanation_text(told.columns, True))
    return writers.markdown_report(told).withColumn("rank", F.col("rank").cast("bigint"))


def _gate_sql(name: str, observed: str, expected: str, passed: str, source: str) -> str:
    return f"SELECT '{name}' AS gate, CAST({observed} AS DOUBLE) AS observed, CAST({expected} AS DOUBLE) AS expected, {passed} AS passed FROM {source}"


@query(
    "q_rows",
    _gate_sql("q_rows", "COUNT(*)", "COUNT(*)", "TRUE", "{orders}") + " UNION ALL "
    + _gate_sql("q_rows", "COUNT(*) FILTER (o_orderkey % 3 > 0)", "COUNT(*)", "FALSE", "{orders}"),
)
def q_rows(inp):
    """The gate on a whole write, which passes, and on one that lost rows, which does not."""
    path, rows = place(inp, "orders"), inp.table("orders").select("o_orderkey")
    writers.write_parquet(rows, path)
    written = inp.spark.read.parquet(path)
    return gates.q_rows(written, rows).unionByName(gates.q_rows(written.where(F.col("o_orderkey") % 3 > 0), rows))


@query("q_unique_book", _gate_sql("q_unique_book", "COUNT(*) - COUNT(DISTINCT book_id)", "0", "COUNT(*) = COUNT(DISTINCT book_id)", "catalog_c"), CATALOG_SQL)
def q_unique_book(inp):
    return gates.q_unique_book(catalog(inp))


@query("q_kcore", _gate_sql("q_kcore", "MIN(interaction_count)", str(MIN_USER), f"MIN(interaction_count) >= {MIN_USER}", "users2"), GRAPH_SQL)
def q_kcore(inp):
    return gates.q_kcore(core(inp)[1], MIN_USER)


@query("q_weight_nonneg", _gate_sql("q_weight_nonneg", "COUNT(*) FILTER (interaction_weight < 0)", "0", "COUNT(*) FILTER (interaction_weight < 0) = 0", "filtered"), GRAPH_SQL)
def q_weight_nonneg(inp):
    return gates.q_weight_nonneg(filtered(inp)[0])


_OUTSIDE = "COUNT(*) FILTER (NOT (wilson_score BETWEEN 0 AND 1))"


@query("q_wilson_range", _gate_sql("q_wilson_range", _OUTSIDE, "0", f"{_OUTSIDE} = 0", "scored"), POPULARITY_SQL)
def q_wilson_range(inp):
    return gates.q_wilson_range(scored(inp))


@query(
    "q_docs_vectors",
    _gate_sql("q_docs_vectors", "(SELECT COUNT(DISTINCT book_id) FROM weights)", "COUNT(*)", "(SELECT COUNT(DISTINCT book_id) FROM weights) = COUNT(*)", "texts"),
    CONTENT_SQL,
)
def q_docs_vectors(inp):
    docs, _, _, vectors = embedded(inp)
    return gates.q_docs_vectors(docs, vectors)


@query(
    "q_maps",
    _gate_sql("q_maps", "COUNT(*) FILTER (user_id IS NULL)", "0", "COUNT(*) > 0", "training") + " UNION ALL "
    + _gate_sql("q_maps", "COUNT(*) FILTER (item_id IS NULL)", "0", "COUNT(*) > 0", "training"),
    GRAPH_SQL,
)
def q_maps(inp):
    """The gate on both factor tables of the model: users, then items."""
    from lectern.operators.collaborative import implicit_als

    rows = cut_lineage(training(inp))
    users, items = implicit_als(rows, scaled_reg=False)
    return gates.q_maps(rows, users, "user_id").unionByName(gates.q_maps(rows, items, "item_id"))


_NEAREST_OTHER = """(SELECT a.book_id, MAX(ROUND(list_inner_product(a.vector, b.vector), 9)) AS nearest
    FROM content_n a JOIN content_n b ON a.book_id <> b.book_id GROUP BY a.book_id)"""


@query(
    "q_self_neighbour",
    _gate_sql("q_self_neighbour", "COUNT(*) FILTER (ABS(SQRT(list_inner_product(vector, vector)) - 1) > 1e-6)", "0", "COUNT(*) > 0", "content_n")
    + " UNION ALL " + _gate_sql("q_self_neighbour", "COUNT(*) FILTER (nearest < 1 - 1e-6)", "0", "COUNT(*) FILTER (nearest < 1 - 1e-6) = 0", _NEAREST_OTHER),
    VECTOR_SQL,
)
def q_self_neighbour(inp):
    """The gate on neighbours that include the item itself, and on those that leave it out."""
    space = content_space(inp)
    own = gates.q_self_neighbour(similarity.similar_items(space, 1, include_self=True))
    return own.unionByName(gates.q_self_neighbour(similarity.similar_items(space, 1)))


@query("q_nonempty", _gate_sql("q_nonempty", "COUNT(*)", "1", "COUNT(*) >= 1", "profile_r"), PERSONAL_SQL)
def q_nonempty(inp):
    return gates.q_nonempty(profile(inp))


@query(
    "catalog_checks",
    """SELECT COUNT(*) AS rows, COUNT(DISTINCT book_id) AS distinct_books, COUNT(*) FILTER (title IS NULL OR TRIM(title) = '') AS missing_titles,
    COUNT(*) FILTER (primary_author IS NULL) AS missing_primary_authors, COUNT(*) FILTER (primary_genre IS NULL) AS missing_primary_genres,
    COUNT(*) FILTER (is_canonical_edition) AS canonical_editions, COUNT(interaction_book_id) AS interaction_mapped_books FROM catalog_c""",
    CATALOG_SQL,
)
def catalog_checks(inp):
    return gates.catalog_checks(catalog(inp))
