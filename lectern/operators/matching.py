"""Matching free-text or ISBN inputs to the catalog."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lectern.functions.fuzzy import author_score, fuzzy_score, title_score
from lectern.functions.text import author_tokens, normalize_isbn, normalize_text, title_tokens
from lectern.operators.bounded import reachable_pairs
from lectern.operators.ranking import top_k
from lectern.session import cut_lineage

# Status, source, method and note texts of a match record.
MATCHED, COLD_START, UNMATCHED = "matched", "cold_start", "unmatched"
LOCAL, EXTERNAL, NOWHERE = "local_catalog", "google_books", "none"
ISBN_EXACT, TITLE_FUZZY = "isbn_exact", "title_author_fuzzy"
EXTERNAL_ISBN, EXTERNAL_FUZZY = "google_isbn_to_local_exact", "google_title_author_to_local_fuzzy"
EXTERNAL_ONLY, NO_METHOD = "google_metadata_only", "none"
NOTE_ISBN = "Exact ISBN match in local catalog."
NOTE_RESOLVED = "Input was resolved with Google Books."
NOTE_EXTERNAL_ISBN = "Google ISBN matched a local catalog edition."
NOTES_COLD = (
    "No reliable local catalog match was found.",
    "Use content-only retrieval, then popularity/novelty reranking.",
)
NOTE_NOTHING = "No reliable local or Google Books result was available."

# longest word whose substrings are listed; longer ones are compared by `contains`
LISTED_WORD = 64
# most popular candidates that are scored before the rest has to reach their best score
FIRST = 50
DETAILS = (
    "work_id", "title", "primary_author", "isbn", "isbn13", "publication_year", "primary_genre", "description",
    "image_url",
)
# what a match reads of the catalog
MATCHED_BY = ("book_id", "title", "primary_author", "isbn", "isbn13", "is_canonical_edition", "ratings_count", "bayesian_rating")
RECORD = (
    "status", "source", "confidence", "match_method", "local_book_id", "work_id", "hybrid_index",
    "content_global_row", "collaborative_item_index", "title", "primary_author", "isbn", "isbn13",
    "publication_year", "primary_genre", "description", "image_url", "google_volume_id", "google_categories",
    "google_language", "cold_start_content_text", "notes",
)


def popularity_order(prefix: str = "") -> list[Column]:
    return [
        F.col(f"{prefix}ratings_count").desc_nulls_last(),
        F.col(f"{prefix}bayesian_rating").desc_nulls_last(),
        F.col(f"{prefix}book_id").asc(),
    ]


def isbn_index(catalog: DataFrame) -> DataFrame:
    """The preferred edition per normalised ISBN: canonical, most rated, lowest id."""
    codes = F.array_distinct(F.array(normalize_isbn("isbn"), normalize_isbn("isbn13")))
    listed = catalog.select(
        F.explode(codes).alias("isbn_key"), "book_id", "is_canonical_edition", "ratings_count"
    ).where(F.col("isbn_key") != "")
    order = [
        F.col("is_canonical_edition").desc_nulls_last(),
        F.col("ratings_count").desc_nulls_last(),
        F.col("book_id").asc(),
    ]
    return top_k(listed, ["isbn_key"], order, 1, "_rank").select("isbn_key", "book_id")


def isbn_match_join(inputs: DataFrame, catalog: DataFrame, isbn: str = "isbn") -> DataFrame:
    """Inputs whose ISBN is a catalog ISBN, with the preferred edition."""
    keyed = inputs.withColumn("isbn_key", normalize_isbn(isbn)).where(F.col("isbn_key") != "")
    return keyed.join(isbn_index(catalog), "isbn_key")


def contained_tokens(texts: DataFrame, key: str, text: str, tokens: DataFrame) -> DataFrame:
    """(key, tokens): which of the distinct ``tokens`` occur inside the lower-cased text.

    Tokens hold a-z and 0-9 only, so an occurrence lies within one such run. The
    distinct runs list their own substrings and meet the tokens by equality, which
    keeps the work linear in the texts. Very long runs meet them by trigram.
    """
    runs = F.array_distinct(F.split(F.lower(F.col(text)), "[^a-z0-9]+"))
    worded = texts.select(key, F.explode(F.filter(runs, lambda w: F.length(w) >= 3)).alias("word"))
    words = worded.select("word").distinct()
    tokens = tokens.select("token").distinct()
    pieces = F.flatten(
        F.transform(
            F.sequence(F.lit(3), F.length("word")),
            lambda n: F.transform(
                F.sequence(F.lit(1), F.length("word") - n + 1), lambda i: F.substring(F.col("word"), i, n)
            ),
        )
    )
    listed = words.where(F.length("word") <= LISTED_WORD).select(
        "word", F.explode(F.array_distinct(pieces)).alias("token")
    ).join(tokens, "token")
    trigrams = F.array_distinct(
        F.transform(F.sequence(F.lit(1), F.length("word") - 2), lambda i: F.substring(F.col("word"), i, F.lit(3)))
    )
    long_words = words.where(F.length("word") > LISTED_WORD).select("word", F.explode(trigrams).alias("_start"))
    compared = long_words.join(tokens.withColumn("_start", F.substring("token", 1, 3)), "_start").where(
        F.contains("word", "token")
    )
    found = listed.select("word", "token").unionByName(compared.select("word", "token"))
    # bounded by the substrings of one word, then of one text
    per_word = found.groupBy("word").agg(F.collect_list("token").alias("_found"))
    return (
        worded.join(per_word, "word")
        .select(key, F.explode("_found").alias("token"))
        .groupBy(key)
        .agg(F.collect_set("token").alias("tokens"))
    )


def match_requests(inputs: DataFrame, title: str = "title", author: str = "author") -> DataFrame:
    """Distinct normalised (title, author) of the inputs that have a title, with tokens."""
    titled = inputs.where(F.coalesce(F.col(title), F.lit("")) != "")
    normalized = titled.select(normalize_text(title).alias("q_title"), normalize_text(author).alias("q_author"))
    return normalized.distinct().select(
        "q_title", "q_author", title_tokens("q_title").alias("t"), author_tokens("q_author").alias("a")
    )


def blocked_fuzzy_join(
    requests: DataFrame, catalog: DataFrame, limit: int = 250, fold_catalog: bool = False
) -> DataFrame:
    """(q_title, q_author, book_id): the ``limit`` most popular canonical editions that
    contain any title token and, where the request names an author, any author token.

    Every (title token, author token) probe keeps its own ``limit`` most popular
    editions; those of a request's probes contain the request's ``limit`` best, so no
    token ever pairs all its titles with all its requests. An absent token kind is
    the empty probe, which every edition answers.
    """
    # requests are read several times; candidates move once, by a number instead of two texts
    asked = cut_lineage(requests.distinct().withColumn("_request", F.monotonically_increasing_id()))
    probes = request_probes(asked.select("_request", "t", "a"))
    postings = probe_postings(probes, edition_texts(catalog, fold_catalog)).drop("_t", "_a")
    best = top_k(postings, ["t", "a"], popularity_order(), limit, "_rank").drop("_rank")
    found = probes.join(best, ["t", "a"]).drop("t", "a").repartition("_request").distinct()
    ranked = top_k(found, ["_request"], popularity_order(), limit, "candidate_rank")
    return asked.drop("t", "a").join(ranked, "_request").drop("_request")


def request_probes(requests: DataFrame) -> DataFrame:
    """A row for each title token and author token (t, a) of a request; a kind without tokens is an empty text."""
    probe = lambda c: F.explode(F.when(F.size(c) > 0, F.col(c)).otherwise(F.array(F.lit(""))))
    rest = [c for c in requests.columns if c not in ("t", "a")]
    return requests.select(*rest, probe("t").alias("t"), "a").select(*rest, "t", probe("a").alias("a"))


def edition_texts(catalog: DataFrame, fold_catalog: bool = False) -> DataFrame:
    """Canonical editions with the title (_t) and the author (_a) that tokens are looked for in."""
    shown = lambda c: normalize_text(c) if fold_catalog else F.lower(F.coalesce(F.col(c), F.lit("")))
    return catalog.where(F.col("is_canonical_edition")).select(
        "book_id", "ratings_count", "bayesian_rating", shown("title").alias("_t"), shown("primary_author").alias("_a")
    )


def probe_postings(probes: DataFrame, texts: DataFrame) -> DataFrame:
    """The texts by the probes (t, a) that they answer."""
    # editions share titles and authors: each text is looked through once
    held = lambda text, probe: contained_tokens(
        texts.select(F.col(text), F.col(text).alias("_text")).distinct(), text, "_text",
        probes.where(F.col(probe) != "").select(F.col(probe).alias("token")))
    titles, authors = held("_t", "t"), held("_a", "a")
    answers = lambda c: F.explode(F.concat(F.array(F.lit("")), F.coalesce(F.col(c), F.array().cast("array<string>"))))
    return (
        texts.join(titles.withColumnRenamed("tokens", "_tt"), "_t", "left")
        .join(authors.withColumnRenamed("tokens", "_aa"), "_a", "left")
        .select(*texts.columns, answers("_tt").alias("t"), "_aa")
        .select(*texts.columns, "t", answers("_aa").alias("a"))
    )


def exact_titles(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """(q_title, q_author, book_id) of canonical editions whose normalised title is the request's, whatever their popularity.

    Of editions with the same title and author, only the most popular one can win, so only it is paired.
    """
    named = catalog.where(F.col("is_canonical_edition")).select(
        normalize_text("title").alias("q_title"), normalize_text("primary_author").alias("_a"), "book_id", "ratings_count", "bayesian_rating"
    ).where(F.col("q_title") != "")
    best = top_k(named, ["q_title", "_a"], popularity_order(), 1, "_rank").drop("_rank", "_a")
    return requests.select("q_title", "q_author").join(best, "q_title")


def request_candidates(requests: DataFrame, catalog: DataFrame, limit: int = 250) -> DataFrame:
    """Blocked candidates, and exact titles beyond the limit, ranked by popularity."""
    popular = catalog.select("book_id", "ratings_count", "bayesian_rating")
    blocked = blocked_fuzzy_join(requests, catalog, limit).select("q_title", "q_author", "book_id").join(popular, "book_id")
    both = blocked.unionByName(exact_titles(requests, catalog)).distinct()
    place = Window.partitionBy("q_title", "q_author").orderBy(*popularity_order())
    return both.withColumn("candidate_rank", F.row_number().over(place))


def limit_candidates(df: DataFrame, keys: list[str], limit: int) -> DataFrame:
    return top_k(df, keys, popularity_order(), limit, "candidate_rank")


def score_candidates(candidates: DataFrame, catalog: DataFrame) -> DataFrame:
    """Title, author and blended score of each candidate.

    Candidates move once, by their pair of titles: equal pairs of texts lie side by side, and a batch scores each once. A title
    with very many candidates is many tasks.
    """
    texts = catalog.select(
        "book_id", normalize_text("title").alias("c_title"), normalize_text("primary_author").alias("c_author")
    )
    named = candidates.join(texts, "book_id").repartition("q_title", "c_title").sortWithinPartitions("q_title", "c_title")
    scored = named.withColumns({"title_score": title_score("q_title", "c_title"), "author_score": author_score("q_author", "c_author")})
    return scored.withColumn("score", fuzzy_score()).select(*candidates.columns, "title_score", "author_score", "score")


def best_match(requests: DataFrame, catalog: DataFrame, threshold: float = 88.0, first: int = FIRST) -> DataFrame:
    """The best of *all* candidates of each request, where it has ``threshold`` or more; ties go to the more popular edition.

    The ``first`` most popular candidates are scored; what they reach is what others have to reach. Requests that have more
    candidates then meet the rest by a bound of the score (``bounded``), and pairs below what they need are never made.
    ``first`` changes the work, not the result. Editions of equal title and author are one text: only the most popular
    can win. Requests without a title and empty tables give no rows.
    """
    keys = ["q_title", "q_author"]
    popular = cut_lineage(score_candidates(request_candidates(requests, catalog, first), catalog))
    leading = F.max(F.when(F.col("candidate_rank") <= first, F.col("score")))
    reached = popular.groupBy(*keys).agg(F.max("score").alias("_best"), leading.alias("_lead"), F.count("*").alias("_n"))
    # with fewer candidates all are scored; a full score among the most popular can't be beaten by less popular ones
    unsettled = reached.where((F.col("_n") >= first) & (F.col("_lead") < 100 - 1e-9)).select(
        *keys, F.greatest("_best", F.lit(float(threshold))).alias("need"))
    probes = cut_lineage(request_probes(requests.join(unsettled, keys)))
    texts = top_k(edition_texts(catalog), ["_t", "_a"], popularity_order(), 1, "_rank").drop("_rank")
    answered = probe_postings(probes, texts).join(probes.select("t", "a").distinct(), ["t", "a"], "left_semi")
    postings = answered.select("book_id", normalize_text("_t").alias("c_title"), normalize_text("_a").alias("c_author"), "t", "a")
    pairs = reachable_pairs(probes, postings).join(popular.select(*keys, "book_id"), [*keys, "book_id"], "left_anti")
    others = score_candidates(pairs, catalog)
    both = popular.drop("candidate_rank").select(*others.columns).unionByName(others).where(F.col("score") >= threshold)
    rated = both.join(catalog.select("book_id", "ratings_count", "bayesian_rating"), "book_id")
    order = [F.col("score").desc(), *popularity_order()]
    return top_k(rated, keys, order, 1, "_rank").drop("_rank", "ratings_count", "bayesian_rating")


def argmax_match(scored: DataFrame, keys: list[str]) -> DataFrame:
    """Highest score per key; ties go to the more popular candidate."""
    order = [F.col("score").desc(), F.col("candidate_rank").asc()]
    return top_k(scored, keys, order, 1, "_rank").drop("_rank")


def local_match(
    inputs: DataFrame, catalog: DataFrame, keys: list[str], threshold: float = 88.0, limit: int | None = None
) -> DataFrame:
    """ISBN first, then the best fuzzy title; (keys, book_id, score parts, via).

    ``inputs`` has the keys and title, author, isbn. Equal inputs are matched once. With a ``limit`` only that many of the
    most popular candidates, and exact titles, are looked at.
    """
    by_isbn = isbn_match_join(inputs, catalog).select(
        *keys, "book_id", F.lit(100.0).alias("score"), F.lit(None).cast("double").alias("title_score"),
        F.lit(None).cast("double").alias("author_score"), F.lit("isbn").alias("via"),
    )
    rest = inputs.join(by_isbn.select(*keys), keys, "left_anti")
    requests = match_requests(rest)
    if limit is None:
        best = best_match(requests, catalog, threshold)
    else:
        best = argmax_match(score_candidates(request_candidates(requests, catalog, limit), catalog), ["q_title", "q_author"])
    named = rest.where(F.coalesce("title", F.lit("")) != "").select(
        *keys, normalize_text("title").alias("q_title"), normalize_text("author").alias("q_author")
    )
    by_title = named.join(best.where(F.col("score") >= threshold), ["q_title", "q_author"]).select(
        *keys, "book_id", "score", "title_score", "author_score", F.lit("title").alias("via")
    )
    return by_isbn.unionByName(by_title)


def canonical_edition(matches: DataFrame, catalog: DataFrame) -> DataFrame:
    """Moves a match to its work's canonical edition, which is the one with vectors.

    Where a catalog marks several editions of a work, the most popular one counts.
    """
    in_work = catalog.where(F.col("work_id").isNotNull())
    canonical = top_k(in_work.where(F.col("is_canonical_edition")), ["work_id"], popularity_order(), 1, "_rank")
    others = in_work.where(~F.coalesce("is_canonical_edition", F.lit(False))).select("book_id", "work_id")
    moved = others.join(canonical.select(F.col("book_id").alias("_canonical"), "work_id"), "work_id").drop("work_id")
    target = F.coalesce("_canonical", "book_id")
    return matches.join(moved, "book_id", "left").withColumn("book_id", target).drop("_canonical")


def hybrid_lookup(books: DataFrame, hybrid_map: DataFrame, book_id: str = "book_id") -> DataFrame:
    """Row positions of a book in the hybrid, content and collaborative tables."""
    columns = [
        c for c in ("hybrid_index", "content_global_row", "collaborative_item_index") if c in hybrid_map.columns
    ]
    return books.join(hybrid_map.select(F.col("book_id").alias(book_id), *columns), book_id, "left")


def cold_start_text(volumes: DataFrame) -> DataFrame:
    """Weighted text of an external volume; empty parts are left out."""
    authors, categories = F.concat_ws(" ", "authors"), F.concat_ws(" | ", "categories")
    language = F.when(F.col("language") != "", F.concat(F.lit("language_"), F.col("language")))
    parts = F.array(*["title"] * 3, authors, authors, categories, categories, "description", language)
    filled = F.filter(parts, lambda p: p != "")
    return volumes.withColumn("cold_start_content_text", F.trim(F.concat_ws(" ", filled)))


def enriched_match(volumes: DataFrame, catalog: DataFrame, keys: list[str], threshold: float = 90.0,
                   limit: int | None = None):
    """First external volume, in order, that leads to a catalog edition.

    ``volumes`` has the keys, position, title, authors, isbn10 and isbn13.
    """
    each = [*keys, "position"]
    first_isbn = F.coalesce(F.when(F.col("isbn13") != "", F.col("isbn13")), F.col("isbn10"))
    # the match reads both sides several times: volumes are parsed and texts read once
    asked = cut_lineage(volumes.select(*each, "title", F.try_element_at("authors", F.lit(1)).alias("author"), first_isbn.alias("isbn")))
    hits = local_match(asked, cut_lineage(catalog.select(*MATCHED_BY)), each, threshold, limit)
    return top_k(hits, keys, [F.col("position").asc()], 1, "_rank").drop("_rank", "position")


def _notes(via: str) -> Column:
    score = lambda label, c: F.concat(F.lit(label), F.expr(f"format_number({c}, '0.00')"))
    return {
        "isbn": F.array(F.lit(NOTE_ISBN)),
        "title": F.array(score("Fuzzy title score: ", "title_score"), score("Fuzzy author score: ", "author_score")),
        "external isbn": F.array(F.lit(NOTE_RESOLVED), F.lit(NOTE_EXTERNAL_ISBN)),
        "external title": F.array(
            F.lit(NOTE_RESOLVED),
            score("Google-to-local title score: ", "title_score"),
            score("Google-to-local author score: ", "author_score"),
        ),
    }[via]


def match_record(
    inputs: DataFrame,
    catalog: DataFrame,
    keys: list[str],
    local: DataFrame,
    enriched: DataFrame | None = None,
    volumes: DataFrame | None = None,
    hybrid_map: DataFrame | None = None,
) -> DataFrame:
    """One 22-column record per input from the match tables."""
    hits = local.withColumns(
        {
            "match_method": F.when(F.col("via") == "isbn", ISBN_EXACT).otherwise(TITLE_FUZZY),
            "notes": F.when(F.col("via") == "isbn", _notes("isbn")).otherwise(_notes("title")),
        }
    )
    if enriched is not None:
        hits = hits.unionByName(
            enriched.withColumns(
                {
                    "match_method": F.when(F.col("via") == "isbn", EXTERNAL_ISBN).otherwise(EXTERNAL_FUZZY),
                    "notes": F.when(F.col("via") == "isbn", _notes("external isbn")).otherwise(_notes("external title")),
                }
            )
        )
    null = lambda kind: F.lit(None).cast(kind)
    found = hits.join(catalog.select("book_id", *DETAILS), "book_id")
    if hybrid_map is not None:
        found = hybrid_lookup(found, hybrid_map)
    for column in ("hybrid_index", "content_global_row", "collaborative_item_index"):
        found = found if column in found.columns else found.withColumn(column, null("bigint"))
    matched = found.select(
        *keys,
        F.lit(MATCHED).alias("status"),
        F.lit(LOCAL).alias("source"),
        F.round("score", 4).alias("confidence"),
        "match_method",
        F.col("book_id").alias("local_book_id"),
        "hybrid_index",
        "content_global_row",
        "collaborative_item_index",
        *DETAILS[:5],
        F.col("publication_year").cast("int").alias("publication_year"),
        *DETAILS[6:],
        null("string").alias("google_volume_id"),
        null("array<string>").alias("google_categories"),
        null("string").alias("google_language"),
        null("string").alias("cold_start_content_text"),
        "notes",
    )
    rest = inputs.select(*keys).join(hits.select(*keys), keys, "left_anti")
    if volumes is None:
        cold = matched.limit(0)
    else:
        first = top_k(volumes, keys, [F.col("position").asc()], 1, "_rank")
        cold = cold_start_text(first.join(rest, keys, "left_semi")).select(
            *keys,
            F.lit(COLD_START).alias("status"),
            F.lit(EXTERNAL).alias("source"),
            F.lit(100.0).alias("confidence"),
            F.lit(EXTERNAL_ONLY).alias("match_method"),
            *(null("bigint").alias(c) for c in ("local_book_id", "work_id", "hybrid_index", "content_global_row", "collaborative_item_index")),
            "title",
            F.when(F.size("authors") > 0, F.array_join("authors", ", ")).alias("primary_author"),
            F.col("isbn10").alias("isbn"),
            "isbn13",
            F.substring("published_date", 1, 4).try_cast("int").alias("publication_year"),
            F.try_element_at("categories", F.lit(1)).alias("primary_genre"),
            "description",
            F.col("thumbnail_url").alias("image_url"),
            "google_volume_id",
            F.col("categories").alias("google_categories"),
            F.col("language").alias("google_language"),
            "cold_start_content_text",
            F.array(*(F.lit(n) for n in NOTES_COLD)).alias("notes"),
        )
    nothing = rest.join(cold.select(*keys), keys, "left_anti").withColumns(
        {
            "status": F.lit(UNMATCHED),
            "source": F.lit(NOWHERE),
            "confidence": F.lit(0.0),
            "match_method": F.lit(NO_METHOD),
            "notes": F.array(F.lit(NOTE_NOTHING)),
        }
    )
    records = matched.unionByName(cold).unionByName(nothing, allowMissingColumns=True)
    return records.select(*keys, *RECORD)


def match_books(
    inputs: DataFrame,
    catalog: DataFrame,
    keys: list[str],
    local: float = 88.0,
    enriched: float = 90.0,
    limit: int | None = None,
    volumes: DataFrame | None = None,
    hybrid_map: DataFrame | None = None,
    to_canonical: bool = True,
) -> DataFrame:
    """ISBN, then fuzzy title, then external volumes, then cold start or unmatched.

    Inputs, catalog and the volumes still wanted are stored first: every step reads them again, and only the columns it needs.
    """
    inputs, catalog = cut_lineage(inputs), cut_lineage(catalog)
    place = (lambda m: canonical_edition(m, catalog)) if to_canonical else (lambda m: m)
    found = cut_lineage(place(local_match(inputs, catalog, keys, local, limit)))
    resolved, offered = None, None
    if volumes is not None:
        offered = cut_lineage(volumes.join(inputs.select(*keys).join(found.select(*keys), keys, "left_anti"), keys, "left_semi"))
        resolved = cut_lineage(place(enriched_match(offered, catalog, keys, enriched, limit)))
    return match_record(inputs, catalog, keys, found, resolved, offered, hybrid_map)
