"""Identifier and text matching, enrichment and the response cache."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import text
from lectern.operators import enrichment as enr, library as lib, matching as ops
from lectern.plans.catalog_queries import CATALOG_SQL
from lectern.plans.content_queries import embedded
from lectern.plans.inputs import Inputs, big, place, query
from lectern.session import cut_lineage
from lectern.sources import cache_table

LIMIT = 250
_FOLD = "TRIM(REGEXP_REPLACE(REPLACE(LOWER(strip_accents(COALESCE({0}, ''))), 'ß', 'ss'), '[^a-z0-9]+', ' ', 'g'))"
_WORDS = "list_filter(string_split({0}, ' '), lambda t: LENGTH(t) >= 3)[1:{1}]"
_INSIDE = """({0} <> '' AND {1} <> '' AND (list_has_all(string_split({0}, ' '), string_split({1}, ' '))
    OR list_has_all(string_split({1}, ' '), string_split({0}, ' '))))"""

MATCH_SQL = {
    # catalog of documents: ISBN-like keys, popularity from the labels of the text
    "editions_d": """SELECT book_id, CAST(FLOOR(book_id / 2) AS BIGINT) AS work_id, title, primary_author, primary_genre,
        is_canonical_edition, LPAD(CAST(book_id AS VARCHAR), 10, '0') AS isbn,
        CASE WHEN book_id % 3 = 0 THEN '978' || LPAD(CAST(book_id AS VARCHAR), 10, '0') END AS isbn13, publication_year,
        description, CAST(LENGTH(description) % 97 AS BIGINT) AS ratings_count, CAST(LENGTH(description) % 7 AS DOUBLE) AS bayesian_rating
        FROM documents_v""",
    # one input per document: the title edited in five ways, the author kept or missing
    "asked": """SELECT book_id AS input_id, CASE book_id % 5 WHEN 0 THEN title WHEN 1 THEN regexp_replace(title, ' [^ ]*$', '')
        WHEN 2 THEN regexp_replace(title, '^([^ ]+) ([^ ]+)', '\\2 \\1') WHEN 3 THEN UPPER(title) ELSE strip_accents(title) END AS title,
        CASE WHEN book_id % 2 = 0 THEN primary_author END AS author,
        CASE book_id % 6 WHEN 0 THEN LPAD(CAST(book_id AS VARCHAR), 10, '0') WHEN 1 THEN '="' || LPAD(CAST(book_id AS VARCHAR), 10, '0') || '"'
        WHEN 2 THEN '978-' || LPAD(CAST(book_id AS VARCHAR), 10, '0') WHEN 3 THEN '' END AS isbn FROM documents_v""",
    "isbn_keys": """SELECT isbn_key, book_id FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY isbn_key ORDER BY is_canonical_edition DESC,
        ratings_count DESC NULLS LAST, book_id) AS rn FROM (
        SELECT DISTINCT UNNEST([REGEXP_REPLACE(UPPER(COALESCE(isbn, '')), '[^0-9X]', '', 'g'), REGEXP_REPLACE(UPPER(COALESCE(isbn13, '')), '[^0-9X]', '', 'g')]) AS isbn_key,
        book_id, is_canonical_edition, ratings_count FROM editions_d) WHERE isbn_key <> '') WHERE rn = 1""",
    "requests": f"""SELECT DISTINCT {_FOLD.format('title')} AS q_title, {_FOLD.format('author')} AS q_author FROM asked WHERE COALESCE(title, '') <> ''""",
    "request_words": f"SELECT *, {_WORDS.format('q_title', 4)} AS t, {_WORDS.format('q_author', 2)} AS a FROM requests",
    "blocked": f"""SELECT * FROM (SELECT q_title, q_author, book_id, ROW_NUMBER() OVER (PARTITION BY q_title, q_author
        ORDER BY ratings_count DESC NULLS LAST, bayesian_rating DESC NULLS LAST, book_id) AS candidate_rank
        FROM request_words JOIN editions_d ON is_canonical_edition
        AND (len(t) = 0 OR len(list_filter(t, lambda x: contains(LOWER(COALESCE(title, '')), x))) > 0)
        AND (len(a) = 0 OR len(list_filter(a, lambda x: contains(LOWER(COALESCE(primary_author, '')), x))) > 0)) WHERE candidate_rank <= {LIMIT}""",
    "blocked_all": """SELECT q_title, q_author, book_id FROM request_words JOIN editions_d ON is_canonical_edition
        AND (len(t) = 0 OR len(list_filter(t, lambda x: contains(LOWER(COALESCE(title, '')), x))) > 0)
        AND (len(a) = 0 OR len(list_filter(a, lambda x: contains(LOWER(COALESCE(primary_author, '')), x))) > 0)""",
    # the score is 100 exactly where one side's tokens are all on the other side, title and (if named) author
    "folded": f"SELECT *, {_FOLD.format('title')} AS c_title, {_FOLD.format('primary_author')} AS c_author FROM editions_d",
    "judged": f"""SELECT q_title, q_author, book_id, candidate_rank, {_INSIDE.format('q_title', 'c_title')} AS title_perfect,
        {_INSIDE.format('q_author', 'c_author')} AS author_perfect FROM blocked JOIN folded USING (book_id)""",
    "isbn_hits": """SELECT input_id, COALESCE(CASE WHEN e.is_canonical_edition THEN e.book_id END, (SELECT c.book_id FROM editions_d c WHERE c.is_canonical_edition AND c.work_id = e.work_id
        ORDER BY ratings_count DESC NULLS LAST, bayesian_rating DESC NULLS LAST, c.book_id LIMIT 1), e.book_id) AS book_id
        FROM asked JOIN isbn_keys k ON isbn_key = REGEXP_REPLACE(UPPER(isbn), '[^0-9X]', '', 'g') JOIN editions_d e ON e.book_id = k.book_id""",
    "perfect_hits": f"""SELECT q_title, q_author, book_id, ROW_NUMBER() OVER (PARTITION BY q_title, q_author
        ORDER BY ratings_count DESC NULLS LAST, bayesian_rating DESC NULLS LAST, book_id) AS place FROM (
        SELECT q_title, q_author, book_id FROM blocked_all UNION SELECT q_title, q_author, book_id FROM requests JOIN folded
        ON is_canonical_edition AND q_title = c_title AND q_title <> '') JOIN folded USING (book_id)
        WHERE {_INSIDE.format('q_title', 'c_title')} AND (q_author = '' OR {_INSIDE.format('q_author', 'c_author')})""",
}


def editions(inp: Inputs):
    key = F.lpad(F.col("book_id").cast("string"), 10, "0")
    length = F.length("description")
    return inp.view("documents_v").select(
        "book_id", F.floor(F.col("book_id") / 2).alias("work_id"), "title", "primary_author", "primary_genre",
        "is_canonical_edition", key.alias("isbn"),
        F.when(F.col("book_id") % 3 == 0, F.concat(F.lit("978"), key)).alias("isbn13"), "publication_year", "description",
        (length % 97).cast("bigint").alias("ratings_count"), (length % 7).cast("double").alias("bayesian_rating"),
        F.lit(None).cast("string").alias("image_url"),
    )


def asked(inp: Inputs):
    key, title = F.lpad(F.col("book_id").cast("string"), 10, "0"), F.col("title")
    edit = lambda n: F.col("book_id") % 5 == n
    code = F.col("book_id") % 6
    edited = (
        F.when(edit(0), title).when(edit(1), F.regexp_replace(title, " [^ ]*$", ""))
        .when(edit(2), F.regexp_replace(title, "^([^ ]+) ([^ ]+)", "$2 $1")).when(edit(3), F.upper(title))
        .otherwise(text.fold_accents(title))
    )
    isbn = (
        F.when(code == 0, key).when(code == 1, F.concat(F.lit('="'), key, F.lit('"')))
        .when(code == 2, F.concat(F.lit("978-"), key)).when(code == 3, "")
    )
    return inp.view("documents_v").select(
        F.col("book_id").alias("input_id"), edited.alias("title"),
        F.when(F.col("book_id") % 2 == 0, F.col("primary_author")).alias("author"), isbn.alias("isbn"),
    )


def landed(inp: Inputs):
    """Search responses as JSON text: two volumes per input."""
    docs = inp.view("documents_v")
    key = F.lpad(F.col("book_id").cast("string"), 10, "0")
    identifier = lambda kind, value: F.struct(F.lit(kind).alias("type"), value.alias("identifier"))
    info = lambda title: F.struct(
        title.alias("title"), F.array("primary_author").alias("authors"), F.col("description"),
        F.col("language_code").alias("language"), F.array("primary_genre").alias("categories"),
        F.concat(F.col("publication_year").cast("string"), F.lit("-05")).alias("publishedDate"),
        F.array(
            identifier("isbn_10", F.concat(F.lit("99"), key)), identifier("ISSN", F.concat(F.lit(" "), key))
        ).alias("industryIdentifiers"),
        (F.length("description") % 500).alias("pageCount"),
        F.struct(F.concat(F.lit("http://covers/"), key).alias("small"), F.lit("").alias("large")).alias("imageLinks"),
    )
    volume = lambda title: F.to_json(F.struct(key.alias("id"), info(title).alias("volumeInfo")))
    pair = F.array(volume(F.concat(F.lit("Notes on "), F.col("title"))), volume(F.col("title")))
    return docs.select(F.col("book_id").alias("input_id"), F.posexplode(pair).alias("position", "json"))


@query("normalize_text", f"SELECT doc_id, {_FOLD.format('text')} AS normalized FROM {{documents}}")
def normalize_text(inp):
    return inp.table("documents").select("doc_id", text.normalize_text("text").alias("normalized"))


@query("normalize_isbn", "SELECT input_id, REGEXP_REPLACE(UPPER(COALESCE(isbn, '')), '[^0-9X]', '', 'g') AS isbn FROM asked", MATCH_SQL)
def normalize_isbn(inp):
    return asked(inp).select("input_id", text.normalize_isbn("isbn").alias("isbn"))


@query("title_tokens", "SELECT q_title, q_author, t, a FROM request_words", MATCH_SQL)
def title_tokens(inp):
    return ops.match_requests(asked(inp))


@query("isbn_match_join", "SELECT input_id, isbn_key, k.book_id FROM asked JOIN isbn_keys k ON isbn_key = REGEXP_REPLACE(UPPER(isbn), '[^0-9X]', '', 'g')", MATCH_SQL)
def isbn_match_join(inp):
    return ops.isbn_match_join(asked(inp), editions(inp)).select("input_id", "isbn_key", "book_id")


@query("blocked_fuzzy_join", "SELECT q_title, q_author, book_id, candidate_rank FROM blocked", MATCH_SQL)
def blocked_fuzzy_join(inp):
    found = ops.blocked_fuzzy_join(ops.match_requests(asked(inp)), editions(inp), LIMIT)
    return big(found.select("q_title", "q_author", "book_id", "candidate_rank"), "candidate_rank")


@query(
    "limit_candidates",
    """SELECT primary_genre, book_id, candidate_rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY primary_genre ORDER BY ratings_count DESC,
    bayesian_rating DESC, book_id) AS candidate_rank FROM editions_d) WHERE candidate_rank <= 10""",
    MATCH_SQL,
)
def limit_candidates(inp):
    kept = ops.limit_candidates(editions(inp), ["primary_genre"], 10)
    return big(kept.select("primary_genre", "book_id", "candidate_rank"), "candidate_rank")


def scored_candidates(inp: Inputs):
    catalog = editions(inp)
    return ops.score_candidates(ops.blocked_fuzzy_join(ops.match_requests(asked(inp)), catalog, LIMIT), catalog)


_PERFECT = "title_perfect AND (q_author = '' OR author_perfect)"


@query(
    "fuzzy_score",
    f"""SELECT q_title, q_author, book_id, title_perfect, author_perfect, CASE WHEN {_PERFECT} THEN 100.0::DOUBLE END AS full_score,
    TRUE AS in_range FROM judged""",
    MATCH_SQL,
)
def fuzzy_score(inp):
    """Which scores of the blocked pairs are full, and whether the others lie below."""
    shown = scored_candidates(inp)
    full = F.col("score") > 100 - 1e-9
    parts = ("title_score", "author_score", "score")
    inside = F.forall(F.array(*parts), lambda s: s.between(0, 100 + 1e-9)) & (F.col("score") <= F.greatest("title_score", "author_score") + 1e-9)
    return shown.select(
        "q_title", "q_author", "book_id", (F.col("title_score") == 100).alias("title_perfect"),
        (F.col("author_score") == 100).alias("author_perfect"), F.when(full, 100.0).alias("full_score"), inside.alias("in_range"),
    )


@query(
    "argmax_match",
    f"""SELECT q_title, q_author, MAX(CASE WHEN {_PERFECT} THEN 1 ELSE 0 END) = 1 AS perfect,
    ARG_MIN(book_id, candidate_rank) FILTER ({_PERFECT}) AS book_id FROM judged GROUP BY q_title, q_author""",
    MATCH_SQL,
)
def argmax_match(inp):
    """The winner of each request that has a full score."""
    best = ops.argmax_match(scored_candidates(inp), ["q_title", "q_author"])
    full = F.col("score") > 100 - 1e-9
    return best.select("q_title", "q_author", full.alias("perfect"), F.when(full, F.col("book_id")).alias("book_id"))


def matched(inp: Inputs):
    volumes = enr.parse_volumes(landed(inp))
    return ops.match_books(asked(inp), editions(inp), ["input_id"], volumes=volumes)


@query(
    "match_books",
    f"""SELECT a.input_id, CASE WHEN i.book_id IS NOT NULL THEN '{ops.ISBN_EXACT}' WHEN p.book_id IS NOT NULL THEN '{ops.TITLE_FUZZY}' END AS sure_method,
    COALESCE(i.book_id, p.book_id) AS sure_book_id FROM asked a LEFT JOIN isbn_hits i ON i.input_id = a.input_id
    LEFT JOIN perfect_hits p ON p.place = 1 AND p.q_title = {_FOLD.format('a.title')} AND p.q_author = {_FOLD.format('a.author')}""",
    MATCH_SQL,
)
def match_books(inp):
    """Every input, with the method and the book of matches by ISBN and of full title scores."""
    sure = (F.col("confidence") >= 100) & F.col("match_method").isin(ops.ISBN_EXACT, ops.TITLE_FUZZY)
    return matched(inp).select(
        "input_id", F.when(sure, F.col("match_method")).alias("sure_method"), F.when(sure, F.col("local_book_id")).alias("sure_book_id")
    )


_SHOWN = ("title", "primary_author", "isbn", "isbn13", "primary_genre", "description")


@query(
    "match_record",
    f"""SELECT a.input_id, TRUE AS known, b.book_id IS NOT NULL AS sure, CASE WHEN b.book_id IS NOT NULL THEN '{ops.MATCHED}' END AS status,
    CASE WHEN b.book_id IS NOT NULL THEN '{ops.LOCAL}' END AS source, CASE WHEN b.book_id IS NOT NULL THEN 100.0::DOUBLE END AS confidence,
    CASE WHEN i.book_id IS NOT NULL THEN '{ops.ISBN_EXACT}' WHEN b.book_id IS NOT NULL THEN '{ops.TITLE_FUZZY}' END AS match_method,
    b.book_id AS local_book_id, b.work_id, {", ".join("b." + c for c in _SHOWN)}, CAST(b.publication_year AS INTEGER) AS publication_year,
    CASE WHEN i.book_id IS NOT NULL THEN '{ops.NOTE_ISBN}' END AS isbn_note
    FROM asked a LEFT JOIN isbn_hits i ON i.input_id = a.input_id
    LEFT JOIN perfect_hits p ON p.place = 1 AND p.q_title = {_FOLD.format('a.title')} AND p.q_author = {_FOLD.format('a.author')}
    LEFT JOIN editions_d b ON b.book_id = COALESCE(i.book_id, p.book_id)""",
    MATCH_SQL,
)
def match_record(inp):
    """The record of every input: whole where an ISBN or a full title score decides, its status and parts checked otherwise."""
    records = matched(inp)
    method, status = F.col("match_method"), F.col("status")
    sure = (F.col("confidence") >= 100) & method.isin(ops.ISBN_EXACT, ops.TITLE_FUZZY)
    fits = (
        F.when(status == ops.MATCHED, F.col("local_book_id").isNotNull() & F.col("google_volume_id").isNull() & (F.col("confidence") >= 88))
        .when(status == ops.COLD_START, F.col("local_book_id").isNull() & (F.col("cold_start_content_text") != ""))
        .when(status == ops.UNMATCHED, F.col("local_book_id").isNull() & (F.col("confidence") == 0))
    )
    whole = ("status", "source", "confidence", "match_method", "local_book_id", "work_id", *_SHOWN, "publication_year")
    return records.select(
        "input_id", F.coalesce(fits & (F.size("notes") > 0), F.lit(False)).alias("known"), sure.alias("sure"),
        *(F.when(sure, F.col(c)).alias(c) for c in whole),
        F.when(sure & (method == ops.ISBN_EXACT), F.col("notes")[0]).alias("isbn_note"),
    )


@query("enriched_match")
def enriched_match(inp):
    hits = ops.enriched_match(enr.parse_volumes(landed(inp)), editions(inp), ["input_id"])
    return hits.select("input_id", "book_id", "score", "via")


@query(
    "cold_start_text",
    """SELECT book_id AS input_id, TRIM(concat_ws(' ', NULLIF(title, ''), NULLIF(title, ''), NULLIF(title, ''), NULLIF(primary_author, ''),
    NULLIF(primary_author, ''), NULLIF(primary_genre, ''), NULLIF(primary_genre, ''), NULLIF(description, ''), 'language_' || language_code)) AS cold_start_content_text
    FROM documents_v""",
)
def cold_start_text(inp):
    offered = enr.parse_volumes(landed(inp)).where(F.col("position") == 1)
    return ops.cold_start_text(offered).select("input_id", "cold_start_content_text")


_LIBRARY = """SELECT event_id, user_id, CAST(event_id % 50 AS VARCHAR) AS "Book Id", p_name AS "Title", p_brand AS "Author",
    CASE event_type WHEN 'purchase' THEN ' Read' WHEN 'click' THEN 'read' WHEN 'view' THEN 'currently-reading' WHEN 'signup' THEN 'to-read' ELSE 'dropped' END AS "Exclusive Shelf",
    CAST(CAST(FLOOR(value) AS INT) % 6 AS VARCHAR) AS "My Rating" FROM (SELECT *, event_id % (SELECT COUNT(*) FROM {part}) AS part_id FROM {events}) JOIN {part} ON p_partkey = part_id"""


def export(inp: Inputs):
    """Library exports of many readers, all text, as a reader would give them."""
    from lectern.sources.readers import library_columns

    shelf = {"purchase": " Read", "click": "read", "view": "currently-reading", "signup": "to-read"}
    chain = None
    for event, name in shelf.items():
        chain = (F if chain is None else chain).when(F.col("event_type") == event, name)
    parts = inp.table("part")
    events = inp.table("events").withColumn("p_partkey", F.col("event_id") % F.lit(parts.count()))
    rows = events.join(parts, "p_partkey").select(
        F.col("event_id").alias("source_row"), "user_id", (F.col("event_id") % 50).cast("string").alias("Book Id"),
        F.col("p_name").alias("Title"), F.col("p_brand").alias("Author"), chain.otherwise("dropped").alias("Exclusive Shelf"),
        (F.floor("value").cast("int") % 6).cast("string").alias("My Rating"),
        F.date_format("ts", "yyyy/MM/dd").alias("Date Read"), (F.lit(1) + F.col("event_id") % 3).cast("string").alias("Read Count"),
    )
    return library_columns(rows)


_CLEAN = {
    "export_rows": _LIBRARY,
    "clean": """SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY goodreads_book_id, source_row) - 1 AS library_row_id FROM (
        SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, LOWER(title), author_key ORDER BY goodreads_book_id, source_row) AS rn FROM (
        SELECT user_id, event_id AS source_row, CAST("Book Id" AS BIGINT) AS goodreads_book_id, "Title" AS title, "Author" AS author,
        TRIM(REGEXP_REPLACE(LOWER("Author"), '[^a-z0-9]+', ' ', 'g')) AS author_key, LOWER(TRIM("Exclusive Shelf")) AS exclusive_shelf,
        CAST("My Rating" AS DOUBLE) AS my_rating FROM export_rows) WHERE exclusive_shelf IN ('read', 'currently-reading', 'to-read')) WHERE rn = 1""",
}


def cleaned(inp: Inputs):
    return lib.clean_library(export(inp), ["user_id"])


@query("clean_library", "SELECT user_id, library_row_id, source_row, goodreads_book_id, title, author_key, exclusive_shelf, my_rating FROM clean", _CLEAN)
def clean_library(inp):
    return cleaned(inp).select(
        "user_id", "library_row_id", "source_row", "goodreads_book_id", "title", "author_key", "exclusive_shelf", "my_rating"
    )


@query("dedupe_library", "SELECT user_id, COUNT(*) AS rows, MIN(library_row_id) AS first_id, MAX(library_row_id) AS last_id FROM clean GROUP BY user_id", _CLEAN)
def dedupe_library(inp):
    return cleaned(inp).groupBy("user_id").agg(
        F.count("*").alias("rows"), F.min("library_row_id").alias("first_id"), F.max("library_row_id").alias("last_id")
    )


def part_catalog(inp: Inputs):
    """Parts as editions, for matching exports whose titles are part names."""
    books = inp.view("books")
    canonical = F.coalesce(F.col("work_id"), -F.col("book_id"))
    from lectern.operators.catalog import edition_rank

    ranked = books.join(edition_rank(books).select("book_id", "edition_rank"), "book_id")
    return ranked.select(
        "book_id", canonical.alias("work_id"), "title", "primary_author", "primary_genre", "publication_year",
        (F.col("edition_rank") == 1).alias("is_canonical_edition"), "ratings_count",
        F.col("average_rating").alias("bayesian_rating"),
        *(F.lit(None).cast("string").alias(c) for c in ("isbn", "isbn13", "description", "image_url")),
    )


def imported(inp: Inputs):
    return lib.import_library(cleaned(inp), part_catalog(inp), ["user_id"])


_IMPORT = {
    **_CLEAN,
    "editions": CATALOG_SQL["editions"],
    "canonical_parts": f"""SELECT book_id, title, primary_author, ratings_count, average_rating, {_FOLD.format('title')} AS c_title,
        {_FOLD.format('primary_author')} AS c_author FROM books JOIN editions USING (book_id) WHERE edition_rank = 1""",
    "library_requests": f"""SELECT *, {_WORDS.format('q_title', 4)} AS t, {_WORDS.format('q_author', 2)} AS a FROM (
        SELECT DISTINCT {_FOLD.format('title')} AS q_title, {_FOLD.format('author')} AS q_author FROM clean WHERE COALESCE(title, '') <> '')""",
    # all candidates of full score: a shared token of title and author, or an equal title
    "library_hits": f"""SELECT q_title, q_author, book_id, ROW_NUMBER() OVER (PARTITION BY q_title, q_author
        ORDER BY ratings_count DESC NULLS LAST, average_rating DESC NULLS LAST, book_id) AS place FROM library_requests JOIN canonical_parts
        ON {_INSIDE.format('q_title', 'c_title')} AND (q_author = '' OR {_INSIDE.format('q_author', 'c_author')}) AND (q_title = c_title OR (
        (len(t) = 0 OR len(list_filter(t, lambda x: contains(LOWER(COALESCE(title, '')), x))) > 0)
        AND (len(a) = 0 OR len(list_filter(a, lambda x: contains(LOWER(COALESCE(primary_author, '')), x))) > 0)))""",
}


@query(
    "import_library",
    f"""SELECT user_id, library_row_id, title AS input_title, author AS input_author, TRUE AS known,
    CASE WHEN h.book_id IS NOT NULL THEN '{ops.TITLE_FUZZY}' END AS sure_method, h.book_id AS sure_book_id
    FROM clean LEFT JOIN library_hits h ON h.place = 1 AND h.q_title = {_FOLD.format('title')} AND h.q_author = {_FOLD.format('author')}""",
    _IMPORT,
)
def import_library(inp):
    """Every cleaned row with the book of a full score; a match below it reaches the threshold, the rest has none."""
    sure = F.coalesce(F.col("match_confidence") >= 100, F.lit(False))
    fits = F.when(F.col("match_status") == ops.MATCHED, F.col("local_book_id").isNotNull() & (F.col("match_confidence") >= 88)).otherwise(
        (F.col("match_status") == ops.UNMATCHED) & F.col("local_book_id").isNull())
    return imported(inp).select(
        "user_id", "library_row_id", "input_title", "input_author", F.coalesce(fits, F.lit(False)).alias("known"),
        F.when(sure, F.col("match_method")).alias("sure_method"), F.when(sure, F.col("local_book_id")).alias("sure_book_id"),
    )


@query(
    "import_report",
    """SELECT COUNT(*) AS imported_rows, COUNT(*) FILTER (exclusive_shelf IN ('read', 'currently-reading')) AS profile_eligible_rows,
    COUNT(*) AS recommendation_exclusion_rows, TRUE AS adds_up, TRUE AS rate_fits FROM clean""",
    _CLEAN,
)
def import_report(inp):
    """The report over all outputs of an import: the three statuses add up, and the tables cut from it agree with it."""
    rows = cut_lineage(imported(inp))
    cut = lib.split_by_status(rows, ["user_id"])
    sizes = {name: df.agg(F.count("*")).scalar() for name, df in cut.items()}
    report = lib.import_report(rows)
    agrees = (
        (F.col("matched_rows") == sizes["matched"]) & (F.col("cold_start_rows") == sizes["cold_start"])
        & (F.col("unmatched_rows") == sizes["unmatched"]) & (F.col("recommendation_exclusion_rows") == sizes["exclusion_books"])
        & (F.col("matched_rows") + F.col("cold_start_rows") + F.col("unmatched_rows") == F.col("imported_rows"))
    )
    return report.select(
        "imported_rows", "profile_eligible_rows", "recommendation_exclusion_rows", agrees.alias("adds_up"),
        (F.abs(F.col("match_rate") * F.col("imported_rows") - F.col("matched_rows")) < 1e-6).alias("rate_fits"),
    )


@query(
    "resume_anti_join",
    "SELECT user_id, library_row_id FROM clean WHERE NOT EXISTS (SELECT 1 FROM {events} e WHERE e.user_id = clean.user_id AND e.event_id = clean.library_row_id)",
    _CLEAN,
)
def resume_anti_join(inp):
    done = inp.table("events").select("user_id", F.col("event_id").alias("library_row_id"))
    rows = cleaned(inp).select("user_id", "library_row_id")
    return lib.resume_anti_join(rows, done, ["user_id", "library_row_id"])


_SAFE = """SELECT event_id, TRY_CAST(TRY_CAST(shown AS DOUBLE) AS DOUBLE) AS number, CAST(TRUNC(TRY_CAST(shown AS DOUBLE)) AS BIGINT) AS whole
    FROM (SELECT event_id, CASE event_id % 4 WHEN 0 THEN CAST(value AS VARCHAR) WHEN 1 THEN event_type WHEN 2 THEN '' ELSE CAST(event_id AS VARCHAR) || '.0' END AS shown FROM {events})"""


def _shown(inp: Inputs):
    n = F.col("event_id") % 4
    shown = (
        F.when(n == 0, F.col("value").cast("string")).when(n == 1, F.col("event_type")).when(n == 2, "")
        .otherwise(F.concat(F.col("event_id").cast("string"), F.lit(".0")))
    )
    return inp.table("events").withColumn("shown", shown)


@query("safe_float", f"SELECT event_id, number FROM ({_SAFE})")
def safe_float(inp):
    return _shown(inp).select("event_id", text.safe_float("shown").alias("number"))


@query("safe_int", f"SELECT event_id, whole FROM ({_SAFE})")
def safe_int(inp):
    return _shown(inp).select("event_id", text.safe_int("shown").alias("whole"))


@query("parse_year", "SELECT o_orderkey, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(YEAR(o_orderdate) AS INT) END AS year FROM {orders}")
def parse_year(inp):
    shown = F.when(F.col("o_orderkey") % 3 != 0, F.date_format("o_orderdate", "yyyy")).otherwise("n. d.")
    return inp.table("orders").select("o_orderkey", text.parse_year(shown).alias("year"))


@query(
    "volume_flatten",
    """SELECT book_id AS input_id, position, LPAD(CAST(book_id AS VARCHAR), 10, '0') AS google_volume_id,
    CASE WHEN position = 0 THEN 'Notes on ' || title ELSE title END AS title, primary_author AS authors, primary_genre AS categories,
    '99' || LPAD(CAST(book_id AS VARCHAR), 10, '0') AS isbn10, CAST(NULL AS VARCHAR) AS isbn13,
    '{"ISSN":"' || LPAD(CAST(book_id AS VARCHAR), 10, '0') || '"}' AS other_identifiers, CAST(LENGTH(description) % 500 AS BIGINT) AS page_count,
    'https://covers/' || LPAD(CAST(book_id AS VARCHAR), 10, '0') AS thumbnail_url, description
    FROM documents_v, (SELECT CAST(UNNEST([0, 1]) AS INT) AS position)""",
)
def volume_flatten(inp):
    return enr.volume_flatten(landed(inp)).select(
        "input_id", "position", "google_volume_id", "title", "authors", "categories", "isbn10", "isbn13",
        "other_identifiers", "page_count", "thumbnail_url", "description",
    )


@query(
    "query_text",
    """SELECT p_partkey, 'intitle:"' || p_name || '" inauthor:"' || p_brand || '" isbn:' || p_partkey || 'x' AS query_text FROM {part}""",
)
def query_text(inp):
    isbn = F.concat(F.col("p_partkey").cast("string"), F.lit("-x"))
    built = enr.query_text(F.concat(F.lit(" "), "p_name"), F.col("p_brand"), isbn, F.lit(None).cast("string"), F.lit(" "), F.lit(""))
    return inp.table("part").select("p_partkey", built.alias("query_text"))


_KEY = """sha256('{{"params": {{"maxResults": 5, "q": "' || {0} || '"}}, "request_type": "search", "value": "' || {0} || '"}}')"""


def _request(inp: Inputs):
    value = F.concat("p_name", F.lit(" "), F.col("p_partkey").cast("string"))
    params = {"q": value, "maxResults": F.lit(5), "langRestrict": F.lit(None).cast("string"), "key": F.lit("secret")}
    return inp.table("part").select("p_partkey", enr.request_key(F.lit("search"), value, params).alias("cache_key"))


@query("request_key", "SELECT p_partkey, " + _KEY.format("p_name || ' ' || p_partkey").replace("{{", "{").replace("}}", "}") + " AS cache_key FROM {part}")
def request_key(inp):
    return _request(inp)


NOW = "2024-01-20 00:00:00"


def cache(inp: Inputs):
    """Stored responses: the first event of a key and day, valid for a few days."""
    return inp.table("events").groupBy((F.col("event_id") % 500).cast("string").alias("cache_key")).agg(
        F.min("ts").alias("fetched_at"), F.min_by("props", "event_id").alias("response_json")
    ).withColumn("expires_at", F.col("fetched_at") + F.make_dt_interval(days=F.length("cache_key") * 6))


def fetched(inp: Inputs):
    late = inp.table("events").where(F.col("event_type") == "purchase")
    return late.select((F.col("event_id") % 700).cast("string").alias("cache_key"), F.col("ts").alias("fetched_at"), F.col("props").alias("response_json"))


_CACHE = {
    "stored": """SELECT CAST(event_id % 500 AS VARCHAR) AS cache_key, MIN(ts) AS fetched_at, ARG_MIN(props, event_id) AS response_json,
        MIN(ts) + to_days(CAST(LENGTH(CAST(event_id % 500 AS VARCHAR)) * 6 AS INT)) AS expires_at FROM {events} GROUP BY event_id % 500""",
    "fetched": "SELECT CAST(event_id % 700 AS VARCHAR) AS cache_key, ts AS fetched_at, props AS response_json FROM {events} WHERE event_type = 'purchase'",
}


@query(
    "cache_lookup",
    f"SELECT event_id, CAST(event_id % 600 AS VARCHAR) AS cache_key, response_json FROM {{events}} LEFT JOIN (SELECT cache_key, response_json FROM stored WHERE expires_at > TIMESTAMP '{NOW}') USING (cache_key)".replace("FROM {events} LEFT", "FROM (SELECT *, CAST(event_id % 600 AS VARCHAR) AS cache_key FROM {events}) LEFT"),
    _CACHE,
)
def cache_lookup(inp):
    requests = inp.table("events").select("event_id", (F.col("event_id") % 600).cast("string").alias("cache_key"))
    return enr.cache_lookup(requests, cache(inp), F.lit(NOW).cast("timestamp")).select("event_id", "cache_key", "response_json")


@query(
    "cache_upsert",
    """SELECT cache_key, fetched_at, response_json, expires_at FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY cache_key
    ORDER BY fresh DESC, fetched_at DESC, response_json) AS rn FROM (SELECT *, 0 AS fresh FROM stored UNION ALL BY NAME
    SELECT *, fetched_at + INTERVAL 30 DAY AS expires_at, 1 AS fresh FROM fetched)) WHERE rn = 1""",
    _CACHE,
)
def cache_upsert(inp):
    """A stored cache after an upsert of its touched buckets."""
    path = place(inp, "cache")
    cache_table.create(cache(inp), path)
    cache_table.upsert(fetched(inp), path)
    return cache_table.read(inp.spark, path)


@query("cache_expire", f"SELECT cache_key, fetched_at, response_json, expires_at FROM stored WHERE expires_at > TIMESTAMP '{NOW}'", _CACHE)
def cache_expire(inp):
    path = place(inp, "expired-cache")
    cache_table.create(cache(inp), path)
    cache_table.expire(inp.spark, path, F.lit(NOW).cast("timestamp"))
    return cache_table.read(inp.spark, path)


@query("cold_start_recommend")
def cold_start_recommend(inp):
    from lectern.operators.popularity import percentiles
    from lectern.operators.recommend import cold_start_recommend as recommend
    from lectern.plans.popularity_queries import scored

    _, tfidf, svd, content = embedded(inp)
    texts = ops.cold_start_text(enr.parse_volumes(landed(inp)).where(F.col("position") == 0)).select(
        "input_id", F.col("cold_start_content_text").alias("content_text")
    )
    shares = percentiles(scored(inp), {"wilson_score": "popularity_percentile", "novelty_score": "novelty_percentile"})
    return recommend(texts, tfidf, svd, content, shares, 10)
