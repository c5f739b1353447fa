"""Text, identifier and lenient-parse expressions."""

from __future__ import annotations

import sys
import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F
from pyspark.sql.types import StringType

# A token is two or more word characters, hyphens allowed inside and
# dropped at the end; a single word character also passes the first class.
TOKEN_PATTERN = r"[\p{L}\p{N}_](?:[\p{L}\p{N}_-]*[\p{L}\p{N}_])"


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def _combining_class() -> str:
    """Character class of every code point with a combining class, built by rule."""
    points = [p for p in range(sys.maxunicode + 1) if unicodedata.combining(chr(p))]
    spans, start = [], points[0]
    for previous, point in zip(points, points[1:] + [None]):
        if point != previous + 1:
            spans.append(f"\\x{{{start:x}}}-\\x{{{previous:x}}}")
            start = point
    return "[" + "".join(spans) + "]+"


_MARKS = None


@F.arrow_udf(StringType())
def fold_accents(text: pa.Array) -> pa.Array:
    """Compatibility decomposition without combining marks, one Arrow batch at a time."""
    global _MARKS
    _MARKS = _MARKS or _combining_class()
    return pc.replace_substring_regex(pc.utf8_normalize(text, form="NFKD"), _MARKS, "")


def blank_to_null(value) -> Column:
    trimmed = F.trim(_col(value))
    return F.when(trimmed != "", trimmed)


def normalize_text(value) -> Column:
    """Accent-free, case-folded, runs of anything but a-z and 0-9 become one blank."""
    folded = F.lower(fold_accents(F.coalesce(_col(value), F.lit(""))))
    return F.trim(F.regexp_replace(F.replace(folded, F.lit("ß"), F.lit("ss")), "[^a-z0-9]+", " "))


def title_key(title_without_series, title) -> Column:
    text = F.coalesce(_col(title_without_series), _col(title), F.lit(""))
    return F.lower(F.regexp_replace(F.trim(text), r"[^\p{Alnum}]+", " "))


def has_usable_description(description, minimum: int = 40) -> Column:
    return F.coalesce(F.length(_col(description)) >= minimum, F.lit(False))


def normalize_isbn(value) -> Column:
    """Digits and X only; also removes a spreadsheet ``="..."`` wrapper."""
    return F.regexp_replace(F.upper(F.coalesce(_col(value), F.lit(""))), "[^0-9X]", "")


def long_tokens(normalized, limit: int, minimum: int = 3) -> Column:
    """The first ``limit`` tokens of at least ``minimum`` characters."""
    tokens = F.filter(F.split(_col(normalized), " "), lambda t: F.length(t) >= minimum)
    return F.slice(tokens, 1, limit)


def title_tokens(normalized_title) -> Column:
    return long_tokens(normalized_title, 4)


def author_tokens(normalized_author) -> Column:
    return long_tokens(normalized_author, 2)


def tokenize(text) -> Column:
    """Lower-cased, accent-free word tokens in text order."""
    folded = fold_accents(F.lower(F.coalesce(_col(text), F.lit(""))))
    return F.regexp_extract_all(folded, F.lit(TOKEN_PATTERN), F.lit(0))


def ngrams(tokens, ngram_max: int = 2) -> Column:
    """Unigrams, followed by the bigrams when ``ngram_max`` is 2."""
    if ngram_max not in (1, 2):
        raise ValueError("ngram_max must be 1 or 2")
    tokens = _col(tokens)
    if ngram_max == 1:
        return tokens
    pairs = F.greatest(F.size(tokens) - 1, F.lit(0))
    bigrams = F.zip_with(
        F.slice(tokens, F.lit(1), pairs),
        F.slice(tokens, F.lit(2), pairs),
        lambda a, b: F.concat(a, F.lit(" "), b),
    )
    return F.concat(tokens, bigrams)


def safe_float(value) -> Column:
    number = F.trim(_col(value).cast("string")).try_cast("double")
    return F.when(~F.isnan(number), number)


def safe_int(value) -> Column:
    """Lenient integer: "12.0" and "12.9" give 12, anything unreadable null."""
    return safe_float(value).try_cast("bigint")


def whole_number(value, rounded: bool = True) -> Column:
    """Integer of a text or number, exact over the whole range of bigint; fractions are rounded or cut, the rest is null.

    Integers never pass through a double, and a decimal carries what is no plain integer ("12.7", "1e3").
    """
    text = F.trim(_col(value).cast("string"))
    number = text.try_cast("decimal(38,10)")
    return F.coalesce(text.try_cast("bigint"), (F.round(number) if rounded else number).try_cast("bigint"))


def parse_year(value) -> Column:
    return F.trim(_col(value).cast("string")).try_cast("int")


def lenient_date(value, formats=("yyyy/MM/dd", "yyyy-MM-dd")) -> Column:
    """The first format that reads the text, or else its part before a time ("2020-01-05 10:00:00", "2020-01-05T10:00Z").

    Days and months of one digit, and the month-first form of exports, are read too; null when nothing does.
    """
    text = F.trim(_col(value).cast("string"))
    day = F.regexp_extract(text, r"^(\S+?)(?:[T ]\s*\d{1,2}:\d{2}(?::\d{2}(?:[.,]\d+)?)?\s*(?:Z|[+-]\d{2}:?\d{2}|[AaPp][Mm])?)?$", 1)
    read = [F.to_date(F.try_to_timestamp(day, F.lit(f))) for f in (*formats, "yyyy/M/d", "yyyy-M-d", "M/d/yyyy")]
    return F.coalesce(*read)


def lenient_boolean(value) -> Column:
    """True/true/1 and False/false/0 only; everything else is null."""
    text = _col(value).cast("string")
    return F.when(text.isin("true", "True", "1", "1.0"), True).when(text.isin("false", "False", "0", "0.0"), False)


def json_encode(value) -> Column:
    return F.to_json(_col(value))


def normalized_key(value) -> Column:
    return F.lower(F.trim(F.coalesce(_col(value).cast("string"), F.lit(""))))


def shared_value(left, right) -> Column:
    """Equal after trimming and case folding; blanks never match."""
    left = normalized_key(left)
    return (left != "") & (left == normalized_key(right))


def first_filled(*values) -> Column:
    """First value that is neither null nor empty."""
    return F.coalesce(*(F.when(_col(v) != "", _col(v)) for v in values))
