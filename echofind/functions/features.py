"""Feature expressions over a text column. All of them are narrow: no shuffle."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from echofind.functions.text import WORD_CHARS, as_column, bind, ngrams, words

# Fixed value: the vectorizer's token rule, two or more word characters.
VECTOR_TOKEN = f"[{WORD_CHARS}]{{2,}}"
# The lookahead passes over the usual characters without asking for their Unicode category.
NO_WORD_CHARS = f"(?![a-z0-9_ ])[^{WORD_CHARS}]+"
FREQUENCY_TYPE = "array<struct<token:string,tf:bigint>>"


def ngram_set(text: Column | str, n: int = 3) -> Column:
    """Distinct word n-grams."""
    return F.array_distinct(ngrams(words(text), n))


def token_set(text: Column | str) -> Column:
    """Distinct words."""
    return F.array_distinct(words(text))


def vector_tokens(text: Column | str) -> Column:
    """Lower-cased runs of two or more word characters, repeats kept."""
    return F.regexp_extract_all(F.lower(as_column(text)), F.lit(VECTOR_TOKEN), F.lit(0))


def spaced_vector_tokens(text: Column | str) -> Column:
    """The text with a plain space for every run of characters that no ``vector_tokens`` have.

    What is left between spaces are those tokens, and single characters.
    """
    return F.regexp_replace(F.lower(as_column(text)), NO_WORD_CHARS, " ")


def count_elements(tokens: Column) -> Column:
    """Count equal elements of an array: ``array<struct<token, tf>>`` ordered by token.

    The array is sorted, the last position of each run is found, and a count
    is the distance between neighbouring run ends. The work stays inside the
    row, so counting needs no shuffle on (document, token).
    """

    def run_ends(s: Column) -> Column:
        return F.filter(
            F.sequence(F.lit(0), F.size(s) - 1),
            lambda i: (i == F.size(s) - 1) | (F.get(s, i) != F.get(s, i + 1)),
        )

    def counted(s: Column) -> Column:
        return bind(
            run_ends(s),
            lambda ends: F.transform(
                ends,
                lambda end, k: F.struct(
                    F.get(s, end).alias("token"),
                    (end - F.coalesce(F.get(ends, k - 1), F.lit(-1))).cast("bigint").alias("tf"),
                ),
            ),
        )

    return bind(
        F.sort_array(tokens),
        lambda s: F.when(s.isNull(), F.lit(None).cast(FREQUENCY_TYPE))
        .when(F.size(s) > 0, counted(s))
        .otherwise(F.array().cast(FREQUENCY_TYPE)),
    )


def token_frequency(text: Column | str) -> Column:
    """Word counts of a text as ``array<struct<token, tf>>``."""
    return count_elements(words(text))


def token_frequency_map(text: Column | str) -> Column:
    """Word counts of a text as ``map<string,bigint>``."""
    return F.map_from_entries(token_frequency(text))
