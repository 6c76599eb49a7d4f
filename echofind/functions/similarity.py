"""Similarity of two text columns or two array columns. All are narrow."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from echofind.functions.features import token_frequency, token_set
from echofind.functions.text import as_column, bind


def count_vector(text: Column | str) -> Column:
    """Word counts of a text and their squared norm, as one struct."""
    return bind(
        token_frequency(text),
        lambda counts: F.struct(
            counts.alias("counts"),
            F.aggregate(counts, F.lit(0).cast("bigint"), lambda acc, c: acc + c["tf"] * c["tf"]).alias("squared"),
        ),
    )


def _dot(left: Column, right: Column) -> Column:
    """Dot product of two count arrays.

    Each token occurs at most once per side, so after sorting both sides
    together the only equal neighbours are the shared tokens.
    """
    return bind(
        F.sort_array(F.concat(left, right)),
        lambda both: F.when(F.size(both) < 2, F.lit(0).cast("bigint")).otherwise(
            F.aggregate(
                F.sequence(F.lit(1), F.size(both) - 1),
                F.lit(0).cast("bigint"),
                lambda acc, i: acc
                + F.when(
                    F.get(both, i)["token"] == F.get(both, i - 1)["token"],
                    F.get(both, i)["tf"] * F.get(both, i - 1)["tf"],
                ).otherwise(F.lit(0).cast("bigint")),
            )
        ),
    )


def cosine_of_vectors(left: Column | str, right: Column | str) -> Column:
    """Cosine of two ``count_vector`` structs; 0.0 when one has no words."""

    def score(a: Column, b: Column) -> Column:
        norms = F.sqrt(a["squared"].cast("double")) * F.sqrt(b["squared"].cast("double"))
        return F.when((a["squared"] == 0) | (b["squared"] == 0), F.lit(0.0)).otherwise(
            _dot(a["counts"], b["counts"]) / norms
        )

    return _bound(left, right, score)


def euclidean_of_vectors(left: Column | str, right: Column | str) -> Column:
    """1 / (1 + Euclidean distance) of two ``count_vector`` structs."""

    def score(a: Column, b: Column) -> Column:
        distance = a["squared"] + b["squared"] - F.lit(2).cast("bigint") * _dot(a["counts"], b["counts"])
        return F.lit(1.0) / (F.lit(1.0) + F.sqrt(distance.cast("double")))

    return _bound(left, right, score)


def _bound(left: Column | str, right: Column | str, body: Callable[[Column, Column], Column]) -> Column:
    return bind(as_column(left), lambda a: bind(as_column(right), lambda b: body(a, b)))


def jaccard_sets(left: Column | str, right: Column | str, empty: float = 1.0) -> Column:
    """Shared over all distinct elements; ``empty`` when neither side has any."""
    a, b = as_column(left), as_column(right)
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, F.lit(empty)).otherwise(F.size(F.array_intersect(a, b)) / union.cast("double"))


def _token_sets_jaccard(left: Column | str, right: Column | str) -> Column:
    return jaccard_sets(left, right, empty=0.0)


def element_names(elements: Column) -> Column:
    """64-bit names of an array of strings, for counting inside tiles of pairs."""
    return F.transform(elements, lambda e: F.xxhash64(e))


def _named_counts(text: Column | str) -> Column:
    counts = token_frequency(text)
    return bind(counts, lambda c: F.struct(element_names(c["token"]).alias("names"), c["tf"].alias("counts")))


def _named_set(text: Column | str) -> Column:
    return F.struct(element_names(token_set(text)).alias("names"), F.lit(None).cast("array<bigint>").alias("counts"))


def cosine_of_products(dot: Column, squared1: Column, squared2: Column) -> Column:
    norms = F.sqrt(squared1.cast("double")) * F.sqrt(squared2.cast("double"))
    return F.when((squared1 == 0) | (squared2 == 0), F.lit(0.0)).otherwise(dot / norms)


def euclidean_of_products(dot: Column, squared1: Column, squared2: Column) -> Column:
    distance = squared1 + squared2 - F.lit(2).cast("bigint") * dot
    return F.lit(1.0) / (F.lit(1.0) + F.sqrt(distance.cast("double")))


def jaccard_of_products(dot: Column, squared1: Column, squared2: Column, empty: float = 0.0) -> Column:
    """Of sets the dot product is what they share and the squares are their sizes."""
    union = squared1 + squared2 - dot
    return F.when(union == 0, F.lit(empty)).otherwise(dot / union.cast("double"))


@dataclass(frozen=True)
class Measure:
    """A similarity of texts split in two, so that the first part runs once per document.

    ``prepare`` turns a text column into what ``compare`` takes. Calling the
    measure compares two text columns directly. ``named`` turns it into names and counts
    instead, and ``of_products`` takes the dot product and the two squared norms
    that a tile of pairs yields.
    """

    prepare: Callable[[Column | str], Column]
    compare: Callable[[Column | str, Column | str], Column]
    named: Callable[[Column | str], Column] | None = None
    of_products: Callable[[Column, Column, Column], Column] | None = None

    def __call__(self, left: Column | str, right: Column | str) -> Column:
        return self.compare(self.prepare(left), self.prepare(right))


# Cosine of the two word-count vectors; 0.0 when a text has no words.
cosine_similarity = Measure(count_vector, cosine_of_vectors, _named_counts, cosine_of_products)
# 1 / (1 + Euclidean distance of the word-count vectors).
euclidean_similarity = Measure(count_vector, euclidean_of_vectors, _named_counts, euclidean_of_products)
# Jaccard similarity of the distinct words; two empty texts give 0.0.
jaccard_text = Measure(token_set, _token_sets_jaccard, _named_set, jaccard_of_products)
