"""Joins between pairs and documents: texts, similarity scores and weights."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from echofind.functions.similarity import Measure, cosine_similarity
from echofind.operators.joins import join_lookup
from echofind.operators.tiles import dot_products, in_tiles, texts_in_tiles
from echofind.sources.store import stored

Similarity = Callable[[str, str], Column]


def attach(pairs: DataFrame, docs: DataFrame, columns: list[str], id_col: str = "doc_id") -> DataFrame:
    """Add ``<column>1`` and ``<column>2`` of both documents to ``(id1, id2, ...)``.

    ``docs`` has one row per id. A document that occurs in very many pairs is
    a hot key of the join, which may be split.
    """
    joined = pairs
    for side in ("1", "2"):
        values = docs.select(F.col(id_col).alias(f"id{side}"), *[F.col(c).alias(f"{c}{side}") for c in columns])
        joined = join_lookup(joined, values, [f"id{side}"])
    return joined


def pair_texts(pairs: DataFrame, docs: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """``(id1, id2, text1, text2)`` for every pair; a text is shipped once for each tile of pairs. The pairs are stored first."""
    return texts_in_tiles(pairs, docs.select(F.col(id_col), F.col(text).alias("text")), id_col)


def in_pairs(pairs: DataFrame, docs: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The documents that occur in a pair."""
    ids = pairs.select(F.explode(F.array("id1", "id2")).alias(id_col)).distinct()
    return docs.join(ids, id_col, "left_semi")


def score_products(
    pairs: DataFrame, named: DataFrame, of_products: Callable[[Column, Column, Column], Column], id_col: str = "doc_id"
) -> DataFrame:
    """Add ``similarity`` from dot products of ``named`` (id, names, counts), computed in tiles of pairs."""
    products = in_tiles(pairs, named, dot_products, ("dot", "squared1", "squared2"), id_col)
    value = of_products(F.col("dot"), F.col("squared1"), F.col("squared2"))
    return products.select(*pairs.columns, value.alias("similarity"))


def score_pairs(
    pairs: DataFrame,
    docs: DataFrame,
    similarity: Similarity = cosine_similarity,
    text: str = "text",
    id_col: str = "doc_id",
) -> DataFrame:
    """Add ``similarity`` of the two texts; any function of two columns will do.

    Only documents that occur in a pair leave the corpus scan. A ``Measure`` is
    prepared on them once per document, and what a document contributes is
    shipped once for each tile of pairs; any other function gets both texts with each pair.
    """
    if isinstance(similarity, Measure) and similarity.named is not None:
        # Read twice: for the documents that are needed and for the tiles.
        pairs = stored(pairs)
        named = in_pairs(pairs, docs, id_col).select(id_col, similarity.named(text).alias("_n")).select(id_col, "_n.names", "_n.counts")
        return score_products(pairs, named, similarity.of_products, id_col)
    prepared = isinstance(similarity, Measure)
    value = similarity.prepare(text) if prepared else F.col(text)
    compare = similarity.compare if prepared else similarity
    texts = in_pairs(pairs, docs, id_col).select(id_col, value.alias("_text"))
    scored = attach(pairs, texts, ["_text"], id_col).withColumn("similarity", compare("_text1", "_text2"))
    return scored.select(*pairs.columns, "similarity")


def weigh_pairs(pairs: DataFrame, groups: DataFrame) -> DataFrame:
    """Say how many document pairs stand behind each pair of distinct texts.

    ``groups`` is ``(doc_id, n_copies)``, one row per distinct text. A pair of
    texts stands for n1 * n2 document pairs. A text with n > 1 copies gives one
    more row ``(id, id)`` for its n(n-1)/2 pairs of copies. Output:
    ``(id1, id2, n1, n2, n_pairs)``.
    """
    sizes = groups.select("doc_id", "n_copies")
    between = attach(pairs.select("id1", "id2"), sizes, ["n_copies"]).select(
        "id1",
        "id2",
        F.col("n_copies1").alias("n1"),
        F.col("n_copies2").alias("n2"),
        (F.col("n_copies1") * F.col("n_copies2")).alias("n_pairs"),
    )
    n = F.col("n_copies")
    within = sizes.where("n_copies > 1").select(
        F.col("doc_id").alias("id1"),
        F.col("doc_id").alias("id2"),
        n.alias("n1"),
        (n - 1).alias("n2"),
        F.expr("n_copies * (n_copies - 1) div 2").alias("n_pairs"),
    )
    return between.unionByName(within)
