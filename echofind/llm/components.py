"""Connected components of a link table, by alternating large-star and small-star steps.

Links stay a table; each step writes its result to the shared folder, so plans stay
short. A node with very many links is one group with partial aggregation and a join
that Spark can split.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from echofind.llm.common import written


def _state(links: DataFrame) -> tuple[int, int]:
    row = links.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first()
    return row[0], row[1]


def components(links: DataFrame, most_steps: int = 60) -> DataFrame:
    """(node, label) of every node in ``links`` (a, b): the label is the least node reachable."""
    # Links point from the larger to the smaller node.
    pairs = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct()
    pairs = written(pairs)
    state = _state(pairs)
    for _ in range(most_steps):
        if not state[0]:
            break
        # Large star: every larger neighbour of u goes to the least of u and its neighbours.
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        # Small star: u and its smaller neighbours go to the least of them.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b")))
        pairs = written(small.filter("a <> b").distinct())
        now = _state(pairs)
        if now == state:
            break
        state = now
    else:
        raise RuntimeError("the links have not settled")
    roots = pairs.select(F.col("b").alias("node"), F.col("b").alias("label")).distinct()
    return pairs.select(F.col("a").alias("node"), F.col("b").alias("label")).unionByName(roots)
