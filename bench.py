"""Headline queries at one scale; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from echofind.plans.queries import QUERIES

HEADLINE = (
    "clean_text",
    "ngram_set",
    "token_frequency",
    "tfidf_token_weights",
    "minhash_signature",
    "simhash_signature",
    "simhash_weighted",
    "minhash_candidate_pairs",
    "minhash_query",
    "simhash_candidate_pairs",
    "bitsampling_candidate_pairs",
    "hybrid_weighted",
    "cosine_similarity",
    "near_duplicate_rate",
    "exact_similar_pairs",
    "find_near_duplicates",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("echofind-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).selectExpr("sum(id)").collect()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
            }
        )
    )


if __name__ == "__main__":
    main()
