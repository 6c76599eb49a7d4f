"""Near-duplicate text detection as PySpark DataFrame operators."""

from echofind.plans.pipeline import NearDuplicates, Options, find_near_duplicates, inspect_pairs, run_pipeline

__all__ = ["NearDuplicates", "Options", "find_near_duplicates", "inspect_pairs", "run_pipeline"]
