"""pass@k curves per method from a graded run table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from answerloom.operators.passk import outcome_counts, pass_at_k_curve

# Fixed value: the curve's default length.
MAX_K = 8


def pass_at_k_report(graded: DataFrame, max_k: int = MAX_K) -> DataFrame:
    """``method, k, examples, pass_at_k`` for k = 1..max_k."""
    return pass_at_k_curve(outcome_counts(graded), max_k)
