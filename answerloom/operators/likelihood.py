"""Sequence likelihoods over a token table.

Input columns: ``seq_id``, ``pos`` (0-based), ``target`` (token id),
``logits`` (``array<double>``, the distribution that predicted ``target``) and,
where a prompt matters, ``prompt_len``; (``seq_id``, ``pos``) is the key.

Only one number per token reaches a shuffle, combined map-side, so a very long
sequence is as cheap as many short ones.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.functions.tokens import token_entropy, token_entropy_arrow, token_logprob, token_logprob_arrow


def with_token_logprob(tokens: DataFrame, temperature: float = 1.0, arrow: bool = False) -> DataFrame:
    """Add ``logprob`` to every token row, without a shuffle; ``arrow`` for vocabularies of many thousands."""
    form = token_logprob_arrow if arrow else token_logprob
    return tokens.withColumn("logprob", form(F.col("logits"), F.col("target"), temperature))


def with_token_entropy(tokens: DataFrame, arrow: bool = False) -> DataFrame:
    """Add ``entropy`` (nats) to every token row, without a shuffle; ``arrow`` for vocabularies of many thousands."""
    return tokens.withColumn("entropy", (token_entropy_arrow if arrow else token_entropy)(F.col("logits")))


def sequence_logprob(tokens: DataFrame, temperature: float = 1.0) -> DataFrame:
    """Sum over all tokens but the first; 0.0 for a single token."""
    value = F.when(
        F.col("pos") >= 1, token_logprob(F.col("logits"), F.col("target"), temperature)
    )
    return (
        tokens.select("seq_id", value.alias("value"))
        .groupBy("seq_id")
        .agg(F.coalesce(F.sum("value"), F.lit(0.0)).alias("logprob"))
    )


def diagnostics(
    tokens: DataFrame, prefix_len: str = "prompt_len", temperature: float = 1.0
) -> DataFrame:
    """``n_tokens``, ``logprob_sum``, ``logprob_avg`` and ``avg_entropy`` of each sequence's suffix, in one pass.

    The suffix are the tokens at ``pos >= prefix_len``.  The first token has no
    distribution, so it is never part of a sum.  The log-probability divides by
    the suffix length, at least 1; entropy is the mean over the suffix without
    a first token, 0.0 where nothing is left.  Both are local to a token row,
    so the logits are read once and repeated keys count as rows of their own.
    """
    inside = F.col("pos") >= F.col(prefix_len)
    known = inside & (F.col("pos") >= 1)
    logprob = token_logprob(F.col("logits"), F.col("target"), temperature)
    rows = tokens.select(
        "seq_id",
        F.when(known, logprob).alias("value"),
        F.when(known, token_entropy(F.col("logits"))).alias("entropy"),
        F.when(inside, F.lit(1)).alias("inside"),
    )
    return (
        rows.groupBy("seq_id")
        .agg(
            F.coalesce(F.sum("value"), F.lit(0.0)).alias("logprob_sum"),
            F.count("inside").alias("n_tokens"),
            F.coalesce(F.avg("entropy"), F.lit(0.0)).alias("avg_entropy"),
        )
        .withColumn("logprob_avg", F.col("logprob_sum") / F.greatest("n_tokens", F.lit(1)))
    )


def suffix_logprob(
    tokens: DataFrame, prefix_len: str = "prompt_len", temperature: float = 1.0
) -> DataFrame:
    """Sum and per-token mean of ``diagnostics``; what is not asked for is not computed."""
    return diagnostics(tokens, prefix_len, temperature).select(
        "seq_id", "logprob_sum", "n_tokens", "logprob_avg"
    )


def average_entropy(tokens: DataFrame) -> DataFrame:
    """Mean entropy of ``diagnostics``."""
    return diagnostics(tokens).select("seq_id", "avg_entropy")
