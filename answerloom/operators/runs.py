"""Assembling run tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from answerloom.functions.columns import strip

# Fixed values.
CHAIN_METHOD = "power_mh"
MIN_ALPHA = 1e-8


def merge_runs(*runs: DataFrame) -> DataFrame:
    """Union by column name; columns a run does not have become NULL."""
    if not runs:
        raise ValueError("no runs to merge")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), runs)


def method_params(
    df: DataFrame,
    temperature: float = 1.0,
    alpha: float = 4.0,
    block_size: int = 192,
    n_mcmc: int = 10,
) -> DataFrame:
    """Add the sampling parameters that each row's method really used.

    Block size and chain steps are 0 for methods without a chain; everything
    but ``base`` samples at 1/alpha.
    """
    chain = F.col("method") == CHAIN_METHOD
    return df.withColumns(
        {
            "alpha": F.lit(float(alpha)),
            "B": F.when(chain, F.lit(block_size)).otherwise(F.lit(0)),
            "n_mcmc": F.when(chain, F.lit(n_mcmc)).otherwise(F.lit(0)),
            "temperature": F.when(
                F.col("method") == "base", F.lit(float(temperature))
            ).otherwise(F.lit(1.0) / F.greatest(F.lit(float(alpha)), F.lit(MIN_ALPHA))),
        }
    )


def clean_problems(problems: DataFrame, *keep: str) -> DataFrame:
    """Problem text with a trimmed gold answer and an id, '' where missing; ``keep`` names further columns."""
    return problems.select(
        *keep,
        "problem",
        strip(F.coalesce(F.col("answer").cast("string"), F.lit(""))).alias("gold"),
        F.coalesce(F.col("unique_id").cast("string"), F.lit("")).alias("example_id"),
    )


def per_example(graded: DataFrame) -> DataFrame:
    """The six-column record per graded run, with defaults for missing values."""

    def text(name: str) -> Column:
        if name not in graded.columns:
            return F.lit("")
        return F.coalesce(F.col(name).cast("string"), F.lit(""))

    def number(name: str, default: int) -> Column:
        if name not in graded.columns:
            return F.lit(default)
        return F.coalesce(F.col(name).cast("int"), F.lit(default))

    return graded.select(
        text("example_id").alias("example_id"),
        number("seed", -1).alias("seed"),
        text("method").alias("method"),
        number("correct_eval", 0).alias("correct"),
        text("gold").alias("gold"),
        text("pred_eval").alias("pred"),
    )


def run_rows(graded: DataFrame, likelihoods: DataFrame, rates: DataFrame, **params: float) -> DataFrame:
    """One whole run row per generated completion.

    ``graded``: runs with the simple grade and the keys ``seq_id`` and
    ``chain_id``; ``likelihoods``: per ``seq_id`` as ``likelihood.diagnostics``
    gives them; ``rates``: per ``chain_id`` as ``sampler.accept_rate`` does.
    Either has one row per key.  Every completion keeps its row: figures that
    are missing are 0, and so is the rate of a method without a chain.
    """
    rows = method_params(graded, **params)
    found = likelihoods.select(
        F.col("seq_id").alias("_seq"), "n_tokens", "logprob_sum", "logprob_avg", "avg_entropy"
    )
    accepted = rates.select(F.col("chain_id").alias("_chain"), F.col("accept_rate").alias("_rate"))
    joined = rows.join(found, F.col("seq_id") == F.col("_seq"), "left").join(
        accepted, F.col("chain_id") == F.col("_chain"), "left"
    )
    rate = F.when(F.col("method") == CHAIN_METHOD, F.col("_rate"))
    return joined.select(
        *rows.columns,
        F.coalesce(rate, F.lit(0.0)).alias("accept_rate"),
        F.coalesce("n_tokens", F.lit(0)).cast("long").alias("num_tokens_generated"),
        F.coalesce("logprob_sum", F.lit(0.0)).alias("base_loglik_sum"),
        F.coalesce("logprob_avg", F.lit(0.0)).alias("base_loglik_avg"),
        F.coalesce("avg_entropy", F.lit(0.0)).alias("avg_entropy"),
    )


def run_name(num_shards: int) -> Column:
    """``{task}__{model}__{method}__seed{s}__shard{i}of{n}``, '/' in the model as '_'."""
    return F.format_string(
        "%s__%s__%s__seed%d__shard%dof%d",
        "task",
        F.replace(F.col("model"), F.lit("/"), F.lit("_")),
        "method",
        "seed",
        "shard_id",
        F.lit(num_shards),
    )
