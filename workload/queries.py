"""One query per operator of the inventory, over whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions import extraction, normalization, prompts
from answerloom.functions.columns import let
from answerloom.functions.equivalence import answers_match
from answerloom.operators import grading, likelihood, memo, metrics, passk, sampler, sharding
from answerloom.operators import runs as run_tables
from answerloom.plans.pass_at_k import pass_at_k_report
from workload.standins import expressions, mh_blind, mh_steps, pairs, runs, solutions, tokens

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RUN_KEYS = ("method", "seed", "example_id", "gold")
MAX_K = 8
NUM_SHARDS, SHARD_ID, SHARD_HEAD = 7, 3, 20
TEMPERATURE = 0.25


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def rounded(column: Column | str) -> Column:
    return F.round(column, 9)


def graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grading.grade_runs(runs(spark, sf_dir))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


# --- extraction -----------------------------------------------------------


def _extracted(df: DataFrame, keys: tuple[str, ...], extract) -> DataFrame:
    return df.select(*keys, extract(F.col("completion")).alias("answer"))


@query
def extract_boxed_simple(spark, sf_dir):
    return _extracted(runs(spark, sf_dir), RUN_KEYS, extraction.simple_box)


@query
def extract_simple(spark, sf_dir):
    return _extracted(runs(spark, sf_dir), RUN_KEYS, extraction.simple_answer)


@query
def extract_boxed_balanced(spark, sf_dir):
    return _extracted(runs(spark, sf_dir), RUN_KEYS, extraction.last_box)


@query
def extract_robust(spark, sf_dir):
    return _extracted(runs(spark, sf_dir), RUN_KEYS, extraction.robust_answer)


@query
def extract_boxed_simple_documents(spark, sf_dir):
    return _extracted(solutions(spark, sf_dir), ("doc_id",), extraction.simple_box)


@query
def extract_simple_documents(spark, sf_dir):
    return _extracted(solutions(spark, sf_dir), ("doc_id",), extraction.simple_answer)


@query
def extract_boxed_balanced_documents(spark, sf_dir):
    return _extracted(solutions(spark, sf_dir), ("doc_id",), extraction.last_box)


@query
def extract_robust_documents(spark, sf_dir):
    return _extracted(solutions(spark, sf_dir), ("doc_id",), extraction.robust_answer)


# --- normalisation --------------------------------------------------------


def _both_sides(spark, sf_dir, normalize, name: str) -> DataFrame:
    return pairs(spark, sf_dir).select(
        "pair_id",
        normalize(F.col("pred")).alias(f"pred_{name}"),
        normalize(F.col("gold")).alias(f"gold_{name}"),
    )


@query
def normalize_simple(spark, sf_dir):
    return _both_sides(spark, sf_dir, normalization.simple_form, "simple")


@query
def strip_wrappers(spark, sf_dir):
    return _both_sides(spark, sf_dir, normalization.bare_form, "bare")


@query
def normalize_text(spark, sf_dir):
    return _both_sides(spark, sf_dir, normalization.text_form, "text")


@query
def latex_to_expr(spark, sf_dir):
    return _both_sides(spark, sf_dir, normalization.expression_form, "expr")


@query
def number_like(spark, sf_dir):
    def side(name: str) -> list[Column]:
        return [
            normalization.is_number(F.col(name)).alias(f"{name}_is_number"),
            normalization.to_double(F.col(name)).alias(f"{name}_value"),
        ]

    return pairs(spark, sf_dir).select("pair_id", *side("pred"), *side("gold"))


@query
def split_commas(spark, sf_dir):
    """Parts of every gold answer and of every document, one row per part."""
    inner = F.regexp_replace(normalization.bare_form(F.col("gold")), r"\A[({](.*)[)}]\z", "$1")
    golds = pairs(spark, sf_dir).select(
        F.lit("gold").alias("source"), F.col("pair_id").alias("id"), inner.alias("text")
    )
    texts = documents(spark, sf_dir).select(
        F.lit("document").alias("source"), F.col("doc_id").alias("id"), "text"
    )
    return (
        golds.unionByName(texts)
        .select("source", "id", F.posexplode(normalization.split_commas(F.col("text"))))
        .select("source", "id", F.col("pos").alias("part_no"), F.col("col").alias("part"))
    )


def _latex_sum(spark, sf_dir) -> DataFrame:
    """Run completions joined with a nested, an unclosed and, where no seed is known, a very deep command."""
    gold = F.coalesce("gold", F.lit(""))
    deep = F.concat(F.repeat(F.lit("{"), F.lit(50)), gold, F.repeat(F.lit("}"), F.lit(50)))
    deeper = F.concat(F.lit("\\dfrac{"), deep, F.lit("}{7}+\\sqrt{"), deep, F.lit("}"))
    text = F.concat_ws(
        "+", F.when(F.col("seed").isNull(), deeper), "completion", F.concat(F.lit("\\dfrac{{"), gold, F.lit("}}{\\sqrt{2}}")),
        F.concat(F.lit("\\sqrt{x+\\sqrt{"), gold, F.lit("}}")),
        F.when(F.col("seed") == 1, F.lit("\\sqrt{open \\sqrt{3} \\frac{4}")),
    )
    return runs(spark, sf_dir).select(*RUN_KEYS, text.alias("text"))


@query
def replace_frac(spark, sf_dir):
    return _latex_sum(spark, sf_dir).select(
        *RUN_KEYS, normalization.fractions_inline(F.col("text")).alias("expr")
    )


@query
def replace_sqrt(spark, sf_dir):
    return _latex_sum(spark, sf_dir).select(
        *RUN_KEYS, normalization.roots_inline(F.col("text")).alias("expr")
    )


# --- grading --------------------------------------------------------------


@query
def grade_simple(spark, sf_dir):
    return grading.grade_runs_simple(runs(spark, sf_dir)).select(
        *RUN_KEYS, "pred", "correct"
    )


@query
def grade_equiv(spark, sf_dir):
    return grading.with_match(pairs(spark, sf_dir), "pred", "gold", "correct").select(
        "pair_id", "pred", "gold", "correct"
    )


@query
def grade_equiv_column(spark, sf_dir):
    """The same cascade as a single column expression."""
    return pairs(spark, sf_dir).select(
        "pair_id", answers_match(F.col("pred"), F.col("gold")).alias("matches")
    )


@query
def grade_runs(spark, sf_dir):
    return graded(spark, sf_dir).select(*RUN_KEYS, "pred_eval", "correct_eval")


@query
def grade_dedup(spark, sf_dir):
    return grading.grade_runs_once_per_pair(runs(spark, sf_dir)).select(
        *RUN_KEYS, "pred_eval", "correct_eval"
    )


@query
def grade_dedup_counts(spark, sf_dir):
    return grading.correct_counts_once_per_pair(runs(spark, sf_dir), "method", "seed")


@query
def grade_identity(spark, sf_dir):
    """Grades that also know when two expressions are one rational function."""
    return grading.with_match(expressions(spark, sf_dir), "pred", "gold", "correct", identities=True).select(
        "pair_id", "pred", "gold", "correct"
    )


@query
def grade_memo(spark, sf_dir):
    """Two evaluations with one memo: the second one grades only the pairs that the first did not have."""
    path = f"{sharding.shared_folder(spark)}/grades-{uuid.uuid4().hex}"
    table = runs(spark, sf_dir)
    memo.grade_runs_with_memo(table.filter("method = 'base'"), path, "first")
    return memo.grade_runs_with_memo(table, path, "second").select(*RUN_KEYS, "pred_eval", "correct_eval")


# --- accuracy -------------------------------------------------------------


@query
def accuracy_overall(spark, sf_dir):
    return metrics.accuracy_overall(graded(spark, sf_dir)).select(
        "n", rounded("accuracy").alias("accuracy")
    )


@query
def accuracy_by_method(spark, sf_dir):
    return metrics.accuracy_by(graded(spark, sf_dir), "method").select(
        "method", "n", rounded("accuracy").alias("accuracy")
    )


@query
def accuracy_by_seed(spark, sf_dir):
    return metrics.accuracy_by(graded(spark, sf_dir), "seed").select(
        F.col("seed").cast("string").alias("seed"), "n", rounded("accuracy").alias("accuracy")
    )


@query
def accuracy_cube(spark, sf_dir):
    return metrics.accuracy_cube(graded(spark, sf_dir)).select(
        "level", "key", "n", rounded("accuracy").alias("accuracy")
    )


@query
def scores_summary(spark, sf_dir):
    """The report, with its maps as sorted text (in billionths), which either engine writes alike."""

    def text(name: str) -> Column:
        entries = F.array_sort(F.map_entries(name))
        parts = F.transform(
            entries, lambda e: F.concat_ws("=", e["key"], F.round(e["value"] * 1e9).cast("long").cast("string"))
        )
        return F.array_join(parts, ",").alias(name)

    return metrics.scores_summary(graded(spark, sf_dir)).select(
        "n", rounded("accuracy").alias("accuracy"), text("accuracy_by_method"), text("accuracy_by_seed")
    )


@query
def distinct_examples(spark, sf_dir):
    return metrics.distinct_examples(runs(spark, sf_dir))


@query
def method_series(spark, sf_dir):
    """With a label that no run has, which must come out as 0."""
    labels = (*metrics.METHODS, "not_run")
    return metrics.method_series(graded(spark, sf_dir), labels).select(
        "position", "method", rounded("accuracy_pct").alias("accuracy_pct")
    )


@query
def sweep_accuracy(spark, sf_dir):
    return metrics.sweep_accuracy(graded(spark, sf_dir)).select(
        "n_mcmc", "n", rounded("accuracy_pct").alias("accuracy_pct")
    )


@query
def per_example(spark, sf_dir):
    return run_tables.per_example(graded(spark, sf_dir))


# --- pass@k ---------------------------------------------------------------


@query
def outcome_counts(spark, sf_dir):
    return passk.outcome_counts(graded(spark, sf_dir))


@query
def pass_at_k_per_example(spark, sf_dir):
    counts = passk.outcome_counts(graded(spark, sf_dir))
    return passk.pass_at_k_per_example(counts, MAX_K).withColumn(
        "pass_at_k", rounded("pass_at_k")
    )


@query
def pass_at_k_curve(spark, sf_dir):
    return pass_at_k_report(graded(spark, sf_dir), MAX_K).withColumn(
        "pass_at_k", rounded("pass_at_k")
    )


@query
def pass_at_k_grid(spark, sf_dir):
    """Out to a k that no example reaches, where the value is NULL."""
    counts = passk.outcome_counts(graded(spark, sf_dir))
    return passk.pass_at_k_grid(counts, 40).withColumn("pass_at_k", rounded("pass_at_k"))


@query
def pass_at_k_orders(spark, sf_dir):
    """Many samples per example: customers as examples, filled orders as correct."""
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet").select(
        F.col("o_orderpriority").alias("method"),
        F.col("o_custkey").cast("string").alias("example_id"),
        (F.col("o_orderstatus") == "F").cast("int").alias("correct_eval"),
    )
    return pass_at_k_report(orders, MAX_K).withColumn("pass_at_k", rounded("pass_at_k"))


# --- run tables, prompts, shards -------------------------------------------


@query
def merge_runs(spark, sf_dir):
    """Runs with different columns: only chains have ``n_mcmc``, base and runs without a method have no gold."""
    table = runs(spark, sf_dir)

    def of(method: str | None) -> DataFrame:
        return table.filter(F.col("method").eqNullSafe(F.lit(method)))

    return run_tables.merge_runs(
        of("base").select("method", "example_id", "seed", "completion"),
        of("lowtemp").select("seed", "method", "gold", "completion", "example_id"),
        of("power_mh").select("n_mcmc", "method", "seed", "example_id", "gold", "completion"),
        of(None).select("completion", "seed", "example_id"),
    )


@query
def run_params(spark, sf_dir):
    table = runs(spark, sf_dir).drop("n_mcmc")
    return run_tables.method_params(table).select(
        "method", "seed", "example_id", "alpha", "B", "n_mcmc", "temperature"
    )


@query
def run_rows(spark, sf_dir):
    """Solutions as completions; token sequences and sampler chains stand in for their diagnostics."""
    table = solutions(spark, sf_dir).select(
        "doc_id", "completion", "gold",
        F.element_at(F.array(*map(F.lit, metrics.METHODS)), (F.col("doc_id") % 3 + 1).cast("int")).alias("method"),
        F.col("doc_id").alias("seq_id"), F.col("doc_id").alias("chain_id"),
    )
    rows = run_tables.run_rows(
        grading.grade_runs_simple(table),
        likelihood.diagnostics(tokens(spark, sf_dir), temperature=TEMPERATURE),
        sampler.accept_rate(mh_steps(spark, sf_dir)),
    )
    figures = ("accept_rate", "base_loglik_sum", "base_loglik_avg", "avg_entropy")
    return rows.select(
        "doc_id", "method", "alpha", "B", "n_mcmc", "temperature", "pred", "correct", "num_tokens_generated",
        *(rounded(c).alias(c) for c in figures),
    )


@query
def prompt_messages(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", F.posexplode(prompts.messages(F.col("text")))
    ).select(
        "doc_id",
        F.col("pos").alias("position"),
        F.col("col.role").alias("role"),
        F.col("col.content").alias("content"),
    )


@query
def prompt_flat(spark, sf_dir):
    return documents(spark, sf_dir).select(
        "doc_id", prompts.flat_prompt(F.col("text")).alias("prompt")
    )


@query
def prompt_transcript(spark, sf_dir):
    """Every conversation turn posed as a problem and rendered as a chat."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    chat = prompts.messages(F.col("text"))
    return turns.select(
        "conv_id", "turn",
        let(chat, lambda m: prompts.transcript(m, "<|", "|>\n", "\n")).alias("prompt"),
    )


@query
def shard_mod(spark, sf_dir):
    positioned = sharding.with_position(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return sharding.take_shard(positioned, SHARD_ID, NUM_SHARDS)


@query
def shard_head(spark, sf_dir):
    positioned = sharding.with_position(documents(spark, sf_dir).select("doc_id", "text"), "doc_id")
    return sharding.take_shard(positioned, SHARD_ID, NUM_SHARDS, SHARD_HEAD)


@query
def shard_mod_file_order(spark, sf_dir):
    """Shards by position in the file itself, without a sort."""
    positioned = sharding.with_file_position(
        spark, f"{sf_dir}/documents.parquet", columns=["doc_id", "text"]
    )
    return sharding.take_shard(positioned, SHARD_ID, NUM_SHARDS)


# --- token likelihoods -----------------------------------------------------


@query
def token_logprob(spark, sf_dir):
    return likelihood.with_token_logprob(tokens(spark, sf_dir), TEMPERATURE).select(
        "seq_id", "pos", rounded("logprob").alias("logprob")
    )


@query
def token_entropy(spark, sf_dir):
    return likelihood.with_token_entropy(tokens(spark, sf_dir)).select(
        "seq_id", "pos", rounded("entropy").alias("entropy")
    )


@query
def seq_logprob(spark, sf_dir):
    return likelihood.sequence_logprob(tokens(spark, sf_dir)).select(
        "seq_id", rounded("logprob").alias("logprob")
    )


@query
def suffix_logprob(spark, sf_dir):
    return likelihood.suffix_logprob(tokens(spark, sf_dir), temperature=TEMPERATURE).select(
        "seq_id",
        "n_tokens",
        rounded("logprob_sum").alias("logprob_sum"),
        rounded("logprob_avg").alias("logprob_avg"),
    )


@query
def avg_entropy(spark, sf_dir):
    return likelihood.average_entropy(tokens(spark, sf_dir)).select(
        "seq_id", rounded("avg_entropy").alias("avg_entropy")
    )


# --- sampler log -----------------------------------------------------------


@query
def block_schedule(spark, sf_dir):
    lengths = documents(spark, sf_dir).select("doc_id", F.col("n_chars").alias("length"))
    return sampler.block_schedule(lengths, 192).select(
        "doc_id", "length", "block", "block_end"
    )


@query
def mh_log_accept(spark, sf_dir):
    return sampler.with_acceptance(mh_steps(spark, sf_dir)).select(
        "chain_id", "block", "step", rounded("log_accept").alias("log_accept"), "accepted"
    )


@query
def accept_rate(spark, sf_dir):
    return sampler.accept_rate(mh_steps(spark, sf_dir)).select(
        "chain_id", "n_steps", "n_accepted", rounded("accept_rate").alias("accept_rate")
    )


@query
def mh_state_carry(spark, sf_dir):
    """Short segments, so that the state really crosses segment borders."""
    return sampler.carried_state(mh_steps(spark, sf_dir), segment_rows=40).select(
        "chain_id",
        "block",
        "step",
        rounded("expected_logp").alias("expected_logp"),
        "consistent",
    )


@query
def mh_replay(spark, sf_dir):
    """A log that claims other states than its own proposals and draws lead to; short segments again."""
    return sampler.replay(mh_blind(spark, sf_dir), segment_rows=40).select(
        "chain_id", "block", "step", rounded("replay_logp").alias("replay_logp"), "replay_accepted"
    )
