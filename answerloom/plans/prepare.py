"""What a sampler is handed: its shard of the problems, as prompts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from answerloom.functions.prompts import flat_prompt, messages
from answerloom.operators.runs import clean_problems
from answerloom.operators.sharding import take_shard, with_position
from answerloom.sources.problems import FILE_ORDER


def prompts_for_shard(
    problems: DataFrame, shard_id: int, num_shards: int, max_examples: int = 0
) -> DataFrame:
    """Prompts of one shard of the problems.

    Problems from ``read_problems_in_order`` keep the order of their file.  Any
    others are ordered by all of id, gold answer and text, so that missing or
    repeated ids leave only equal rows to chance.
    """
    if set(FILE_ORDER) <= set(problems.columns):
        positioned = with_position(clean_problems(problems, *FILE_ORDER), *FILE_ORDER)
    else:
        positioned = with_position(clean_problems(problems), "example_id", "gold", "problem")
    shard = take_shard(positioned, shard_id, num_shards, max_examples)
    return shard.select(
        "position",
        "example_id",
        "gold",
        messages(F.col("problem")).alias("messages"),
        flat_prompt(F.col("problem")).alias("prompt"),
    )
