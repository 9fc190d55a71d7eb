"""Prompts as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prompt texts.
SYSTEM_TEXT = "You are a helpful assistant."
TASK_TEXT = (
    "Solve the following math problem. "
    "Please reason step by step, and put your final answer within \\boxed{}.\n\n"
    "Problem:\n"
)


def _message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def messages(problem: Column) -> Column:
    """System and user message as ``array<struct<role, content>>``."""
    return F.array(
        _message("system", F.lit(SYSTEM_TEXT)),
        _message("user", F.concat(F.lit(TASK_TEXT), problem)),
    )


def flat_prompt(problem: Column) -> Column:
    """The same prompt as one text, for models without a chat template."""
    return F.concat(F.lit(SYSTEM_TEXT + "\n" + TASK_TEXT), problem, F.lit("\n"))


def transcript(
    chat: Column, opening: str = "", between: str = ": ", closing: str = "\n"
) -> Column:
    """Render a message list with fixed text around each role and content.

    Stands in for a tokenizer's chat template, whose text is the model's own.
    """
    lines = F.transform(
        chat,
        lambda m: F.concat(
            F.lit(opening), m["role"], F.lit(between), m["content"], F.lit(closing)
        ),
    )
    return F.array_join(lines, "")
