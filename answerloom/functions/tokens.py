"""Log-probability and entropy of one next-token distribution."""

from __future__ import annotations

import sys

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.columns import let

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

# Fixed value: temperatures are never taken below this.
MIN_TEMPERATURE = 1e-8


def token_logprob(logits: Column, target: Column, temperature: float = 1.0) -> Column:
    """``log_softmax(logits / temperature)[target]``; ``target`` counts from 0."""
    scale = 1.0 / max(temperature, MIN_TEMPERATURE)

    def scaled(difference: Column) -> Column:
        return difference if scale == 1.0 else difference * scale

    def given_top(top: Column) -> Column:
        total = F.aggregate(
            logits, F.lit(0.0), lambda acc, x: acc + F.exp(scaled(x - top))
        )
        return scaled(F.element_at(logits, target + 1) - top) - F.ln(total)

    return let(F.array_max(logits), given_top)


def token_entropy(logits: Column) -> Column:
    """Entropy of ``softmax(logits)`` in nats.

    With e = exp(x - top): ln(sum e) - sum(e * (x - top)) / sum e.
    """

    def given_top(top: Column) -> Column:
        total = F.aggregate(logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - top))
        weighted = F.aggregate(
            logits, F.lit(0.0), lambda acc, x: acc + F.exp(x - top) * (x - top)
        )
        return let(F.array(total, weighted), lambda s: F.ln(s[0]) - s[1] / s[0])

    return let(F.array_max(logits), given_top)


def _rows(logits: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """All logits of a batch in one array, minus the highest of their row; where rows begin, their lengths, and which are whole."""
    whole = np.asarray(logits.is_valid().to_numpy(zero_copy_only=False)) & (logits.value_lengths().fill_null(0).to_numpy(zero_copy_only=False) > 0)
    kept = logits.filter(pa.array(whole)) if not whole.all() else logits
    flat = kept.flatten().to_numpy(zero_copy_only=False)
    length = kept.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    starts = np.cumsum(length) - length
    if len(flat):
        flat = flat - np.repeat(np.maximum.reduceat(flat, starts), length)
    return flat, starts, length, whole


def _spread(values: np.ndarray, whole: np.ndarray) -> pa.Array:
    out = np.full(len(whole), np.nan)
    out[whole] = values
    return pa.array(out, mask=np.isnan(out))


def token_logprob_arrow(logits: Column, target: Column, temperature: float = 1.0) -> Column:
    """``token_logprob`` over the flat values of whole Arrow batches; about twice as fast for wide vocabularies, at the price of a Python worker."""
    scale = 1.0 / max(temperature, MIN_TEMPERATURE)

    @F.arrow_udf("double")
    def run(logits: pa.Array, target: pa.Array) -> pa.Array:
        flat, starts, length, whole = _rows(logits)
        if not len(flat):
            return pa.nulls(len(logits), pa.float64())
        flat = flat * scale
        at = target.cast(pa.int64()).fill_null(-1).to_numpy(zero_copy_only=False)[whole]
        inside = (at >= 0) & (at < length)
        chosen = np.where(inside, flat[starts + np.where(inside, at, 0)], np.nan)
        return _spread(chosen - np.log(np.add.reduceat(np.exp(flat), starts)), whole)

    return run(logits, target)


def token_entropy_arrow(logits: Column) -> Column:
    """``token_entropy`` over the flat values of whole Arrow batches."""

    @F.arrow_udf("double")
    def run(logits: pa.Array) -> pa.Array:
        flat, starts, _, whole = _rows(logits)
        if not len(flat):
            return pa.nulls(len(logits), pa.float64())
        weights = np.exp(flat)
        total = np.add.reduceat(weights, starts)
        return _spread(np.log(total) - np.add.reduceat(weights * flat, starts) / total, whole)

    return run(logits)
