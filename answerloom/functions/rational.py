"""Values of expressions over Arrow batches.

The same rule as :mod:`answerloom.functions.identity`, whose folds over stacks
take about a millisecond a pair.  A value belongs to one text alone, so it is
computed once however many others the text is compared with, and all primes are
served at once: a remainder modulo their product stands for one modulo each.
"""

from __future__ import annotations

import re
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.identity import MOST, POINTS, TOKEN

PRIMES = [p for p, _ in POINTS]
PRODUCT = PRIMES[0] * PRIMES[1] * PRIMES[2]
TOKENS = re.compile(TOKEN)
RANK = {"(": 0, "+": 1, "-": 1, "*": 2, "/": 2, "~": 3, "**": 4}
# Python does not read longer numbers at once.
DIGITS = 4000

Value = tuple[int, int, "int | None"]  # over, under, and the value itself while it may be an exponent


@lru_cache(maxsize=10_000)
def _point(symbol: str) -> int:
    return int.from_bytes(blake2b(symbol.encode(), digest_size=24).digest()) % PRODUCT


def _number(token: str) -> Value:
    """A decimal as a fraction over a power of ten."""
    whole, _, places = token.partition(".")
    digits = whole + places
    if len(digits) <= DIGITS:
        n = int(digits) % PRODUCT
    else:
        n = 0
        for part in (digits[k : k + DIGITS] for k in range(0, len(digits), DIGITS)):
            n = (n * pow(10, len(part), PRODUCT) + int(part)) % PRODUCT
    return n, pow(10, len(places), PRODUCT) if places else 1, n if not places and len(digits) <= 4 else None


def _small(k: int) -> int | None:
    return k if -MOST <= k <= MOST else None


def _apply(op: str, values: list[Value]) -> None:
    """Replace the last values by ``op`` of them; fails where they are too few, or the exponent is no whole number in bounds."""
    bn, bd, bk = values.pop()
    if op == "~":
        values.append((-bn, bd, None if bk is None else -bk))
        return
    an, ad, ak = values.pop()
    known = ak is not None and bk is not None
    if op == "+":
        made = ((an * bd + bn * ad) % PRODUCT, ad * bd % PRODUCT, _small(ak + bk) if known else None)
    elif op == "-":
        made = ((an * bd - bn * ad) % PRODUCT, ad * bd % PRODUCT, _small(ak - bk) if known else None)
    elif op == "*":
        made = (an * bn % PRODUCT, ad * bd % PRODUCT, _small(ak * bk) if known else None)
    elif op == "/":
        made = (an * bd % PRODUCT, ad * bn % PRODUCT, None)
    elif op == "**" and bk is not None and -MOST <= bk <= MOST:
        n, d = pow(an, abs(bk), PRODUCT), pow(ad, abs(bk), PRODUCT)
        # From 2 on, the tenth power is beyond any exponent.
        whole = ak is not None and ak >= 0 and (ak < 2 or bk < 10)
        made = (n, d, _small(ak**bk) if whole else None) if bk >= 0 else (d, n, None)
    else:
        raise ValueError(op)
    values.append(made)


def value(text: str) -> list[int | None] | None:
    """The expression's value modulo each prime, at a point of its own; None if it is not well formed.

    Operators wait on a stack until one that binds no tighter comes.  A value
    that has no inverse of its denominator is None for that prime.
    """
    values: list[Value] = []
    ops: list[str] = []
    ends = False  # does a value end here?

    def wait(op: str) -> None:
        # Powers are taken from the right.
        while ops and op != "**" and RANK[ops[-1]] >= RANK[op]:
            _apply(ops.pop(), values)
        ops.append(op)

    try:
        for token in TOKENS.findall(text):
            first = token[0]
            starts = first.isalnum() or first in ".("
            if starts and ends:
                wait("*")  # a product that is not written out
            if first == "(":
                ops.append(token)
            elif first == ")":
                while ops[-1] != "(":
                    _apply(ops.pop(), values)
                ops.pop()
            elif first.isalpha():
                values.append((_point(token), 1, None))
            elif starts:
                values.append(_number(token))
            elif ends or token not in "+-":
                wait(token)
            elif token == "-":
                ops.append("~")  # a sign waits for its value
            ends = (starts and first != "(") or first == ")"
        while ops:
            _apply(ops.pop(), values)
        ((n, d, _),) = values
    except (IndexError, ValueError):
        return None
    try:
        whole = n * pow(d, -1, PRODUCT)
    except ValueError:
        return [n * pow(d, -1, p) % p if d % p else None for p in PRIMES]
    return [whole % p for p in PRIMES]


def expression_values(texts: Column) -> Column:
    """``value`` of each of the ``texts`` (an array of plain expressions or NULLs), in their order; not for use in a lambda."""

    @F.arrow_udf("array<array<bigint>>")
    def run(texts: pa.Array) -> pa.Array:
        found = [None if text is None else value(text) for text in texts.flatten().to_pylist()]
        starts = np.concatenate([[0], np.cumsum(texts.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))])
        return pa.ListArray.from_arrays(pa.array(starts, pa.int32()), pa.array(found, pa.list_(pa.int64())))

    return run(texts)


def same_values(pred: Column, gold: Column) -> Column:
    """Whether two expressions with these values are the same; NULL where that stays undecided, one prime that differs is enough."""
    return F.forall(F.zip_with(pred, gold, lambda a, b: a == b), lambda same: same)
