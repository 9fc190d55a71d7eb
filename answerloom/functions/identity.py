r"""Are two expressions the same rational function?

``\frac{1}{2}`` and ``0.5``, or ``(x+1)^2`` and ``x^2+2x+1``, agree as
expressions though not as texts.  Both are evaluated at fixed points modulo large
primes, as fractions: different polynomials of degree d agree at a point modulo
p with a chance of d / p, so agreement at all points settles it.  Numbers,
symbols, ``+ - * / ^`` with whole exponents, brackets, fractions and implicit
multiplication are understood; whatever else occurs leaves the pair undecided.

Here all of it is one column expression.  :mod:`answerloom.functions.rational`
computes values over Arrow batches, for tables of any size.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.columns import let
from answerloom.functions.normalization import bare_form, expression_form_of_bare, fractions_inline

# Primes below 2^31, so that a product of two remainders is a BIGINT, and the seeds of the points.
POINTS = ((2147483647, 1), (2147483629, 2), (2147483587, 3))
#: Larger exponents, and longer answers, are left undecided.
MOST, LONGEST = 1000, 10_000

TOKEN = r"\*\*|[0-9]+(?:\.[0-9]*)?|\.[0-9]+|[A-Za-z]+|[-+*/()]"
VALUE = "struct<n:bigint,d:bigint,k:int>"


def plain_expression(bare: Column) -> Column:
    """A bare answer as numbers, symbols, operators and brackets; NULL if anything else occurs."""
    text = F.regexp_replace(expression_form_of_bare(fractions_inline(bare, nested=True)), r"\\div(?![A-Za-z])", "/")

    def looks_known(t: Column) -> Column:
        return F.rlike(t, F.lit(rf"\A(?:{TOKEN})+\z")) & ~F.rlike(t, F.lit(r"\.[0-9]*\."))

    return F.when(F.length(bare) <= LONGEST, let(text, lambda t: F.when(looks_known(t), t)))


def expression_tokens(bare: Column) -> Column:
    """The tokens of :func:`plain_expression`, ``~`` for a sign.

    A product that is not written out gets its ``*``.
    """

    def spelled(raw: Column) -> Column:
        def one(token: Column, i: Column) -> Column:
            before = F.get(raw, i - 1)
            starts = F.rlike(token, F.lit(r"\A[0-9.A-Za-z(]"))
            ends = F.rlike(before, F.lit(r"[0-9.A-Za-z)]\z"))
            signs = token.isin("-", "+") & ((i == 0) | ~ends)
            return (
                F.when(signs & (token == "-"), F.array(F.lit("~"))).when(signs, F.array().cast("array<string>"))
                .when((i > 0) & starts & ends, F.array(F.lit("*"), token)).otherwise(F.array(token))
            )

        return F.flatten(F.transform(raw, one))

    return let(
        plain_expression(bare), lambda t: F.when(t.isNotNull(), let(F.regexp_extract_all(t, F.lit(f"({TOKEN})"), F.lit(1)), spelled))
    )


def _times(a: Column, b: Column, p: Column) -> Column:
    return (a * b) % p


def _power(base: Column, k: Column, p: Column) -> Column:
    """``base`` to the power of 0 <= k <= ``MOST``, bit by bit from the top."""
    bits = F.array(*(F.lit(1 << b) for b in reversed(range(MOST.bit_length()))))
    return F.aggregate(
        bits,
        F.lit(1).cast("bigint"),
        lambda acc, bit: let(
            _times(acc, acc, p), lambda sq: F.when(k.bitwiseAND(bit) > 0, _times(sq, base, p)).otherwise(sq)
        ),
    )


def _number(token: Column, p: Column) -> Column:
    """A decimal as a fraction over a power of ten; long ones digit by digit."""
    whole = F.regexp_replace(token, r"\.", "")
    places = F.when(F.contains(token, F.lit(".")), F.length(token) - F.instr(token, ".")).otherwise(0)
    digits = F.regexp_extract_all(whole, F.lit("[0-9]"), F.lit(0))
    remainder = F.aggregate(digits, F.lit(0).cast("bigint"), lambda acc, d: (acc * 10 + d.cast("bigint")) % p)
    tens = F.aggregate(F.sequence(F.lit(0), places), F.lit(1).cast("bigint"), lambda acc, i: F.when(i == 0, acc).otherwise((acc * 10) % p))
    small = F.when((places == 0) & (F.length(whole) <= 4), whole.cast("int"))
    return _value(remainder, tens, small)


def _value(n: Column, d: Column, k: Column) -> Column:
    return F.struct(n.cast("bigint").alias("n"), d.cast("bigint").alias("d"), k.cast("int").alias("k"))


def _applied(op: Column, a: Column, b: Column, p: Column) -> Column:
    """``a op b``; a sign has only ``b``.  NULL where the exponent is no whole number in bounds."""
    none = F.lit(None).cast("int")

    def small(k: Column) -> Column:
        """A whole number while it may still be an exponent."""
        return F.when(F.abs(k) <= MOST, k.cast("int"))

    whole = F.when((a["k"] >= 0) & (b["k"] >= 0), F.pow(a["k"], b["k"]))
    raised = let(
        F.abs(b["k"]),
        lambda k: F.when(
            k <= MOST,
            let(
                F.struct(_power(a["n"], k, p).alias("n"), _power(a["d"], k, p).alias("d")),
                lambda v: F.when(b["k"] >= 0, _value(v["n"], v["d"], small(whole))).otherwise(_value(v["d"], v["n"], none)),
            ),
        ),
    )

    def sum_of(sign: int) -> Column:
        n = _times(a["n"], b["d"], p) + sign * _times(b["n"], a["d"], p) + p
        return _value(n % p, _times(a["d"], b["d"], p), small(a["k"] + sign * b["k"]))

    return (
        F.when(op == "~", _value((p - b["n"]) % p, b["d"], -b["k"]))
        .when(op == "+", sum_of(1)).when(op == "-", sum_of(-1))
        .when(op == "*", _value(_times(a["n"], b["n"], p), _times(a["d"], b["d"], p), small(a["k"] * b["k"])))
        .when(op == "/", _value(_times(a["n"], b["d"], p), _times(a["d"], b["n"], p), none))
        .when(op == "**", raised)
    )


def _rank(op: Column) -> Column:
    return F.when(op.isin("+", "-"), 1).when(op.isin("*", "/"), 2).when(op == "~", 3).when(op == "**", 4).otherwise(0)


def evaluated(tokens: Column, p: Column, seed: Column) -> Column:
    """The expression's value modulo ``p`` at the point ``seed`` as (n, d); NULL if it is not well formed.

    Operators wait on a stack, the last one first, until one that binds no
    tighter comes; what then leaves the stack is applied to the values.
    """
    empty_values = F.array().cast(f"array<{VALUE}>")
    empty_ops = F.array().cast("array<string>")

    def state(values: Column, ops: Column, ok: Column) -> Column:
        return F.struct(values.alias("values"), ops.alias("ops"), ok.alias("ok"))

    def reduced(s: Column, count: Column) -> Column:
        """Apply the first ``count`` operators of the stack."""

        def apply(acc: Column, op: Column) -> Column:
            takes = F.when(op == "~", 1).otherwise(2)
            enough = acc["ok"] & (F.size(acc["values"]) >= takes) & (op != "(")
            made = F.when(enough, _applied(op, F.get(acc["values"], F.lit(1)), F.get(acc["values"], F.lit(0)), p))
            return let(
                made,
                lambda v: F.struct(
                    F.when(v.isNotNull(), F.concat(F.array(v), F.slice(acc["values"], takes + 1, F.greatest(F.size(acc["values"]), F.lit(1)))))
                    .otherwise(acc["values"]).alias("values"),
                    (acc["ok"] & v.isNotNull()).alias("ok"),
                ),
            )

        return let(
            F.aggregate(F.slice(s["ops"], F.lit(1), count), F.struct(s["values"].alias("values"), s["ok"].alias("ok")), apply),
            lambda r: state(r["values"], F.slice(s["ops"], count + 1, F.greatest(F.size(s["ops"]), F.lit(1))), r["ok"]),
        )

    def waiting(s: Column, holds: Column) -> Column:
        """How many operators stand before the first that ``holds`` marks; all if there is none."""
        return let(F.array_position(holds, F.lit(True)).cast("int"), lambda at: F.when(at > 0, at - 1).otherwise(F.size(s["ops"])))

    def operator(s: Column, token: Column) -> Column:
        rank = _rank(token)
        # A sign waits for its value; powers are taken from the right.
        looser = F.transform(s["ops"], lambda op: (_rank(op) < rank) | ((token == "**") & (_rank(op) == rank)) | (op == "("))
        count = F.when(token == "~", 0).otherwise(waiting(s, looser))
        return let(count, lambda c: let(reduced(s, c), lambda r: state(r["values"], F.concat(F.array(token), r["ops"]), r["ok"])))

    def closing(s: Column) -> Column:
        opens = F.transform(s["ops"], lambda op: op == "(")
        return let(
            waiting(s, opens),
            lambda c: let(
                reduced(s, c),
                lambda r: state(r["values"], F.slice(r["ops"], F.lit(2), F.greatest(F.size(r["ops"]), F.lit(1))), r["ok"] & (F.size(r["ops"]) > 0)),
            ),
        )

    def step(s: Column, token: Column) -> Column:
        symbol = F.pmod(F.xxhash64(token, seed), p)
        read = (
            F.when(F.rlike(token, F.lit(r"\A[0-9.]")), _number(token, p))
            .when(F.rlike(token, F.lit(r"\A[A-Za-z]")), _value(symbol, F.lit(1), F.lit(None)))
        )
        moved = let(
            read,
            lambda v: F.when(v.isNotNull(), state(F.concat(F.array(v), s["values"]), s["ops"], s["ok"]))
            .when(token == "(", state(s["values"], F.concat(F.array(token), s["ops"]), s["ok"]))
            .when(token == ")", closing(s))
            .otherwise(operator(s, token)),
        )
        return F.when(s["ok"], moved).otherwise(s)

    def finished(s: Column) -> Column:
        return let(
            reduced(s, F.size(s["ops"])), lambda r: F.when(r["ok"] & (F.size(r["values"]) == 1), F.get(r["values"], F.lit(0)))
        )

    return F.aggregate(tokens, state(empty_values, empty_ops, F.lit(True)), step, finished)


def same_expression(pred: Column, gold: Column) -> Column:
    """Whether two answers are the same rational function; NULL where that stays undecided."""
    return same_bare_expression(bare_form(pred), bare_form(gold))


def same_bare_expression(pred: Column, gold: Column) -> Column:
    """``same_expression`` of answers in bare form."""

    points = F.array(*(F.struct(F.lit(p).cast("bigint").alias("p"), F.lit(seed).alias("seed")) for p, seed in POINTS))

    def agree(point: Column, t: Column) -> Column:
        def equal(v: Column) -> Column:
            a, b, p = F.get(v, F.lit(0)), F.get(v, F.lit(1)), point["p"]
            return F.when((a["d"] != 0) & (b["d"] != 0), _times(a["n"], b["d"], p) == _times(b["n"], a["d"], p))

        return let(F.transform(t, lambda tokens: evaluated(tokens, point["p"], point["seed"])), equal)

    def compared(t: Column) -> Column:
        both = F.get(t, F.lit(0)).isNotNull() & F.get(t, F.lit(1)).isNotNull()
        return F.when(both, F.forall(points, lambda point: agree(point, t)))  # one point that differs is enough

    return let(F.transform(F.array(pred, gold), expression_tokens), compared)
