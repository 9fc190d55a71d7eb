"""Does a predicted answer agree with the gold answer?

The rules are tried from cheap to dear, and the first one that decides wins.
Each rule is a column that is NULL while undecided, so the cascade is one
``coalesce``, which Spark evaluates lazily.

Tuples and sets compare their parts with the same rules.  Column expressions
cannot recurse, so the nesting is written out ``NESTING`` levels deep; answers
with more brackets are taken apart level by level (``functions.nested``).
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.columns import SPACE, deeper_analysis, enclosed, let, unwrap
from answerloom.functions.nested import REMOVABLE, Nested, nested_match
from answerloom.functions.normalization import (
    bare_form,
    bare_is_number,
    bare_to_double,
    simple_form,
    split_commas,
    text_form_of_bare,
)

# Fixed values.
TOLERANCE = 1e-9
LETTER = r"[A-Za-z]"
DIGIT_OR_OPERATOR = r"[\p{Nd}=+\-*/^]"
NESTING = 3
# Where an answer is taken apart: levels of groups below a pair that is decided by its texts, and how deep these are
# looked into (further, since brackets that do not match are not taken apart).
BELOW, BY_TEXTS = 1, 1
# Groups that close with their last bracket and have brackets at most ``NESTING`` deep.
_INNER = r"[^()\[\]{}]*+"
for _ in range(NESTING - 1):
    _INNER = r"(?:[^()\[\]{}]++|[(\[{]" + _INNER + r"[)\]}])*+"
GROUP = rf"\A(?:\({_INNER}\)|\{{{_INNER}\}})\z"

Rule = Callable[[Column, Column], Column]


def simple_match(pred: Column, gold: Column) -> Column:
    """Equality after the simple normalisation."""
    forms = F.transform(F.array(pred, gold), simple_form)
    return let(forms, lambda both: both[0] == both[1])


def is_blank(answer: Column) -> Column:
    return answer.isNull() | ~F.rlike(answer, F.lit(f"(?U)[^{SPACE}]"))


def _bare_parts(bare: Column) -> Column:
    inner = F.substring(bare, F.lit(2), F.char_length(bare) - 2)
    return F.transform(split_commas(inner), bare_form)


def _match_parts(ps: Column, gs: Column, ordered: Column, agrees: Rule) -> Column:
    """Pair every part of ``ps`` with its own agreeing part of ``gs``.

    A set gives each part the first free counterpart that agrees with it.  In a
    tuple the only candidate is the one at the same place, so the same fold
    serves both.
    """

    def take(state: Column, p: Column) -> Column:
        candidates = F.when(ordered, F.array(F.get(gs, state["place"]))).otherwise(state["free"])
        agree = F.transform(candidates, lambda g: agrees(p, g))
        rest = lambda at: F.when(ordered, state["free"]).otherwise(F.filter(state["free"], lambda _, i: i != at - 1))
        return F.when(~state["ok"], state).otherwise(
            let(
                F.array_position(agree, F.lit(True)),
                lambda at: F.struct(rest(at).alias("free"), (at > 0).alias("ok"), (state["place"] + 1).alias("place")),
            )
        )

    return F.aggregate(
        ps,
        F.struct(gs.alias("free"), F.lit(True).alias("ok"), F.lit(0).alias("place")),
        take,
        lambda state: state["ok"],
    )


def _grouped_match(p: Column, g: Column, depth: int, further: Rule | None) -> Column:
    """Tuples and sets with the same number of parts; NULL for anything else."""
    tuples = enclosed(p, "(", ")") & enclosed(g, "(", ")")
    sets = enclosed(p, "{", "}") & enclosed(g, "{", "}")
    return F.when(
        tuples | sets,
        let(
            F.transform(F.array(p, g), _bare_parts),
            lambda parts: F.when(
                (F.size(parts[0]) > 0) & (F.size(parts[0]) == F.size(parts[1])),
                _match_parts(parts[0], parts[1], F.startswith(g, F.lit("(")), partial(bare_match, depth=depth, further=further)),
            ),
        ),
    )


def _words(g: Column) -> Column:
    return F.rlike(g, F.lit(LETTER)) & ~F.rlike(g, F.lit(DIGIT_OR_OPERATOR))


def bare_match(p: Column, g: Column, depth: int = NESTING, further: Rule | None = None) -> Column:
    """The cascade on two answers already in bare form.

    ``further`` may add a rule of its own for what is neither text, group nor
    number; it counts where it gives true.
    """
    words = _words(g)
    both = F.array(p, g)
    rules = [
        F.when(p == g, F.lit(True)),
        F.when(
            words,
            let(F.transform(both, text_form_of_bare), lambda text: text[0] == text[1]),
        ),
        F.when(
            bare_is_number(p) & bare_is_number(g),
            let(
                F.transform(both, bare_to_double),
                lambda value: F.abs(value[0] - value[1]) <= TOLERANCE,
            ),
        ),
        F.when(
            enclosed(p, "(", ")") | enclosed(g, "(", ")"),
            let(
                F.transform(both, lambda x: unwrap(x, "(", ")")),
                lambda core: core[0] == core[1],
            ),
        ),
        F.lit(False),
    ]
    if further:
        rules.insert(3, F.when(further(p, g), F.lit(True)))
    if depth:
        rules.insert(2, _grouped_match(p, g, depth - 1, further))
    return F.coalesce(*rules)


def nested(bare: Column) -> Column:
    """More opening brackets than the written-out nesting could need; may be NULL."""
    return F.rlike(bare, F.lit(rf"(?:[(\[{{][^(\[{{]*+){{{NESTING + 1}}}"))


def level_by_level(further: Rule | None = None) -> Nested:
    """The match for groups that are ``apart_from``; NULL where they cannot be taken apart."""
    below, by_texts = (BELOW, BY_TEXTS) if further is None else (0, 0)
    return nested_match(partial(bare_match, depth=by_texts, further=further), bare_form, LETTER, DIGIT_OR_OPERATOR, below)


def written_out(p: Column, g: Column, further: Rule | None = None) -> Column:
    """The cascade for all other answers; with a further rule, which makes it long, without any nesting."""
    return bare_match(p, g, NESTING if further is None else 0, further)


def apart_from(p: Column, g: Column, further: Rule | None = None) -> Column:
    """Are both answers to be taken apart? The nested ones, and with a further rule all groups; may be NULL."""
    if further is None:
        return nested(p) & nested(g)
    return (enclosed(p, "(", ")") & enclosed(g, "(", ")")) | (enclosed(p, "{", "}") & enclosed(g, "{", "}"))


def undecided(p: Column, g: Column) -> Column:
    """Do two bare texts reach the further rule? False or NULL if not."""
    return (p != g) & ~_words(g) & ~(bare_is_number(p) & bare_is_number(g))


def _is_group(bare: Column) -> Column:
    return F.rlike(bare, F.lit(GROUP))


def _group_parts(group: Column) -> Column:
    return split_commas(F.substring(group, F.lit(2), F.char_length(group) - 2))


def shallow(p: Column, g: Column) -> Column:
    """Are both answers groups of one kind that :func:`shallow_match` decides as ``level_by_level`` does, only sooner? May be NULL."""
    clean = [_is_group(x) & ~F.rlike(x, F.lit(REMOVABLE)) for x in (p, g)]
    return clean[0] & clean[1] & (F.left(p, F.lit(1)) == F.left(g, F.lit(1)))


def shallow_match(p: Column, g: Column, further: Rule, depth: int = NESTING) -> Column:
    """``level_by_level`` with a further rule, written out for groups that are ``shallow``."""
    by_texts = bare_match(p, g, 0, further)
    if not depth:
        return by_texts

    def parts(x: Column) -> Column:
        return F.when(_is_group(x), _group_parts(x))

    def grouped(ps: Column, gs: Column) -> Column:
        """NULL where the texts decide: a long group and something else never agree."""
        alike = (F.left(p, F.lit(1)) == F.left(g, F.lit(1))) & (F.size(ps) == F.size(gs)) & (F.size(ps) > 0)
        matched = _match_parts(ps, gs, F.startswith(g, F.lit("(")), lambda x, y: shallow_match(x, y, further, depth - 1))
        return F.when(ps.isNotNull() & gs.isNotNull() & alike, matched).when(
            (ps.isNotNull() | gs.isNotNull()) & (F.abs(F.octet_length(p) - F.octet_length(g)) > 2), F.lit(False)
        )

    by_parts = let(F.struct(parts(p).alias("p"), parts(g).alias("g")), lambda s: grouped(s["p"], s["g"]))
    return F.coalesce(F.when((p != g) & ~_words(g) & (_is_group(p) | _is_group(g)), by_parts), by_texts)


def shallow_texts(p: Column, g: Column) -> Column:
    """All parts of two ``shallow`` groups, parts of parts too: the texts that :func:`shallow_match` may compare."""

    def inner(texts: Column) -> Column:
        return F.flatten(F.transform(F.filter(texts, _is_group), _group_parts))

    def with_inner(texts: Column, depth: int) -> Column:
        return let(inner(texts), lambda t: F.concat(texts, with_inner(t, depth - 1))) if depth else texts

    return let(F.flatten(F.transform(F.array(p, g), _group_parts)), lambda t: with_inner(t, NESTING - 1))


def answers_match(pred: Column, gold: Column, further: Rule | None = None) -> Column:
    """Robust equivalence as one boolean column; never NULL.

    Spark resolves lambdas within lambdas one by one, and this expression has
    more of them than its limit of passes foresees; the limit is raised.
    :func:`answerloom.operators.grading.with_match` does without.
    """
    deeper_analysis()

    def matched(p: Column, g: Column) -> Column:
        deep = F.when(apart_from(p, g, further), level_by_level(further).at_once(p, g))
        return F.coalesce(deep, written_out(p, g, further))

    both = F.array(bare_form(pred), bare_form(gold))
    return F.when(is_blank(pred) | is_blank(gold), F.lit(False)).otherwise(let(both, lambda b: matched(b[0], b[1])))
