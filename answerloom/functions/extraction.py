r"""Finding the final answer inside a completion.

Two families are kept, because they grade differently:

* the *simple* one looks for ``\boxed{...}`` up to the first closing brace;
* the *robust* one balances braces and also knows ``\fbox{...}``.

Both fall back to an "answer:" line, then a "####" line, then the last line
that is not blank.  All of them read the whole text, once per pattern.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.columns import SPACE, first_group, last_line, let, strip

# The answer markers.
BOX = "\\boxed{"
FRAMED_BOX = "\\fbox{"
ANSWER_LINE = rf"(?iuU)answer[{SPACE}]*[:\-][{SPACE}]*([^\n]+)"
HASH_LINE = rf"(?U)####[{SPACE}]*([^\n]+)"


def answer_line(text: Column) -> Column:
    """Text behind the first ``answer:`` / ``answer -`` marker; NULL if none."""
    return strip(first_group(text, ANSWER_LINE))


def hash_line(text: Column) -> Column:
    """Text behind the first ``####`` marker; NULL if none."""
    return strip(first_group(text, HASH_LINE))


def simple_box(text: Column) -> Column:
    r"""Content of the last ``\boxed{...}``, cut at its first closing brace.

    A box that is never closed is matched too, up to the end of the text, and
    dropped afterwards: otherwise every one of a long run of open boxes would
    be followed to the end in vain.
    """
    boxes = F.regexp_extract_all(text, F.lit(r"\\boxed\{[^}]*+(?:\}|\z)"), F.lit(0))
    closed = F.filter(boxes, lambda box: F.endswith(box, F.lit("}")))

    def content(box: Column) -> Column:
        return strip(F.substring(box, len(BOX) + 1, F.char_length(box) - len(BOX) - 1))

    return F.when(
        F.contains(text, F.lit(BOX)), let(F.try_element_at(closed, F.lit(-1)), content)
    )


def simple_answer(text: Column) -> Column:
    """Simple extraction.  An empty box counts as an (empty) answer."""
    return F.coalesce(
        simple_box(text), answer_line(text), hash_line(text), last_line(text), F.lit("")
    )


def closed_group(tail: Column) -> Column:
    """Content up to the brace that closes a group opened just before ``tail``.

    NULL when the group is never closed.  Works on the pieces between closing
    braces: each piece adds its opening braces and takes one away, and the
    group ends with the piece that brings the depth to zero.  Only the number
    of that piece is carried, so the text itself is cut once, at the end.  The
    last piece has no brace behind it; one more opening brace in front of the
    end keeps it from closing anything.
    """
    pieces = F.split(F.concat(tail, F.lit("{")), r"\}")

    def step(state: Column, piece: Column) -> Column:
        opened = F.octet_length(piece) - F.octet_length(
            F.replace(piece, F.lit("{"), F.lit(""))
        )
        return F.when(state["depth"] == 0, state).otherwise(
            F.struct(
                (state["depth"] + opened - 1).alias("depth"),
                (state["seen"] + 1).alias("seen"),
            )
        )

    closing = F.aggregate(
        pieces,
        F.struct(F.lit(1).alias("depth"), F.lit(0).alias("seen")),
        step,
        lambda state: F.when(state["depth"] == 0, state["seen"]),
    )
    return F.call_function("substring_index", tail, F.lit("}"), closing)


def last_box(text: Column) -> Column:
    r"""Balanced content of the rightmost ``\boxed{`` or ``\fbox{``, trimmed.

    NULL when there is no box or when that last one is not closed; earlier
    complete boxes are deliberately not tried.
    """
    # Cutting behind the last \boxed{ first leaves an \fbox{ only if it is later.
    tail = F.substring_index(F.substring_index(text, BOX, -1), FRAMED_BOX, -1)
    return let(
        tail,
        lambda t: F.when(
            F.octet_length(t) < F.octet_length(text), strip(closed_group(t))
        ),
    )


def robust_answer(text: Column) -> Column:
    """Robust extraction.  A blank or unclosed box falls through."""
    box = let(last_box(text), lambda b: F.when(b != "", b))
    return F.coalesce(
        box, answer_line(text), hash_line(text), last_line(text), F.lit("")
    )
