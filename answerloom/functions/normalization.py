r"""Bringing answers into comparable form."""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.brackets import brace_partners, byte_starts, cut_pieces, rewrite
from answerloom.functions.columns import SPACE, drop, let, nested_braces, running, squeeze, strip, unwrap

# Commands that only wrap text, and the plain-text equivalents
# of LaTeX operators, applied in this order.
TEXT_COMMANDS = ("text", "mathrm", "mathbf")
UNWRAP_ROUNDS = 3
EXPRESSION_FORMS = (
    ("^\\circ", "*pi/180"),
    ("\\cdot", "*"),
    ("\\times", "*"),
    ("\\pi", "pi"),
    ("^", "**"),
    ("{", "("),
    ("}", ")"),
    ("\\!", ""),
)
NUMBER = r"\A[+-]?(?:\p{Nd}+(?:\.\p{Nd}*)?|\.\p{Nd}+)\z"
_DIGITS = r"\p{Nd}+(?:_\p{Nd}+)*"
FLOAT_LITERAL = (
    rf"(?i)\A[+-]?(?:(?:{_DIGITS}(?:\.(?:{_DIGITS})?)?|\.{_DIGITS})(?:e[+-]?{_DIGITS})?"
    r"|inf|infinity|nan)\z"
)
TOP, INNER = "\x01", "\x02"
# Texts of at most so many opening braces are rewritten by patterns that look as deep, commands within commands in so
# many rounds; what goes beyond either is taken to pieces.
FEW_BRACES, COMMAND_ROUNDS = 128, 8
BALANCED = nested_braces(FEW_BRACES)
FRACTION = rf"\\d?frac\{{({BALANCED})\}}\{{({BALANCED})\}}"
# Parts between commas of texts of at most so many opening brackets; one that is never closed keeps all that follows.
FEW_BRACKETS = 64
INSIDE = r"[^()\[\]{}]*+"
for _ in range(FEW_BRACKETS):
    INSIDE = r"(?:[^()\[\]{}]++|[(\[{]" + INSIDE + r"[)\]}])*+"
PART = rf"(?:[^,(\[{{]++|[(\[{{]{INSIDE}[)\]}}]|[(\[{{](?s:.*+))++"
ROOT = rf"\\sqrt\{{({BALANCED})\}}"


def simple_form(answer: Column) -> Column:
    r"""Simple normalisation.

    One trailing ``}`` is dropped whatever it closes, and so is one outer pair
    of parentheses; both sides of a comparison lose them alike.
    """
    text = drop(strip(answer), "$", "\\left", "\\right", "\\,", "\\ ")
    text = F.regexp_replace(squeeze(text), r"\A\\boxed\{|\}\z", "")
    return unwrap(text, "(", ")")


def bare_form(answer: Column) -> Column:
    r"""Remove ``$``, sizing commands, text wrappers and all white space.

    Most answers hold none of these and are returned as they are.  Wrappers
    are taken off in rounds, and only on the rare rows that have one.
    """
    removable = F.rlike(answer, F.lit(rf"(?U)[$\\{SPACE}]"))
    plain = drop(strip(answer), "$", "\\left", "\\right")

    # The second branch puts an unclosed wrapper back as it is, together with all
    # that follows: nothing behind it can be closed, so nothing is searched twice.
    def one_round(text: Column, _: Column) -> Column:
        for command in TEXT_COMMANDS:
            opened = rf"\\{command}\{{"
            pattern = rf"{opened}([^}}]*+)\}}|({opened}[^}}]*+\z)"
            text = F.regexp_replace(text, pattern, "$1$2")
        return text

    unwrapped = F.aggregate(F.sequence(F.lit(1), F.lit(UNWRAP_ROUNDS)), plain, one_round)
    has_wrapper = F.contains(answer, F.lit("{")) & F.rlike(
        plain, F.lit(rf"\\(?:{'|'.join(TEXT_COMMANDS)})\{{")
    )
    text = F.when(has_wrapper, unwrapped).otherwise(plain)
    return F.when(removable, squeeze(drop(text, "\\,", "\\ "))).otherwise(answer)


def text_form_of_bare(bare: Column) -> Column:
    return F.lower(unwrap(bare, "{", "}"))


def text_form(answer: Column) -> Column:
    """Bare form without one outer pair of braces, in lower case."""
    return text_form_of_bare(bare_form(answer))


def bare_is_number(bare: Column) -> Column:
    return F.rlike(bare, F.lit(NUMBER))


def is_number(answer: Column) -> Column:
    """Is the bare form a plain decimal number (no exponent, no separators)?"""
    return bare_is_number(bare_form(answer))


def _digit_map() -> tuple[str, str]:
    """All decimal digits outside ASCII and their ASCII counterparts."""
    digits = [
        chr(point)
        for point in range(128, sys.maxunicode + 1)
        if unicodedata.category(chr(point)) == "Nd"
    ]
    return "".join(digits), "".join(str(unicodedata.digit(d)) for d in digits)


_OTHER_DIGITS, _ASCII_DIGITS = _digit_map()


def bare_to_double(bare: Column) -> Column:
    ascii_only = F.when(
        F.rlike(bare, F.lit(r"[^\x00-\x7f]")),
        F.translate(bare, _OTHER_DIGITS, _ASCII_DIGITS),
    ).otherwise(bare)
    return F.when(
        F.rlike(bare, F.lit(FLOAT_LITERAL)), drop(ascii_only, "_").try_cast("double")
    )


def to_double(answer: Column) -> Column:
    """Bare form as a double; NULL when it is no floating-point literal."""
    return bare_to_double(bare_form(answer))


def _depth_change(piece: Column) -> Column:
    """(fall, change) of the bracket depth over ``piece``: the lowest point below its start, and the end.

    Closing brackets never take the depth below 0, so the depth behind it is
    ``max(depth + change, change - fall)``.
    """
    brackets = F.regexp_extract_all(piece, F.lit(r"[(\[{)\]}]"), F.lit(0))

    def step(state: Column, bracket: Column) -> Column:
        after = state["change"] + F.when(bracket.isin("(", "[", "{"), 1).otherwise(-1)
        return F.struct(
            F.least(state["fall"], after).alias("fall"), after.alias("change")
        )

    return F.aggregate(brackets, F.struct(F.lit(0).alias("fall"), F.lit(0).alias("change")), step)


def _split_nested(text: Column) -> Column:
    """Cut at the commas before which the depth is 0.

    Only depths are carried along the pieces.  Every comma is then put back with
    a mark behind it, ``TOP`` or ``INNER``, and the text is cut at the former;
    pieces hold no comma, so a comma's mark is never mistaken.  The work stays
    in proportion to the text.
    """

    def cut(pieces: Column) -> Column:
        def after(depth: Column, change: Column) -> Column:
            return F.greatest(depth + change["change"], change["change"] - change["fall"])

        depths = running(F.transform(pieces, _depth_change), F.lit(0), after, "int")
        marked = F.zip_with(
            pieces,
            depths,
            lambda piece, depth: F.concat(F.when(depth == 0, f",{TOP}").otherwise(f",{INNER}"), piece),
        )
        parts = F.split(F.array_join(marked, ""), f",{TOP}")  # nothing stands before the first mark
        return F.transform(F.slice(parts, F.lit(2), F.size(parts)), lambda part: F.replace(part, F.lit(f",{INNER}"), F.lit(",")))

    return let(F.split(text, ","), cut)


def split_commas(text: Column) -> Column:
    """Split at commas outside any bracket, trim, drop empty parts.

    The bracket kinds are not matched against each other.  Text without a
    bracket takes the plain split, one with few brackets a pattern that looks
    as deep; folding over the brackets of the others is far dearer.
    """
    many = F.rlike(text, F.lit(rf"\A(?:[^(\[{{]*+[(\[{{]){{{FEW_BRACKETS + 1}}}"))
    parts = (
        F.when(many, _split_nested(text))
        .when(F.rlike(text, F.lit(r"[(\[{]")), F.regexp_extract_all(text, F.lit(PART), F.lit(0)))
        .otherwise(F.split(text, ","))
    )
    return F.filter(F.transform(parts, strip), lambda part: part != "")


def expression_form(answer: Column) -> Column:
    r"""LaTeX to plain expression text.

    Braces become parentheses before fractions and roots could be rewritten,
    so those stay as ``\frac(a)(b)`` and ``\sqrt(a)``; use
    :func:`fractions_inline` and :func:`roots_inline` on the raw answer.
    """
    return expression_form_of_bare(bare_form(answer))


def expression_form_of_bare(text: Column) -> Column:
    for latex, plain in EXPRESSION_FORMS:
        text = F.replace(text, F.lit(latex), F.lit(plain))
    return text


def _with_braces(text: Column, command: str, by_pattern: Callable[[Column], Column], edits: Callable[[Column], Column]) -> Column:
    """``text`` edited by ``by_pattern``, or by what ``edits`` makes of its pieces; as it is where it has no ``command`` with a brace.

    Pieces cost a hundred times as much as patterns, so only texts of many braces, and those that ``by_pattern``
    leaves NULL, are cut.  A pattern may look through the rest of a text from each brace, hence the bound.  ``edits`` gets a struct: ``pieces``, ``starts`` (bytes) and ``braces``, as
    :func:`brace_partners` gives them.
    """

    def edited(pieces: Column) -> Column:
        return let(
            F.struct(pieces.alias("pieces"), byte_starts(pieces).alias("starts"), brace_partners(pieces).alias("braces")),
            lambda t: rewrite(text, edits(t)),
        )

    few = ~F.rlike(text, F.lit(rf"\A(?:[^{{]*+\{{){{{FEW_BRACES + 1}}}"))
    changed = F.coalesce(F.when(few, by_pattern(text)), let(cut_pieces(text, "{}"), edited))
    return F.when(F.contains(text, F.lit(command + "{")), changed).otherwise(text)


def _outside_in(text: Column, command: str, pattern: str, new: str) -> Column:
    """``text`` with each match of ``pattern`` made ``new``, and then those within them; NULL if rounds run out."""

    def one_round(state: Column, _: Column) -> Column:
        return F.when(F.contains(state, F.lit(command + "{")), F.regexp_replace(state, pattern, new)).otherwise(state)

    rewritten = F.aggregate(F.sequence(F.lit(1), F.lit(COMMAND_ROUNDS)), text, one_round)
    return let(rewritten, lambda t: F.when(~F.rlike(t, F.lit(pattern)), t))


def _braces_after(t: Column, pattern: str) -> Column:
    """Places of the opening braces right behind ``pattern``."""
    behind = lambda piece, i: (piece == "{") & F.rlike(F.get(t["pieces"], i - 1), F.lit(pattern))
    places = F.transform(t["pieces"], lambda piece, i: F.when((i > 0) & behind(piece, i), i))
    return F.filter(places, lambda i: i.isNotNull())


def _partner(t: Column, place: Column) -> Column:
    """The place of the brace that closes the one that opens at ``place``; NULL if none does, or if no brace opens there."""
    return F.when(F.get(t["pieces"], place) == "{", F.get(t["braces"]["close"], F.get(t["braces"]["no"], place)))


def _edit(start: Column, stop: Column, new: str) -> Column:
    return F.struct(start.alias("start"), stop.alias("stop"), F.lit(new).alias("new"))


def fractions_inline(text: Column, nested: bool = False) -> Column:
    r"""``\frac{a}{b}`` and ``\dfrac{a}{b}`` to ``((a))/((b))``, whatever their depth; outermost only, or ``nested`` ones too."""

    def outermost(all_of_them: Column) -> Column:
        """Those that begin behind the end of the last one taken."""
        behind = lambda end, f: f["open"] - 1 > end
        ends = running(all_of_them, F.lit(-2), lambda end, f: F.when(behind(end, f), f["under"]).otherwise(end), "int")
        return let(ends, lambda e: F.filter(all_of_them, lambda f, i: behind(F.get(e, i), f)))

    def edits(t: Column) -> Column:
        over_under = F.filter(
            F.transform(
                _braces_after(t, r"\\d?frac\z"),
                lambda i: let(
                    _partner(t, i),
                    lambda close: F.struct(i.alias("open"), close.alias("over"), _partner(t, close + 1).alias("under")),
                ),
            ),
            lambda f: f["under"].isNotNull(),
        )

        def three(f: Column) -> Column:
            open_, over, under = (F.get(t["starts"], f[name]) for name in ("open", "over", "under"))
            command = F.when(F.endswith(F.get(t["pieces"], f["open"] - 1), F.lit("\\dfrac")), 6).otherwise(5)
            return F.array(_edit(open_ - command, open_ + 1, "(("), _edit(over, over + 2, "))/(("), _edit(under, under + 1, "))"))

        if nested:
            return F.array_sort(F.flatten(F.transform(over_under, three)))
        return F.flatten(F.transform(let(over_under, outermost), three))

    new = "(($1))/(($2))"
    by_pattern = (lambda t: _outside_in(t, "frac", FRACTION, new)) if nested else (lambda t: F.regexp_replace(t, FRACTION, new))
    return _with_braces(text, "frac", by_pattern, edits)


def roots_inline(text: Column) -> Column:
    r"""``\sqrt{a}`` to ``sqrt((a))``, nested ones too, up to the first unclosed."""

    def edits(t: Column) -> Column:
        def closed(places: Column) -> Column:
            """Those before the first that is not closed."""
            return let(
                F.array_position(F.transform(places, lambda i: _partner(t, i).isNull()), F.lit(True)),
                lambda unclosed: F.filter(places, lambda _, k: (unclosed == 0) | (k < unclosed - 1)),
            )

        def two(i: Column) -> Column:
            open_, close = F.get(t["starts"], i), F.get(t["starts"], _partner(t, i))
            return F.array(_edit(open_ - 5, open_ + 1, "sqrt(("), _edit(close, close + 1, "))"))

        return F.array_sort(F.flatten(F.transform(let(_braces_after(t, r"\\sqrt\z"), closed), two)))

    def by_pattern(t: Column) -> Column:
        # Up to the first unclosed; no root before that one reaches beyond it.
        head = F.regexp_extract(t, rf"\A((?:[^\\]++|\\(?!sqrt\{{)|\\sqrt\{{(?={BALANCED}\}}))*+)", 1)
        tail = lambda h: F.substring(t, F.char_length(h) + 1, F.char_length(t))
        return let(head, lambda h: F.concat(_outside_in(h, "\\sqrt", ROOT, "sqrt(($1))"), tail(h)))

    return _with_braces(text, "\\sqrt", by_pattern, edits)
