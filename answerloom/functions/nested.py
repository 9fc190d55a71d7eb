"""Agreement of answers nested to any depth, without recursion.

Both answers are taken apart once.  Pairs of parts that have to agree are then
collected level by level from the outside in, and decided level by level from
the inside out, so the work is that of the pairs, not of depth times length.  A
tuple pairs its parts by place.  A set pairs each part with each, and every part
takes the first free counterpart that agrees.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.brackets import HIGH, byte_starts, cut_bytes, cut_pieces, high, low, sequence_of
from answerloom.functions.columns import SPACE, enclosed, let, running, scan

PAIR = "struct<x:int,y:int,mode:int,n:int,first:int>"
# What becomes of a pair: decided by its texts, tuples, sets, not equal.
TEXTS, TUPLES, SETS, DIFFERENT = range(4)
REMOVABLE = rf"(?U)[${SPACE}]|\\(?:left|right|,| |(?:text|mathrm|mathbf)\{{)"


def settled(bare: Column, bare_form: Callable[[Column], Column], rounds: int = 8) -> Column:
    """``bare`` until nothing removable is left in it; most answers are like that as they come.

    Parts of such a text are in bare form themselves.
    """
    left = F.rlike(bare, F.lit(REMOVABLE))
    again = F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), bare, lambda text, _: bare_form(text))
    return F.when(left, again).otherwise(bare)


def taken_apart(text: Column, letter: str, figure: str) -> Column:
    """One answer as a struct, or NULL if it does not begin and end with brackets of one kind.

    ``whole`` the text in bytes, ``starts`` where its pieces begin, ``counts``
    the letters and figures before each piece, ``groups`` (first part, parts,
    piece that closes it, -1 if none does) in the order of opening, ``parts``
    (first and last piece, number of the group it is or -1, opening bracket)
    level by level, the last of them the whole answer, ``depth``.

    As in splitting at commas, brackets within the outermost ones are not told
    apart, one that closes nothing changes no depth, and one that is never
    closed keeps what follows inside.
    """

    def depth(state: Column, piece: Column) -> Column:
        """Opened so far in the high half, depth in the low one; the first bracket counts as opened and stands at depth 0."""
        closes = F.when(low(state) > 0, state - 1).otherwise(state)
        return F.when(piece.isin("(", "[", "{"), state + HIGH + 1).when(piece.isin(")", "]", "}"), closes).otherwise(state)

    def count(state: Column, piece: Column) -> Column:
        return state + F.when(F.rlike(piece, F.lit(letter)), HIGH).otherwise(0) + F.rlike(piece, F.lit(figure)).cast("int")

    def marked(p: Column, states: Column) -> Column:
        """(level, place, kind, number) of each bracket and comma that counts; kinds: 0 opens, 1 divides, 2 closes."""

        def made(level: Column | int, at: Column, kind: int, no: Column | int) -> Column:
            level, no = (x if isinstance(x, Column) else F.lit(x) for x in (level, no))
            return F.struct(level.alias("level"), at.alias("at"), F.lit(kind).alias("kind"), no.alias("no"))

        def mark(piece: Column, i: Column) -> Column:
            level, no = low(F.get(states, i)), high(F.get(states, i))
            return (
                F.when(i == 0, made(0, i, 0, 0)).when(i == F.size(p) - 1, made(0, i, 2, 0))
                .when(piece.isin("(", "[", "{"), made(level + 1, i, 0, no)).when(piece == ",", made(level, i, 1, no))
                .when(piece.isin(")", "]", "}") & (level > 0), made(level, i, 2, no))
            )

        return F.array_sort(F.filter(F.transform(p, mark), lambda m: m.isNotNull()))

    def built(p: Column, states: Column, marks: Column) -> Column:
        # A part lies between two marks of one group; empty ones do not count.
        filled = F.transform(
            marks, lambda m, i: F.coalesce((m["kind"] != 2) & (F.get(marks, i + 1)["at"] > m["at"] + 1), F.lit(False))
        )
        before = running(F.transform(filled, lambda f: f.cast("int")), F.lit(0), lambda at, one: at + one, "int")
        return let(F.struct(filled.alias("filled"), before.alias("before")), lambda f: finished(p, states, marks, f))

    def finished(p: Column, states: Column, marks: Column, f: Column) -> Column:
        total = F.element_at(f["before"], -1)  # no part begins at the last mark
        opened = F.filter(
            F.transform(marks, lambda m, i: F.struct(m["no"].alias("no"), i.alias("pos"), m["kind"].alias("kind"))), lambda m: m["kind"] == 0
        )

        def group(o: Column, m: Column, i: Column) -> Column:
            span = F.struct(F.get(f["before"], m["pos"]).alias("first"), F.coalesce(F.get(o, i + 1)["pos"], F.size(marks)).alias("end"))
            return let(
                span,
                lambda s: F.struct(
                    m["no"].alias("no"), s["first"].alias("first"),
                    (F.coalesce(F.get(f["before"], s["end"]), total) - s["first"]).alias("n"),
                    F.when(F.get(marks, s["end"] - 1)["kind"] == 2, F.get(marks, s["end"] - 1)["at"]).otherwise(-1).alias("close"),
                ),
            )

        groups = let(opened, lambda o: F.transform(o, lambda m, i: group(o, m, i)))
        spans = F.transform(
            F.filter(sequence_of(F.lit(0), F.size(marks)), lambda i: F.get(f["filled"], i)),
            lambda i: F.struct((F.get(marks, i)["at"] + 1).alias("a"), (F.get(marks, i + 1)["at"] - 1).alias("b")),
        )
        whole = F.struct(F.lit(0).alias("a"), (F.size(p) - 1).alias("b"), F.lit(0).alias("group"), F.get(p, F.lit(0)).alias("opens"))
        return let(
            F.array_sort(groups),
            lambda gs: F.struct(
                gs.alias("groups"), F.concat(F.transform(spans, lambda s: part(p, states, gs, s)), F.array(whole)).alias("parts")
            ),
        )

    def part(p: Column, states: Column, groups: Column, span: Column) -> Column:
        opens, closes = F.get(p, span["a"]), F.get(p, span["b"])
        no = high(F.get(states, span["a"]))
        enclosed = ((opens == "(") & (closes == ")")) | ((opens == "{") & (closes == "}"))
        group = F.when(enclosed & (F.get(groups, no)["close"] == span["b"]), no).otherwise(-1)
        return F.struct(span["a"].alias("a"), span["b"].alias("b"), group.alias("group"), opens.alias("opens"))

    def with_marks(p: Column, states: Column) -> Column:
        return let(
            marked(p, states),
            lambda marks: let(
                built(p, states, marks),
                lambda t: F.struct(
                    F.encode(text, "UTF-8").alias("whole"),
                    F.concat(byte_starts(p), F.array(F.octet_length(text))).alias("starts"),
                    running(F.concat(p, F.array(F.lit(""))), F.lit(0), count, "bigint").alias("counts"),
                    t["groups"].alias("groups"),
                    t["parts"].alias("parts"),
                    F.element_at(marks, -1)["level"].alias("depth"),
                ),
            ),
        )

    def pieces(p: Column) -> Column:
        inner = F.concat(F.array(F.lit("")), F.slice(p, F.lit(2), F.size(p)))  # the first bracket does not add to the depth
        return let(running(inner, F.lit(HIGH), depth, "bigint"), lambda states: with_marks(p, states))

    grouped = enclosed(text, "(", ")") | enclosed(text, "{", "}")
    return F.when(grouped & (F.length(text) > 1), let(cut_pieces(text, r"(\[{,)\]}"), pieces))


def _text(t: Column, part: Column) -> Column:
    return cut_bytes(t["whole"], F.get(t["starts"], part["a"]), F.get(t["starts"], part["b"] + 1))


def _bytes(t: Column, part: Column) -> Column:
    return F.get(t["starts"], part["b"] + 1) - F.get(t["starts"], part["a"])


def _group(t: Column, part: Column) -> Column:
    """first, n of the part's group; NULL if it is none."""
    return F.when(part["group"] >= 0, F.get(t["groups"], part["group"]))


def _tall(t: Column, part: Column, levels: int) -> Column:
    """Are there groups ``levels`` below this part?"""
    if levels == 0:
        return part["group"] >= 0
    return let(
        _group(t, part),
        lambda g: g.isNotNull()
        & F.exists(sequence_of(g["first"], g["n"]), lambda c: let(F.get(t["parts"], c), lambda child: _tall(t, child, levels - 1))),
    )


def _classified(p: Column, g: Column, x: Column, y: Column, levels: int) -> Column:
    """(x, y, mode, n): what becomes of a pair of parts, and into how many pairs it falls."""

    def decide(xp: Column, yp: Column, xg: Column, yg: Column) -> Column:
        letters, figures = (lambda t, part, half=half: half(F.get(t["counts"], part["b"] + 1) - F.get(t["counts"], part["a"])) for half in (high, low))
        words = (letters(g, yp) > 0) & (figures(g, yp) == 0)
        alike = xg.isNotNull() & yg.isNotNull() & (xp["opens"] == yp["opens"]) & (xg["n"] == yg["n"]) & (xg["n"] > 0)
        falls = alike & ~words & _tall(p, xp, levels) & _tall(g, yp, levels)
        # A long group against something else: words need no figure opposite, other texts at most a pair of brackets more.
        different = (xg.isNotNull() | yg.isNotNull()) & ~alike & F.when(words, figures(p, xp) > 0).otherwise(
            F.abs(_bytes(p, xp) - _bytes(g, yp)) > 2
        )
        mode = (
            F.when(falls & (yp["opens"] == "("), TUPLES)
            .when(falls & (_text(p, xp) != _text(g, yp)), SETS)
            .when(different, DIFFERENT).otherwise(TEXTS)
        )
        return let(
            mode,
            lambda m: F.struct(
                x.alias("x"), y.alias("y"), m.alias("mode"),
                F.when(m == TUPLES, xg["n"]).when(m == SETS, xg["n"] * xg["n"]).otherwise(0).alias("n"),
            ),
        )

    return let(
        F.struct(F.get(p["parts"], x).alias("x"), F.get(g["parts"], y).alias("y")),
        lambda parts: let(
            F.struct(_group(p, parts["x"]).alias("x"), _group(g, parts["y"]).alias("y")),
            lambda groups: decide(parts["x"], parts["y"], groups["x"], groups["y"]),
        ),
    )


def _level(p: Column, g: Column, pairs: Column, levels: int) -> Column:
    """Pairs (x, y) of one level, each with what becomes of it and where its own pairs begin on the next."""
    classified = F.transform(pairs, lambda pair: _classified(p, g, pair["x"], pair["y"], levels))
    return let(
        classified,
        lambda c: let(
            running(F.transform(c, lambda pair: pair["n"]), F.lit(0), lambda at, n: at + n, "int"),
            lambda firsts: F.transform(
                c, lambda pair, i: F.struct(pair["x"], pair["y"], pair["mode"], pair["n"], F.get(firsts, i).alias("first")).cast(PAIR)
            ),
        ),
    )


def _next(p: Column, g: Column, level: Column) -> Column:
    """The pairs into which those of ``level`` fall, in their order."""

    def inner(pair: Column) -> Column:
        xs = F.get(p["groups"], F.get(p["parts"], pair["x"])["group"])
        ys = F.get(g["groups"], F.get(g["parts"], pair["y"])["group"])
        couple = lambda x, y: F.struct(x.cast("int").alias("x"), y.cast("int").alias("y"))
        return let(
            F.struct(xs.alias("x"), ys.alias("y")),
            lambda s: F.transform(
                sequence_of(F.lit(0), pair["n"]),
                lambda k: F.when(pair["mode"] == TUPLES, couple(s["x"]["first"] + k, s["y"]["first"] + k)).otherwise(
                    couple(s["x"]["first"] + F.floor(k / s["x"]["n"]), s["y"]["first"] + k % s["x"]["n"])
                ),
            ),
        )

    return F.flatten(F.transform(F.filter(level, lambda pair: pair["n"] > 0), inner))


def _first_free(agree: Column, pair: Column) -> Column:
    """Does every part of a set find a free counterpart, each taking the first? ``agree`` holds a row for each part."""

    def row(state: Column, i: Column, n: Column) -> Column:
        def take(s: Column) -> Column:
            at = F.filter(s["free"], lambda j: F.get(agree, pair["first"] + i * n + j))
            return let(
                F.get(at, F.lit(0)),
                lambda j: F.struct(F.filter(s["free"], lambda k: k != j).alias("free"), j.isNotNull().alias("ok")),
            )

        return F.when(~state["ok"], state).otherwise(let(state, take))

    return let(
        F.round(F.sqrt(pair["n"])).cast("int"),
        lambda n: F.aggregate(
            sequence_of(F.lit(0), n),
            F.struct(sequence_of(F.lit(0), n).alias("free"), F.lit(True).alias("ok")),
            lambda state, i: row(state, i, n),
            lambda state: state["ok"],
        ),
    )


class Nested(NamedTuple):
    """The three steps of a match, each a column of what the steps before have made.

    They may be columns of their own: Spark resolves lambdas within lambdas pass
    by pass over a whole expression, so three small ones are resolved far sooner
    than one.
    """

    apart: Callable[[Column], Column]
    pairs: Callable[[Column, Column], Column]
    match: Callable[[Column, Column, Column], Column]

    @staticmethod
    def texts(p: Column, g: Column, levels: Column) -> Column:
        """The pairs (x, y) of texts that ``match`` leaves to ``by_texts``."""
        left = F.filter(F.flatten(levels), lambda pair: pair["mode"] == TEXTS)
        cut = lambda pair: F.struct(_text(p, F.get(p["parts"], pair["x"])).alias("x"), _text(g, F.get(g["parts"], pair["y"])).alias("y"))
        return F.transform(left, cut)

    def at_once(self, pred: Column, gold: Column) -> Column:
        """All three as one expression."""
        sides = F.transform(F.array(pred, gold), self.apart)
        return let(sides, lambda s: let(self.pairs(s[0], s[1]), lambda levels: self.match(s[0], s[1], levels)))


def nested_match(
    by_texts: Callable[[Column, Column], Column], bare_form: Callable[[Column], Column], letter: str, figure: str, levels: int
) -> Nested:
    """Agreement of two bare answers, both in brackets of the same kind; NULL if either is not.

    ``by_texts`` decides pairs with no more than ``levels`` levels of groups
    below them, and groups whose first bracket does not match their last one,
    into which nothing else looks.  Tuples take time near linear in the answers; so do sets but
    where parts of one set are nested deeper than ``levels`` themselves, which
    meet each with each.
    """

    def decided(p: Column, g: Column, pair: Column, below: Column) -> Column:
        # The other branches look only at what is already decided, so the texts are cut out for this one alone.
        texts = F.struct(_text(p, F.get(p["parts"], pair["x"])).alias("x"), _text(g, F.get(g["parts"], pair["y"])).alias("y"))
        return (
            F.when(pair["mode"] == DIFFERENT, F.lit(False))
            .when(pair["mode"] == TUPLES, F.forall(sequence_of(pair["first"], pair["n"]), lambda k: F.get(below, k)))
            .when(pair["mode"] == SETS, _first_free(below, pair))
            .otherwise(let(texts, lambda t: by_texts(t["x"], t["y"])))
        )

    def outside_in(p: Column, g: Column) -> Column:
        top = F.array(F.struct((F.size(p["parts"]) - 1).alias("x"), (F.size(g["parts"]) - 1).alias("y")))

        def down(pairs: Column, _: Column) -> Column:
            # Once a level is empty, nothing more is looked at.
            return let(_level(p, g, pairs, levels), lambda level: F.struct(_next(p, g, level).alias("next"), level.alias("out")))

        places = F.sequence(F.lit(0), F.least(p["depth"], g["depth"]) + 1)  # parts lie a level below their brackets
        return scan(places, top, down, "array<struct<x:int,y:int>>", f"array<{PAIR}>")

    def inside_out(p: Column, g: Column, all_levels: Column) -> Column:
        return F.aggregate(
            F.reverse(all_levels),
            F.array().cast("array<boolean>"),
            lambda below, level: F.transform(level, lambda pair: decided(p, g, pair, below)),
            lambda top: F.get(top, F.lit(0)),
        )

    def comparable(p: Column, g: Column) -> Column:
        opens = lambda t: F.get(t["parts"], F.size(t["parts"]) - 1)["opens"]
        return p.isNotNull() & g.isNotNull() & (opens(p) == opens(g))

    return Nested(
        lambda text: let(settled(text, bare_form), lambda t: taken_apart(t, letter, figure)),
        lambda p, g: F.when(comparable(p, g), outside_in(p, g)),
        lambda p, g, levels_: F.when(levels_.isNotNull(), inside_out(p, g, levels_)),
    )
