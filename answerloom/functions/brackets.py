"""Brackets of any depth in column expressions: positions, partners and cuts by folds and sorts.

A text is cut into pieces, each a single bracket (or comma) or a run of anything
else.  One fold over the pieces gives the depth before each; sorted by depth,
the brackets of one group stand side by side, so partners, parts and children
need no stack.  All work is in proportion to the text, but for the sorting.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from answerloom.functions.columns import let, running

# Two counts in one BIGINT: the higher one counts in steps of this.
HIGH = 1 << 31


def low(packed: Column) -> Column:
    return packed.bitwiseAND(F.lit(HIGH - 1)).cast("int")


def high(packed: Column) -> Column:
    return F.shiftright(packed, 31).cast("int")


def cut_pieces(text: Column, single: str) -> Column:
    """The text as pieces: characters of the class body ``single`` one by one, runs of others whole."""
    return F.regexp_extract_all(text, F.lit(rf"[{single}]|[^{single}]++"), F.lit(0))


def byte_starts(pieces: Column) -> Column:
    """Where each piece begins, in bytes of UTF-8."""
    return running(F.transform(pieces, F.octet_length), F.lit(0), lambda at, size: at + size, "int")


def cut_bytes(whole: Column, start: Column, stop: Column) -> Column:
    """Bytes from ``start`` up to ``stop`` of a BINARY text; unlike cutting by characters, this does not count from the front."""
    return F.substring(whole, start + 1, stop - start).cast("string")


def rewrite(text: Column, edits: Column) -> Column:
    """``text`` with ``edits`` (an array of start, stop, new; bytes, in order, apart from one another)."""
    last = F.struct(F.octet_length(text).alias("start"), F.lit(0).alias("stop"), F.lit("").alias("new"))

    def joined(whole: Column, all_edits: Column) -> Column:
        kept = F.transform(
            all_edits,
            lambda e, i: F.concat(
                cut_bytes(whole, F.when(i == 0, F.lit(0)).otherwise(F.get(all_edits, i - 1)["stop"]), e["start"]), e["new"]
            ),
        )
        return F.array_join(kept, "")

    return let(
        F.struct(F.encode(text, "UTF-8").alias("whole"), F.concat(edits, F.array(last)).alias("edits")),
        lambda s: joined(s["whole"], s["edits"]),
    )


def brace_partners(pieces: Column) -> Column:
    """(no, close): for each piece how many braces open before it, and for each opening brace the place of its partner.

    A closing brace without an open one before it counts for nothing; an opening
    brace that is never closed has no partner, which is NULL.
    """

    def step(state: Column, piece: Column) -> Column:
        """Opened so far in the high half, depth in the low one."""
        closes = F.when(low(state) > 0, state - 1).otherwise(state)
        return F.when(piece == "{", state + HIGH + 1).when(piece == "}", closes).otherwise(state)

    def partners(p: Column, states: Column) -> Column:
        def mark(i: Column) -> Column:
            level, opens = low(F.get(states, i)), F.get(p, i) == "{"
            return F.struct(F.when(opens, level + 1).otherwise(level).alias("level"), i.alias("at"), opens.alias("opens"))

        braces = F.filter(sequence_of(F.lit(0), F.size(p)), lambda i: (F.get(p, i) == "{") | ((F.get(p, i) == "}") & (low(F.get(states, i)) > 0)))
        # On one level an opening brace and the next mark are partners if that one closes.
        side_by_side = F.array_sort(F.transform(braces, mark))

        def closed(s: Column) -> Column:
            def one(m: Column, i: Column) -> Column:
                following = F.get(s, i + 1)
                partner = (following["level"] == m["level"]) & ~following["opens"]
                return F.struct(m["at"].alias("open"), F.when(partner, following["at"]).alias("close"), m["opens"].alias("opens"))

            return F.filter(F.transform(s, one), lambda x: x["opens"])

        by_opening = F.array_sort(let(side_by_side, closed))
        return F.struct(
            F.transform(states, high).alias("no"), F.transform(by_opening, lambda x: x["close"]).alias("close")
        )

    return let(pieces, lambda p: let(running(p, F.lit(0), step, "bigint"), lambda states: partners(p, states)))


def sequence_of(first: Column, count: Column) -> Column:
    """first, first + 1, ...; ``count`` numbers."""
    return F.when(count > 0, F.sequence(first, first + count - 1)).otherwise(F.array().cast("array<int>"))
