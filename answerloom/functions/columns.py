"""Small helpers shared by the column functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# The characters that count as white space for trimming and for
# "\s", and those that end a line.  Both are wider than Spark's defaults
# (``trim`` removes U+0020 only; Java's "\s" is ASCII only).
SPACES = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
SPACE = r"\s\x1c-\x1f"  # inside [...], under the flag (?U)
BREAK = r"\v\x1c-\x1e"


ANALYSIS = "spark.sql.analyzer.maxIterations"


def deeper_analysis(passes: int = 1000) -> None:
    """Let the session's analyzer make more passes over an expression; it stops by itself as soon as nothing changes."""
    spark = SparkSession.getActiveSession()
    if spark is not None and int(spark.conf.get(ANALYSIS, "100")) < passes:
        spark.conf.set(ANALYSIS, str(passes))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once per row and use it several times in ``body``.

    A column expression that mentions another one twice is evaluated twice
    whenever a mention sits behind a condition, where subexpression
    elimination does not reach.  A lambda variable is bound exactly once.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(text: Column) -> Column:
    """Trim Unicode white space on both ends."""
    return F.btrim(text, F.lit(SPACES))


def squeeze(text: Column) -> Column:
    """Remove all white space."""
    return F.regexp_replace(text, f"(?U)[{SPACE}]+", "")


def drop(text: Column, *literals: str) -> Column:
    """Delete every occurrence of each literal, one literal after the other."""
    for literal in literals:
        text = F.replace(text, F.lit(literal), F.lit(""))
    return text


def unwrap(text: Column, left: str, right: str) -> Column:
    """Drop one outer pair of single-character brackets, if both are there."""
    return F.regexp_replace(text, rf"(?s)\A\{left}(.*)\{right}\z", "$1")


def enclosed(text: Column, left: str, right: str) -> Column:
    return F.startswith(text, F.lit(left)) & F.endswith(text, F.lit(right))


def first_group(text: Column, pattern: str) -> Column:
    """Group 1 of the leftmost match; NULL (not '') when nothing matches."""
    return F.get(F.regexp_extract_all(text, F.lit(pattern), F.lit(1)), F.lit(0))


def last_line(text: Column) -> Column:
    """Last line that is not blank, trimmed; '' when there is none.

    One greedy pass to the last line break that still has a visible character
    behind it, so the cost is linear in the text.
    """
    line = F.regexp_extract(
        text, rf"(?U)\A(?:(?s:.*)[{BREAK}])?([^{BREAK}]*[^{SPACE}])", 1
    )
    return strip(line)


def nested_braces(depth: int) -> str:
    """Regex body for text whose braces balance, up to ``depth`` levels.

    Possessive throughout: no backtracking, and Java runs it iteratively.
    """
    body = "[^{}]*+"
    for _ in range(depth):
        body = r"(?:[^{}]++|\{" + body + r"\})*+"
    return body


def _gather(items: Column, start: Column, kind: str, emits: str, one: Callable[[Column, Column], Column], chunk: int) -> Column:
    """Fold ``one`` over the items and gather what it puts out.

    ``one`` gets (at, seen) and an item and gives the same again.  Appending to
    an array copies it, so outputs are gathered in chunks, chunks in blocks of
    chunks, and these into the result: the work is near linear in the items.
    """
    wide = chunk * chunk

    def empty(state: Column, depth: str) -> Column:
        return F.struct(state.alias("at"), F.array().cast(f"array<{depth}>").alias("seen"))

    def gathered(numbers: Column, state: Column, body: Callable[[Column, Column], Column], depth: str) -> Column:
        """Fold ``body`` over ``numbers``, gathering what each gives."""
        return F.aggregate(
            numbers,
            empty(state, depth),
            lambda acc, number: let(
                body(acc["at"], number), lambda r: F.struct(r["at"].alias("at"), F.array_append(acc["seen"], r["seen"]).alias("seen"))
            ),
        )

    def over(every: Column) -> Column:
        total = F.size(every)

        def inside(state: Column, c: Column) -> Column:
            # Not slice(): inside a lambda that copies the whole array each time.
            places = F.sequence(c * chunk, F.least((c + 1) * chunk, total) - 1)
            return F.aggregate(places, empty(state, emits), lambda acc, i: one(acc, F.get(every, i)))

        def block(state: Column, b: Column) -> Column:
            last = F.floor((F.least((b + 1) * wide, total) - 1) / chunk).cast("int")
            return gathered(F.sequence(b * chunk, last), state, inside, f"array<{emits}>")

        blocks = F.sequence(F.lit(0), F.floor((total - 1) / wide).cast("int"))
        return F.flatten(F.flatten(gathered(blocks, start.cast(kind), block, f"array<array<{emits}>>")["seen"]))

    return F.when(F.size(items) == 0, F.array().cast(f"array<{emits}>")).otherwise(let(items, over))


def scan(
    items: Column, start: Column, step: Callable[[Column, Column], Column], kind: str, emits: str, chunk: int = 32
) -> Column:
    """What ``step`` puts out at each item, while a state goes from item to item.

    ``step`` gets the state and the item and gives ``next``, the state behind it, and ``out``.
    """

    def one(acc: Column, item: Column) -> Column:
        return let(
            step(acc["at"], item),
            lambda s: F.struct(s["next"].cast(kind).alias("at"), F.array_append(acc["seen"], s["out"].cast(emits)).alias("seen")),
        )

    return _gather(items, start, kind, emits, one, chunk)


def running(
    items: Column, start: Column, step: Callable[[Column, Column], Column], kind: str, chunk: int = 32
) -> Column:
    """The state before each item, ``step`` giving the one behind it."""

    def one(acc: Column, item: Column) -> Column:
        return F.struct(step(acc["at"], item).cast(kind).alias("at"), F.array_append(acc["seen"], acc["at"]).alias("seen"))

    return _gather(items, start, kind, kind, one, chunk)
