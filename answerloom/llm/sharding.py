"""Placing rows on shards by a hierarchical weighted hash tree.

A row descends region, rack and shard.  At each level every child draws
``-ln(u) / weight`` with ``u`` hashed from the row's key and the child's name,
and the smallest draw wins.  A child's draw depends on nothing but its own name
and weight, so a change of weight moves rows only into or out of the subtrees on
the path of that change.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.llm.common import land

#: Rows of a shard are numbered in this many pieces, each ordered by one task.
PIECES = 1024


@dataclass(frozen=True)
class Node:
    """A region, rack or shard; ``shard`` is set on leaves only."""

    name: str
    weight: float
    children: tuple[Node, ...] = ()
    shard: int | None = None


def leaf(shard: int, weight: float = 1.0) -> Node:
    return Node(f"shard-{shard}", weight, (), shard)


def inner(name: str, children: Sequence[Node]) -> Node:
    return Node(name, sum(c.weight for c in children), tuple(children))


def layout(shards: int, racks: int = 2, per_rack: int = 5, base: int = 40) -> Node:
    """A tree of regions, racks and shards of equal weight.

    The first ``base`` shards fill racks and regions; every later shard opens a
    region of its own.  A row that enters that region can only reach the new
    shard, and no other draw changes, so one more shard takes rows only into
    itself.
    """
    regions = []
    for first in range(0, min(shards, base), racks * per_rack):
        inside = range(first, min(first + racks * per_rack, shards, base))
        regions.append(
            inner(
                f"region-{first}",
                [
                    inner(f"rack-{start}", [leaf(s) for s in range(start, min(start + per_rack, inside.stop))])
                    for start in inside[::per_rack]
                ],
            )
        )
    regions += [inner(f"region-{s}", [inner(f"rack-{s}", [leaf(s)])]) for s in range(base, shards)]
    return inner("root", regions)


def _draw(key: Column, node: Node) -> Column:
    u = (F.shiftrightunsigned(F.xxhash64(key, F.lit(node.name)), 11).cast("double") + 0.5) / float(2**53)
    return -F.log(u) / node.weight


def descend(key: Column, tree: Node) -> Column:
    """The shard that ``key`` (a non-NULL column) reaches; one draw for each child on its own path only."""
    children = [c for c in tree.children if c.weight > 0]
    if tree.shard is not None:
        return F.lit(tree.shard)
    if not children:
        return F.lit(None).cast("int")
    if len(children) == 1:
        return descend(key, children[0])
    winner = F.array_min(
        F.array(*(F.struct(_draw(key, c).alias("draw"), F.lit(i).alias("at")) for i, c in enumerate(children)))
    )["at"]
    if all(c.shard is not None for c in children):
        return F.get(F.array(*(F.lit(c.shard) for c in children)), winner)
    # A lambda binds the winner once; behind CASE branches it would be drawn again for each.
    branches = lambda at: F.coalesce(
        *(F.when(at == i, descend(key, c)) for i, c in enumerate(children))
    )
    return F.get(F.transform(F.array(winner), branches), F.lit(0))


def place(docs: DataFrame, tree: Node, out: str = "shard", key: str = "doc_id") -> DataFrame:
    """Add the shard of each row, decided by ``key`` and the tree alone.

    Row-local: nothing is shuffled.  A NULL key is a key like any other, apart
    from the empty text; repeated keys share a shard.  A column ``out`` in
    ``docs`` is replaced.
    """
    text = F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("null"))
    return docs.withColumn(out, descend(text, tree).cast("int"))


def with_slots(placed: DataFrame, order: Sequence[str], shard: str = "shard", out: str = "slot") -> DataFrame:
    """Number the rows of each shard from 0 without a gap.

    The order is a hash of the first column of ``order``, then its columns.
    Each shard is cut into ``PIECES`` ranges of the hash; ranges are counted
    first, so no task holds a shard.  Rows that agree in all of ``order`` share
    their numbers out among themselves.
    """
    hashed = placed.withColumn("_hash", F.xxhash64(F.col(order[0]))).withColumn(
        "_piece", F.shiftrightunsigned("_hash", 64 - (PIECES.bit_length() - 1)).cast("int")
    )
    counts = hashed.groupBy(shard, "_piece").agg(F.count("*").alias("_rows"))
    before = Window.partitionBy(shard).orderBy("_piece").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        F.col(shard).alias("_of"),
        F.col("_piece").alias("_range"),
        F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"),
    )
    within = Window.partitionBy(shard, "_piece").orderBy("_hash", *order)
    return (
        hashed.withColumn("_at", F.row_number().over(within) - 1)
        .join(offsets, F.col(shard).eqNullSafe(F.col("_of")) & (F.col("_piece") == F.col("_range")))
        .withColumn(out, (F.col("_before") + F.col("_at")).cast("long"))
        .drop("_hash", "_piece", "_at", "_of", "_range", "_before")
    )


def digest(docs: DataFrame, overhead: int = 16) -> DataFrame:
    """doc_id, ``size`` (UTF-8 bytes of the text and a fixed overhead) and ``text_crc32``; NULL text: none and 0."""
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length("text"), F.lit(0)) + overhead).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit(""))).alias("text_crc32"),
    )


def shard_digest(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Where each document goes under the law ``key``, its slot there, and where it would go with one more shard."""
    rows = land(place(place(digest(docs), layout(shards)), layout(shards + 1), "grown_shard"), "shard-digest")
    return with_slots(rows, ["doc_id", "size", "text_crc32"]).withColumn("law", F.lit("key"))
