"""Diagnostics over the log of a blockwise Metropolis-Hastings sampler.

Input columns: ``chain_id``, ``block``, ``step``, ``alpha``, ``prop_logp``,
``cur_logp``, ``logq_old``, ``logq_new``, ``u`` (the uniform draw).
"""

from __future__ import annotations

import itertools
import sys
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from answerloom.operators.sharding import shared_folder

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # executors need no copy of this module

# Rows per window segment: small enough for one task, large enough that a
# chain has few segments.
SEGMENT_STEPS = 100_000


def block_schedule(
    lengths: DataFrame, block_size: int, length: str = "length"
) -> DataFrame:
    """One row per block: ``block`` (from 1) and ``block_end``.

    Blocks end at multiples of ``block_size``, the last one at the length.
    """
    blocks = F.ceil(F.col(length) / F.lit(block_size)).cast("long")
    return (
        lengths.filter(F.col(length) > 0)
        .withColumn("block", F.explode(F.sequence(F.lit(1).cast("long"), blocks)))
        .withColumn("block_end", F.least(F.col("block") * block_size, F.col(length)))
    )


def log_accept() -> Column:
    return F.col("alpha") * (F.col("prop_logp") - F.col("cur_logp")) + (
        F.col("logq_old") - F.col("logq_new")
    )


def with_acceptance(steps: DataFrame) -> DataFrame:
    """Add ``log_accept`` and ``accepted``: ``ln(u) < min(0, log_accept)``.

    A draw of exactly 0 has no logarithm; it accepts whatever is possible.
    """
    bound = F.least(F.lit(0.0), F.col("log_accept"))
    accepted = F.when(
        F.col("u") <= 0, F.col("log_accept") > F.lit(float("-inf"))
    ).otherwise(F.ln("u") < bound)
    return steps.withColumn("log_accept", log_accept()).withColumn("accepted", accepted)


def accept_rate(steps: DataFrame) -> DataFrame:
    """Accepted share of the steps per chain; a run without a chain has no row, and 0.0 in ``run_rows``."""
    counts = (
        with_acceptance(steps)
        .groupBy("chain_id")
        .agg(
            F.count("*").alias("n_steps"),
            F.count(F.when(F.col("accepted"), F.lit(1))).alias("n_accepted"),
        )
    )
    return counts.withColumn(
        "accept_rate", F.col("n_accepted") / F.greatest("n_steps", F.lit(1))
    )


def _in_segments(steps: DataFrame, segment_rows: int) -> DataFrame:
    """``steps`` written in the order of chain, block and step, with ``_place`` and the ``_segment`` of so many rows it is in."""
    spark = steps.sparkSession
    order = ["chain_id", "block", "step"]
    path = f"{shared_folder(spark)}/chains-{uuid.uuid4().hex}"
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id()  # partitions follow one another, and rows within them
    sorted_rows = steps.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    sorted_rows.withColumn("_place", place).withColumn(
        "_segment", F.floor(F.col("_place") / F.lit(segment_rows))
    ).write.parquet(path)
    return spark.read.parquet(path)


def carried_state(
    steps: DataFrame, segment_rows: int = SEGMENT_STEPS, tolerance: float = 1e-9
) -> DataFrame:
    """Replay each chain's log-probability and compare it with the logged one.

    ``expected_logp`` is the proposal last accepted earlier in the block, or
    the block's first logged value; ``consistent`` says whether ``cur_logp``
    agrees.  ``step`` must order a block.  NULL chains and blocks are chains
    and blocks of their own; a NULL step comes first.

    One chain may hold most of the log, so the log is range-partitioned by
    chain, block and step and cut into segments of at most ``segment_rows``
    rows: by count, so that sparse step numbers cut no more than dense ones.
    The cut log is written to the shared folder, once, when the function is
    called.  A segment's summary (last accepted proposal, first value) is one
    row; the state at its start comes from a window over the summaries, which
    are few; and the row window runs within a segment.
    """
    logged = _in_segments(with_acceptance(steps), segment_rows)
    segment = ["chain_id", "block", "_segment"]
    took = F.when(F.col("accepted"), F.col("prop_logp"))
    summaries = logged.groupBy(*segment).agg(
        F.max_by("prop_logp", F.when(F.col("accepted"), F.col("_place"))).alias("_last"),
        F.min_by("cur_logp", "_place").alias("_first"),
    )
    block = Window.partitionBy("chain_id", "block").orderBy("_segment")
    before = block.rowsBetween(Window.unboundedPreceding, -1)
    upto = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    starts = summaries.select(
        F.col("chain_id").alias("_chain"),
        F.col("block").alias("_of"),
        F.col("_segment").alias("_cut"),
        F.coalesce(
            F.last("_last", ignorenulls=True).over(before), F.first("_first").over(upto)
        ).alias("_start"),
    )
    earlier = (
        Window.partitionBy(*segment)
        .orderBy("_place")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    expected = F.coalesce(F.last(took, ignorenulls=True).over(earlier), F.col("_start"))
    same = (
        F.col("chain_id").eqNullSafe(F.col("_chain"))
        & F.col("block").eqNullSafe(F.col("_of"))
        & (F.col("_segment") == F.col("_cut"))
    )
    return (
        logged.join(starts, same, "left")
        .withColumn("expected_logp", expected)
        .withColumn(
            "consistent", F.abs(F.col("expected_logp") - F.col("cur_logp")) <= tolerance
        )
        .drop("_segment", "_start", "_chain", "_of", "_cut", "_place")
    )


# --- replay: acceptance decided anew by the carried state --------------------
#
# A step takes its proposal if ln(u) < min(0, alpha * (prop - x) + dq), x being
# the state it finds.  For alpha > 0 that is x < t with t = prop + (dq - ln u) /
# alpha: a map that sends everything below t to prop and leaves the rest alone.
# Such maps compose: what a run of them makes of x depends only on the first t
# above x, so a segment is summed up by its record thresholds and, for each, the
# state that a chain entering there leaves with.

NEVER, ALWAYS = -np.inf, np.inf


def thresholds(alpha: np.ndarray, prop: np.ndarray, dq: np.ndarray, u: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each step the bound and its side (1: takes states below it, -1: states above it).

    A step with a missing figure never takes its proposal; with alpha = 0 the
    state does not matter.
    """
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        log_u = np.where(u > 0, np.log(np.where(u > 0, u, 1.0)), -np.inf)
        bound = prop + (dq - log_u) / alpha
    side = np.where(alpha < 0, -1, 1)
    flat = np.where((log_u < np.minimum(0.0, dq)) | ((u <= 0) & (dq > -np.inf)), ALWAYS, NEVER)
    bound = np.where(alpha == 0, flat, bound)
    # ln(u) < 0 is a condition of its own, and a draw of 0 takes whatever is possible.
    bound = np.where((u >= 1), NEVER * side, bound)
    known = ~(np.isnan(alpha) | np.isnan(prop) | np.isnan(dq) | np.isnan(u))
    return np.where(known & ~np.isnan(bound), bound, NEVER * side), side


def walk(state: float, prop: np.ndarray, bound: np.ndarray, side: np.ndarray) -> np.ndarray:
    """The state before each step, and behind the last one, of a chain that enters with ``state``."""
    out = np.empty(len(prop) + 1)
    out[0], at = state, 0
    for k, (p, t, s) in enumerate(zip(prop.tolist(), bound.tolist(), side.tolist())):
        if (state < t) if s > 0 else (state > t):
            out[at : k + 1] = state
            state, at = p, k + 1
    out[at:] = state
    return out


def summary(prop: np.ndarray, bound: np.ndarray, side: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The composed map of some steps as (side, record bound, state left behind), in the order in which a chain meets them.

    A chain that enters with x takes the first record that x satisfies, and
    leaves with that record's state; if x satisfies none, it leaves with x.
    """
    n = len(prop)
    leaves = np.empty(n)
    # From the back: a chain that takes step k leaves with the state that the next step it takes leaves.  The stacks
    # hold what a chain coming from the front meets, the nearest last: (bound, state left behind, step).
    firsts: list[tuple[float, float, int]] = []
    above: list[tuple[float, float, int]] = []
    for k in range(n - 1, -1, -1):
        p, t = float(prop[k]), float(bound[k])
        if k + 1 < n:
            hits = [_first(firsts, p), _first_above(above, p)]
            hits = [h for h in hits if h is not None]
            leaves[k] = min(hits, key=lambda h: h[0])[1] if hits else p
        else:
            leaves[k] = p
        if side[k] > 0:
            while firsts and firsts[-1][0] <= t:  # hidden behind this one for whoever comes from the front
                firsts.pop()
            firsts.append((t, leaves[k], k))
        else:
            while above and above[-1][0] >= t:
                above.pop()
            above.append((t, leaves[k], k))
    records = sorted([(k, 1, t, v) for t, v, k in firsts] + [(k, -1, t, v) for t, v, k in above])
    return tuple(np.array([r[i] for r in records], float) for i in (1, 2, 3))


def _first(stack: list[tuple[float, float, int]], x: float) -> tuple[int, float] | None:
    """(step, state left behind) of the first step with a bound above ``x``; bounds grow towards the bottom of the stack."""
    low, high = 0, len(stack)  # stack[:low] are above x
    while low < high:
        mid = (low + high) // 2
        if stack[mid][0] > x:
            low = mid + 1
        else:
            high = mid
    return (stack[low - 1][2], stack[low - 1][1]) if low else None


def _first_above(stack: list[tuple[float, float, int]], x: float) -> tuple[int, float] | None:
    """As ``_first`` for bounds that must lie below ``x``; they fall towards the bottom of the stack."""
    low, high = 0, len(stack)
    while low < high:
        mid = (low + high) // 2
        if stack[mid][0] < x:
            low = mid + 1
        else:
            high = mid
    return (stack[low - 1][2], stack[low - 1][1]) if low else None


def _met(sides: np.ndarray, bounds: np.ndarray, leaves: np.ndarray, x: float) -> float:
    """What a summary makes of ``x``."""
    hit = np.flatnonzero(np.where(sides > 0, x < bounds, x > bounds))
    return float(leaves[hit[0]]) if len(hit) else x


def _figures(rows: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    prop, alpha, old, new, u = (_doubles(rows, c) for c in ("prop_logp", "alpha", "logq_old", "logq_new", "u"))
    return (prop, *thresholds(alpha, prop, old - new, u))


def replay(steps: DataFrame, segment_rows: int = SEGMENT_STEPS) -> DataFrame:
    """Run each chain again from its proposals and draws alone, whatever state its log claims.

    Adds ``replay_logp``, the state each step finds (a block starts with its
    first logged value), and ``replay_accepted``.  ``step`` must order a block;
    NULL chains and blocks are chains and blocks of their own.  A step with a
    missing figure never takes its proposal; a block whose first value is
    missing has no state until it takes one, and a missing state takes nothing.

    A block may hold most of the log, and a log may have a block to every other
    row.  So it is cut by row count, into segments of ``segment_rows`` rows,
    whatever blocks they hold.  Only a segment's first and last block may reach
    over its borders; these are summed up by the thresholds that a chain can
    meet first (about the logarithm of their rows, unless the thresholds keep
    rising).  The summaries are walked through block by block, which gives the
    state that enters each segment, and then all segments are replayed at once.
    Every step runs over Arrow batches of many segments.
    """
    logged = _in_segments(steps, segment_rows)
    block = ["chain_id", "block"]
    kinds = {f.name: f.dataType.simpleString() for f in logged.schema.fields}
    columns = ", ".join(f"`{name}` {kind}" for name, kind in kinds.items())
    block_kinds = ", ".join(f"{k} {kinds[k]}" for k in block)

    narrow = logged.select(*block, "_segment", "_place", "cur_logp", "prop_logp", "alpha", "logq_old", "logq_new", "u")
    summaries = _with_begins(narrow.repartition("_segment"), block, "_segment", "_place").mapInArrow(
        _sum_up_borders, f"{block_kinds}, _segment bigint, _leads boolean, first double, sides array<double>, bounds array<double>, leaves array<double>"
    )
    entries = _with_begins(summaries.repartition(*block), block, *block, "_segment").mapInArrow(
        _walk_summaries, "_segment bigint, _entry double"
    )
    # An entry comes before the rows of its segment: it has no place.
    entered = logged.withColumn("_entry", F.lit(None).cast("double")).unionByName(entries, allowMissingColumns=True)
    return (
        _with_begins(entered.repartition("_segment"), block, "_segment", "_place")
        .mapInArrow(_run_again, f"{columns}, replay_logp double, replay_accepted boolean")
        .drop("_segment", "_place")
    )


def _with_begins(rows: DataFrame, block: list[str], *order: str) -> DataFrame:
    """``rows`` in ``order`` within their partitions, with ``_begins``: does a block begin here, or else what all but the last of ``order`` name?"""
    before = Window.partitionBy(*order[:-1]).orderBy(order[-1])
    same = [F.lag(k).over(before).eqNullSafe(F.col(k)) for k in block]
    begins = F.lag(F.lit(1)).over(before).isNull() | ~(same[0] & same[1])
    return rows.withColumn("_begins", begins).sortWithinPartitions(*order)


def _doubles(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).cast(pa.float64()).to_numpy(zero_copy_only=False)


def _sum_up_borders(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The summaries of each segment's first and last block (one if they are the same)."""
    rest = None
    for batch in itertools.chain(batches, [None]):
        if batch is not None:
            new = pa.Table.from_batches([batch])
            rows = new if rest is None else pa.concat_tables([rest, new])
        else:
            rows = rest
        if rows is None or not rows.num_rows:
            continue
        segments = rows.column("_segment").to_numpy()
        cuts = [0, *(np.flatnonzero(np.diff(segments)) + 1).tolist()]
        if batch is None:
            cuts.append(rows.num_rows)
        rest = rows.slice(cuts[-1])  # the last segment may go on in the next batch
        rows = rows.slice(0, cuts[-1])
        if not rows.num_rows:
            continue
        prop, bound, side = _figures(rows)
        first = _doubles(rows, "cur_logp")
        begins = np.flatnonzero(rows.column("_begins").to_numpy(zero_copy_only=False))
        spans = []
        for start, stop in zip(cuts, cuts[1:]):
            one, many = np.searchsorted(begins, (start, stop))
            spans.append((start, int(begins[one + 1]) if one + 1 < many else stop, True))
            if one + 1 < many:
                spans.append((int(begins[many - 1]), stop, False))
        found = [summary(prop[a:b], bound[a:b], side[a:b]) for a, b, _ in spans]
        at = [a for a, _, _ in spans]
        heads = rows.select(["chain_id", "block", "_segment"]).take(pa.array(at)).combine_chunks()
        heads = heads.append_column("_leads", pa.array([leads for _, _, leads in spans]))
        heads = heads.append_column("first", pa.array(first[at], pa.float64()))
        for i, name in enumerate(("sides", "bounds", "leaves")):
            heads = heads.append_column(name, pa.array([f[i].tolist() for f in found], pa.list_(pa.float64())))
        yield from heads.combine_chunks().to_batches()


def _walk_summaries(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The state with which each segment is entered."""
    x = np.nan
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        entries = []
        first = _doubles(rows, "first").tolist()
        begins, leads, sides, bounds, leaves = (rows.column(c).to_pylist() for c in ("_begins", "_leads", "sides", "bounds", "leaves"))
        for k in range(rows.num_rows):
            if begins[k]:
                x = first[k]
            entries.append(x)
            x = _met(*(np.array(a[k], float) for a in (sides, bounds, leaves)), x)
        leading = pa.array(leads, pa.bool_())
        out = pa.table([rows.column("_segment"), pa.array(entries, pa.float64())], names=["_segment", "_entry"]).filter(leading)
        yield from out.combine_chunks().to_batches()


def _run_again(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row with the state it finds; entries set the state and go."""
    state, entered = np.nan, False
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        prop, bound, side = _figures(rows)
        is_entry = rows.column("_place").is_null().to_numpy()
        found = np.empty(rows.num_rows)
        figures = (is_entry, rows.column("_begins").to_numpy(zero_copy_only=False), prop, bound, side)
        starts = np.where(is_entry, _doubles(rows, "_entry"), _doubles(rows, "cur_logp")).tolist()
        for k, (enters, begins, p, t, s, start) in enumerate(zip(*(f.tolist() for f in figures), starts)):
            if enters:
                state, entered = start, True
                continue
            if begins and not entered:
                state = start
            entered = False
            found[k] = state
            if (state < t) if s > 0 else (state > t):
                state = p
        took = np.where(side > 0, found < bound, found > bound)
        out = rows.drop_columns(["_begins", "_entry"])
        out = out.append_column("replay_logp", pa.array(found, mask=np.isnan(found))).append_column("replay_accepted", pa.array(took))
        yield from out.filter(pa.array(~is_entry)).combine_chunks().to_batches()
