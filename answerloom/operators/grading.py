"""Extraction and grading of whole run tables."""

from __future__ import annotations

from collections.abc import Callable
from weakref import WeakKeyDictionary

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from answerloom.functions.columns import deeper_analysis
from answerloom.functions.equivalence import (
    Rule,
    apart_from,
    is_blank,
    level_by_level,
    shallow,
    shallow_match,
    shallow_texts,
    simple_match,
    undecided,
    written_out,
)
from answerloom.functions.extraction import robust_answer, simple_answer
from answerloom.functions.identity import plain_expression
from answerloom.functions.normalization import bare_form
from answerloom.functions.rational import expression_values, same_values

# Writing out the rules takes about a second of driver time, so each session
# keeps its expressions; they name columns only, not a table.
_KEPT: WeakKeyDictionary[SparkSession, dict[tuple, Column]] = WeakKeyDictionary()


def _kept(spark: SparkSession, build: Callable[..., Column], *names: str) -> Column:
    known = _KEPT.setdefault(spark, {})
    key = (build, *names)
    if key not in known:
        known[key] = build(*names)
    return known[key]


def _robust(completion: str) -> Column:
    return robust_answer(F.col(completion))


def _blank(pred: str, gold: str) -> Column:
    return is_blank(F.col(pred)) | is_blank(F.col(gold))


def _bare(name: str, other: str) -> Column:
    """Bare form where the two answers differ as they stand, NULL elsewhere."""
    return F.when(F.col(name) != F.col(other), bare_form(F.col(name)))


def _same_value(p: Column, g: Column) -> Column:
    return same_values(F.try_element_at(F.col("_values"), p), F.try_element_at(F.col("_values"), g))


def _rule(*rules: str) -> Rule | None:
    return _same_value if rules else None


def _shallow() -> Column:
    return shallow(F.col("_bare_pred"), F.col("_bare_gold"))


def _apart(name: str, *rules: str) -> Column:
    further = _rule(*rules)
    apart = apart_from(F.col("_bare_pred"), F.col("_bare_gold"), further)
    if rules:
        apart = apart & ~F.col("_shallow")
    return F.when(apart, level_by_level(further).apart(F.col(name)))


def _pairs(*rules: str) -> Column:
    return level_by_level(_rule(*rules)).pairs(F.col("_apart_pred"), F.col("_apart_gold"))


def _texts() -> Column:
    """The texts of a row that may be compared as expressions, each once; NULL where the answers agree as they stand."""
    p, g = F.col("_bare_pred"), F.col("_bare_gold")
    by_level = level_by_level(_same_value).texts(F.col("_apart_pred"), F.col("_apart_gold"), F.col("_pairs"))
    pairs = F.coalesce(by_level, F.array(F.struct(p.alias("x"), g.alias("y"))))
    open_pairs = F.filter(pairs, lambda t: undecided(t["x"], t["y"]))
    texts = F.flatten(F.transform(open_pairs, lambda t: F.array(t["x"], t["y"])))
    return F.when(p.isNotNull(), F.array_distinct(F.when(F.col("_shallow"), shallow_texts(p, g)).otherwise(texts)))


def _plain() -> Column:
    return F.transform(_texts(), lambda t: F.struct(t.alias("text"), plain_expression(t).alias("plain")))


def _values() -> Column:
    # A column of its own: Spark does not find a Python function that has a lambda in its arguments.
    return F.map_from_arrays(F.col("_plain.text"), expression_values(F.col("_plain.plain")))


def _cascade(*rules: str) -> Column:
    further = _rule(*rules)
    bare = (F.col("_bare_pred"), F.col("_bare_gold"))
    by_level = level_by_level(further).match(F.col("_apart_pred"), F.col("_apart_gold"), F.col("_pairs"))
    if rules:
        by_level = F.coalesce(F.when(F.col("_shallow"), shallow_match(*bare, further)), by_level)
    return F.coalesce(by_level, written_out(*bare, further))


def with_match(df: DataFrame, pred: str, gold: str, out: str, identities: bool = False) -> DataFrame:
    """Add the robust grade (0/1) of ``pred`` against ``gold``.

    With ``identities``, answers and parts of them also agree if they are the
    same rational function (see :mod:`answerloom.functions.identity`).

    Row-local: no shuffle.  The two bare forms are columns of their own, so
    they are computed once per row however many rules look at them, and not at
    all for answers that agree as they stand.  So are the steps of the match for
    deeply nested answers, which are NULL for all others.  Identities look up the
    values of the texts that are left to compare, made by a Python worker before.
    """
    spark = df.sparkSession
    rules = ("identities",) if identities else ()
    if identities:
        deeper_analysis()
    bare = df.withColumns(
        {"_bare_pred": _kept(spark, _bare, pred, gold), "_bare_gold": _kept(spark, _bare, gold, pred)}
    )
    if identities:
        bare = bare.withColumn("_shallow", _kept(spark, _shallow))
    apart = bare.withColumns({f"_apart_{n}": _kept(spark, _apart, f"_bare_{n}", *rules) for n in ("pred", "gold")})
    paired = apart.withColumn("_pairs", _kept(spark, _pairs, *rules))
    if identities:
        paired = paired.withColumn("_plain", _kept(spark, _plain)).withColumn("_values", _kept(spark, _values))
    match = (
        F.when(_kept(spark, _blank, pred, gold), F.lit(False))
        .when(F.col(pred) == F.col(gold), F.lit(True))
        .otherwise(_kept(spark, _cascade, *rules))
    )
    return paired.withColumn(out, match.cast("int")).drop(
        "_bare_pred", "_bare_gold", "_shallow", "_apart_pred", "_apart_gold", "_pairs", "_plain", "_values"
    )


def extract_answers(runs: DataFrame, completion: str = "completion") -> DataFrame:
    """Add ``pred_eval``, the answer that the completion ends with; '' where there is none."""
    return runs.withColumn("pred_eval", _kept(runs.sparkSession, _robust, completion))


def grade_runs(
    runs: DataFrame, completion: str = "completion", gold: str = "gold"
) -> DataFrame:
    """Add ``pred_eval`` and ``correct_eval`` to every run row.

    A missing or empty completion gives an empty, hence wrong, prediction.
    One scan, no shuffle, whatever the size or skew of the table.
    """
    extracted = extract_answers(runs, completion)
    return with_match(extracted, "pred_eval", gold, "correct_eval")


def grade_runs_simple(
    runs: DataFrame, completion: str = "completion", gold: str = "gold"
) -> DataFrame:
    """Add ``pred`` and ``correct`` by the simple rules used while sampling."""
    extracted = runs.withColumn("pred", simple_answer(F.col(completion)))
    match = simple_match(F.col("pred"), F.coalesce(F.col(gold), F.lit("")))
    return extracted.withColumn("correct", match.cast("int"))


def grade_runs_once_per_pair(
    runs: DataFrame, completion: str = "completion", gold: str = "gold"
) -> DataFrame:
    """As :func:`grade_runs`, grading each distinct (prediction, gold) once.

    Worth it only where a grade costs more than a shuffle of the run table.
    ``distinct`` combines map-side.  The pair table has one row per key, so a
    pair that holds a large share of the runs is skewed on the run side only,
    which adaptive execution splits; it also broadcasts the pair table when
    its measured size allows.
    """
    extracted = extract_answers(runs, completion)
    pairs = extracted.select(
        F.col("pred_eval").alias("_pred"), F.col(gold).alias("_gold")
    ).distinct()
    graded = with_match(pairs, "_pred", "_gold", "correct_eval")
    same = F.col("pred_eval").eqNullSafe(F.col("_pred")) & F.col(gold).eqNullSafe(
        F.col("_gold")
    )
    return extracted.join(graded, same, "left").drop("_pred", "_gold")


def correct_counts_once_per_pair(
    runs: DataFrame, *keys: str, completion: str = "completion", gold: str = "gold"
) -> DataFrame:
    """``n`` and ``c`` per key, grading each distinct pair once and joining nothing.

    Rows are counted per (keys, prediction, gold) with map-side combine, each
    count is graded as one row, and the counts are summed.
    """
    extracted = runs.select(
        *keys, _kept(runs.sparkSession, _robust, completion).alias("_pred"), F.col(gold).alias("_gold")
    )
    copies = extracted.groupBy(*keys, "_pred", "_gold").agg(F.count("*").alias("_n"))
    graded = with_match(copies, "_pred", "_gold", "_ok")
    return graded.groupBy(*keys).agg(
        F.sum("_n").alias("n"), F.sum(F.col("_ok") * F.col("_n")).alias("c")
    )
