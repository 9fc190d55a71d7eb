"""Stand-in inputs over the given tables, as SQL that Spark and DuckDB share.

No table of completions, token distributions or sampler steps is given, so each
is derived, row by row, from a whole given table.  ``chr(92)`` is a backslash,
which keeps the texts free of either dialect's escapes.
"""

from __future__ import annotations

import re
import uuid
from weakref import WeakKeyDictionary

from pyspark.sql import DataFrame, SparkSession

from answerloom.operators.sharding import shared_folder

RUNS = """
WITH b AS (
  SELECT CASE WHEN l_partkey % 89 = 7 THEN NULL WHEN l_returnflag = 'A' THEN 'base' WHEN l_returnflag = 'N' THEN 'lowtemp'
              ELSE 'power_mh' END AS method,
         CASE WHEN l_partkey % 97 = 3 THEN NULL ELSE CAST(l_linenumber % 3 AS INT) END AS seed,
         CAST(l_suppkey % 4 + 1 AS INT) AS n_mcmc,
         l_partkey % 83 = 5 AS no_completion, l_partkey % 79 = 11 AS no_gold,
         concat('test/algebra/', CAST(l_partkey AS STRING), '.json') AS example_id,
         CAST(l_partkey % 5 AS INT) AS fmt, l_linenumber AS shape,
         CAST(l_partkey % 50 + 1 AS STRING) AS g,
         CAST(l_partkey % 50 + 1 + CASE WHEN l_suppkey % 3 = 0 THEN 1 ELSE 0 END AS STRING) AS v
  FROM lineitem),
f AS (
  SELECT method, seed, n_mcmc, example_id, shape, no_completion,
    CASE WHEN no_gold THEN NULL ELSE CASE fmt WHEN 0 THEN g
             WHEN 1 THEN concat(chr(92), 'frac{', g, '}{7}')
             WHEN 2 THEN concat(chr(92), 'left( ', g, ', ', chr(92), 'frac{', chr(92), 'pi}{2} ', chr(92), 'right)')
             WHEN 3 THEN concat(chr(92), 'text{Name', chr(64 + CAST(g AS INT) % 26 + 1), '}')
             ELSE concat(g, '.0') END END AS gold,
    CASE fmt WHEN 0 THEN concat('$', v, '$')
             WHEN 1 THEN concat(chr(92), 'frac{', v, '}{7}')
             WHEN 2 THEN concat('(', v, ',', chr(92), 'frac{', chr(92), 'pi}{2})')
             WHEN 3 THEN concat('name', chr(64 + CAST(v AS INT) % 26 + 1))
             ELSE v END AS ans
  FROM b)
SELECT method, seed, n_mcmc, example_id, gold,
  CASE WHEN no_completion THEN NULL ELSE CASE shape
    WHEN 1 THEN concat('Step one.', chr(10), 'So ', chr(92), 'boxed{', ans, '}.')
    WHEN 2 THEN concat(chr(92), 'boxed{0} then ', chr(92), 'fbox{', ans, '} done')
    WHEN 3 THEN concat('So ', chr(92), 'boxed{', ans, '} and ', chr(92), 'boxed{', ans)
    WHEN 4 THEN concat('Work.', chr(10), 'Final answer: ', ans, chr(10), 'bye')
    WHEN 5 THEN concat('Work', chr(10), '#### ', ans)
    WHEN 6 THEN concat('Work', chr(10), chr(10), ans, chr(10))
    ELSE '' END END AS completion
FROM f
"""

# Long texts: every document, with the tail of a worked solution.
SOLUTIONS = """
SELECT doc_id, lang, text AS problem, CAST(doc_id % 90 + 1 AS STRING) AS gold,
  concat(text, CASE CAST(doc_id % 8 AS INT)
    WHEN 0 THEN ''
    WHEN 1 THEN concat(chr(10), 'So it is ', chr(92), 'boxed{', chr(92), 'frac{', CAST(doc_id % 90 + 1 AS STRING), '}{{7}}}.')
    WHEN 2 THEN concat(chr(10), 'FINAL ANSWER - ', CAST(doc_id % 90 + 1 AS STRING), chr(10), 'and the answer: 0')
    WHEN 3 THEN concat(chr(10), '####  ', CAST(doc_id % 90 + 1 AS STRING), ' ', chr(13), chr(10), chr(10))
    WHEN 4 THEN concat(' ', chr(92), 'boxed{0} and ', chr(92), 'fbox{ ', CAST(doc_id % 90 + 1 AS STRING), ' } {x}.')
    WHEN 5 THEN concat(' ', chr(92), 'boxed{1} ', chr(92), 'boxed{2', chr(10), 'open ', CAST(doc_id % 90 + 1 AS STRING))
    WHEN 6 THEN concat(' ', chr(92), 'boxed{ }', chr(10), 'Answer:', chr(10), chr(10), '  ', CAST(doc_id % 90 + 1 AS STRING), chr(9))
    ELSE concat(chr(13), chr(10), 'last', chr(12), ' line ', CAST(doc_id % 90 + 1 AS STRING), ' ', chr(13), chr(10), ' ', chr(9))
  END) AS completion
FROM documents
"""

# Prediction and gold pairs that reach every grading rule; the last four shapes nest them 1 to 13 deep.
PAIRS = """
WITH k AS (
  SELECT o_orderkey AS pair_id, CAST(o_orderkey % 20 AS INT) AS shape, CAST(o_custkey % 12 + 1 AS INT) AS depth,
         CAST(o_custkey % 40 + 1 AS STRING) AS a, CAST(o_orderkey % 7 + 2 AS STRING) AS b,
         CAST(o_custkey % 40 + 1 + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS STRING) AS v
  FROM orders)
SELECT pair_id,
  CASE shape
    WHEN 0 THEN concat(chr(92), '{', a, ', ', b, chr(92), '}')
    WHEN 1 THEN concat('{', a, ', ', b, ', x+', b, '}')
    WHEN 2 THEN concat('{', a, ',', a, ',', b, '}')
    WHEN 3 THEN concat('((', a, ',', b, '),', a, ')')
    WHEN 4 THEN concat('(', a, ',', b, ')')
    WHEN 5 THEN concat(chr(92), 'text{Blue ', chr(64 + CAST(b AS INT)), '}')
    WHEN 6 THEN concat(chr(92), 'pi')
    WHEN 7 THEN concat('+', a, '.50')
    WHEN 8 THEN a
    WHEN 9 THEN concat('x=', a)
    WHEN 10 THEN concat('(', a, ')')
    WHEN 11 THEN concat(a, '^', chr(92), 'circ')
    WHEN 12 THEN concat('{(1,', a, '),(2,', b, ')}')
    WHEN 13 THEN concat(chr(92), 'mathrm{', chr(92), 'mathbf{P', a, '}}', chr(92), ',q')
    WHEN 14 THEN concat('$', a, '-', b, 'i$')
    WHEN 15 THEN concat('(', a, ',', b, ',1)')
    WHEN 17 THEN concat(repeat('{0,', depth), a, repeat('}', depth))
    WHEN 18 THEN concat(repeat('({2,', depth), a, repeat('},1)', depth))
    ELSE concat(repeat('(0,', depth), a, repeat(')', depth)) END AS gold,
  CASE shape
    WHEN 0 THEN concat(chr(92), '{', b, ', ', v, chr(92), '}')
    WHEN 1 THEN concat('{ x+', b, ' ,', b, '.0, ', v, ' }')
    WHEN 2 THEN concat('{', a, ',', b, ',', CASE WHEN v = a THEN a ELSE b END, '}')
    WHEN 3 THEN concat('( (', a, '.0 , ', b, ') , ', v, '.', ')')
    WHEN 4 THEN concat('(', b, ',', v, ')')
    WHEN 5 THEN concat('{', 'blue', CASE WHEN v = a THEN chr(96 + CAST(b AS INT)) ELSE 'z' END, '}')
    WHEN 6 THEN CASE WHEN v = a THEN concat(chr(92), 'pi') ELSE 'pi' END
    WHEN 7 THEN concat(v, '.5')
    WHEN 8 THEN concat(a, CASE WHEN v = a THEN '.0000000005' ELSE '.000000002' END)
    WHEN 9 THEN a
    WHEN 10 THEN concat(' ', v, chr(9))
    WHEN 11 THEN concat(a, CASE WHEN v = a THEN concat(' ^', chr(92), 'circ') ELSE '' END)
    WHEN 12 THEN concat('{(2,', b, '.0),(1,', v, ')}')
    WHEN 13 THEN concat('P', v, chr(92), ' q')
    WHEN 14 THEN CASE WHEN v = a THEN concat(a, ' - ', b, 'i') ELSE ' ' END
    WHEN 15 THEN concat('(', a, ',', b, ')')
    WHEN 16 THEN concat(repeat('( 0.0 ,', depth), v, '.0', repeat(')', depth))
    WHEN 17 THEN concat(repeat('{ ', depth), v, '.0', repeat(', 0 }', depth))
    WHEN 18 THEN concat(repeat('({', depth), v, repeat(' , 2.0}, 1.0)', depth))
    ELSE concat(repeat('(0,', CASE WHEN v = a THEN depth ELSE depth + 1 END), a, repeat(')', CASE WHEN v = a THEN depth ELSE depth + 1 END)) END AS pred
FROM k
"""

# Ten tokens per sequence; the embedding plays the logits.
TOKENS = """
SELECT CAST(floor(vec_id / 10) AS BIGINT) AS seq_id, CAST(vec_id % 10 AS INT) AS pos,
       CAST(label AS INT) AS target, CAST(embedding AS {double_array}) AS logits,
       CAST(floor(vec_id / 10) % 12 AS INT) AS prompt_len
FROM embeddings
"""

# One chain per user, one block to 2,500 events, steps in event order.  Most steps
# are decided by their proposal ratio, the others propose the state they are in, so
# the state that is carried is known: three of four steps log it, one is off.
MH_STEPS = """
WITH e AS (
  SELECT user_id AS chain_id, CAST(floor(event_id / 2500) AS BIGINT) AS block, event_id AS step, -value AS v,
         event_id % 5 = 0 AS stays, event_id % 3 <> 0 AS takes
  FROM events),
c AS (
  SELECT *, coalesce(last_value(CASE WHEN takes AND NOT stays THEN v END{inside}){outside} OVER (
      PARTITION BY chain_id, block ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
      CAST(-(chain_id % 7) AS DOUBLE)) AS carried
  FROM e)
SELECT chain_id, block, step, CAST(4.0 AS DOUBLE) AS alpha,
       CASE WHEN stays THEN carried ELSE v END AS prop_logp,
       CASE WHEN step % 4 = 1 THEN carried + 0.5 ELSE carried END AS cur_logp,
       CASE WHEN stays THEN CAST(-(step % 13) AS DOUBLE) / 4 WHEN takes THEN 100000.0 ELSE -100000.0 END AS logq_old,
       CAST(-(step % 7) AS DOUBLE) / 4 AS logq_new,
       CASE WHEN step % 97 = 0 AND (takes OR stays) THEN 0.0 ELSE CAST(step % 97 + 1 AS DOUBLE) / 98 END AS u
FROM c
"""

# Pairs of expressions: fractions, decimals, polynomials, one beyond rational functions, parts of a tuple.
EXPRESSIONS = """
WITH k AS (
  SELECT o_orderkey AS pair_id, CAST(o_orderkey % 9 AS INT) AS shape, o_custkey % 40 + 1 AS a, o_orderkey % 7 + 2 AS b,
         o_custkey % 40 + 1 + CASE WHEN o_orderstatus = 'F' THEN 0 ELSE 1 END AS v
  FROM orders)
SELECT pair_id, shape, v = a AS same,
  CASE shape
    WHEN 0 THEN concat(chr(92), 'frac{', a, '}{', b, '}')
    WHEN 1 THEN concat(a, '.5')
    WHEN 2 THEN concat('(x+', a, ')(x-', b, ')')
    WHEN 3 THEN concat('(x+', a, ')^2')
    WHEN 4 THEN concat(chr(92), 'frac{x^2-', a * a, '}{x-', a, '}')
    WHEN 5 THEN concat(a, chr(92), 'pi')
    WHEN 6 THEN concat(chr(92), 'sqrt{', a, '}')
    WHEN 7 THEN concat('(', a, '/2, {1, ', chr(92), 'frac{', a, '}{4}})')
    ELSE concat('x=', a) END AS gold,
  CASE shape
    WHEN 0 THEN concat(3 * v, '/', 3 * b)
    WHEN 1 THEN concat(chr(92), 'frac{', 2 * v + 1, '}{2}')
    WHEN 2 THEN concat('x^2+', v - b, 'x-', v * b)
    WHEN 3 THEN concat('x^{2}+', 2 * v, 'x+', v * v)
    WHEN 4 THEN concat('x+', v)
    WHEN 5 THEN concat(chr(92), 'pi ', chr(92), 'cdot ', v)
    WHEN 6 THEN concat(chr(92), 'sqrt{', v, '}+0')
    WHEN 7 THEN concat('(', v, '*0.5,{0.25*', v, ',2-1})')
    ELSE concat('x=', v, '+0') END AS pred
FROM k
"""

# A log whose decisions depend on the state and whose logged states do not tell it.
MH_BLIND = """
SELECT user_id AS chain_id, CAST(floor(event_id / 2500) AS BIGINT) AS block, event_id AS step, CAST(2.0 AS DOUBLE) AS alpha,
       CAST(-(event_id * 31 % 1009) AS DOUBLE) / 100 - value / 1000 AS prop_logp, CAST(-(event_id % 11) AS DOUBLE) AS cur_logp,
       CAST(event_id % 5 AS DOUBLE) / 4 AS logq_old, CAST(event_id % 3 AS DOUBLE) / 4 AS logq_new,
       CASE WHEN event_id % 101 = 7 THEN 0.0 ELSE CAST(event_id * 7919 % 10007 + 1 AS DOUBLE) / 10009 END AS u
FROM events
"""

# Grading may take half a millisecond a row.
ROWS_A_TASK = 200_000

TABLES = ("lineitem", "documents", "orders", "embeddings", "events", "conversations", "part")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, spread over the cores where its file cannot be split.

    A row group cannot be split, so there may be many splits and rows in a few
    of them only.  Rows are counted from the files' metadata; a table with fewer
    splits than cores, or than tasks of ``ROWS_A_TASK`` rows, is shuffled.
    """
    rows = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    tasks = max(spark.sparkContext.defaultParallelism, -(-rows.count() // ROWS_A_TASK))
    return rows if rows.rdd.getNumPartitions() >= tasks else rows.repartition(tasks, rows.columns[0])


def from_files(spark: SparkSession, sql: str, sf_dir: str) -> DataFrame:
    """Run shared SQL with its table bound to the Parquet files."""
    name = re.search(rf"FROM ({'|'.join(TABLES)})\b", sql)[1]
    view = f"standin_{name}"
    table(spark, sf_dir, name).createOrReplaceTempView(view)
    return spark.sql(re.sub(rf"FROM {name}\b", f"FROM {view}", sql))


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_files(spark, RUNS, sf_dir)


def solutions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_files(spark, SOLUTIONS, sf_dir)


def pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_files(spark, PAIRS, sf_dir)


def tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_files(spark, TOKENS.format(double_array="ARRAY<DOUBLE>"), sf_dir)


# The log of each session and directory, once written.
_LOGS: WeakKeyDictionary[SparkSession, dict[str, str]] = WeakKeyDictionary()


def mh_steps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log as a sampler leaves it behind: written once for each session, since deriving it takes a window over the chains."""
    written = _LOGS.setdefault(spark, {})
    if sf_dir not in written:
        path = f"{shared_folder(spark)}/sampler-log-{uuid.uuid4().hex}"
        from_files(spark, MH_STEPS.format(inside="", outside=" IGNORE NULLS"), sf_dir).write.parquet(path)
        written[sf_dir] = path
    return spark.read.parquet(written[sf_dir])


def mh_blind(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_files(spark, MH_BLIND, sf_dir)


def expressions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_files(spark, EXPRESSIONS, sf_dir)
