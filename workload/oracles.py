"""DuckDB SQL for the registered queries, written independently of them."""

from __future__ import annotations

from workload.queries import MAX_K, NUM_SHARDS, SHARD_HEAD, SHARD_ID, TEMPERATURE
from workload.standins import EXPRESSIONS, MH_BLIND, MH_STEPS, PAIRS, RUNS, SOLUTIONS, TOKENS

ORACLES: dict[str, str] = {}

# White space and line breaks, as RE2 classes and as a character list.
WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
NL = r"[\n\r\x{0b}\x{0c}\x{1c}-\x{1e}\x{85}\x{2028}\x{2029}]"
WS_POINTS = [*range(9, 14), *range(28, 33), 133, 160, 5760, *range(8192, 8203),
             8232, 8233, 8239, 8287, 12288]
WS_CHARS = " || ".join(f"chr({point})" for point in WS_POINTS)
# Braces nested up to three deep, which is more than any stand-in has.
FLAT = r"[^{}]*"
NEST1 = rf"(?:[^{{}}]|\{{{FLAT}\}})*"
NEST2 = rf"(?:[^{{}}]|\{{{NEST1}\}})*"
NEST3 = rf"(?:[^{{}}]|\{{{NEST2}\}})*"

# What marks an answer.
ANSWER = rf"(?im)(?:final answer|answer){WS}*[:\-]{WS}*(.+)$"
HASH = rf"(?m)####{WS}*(.+)$"
TAIL = r"(?s)^.*\\(?:boxed|fbox)\{(.*)$"


def trim(x: str) -> str:
    return f"trim({x}, {WS_CHARS})"


def group(x: str, pattern: str) -> str:
    return f"CASE WHEN regexp_matches({x}, '{pattern}') THEN {trim(f"regexp_extract({x}, '{pattern}', 1)")} END"


SIMPLE_BOX = (
    "CASE WHEN regexp_matches(completion, '\\\\boxed\\{[^}]*\\}') THEN "
    + trim("list_extract(regexp_extract_all(completion, '\\\\boxed\\{([^}]*)\\}', 1), -1)")
    + " END"
)
BALANCED_BOX = (
    f"CASE WHEN regexp_matches(completion, '{TAIL}') THEN "
    + group(f"regexp_extract(completion, '{TAIL}', 1)", rf"^({NEST3})\}}")
    + " END"
)
FALLBACK = (
    f"{group('completion', ANSWER)}, {group('completion', HASH)}, "
    f"list_extract(list_filter(list_transform(string_split_regex(completion, '{NL}'), "
    f"lambda x: {trim('x')}), lambda x: x <> ''), -1), ''"
)
SIMPLE = f"coalesce({SIMPLE_BOX}, {FALLBACK})"
ROBUST = f"coalesce(nullif({BALANCED_BOX}, ''), {FALLBACK})"


def cte(**tables: str) -> str:
    return "WITH " + ", ".join(f"{name} AS ({sql})" for name, sql in tables.items())


def drop(x: str, *literals: str) -> str:
    for literal in literals:
        x = f"replace({x}, '{literal}', '')"
    return x


def squeeze(x: str) -> str:
    return f"regexp_replace({x}, '{WS}+', '', 'g')"


def simple_form(x: str) -> str:
    x = squeeze(drop(trim(x), "$", "\\left", "\\right", "\\,", "\\ "))
    x = f"regexp_replace({x}, '^\\\\boxed\\{{', '')"
    x = f"regexp_replace({x}, '\\}}$', '')"
    return f"regexp_replace({x}, '(?s)^\\((.*)\\)$', '\\1')"


def bare(x: str) -> str:
    x = drop(trim(x), "$", "\\left", "\\right")
    for _ in range(3):
        for command in ("text", "mathrm", "mathbf"):
            x = f"regexp_replace({x}, '\\\\{command}\\{{([^}}]*)\\}}', '\\1', 'g')"
    return squeeze(drop(x, "\\,", "\\ "))


def text_of(b: str) -> str:
    return f"lower(regexp_replace({b}, '(?s)^\\{{(.*)\\}}$', '\\1'))"


def is_number(b: str) -> str:
    return f"regexp_full_match({b}, '[+-]?([0-9]+(\\.[0-9]*)?|\\.[0-9]+)')"


def number(b: str) -> str:
    return f"TRY_CAST({b} AS DOUBLE)"


def scalar_match(p: str, g: str) -> str:
    """Rules without tuples and sets, on bare forms."""
    return (
        f"CASE WHEN {p} = {g} THEN true"
        f" WHEN regexp_matches({g}, '[A-Za-z]') AND NOT regexp_matches({g}, '[0-9=+\\-*/^]')"
        f" THEN {text_of(p)} = {text_of(g)}"
        f" WHEN {is_number(p)} AND {is_number(g)} THEN abs({number(p)} - {number(g)}) <= 1e-9"
        f" ELSE regexp_replace({p}, '(?s)^\\((.*)\\)$', '\\1')"
        f" = regexp_replace({g}, '(?s)^\\((.*)\\)$', '\\1') END"
    )


def parts(b: str) -> str:
    """Top-level parts of a bracketed text whose parts are at most tuples."""
    return f"regexp_extract_all({b}[2:-2], '\\([^()]*\\)|\\\\[a-z]+\\{{[^{{}}]*\\}}\\{{[^{{}}]*\\}}|[^,]+')"


def canonical(b: str) -> str:
    """Sort key that is equal exactly for the parts that agree in the stand-in."""
    plain = f"coalesce(CAST({number(b)} AS VARCHAR), {b})"
    member = "coalesce(CAST(TRY_CAST(y AS DOUBLE) AS VARCHAR), y)"
    return (
        f"CASE WHEN {b}[1] = '(' THEN array_to_string(list_transform("
        f"string_split({b}[2:-2], ','), lambda y: {member}), ';') ELSE {plain} END"
    )


def both(p: str, g: str, left: str, right: str) -> str:
    return " AND ".join(
        f"starts_with({x}, '{left}') AND ends_with({x}, '{right}')" for x in (p, g)
    )


def leaves(b: str) -> str:
    """Depth and value of everything between the brackets, sorted; in towers these tell whether two agree."""
    tokens = f"regexp_extract_all({b}, '[(){{}},]|[^(){{}},]+')"
    depth = "len(list_filter(t[:i], lambda x: x IN ('(', '{'))) - len(list_filter(t[:i], lambda x: x IN (')', '}')))"
    value = "coalesce(CAST(TRY_CAST(t[i] AS DOUBLE) AS VARCHAR), t[i])"
    return (
        f"(SELECT list_sort(list_transform(list_filter(range(1, len(t) + 1), lambda i: NOT regexp_matches(t[i], '^[(){{}},]$')), "
        f"lambda i: concat({depth}, ':', {value}))) FROM (SELECT {tokens} AS t))"
    )


MATCH = f"""CASE
  WHEN {trim("coalesce(pred, '')")} = '' OR {trim("coalesce(gold, '')")} = '' THEN false
  WHEN p0 = g0 THEN true
  WHEN regexp_matches(g0, '[A-Za-z]') AND NOT regexp_matches(g0, '[0-9=+\\-*/^]')
    THEN {text_of('p0')} = {text_of('g0')}
  WHEN regexp_matches(g0, '^([(][{{]|[({{][0][,])') AND {both('p0', 'g0', '(', ')')} OR {both('p0', 'g0', '{', '}')} AND starts_with(g0, '{{0,')
    THEN {leaves('p0')} = {leaves('g0')}
  WHEN {both('p0', 'g0', '(', ')')} AND len({parts('p0')}) = len({parts('g0')})
    THEN list_bool_and(list_transform(list_zip({parts('p0')}, {parts('g0')}), lambda z:
      CASE WHEN {both('z[1]', 'z[2]', '(', ')')}
        THEN {canonical('z[1]')} = {canonical('z[2]')}
        ELSE {scalar_match('z[1]', 'z[2]')} END))
  WHEN {both('p0', 'g0', '{', '}')} AND len({parts('p0')}) = len({parts('g0')})
    THEN list_sort(list_transform({parts('p0')}, lambda x: {canonical('x')}))
       = list_sort(list_transform({parts('g0')}, lambda x: {canonical('x')}))
  ELSE {scalar_match('p0', 'g0')} END"""

PAIR_BARE = f"SELECT *, {bare('pred')} AS p0, {bare('gold')} AS g0 FROM pairs"
GRADED_PAIRS = cte(pairs=PAIRS, bared=PAIR_BARE)

EXTRACTED = f"SELECT *, {ROBUST} AS pred FROM runs"
RUN_BARE = f"SELECT *, {bare('pred')} AS p0, {bare('gold')} AS g0 FROM extracted"
GRADED = cte(
    runs=RUNS,
    extracted=EXTRACTED,
    bared=RUN_BARE,
    graded=f"SELECT *, CAST({MATCH} AS INT) AS correct_eval, pred AS pred_eval FROM bared",
)
RUN_KEYS = "method, seed, example_id, gold"

# --- extraction -----------------------------------------------------------

for name, expression in {
    "extract_boxed_simple": SIMPLE_BOX,
    "extract_simple": SIMPLE,
    "extract_boxed_balanced": BALANCED_BOX,
    "extract_robust": ROBUST,
}.items():
    ORACLES[name] = f"{cte(runs=RUNS)} SELECT {RUN_KEYS}, {expression} AS answer FROM runs"
    ORACLES[f"{name}_documents"] = (
        f"{cte(solutions=SOLUTIONS)} SELECT doc_id, {expression} AS answer FROM solutions"
    )

# --- normalisation --------------------------------------------------------


def both_sides(form, name: str) -> str:
    return (
        f"{cte(pairs=PAIRS)} SELECT pair_id, {form('pred')} AS pred_{name}, "
        f"{form('gold')} AS gold_{name} FROM pairs"
    )


def expression_form(x: str) -> str:
    x = bare(x)
    for latex, plain in (
        ("^\\circ", "*pi/180"), ("\\cdot", "*"), ("\\times", "*"), ("\\pi", "pi"),
        ("^", "**"), ("{", "("), ("}", ")"), ("\\!", ""),
    ):
        x = f"replace({x}, '{latex}', '{plain}')"
    return x


ORACLES["normalize_simple"] = both_sides(simple_form, "simple")
ORACLES["strip_wrappers"] = both_sides(bare, "bare")
ORACLES["normalize_text"] = both_sides(lambda x: text_of(bare(x)), "text")
ORACLES["latex_to_expr"] = both_sides(expression_form, "expr")
ORACLES["number_like"] = f"""{GRADED_PAIRS}
SELECT pair_id, {is_number('p0')} AS pred_is_number, {number('p0')} AS pred_value,
       {is_number('g0')} AS gold_is_number, {number('g0')} AS gold_value FROM bared"""

# Character by character: the depth, floored at 0, and the commas at depth 0.
ORACLES["split_commas"] = f"""{GRADED_PAIRS},
texts AS (
  SELECT 'gold' AS source, pair_id AS id,
         regexp_replace(g0, '^[({{](.*)[)}}]$', '\\1') AS text FROM bared
  UNION ALL SELECT 'document', doc_id, text FROM documents),
characters AS (
  SELECT source, id, unnest(string_split(text, '')) AS ch,
         generate_subscripts(string_split(text, ''), 1) AS i FROM texts),
levels AS (
  SELECT *, sum(CASE WHEN ch IN ('(', '[', '{{') THEN 1 WHEN ch IN (')', ']', '}}') THEN -1
                ELSE 0 END) OVER (PARTITION BY source, id ORDER BY i) AS level FROM characters),
commas AS (
  SELECT *, ch = ',' AND level = least(0, min(level) OVER (PARTITION BY source, id ORDER BY i))
            AS ends FROM levels),
parts AS (
  SELECT *, count(*) FILTER (WHERE ends) OVER (PARTITION BY source, id ORDER BY i) AS part
  FROM commas),
joined AS (
  SELECT source, id, part,
         {trim("coalesce(string_agg(ch, '' ORDER BY i) FILTER (WHERE NOT ends), '')")} AS text
  FROM parts GROUP BY source, id, part)
SELECT source, id,
       CAST(row_number() OVER (PARTITION BY source, id ORDER BY part) - 1 AS INT) AS part_no,
       text AS part
FROM joined WHERE text <> ''"""

# The very deep commands, whose outcome is known, stand in front.
_DEEP = "concat(repeat('{', 50), gold, repeat('}', 50))"
_FRONT = "CASE WHEN seed IS NULL THEN concat({}, CASE WHEN text <> '' THEN '+' ELSE '' END) ELSE '' END"
_FRAC = f"'\\\\d?frac\\{{({NEST3})\\}}\\{{({NEST3})\\}}', '((\\1))/((\\2))', 'g'"
_INNER = _DEEP.replace("gold", f"regexp_replace(gold, {_FRAC})")  # within a root a fraction is an outermost one
_DEEP_FRAC = _FRONT.format(f"'((', {_DEEP}, '))/((7))+\\sqrt{{', {_INNER}, '}}'")
_DEEP_ROOT = _FRONT.format(f"'\\dfrac{{', {_DEEP}, '}}{{7}}+sqrt((', {_DEEP}, '))'")
LATEX_SUM = """SELECT method, seed, example_id, gold, concat_ws('+', completion,
  concat('\\dfrac{{', gold, '}}{\\sqrt{2}}'), concat('\\sqrt{x+\\sqrt{', gold, '}}'),
  CASE WHEN seed = 1 THEN '\\sqrt{open \\sqrt{3} \\frac{4}' END) AS text FROM runs"""
ORACLES["replace_frac"] = f"""{cte(runs=RUNS, sums=LATEX_SUM)}
SELECT {RUN_KEYS}, concat({_DEEP_FRAC}, regexp_replace(text, '\\\\d?frac\\{{({NEST3})\\}}\\{{({NEST3})\\}}',
  '((\\1))/((\\2))', 'g')) AS expr FROM sums"""
# The stand-in's only unclosed root is the literal one at its end.
_HEAD = "CASE WHEN seed = 1 THEN regexp_extract(text, '(?s)^(.*)\\\\sqrt\\{open', 1) ELSE text END"
_ROOT = f"'\\\\sqrt\\{{({NEST3})\\}}', 'sqrt((\\1))', 'g'"
ORACLES["replace_sqrt"] = f"""{cte(runs=RUNS, sums=LATEX_SUM)}
SELECT {RUN_KEYS}, concat({_DEEP_ROOT}, regexp_replace(regexp_replace({_HEAD}, {_ROOT}), {_ROOT}),
  CASE WHEN seed = 1 THEN '\\sqrt{{open \\sqrt{{3}} \\frac{{4}}' ELSE '' END) AS expr FROM sums"""

# --- grading --------------------------------------------------------------

ORACLES["grade_simple"] = f"""{cte(runs=RUNS, extracted=f"SELECT *, {SIMPLE} AS pred FROM runs")}
SELECT {RUN_KEYS}, pred,
       CAST({simple_form('pred')} = {simple_form("coalesce(gold, '')")} AS INT) AS correct FROM extracted"""
ORACLES["grade_equiv"] = (
    f"{GRADED_PAIRS} SELECT pair_id, pred, gold, CAST({MATCH} AS INT) AS correct FROM bared"
)
ORACLES["grade_equiv_column"] = (
    f"{GRADED_PAIRS} SELECT pair_id, {MATCH} AS matches FROM bared"
)
ORACLES["grade_runs"] = f"{GRADED} SELECT {RUN_KEYS}, pred_eval, correct_eval FROM graded"
ORACLES["grade_dedup"] = ORACLES["grade_memo"] = ORACLES["grade_runs"]
# All shapes are equal where their numbers are, but for the root and the equation, which stay texts.
ORACLES["grade_identity"] = f"""{cte(expressions=EXPRESSIONS)}
SELECT pair_id, pred, gold, CAST(same AND shape NOT IN (6, 8) AS INT) AS correct FROM expressions"""
ORACLES["grade_dedup_counts"] = f"""{GRADED}
SELECT method, seed, count(*) AS n, CAST(sum(correct_eval) AS BIGINT) AS c
FROM graded GROUP BY method, seed"""

# --- accuracy -------------------------------------------------------------

ORACLES["accuracy_overall"] = f"""{GRADED}
SELECT count(*) AS n, round(coalesce(avg(correct_eval), 0), 9) AS accuracy FROM graded"""
ORACLES["accuracy_by_method"] = f"""{GRADED}
SELECT method, count(*) AS n, round(avg(correct_eval), 9) AS accuracy
FROM graded WHERE method IS NOT NULL GROUP BY method"""
ORACLES["accuracy_by_seed"] = f"""{GRADED}
SELECT CAST(seed AS VARCHAR) AS seed, count(*) AS n, round(avg(correct_eval), 9) AS accuracy
FROM graded WHERE seed IS NOT NULL GROUP BY seed"""
ORACLES["accuracy_cube"] = f"""{GRADED}
SELECT 'all' AS level, CAST(NULL AS VARCHAR) AS key, count(*) AS n,
       round(coalesce(avg(correct_eval), 0), 9) AS accuracy FROM graded
UNION ALL SELECT 'method', method, count(*), round(avg(correct_eval), 9)
FROM graded WHERE method IS NOT NULL GROUP BY method
UNION ALL SELECT 'seed', CAST(seed AS VARCHAR), count(*), round(avg(correct_eval), 9)
FROM graded WHERE seed IS NOT NULL GROUP BY seed"""
ORACLES["distinct_examples"] = (
    f"{cte(runs=RUNS)} SELECT count(DISTINCT example_id) AS n_examples FROM runs"
)
ORACLES["method_series"] = f"""{GRADED}
SELECT position, l.method, round(coalesce(100 * avg(correct_eval), 0), 9) AS accuracy_pct
FROM (VALUES (0, 'base'), (1, 'lowtemp'), (2, 'power_mh'), (3, 'not_run')) l(position, method)
LEFT JOIN graded g ON g.method = l.method GROUP BY position, l.method"""
ORACLES["sweep_accuracy"] = f"""{GRADED}
SELECT n_mcmc, count(*) AS n, round(100 * avg(correct_eval), 9) AS accuracy_pct
FROM graded GROUP BY n_mcmc"""
ORACLES["per_example"] = f"""{GRADED}
SELECT coalesce(example_id, '') AS example_id, coalesce(seed, -1) AS seed,
       coalesce(method, '') AS method, correct_eval AS correct,
       coalesce(gold, '') AS gold, pred_eval AS pred FROM graded"""

# --- pass@k ---------------------------------------------------------------

COUNTS = """SELECT method, example_id, count(*) AS n, CAST(sum(correct_eval) AS BIGINT) AS c
FROM graded WHERE method IS NOT NULL AND example_id IS NOT NULL GROUP BY method, example_id"""
# C(n-c, k) / C(n, k) as a product over the c correct samples.
ESTIMATE = """CASE WHEN n < k THEN NULL WHEN c = 0 THEN 0.0 WHEN n - c < k THEN 1.0
  ELSE 1.0 - list_product(list_transform(range(n - c + 1, n + 1), lambda i: 1.0 - CAST(k AS DOUBLE) / i)) END"""


def points(max_k: int, graded: str = GRADED) -> str:
    return f"""{graded}, counts AS ({COUNTS}),
points AS (SELECT method, example_id, n, c, CAST(k AS INT) AS k, {ESTIMATE} AS v
           FROM counts, range(1, {max_k + 1}) r(k))"""


CURVE = """SELECT method, k, count(v) AS examples, round(avg(v), 9) AS pass_at_k
FROM points GROUP BY method, k"""
ORACLES["outcome_counts"] = f"{GRADED} {COUNTS}"
ORACLES["pass_at_k_per_example"] = f"""{points(MAX_K)}
SELECT method, example_id, n, c, k, round(v, 9) AS pass_at_k FROM points"""
ORACLES["pass_at_k_curve"] = f"{points(MAX_K)} {CURVE} HAVING count(v) > 0"
ORACLES["pass_at_k_grid"] = f"{points(40)} {CURVE}"
ORACLES["pass_at_k_orders"] = f"""{points(MAX_K, '''WITH graded AS (
  SELECT o_orderpriority AS method, CAST(o_custkey AS VARCHAR) AS example_id,
         CAST(o_orderstatus = 'F' AS INT) AS correct_eval FROM orders)''')}
{CURVE} HAVING count(v) > 0"""

_ENTRIES = """(SELECT string_agg(concat(k, '=', CAST(CAST(round(a * 1e9) AS BIGINT) AS VARCHAR)), ',' ORDER BY k)
   FROM (SELECT CAST({key} AS VARCHAR) AS k, avg(correct_eval) AS a FROM graded WHERE {key} IS NOT NULL GROUP BY {key}))"""
ORACLES["scores_summary"] = f"""{GRADED}
SELECT count(*) AS n, round(coalesce(avg(correct_eval), 0), 9) AS accuracy,
       {_ENTRIES.format(key='method')} AS accuracy_by_method,
       {_ENTRIES.format(key='seed')} AS accuracy_by_seed
FROM graded"""

# --- run tables, prompts, shards -------------------------------------------

ORACLES["merge_runs"] = f"""{cte(runs=RUNS)}
SELECT method, example_id, seed, completion,
       CASE WHEN method <> 'base' THEN gold END AS gold,
       CASE WHEN method = 'power_mh' THEN n_mcmc END AS n_mcmc FROM runs"""
ORACLES["run_params"] = f"""{cte(runs=RUNS)}
SELECT method, seed, example_id, CAST(4 AS DOUBLE) AS alpha,
       CAST(CASE method WHEN 'power_mh' THEN 192 ELSE 0 END AS INT) AS B,
       CAST(CASE method WHEN 'power_mh' THEN 10 ELSE 0 END AS INT) AS n_mcmc,
       CAST(CASE method WHEN 'base' THEN 1 ELSE 0.25 END AS DOUBLE) AS temperature FROM runs"""
# The prompt texts.
_SYSTEM = "'You are a helpful assistant.'"
_SENTENCE = "Solve the following math problem. Please reason step by step, and put your final answer within \\boxed{}."
_TASK = f"concat('{_SENTENCE}', chr(10), chr(10), 'Problem:', chr(10), text)"
ORACLES["prompt_messages"] = f"""
SELECT doc_id, 0 AS position, 'system' AS role, {_SYSTEM} AS content FROM documents
UNION ALL SELECT doc_id, 1, 'user', {_TASK} FROM documents"""
ORACLES["prompt_flat"] = f"""
SELECT doc_id, concat({_SYSTEM}, chr(10), {_TASK}, chr(10)) AS prompt FROM documents"""
ORACLES["prompt_transcript"] = f"""
SELECT conv_id, turn, concat('<|system|>', chr(10), {_SYSTEM}, chr(10), '<|user|>', chr(10),
  {_TASK}, chr(10)) AS prompt FROM conversations"""
_SHARD = f"""WITH d AS (
  SELECT doc_id, text, row_number() OVER (ORDER BY doc_id) - 1 AS position FROM documents)
SELECT doc_id, text, position FROM d WHERE position % {NUM_SHARDS} = {SHARD_ID}"""
ORACLES["shard_mod"] = _SHARD
ORACLES["shard_head"] = f"{_SHARD} ORDER BY position LIMIT {SHARD_HEAD}"
ORACLES["shard_mod_file_order"] = _SHARD

# --- token likelihoods -----------------------------------------------------


def scored(temperature: float) -> str:
    z = f"list_transform(logits, lambda x: x / {temperature})"
    return cte(
        tokens=TOKENS.format(double_array="DOUBLE[]"),
        scaled=f"SELECT *, {z} AS z FROM tokens",
        peaks="SELECT *, list_max(z) AS peak FROM scaled",
        sums="SELECT *, peak + ln(list_sum(list_transform(z, lambda x: exp(x - peak)))) AS lse FROM peaks",
        scored="""SELECT *, z[target + 1] - lse AS lp,
          -list_sum(list_transform(z, lambda x: exp(x - lse) * (x - lse))) AS entropy FROM sums""",
    )


ORACLES["token_logprob"] = (
    f"{scored(TEMPERATURE)} SELECT seq_id, pos, round(lp, 9) AS logprob FROM scored"
)
ORACLES["token_entropy"] = (
    f"{scored(1.0)} SELECT seq_id, pos, round(entropy, 9) AS entropy FROM scored"
)
ORACLES["seq_logprob"] = f"""{scored(1.0)}
SELECT seq_id, round(coalesce(sum(lp) FILTER (WHERE pos >= 1), 0), 9) AS logprob
FROM scored GROUP BY seq_id"""
ORACLES["suffix_logprob"] = f"""{scored(TEMPERATURE)},
s AS (SELECT seq_id, coalesce(sum(lp) FILTER (WHERE pos >= prompt_len AND pos >= 1), 0) AS total,
             count(*) FILTER (WHERE pos >= prompt_len) AS n_tokens FROM scored GROUP BY seq_id)
SELECT seq_id, n_tokens, round(total, 9) AS logprob_sum,
       round(total / greatest(n_tokens, 1), 9) AS logprob_avg FROM s"""
ORACLES["avg_entropy"] = f"""{scored(1.0)}
SELECT seq_id, round(coalesce(avg(entropy) FILTER (WHERE pos >= greatest(prompt_len, 1)), 0), 9)
  AS avg_entropy FROM scored GROUP BY seq_id"""

# --- sampler log -----------------------------------------------------------

ORACLES["block_schedule"] = """
SELECT doc_id, n_chars AS length, b AS block, least(b * 192, n_chars) AS block_end
FROM (SELECT doc_id, n_chars,
             unnest(range(1, CAST(ceil(n_chars / 192.0) AS BIGINT) + 1)) AS b FROM documents)"""
ACCEPTANCE = cte(
    steps=MH_STEPS.format(inside=" IGNORE NULLS", outside=""),
    ratios="SELECT *, alpha * (prop_logp - cur_logp) + (logq_old - logq_new) AS la FROM steps",
    accepted="SELECT *, CASE WHEN u > 0 THEN ln(nullif(u, 0)) < least(0.0, la) ELSE true END AS ok FROM ratios",
)
ORACLES["mh_log_accept"] = f"""{ACCEPTANCE}
SELECT chain_id, block, step, round(la, 9) AS log_accept, ok AS accepted FROM accepted"""
ORACLES["accept_rate"] = f"""{ACCEPTANCE}
SELECT chain_id, count(*) AS n_steps, count(*) FILTER (WHERE ok) AS n_accepted,
       round(count(*) FILTER (WHERE ok) / CAST(count(*) AS DOUBLE), 9) AS accept_rate
FROM accepted GROUP BY chain_id"""
ORACLES["mh_state_carry"] = f"""{ACCEPTANCE},
carried AS (
  SELECT *, coalesce(
    last_value(CASE WHEN ok THEN prop_logp END IGNORE NULLS) OVER (
      PARTITION BY chain_id, block ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
    first_value(cur_logp) OVER (PARTITION BY chain_id, block ORDER BY step)) AS expected
  FROM accepted)
SELECT chain_id, block, step, round(expected, 9) AS expected_logp,
       abs(expected - cur_logp) <= 1e-9 AS consistent FROM carried"""

# Step by step, each from the state that the one before it leaves.
ORACLES["mh_replay"] = f"""WITH RECURSIVE steps AS ({MH_BLIND}),
placed AS (SELECT *, row_number() OVER (PARTITION BY chain_id, block ORDER BY step) AS place FROM steps),
walk AS (
  SELECT chain_id, block, place, cur_logp AS x FROM placed WHERE place = 1
  UNION ALL
  SELECT w.chain_id, w.block, w.place + 1,
    CASE WHEN u <= 0 OR ln(nullif(u, 0)) < least(0.0, alpha * (prop_logp - x) + (logq_old - logq_new)) THEN prop_logp ELSE x END
  FROM walk w JOIN placed p USING (chain_id, block, place))
SELECT chain_id, block, step, round(x, 9) AS replay_logp,
  u <= 0 OR ln(nullif(u, 0)) < least(0.0, alpha * (prop_logp - x) + (logq_old - logq_new)) AS replay_accepted
FROM walk JOIN placed USING (chain_id, block, place)"""

_METHOD = "CASE doc_id % 3 WHEN 0 THEN 'base' WHEN 1 THEN 'lowtemp' ELSE 'power_mh' END"
ORACLES["run_rows"] = f"""
WITH likelihoods AS ({ORACLES["suffix_logprob"]}), entropies AS ({ORACLES["avg_entropy"]}),
rates AS ({ORACLES["accept_rate"]}), solutions AS ({SOLUTIONS}),
extracted AS (SELECT *, {SIMPLE} AS pred, {_METHOD} AS method FROM solutions)
SELECT doc_id, method, CAST(4 AS DOUBLE) AS alpha,
       CAST(CASE method WHEN 'power_mh' THEN 192 ELSE 0 END AS INT) AS B,
       CAST(CASE method WHEN 'power_mh' THEN 10 ELSE 0 END AS INT) AS n_mcmc,
       CAST(CASE method WHEN 'base' THEN 1 ELSE 0.25 END AS DOUBLE) AS temperature,
       pred, CAST({simple_form('pred')} = {simple_form('gold')} AS INT) AS correct,
       coalesce(n_tokens, 0) AS num_tokens_generated,
       CASE WHEN method = 'power_mh' THEN coalesce(accept_rate, 0) ELSE 0 END AS accept_rate,
       coalesce(logprob_sum, 0) AS base_loglik_sum, coalesce(logprob_avg, 0) AS base_loglik_avg,
       coalesce(avg_entropy, 0) AS avg_entropy
FROM extracted LEFT JOIN likelihoods l ON l.seq_id = doc_id LEFT JOIN entropies e ON e.seq_id = doc_id
LEFT JOIN rates ON chain_id = doc_id"""
