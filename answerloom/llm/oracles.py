"""DuckDB SQL for the queries of this package that SQL can express."""

from __future__ import annotations

# Seats are given out one by one here, in the order of their quotients; 64 shards share them in that order.
MIX_SOURCES = r"""
WITH sized AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
sizes AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1 AS rank FROM sizes),
weighted AS (
  SELECT *, CASE rank % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight, 2.0::DOUBLE * source_size AS most FROM ranked),
levels AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER filled, 0.0))
            / (sum(weight) OVER () - coalesce(sum(weight) OVER filled, 0)) AS level
  FROM weighted
  WINDOW filled AS (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, rank, least(most, max(level) OVER () * weight) AS target FROM levels),
seats AS (
  SELECT rank, k, row_number() OVER (ORDER BY target / (2 * k + 1) DESC, rank, k) AS place
  FROM targets, unnest(range(CAST(target / 16 AS BIGINT) + 20)) AS t(k) WHERE target > 0),
house AS (SELECT CAST(round(sum(target) / 16) AS BIGINT) AS blocks FROM targets),
won AS (SELECT rank, k, CAST((place - 1) // CAST(ceil(blocks / 64) AS BIGINT) AS INT) AS shard FROM seats, house WHERE place <= blocks),
budgets AS (SELECT rank, 16 * count(*) AS budget FROM won GROUP BY rank),
placed AS (
  SELECT doc_id, source, size, coalesce(sum(size) OVER (
      PARTITION BY source ORDER BY md5(concat('7:', coalesce(CAST(doc_id AS VARCHAR), ''))), doc_id NULLS FIRST, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start
  FROM sized)
SELECT doc_id, size, source_size, target,
  CAST(greatest(0, least(size, coalesce(budget, 0) - start))
     + greatest(0, least(size, coalesce(budget, 0) - source_size - start)) AS BIGINT) AS taken,
  CASE WHEN size > 0 THEN shard END AS first_shard
FROM placed JOIN targets ON placed.source IS NOT DISTINCT FROM targets.source LEFT JOIN budgets USING (rank)
LEFT JOIN won ON won.rank = targets.rank AND won.k = start // 16
"""

# Base32 by hand: five bits of the SHA-1 at a time.
WARC_PAGES = """
WITH payloads AS (
  SELECT page_id, coalesce(html, '') AS payload, CAST(CAST(unhex(sha1(coalesce(html, ''))) AS BIT) AS VARCHAR) AS bits FROM pages),
firsts AS (SELECT bits, max(page_id) AS first FROM payloads GROUP BY bits),
coded AS (
  SELECT page_id, strlen(payload) AS payload_bytes, first,
    array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + 16 * CAST(bits[5 * i + 1] AS INT) + 8 * CAST(bits[5 * i + 2] AS INT) + 4 * CAST(bits[5 * i + 3] AS INT)
        + 2 * CAST(bits[5 * i + 4] AS INT) + CAST(bits[5 * i + 5] AS INT), 1)), '') AS payload_digest
  FROM payloads JOIN firsts USING (bits))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
FROM coded
"""


def _crc_table() -> str:
    """The 256 steps of CRC-32, as a list."""
    table = []
    for c in range(256):
        for _ in range(8):
            c = (c >> 1) ^ (0xEDB88320 if c & 1 else 0)
        table.append(c)
    return f"{table}::BIGINT[]"


def crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of ``text``, byte by byte."""
    pairs = f"regexp_extract_all(hex(encode({text})), '..')"
    values = f"list_transform({pairs}, lambda p: CAST(concat('0x', p) AS BIGINT))"
    step = f"lambda c, b: xor(c >> 8, ({_crc_table()})[(xor(c, b) & 255) + 1])"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {values}), {step}), 4294967295)"


def _leaf(text: str) -> str:
    fields = ("doc_id", "source", "lang", "n_chars", text)
    return "sha256(concat(" + ", ".join(
        f"coalesce(concat(strlen(CAST({x} AS VARCHAR)), ':', CAST({x} AS VARCHAR)), '-')" for x in fields
    ) + "))"


def _levels(name: str, base: str) -> str:
    """All levels above the nodes ``base`` (g, idx, n, d), and each node's siblings to its left and right."""
    return f"""
{name}(level, g, idx, n, d) AS (
  SELECT 0, g, idx, n, d FROM {base}
  UNION ALL
  SELECT level + 1, g, idx // 8, (n + 7) // 8, sha256(string_agg(d, '' ORDER BY idx)) FROM {name}
  WHERE n > 1 GROUP BY level, g, idx // 8, n),
{name}_runs AS (SELECT level, g, idx // 8 AS up, list(d ORDER BY idx) AS run FROM {name} WHERE n > 1 GROUP BY ALL),
{name}_steps AS (
  SELECT t.level, g, idx, array_to_string(run[:idx % 8], '') AS before, array_to_string(run[idx % 8 + 2:], '') AS behind
  FROM {name} t JOIN {name}_runs r USING (level, g) WHERE t.n > 1 AND r.up = t.idx // 8)"""


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT *, dense_rank() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS g,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n
  FROM (SELECT doc_id, lang, {_leaf('text')} AS leaf,
    CASE WHEN {crc32("CAST(doc_id AS VARCHAR)")} % 3 = 0
         THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS altered FROM documents)),
bottom AS (SELECT g, idx, n, leaf AS d FROM leaves),
{_levels('lower_tree', 'bottom')},
subroots AS (SELECT 0 AS g, g AS idx, count(*) OVER () AS n, d FROM lower_tree WHERE n = 1),
{_levels('upper_tree', 'subroots')},
steps AS (
  SELECT l.g, l.idx, 0 AS tree, s.level, s.before, s.behind FROM leaves l JOIN lower_tree_steps s
    ON s.g = l.g AND s.idx = l.idx // CAST(pow(8, s.level) AS BIGINT)
  UNION ALL
  SELECT l.g, l.idx, 1, s.level, s.before, s.behind FROM leaves l JOIN upper_tree_steps s ON s.idx = l.g // CAST(pow(8, s.level) AS BIGINT)),
ways AS (
  SELECT g, idx, sha256(string_agg(concat(before, behind), '' ORDER BY tree, level)) AS proof,
    list(concat(before, '|', behind) ORDER BY tree, level) AS way FROM steps GROUP BY g, idx),
folded AS (
  SELECT l.*, coalesce(proof, sha256('')) AS proof_sha256,
    list_reduce(coalesce(way, []), lambda node, step: sha256(replace(step, '|', node)), coalesce(altered, leaf)) AS folded_root
  FROM leaves l LEFT JOIN ways USING (g, idx))
SELECT doc_id, leaf, s.d AS subroot, r.d AS root, proof_sha256, folded_root, folded_root = r.d AS verified
FROM folded f JOIN subroots s ON s.idx = f.g JOIN (SELECT d FROM upper_tree WHERE n = 1) r ON true
"""

# Every n-gram of a table counts; each different one is hashed once.
_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
RESAMPLE = f"""
WITH docs AS (SELECT doc_id, row_number() OVER () AS nr, {_WORDS} AS w FROM documents),
tests AS (SELECT {_WORDS} AS w FROM benchmark),
grams AS (
  SELECT nr, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: concat(w[i], ' ', w[i + 1])),
    list_transform(range(1, len(w) - 1), lambda i: concat(w[i], ' ', w[i + 1], ' ', w[i + 2])))) AS gram
  FROM (SELECT nr, w FROM docs UNION ALL SELECT NULL, w FROM tests)),
buckets AS (SELECT gram, {crc32("gram")} % 10000 AS bucket FROM (SELECT DISTINCT gram FROM grams)),
counts AS (
  SELECT bucket, CAST(count(nr) AS DOUBLE) AS s, CAST(count(*) - count(nr) AS DOUBLE) AS t
  FROM grams JOIN buckets USING (gram) GROUP BY bucket),
gains AS (
  SELECT bucket, CAST(floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000)))) AS BIGINT) AS gain FROM counts),
sums AS (
  SELECT nr, count(*) AS n_features, CAST(sum(gain) AS BIGINT) AS weight
  FROM grams JOIN buckets USING (gram) JOIN gains USING (bucket) WHERE nr IS NOT NULL GROUP BY nr),
scored AS (
  SELECT doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST(concat('0x', sha256(concat('42:', coalesce(CAST(doc_id AS VARCHAR), '')))[:8]) AS BIGINT) + 0.5::DOUBLE)
      / 4294967296.0::DOUBLE))) AS BIGINT) AS score
  FROM docs LEFT JOIN sums USING (nr)),
drawn AS (
  SELECT *, row_number() OVER (PARTITION BY n_words >= 20 ORDER BY score DESC, doc_id NULLS FIRST) AS place,
    count(*) FILTER (WHERE n_words >= 20) OVER () AS n FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND place <= 5 * n // 100 THEN place END AS rank FROM drawn
"""

# Every string of 50 bytes, in hex; the remaining bytes are put together from what lies between the removed runs.
REPEATS = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
strings AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS g FROM texts, unnest(range(len(h) // 2 - 49)) AS r(i)),
firsts AS (SELECT g, min(doc_id) AS first FROM strings GROUP BY g),
hits AS (SELECT doc_id, i, i > lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 AS apart FROM strings JOIN firsts USING (g) WHERE first < doc_id),
runs AS (SELECT doc_id, i, count(*) FILTER (WHERE apart) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits),
spans AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY doc_id, run),
cut AS (SELECT *, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans),
gone AS (
  SELECT doc_id, sum(b - a) AS n, count(*) AS k, max(b) AS last, string_agg(substr(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS front
  FROM cut JOIN texts USING (doc_id) GROUP BY doc_id)
SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, coalesce(k, 0) AS n_spans,
  sha256(unhex(concat(front, substr(h, 2 * coalesce(last, 0) + 1)))) AS kept_sha256
FROM texts LEFT JOIN gone USING (doc_id)
"""

# Words and lines one by one; a word counts once, however many repeated windows hold it.
QUALITY_BASE = r"""
WITH texts AS (
  SELECT row_number() OVER () AS nr, doc_id, coalesce(text, '') AS text,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
positions AS (SELECT nr, unnest(range(1, len(w) - 1)) AS i, w FROM texts),
windows AS (SELECT nr, i, concat(w[i], ' ', w[i + 1], ' ', w[i + 2]) AS g FROM positions),
counted AS (SELECT nr, i, count(*) OVER (PARTITION BY nr, g) > 1 AS again FROM windows),
repeated AS (SELECT nr, count(DISTINCT i + k) AS n FROM counted, unnest([0, 1, 2]) AS t(k) WHERE again GROUP BY nr),
lines AS (SELECT nr, unnest(string_split(text, chr(10))) AS line FROM texts),
doubled AS (SELECT nr, count(*) - count(DISTINCT line) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY nr)
SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
  length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(d.n, 0) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words,
  len(w) < 50 OR 100 * coalesce(r.n, 0) > 50 * len(w) AS base_failed
FROM texts LEFT JOIN repeated r USING (nr) LEFT JOIN doubled d USING (nr)
"""

DOCUMENT_SIZES = f"""
SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size, {crc32("coalesce(text, '')")} AS text_crc32 FROM documents
"""

ORACLES = {
    "op7_suffix_dedup": REPEATS, "quality_base_counts": QUALITY_BASE, "document_sizes": DOCUMENT_SIZES,
    "op2_mix_sources": MIX_SOURCES, "op6_warc": WARC_PAGES, "op11_merkle_manifest": MERKLE, "op13_importance_resample": RESAMPLE,
}
