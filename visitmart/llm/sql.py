"""DuckDB SQL for the queries of this subpackage that SQL can express.

Token counts, SimHash (XXH64), language ID, the classifier, tokenizer alignment and the pipeline can't be;
tests hold them against brute force or held-out rows.
"""

from __future__ import annotations

from visitmart.llm import sharding

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
SPACED = r"[^\x20\x09-\x0D]+"
PLAIN = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

SUBSTRING = rf"""
WITH docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '{SPACED}'), []) AS ws FROM documents),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos, len(ws) AS n FROM docs),
begins AS (
  SELECT doc_id, pos, n,
         string_agg(word, ' ') OVER (PARTITION BY doc_id ORDER BY pos ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING) AS win FROM words),
windows AS (SELECT doc_id, pos, row_number() OVER (PARTITION BY win ORDER BY doc_id, pos) AS nth FROM begins WHERE pos + 20 <= n),
gone AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM windows WHERE nth > 1),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY pos) AS text, count(*) AS stay FROM words ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - coalesce(stay, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (doc_id)
"""

EMBEDDINGS = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT a AS node, b AS other FROM links UNION SELECT reach.node, links.b FROM reach JOIN links ON reach.other = links.a),
least_of AS (SELECT node, min(other) AS least FROM reach GROUP BY node),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(least, vec_id)) AS component_id,
       vec_id = least(vec_id, coalesce(least, vec_id)) AS kept
FROM embeddings LEFT JOIN counts ON vec_id = counts.a LEFT JOIN least_of ON vec_id = node
"""

MIX = rf"""
WITH sized AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{SPACED}')), 0) AS BIGINT) AS size FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INT)] AS weight FROM sources),
filling AS (
  SELECT *, row_number() OVER w AS place, CAST(sum(source_size) OVER () AS BIGINT) * 150 / 100 AS budget,
         CAST(coalesce(sum(2 * source_size) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS filled,
         CAST(sum(weight) OVER (w ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS sharing
  FROM weighed WINDOW w AS (ORDER BY source_size / weight, source IS NULL, source)),
levels AS (SELECT *, (budget - filled) / sharing AS lift FROM filling),
targets AS (
  SELECT source, source_size, budget,
         least(CAST(2 * source_size AS DOUBLE), weight * first_value(CASE WHEN weight * lift <= 2 * source_size THEN lift END IGNORE NULLS)
           OVER (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS target
  FROM levels),
shuffled AS (
  SELECT *, md5('0:' || CAST(doc_id AS VARCHAR)) AS digest FROM sized),
queued AS (
  SELECT *, CAST(sum(size) OVER (PARTITION BY source ORDER BY digest, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS upto FROM shuffled),
timed AS (
  SELECT q.*, source_size, target, budget, pass, (upto + pass * source_size) / target AS finish
  FROM queued AS q JOIN targets AS t ON q.source IS NOT DISTINCT FROM t.source CROSS JOIN (VALUES (0), (1)) AS passes(pass)
  WHERE target > 0),
served AS (
  SELECT *, CAST(sum(size) OVER (ORDER BY finish, source IS NULL, source, pass, digest, doc_id, size ROWS UNBOUNDED PRECEDING) AS BIGINT) AS served
  FROM timed),
taken AS (SELECT doc_id, count(*) AS passes FROM served WHERE served <= budget GROUP BY doc_id)
SELECT s.doc_id, s.size, t.source_size, t.target, CAST(s.size * coalesce(passes, 0) AS BIGINT) AS taken
FROM sized AS s JOIN targets AS t ON s.source IS NOT DISTINCT FROM t.source LEFT JOIN taken ON s.doc_id = taken.doc_id
"""

LINES = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM split),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), '{UPPER}', '{UPPER.lower()}') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS top FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (SELECT keyed.*, top IS NOT NULL AND doc_id <> top AS gone FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

LEAKS = rf"""
WITH items AS (
  SELECT item_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{PLAIN}'), []) AS ws FROM benchmark),
item_begins AS (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS b FROM items WHERE len(ws) > 0),
wanted AS (SELECT DISTINCT item_id, n, array_to_string(ws[b:b + n - 1], ' ') AS win FROM item_begins),
docs AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, '{UPPER}', '{UPPER.lower()}'), '{PLAIN}'), []) AS ws FROM documents),
doc_begins AS (
  SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS b FROM docs CROSS JOIN (SELECT DISTINCT n FROM wanted)),
hits AS (
  SELECT doc_id, b, d.n, item_id FROM (SELECT doc_id, b, n, array_to_string(ws[b:b + n - 1], ' ') AS win FROM doc_begins) AS d
  JOIN wanted USING (win, n)),
covered AS (
  SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(b, b + n)) AS pos FROM hits) GROUP BY doc_id),
listed AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""


# Letters in either case are written out: a case-insensitive match would take more than ASCII ones here.
NAMES = "password passwd secret token apikey api_key"
ASSIGN = (
    "(?:" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in name) for name in NAMES.split()) + ")"
    r"""["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
)
RUN = "[A-Za-z0-9+/_-]{20,}"
HARMLESS = "(?i:example|sample|dummy|placeholder|changeme|change_me|your_|your-)|(?i:abcdefgh|01234567|12345678)|^[0-9]+$"


def _found(rows: str, kind: str, rank: int, pattern: str) -> str:
    """(doc_id, kind, rank, s, e, found) of the matches in (doc_id, base, text), counted from ``base``."""
    return f"""
  SELECT doc_id, '{kind}' AS kind, {rank} AS rank, s, s + length(found) AS e, found FROM (
    SELECT doc_id, found, base + CAST(sum(length(piece)) OVER w + coalesce(sum(length(found)) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS s
    FROM (SELECT doc_id, base, unnest(range(len(ms))) AS nth, unnest(ms) AS found, unnest(ps[1:len(ms)]) AS piece
          FROM (SELECT doc_id, base, regexp_extract_all(text, '{pattern}') AS ms, string_split_regex(text, '{pattern}') AS ps FROM {rows}) WHERE len(ms) > 0)
    WINDOW w AS (PARTITION BY doc_id, base ORDER BY nth))"""


SECRETS = f"""
WITH docs AS (SELECT doc_id, 0 AS base, coalesce(text, '') AS text FROM documents),
assigned AS ({_found("docs", "assign", 0, ASSIGN)}),
pieces AS (
  SELECT doc_id, 0 AS base, string_split_regex(text, '{ASSIGN}')[1] AS text FROM docs
  UNION ALL
  SELECT doc_id, e, string_split_regex(substr(rest, 1 + e), '{ASSIGN}')[1] FROM (SELECT a.doc_id, a.e, d.text AS rest FROM assigned AS a JOIN docs AS d USING (doc_id))),
runs AS ({_found("pieces", "run", 3, RUN)}),
windows AS (
  SELECT *, unnest(list_transform(range(1, length(found) - 18), lambda i: list_entropy(string_split(substr(found, CAST(i AS BIGINT), 20), '')))) AS bits
  FROM runs WHERE NOT regexp_matches(found, '{HARMLESS}|[0-9a-f]{{16,}}|AKIA[A-Z0-9]{{14,}}')
    AND regexp_matches(found, '[0-9]') AND regexp_matches(found, '[A-Za-z]')),
added AS (
  SELECT doc_id, CASE WHEN regexp_full_match(found, '[0-9A-Fa-f]+') THEN 'entropy_hex' ELSE 'entropy_base64' END AS kind,
         CASE WHEN regexp_full_match(found, '[0-9A-Fa-f]+') THEN 3 ELSE 4 END AS rank, s, e, max(bits) AS bits
  FROM windows GROUP BY ALL),
spans AS (
  SELECT doc_id, kind, rank, s, e FROM assigned WHERE length(regexp_extract(found, '{ASSIGN}', 1)) >= 12
  UNION ALL SELECT doc_id, kind, rank, s, e FROM ({_found("docs", "access", 1, "AKIA[A-Z0-9]+")}) WHERE length(found) >= 18
  UNION ALL SELECT doc_id, kind, rank, s, e FROM ({_found("docs", "hex", 2, "[0-9a-f]+")}) WHERE length(found) >= 16
  UNION ALL SELECT doc_id, kind, rank, s, e FROM added WHERE bits >= CASE rank WHEN 3 THEN 3.0 ELSE 3.8 END),
listed AS (
  SELECT doc_id, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
         string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(listed.base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (doc_id)
"""

INFILL = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS us FROM documents),
numbers AS (
  SELECT *, CAST(len(us) AS BIGINT) AS n, list_transform(range(4), lambda k: CAST('0x' || substr(h, CAST(8 * k + 1 AS BIGINT), 8) AS BIGINT)) AS hs FROM cut),
places AS (
  SELECT *, least(hs[1] % (n + 1), hs[2] % (n + 1)) AS lo, greatest(hs[1] % (n + 1), hs[2] % (n + 1)) AS hi,
         CASE WHEN n = 0 OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR hs[3] % 100 >= 90 THEN 'plain'
              WHEN hs[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM numbers),
parts AS (
  SELECT doc_id, text, n, form, coalesce(array_to_string(us[1:lo], ''), '') AS p, coalesce(array_to_string(us[lo + 1:hi], ''), '') AS m,
         coalesce(array_to_string(us[hi + 1:], ''), '') AS s
  FROM places)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(CASE form WHEN 'plain' THEN text ELSE p || m || s END) AS restored_sha256
FROM parts
"""


def _shards() -> str:
    """Placement by the lookup table, which is written out: filling it takes turns, which SQL has not."""
    owners = ",".join(map(str, sharding.lookup_table([f"shard-{n}" for n in range(sharding.SHARDS)])))
    return f"""
WITH owners AS (SELECT string_split('{owners}', ',') AS owner),
slots AS (SELECT doc_id, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, {sharding.DIGITS}) AS BIGINT) % {sharding.SLOTS} AS slot FROM documents),
placed AS (SELECT unnest(owner) AS shard, unnest(range(len(owner))) AS slot FROM owners)
SELECT doc_id, slot, CAST(shard AS INTEGER) AS shard FROM slots JOIN placed USING (slot)
"""


STATEMENTS: dict[str, str] = {
    "op2_substring_dedup": SUBSTRING,
    "op3_sharding": _shards(),
    "op4_embedding_dedup": EMBEDDINGS,
    "op5_weighted_mix": MIX,
    "op7_line_dedup": LINES,
    "op8_decontamination": LEAKS,
    "op11_secret_scan": SECRETS,
    "op13_fill_in_middle": INFILL,
}
