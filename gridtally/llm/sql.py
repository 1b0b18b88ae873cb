"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_KEY = _LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")

OP2 = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS xs FROM documents),
lines AS (SELECT doc_id, unnest(range(1, len(xs) + 1)) AS i, unnest(xs) AS line FROM split),
keyed AS (SELECT doc_id, i, line, {_KEY} AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS last FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT k.doc_id, k.i, k.line, r.last IS NOT NULL AND k.doc_id < r.last AS dropped
  FROM keyed k LEFT JOIN repeated r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT dropped), ''))
         AS kept_sha256
FROM judged GROUP BY doc_id
"""


def _words(text: str) -> str:
    return (f"regexp_extract_all({_LOWER.format(f'coalesce({text}, chr(32))')}, "
            r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")


OP3 = f"""
WITH b AS (SELECT item_id, {_words('text')} AS w FROM benchmark),
sized AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM sized)),
d AS (SELECT doc_id, {_words('text')} AS w FROM documents),
places AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM windows))),
hits AS (SELECT doc_id, n, i, item_id FROM places JOIN windows USING (n, p)),
covered AS (
  SELECT doc_id, count(DISTINCT pos) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY doc_id),
found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""

#: The others need fingerprints, trained models, BPE, DOM trees, estimation or a
#: table filled in turns; their tests hold them against brute force.
ORACLES = {"op2_line_dedup": OP2, "op3_decontamination": OP3}
