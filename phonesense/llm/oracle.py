"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from . import licenses
from .common import LOWER, UPPER

_LOWERED = f"translate(coalesce(text, ''), '{UPPER}', '{LOWER}')"

# Phrases stand where their words stand one after the other. A wording's 4-grams vote for the
# offset between document and wording; offsets up to GAP apart are one span.
_WORDINGS = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(licenses.TEMPLATES))
_PHRASES = ", ".join(f"('{label}', '{text}')" for text, label in licenses.PHRASES.items())
LICENSE_SCAN = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), placed AS (
  SELECT r, unnest(range(len(ws))) AS p, ws FROM docs
), phrases AS (
  SELECT label, string_split(words, ' ') AS own FROM (VALUES {_PHRASES}) t(label, words)
), base AS (
  SELECT r, p, label FROM placed JOIN phrases ON ws[p + 1] = own[1] AND ws[p + 1:p + len(own)] = own
), wordings AS (
  SELECT id, label, string_split(words, ' ') AS own FROM (VALUES {_WORDINGS}) t(id, label, words)
), grams AS (
  SELECT id, label, t, len(own) AS n, own[t + 1:t + 4] AS gram
  FROM (SELECT *, unnest(range(len(own) - 3)) AS t FROM wordings)
), votes AS (
  SELECT r, id, label, n, p, t, p - t AS diagonal
  FROM placed JOIN grams ON ws[p + 1] = gram[1] AND ws[p + 1:p + 4] = gram
), steps AS (
  SELECT *, CASE WHEN diagonal - lag(diagonal) OVER (PARTITION BY r, id ORDER BY diagonal, p) <= {licenses.GAP} THEN 0 ELSE 1 END AS step
  FROM votes
), spans AS (
  SELECT *, sum(step) OVER (PARTITION BY r, id ORDER BY diagonal, p ROWS UNBOUNDED PRECEDING) AS span FROM steps
), verified AS (
  SELECT r, label, count(DISTINCT t) / (n - 3) AS cover FROM spans GROUP BY r, id, label, n, span
  HAVING count(DISTINCT t) / (n - 3) >= CASE WHEN n < {licenses.SHORT} THEN 1.0 ELSE {licenses.COVER} END
     AND max(p) + 4 - min(p) <= n * {licenses.STRETCH}
), named AS (
  SELECT r, label, true AS is_base, 1.0 AS cover, p FROM base
  UNION ALL SELECT r, label, false, cover, NULL FROM verified
)
SELECT doc_id, len(ws) AS n_words, count(*) FILTER (WHERE is_base) AS n_base, min(p) AS first_word, max(p) AS last_word,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label) FILTER (WHERE is_base), '') AS base_labels,
       coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS labels,
       CAST(coalesce(max(cover), 0) AS DOUBLE) AS score
FROM docs LEFT JOIN named USING (r) GROUP BY r, doc_id, ws
"""

TOPK = """
WITH fit AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM fit a JOIN fit b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q) WHERE a.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 5
"""

NEAR_DEDUP = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_LOWERED}, '[^\x20\x09-\x0D]+') AS ws FROM documents
), nodes AS (
  SELECT ws, min(doc_id) AS id FROM docs WHERE len(ws) > 0 GROUP BY ws
), shingles AS (
  SELECT DISTINCT id, CASE WHEN len(ws) < 4 THEN ws ELSE ws[i:i + 3] END AS s
  FROM (SELECT id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM nodes)
), sizes AS (
  SELECT id, count(*) AS n FROM shingles GROUP BY id
), shared AS (
  SELECT a.id AS a, b.id AS b, count(*) AS common FROM shingles a JOIN shingles b ON a.s = b.s AND a.id <> b.id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.id = a JOIN sizes y ON y.id = b
  WHERE 100 * common >= 80 * (x.n + y.n - common)
), reach AS (
  SELECT id AS a, id AS b FROM nodes UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), named AS (
  SELECT a AS id, min(b) AS component_id FROM reach GROUP BY a
)
SELECT d.doc_id, coalesce(n, 0) AS n_shingles, coalesce(component_id, d.doc_id) AS component_id,
       d.doc_id = coalesce(component_id, d.doc_id) AS kept
FROM docs d LEFT JOIN nodes USING (ws) LEFT JOIN sizes USING (id) LEFT JOIN named USING (id)
"""


def _state(cost: int, letter: str, line: str | None, of: str) -> str:
    """A path's state {cost, audit, lines} after one more edit."""
    lines = f"{of}.r" if line is None else f"CASE WHEN {of}.a LIKE '%K%' OR {of}.a LIKE '%R%' OR {of}.a LIKE '%I%' THEN {of}.r || chr(10) ELSE '' END || {line}"
    return f"{{'c': {of}.c + {cost}, 'a': {of}.a || '{letter}', 'r': {lines}}}"


# The states: nothing yet (s0), after s (s1), after u (s2), after a (s3). A row is deleted, kept or reroled; then
# texts may be inserted, two in a row at most, as more lead back to the same state.
_NONE = "{'c': 1000000000, 'a': '', 'r': ''}"
_LINE = "role || ':' || text"


def _into(state: int, initial: str, sources: tuple[int, ...]) -> str:
    """The least way into ``state``, which ``initial`` leads to from ``sources``."""
    ways = [_state(2, "D", None, f"s{state}")]
    for s in sources:
        ways.append(f"CASE WHEN keeps AND h = '{initial}' THEN {_state(0, 'K', _LINE, f's{s}')} ELSE {_NONE} END".replace(
            f"s{s}.c + 0", f"s{s}.c + more"))
        if initial != "s":
            line = "'user:' || text" if initial == "u" else "'assistant:' || text"
            ways.append(f"CASE WHEN keeps AND h <> '{initial}' THEN {_state(1, 'R', line, f's{s}')} ELSE {_NONE} END".replace(
                f"s{s}.c + 1", f"s{s}.c + 1 + more"))
    return f"least({', '.join(ways)})" if len(ways) > 1 else ways[0]


_USER_IN = "least(s2, " + ", ".join(_state(5, "I", "'user:'", s) for s in ("s0", "s1", "s3")) + ")"
_ASSISTANT_IN = f"least(s3, {_state(5, 'I', chr(39) + 'assistant:' + chr(39), 's2')})"
_CRC_BIT = "CASE WHEN x % 2 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
CONVERSATION_REPAIR = rf"""
WITH RECURSIVE named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS name FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce(list_transform(string_split(name, ''), lambda c: CAST(ord(c) AS BIGINT)),
                lambda crc, b: list_reduce([0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: {_CRC_BIT}, xor(crc, b)),
                CAST(4294967295 AS BIGINT)), 4294967295) % 20 AS d FROM named
), damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM (SELECT *, unnest(CASE d WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM hashed)
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, md5(text)) AS i,
         left(role, 1) AS h, regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS ending FROM damaged
), faulty AS (
  SELECT *, CASE WHEN ending = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1
                 THEN 'duplicate' WHEN ending NOT IN ('.', '!', '?') THEN 'truncated'
                 ELSE '' END AS fault,
         lag(h) OVER (PARTITION BY conv_id ORDER BY i) || h AS pair FROM placed
), lattice AS (
  SELECT *, fault NOT IN ('blank', 'duplicate') AS keeps, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more FROM faulty
), starts AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 'r': ''}} AS s0, {_NONE} AS s1, {_NONE} AS s2, {_NONE} AS s3 FROM faulty
), paths AS (
  SELECT conv_id, i, s0, s1, s2, {_ASSISTANT_IN} AS s3 FROM (SELECT * REPLACE ({_USER_IN} AS s2) FROM starts)
  UNION ALL
  SELECT conv_id, i, s0, s1, s2, {_ASSISTANT_IN} AS s3 FROM (SELECT * REPLACE ({_USER_IN} AS s2) FROM (
    SELECT p.conv_id, l.i, {_into(0, '', ())} AS s0, {_into(1, 's', (0,))} AS s1, {_into(2, 'u', (0, 1, 3))} AS s2,
           {_into(3, 'a', (2,))} AS s3
    FROM paths p JOIN lattice l ON p.conv_id IS NOT DISTINCT FROM l.conv_id AND l.i = p.i + 1))
), ended AS (
  SELECT conv_id, least(s0, s3) AS s FROM paths QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
         count(*) FILTER (WHERE fault = 'truncated') AS truncated,
         count(*) FILTER (WHERE pair NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(s.c, 0) AS BIGINT) AS cost,
       coalesce(s.a, '') AS audit, sha256(coalesce(s.r, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM o.conv_id
"""


def _round(n: int) -> str:
    """Assignment to the centroids of round n and the centroids after it."""
    return f"""a{n} AS MATERIALIZED (
  SELECT * FROM (SELECT r, vec_id, k.q, c, square - 2 * list_inner_product(k.q, m.q) + list_inner_product(m.q, m.q) AS d FROM kept k, c{n} m)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, c) = 1
), c{n + 1} AS MATERIALIZED (
  SELECT c, list(x ORDER BY i) AS q FROM (
    SELECT c, i, floor(sum(x) / count(*)) AS x FROM (SELECT c, unnest(q) AS x, unnest(range(64)) AS i FROM a{n}) GROUP BY c, i) GROUP BY c
  UNION ALL SELECT c, q FROM c{n} WHERE c NOT IN (SELECT c FROM a{n})
)"""


# Sums and products of these whole numbers are exact in doubles.
CENTROIDS = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, q, list_inner_product(q, q) AS square FROM (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)
), c0 AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY h, vec_id, q) - 1 AS c, q
  FROM (SELECT *, sha256('2:' || coalesce(CAST(vec_id AS VARCHAR), '')) AS h FROM kept) QUALIFY c < 40
), {", ".join(_round(n) for n in range(6))}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance,
       CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(list_transform(m.q, lambda x: CAST(x AS BIGINT)), ',')) AS centroid_sha256
FROM a5 JOIN c5 m USING (c)
"""


EMBEDDING_DEDUP = """
WITH RECURSIVE kept_rows AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS x,
         label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NOT NULL AND isfinite(c))) = len(embedding)
           AND len(list_filter(embedding, lambda c: c <> 0)) > 0 AS fit
  FROM embeddings
), fit_rows AS MATERIALIZED (
  SELECT * FROM kept_rows WHERE fit
), links AS MATERIALIZED (
  SELECT a.r AS a, b.r AS b FROM fit_rows a JOIN fit_rows b ON a.label = b.label AND a.r <> b.r
  WHERE CASE WHEN len(a.x) = len(b.x) THEN list_cosine_similarity(a.x, b.x) >= 0.93 END
), reach AS (
  SELECT r AS a, r AS b FROM kept_rows UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
), named AS (
  SELECT reach.a AS r, min(o.vec_id) AS component_id FROM reach JOIN kept_rows o ON o.r = reach.b GROUP BY reach.a
)
SELECT k.vec_id, (SELECT count(*) FROM links WHERE links.a = k.r) AS n_links, component_id, k.vec_id IS NOT DISTINCT FROM component_id AS kept
FROM kept_rows k JOIN named USING (r)
"""

ORACLE_SQL = {"op1_license_scan": LICENSE_SCAN, "op5_topk": TOPK, "op8_near_dedup": NEAR_DEDUP,
              "op11_conversation_repair": CONVERSATION_REPAIR, "op12_centroids": CENTROIDS, "op13_embedding_dedup": EMBEDDING_DEDUP}
