"""SQL twins (DuckDB) of the queries that SQL can express."""

LOWERED = ("translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
           "'abcdefghijklmnopqrstuvwxyz')")

EXACT = f"""
WITH d AS (SELECT doc_id, {LOWERED} AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)
"""

WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM documents),
i AS (SELECT item_id, regexp_extract_all({LOWERED}, '{WORDS}') AS w FROM benchmark),
iw AS (SELECT DISTINCT coalesce(CAST(item_id AS VARCHAR), '') AS item, least(len(w), 13) AS n,
         array_to_string(list_slice(w, k, k + least(len(w), 13) - 1), ' ') AS win
       FROM i, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS r(k) WHERE len(w) > 0),
n AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, k, n, array_to_string(list_slice(w, k, k + n - 1), ' ') AS win
       FROM d, n, unnest(range(1, len(w) - n + 2)) AS r(k) WHERE len(w) >= n),
m AS (SELECT doc_id, k, n, item FROM dw JOIN iw USING (n, win)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit
      FROM (SELECT DISTINCT doc_id, k, n FROM m), unnest(range(k, k + n)) AS r(p) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
      FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN s USING (doc_id)
"""

CHAT = r"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                   (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
e AS (SELECT *, length(role || text) + length('<turn ></turn>') + 1
        + length(regexp_replace(role || text, '[^\\<>#]', '', 'g')) AS n FROM t),
c AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn) AS said,
        coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '') AS loss, sum(n) AS chars
      FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars
FROM c
"""

PHRASES = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, k, array_to_string(list_slice(w, k, k + 49), ' ') AS win
        FROM d, unnest(range(1, len(w) - 48)) AS r(k) WHERE len(w) >= 50),
f AS (SELECT win, min(doc_id) AS first FROM win GROUP BY win HAVING min(doc_id) < max(doc_id)),
h AS (SELECT doc_id, array_agg(DISTINCT p) AS gone
      FROM (SELECT doc_id, k FROM win JOIN f USING (win) WHERE first < doc_id), unnest(range(k, k + 50)) AS r(p)
      GROUP BY doc_id),
l AS (SELECT d.doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN h USING (doc_id)),
x AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept
      FROM (SELECT doc_id, gone, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM l)
      WHERE NOT list_contains(gone, p) GROUP BY doc_id)
SELECT l.doc_id, len(w) AS n_words, len(gone) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM l LEFT JOIN x USING (doc_id)
"""

# CRC-32 bit by bit; the number is the reversed polynomial.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}, ''), lambda c: ord(c)::BIGINT)),
  lambda crc, b: list_reduce(list_prepend(xor(crc, b), [1, 2, 3, 4, 5, 6, 7, 8]::BIGINT[]),
    lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END::BIGINT))), 4294967295)"""


def _field(c):
    return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}, '-')"


def _leaf(n_chars):
    return "sha256(" + " || ".join(_field(c) for c in ("doc_id", "source", "lang", n_chars, "text")) + ")"


MERKLE = f"""
WITH RECURSIVE raw AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
    CASE WHEN {CRC32.format('CAST(doc_id AS VARCHAR)')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} END AS forged FROM documents),
d AS (SELECT *, row_number() OVER () AS r, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
    count(*) OVER (PARTITION BY lang) AS n FROM raw),
t AS (SELECT coalesce('=' || lang, '') AS tree, 0 AS lvl, place, leaf AS h, n FROM d
  UNION ALL SELECT tree, lvl + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (n + 1) // 2
  FROM t WHERE n > 1 GROUP BY tree, lvl, place // 2, n),
s AS (SELECT tree, h, lvl AS height, row_number() OVER (ORDER BY tree) - 1 AS place, count(*) OVER () AS n FROM t WHERE n = 1),
u AS (SELECT 0 AS lvl, place, h, n FROM s
  UNION ALL SELECT lvl + 1, place // 2, sha256(string_agg(h, '' ORDER BY place)), (n + 1) // 2
  FROM u WHERE n > 1 GROUP BY lvl, place // 2, n),
p AS (SELECT r, t.lvl, d.place >> t.lvl AS spot, o.h FROM d JOIN t ON t.tree = coalesce('=' || lang, '') AND t.place = d.place >> t.lvl AND t.n > 1
    LEFT JOIN t o ON o.tree = t.tree AND o.lvl = t.lvl AND o.place = xor(t.place, 1)
  UNION ALL SELECT r, height + u.lvl, s.place >> u.lvl, o.h FROM d JOIN s ON s.tree = coalesce('=' || lang, '')
    JOIN u ON u.place = s.place >> u.lvl AND u.n > 1 LEFT JOIN u o ON o.lvl = u.lvl AND o.place = xor(u.place, 1)),
proofs AS (SELECT r, string_agg(h, '' ORDER BY lvl) AS proof, max(lvl) AS top FROM p GROUP BY r),
f AS (SELECT r, 0 AS lvl, coalesce(forged, leaf) AS h FROM d
  UNION ALL SELECT f.r, f.lvl + 1, sha256(CASE WHEN spot % 2 = 1 THEN coalesce(p.h, '') || f.h ELSE f.h || coalesce(p.h, '') END)
  FROM f JOIN p ON p.r = f.r AND p.lvl = f.lvl)
SELECT doc_id, leaf, s.h AS subroot, u.h AS root, sha256(coalesce(proof, '')) AS proof_sha256, f.h AS folded_root, f.h = u.h AS verified
FROM d JOIN s ON s.tree = coalesce('=' || lang, '') JOIN u ON u.n = 1 LEFT JOIN proofs USING (r)
JOIN f ON f.r = d.r AND f.lvl = coalesce(top + 1, 0)
"""

HARD_NEGATIVES = """
WITH v AS (SELECT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.id AS anchor_id, b.id, a.label = b.label AS same, CAST(list_inner_product(a.e, b.e) AS BIGINT) AS score
  FROM v a JOIN v b ON a.id % 100 = 0 AND a.id <> b.id),
p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER w AS INT) AS rank, s.id AS negative_id,
  p.score AS positive_score, s.score AS negative_score
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT s.same AND 100 * s.score BETWEEN 30 * p.score AND 90 * p.score
WINDOW w AS (PARTITION BY p.anchor_id, p.id ORDER BY s.score DESC, s.id)
QUALIFY row_number() OVER w <= 10
"""
