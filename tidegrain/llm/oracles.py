"""What the queries return, in DuckDB SQL where it can say it, by plain means that share nothing with the operators."""

from __future__ import annotations

from tidegrain.llm import chat, mix

WORD = r"[^\x20\x09-\x0D]+"
LETTERS = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

JACCARD = f"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{WORD}') AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS sh FROM d),
 u AS (SELECT doc_id, unnest(sh) AS g FROM s), p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM u a JOIN u b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
 e AS (SELECT x, y FROM p JOIN s a ON a.doc_id = x JOIN s b ON b.doc_id = y WHERE 100 * c >= 80 * (len(a.sh) + len(b.sh) - c)),
 r AS (SELECT doc_id AS x, doc_id AS y FROM s UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
 SELECT s.doc_id, CAST(len(sh) AS BIGINT) AS n_shingles, m AS component_id FROM s JOIN (SELECT x, min(y) AS m FROM r GROUP BY x) ON x = doc_id"""

VECTORS = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
 ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
 l AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
 r AS (SELECT vec_id AS x, vec_id AS y FROM v UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x), m AS (SELECT x, min(y) AS c FROM r GROUP BY x), n AS (SELECT x, count(*) AS k FROM l GROUP BY x)
 SELECT v.vec_id, coalesce(k, 0) AS n_links, c AS component_id, c = v.vec_id AS kept FROM v JOIN m ON m.x = v.vec_id LEFT JOIN n ON n.x = v.vec_id"""

SUBSTRINGS = f"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
 win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS t FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
 late AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY t ORDER BY doc_id, i) AS n FROM win) WHERE n > 1),
 gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS i FROM late), word AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS x FROM d),
 kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.i) AS t FROM word LEFT JOIN gone ON gone.doc_id = word.doc_id AND gone.i = word.i WHERE gone.i IS NULL GROUP BY 1), n AS (SELECT doc_id, count(*) AS c FROM gone GROUP BY 1)
 SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(c, 0) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)"""

ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

PHRASES = f"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{ALNUM}') AS w FROM documents),
 b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), {LETTERS}), '{ALNUM}') AS w FROM benchmark),
 q AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS t FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
 win AS (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS t FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM q) WHERE len(w) >= n)),
 hit AS (SELECT doc_id, i, item_id, win.n AS n FROM win JOIN q ON win.t = q.t AND win.n = q.n),
 word AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM hit) GROUP BY 1),
 item AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR))) AS items_sha256 FROM (SELECT DISTINCT doc_id, item_id FROM hit WHERE item_id IS NOT NULL) GROUP BY 1)
 SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, coalesce(items_sha256, sha256('')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
 FROM d LEFT JOIN word USING (doc_id) LEFT JOIN item USING (doc_id)"""

_HEX = lambda i: f"CAST('0x' || substr(sha256(CAST(doc_id AS VARCHAR)), {8 * i + 1}, 8) AS BIGINT)"

FEATURES = f"""WITH v AS (SELECT source, doc_id, {_HEX(0)} % 200000 AS event, {_HEX(0)} % 200000 - 60 + {_HEX(1)} % 1200 AS arrival, {_HEX(0)} % 200000 + {_HEX(2)} % 900 AS expiry, n_chars, lang FROM documents),
 s AS (SELECT doc_id, min(source) AS source FROM documents WHERE doc_id IS NOT NULL GROUP BY 1), l AS (SELECT row_number() OVER () AS n, doc_id, {_HEX(3)} % 200000 AS t FROM labels),
 c AS (SELECT l.n, l.doc_id, l.t, v.doc_id AS version_id, event, v.n_chars, v.lang, row_number() OVER (PARTITION BY l.n ORDER BY event DESC NULLS LAST, arrival DESC NULLS LAST, v.doc_id DESC NULLS LAST, v.n_chars DESC NULLS LAST, v.lang DESC NULLS LAST) AS r
 FROM l LEFT JOIN s ON s.doc_id = l.doc_id LEFT JOIN v ON v.source = s.source AND event <= t AND arrival <= t AND t < expiry),
 w AS (SELECT *, t - event AS age, CASE WHEN version_id IS NULL THEN 'none' WHEN t - event > 20 THEN 'stale' ELSE 'fresh' END AS status FROM c WHERE r = 1)
 SELECT doc_id, t, version_id, age, status, CASE WHEN status = 'fresh' THEN n_chars END AS n_chars, CASE WHEN status = 'fresh' THEN lang END AS lang FROM w"""

NEGATIVES = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(256 * x) AS BIGINT)) AS e FROM embeddings
 WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
 s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_sum(list_transform(list_zip(a.e, b.e), lambda z: z[1] * z[2])) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE a.vec_id % 50 = 0),
 p AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
 SELECT p.anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
 FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT same AND 100 * score >= 50 * positive_score AND 100 * score <= 95 * positive_score
 WINDOW w AS (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, vec_id) QUALIFY rank <= 3"""

MIX = f"""WITH d AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '{WORD}')) AS BIGINT) AS size, CAST('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 15) AS BIGINT) AS h FROM documents),
 p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY 1), w AS (SELECT *, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, 2.0::DOUBLE * source_size AS cap, CAST(1.5::DOUBLE * sum(source_size) OVER () AS DOUBLE) AS total FROM p),
 l AS (SELECT *, (total - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) / sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
 f AS (SELECT *, level * w >= cap AS is_full FROM l), t AS (SELECT *, CASE WHEN is_full THEN cap ELSE w * (SELECT arg_min(level, cap / w) FROM f WHERE NOT is_full) END AS target FROM f),
 c AS (SELECT *, greatest(1, CAST(ceil(total / {mix.SLOTS}) AS BIGINT)) AS block, sum(target) OVER (ORDER BY source NULLS LAST ROWS UNBOUNDED PRECEDING) / sum(target) OVER () AS top, row_number() OVER (ORDER BY source NULLS LAST) = count(*) OVER () AS is_last FROM t),
 b AS (SELECT *, coalesce(lag(top) OVER (ORDER BY source NULLS LAST), 0) AS lo, CASE WHEN is_last THEN 1.0::DOUBLE ELSE top END AS hi FROM c),
 slots AS (SELECT (i * {mix.GOLDEN}::DOUBLE) % 1.0::DOUBLE AS u FROM range({mix.SLOTS}) r(i), (SELECT max(block) AS block, max(total) AS total FROM b) WHERE i * block < total),
 cnt AS (SELECT b.source, count(u) AS n FROM b LEFT JOIN slots ON u >= lo AND u < hi GROUP BY 1),
 x AS (SELECT d.*, b.source_size, b.target, n * block AS a, sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id ROWS UNBOUNDED PRECEDING) AS c1 FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source JOIN cnt ON cnt.source IS NOT DISTINCT FROM b.source)
 SELECT doc_id, size, source_size, target, CAST(greatest(0, least(c1, a) - (c1 - size)) + greatest(0, least(source_size + c1, a) - (source_size + c1 - size)) AS BIGINT) AS taken FROM x"""


def _escaped(text: str) -> str:
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    out = f"replace({text}, {quote(chat.ESC)}, {quote(chat.ESC * 2)})"
    for c in chat.CONTROL:
        out = f"replace({out}, {quote(c)}, {quote(c[0] + chat.ESC + '-' + c[1:])})"
    return out


CHAT = f"""WITH r AS (SELECT conv_id, turn, coalesce(role, 'null') AS role, coalesce(text, '') AS text FROM conversations UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')),
 g AS (SELECT conv_id, count(*) AS n_turns, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS whole, coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '') AS loss,
 CAST(sum(length({_escaped("role")}) + length({_escaped("text")}) + {len(chat.OPEN + chat.CLOSE + chat.END)}) AS BIGINT) AS formatted_chars FROM r GROUP BY 1)
 SELECT conv_id, n_turns, sha256(whole) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars FROM g"""
