"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_ALNUM = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SIZE = r"len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))"

OP8 = f"""
WITH d AS (SELECT doc_id, {_ALNUM} AS w FROM documents),
i AS (SELECT item_id, {_ALNUM} AS w FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[s + 1:s + least(len(w), 10)], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(0, greatest(len(w) - 9, 1))) AS s FROM i WHERE len(w) > 0)),
dw AS (SELECT doc_id, s, n, array_to_string(w[s + 1:s + n], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(0, len(w) - n + 1)) AS s FROM d, (SELECT DISTINCT n FROM iw) WHERE len(w) >= n)),
hit AS (SELECT doc_id, item_id, s, dw.n FROM dw JOIN iw ON dw.n = iw.n AND dw.g = iw.g),
covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
           FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

OP5 = f"""
WITH d AS (SELECT doc_id, source, coalesce(text, '') AS t, CAST({_SIZE} AS BIGINT) AS size FROM documents),
k AS (SELECT doc_id, source, size, t,
             -ln((CAST(('0x' || substr(md5('mix:' || CAST(doc_id AS VARCHAR)), 1, 12)) AS BIGINT) + 0.5) / 281474976710656.0)
             * (1.0 + 20.0 * (length(t) - length(translate(t, '#*$%&|<>', ''))) / greatest(length(t), 1)) AS key FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             [5.0, 2.0, 1.0][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS BIGINT)]::DOUBLE AS weight FROM d GROUP BY source),
l AS (SELECT *, 2.0 * source_size AS cap, 2.0 * source_size / weight AS level, 1.5 * sum(source_size) OVER () AS budget FROM s),
r AS (SELECT a.source, (max(a.budget) - coalesce(sum(b.cap) FILTER (b.level < a.level), 0)) / sum(b.weight) FILTER (b.level >= a.level) AS own, max(a.level) AS level
      FROM l a, l b GROUP BY a.source),
f AS (SELECT min_by(own, level) AS fill FROM r WHERE own < level),
g AS (SELECT source, source_size, least(cap, coalesce(weight * fill, cap)) AS target FROM l, f),
p AS (SELECT k.*, source_size, target, CAST(floor(target) AS BIGINT) AS goal, sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id ROWS UNBOUNDED PRECEDING) - size AS prior
      FROM k JOIN g ON k.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CAST(CASE WHEN source_size = 0 THEN 0 ELSE goal // source_size * size + greatest(0, least(size, goal % source_size - prior)) END AS BIGINT) AS taken FROM p
"""

OP9 = """
WITH t AS (SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
c AS (SELECT conv_id, list({'role': role, 'text': text} ORDER BY turn, role, text) AS turns, list(turn ORDER BY turn, role, text) AS numbers FROM t GROUP BY conv_id),
g AS (SELECT min(conv_id) AS conv_id, count(*) AS n_copies, turns FROM c GROUP BY turns),
p AS (SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, len(turns))) AS k FROM c)),
m AS (SELECT conv_id, n_copies, len(turns) AS n_turns FROM g WHERE turns NOT IN (SELECT turns FROM p))
SELECT m.conv_id, turn // 1024 AS part, n_turns, n_copies, string_agg('<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10), '' ORDER BY turn, role, text) AS text
FROM m JOIN t USING (conv_id) GROUP BY ALL
"""

# base32 of the SHA-1: each group of five bits, most significant first
OP6 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
l AS (SELECT hex, max(page_id) AS largest FROM p GROUP BY hex),
b AS (SELECT hex, largest, CAST(CAST(from_hex(hex) AS BIT) AS VARCHAR) AS bits FROM l)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 160, 5), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           CAST(16 * CAST(substr(bits, i + 1, 1) AS INT) + 8 * CAST(substr(bits, i + 2, 1) AS INT) + 4 * CAST(substr(bits, i + 3, 1) AS INT)
           + 2 * CAST(substr(bits, i + 4, 1) AS INT) + CAST(substr(bits, i + 5, 1) AS INT) + 1 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM p JOIN b USING (hex)
"""



def _near(words: int, percent: int, more: str = "") -> str:
    """Shingles as text; each document's least id that links reach, by growing what it reaches."""
    return rf"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i + 1:i + {words}], ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {words - 1}, 1))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= {percent} * (nx.n + ny.n - shared)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT x AS doc_id, x AS other FROM e UNION SELECT r.doc_id, e.y FROM r JOIN e ON r.other = e.x),
c AS (SELECT doc_id, min(other) AS least FROM r GROUP BY doc_id)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(least, d.doc_id) AS component_id{more}
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN c USING (doc_id)
"""


OP10 = _near(5, 75)
OP11 = _near(3, 85, ", coalesce(least, d.doc_id) = d.doc_id AS kept")

OP12 = rf"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f
      FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM w, (SELECT unnest([1, 2, 3]) AS k) WHERE len(w) >= k) GROUP BY ALL),
c AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1 AND f >= 10),
u AS (SELECT *, unnest(range(1, k)) AS cut FROM c),
s AS (SELECT u.*, x.f AS l, y.f AS r, 1000000::HUGEINT * a * a // (x.f::HUGEINT * y.f) AS score
      FROM u JOIN f x ON x.lang = u.lang AND x.phrase = array_to_string(u.w[1:cut], ' ') JOIN f y ON y.lang = u.lang AND y.phrase = array_to_string(u.w[cut + 1:u.k], ' ')),
b AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
h AS (SELECT lang, part, max(a) AS more FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS part FROM c WHERE k = 3) GROUP BY ALL),
g AS (SELECT b.* FROM b LEFT JOIN h ON h.lang = b.lang AND h.part = b.phrase AND b.k = 2 WHERE more IS NULL OR 100 * more < 50 * a)
SELECT lang, rank, phrase, a, l, r, n, CAST(score AS BIGINT) AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM g) JOIN t USING (lang) WHERE rank <= 2000
"""
