"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["op1_jaccard_join"] = rf"""
WITH RECURSIVE doc AS (
    SELECT row_number() OVER () AS k, doc_id,
           regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\x20\x09-\x0D]+') AS w FROM documents
), shingle AS (
    SELECT DISTINCT k, array_to_string(w[i:i + 3], ' ') AS s
    FROM (SELECT k, w, unnest(range(1, greatest(1, len(w) - 3) + 1)) AS i FROM doc WHERE len(w) > 0)
), size AS (
    SELECT k, count(*) AS n FROM shingle GROUP BY k
), link AS (
    SELECT x, y FROM (SELECT a.k AS x, b.k AS y, count(*) AS c FROM shingle a JOIN shingle b USING (s) GROUP BY ALL) p
    JOIN size m ON m.k = x JOIN size n ON n.k = y WHERE 100 * c >= 85 * (m.n + n.n - c)
), reach AS (
    SELECT k AS x, k AS y FROM doc UNION SELECT reach.x, link.y FROM reach JOIN link ON reach.y = link.x
), component AS (
    SELECT x AS k, min(doc_id) AS component_id FROM reach JOIN doc ON doc.k = y GROUP BY x
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM doc JOIN component USING (k) LEFT JOIN size USING (k)
"""

ORACLE_SQL["op4_decontamination"] = f"""
WITH item AS (
    SELECT row_number() OVER () AS k, item_id, {_WORDS} AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS win, least(10, len(w)) AS n
    FROM (SELECT *, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM item WHERE len(w) > 0)
), doc AS (
    SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents
), sizes AS (
    SELECT DISTINCT n FROM windows
), spot AS (
    SELECT d.k, i, s.n, array_to_string(d.w[i:i + s.n - 1], ' ') AS win
    FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM doc) d JOIN sizes s ON i + s.n - 1 <= len(d.w)
), hit AS (
    SELECT spot.k, spot.i, spot.n, item_id FROM spot JOIN windows USING (win, n)
), covered AS (
    SELECT k, count(DISTINCT p) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS p FROM hit) GROUP BY k
), named AS (
    SELECT k, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
    FROM (SELECT DISTINCT k, CAST(item_id AS VARCHAR) AS id FROM hit WHERE item_id IS NOT NULL) GROUP BY k
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (k) LEFT JOIN named USING (k)
"""

ORACLE_SQL["op5_url_filters"] = f"""
WITH cut AS (
    SELECT page_id, CASE WHEN instr(coalesce(url, ''), '://') > 0
                         THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), part AS (
    SELECT page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/'
        END AS rule FROM part
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN list_has_any(string_split(host, '.'),
                      ['cheap-pills', 'casino', 'free-money', 'porn', 'viagra', 'xxx']) THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""

#: crc32 of the UTF-8 bytes of ``s``; ``crc.t`` is the table of the 256 bytes
_CRC_TABLE = """crc AS (
    SELECT list(list_reduce([x, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384)
                                                                        ELSE c >> 1 END) ORDER BY x) AS t
    FROM (SELECT CAST(unnest(range(256)) AS BIGINT) AS x)
)"""
_CRC = """xor(list_reduce([4294967295]::BIGINT[] || [CAST('0x' || substr(hex(encode({s})), 2 * i - 1, 2) AS BIGINT)
                                                     FOR i IN range(1, strlen({s}) + 1)],
                lambda c, b: xor(crc.t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"""

ORACLE_SQL["op12_spelling_variants"] = rf"""
WITH RECURSIVE {_CRC_TABLE}, run AS (
    SELECT doc_id, {_LOWER.format("r")} AS r, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) AS r FROM documents)
    GROUP BY ALL
), hashed AS (
    SELECT r, n, {_CRC.format(s="s")} AS h FROM (SELECT r, n, concat(doc_id, ':', r) AS s FROM run), crc
), word AS (
    SELECT w AS word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT n, CASE WHEN h % 97 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS w FROM hashed)
    WHERE length(w) >= 5 GROUP BY w HAVING sum(n) >= 3
), cut AS (
    SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
    FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM word)
), pair AS (
    SELECT a.word AS word, b.word AS near FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
    UNION SELECT cut.word, w.word FROM cut JOIN word w ON cut.rest = w.word
    UNION SELECT w.word, cut.word FROM cut JOIN word w ON cut.rest = w.word
), top AS (
    SELECT pair.word, count(*) AS n_near, min({{'n': -b.n, 'w': encode(pair.near)}}) AS best
    FROM pair JOIN word b ON b.word = pair.near GROUP BY pair.word
), formed AS (
    SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.n >= 2 * n THEN decode(best.w) END AS form,
           CASE WHEN -best.n >= 2 * n THEN -best.n END AS form_n
    FROM word LEFT JOIN top USING (word)
), chain AS (
    SELECT word, coalesce(form, word) AS at FROM formed
    UNION SELECT chain.word, formed.form FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NOT NULL
), ended AS (
    SELECT chain.word, chain.at AS root FROM chain JOIN formed ON formed.word = chain.at WHERE formed.form IS NULL
)
SELECT word, form, root, n, CAST(n_near AS BIGINT) AS n_near, CAST(form_n AS BIGINT) AS form_n
FROM formed JOIN ended USING (word)
"""

ORACLE_SQL["op13_conversation_repair"] = rf"""
WITH RECURSIVE {_CRC_TABLE}, hashed AS (
    SELECT conv_id, turn, role, text, {_CRC.format(s="s")} % 20 AS k
    FROM (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                 concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' ')) AS s
          FROM conversations), crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
           CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN k = 3 THEN 2 ELSE 1 END)) AS copy
    FROM hashed WHERE k <> 0
), placed AS (
    SELECT coalesce(CAST(conv_id AS VARCHAR), '') AS g, *, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM damaged
), judged AS (
    SELECT *, lag(initial) OVER (PARTITION BY g ORDER BY i) || initial AS step, CASE
        WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
        WHEN row_number() OVER (PARTITION BY g, role, text ORDER BY i) > 1 THEN 'duplicate'
        WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
    FROM placed
), counted AS (
    SELECT g, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (step NOT IN ('su', 'ua', 'au')) AS illegal
    FROM judged GROUP BY g
), way AS (
    -- the cheapest (cost, audit) with nothing written yet, or a system, user or assistant turn last
    SELECT g, CAST(0 AS BIGINT) AS i, {{'c': 0::BIGINT, 'e': ''}} AS n, {{'c': 1000000000::BIGINT, 'e': ''}} AS s,
           {{'c': 5::BIGINT, 'e': 'I'}} AS u, {{'c': 10::BIGINT, 'e': 'II'}} AS a FROM counted
    UNION ALL
    SELECT g, i, n, s,
           least(u, {{'c': n.c + 5, 'e': n.e || 'I'}}, {{'c': s.c + 5, 'e': s.e || 'I'}}, {{'c': a.c + 5, 'e': a.e || 'I'}}),
           least(a, {{'c': u.c + 5, 'e': u.e || 'I'}}, {{'c': n.c + 10, 'e': n.e || 'II'}}, {{'c': s.c + 10, 'e': s.e || 'II'}})
    FROM (
        SELECT g, i, {{'c': n.c + 2, 'e': n.e || 'D'}} AS n,
               least({{'c': s.c + 2, 'e': s.e || 'D'}}, {{'c': n.c + t + CASE WHEN initial = 's' THEN 0 ELSE no END, 'e': n.e || 'K'}}) AS s,
               least({{'c': u.c + 2, 'e': u.e || 'D'}},
                     {{'c': n.c + t + keep_u, 'e': n.e || 'K'}}, {{'c': s.c + t + keep_u, 'e': s.e || 'K'}}, {{'c': a.c + t + keep_u, 'e': a.e || 'K'}},
                     {{'c': n.c + t + 1, 'e': n.e || 'R'}}, {{'c': s.c + t + 1, 'e': s.e || 'R'}}, {{'c': a.c + t + 1, 'e': a.e || 'R'}}) AS u,
               least({{'c': a.c + 2, 'e': a.e || 'D'}}, {{'c': u.c + t + CASE WHEN initial = 'a' THEN 0 ELSE no END, 'e': u.e || 'K'}},
                     {{'c': u.c + t + 1, 'e': u.e || 'R'}}) AS a
        FROM (SELECT way.g, judged.i, n, s, u, a, initial, 1000000000::BIGINT AS no, CASE WHEN initial = 'u' THEN 0 ELSE 1000000000::BIGINT END AS keep_u,
                     CASE fault WHEN '' THEN 0 WHEN 'truncated' THEN 5 ELSE 1000000000::BIGINT END AS t
              FROM way JOIN judged ON judged.g = way.g AND judged.i = way.i + 1)
    )
), best AS (
    SELECT g, least(n, a) AS b FROM way JOIN counted USING (g) WHERE i = rows
), walk AS (
    -- along the audit: edits read, rows read, the role written last and the turns written
    SELECT g, b.e AS e, 0 AS k, 0 AS i, 'n' AS q, CAST([] AS VARCHAR[]) AS made FROM best
    UNION ALL
    SELECT walk.g, e, k + 1, walk.i + CASE WHEN edit = 'I' THEN 0 ELSE 1 END,
           CASE edit WHEN 'D' THEN q WHEN 'K' THEN initial ELSE CASE q WHEN 'u' THEN 'a' ELSE 'u' END END,
           CASE edit WHEN 'D' THEN made WHEN 'K' THEN made || [role || ':' || text]
                     ELSE made || [CASE q WHEN 'u' THEN 'assistant:' ELSE 'user:' END || CASE edit WHEN 'R' THEN text ELSE '' END] END
    FROM (SELECT *, substr(e, k + 1, 1) AS edit FROM walk WHERE k < length(e)) walk
    LEFT JOIN judged ON judged.g = walk.g AND judged.i = walk.i + 1
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(b.c, 0) AS BIGINT) AS cost, coalesce(b.e, '') AS audit,
       sha256(coalesce(array_to_string(made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(CAST(conv_id AS VARCHAR), '') AS g FROM conversations) o
LEFT JOIN counted USING (g) LEFT JOIN best USING (g) LEFT JOIN (SELECT g, made FROM walk WHERE k = length(e)) USING (g)
"""
