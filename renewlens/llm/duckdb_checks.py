"""DuckDB SQL with the same results as the queries that SQL can express."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _strength(groups: str) -> str:
    return f"""
        SELECT CASE WHEN s IS NULL OR total = groups OR s <= groups THEN 1000.0::DOUBLE
                    ELSE least(1000.0::DOUBLE, greatest(1.0::DOUBLE,
                         1 / least((s - groups) / (total - groups), 1.0::DOUBLE) - 1)) END AS k
        FROM (SELECT sum(pow(good - n * mean, 2) / (n * mean * (1 - mean))) AS s,
                     count(*) AS groups, sum(n)::DOUBLE AS total
              FROM {groups} WHERE n > 0) z"""


_HOST_REPUTATION = f"""
WITH parts AS (
    SELECT page_id,
           coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{_UPPER}', '{_LOWER}'), '')
               AS host,
           coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
    FROM pages),
named AS (
    SELECT *, regexp_replace(host, '^.*@|:[0-9]*$|\\.$', '', 'g') AS plain FROM parts),
labels_of AS (SELECT *, string_split(plain, '.') AS l FROM named),
placed AS (
    SELECT page_id, host, path,
           CASE WHEN long THEN array_to_string(l[-2:], '.') ELSE l[-1] END AS suffix,
           CASE WHEN regexp_matches(plain, '^[0-9.]+$') THEN plain
                ELSE array_to_string(l[CASE WHEN long THEN -3 ELSE -2 END:], '.') END AS domain
    FROM (SELECT *, array_to_string(l[-2:], '.')
                        IN ('co.uk', 'org.uk', 'com.au', 'co.jp', 'com.br') AS long
          FROM labels_of) z),
outcomes AS (
    SELECT doc_id, min(CASE WHEN quality = 1 AND toxic = 0 THEN 1
                            WHEN quality <> 1 OR toxic <> 0 THEN 0 END) AS good
    FROM labels GROUP BY doc_id),
h0 AS (
    SELECT host, domain, suffix, count(good) AS n, coalesce(sum(good), 0) AS good
    FROM placed LEFT JOIN outcomes ON page_id = doc_id GROUP BY host, domain, suffix),
d0 AS (SELECT domain, suffix, sum(n) AS n, sum(good) AS good FROM h0 GROUP BY domain, suffix),
s0 AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM d0 GROUP BY suffix),
s1 AS (SELECT *, (SELECT (sum(good) + 1.0::DOUBLE) / (sum(n) + 2.0::DOUBLE) FROM s0) AS mean
       FROM s0),
sk AS ({_strength("s1")}),
d1 AS (SELECT d0.*, (s1.good + k * s1.mean) / (s1.n + k) AS mean
       FROM d0 JOIN s1 USING (suffix), sk),
dk AS ({_strength("d1")}),
h1 AS (SELECT h0.*, (d1.good + k * d1.mean) / (d1.n + k) AS mean
       FROM h0 JOIN d1 USING (domain, suffix), dk),
hk AS ({_strength("h1")}),
standing AS (
    SELECT host, n, share, share + 2 * sqrt(share * (1 - share) / (n + k + 1)) AS upper_bound
    FROM (SELECT host, n, k, (good + k * mean) / (n + k) AS share FROM h1, hk) z),
ruled AS (
    SELECT *, CASE
        WHEN (host = 'example.net' OR ends_with(host, '.example.net'))
             AND starts_with(path, '/en/') THEN 'example.net/en/'
        WHEN (host = 'example.com' OR ends_with(host, '.example.com'))
             AND starts_with(path, '/de/') THEN 'example.com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
        WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
        END AS rule
    FROM placed)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
            WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
            WHEN upper_bound < 0.5 THEN 'block' ELSE 'allow' END AS verdict,
       n AS n_outcomes, round(share, 6) AS good_share, round(upper_bound, 6) AS upper_bound
FROM ruled JOIN standing USING (host)"""

_TOOL_CALLS = """
WITH calls AS (
    SELECT conv_id, turn, concat(conv_id, '-', turn) AS call_id, text
    FROM conversations WHERE role = 'user'),
results AS (
    SELECT conv_id, turn, concat(conv_id, '-', turn - 1) AS call_id, text
    FROM conversations WHERE role = 'assistant'),
ranked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, call_id ORDER BY turn, text) AS rn,
           EXISTS (SELECT 1 FROM calls c
                   WHERE c.conv_id = r.conv_id AND c.call_id = r.call_id) AS known
    FROM results r),
answers AS (SELECT * FROM ranked WHERE rn = 1)
SELECT c.conv_id, c.call_id, c.turn, 'answer' AS tool,
       CASE WHEN coalesce(length(c.text), 0) < 1 OR c.turn < 0 THEN 'invalid'
            WHEN a.call_id IS NULL THEN 'unanswered' ELSE 'ok' END AS status,
       0::INT AS stage, a.turn AS result_turn,
       concat('{"arguments":{',
              CASE WHEN c.text IS NOT NULL THEN concat('"prompt":', to_json(c.text), ',') END,
              '"turn":', c.turn, '},"id":', to_json(c.call_id), ',"name":"answer","result":',
              coalesce(to_json(a.text)::VARCHAR, 'null'), '}') AS json
FROM calls c LEFT JOIN answers a USING (conv_id, call_id)
UNION ALL
SELECT conv_id, call_id, turn, NULL, CASE WHEN known THEN 'extra_result' ELSE 'orphan' END,
       0::INT, turn,
       concat('{"arguments":null,"id":', to_json(call_id), ',"name":null,"result":',
              coalesce(to_json(text)::VARCHAR, 'null'), '}')
FROM ranked WHERE rn > 1 OR NOT known
UNION ALL
SELECT conv_id, NULL, turn, NULL, 'other', 0::INT, NULL,
       concat('{"content":', coalesce(to_json(text)::VARCHAR, 'null'), ',"role":',
              coalesce(to_json(role)::VARCHAR, 'null'), '}')
FROM conversations WHERE coalesce(role NOT IN ('user', 'assistant'), true)"""


def _field(name: str) -> str:
    return f"coalesce(concat(strlen({name}::VARCHAR), ':', {name}::VARCHAR), '-')"


def _table_crc32() -> str:
    """Rows (b, c): the CRC of every byte, by the eight steps of its polynomial."""
    step = "CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END"
    return f"""crc(b, c, k) AS (
    SELECT range, range, 0 FROM range(256)
    UNION ALL SELECT b, {step}, k + 1 FROM crc WHERE k < 8),
crc_table AS (SELECT list(c ORDER BY b) AS entries FROM crc WHERE k = 8)"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII text, byte by byte; needs ``crc_table`` in scope."""
    return f"""xor(4294967295, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split({text}, ''),
                                                lambda z: ascii(z)::BIGINT)),
        lambda s, z: xor(s // 256, entries[xor(s % 256, z) + 1])))"""


_MERKLE = f"""
WITH RECURSIVE {_table_crc32()},
hashed AS (
    SELECT doc_id, coalesce('=' || lang, '-') AS tree,
           sha256(concat({", ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars", "text"))}))
               AS leaf,
           sha256(concat({", ".join(_field(c) for c in ("doc_id", "source", "lang"))},
               CASE WHEN doc_id IS NOT NULL AND {_crc32("doc_id::VARCHAR")} % 7 = 0
                    THEN {_field("(n_chars + 1)")} ELSE {_field("n_chars")} END,
               {_field("text")})) AS changed
    FROM documents, crc_table),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY tree) AS n
    FROM hashed),
nodes(tree, level, place, n, h) AS (
    SELECT tree, 0, place, n, leaf FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM nodes WHERE n > 1 GROUP BY tree, level, place // 2),
subroots AS (
    SELECT tree, h AS subroot, row_number() OVER (ORDER BY tree) - 1 AS place,
           count(*) OVER () AS n
    FROM nodes WHERE n = 1),
tops(level, place, n, h) AS (
    SELECT 0, place, n, subroot FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, (max(n) + 1) // 2, sha256(string_agg(h, '' ORDER BY place))
    FROM tops WHERE n > 1 GROUP BY level, place // 2),
walk(doc_id, tree, leaf, place, n, level, acc, seen) AS (
    SELECT doc_id, tree, leaf, place, n, 0, changed, '' FROM leaves
    UNION ALL
    SELECT w.doc_id, w.tree, w.leaf, w.place // 2, (w.n + 1) // 2, w.level + 1,
           sha256(CASE WHEN w.place % 2 = 1 THEN coalesce(s.h, '') || acc
                       ELSE acc || coalesce(s.h, '') END), seen || coalesce(s.h, '')
    FROM walk w LEFT JOIN nodes s
         ON s.tree = w.tree AND s.level = w.level AND s.place = xor(w.place, 1)
    WHERE w.n > 1),
upper_walk(doc_id, leaf, subroot, place, n, level, acc, seen) AS (
    SELECT doc_id, leaf, subroot, u.place, u.n, 0, acc, seen
    FROM walk w JOIN subroots u USING (tree) WHERE w.n = 1
    UNION ALL
    SELECT w.doc_id, w.leaf, w.subroot, w.place // 2, (w.n + 1) // 2, w.level + 1,
           sha256(CASE WHEN w.place % 2 = 1 THEN coalesce(s.h, '') || acc
                       ELSE acc || coalesce(s.h, '') END), seen || coalesce(s.h, '')
    FROM upper_walk w LEFT JOIN tops s ON s.level = w.level AND s.place = xor(w.place, 1)
    WHERE w.n > 1)
SELECT doc_id, leaf, subroot, t.h AS root, sha256(seen) AS proof_sha256, acc AS folded_root,
       acc = t.h AS verified
FROM upper_walk w, (SELECT h FROM tops WHERE n = 1) t WHERE w.n = 1"""


def _plus(path: str, cost: str, letter: str) -> str:
    """A path (nine digits of cost, then its edits) made longer by one edit."""
    more = f"lpad((left({path}, 9)::BIGINT + {cost})::VARCHAR, 9, '0')"
    return f"({more} || substr({path}, 10) || '{letter}')"


_SPACES = "concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
# Paths to each state before the next row, with rows inserted: states start, s, u, a.
_INSERTED = f"""
    SELECT key, p, v0 AS w0, v1 AS w1,
           least(u, {_plus("a", "3", "I")}) AS w2, a AS w3
    FROM (SELECT *, least(v3, {_plus("u", "3", "I")}) AS a
          FROM (SELECT *, least(v2, {_plus("v0", "3", "I")}, {_plus("v1", "3", "I")},
                                {_plus("v3", "3", "I")}) AS u
                FROM paths) y) z"""


def _to_user(state: str) -> str:
    kept = f"CASE WHEN r.initial = 'u' AND NOT gone THEN {_plus(state, 'late', 'K')} END"
    return f"{kept}, CASE WHEN NOT gone THEN {_plus(state, '3 + late', 'R')} END"


_REPAIR = f"""
WITH RECURSIVE {_table_crc32()},
spoilt AS (
    SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
           CASE k WHEN 1 THEN '' WHEN 2 THEN translate(coalesce(text, ' '), '.!?', '')
                  ELSE coalesce(text, ' ') END AS text, k
    FROM (SELECT *, {_crc32("concat(coalesce(conv_id::VARCHAR, ' '), ':', coalesce(turn::VARCHAR, ' '))")}
                        % 20 AS k FROM conversations, crc_table) z
    WHERE k <> 0),
twice AS (SELECT * FROM spoilt UNION ALL SELECT * FROM spoilt WHERE k = 3),
placed AS (
    SELECT coalesce('=' || conv_id, '-') AS key, turn, role, text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS p,
           rtrim(text, {_SPACES}) AS bare
    FROM twice),
faulted AS (
    SELECT *, left(role, 1) AS initial,
           CASE WHEN bare = '' THEN 'blank'
                WHEN row_number() OVER (PARTITION BY key, role, text ORDER BY p) > 1 THEN 'duplicate'
                WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
           lead(left(role, 1)) OVER (PARTITION BY key ORDER BY p) AS follows
    FROM placed),
judged AS (
    SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS gone,
           CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END AS late
    FROM faulted),
counts AS (
    SELECT key, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (fault = 'blank') AS blank,
           count(*) FILTER (fault = 'duplicate') AS duplicate,
           count(*) FILTER (fault = 'truncated') AS truncated,
           count(*) FILTER (follows IS NOT NULL AND initial || follows NOT IN ('su', 'ua', 'au'))
               AS illegal,
           count(*) AS n
    FROM judged GROUP BY key),
paths(key, p, v0, v1, v2, v3) AS (
    SELECT key, 1::BIGINT, '000000000', NULL::VARCHAR, NULL::VARCHAR, NULL::VARCHAR FROM counts
    UNION ALL
    SELECT w.key, w.p + 1, {_plus("w0", "4", "D")},
           least({_plus("w1", "4", "D")},
                 CASE WHEN r.initial = 's' AND NOT gone THEN {_plus("w0", "late", "K")} END),
           least({_plus("w2", "4", "D")}, {_to_user("w0")}, {_to_user("w1")}, {_to_user("w3")}),
           least({_plus("w3", "4", "D")},
                 CASE WHEN r.initial = 'a' AND NOT gone THEN {_plus("w2", "late", "K")} END,
                 CASE WHEN NOT gone THEN {_plus("w2", "3 + late", "R")} END)
    FROM ({_INSERTED}) w JOIN judged r ON r.key = w.key AND r.p = w.p),
best AS (
    SELECT key, left(path, 9)::BIGINT AS cost, substr(path, 10) AS audit
    FROM (SELECT w.key, least(w0, w3) AS path
          FROM ({_INSERTED}) w JOIN counts c ON c.key = w.key AND w.p = c.n + 1) z),
letters AS (
    SELECT key, i, audit[i] AS letter FROM (SELECT key, audit, unnest(range(1, len(audit) + 1)) AS i
                                            FROM best) z),
numbered AS (
    SELECT *, sum((letter <> 'I')::INT) OVER w AS p, sum((letter <> 'D')::INT) OVER w AS m
    FROM letters WINDOW w AS (PARTITION BY key ORDER BY i)),
edited AS (
    SELECT l.key, i, m, letter, r.role, r.text,
           bool_or(m = 1 AND letter = 'K' AND initial = 's') OVER (PARTITION BY l.key) AS headed
    FROM numbered l LEFT JOIN judged r ON r.key = l.key AND r.p = l.p AND letter <> 'I'
    WHERE letter <> 'D'),
digests AS (
    SELECT key, sha256(string_agg(
        concat(CASE WHEN letter = 'K' THEN role
                    WHEN (m - headed::INT) % 2 = 1 THEN 'user' ELSE 'assistant' END,
               ':', CASE WHEN letter = 'I' THEN '' ELSE text END), chr(10) ORDER BY i)) AS digest
    FROM edited GROUP BY key)
SELECT conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank,
       coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
       coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce('=' || conv_id, '-') AS key FROM conversations) k
LEFT JOIN counts USING (key) LEFT JOIN best USING (key) LEFT JOIN digests USING (key)"""


def oracle_sql() -> dict[str, str]:
    return {
        "op2_host_reputation": _HOST_REPUTATION,
        "op3_tool_call_linking": _TOOL_CALLS,
        "op11_four_russians_repair": _REPAIR,
        "op13_octopus_manifest": _MERKLE,
    }
