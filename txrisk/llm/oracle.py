"""DuckDB SQL for the rows of the registered queries that SQL can express."""

from __future__ import annotations

from txrisk.llm import chat, warc_audit

CONTROL = chat.CONTROL.replace("'", "''")

OP3 = f"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), parts AS (
    SELECT *, regexp_replace(replace(replace(role, '\\', '\\\\'), chr(10), '\\n'), '{CONTROL}', '\\1\\\\\\2\\3', 'g') AS head,
        regexp_replace(text, '{CONTROL}', '\\1\\\\\\2\\3', 'g') AS body
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
    CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
    sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
    CAST(sum(length(head) + length(body) + 8) AS BIGINT) AS formatted_chars
FROM parts GROUP BY conv_id
"""

OP5 = """
WITH RECURSIVE doc AS (
    SELECT row_number() OVER () AS r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \\t\\n\\x0B\\f\\r]+') AS w
    FROM documents
), places AS (
    SELECT r, w, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS i FROM doc WHERE len(w) > 0
), shingle AS (
    SELECT DISTINCT r, hash(array_to_string(list_slice(w, i, i + 3), ' ')) AS s FROM places
), sizes AS (
    SELECT r, count(*) AS n FROM shingle GROUP BY r
), common AS (
    SELECT a.r AS x, b.r AS y, count(*) AS c FROM shingle a JOIN shingle b ON a.s = b.s AND a.r < b.r GROUP BY ALL
), link AS (
    SELECT x, y FROM common JOIN sizes a ON x = a.r JOIN sizes b ON y = b.r WHERE 100 * c >= 85 * (a.n + b.n - c)
), edge AS (
    SELECT x, y FROM link UNION ALL SELECT y, x FROM link
), reach AS (
    SELECT r AS x, r AS y FROM doc UNION SELECT reach.x, edge.y FROM reach JOIN edge ON reach.y = edge.x
)
SELECT doc.doc_id, coalesce(n, 0) AS n_shingles, min(other.doc_id) AS component_id
FROM doc LEFT JOIN sizes USING (r) JOIN reach ON reach.x = doc.r JOIN doc other ON other.r = reach.y
GROUP BY doc.r, doc.doc_id, n
"""

OP6 = """
WITH doc AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM (SELECT doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents)
), item AS (
    SELECT coalesce(CAST(item_id AS VARCHAR), 'null') AS item, regexp_extract_all(coalesce(text, ''), '[0-9a-z\\x{80}-\\x{10FFFF}]+') AS w
    FROM (SELECT item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM benchmark)
), item_at AS (
    SELECT item, w, least(len(w), 13) AS n, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS i FROM item WHERE len(w) > 0
), windows AS (
    SELECT DISTINCT item, n, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key FROM item_at
), doc_at AS (
    SELECT r, n, w, unnest(range(1, len(w) - n + 2)) AS i FROM doc, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n
), found AS (
    SELECT r, i, windows.n AS n, item
    FROM (SELECT r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') AS key FROM doc_at) AS d
    JOIN windows ON d.n = windows.n AND d.key = windows.key
), hits AS (
    SELECT r, count(DISTINCT place) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS place FROM found) GROUP BY r
), items AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * n_hit >= len(w) AS contaminated
FROM doc LEFT JOIN hits USING (r) LEFT JOIN items USING (r)
"""

OP7 = """
WITH sized AS (
    SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^ \\t\\n\\x0B\\f\\r]+')) AS BIGINT) AS size FROM documents
), sums AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM sized GROUP BY source
), weighted AS (
    SELECT *, source_size * 3 AS cap,
        [5, 2, 1][CAST((row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1 AS INTEGER)] AS weight
    FROM sums
), turns AS (
    SELECT *, row_number() OVER (ORDER BY cap / weight, source IS NULL, source) AS turn FROM weighted
), lefts AS (
    SELECT *, CAST(sum(source_size) OVER () - coalesce(sum(cap) OVER w, 0) AS BIGINT) AS words_left,
        CAST(sum(weight) OVER () - coalesce(sum(weight) OVER w, 0) AS BIGINT) AS weight_left
    FROM turns WINDOW w AS (ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT words_left, weight_left FROM lefts WHERE words_left * weight <= cap * weight_left ORDER BY turn LIMIT 1
), goals AS (
    SELECT source, source_size,
        least(CAST(level.words_left AS DOUBLE) * weight / level.weight_left, CAST(cap AS DOUBLE)) AS target
    FROM lefts, level
), rates AS (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE)
            / 4503599627370496 AS drawn
    FROM sized JOIN goals ON sized.source IS NOT DISTINCT FROM goals.source
)
SELECT doc_id, size, source_size, target,
    CAST(size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM rates
"""

OP9 = f"""
WITH made AS (
    SELECT page_id, url,
        CAST('0x' || substr(md5(coalesce(CAST(page_id AS VARCHAR), '') || '|' || coalesce(url, '')), 1, 13) AS BIGINT)
            % (SELECT greatest(1, (count(*) + {warc_audit.FILE_RECORDS - 1}) // {warc_audit.FILE_RECORDS}) FROM pages) AS file,
        'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: response' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:'
            || coalesce(CAST(page_id AS VARCHAR), '') || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || coalesce(url, '')
            || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '
            || strlen(coalesce(html, '')) || chr(13) || chr(10) || chr(13) || chr(10) || coalesce(html, '')
            || chr(13) || chr(10) || chr(13) || chr(10) AS record
    FROM pages
), hashed AS (
    SELECT page_id, url, file, CAST(strlen(record) AS BIGINT) AS length, sha256(record) AS sha256 FROM made
)
SELECT page_id, file, CAST(row_number() OVER w - 1 AS INTEGER) AS position,
    CAST(coalesce(sum(length) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset", length, sha256,
    CASE WHEN CAST('0x' || substr(md5(CAST(page_id AS VARCHAR)), 1, 8) AS BIGINT) % 101 = 7 THEN 'changed' ELSE 'sound' END AS state
FROM hashed WINDOW w AS (PARTITION BY file ORDER BY page_id NULLS FIRST, url NULLS FIRST, sha256)
"""

OP10 = """
WITH digested AS (
    SELECT doc_id, length(coalesce(text, '')) AS n,
        sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS text_sha256
    FROM documents
), ranked AS (
    SELECT *, first_value(doc_id) OVER w AS keep_id, first_value(n) OVER w AS keep_n,
        count(*) OVER (PARTITION BY text_sha256) AS group_size
    FROM digested WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id NULLS LAST)
)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AND n = keep_n AS kept, text_sha256 FROM ranked
"""

OP12 = r"""
WITH parsed AS (
    SELECT page_id, coalesce(url LIKE '%://%', false) AS has,
        translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path,
        coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*(.*)$', 1), '') AS rest
    FROM pages
), rules(verdict, rule_host, rule_path) AS (
    VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
        ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), best AS (
    SELECT *, (
        SELECT max_by(rule_host || rule_path || ' ' || verdict, length(rule_host || rule_path)) FROM rules
        WHERE ends_with('.' || host, '.' || rule_host) AND starts_with(path, rule_path)
    ) AS found, CASE WHEN NOT has THEN NULL
        WHEN contains(rest, '/wp-login.php') THEN 'login'
        WHEN regexp_matches('.' || host, '[.]spam-farm[.]') THEN 'spam farm'
        WHEN contains(host, '-casino.') THEN 'casino'
        WHEN contains(rest, '?sessionid=') THEN 'session'
        WHEN contains(rest, '/cart/') THEN 'cart'
        WHEN ends_with(rest, '.zip') THEN 'archive' END AS other
    FROM parsed
)
SELECT page_id, host, path, split_part(found, ' ', 1) AS rule,
    CASE WHEN found IS NULL THEN other END AS pattern,
    CASE WHEN found IS NOT NULL THEN split_part(found, ' ', 2) WHEN pattern IS NULL THEN 'allow' ELSE 'block' END AS verdict
FROM best
"""


def crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text: eight shifts for each character."""
    shifts = "list_reduce([xor(crc, character), 0, 0, 0, 0, 0, 0, 0, 0], lambda v, z: xor(v >> 1, 3988292384 * (v & 1)))"
    start = "[CAST(4294967295 AS BIGINT)]"
    codes = f"list_transform(string_split({text}, ''), lambda x: CAST(ascii(x) AS BIGINT))"
    return f"xor(list_reduce(list_concat({start}, {codes}), lambda crc, character: {shifts}), 4294967295)"


OP11 = f"""
WITH said AS (
    SELECT conv_id, turn, sha256(sha256(coalesce(role, '')) || coalesce(text, '')) AS told, CAST(length(coalesce(text, '')) AS BIGINT) AS chars
    FROM conversations WHERE conv_id IS NOT NULL
), turns AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, told) AS k FROM said
), ids AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, {crc32_sql("CAST(conv_id AS VARCHAR)")} % 6 AS h, count(*) AS own FROM turns GROUP BY ALL
), planned AS (
    SELECT ids.*, least(ids.h, coalesce(b.own, 0)) AS head FROM ids LEFT JOIN ids b ON b.conv_id = ids.base
), rebuilt AS (
    SELECT p.conv_id AS c, k AS d, told, chars FROM planned p JOIN turns ON turns.conv_id = base AND k <= head
    UNION ALL SELECT p.conv_id, head + k - h, told, chars FROM planned p JOIN turns ON turns.conv_id = p.conv_id AND k > h
    UNION ALL SELECT conv_id, 0, '', 0 FROM planned
), paths AS (
    SELECT c, d, chars, string_agg(told, '') OVER (PARTITION BY c ORDER BY d) AS path, d = max(d) OVER (PARTITION BY c) AS is_end FROM rebuilt
), nodes AS (
    SELECT d, path, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
        sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (is_end), '')) AS ends_sha256
    FROM paths GROUP BY d, path
), children AS (
    SELECT left(path, 64 * (d - 1)) AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), whole AS (
    SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (path)
), above AS (
    SELECT left(path, 64 * i) AS path, n_children = 0 AS leaf, (n_convs - 1) * chars AS saved
    FROM (SELECT *, unnest(range(0, d + 1)) AS i FROM whole)
), sums AS (
    SELECT path, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM above GROUP BY path
)
SELECT w.conv_id, w.d AS depth, p.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM whole w JOIN sums USING (path) LEFT JOIN nodes p ON w.d > 0 AND p.path = left(w.path, 64 * (w.d - 1))
"""

#: Of the states of a repair, the cheapest text "cost and edits": nothing, s, u and a before.
def _cheapest(*ways: tuple[str, str, str]) -> str:
    """The least of ways: (state, cost, edit). A cost is held as six digits, so that texts compare by cost, then edits."""
    made = ", ".join(f"lpad(CAST(CAST(left({s}, 6) AS BIGINT) + ({c}) AS VARCHAR), 6, '0') || substr({s}, 7) || '{e}'" for s, c, e in ways)
    return f"list_min([{made}])"


#: An inserted user after nothing, s or a; an inserted assistant after u; and again, as one may lead to the other.
_AFTER_U = f"list_min([u, {_cheapest(('z', '3', 'I'), ('s', '3', 'I'), ('a', '3', 'I'))}])"
_AFTER_A = f"list_min([a, {_cheapest(('u', '3', 'I'))}])"

OP13 = f"""
WITH RECURSIVE keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        {crc32_sql("(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS kind
    FROM conversations
), damaged AS (
    SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM keyed
), numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(sha256(role) || text), copy) AS k FROM damaged
), initials AS (
    SELECT *, CASE WHEN left(role, 1) IN ('s', 'u', 'a') THEN left(role, 1) ELSE 'x' END AS initial,
        CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
            WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
            WHEN regexp_matches(text, '[^.!?\x20\x09-\x0D][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault
    FROM numbered
), pairs AS (
    SELECT *, coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial NOT IN ('su', 'ua', 'au'), false) AS illegal FROM initials
), sums AS (
    SELECT conv_id, count(*) AS rows, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
        count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
        count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (illegal) AS illegal
    FROM pairs GROUP BY conv_id
), searched AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS k, '000000' AS z, CAST(NULL AS VARCHAR) AS s, '000003I' AS u, '000006II' AS a FROM sums
    UNION ALL
    SELECT conv_id, k, z, s, u, a FROM (
        SELECT conv_id, k, z, s, u, {_AFTER_A} AS a FROM (
            SELECT conv_id, k, z, s, {_AFTER_U} AS u, a FROM (
                SELECT conv_id, k, z, s, u, {_AFTER_A} AS a FROM (
                    SELECT b.conv_id, r.k, {_cheapest(('b.z', '4', 'D'))} AS z,
                        list_min([{_cheapest(('b.s', '4', 'D'))}, CASE WHEN may AND initial = 's' THEN {_cheapest(('b.z', 'more', 'K'))} END]) AS s,
                        list_min([{_cheapest(('b.u', '4', 'D'))},
                            CASE WHEN may AND initial = 'u' THEN {_cheapest(('b.z', 'more', 'K'), ('b.s', 'more', 'K'), ('b.a', 'more', 'K'))} END,
                            CASE WHEN may THEN {_cheapest(('b.z', 'more + 3', 'R'), ('b.s', 'more + 3', 'R'), ('b.a', 'more + 3', 'R'))} END]) AS u,
                        list_min([{_cheapest(('b.a', '4', 'D'))}, CASE WHEN may AND initial = 'a' THEN {_cheapest(('b.u', 'more', 'K'))} END,
                            CASE WHEN may THEN {_cheapest(('b.u', 'more + 3', 'R'))} END]) AS a
                    FROM searched b JOIN (
                        SELECT *, fault NOT IN ('blank', 'duplicate') AS may, CASE fault WHEN 'truncated' THEN 3 ELSE 0 END AS more FROM initials
                    ) r ON r.conv_id IS NOT DISTINCT FROM b.conv_id AND r.k = b.k + 1
                )
            )
        )
    )
), best AS (
    SELECT conv_id, list_min([z, a]) AS best FROM searched WHERE k = (SELECT max(rows) FROM sums WHERE sums.conv_id IS NOT DISTINCT FROM searched.conv_id)
), edits AS (
    SELECT conv_id, CAST(left(best, 6) AS BIGINT) AS cost, substr(best, 7) AS audit, unnest(range(1, length(best) - 5)) AS i FROM best
), made AS (
    SELECT conv_id, i, substr(audit, i, 1) AS edit, length(replace(left(audit, i), 'I', '')) AS k, length(replace(left(audit, i), 'D', '')) AS place FROM edits
), first_kept AS (
    SELECT made.conv_id, edit = 'K' AND initial = 's' AS system FROM made LEFT JOIN initials r ON r.conv_id IS NOT DISTINCT FROM made.conv_id AND r.k = made.k
    WHERE edit <> 'D' AND place = 1
), repaired AS (
    SELECT made.conv_id, sha256(string_agg(CASE edit WHEN 'K' THEN role || ':' || text ELSE
        CASE WHEN (place + CAST(system AS INTEGER)) % 2 = 1 THEN 'user:' ELSE 'assistant:' END || CASE edit WHEN 'R' THEN text ELSE '' END END, chr(10) ORDER BY i)) AS sha
    FROM made JOIN first_kept f ON f.conv_id IS NOT DISTINCT FROM made.conv_id
    LEFT JOIN initials r ON r.conv_id IS NOT DISTINCT FROM made.conv_id AND r.k = made.k WHERE edit <> 'D' GROUP BY made.conv_id
), of_all AS (
    SELECT DISTINCT conv_id FROM conversations
)
SELECT of_all.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
    coalesce(illegal, 0) AS illegal, coalesce(CAST(left(best, 6) AS BIGINT), 0) AS cost, coalesce(substr(best, 7), '') AS audit, coalesce(sha, sha256('')) AS repaired_sha256
FROM of_all LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM of_all.conv_id LEFT JOIN best ON best.conv_id IS NOT DISTINCT FROM of_all.conv_id
    LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM of_all.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat_format": OP3,
        "op5_jaccard_join": OP5,
        "op6_decontaminate": OP6,
        "op7_mixing": OP7,
        "op9_merkle_audit": OP9,
        "op10_exact_dedup": OP10,
        "op11_prefix_trie": OP11,
        "op12_url_rules": OP12,
        "op13_structure_repair": OP13,
    }
