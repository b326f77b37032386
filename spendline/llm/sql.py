"""DuckDB twins of the queries that SQL can express."""

ORACLES: dict[str, str] = {
    "op4_chat": """
        WITH numbered AS (
            SELECT conv_id, turn, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS nth,
                   '<|im_start|>' || coalesce(role, '') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10) AS line FROM conversations),
        rolled AS (
            SELECT conv_id, turn, nth, line, count(*) OVER (PARTITION BY conv_id) AS n_turns,
                   string_agg(line, '') OVER (PARTITION BY conv_id ORDER BY nth) AS upto FROM numbered),
        ends AS (SELECT n_turns, upto, min(conv_id) AS conv_id, count(*) AS n_copies FROM rolled WHERE nth = n_turns GROUP BY ALL),
        kept AS (SELECT * FROM ends e WHERE NOT EXISTS (SELECT 1 FROM rolled r WHERE r.nth < r.n_turns AND r.nth = e.n_turns AND r.upto = e.upto))
        SELECT k.conv_id, k.n_turns, k.n_copies, r.turn // 256 AS part, string_agg(r.line, '' ORDER BY r.nth) AS rendered
        FROM kept k JOIN rolled r USING (conv_id) GROUP BY ALL""",
    "op5_line_dedup": """
        WITH lines AS (
            SELECT doc_id, position, line, trim(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                        ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS key
            FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS position FROM documents)),
        common AS (SELECT key FROM lines WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
        SELECT doc_id, count(*) AS n_lines, count(c.key) AS n_dropped,
               sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
        FROM lines l LEFT JOIN common c ON l.key = c.key GROUP BY doc_id""",
    "op11_prefix_trie": r"""
        WITH numbered AS (
            SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
                PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(md5(coalesce(role, '')) || md5(coalesce(text, '')))) AS nth
            FROM conversations WHERE conv_id IS NOT NULL),
        crc AS (    -- crc32 of the decimal number, bit by bit
            WITH RECURSIVE steps AS (
                SELECT DISTINCT conv_id, conv_id::VARCHAR AS s, 0 AS k, 4294967295::BIGINT AS c FROM numbered
                UNION ALL
                SELECT conv_id, s, k + 1, CASE WHEN k % 9 = 0 THEN xor(c, ascii(s[k // 9 + 1])::BIGINT) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END
                FROM steps WHERE k < 9 * length(s))
            SELECT conv_id, xor(c, 4294967295::BIGINT) % 4 AS h FROM steps WHERE k = 9 * length(s)),
        rebuilt AS (
            SELECT c.conv_id, n.role, n.text, n.nth, 0 AS own FROM crc c JOIN numbered n ON n.conv_id = c.conv_id - c.conv_id % 20 AND n.nth <= c.h
            UNION ALL
            SELECT c.conv_id, n.role, n.text, n.nth, 1 FROM crc c JOIN numbered n ON n.conv_id = c.conv_id AND n.nth > c.h),
        prefixes AS (
            SELECT conv_id, row_number() OVER w AS depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
                   string_agg(length(role) || ':' || role || length(text) || ':' || text, '') OVER w AS path
            FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY own, nth)
            UNION ALL
            SELECT conv_id, 0, 0, '' FROM crc),
        members AS (
            SELECT conv_id, depth, words, path, count(*) OVER node AS n_convs, min(conv_id) OVER node AS owner, max(depth) OVER (PARTITION BY conv_id) AS length
            FROM prefixes WINDOW node AS (PARTITION BY depth, path)),
        nodes AS (
            SELECT m.depth, m.path, m.owner, m.n_convs, any_value(u.owner) AS parent_conv_id,
                   coalesce(string_agg(m.conv_id::VARCHAR, ',' ORDER BY m.conv_id) FILTER (WHERE m.depth = m.length), '') AS ends, bool_and(m.depth = m.length) AS leaf
            FROM members m LEFT JOIN members u ON u.conv_id = m.conv_id AND u.depth = m.depth - 1 GROUP BY m.depth, m.path, m.owner, m.n_convs),
        below AS (
            SELECT a.depth, a.path, count(*) FILTER (WHERE b.depth = a.depth + 1) AS n_children, count(*) FILTER (WHERE n.leaf) AS n_leaves, sum((b.n_convs - 1) * b.words) AS saved_tokens
            FROM members a JOIN members b ON b.conv_id = a.conv_id AND b.depth >= a.depth AND b.owner = b.conv_id JOIN nodes n ON n.depth = b.depth AND n.path = b.path
            GROUP BY a.depth, a.path)
        SELECT owner::BIGINT AS conv_id, depth::BIGINT AS depth, parent_conv_id::BIGINT AS parent_conv_id, n_convs::BIGINT AS n_convs, n_children::BIGINT AS n_children,
               n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(ends) AS ends_sha256
        FROM nodes JOIN below USING (depth, path)""",
    "op12_filter_audit": r"""
        WITH flags AS (
            SELECT part, CASE WHEN len(words) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(words)) < 50 * len(words) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY t) THEN 16 ELSE 0 END AS mask,
                   EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.quality = 1) AS good,
                   EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1) AS toxic
            FROM (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents) d),
        counts AS (SELECT part, mask, count(*) AS docs, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic FROM flags GROUP BY part, mask),
        letter AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(f, b)),
        perms AS (
            SELECT v.f || w.f || x.f || y.f || z.f AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bits
            FROM letter v JOIN letter w ON w.f <> v.f JOIN letter x ON x.f NOT IN (v.f, w.f) JOIN letter y ON y.f NOT IN (v.f, w.f, x.f) JOIN letter z ON z.f NOT IN (v.f, w.f, x.f, y.f)),
        steps AS (
            SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[:step - 1]), 0)::INT AS state
            FROM perms, (SELECT unnest([1, 2, 3, 4, 5]) AS step)),
        rows AS (
            SELECT part, filter_order, step, bit, coalesce(sum(docs) FILTER (WHERE mask & (state | bit) = 0), 0)::BIGINT AS kept,
                   coalesce(sum(docs) FILTER (WHERE mask & state = 0 AND mask & bit <> 0), 0)::BIGINT AS removed,
                   coalesce(sum(docs) FILTER (WHERE mask & state <> 0 AND mask & bit <> 0), 0)::BIGINT AS redundant,
                   coalesce(sum(docs) FILTER (WHERE mask = bit), 0)::BIGINT AS unique_fails,
                   coalesce(sum(good) FILTER (WHERE mask & state = 0 AND mask & bit <> 0), 0)::BIGINT AS good_lost,
                   coalesce(sum(toxic) FILTER (WHERE mask & state = 0 AND mask & bit <> 0), 0)::BIGINT AS toxic_lost
            FROM counts, steps GROUP BY part, filter_order, step, bit)
        SELECT part, filter_order, step::INT AS step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley FROM rows""",
    "op13_secrets": r"""
        WITH docs AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
        patterns AS (SELECT * FROM (VALUES
            (0, 'assign', '(?i:(?:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)'), (1, 'access', '(AKIA[A-Z0-9]{14,})'), (2, 'hex', '([0-9a-f]{16,})'),
            (3, 'opaque', '([A-Za-z0-9+/_-]{20,})'), (4, 'login', '[A-Za-z][A-Za-z0-9+.-]*://[^\x00-\x20/:@]+:([^\x00-\x20/:@]+)@')) AS v(rank, kind, p)),
        cut AS (
            SELECT r, doc_id, source, rank, kind, regexp_extract_all(t, p, 0) AS whole, regexp_extract_all(t, p, 1) AS vals,
                   string_split(regexp_replace(t, p, chr(1), 'g'), chr(1)) AS gaps FROM docs, patterns),
        nth AS (
            SELECT r, doc_id, source, rank, kind, whole[i] AS span, vals[i] AS val,
                   list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(whole[:i - 1], lambda g: length(g))), 0) AS start
            FROM (SELECT *, unnest(generate_series(1, len(whole))) AS i FROM cut)),
        hits AS (
            SELECT r, doc_id, source, rank, kind, val, start::BIGINT AS start, (start + length(span))::BIGINT AS stop FROM nth
            WHERE CASE kind WHEN 'assign' THEN length(val) >= 12 WHEN 'login' THEN length(val) >= 8 WHEN 'opaque' THEN
                  (regexp_matches(val, '^(ghp_|gho_|ghu_|ghs_|glpat-|sk-|xoxa-|xoxb-|xoxp-|AIza|eyJ|AKIA|ASIA)')
                       OR regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[0-9].*[0-9]')) ELSE true END),
        free AS (SELECT * FROM hits h WHERE rank < 3 OR NOT EXISTS (SELECT 1 FROM hits b WHERE b.r = h.r AND b.rank < 3 AND b.start < h.stop AND h.start < b.stop)),
        spread AS (SELECT val, count(DISTINCT coalesce(source, chr(1))) AS owners FROM free GROUP BY val),
        judged AS (
            SELECT f.*, CASE WHEN owners >= 3 THEN 'example'
                        WHEN 8 * list_sum(list_transform(map_values(list_histogram(string_split(val, ''))), lambda n: n * n)) <= length(val) ** 2 THEN 'live' ELSE 'unclear' END AS verdict,
                   kind || ':' || start || ':' || stop AS name FROM free f JOIN spread USING (val))
        SELECT d.doc_id, count(*) FILTER (WHERE kind = 'assign') AS n_assign, count(*) FILTER (WHERE kind = 'access') AS n_access, count(*) FILTER (WHERE kind = 'hex') AS n_hex,
               sha256(coalesce(string_agg(name, ',' ORDER BY start, rank) FILTER (WHERE rank < 3), '')) AS base_sha256,
               coalesce(string_agg(name, ',' ORDER BY start, rank), '') AS spans,
               coalesce(string_agg(name, ',' ORDER BY start, rank) FILTER (WHERE verdict = 'live'), '') AS live_spans,
               coalesce(string_agg(name, ',' ORDER BY start, rank) FILTER (WHERE verdict = 'example'), '') AS example_spans
        FROM docs d LEFT JOIN (SELECT * FROM judged WHERE rank < 3 OR verdict = 'live') j USING (r) GROUP BY d.r, d.doc_id""",
}
