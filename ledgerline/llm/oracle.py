"""DuckDB SQL of those queries of this package that SQL can express."""

from __future__ import annotations

_CRC = """
        crc_table AS (SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
                      lambda c, x: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS tab)"""


def _crc(units: str) -> str:
    """CRC-32 of a list of bytes, with ``crc_table`` joined."""
    return f"xor(list_reduce(list_concat([4294967295], {units}), lambda c, b: xor(tab[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


def _merkle(levels: int = 8, upper: int = 4, fan: int = 8) -> str:
    """The trees of up to ``fan`` ** ``levels`` rows a group and ``fan`` ** ``upper`` groups, level by level."""
    field = lambda x: f"coalesce(strlen({x}::VARCHAR)::VARCHAR || ':' || {x}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(field(x) for x in ("doc_id", "source", "lang", "n_chars", text)) + ")"
    digits = "list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)"
    parts = [_CRC.strip(), f"""read AS (
            SELECT doc_id, coalesce('+' || lang, '') AS g, {leaf('text')} AS leaf,
                   CASE WHEN {_crc(digits)} % 3 = 0 THEN {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} ELSE {leaf('text')} END AS changed
            FROM documents, crc_table)""", """climb_g0 AS (
            SELECT doc_id, leaf, g, changed AS folded, '' AS proof, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                   count(*) OVER (PARTITION BY g) AS n FROM read)""", "node_g0 AS (SELECT g, pos, n, leaf AS digest FROM climb_g0)"]

    def up(kind: str, k: int) -> list[str]:
        before, after = "array_to_string(kids[1:c.pos % {0}], '')".format(fan), "array_to_string(kids[c.pos % {0} + 2:], '')".format(fan)
        return [f"""run_{kind}{k} AS (SELECT g, pos // {fan} AS up, list(digest ORDER BY pos) AS kids, max(n) AS n FROM node_{kind}{k} GROUP BY ALL)""",
                f"""node_{kind}{k + 1} AS (SELECT g, up AS pos, (n + {fan - 1}) // {fan} AS n, CASE WHEN n = 1 THEN kids[1] ELSE sha256(array_to_string(kids, '')) END AS digest FROM run_{kind}{k})""",
                f"""climb_{kind}{k + 1} AS (
            SELECT c.* EXCLUDE (folded, proof, pos, n), CASE WHEN c.n = 1 THEN folded ELSE sha256({before} || folded || {after}) END AS folded,
                   CASE WHEN c.n = 1 THEN proof ELSE proof || {before} || {after} END AS proof, c.pos // {fan} AS pos, (c.n + {fan - 1}) // {fan} AS n
            FROM climb_{kind}{k} c JOIN run_{kind}{k} r ON c.g = r.g AND c.pos // {fan} = r.up)"""]

    for k in range(levels):
        parts += up("g", k)
    parts += [f"ranked AS (SELECT g AS name, digest, row_number() OVER (ORDER BY g) - 1 AS pos, count(*) OVER () AS n FROM node_g{levels})",
              "node_r0 AS (SELECT '' AS g, pos, n, digest FROM ranked)",
              f"climb_r0 AS (SELECT c.* EXCLUDE (g, pos, n), digest AS subroot, '' AS g, r.pos, r.n FROM climb_g{levels} c JOIN ranked r ON c.g = r.name)"]
    for k in range(upper):
        parts += up("r", k)
    return f"""WITH {", ".join(parts)}
        SELECT doc_id, leaf, subroot, digest AS root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = digest AS verified
        FROM climb_r{upper}, node_r{upper}"""


SQL: dict[str, str] = {
    "op5_exact_dedup": r"""
        WITH plain AS (
            SELECT doc_id, length(coalesce(text, '')) AS n_points,
                   regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS body
            FROM documents),
        placed AS (
            SELECT doc_id, body,
                   first_value(doc_id) OVER w AS keep_id,
                   count(*) OVER (PARTITION BY body) AS group_size,
                   row_number() OVER w AS place
            FROM plain WINDOW w AS (PARTITION BY body ORDER BY n_points DESC, doc_id NULLS LAST))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(body) AS text_sha256 FROM placed
    """,
    "op8_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS weight
            FROM sized GROUP BY source),
        ranked AS (
            SELECT *, 3 * source_size AS cap, 3 * source_size / weight AS most_share,
                   sum(source_size) OVER () AS total, sum(weight) OVER () AS weights,
                   coalesce(sum(3 * source_size) OVER w, 0) AS capped, coalesce(sum(weight) OVER w, 0) AS closed
            FROM sources
            WINDOW w AS (ORDER BY 3 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
        level AS (
            SELECT (total - capped)::DOUBLE / (weights - closed)::DOUBLE AS share FROM ranked
            WHERE (total - capped)::DOUBLE / (weights - closed)::DOUBLE <= most_share ORDER BY most_share, source NULLS LAST LIMIT 1),
        rated AS (
            SELECT r.source, source_size, least(weight * share, cap::DOUBLE) AS target,
                   CASE WHEN source_size > 0 THEN least(least(weight * share, cap::DOUBLE) / source_size, 3.0::DOUBLE) ELSE 0 END AS rate
            FROM ranked r, level),
        drawn AS (
            SELECT s.*, r.source_size, r.target, r.rate,
                   ('0x' || substr(md5('17:' || coalesce(s.doc_id::VARCHAR, 'null')), 1, 12))::BIGINT / 281474976710656.0::DOUBLE AS draw
            FROM sized s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source),
        copied AS (SELECT *, floor(rate)::BIGINT + (draw < rate - floor(rate))::BIGINT AS copies FROM drawn)
        SELECT doc_id, size, source_size, target, size * copies AS taken, copies FROM copied
    """,
    "op10_warc_revisits": r"""
        WITH base AS (
            SELECT page_id, url, 1700000000 + page_id * 60 AS stamp, coalesce(html, '') AS body,
                   '"' || md5(coalesce(html, '')) || '"' AS tag FROM pages),
        records AS (
            SELECT page_id * 2 AS record_id, url, stamp AS captured, 0 AS revisit, tag AS etag, (stamp - 86400)::VARCHAR AS last_modified,
                   sha1(body) AS payload_digest, tag AS own_tag, strlen(body) AS bytes FROM base
            UNION ALL
            SELECT page_id * 2 + 1, url, CASE WHEN page_id % 13 = 0 THEN stamp - 30 ELSE stamp + page_id % 9 * 3600 + 30 END, 1,
                   CASE WHEN page_id % 11 = 0 OR page_id % 7 = 0 THEN NULL WHEN page_id % 5 = 0 THEN '"other"'
                        WHEN page_id % 3 = 0 THEN 'W/' || tag ELSE tag END,
                   CASE WHEN page_id % 11 <> 0 THEN (stamp - 86400)::VARCHAR END, NULL, NULL, NULL FROM base),
        cut AS (
            SELECT *, regexp_replace(regexp_replace(trim(url), '(?s)#.*$', ''), '(?i)^[a-z][a-z0-9+.-]*://', '') AS rest FROM records),
        keyed AS (
            SELECT *, regexp_replace(lower(regexp_extract(rest, '^[^/?]*')), ':(80|443)$', '') AS host,
                   CASE WHEN regexp_extract(rest, '^[^/?]*([^?]*)', 1) = '' THEN '/' ELSE regexp_extract(rest, '^[^/?]*([^?]*)', 1) END AS place,
                   array_to_string(list_sort(list_filter(string_split(regexp_extract(rest, '(?s)^[^?]*\?(.*)$', 1), '&'),
                       lambda x: x <> '' AND string_split(x, '=')[1] NOT IN ('ref', 'utm_campaign', 'utm_medium', 'utm_source'))), '&') AS query
            FROM cut),
        named AS (SELECT *, CASE WHEN coalesce(host, '') = '' THEN '' ELSE host || place || CASE WHEN query = '' THEN '' ELSE '?' || query END END AS canonical FROM keyed),
        scanned AS (
            SELECT *, last_value(CASE WHEN revisit = 0 THEN {'id': record_id, 'etag': etag, 'date': last_modified, 'digest': payload_digest,
                                      'tag': own_tag, 'bytes': bytes, 'stamp': captured} END IGNORE NULLS)
                      OVER (PARTITION BY canonical ORDER BY captured, revisit, record_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f
            FROM named),
        judged AS (
            SELECT *, CASE WHEN canonical = '' THEN 'no_url' WHEN f IS NULL THEN 'no_response'
                           WHEN etag IS NOT NULL AND f.etag IS NOT NULL
                                THEN CASE WHEN regexp_replace(etag, '^W/', '') = regexp_replace(f.etag, '^W/', '') THEN 'resolved' ELSE 'mismatch' END
                           WHEN last_modified IS NOT NULL AND f.date IS NOT NULL
                                THEN CASE WHEN last_modified = f.date THEN 'resolved' ELSE 'mismatch' END
                           ELSE 'no_validator' END AS status
            FROM scanned WHERE revisit = 1)
        SELECT record_id, canonical, captured, status, CASE WHEN canonical <> '' THEN f.id END AS response_id,
               CASE WHEN status = 'resolved' THEN f.digest END AS payload_digest,
               CASE WHEN status = 'resolved' THEN 'Content-Type: text/html' || chr(10) || 'Content-Length: ' || f.bytes || chr(10) || 'ETag: ' || f.tag
                    || chr(10) || 'date: ' || captured || chr(10) || 'Cache-Control: max-age=60' END AS headers
        FROM judged
    """,
    "op11_chat_windows": r"""
        WITH RECURSIVE chats AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL
            SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
        sized AS (
            SELECT *, row_number() OVER w - 1 AS pos, len(regexp_extract_all(text, '[\p{L}\p{N}]+|[^\s\p{L}\p{N}]')) + 4 AS tokens,
                   length('<|im_start|>') + length(regexp_replace(role, '[\\\n|]', 'xx', 'g')) + 1 + length(regexp_replace(text, '<(\\*)\|', '<\1x|', 'g')) + length('<|im_end|>') + 1 AS chars
            FROM chats WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS LAST, role, text)),
        summed AS (
            SELECT *, coalesce(sum(tokens) OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                   pos = 0 AND role = 'system' AS sys FROM sized),
        led AS (
            SELECT s.*, before // (8 * 1024) AS stretch, coalesce(y.tokens, 0) AS sys_tokens, coalesce(y.chars, 0) AS sys_chars,
                   row_number() OVER (PARTITION BY s.conv_id ORDER BY s.pos) AS nth
            FROM summed s LEFT JOIN (SELECT conv_id, tokens, chars FROM summed WHERE sys) y ON s.conv_id IS NOT DISTINCT FROM y.conv_id WHERE NOT s.sys),
        packed AS (
            SELECT conv_id, nth, stretch, before AS start FROM led WHERE nth = 1
            UNION ALL
            SELECT l.conv_id, l.nth, l.stretch, CASE WHEN l.stretch <> p.stretch OR l.before + l.tokens - p.start > 1024 - 256 - l.sys_tokens THEN l.before ELSE p.start END
            FROM packed p JOIN led l ON l.conv_id = p.conv_id AND l.nth = p.nth + 1),
        windows AS (
            SELECT conv_id, start, max(sys_tokens) AS sys_tokens, max(sys_chars) AS sys_chars, sum(tokens) AS spent, sum(chars) AS chars
            FROM packed JOIN led USING (conv_id, nth) GROUP BY conv_id, start),
        shown AS (
            SELECT w.conv_id, w.start, any_value(w.sys_chars) + any_value(w.chars) + coalesce(sum(l.chars), 0) AS chars
            FROM windows w LEFT JOIN led l ON l.conv_id = w.conv_id AND l.before < w.start AND l.before >= w.start - least(256, 1024 - w.sys_tokens - w.spent)
            GROUP BY w.conv_id, w.start
            UNION ALL
            SELECT conv_id, 0, chars FROM summed s WHERE sys AND NOT EXISTS (SELECT 1 FROM led l WHERE l.conv_id = s.conv_id)),
        counted AS (SELECT conv_id, sum(chars)::BIGINT AS formatted_chars, count(*) AS n_windows FROM shown GROUP BY conv_id),
        told AS (
            SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
                   coalesce(string_agg(text, '' ORDER BY pos) FILTER (WHERE role = 'assistant'), '') AS loss FROM sized GROUP BY conv_id)
        SELECT conv_id, n_turns, turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256, formatted_chars, n_windows FROM told JOIN counted USING (conv_id)
    """,
    "op12_merkle_manifest": _merkle(),
    "op13_spelling_variants": "WITH RECURSIVE " + _CRC.strip() + r""",
        runs AS (
            SELECT doc_id, run, count(*) AS n
            FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents)
            WHERE length(run) >= 7 GROUP BY doc_id, run),
        hashed AS (
            SELECT run, n, """ + _crc("flatten(list_transform(string_split(coalesce(doc_id::VARCHAR, '') || ':' || run, ''), lambda x: CASE WHEN ord(x) < 128 THEN [ord(x)::BIGINT] ELSE [192 + (ord(x) >> 6), 128 + (ord(x) & 63)]::BIGINT[] END))") + r""" AS h
            FROM runs, crc_table),
        words AS (
            SELECT word, sum(n)::BIGINT AS n
            FROM (SELECT CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n FROM hashed)
            WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
        cut AS (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM words, unnest(range(length(word))) t(i)),
        pairs AS (
            SELECT a.word, b.word AS near, b.n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
            UNION
            SELECT c.word, w.word, w.n FROM cut c JOIN words w ON c.rest = w.word
            UNION
            SELECT w.word, c.word, c.n FROM cut c JOIN words w ON c.rest = w.word),
        best AS (SELECT word, count(*) AS n_near, first(near ORDER BY n DESC, near) AS near, max(n) AS near_n FROM pairs GROUP BY word),
        forms AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
            FROM words w LEFT JOIN best b ON w.word = b.word),
        climb AS (
            SELECT word, word AS root, form AS next FROM forms
            UNION ALL
            SELECT c.word, c.next, f.form FROM climb c JOIN forms f ON c.next = f.word)
        SELECT f.word, form, root, n, n_near, form_n FROM forms f JOIN climb c ON f.word = c.word AND c.next IS NULL
    """,
}
