"""DuckDB SQL for the queries that SQL can express."""

_LOWER = "translate(coalesce({0}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

_RENDERED = "coalesce(string_agg('<|' || role || '|>' || chr(10) || text || chr(10), '' ORDER BY turn, role, text) {0}, '')"
_RUNS = (
    "coalesce(string_agg((length(role) + 5) || ':0,' || length(text) || ':' || CAST(role = 'assistant' AS INTEGER)"
    " || ',1:0', ',' ORDER BY turn, role, text) {0}, '')"
)


def _side(number: int) -> str:
    return f"FILTER (side = {number} AND turn >= split)"


ORACLE: dict[str, str] = {
    "op1_chat": f"""
        WITH said AS (SELECT DISTINCT conv_id // 2 AS pair_id, conv_id % 2 AS side, turn, coalesce(role, '') AS role,
            coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
        turns AS (SELECT pair_id, turn,
            list([role, text] ORDER BY role, text) FILTER (side = 0) IS NOT DISTINCT FROM
            list([role, text] ORDER BY role, text) FILTER (side = 1) AS same FROM said GROUP BY ALL),
        splits AS (SELECT pair_id, min(turn) FILTER (NOT same) AS split, count(*) AS n FROM turns GROUP BY pair_id),
        before AS (SELECT pair_id, CAST(count(*) AS INTEGER) AS n FROM turns JOIN splits USING (pair_id)
            WHERE split IS NULL OR turn < split GROUP BY pair_id)
        SELECT pair_id, coalesce(any_value(before.n), 0) AS prompt_turns,
            {_RENDERED.format("FILTER (side = 0 AND (split IS NULL OR turn < split))")} AS prompt,
            {_RENDERED.format(_side(0))} AS chosen, {_RUNS.format(_side(0))} AS chosen_mask,
            {_RENDERED.format(_side(1))} AS rejected, {_RUNS.format(_side(1))} AS rejected_mask
        FROM said JOIN splits USING (pair_id) LEFT JOIN before USING (pair_id) GROUP BY pair_id
    """,
    "op6_url_filter": r"""
        WITH parts AS (SELECT page_id,
            translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        ruled AS (SELECT *, CASE
            WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
            WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
            WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
            WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
            WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM parts)
        SELECT *, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END
            AS verdict FROM ruled
    """,
    "op8_decontamination": f"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS.format("text")} AS ws FROM documents),
        items AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_WORDS.format("text")} AS ws FROM benchmark),
        grams AS (
            SELECT DISTINCT item, len(g) AS n, g FROM (
                SELECT item, unnest([ws[i : i + 9] FOR i IN range(1, greatest(len(ws) - 9, 1) + 1)]) AS g
                FROM items WHERE len(ws) > 0)),
        sizes AS (SELECT DISTINCT n FROM grams),
        windows AS (
            SELECT rid, n, i, ws[i : i + n - 1] AS g
            FROM (SELECT rid, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM docs, sizes WHERE len(ws) >= n)),
        hits AS (SELECT rid, i, n, item FROM windows JOIN grams USING (n, g)),
        words AS (SELECT rid, count(DISTINCT w) AS n_hit
            FROM (SELECT rid, unnest(range(i, i + n)) AS w FROM hits) GROUP BY rid),
        named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names
            FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid)
        SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
            sha256(coalesce(names, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM docs LEFT JOIN words USING (rid) LEFT JOIN named USING (rid)
    """,
    "op10_line_dedup": r"""
        WITH docs AS (SELECT row_number() OVER () AS rid, doc_id, string_split(coalesce(text, ''), chr(10)) AS ls
            FROM documents),
        lines AS (SELECT rid, unnest(ls) AS line, generate_subscripts(ls, 1) AS pos FROM docs),
        keyed AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
        common AS (SELECT k FROM keyed WHERE length(k) >= 1 GROUP BY k HAVING count(DISTINCT rid) >= 10),
        kept AS (SELECT rid, string_agg(line, chr(10) ORDER BY pos) AS text, count(*) AS n
            FROM keyed WHERE k NOT IN (SELECT k FROM common) GROUP BY rid)
        SELECT doc_id, len(ls) AS n_lines, len(ls) - coalesce(n, 0) AS n_dropped, sha256(coalesce(text, '')) AS kept_sha256
        FROM docs LEFT JOIN kept USING (rid)
    """,
    "op12_hard_negatives": """
        WITH v AS (SELECT row_number() OVER () AS rid, vec_id,
                CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS e
            FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
                AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
        pairs AS (SELECT a.rid, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
                CAST(list_sum([p[1] * p[2] FOR p IN list_zip(a.e, b.e)]) AS BIGINT) AS score
            FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 100 = 0),
        positives AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY score DESC, other_id) AS place
            FROM pairs WHERE alike QUALIFY place <= 5)
        SELECT p.anchor_id, p.other_id AS positive_id,
            CAST(row_number() OVER (PARTITION BY p.rid, p.place ORDER BY n.score DESC, n.other_id) AS INTEGER) AS rank,
            n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN pairs n ON p.rid = n.rid AND NOT n.alike
            AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
        QUALIFY rank <= 10
    """,
    "op13_collocations": r"""
        WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(string_split_regex(
                {0}, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS ws FROM documents),
        grams AS (SELECT lang, s, unnest([array_to_string(ws[i : i + s - 1], ' ') FOR i IN range(1, len(ws) - s + 2)]) AS p
            FROM pieces, (VALUES (1), (2), (3)) AS t(s)),
        f AS (SELECT lang, s, p, count(*) AS a FROM grams GROUP BY ALL),
        sizes AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE s = 1 GROUP BY lang),
        candidates AS (SELECT *, string_split(p, ' ') AS w FROM f WHERE s > 1 AND a >= 10),
        cuts AS (SELECT *, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
            FROM (SELECT *, unnest(range(1, s)) AS k FROM candidates)),
        scored AS (SELECT c.*, l.a AS l, r.a AS r,
                1000000 * c.a::HUGEINT * c.a::HUGEINT // (l.a::HUGEINT * r.a::HUGEINT) AS score
            FROM cuts c JOIN f l ON c.lang = l.lang AND c.first = l.p JOIN f r ON c.lang = r.lang AND c.rest = r.p),
        weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
        longer AS (SELECT lang, unnest([w[1] || ' ' || w[2], w[2] || ' ' || w[3]]) AS p, a FROM candidates WHERE s = 3),
        kept AS (SELECT * FROM weakest WHERE NOT EXISTS (SELECT 1 FROM longer g
            WHERE g.lang = weakest.lang AND g.p = weakest.p AND 100 * g.a >= 50 * weakest.a))
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(p)) AS rank,
            p AS phrase, a, l, r, n, score::BIGINT AS score
        FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000
    """.replace("{0}", _LOWER.format("text")),
}
