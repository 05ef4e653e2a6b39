"""The queries that SQL can express, for an independent engine over the same tables."""

from __future__ import annotations

EMBEDDINGS = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS vec FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.vec) = len(b.vec)
    WHERE list_cosine_similarity(a.vec, b.vec) >= 0.98
),
reach AS (
    SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
),
counted AS (SELECT a, count(*) AS n_links FROM links GROUP BY a),
smallest AS (SELECT a, min(b) AS b FROM reach GROUP BY a)
SELECT e.vec_id, coalesce(c.n_links, 0) AS n_links, least(e.vec_id, coalesce(s.b, e.vec_id)) AS component_id,
       least(e.vec_id, coalesce(s.b, e.vec_id)) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN smallest s ON s.a = e.vec_id
"""

LINES = r"""
WITH lines AS (
    SELECT doc_id, line, place FROM (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
        FROM documents
    )
),
keyed AS (
    SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM lines
),
often AS (SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(o.key) AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.place) FILTER (WHERE o.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN often o ON o.key = k.key GROUP BY doc_id
"""

SECRETS = r"""
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || source, '') AS owner, sha256(coalesce(text, '')) AS repository
    FROM documents
),
patterns(kind_no, kind, pattern, grp, least) AS (
    VALUES
    (0, 'assign', '(?i)(password|passwd|secret|token|api_?key)["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 2, 12),
    (1, 'access', 'AKIA[A-Z0-9]+', 0, 18),
    (2, 'hex', '[0-9a-f]+', 0, 16),
    (3, 'bare', '[A-Za-z0-9_+/=-]+', 0, 20)
),
found AS (
    SELECT doc_id, owner, repository, kind_no, kind, least, regexp_extract_all(t, pattern) AS matches,
           CASE grp WHEN 2 THEN regexp_extract_all(t, pattern, 2) ELSE regexp_extract_all(t, pattern) END AS vals,
           string_split_regex(t, pattern) AS gaps
    FROM docs, patterns
),
each AS (
    SELECT doc_id, owner, repository, kind_no, kind, least, unnest(matches) AS match, unnest(vals) AS val,
           unnest(gaps[1:len(matches)]) AS gap, generate_subscripts(matches, 1) AS place
    FROM found
),
placed AS (
    SELECT *, sum(length(gap) + length(match)) OVER (PARTITION BY doc_id, kind_no ORDER BY place) - length(match) AS start
    FROM each
),
tokens AS (
    SELECT doc_id, owner, repository, kind_no, kind, least, start,
           CASE kind WHEN 'bare' THEN regexp_extract(match, '^[A-Za-z0-9_+-]+') ELSE val END AS val,
           start + CASE kind WHEN 'bare' THEN length(regexp_extract(match, '^[A-Za-z0-9_+-]+')) ELSE length(match) END AS stop
    FROM placed
),
long AS (
    SELECT * FROM tokens WHERE length(val) >= least AND (kind <> 'bare' OR
        regexp_matches(val, '[0-9]') AND regexp_matches(val, '[A-Z]') AND regexp_matches(val, '[a-z]'))
),
clear AS (
    SELECT * FROM long a WHERE kind <> 'bare' OR NOT EXISTS (
        SELECT 1 FROM long b WHERE b.doc_id = a.doc_id AND b.kind <> 'bare' AND b.start < a.stop AND a.start < b.stop
    )
),
owners AS (
    SELECT val, count(DISTINCT owner) AS owners, count(DISTINCT (owner, repository)) AS repositories FROM clear GROUP BY val
),
judged AS (
    SELECT c.*, o.owners, o.repositories, o.owners >= 3 OR o.repositories >= 10 AS copied,
           o.owners < 3 AND o.repositories < 10 AND len(list_distinct(string_split(c.val, ''))) >= 8 AND NOT regexp_matches(
               c.val, '(?i)example|sample|dummy|changeme|placeholder|your|xxxx|1234567') AS live
    FROM clear c JOIN owners o ON o.val = c.val
),
spans AS (SELECT *, kind || ':' || CAST(start AS BIGINT) || ':' || CAST(stop AS BIGINT) AS span FROM judged
          WHERE kind <> 'bare' OR live)
SELECT d.doc_id,
       count(*) FILTER (kind = 'assign') AS n_assign,
       count(*) FILTER (kind = 'access') AS n_access,
       count(*) FILTER (kind = 'hex') AS n_hex,
       sha256(coalesce(string_agg(span, ',' ORDER BY start, kind_no) FILTER (kind <> 'bare'), '')) AS base_sha256,
       coalesce(string_agg(span, ',' ORDER BY start, kind_no), '') AS spans,
       coalesce(string_agg(owners || ':' || repositories, ',' ORDER BY start, kind_no), '') AS counts,
       count(*) FILTER (live) AS n_live,
       count(*) FILTER (copied) AS n_copied
FROM docs d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

RANKED = r"""
WITH words AS (
    SELECT row_number() OVER () AS doc, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
    FROM documents
),
sizes AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM words),
held AS (SELECT doc, doc_id, len(terms) AS n, unnest(terms) AS term FROM words),
tf AS (SELECT doc, doc_id, n, term, count(*) AS tf FROM held GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
items AS (
    SELECT item, item_id, unnest(list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS term
    FROM (SELECT row_number() OVER () AS item, * FROM benchmark)
),
scored AS (
    SELECT item, item_id, doc, doc_id, CAST(sum(
        CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT)
        * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * n_docs) // n_terms)))) AS BIGINT) AS score
    FROM items JOIN tf USING (term) JOIN df USING (term), sizes
    GROUP BY ALL
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER) AS rank
    FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""

#: The best product of each query and vector, by whole numbers.
PRODUCTS = """
WITH vectors AS (
    SELECT row_number() OVER () AS place, vec_id,
           list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT)) AS vec
    FROM embeddings
    WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS (
    SELECT q.place, q.vec_id AS query_id, c.vec_id, CAST(list_sum(
        list_transform(list_zip(q.vec, c.vec), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM vectors q JOIN vectors c ON q.place <> c.place AND len(q.vec) = len(c.vec) WHERE q.vec_id % 100 = 0
),
ranked AS (
    SELECT *, CAST(row_number() OVER (PARTITION BY place ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 10
"""

#: States of the roles so far, in SQL from 1: nothing, system, user last, assistant last; the role that follows each.
FOLLOWING = {1: (3, "user"), 2: (3, "user"), 3: (4, "assistant"), 4: (3, "user")}


def _edited(state: int) -> str:
    """The best of what a row's edits cost in a state, with their initials and what they leave."""
    kept = {1: [("s", 2), ("u", 3)], 2: [("u", 3)], 3: [("a", 4)], 4: [("u", 3)]}[state]
    then, role = FOLLOWING[state]
    some = [f"{{c: 2 + v[{state}].c, a: 'D' || v[{state}].a, t: v[{state}].t}}"]
    some += [
        f"CASE WHEN NOT gone AND initial = '{i}' THEN"
        f" {{c: more + v[{s}].c, a: 'K' || v[{s}].a, t: chr(10) || role || ':' || text || v[{s}].t}} END"
        for i, s in kept
    ]
    some.append(
        f"CASE WHEN NOT gone THEN {{c: 1 + more + v[{then}].c, a: 'R' || v[{then}].a,"
        f" t: chr(10) || '{role}:' || text || v[{then}].t}} END"
    )
    return f"list_min(list_filter([{', '.join(some)}], lambda e: e IS NOT NULL))"


def _inserted(state: int) -> str:
    """The same with up to two rows inserted before."""
    once, first = FOLLOWING[state]
    twice, second = FOLLOWING[once]
    return (
        f"list_min([b[{state}], {{c: 5 + b[{once}].c, a: 'I' || b[{once}].a, t: chr(10) || '{first}:' || b[{once}].t}},"
        f" {{c: 10 + b[{twice}].c, a: 'II' || b[{twice}].a,"
        f" t: chr(10) || '{first}:' || chr(10) || '{second}:' || b[{twice}].t}}])"
    )


#: The cheapest edits as whole texts, from the last row to the first; the checksum bit by bit.
REPAIRED = rf"""
WITH RECURSIVE coded AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, list_reduce(
        list_concat([4294967295], flatten(list_transform(
            string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''),
            lambda c: [CAST(ascii(c) AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1]))),
        lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s & 1 = 1 THEN xor(s >> 1, 3988292384) ELSE s >> 1 END) AS crc
    FROM conversations
),
damaged AS (
    SELECT conv_id, turn, CASE code WHEN 4 THEN 'user' ELSE role END AS role,
           CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE code WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
    FROM (SELECT *, xor(crc, 4294967295) % 20 AS code FROM coded)
),
placed AS (
    SELECT conv_id, turn, role, text, substr(role, 1, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS pos,
           regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS stripped
    FROM damaged
),
faults AS (
    SELECT *, stripped = '' AS blank,
           stripped <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again
    FROM placed
),
marked AS (
    SELECT *, NOT blank AND NOT again AND right(stripped, 1) NOT IN ('.', '!', '?') AS cut,
           coalesce(lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial NOT IN ('su', 'ua', 'au'), false) AS odd
    FROM faults
),
counted AS (
    SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (blank) AS blank, count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
           count(*) FILTER (odd) AS illegal
    FROM marked GROUP BY conv_id
),
steps AS (
    SELECT conv_id, n + 1 AS pos, [{{c: 0, a: '', t: ''}}, {{c: 10, a: 'II', t: chr(10) || 'user:' || chr(10) || 'assistant:'}},
           {{c: 5, a: 'I', t: chr(10) || 'assistant:'}}, {{c: 0, a: '', t: ''}}] AS v
    FROM counted
    UNION ALL
    SELECT conv_id, pos, [{_inserted(1)}, {_inserted(2)}, {_inserted(3)}, {_inserted(4)}] AS v
    FROM (
        SELECT conv_id, pos, [{_edited(1)}, {_edited(2)}, {_edited(3)}, {_edited(4)}] AS b
        FROM (
            SELECT m.conv_id, m.pos, m.role, m.text, m.initial, m.blank OR m.again AS gone,
                   CASE WHEN m.cut THEN 5 ELSE 0 END AS more, s.v
            FROM steps s JOIN marked m ON m.conv_id IS NOT DISTINCT FROM s.conv_id AND m.pos = s.pos - 1
        )
    )
)
SELECT o.conv_id, coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate,
       coalesce(c.truncated, 0) AS truncated, coalesce(c.illegal, 0) AS illegal,
       CAST(coalesce(s.v[1].c, 0) AS BIGINT) AS cost, coalesce(s.v[1].a, '') AS audit,
       sha256(coalesce(substr(s.v[1].t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN counted c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN steps s ON s.conv_id IS NOT DISTINCT FROM o.conv_id AND s.pos = 1
"""

ORACLE: dict[str, str] = {
    "op2_secret_ownership": SECRETS,
    "op5_embedding_tiles": EMBEDDINGS,
    "op7_line_dedup": LINES,
    "op11_norm_buckets": RANKED,
    "op12_conversation_repair": REPAIRED,
    "op13_ball_trees": PRODUCTS,
}
