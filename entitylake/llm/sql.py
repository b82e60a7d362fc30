"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

import re

from entitylake.llm.licenses import NOTICES, SHARE, TEXTS, THRESHOLD
from entitylake.llm.mixing import SYMBOLS

WORDS = r"len(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'))"

SOURCE_MIXING = rf"""
WITH docs AS (
    SELECT doc_id, text, source, coalesce({WORDS.format('text')}, 0)::BIGINT AS size,
           -ln((('0x' || md5(coalesce(doc_id::VARCHAR, md5(text), ''))[:13])::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE)
           / coalesce(0.1::DOUBLE + 0.9::DOUBLE * length(translate(text, '{SYMBOLS}', '')) / nullif(length(text), 0), 0.1::DOUBLE)
           AS draw
    FROM documents
), sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM docs GROUP BY source
), ordered AS (  -- sources in the order in which they reach three times their size as the level rises
    SELECT *, row_number() OVER w AS place,
           sum(source_size * 3) OVER w - source_size * 3 AS held, sum(weight) OVER w - weight AS gone,
           sum(source_size) OVER () AS total, sum(weight) OVER () AS every
    FROM sizes
    WINDOW w AS (ORDER BY source_size * 3::DOUBLE / weight, source NULLS LAST ROWS UNBOUNDED PRECEDING)
), levels AS (
    SELECT place, ((total - held) / (every - gone)::DOUBLE) AS level, source_size * 3 < weight * ((total - held) / (every - gone)::DOUBLE) AS above
    FROM ordered
), chosen AS (
    SELECT level FROM levels WHERE NOT above ORDER BY place LIMIT 1
), targets AS (
    SELECT source, source_size, least((source_size * 3)::DOUBLE, weight * level) AS target FROM sizes, chosen
), budgets AS (
    SELECT *, coalesce(round(target)::BIGINT // nullif(source_size, 0), 0) AS epochs,
           coalesce(round(target)::BIGINT % nullif(source_size, 0), 0) AS rest
    FROM targets
), placed AS (
    SELECT doc_id, size, source_size, target, epochs, rest,
           sum(size) OVER (PARTITION BY d.source ORDER BY draw, doc_id::VARCHAR, size, md5(text) ROWS UNBOUNDED PRECEDING) - size AS before
    FROM docs d JOIN budgets b ON d.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, size, source_size, target,
       size * (epochs + (2 * (rest - before) >= size)::BIGINT)::BIGINT AS taken
FROM placed
"""

SUBSTRING_DEDUP = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
    SELECT r, i, array_to_string(w[i : i + 34], ' ') AS words
    FROM (SELECT r, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)
), repeated AS (
    SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY words) > 1
), gone AS (
    SELECT DISTINCT r, unnest(range(i, i + 35)) AS i FROM repeated
), kept AS (
    SELECT r, string_agg(w[i], ' ' ORDER BY i) AS text
    FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM docs) ANTI JOIN gone USING (r, i) GROUP BY r
), counts AS (
    SELECT r, count(*) AS n FROM gone GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r) LEFT JOIN counts USING (r)
"""

EMBEDDING_DEDUP = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS e FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
      AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b ON a.label = b.label AND len(a.e) = len(b.e)
    WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.98
), reached(a, b) AS (
    SELECT vec_id, vec_id FROM embeddings UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), components AS (
    SELECT a AS vec_id, min(b) AS component_id FROM reached GROUP BY a
), counts AS (
    SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a
)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN components USING (vec_id) LEFT JOIN counts USING (vec_id)
"""

_TEMPLATES = ", ".join(
    "({}, '{}', {}, '{}')".format(place, name, place >= len(NOTICES), " ".join(re.findall("[a-z0-9]+", text.lower())))
    for place, (name, text) in enumerate(NOTICES + TEXTS)
)

LICENSE_SCAN = f"""
WITH listed(place, name, is_text, words) AS (VALUES {_TEMPLATES}),
worded AS (SELECT place, name, is_text, string_split(words, ' ') AS w FROM listed),
templates AS (
    SELECT place, name, is_text, len(w) - 1 AS pairs, greatest(1, (len(w) - 1) // {SHARE}) AS step,
           list_distinct([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))]) AS grams
    FROM worded
),
docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lower(text), '') AS t FROM documents),
passages AS (
    SELECT DISTINCT r, unnest([t] || regexp_split_to_array(t, '\n[ \t\r]*\n') || string_split(t, chr(10))) AS passage FROM docs
),
cut AS (
    SELECT r, w, len(w) - 1 AS n FROM (SELECT r, regexp_extract_all(passage, '[a-z0-9]+') AS w FROM passages)
    WHERE len(w) - 1 BETWEEN 1 AND (SELECT max(len(grams)) * 2 FROM templates WHERE NOT is_text)
),
in_passages AS (
    SELECT r, place, name, n, len(grams) AS size,
           len(list_intersect([w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))], grams)) AS shared
    FROM cut JOIN templates ON NOT is_text
     AND n BETWEEN len(grams) * {THRESHOLD} / (2 - {THRESHOLD}) - 1 AND len(grams) * (2 - {THRESHOLD}) / {THRESHOLD} + 1
),
whole AS (
    SELECT r, [w[i] || ' ' || w[i + 1] FOR i IN range(1, len(w))] AS g
    FROM (SELECT r, regexp_extract_all(t, '[a-z0-9]+') AS w FROM docs)
),
hits AS (  -- bigrams of a template in a text
    SELECT r, i, place, is_text FROM (SELECT r, unnest(g) AS gram, unnest(range(1, len(g) + 1)) AS i FROM whole)
    JOIN (SELECT place, is_text, unnest(grams) AS gram FROM templates) USING (gram)
),
starts AS (
    SELECT r, place, i FROM hits WHERE NOT is_text
    UNION ALL
    SELECT DISTINCT r, place, unnest(range(1, last + 2, step) || [last + 1]) FROM (
        SELECT r, place, step, greatest(len(g) - pairs, 0) AS last FROM whole
        JOIN (SELECT r, place, count(*) AS n FROM hits WHERE is_text GROUP BY ALL) USING (r) JOIN templates USING (place)
        WHERE 2 * n >= len(grams)
    )
),
in_windows AS (
    SELECT r, place, name, len(w) AS n, len(grams) AS size, len(list_intersect(w, grams)) AS shared FROM (
        SELECT r, place, name, grams, list_distinct(g[i : i + pairs - 1]) AS w FROM starts JOIN whole USING (r) JOIN templates USING (place)
    )
),
best_windows AS (
    SELECT * FROM in_windows QUALIFY row_number() OVER (PARTITION BY r, place ORDER BY 2.0::DOUBLE * shared / (n + size) DESC, shared DESC) = 1
),
found AS (
    SELECT r, place, name, shared, 2.0::DOUBLE * shared / (n + size) AS dice
    FROM (FROM in_passages UNION ALL FROM best_windows) WHERE 2.0::DOUBLE * shared / (n + size) >= {THRESHOLD}::DOUBLE
),
best AS (
    SELECT r, first(name ORDER BY shared DESC, dice DESC, place) AS license, first(dice ORDER BY shared DESC, dice DESC, place) AS dice,
           string_agg(DISTINCT name, ';' ORDER BY name) AS licenses
    FROM found GROUP BY r
)
SELECT doc_id, license, dice, coalesce(licenses, '') AS licenses FROM docs LEFT JOIN best USING (r)
"""


def _leaf(text: str) -> str:
    """Digest of a row of ``documents`` with ``text`` for its text."""
    values = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    parts = [f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values]
    return f"sha256({' || '.join(parts)})"


MERKLE_MANIFEST = rf"""
WITH RECURSIVE crcs AS (  -- crc32 of every byte
    SELECT list(crc ORDER BY byte) AS crc FROM (
        SELECT byte, list_reduce(list_prepend(byte, range(8)), LAMBDA c, i: xor(c >> 1, (c & 1) * 3988292384)) AS crc
        FROM (SELECT unnest(range(256)) AS byte)
    )
), leaves AS (
    SELECT row_number() OVER () AS r, doc_id, source, {_leaf("text")} AS leaf,
           CASE WHEN xor(4294967295, list_reduce(
               list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), LAMBDA x: ascii(x)::BIGINT)),
               LAMBDA c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1]))) % 5 = 0
           THEN {_leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS tampered
    FROM documents, crcs
), nodes(level, source, pos, h, n, r) AS (  -- the trees of the sources
    SELECT 0, source, row_number() OVER w - 1, leaf, count(*) OVER (PARTITION BY source), r
    FROM leaves WINDOW w AS (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf)
    UNION ALL
    SELECT level + 1, source, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16, NULL
    FROM nodes WHERE n > 1 GROUP BY level, source, pos // 16, n
), tops(level, pos, h, n, source) AS (  -- the tree over the sources
    SELECT 0, row_number() OVER (ORDER BY source NULLS FIRST) - 1, h, count(*) OVER (), source FROM nodes WHERE n = 1
    UNION ALL
    SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16, NULL
    FROM tops WHERE n > 1 GROUP BY level, pos // 16, n
), runs AS (
    SELECT level, source, pos // 16 AS run, string_agg(h, '' ORDER BY pos) AS members
    FROM nodes WHERE n > 1 GROUP BY level, source, pos // 16
), top_runs AS (
    SELECT level, pos // 16 AS run, string_agg(h, '' ORDER BY pos) AS members FROM tops WHERE n > 1 GROUP BY level, pos // 16
), places AS (
    SELECT l.r, runs.level, ((l.pos // (16 ** runs.level)::BIGINT) % 16)::BIGINT AS place, members
    FROM nodes l JOIN runs ON l.source IS NOT DISTINCT FROM runs.source AND (l.pos // (16 ** runs.level)::BIGINT) // 16 = runs.run
    WHERE l.level = 0
    UNION ALL
    SELECT l.r, 100 + t.level, ((s.pos // (16 ** t.level)::BIGINT) % 16)::BIGINT, members
    FROM leaves l JOIN tops s ON s.level = 0 AND l.source IS NOT DISTINCT FROM s.source
    JOIN top_runs t ON (s.pos // (16 ** t.level)::BIGINT) // 16 = t.run
), paths AS (
    SELECT r, list({{'before': substr(members, 1, 64 * place), 'after': substr(members, 64 * place + 65)}} ORDER BY level) AS path
    FROM places GROUP BY r
), folds(r, i, h) AS (
    SELECT r, 0, coalesce(tampered, leaf) FROM leaves
    UNION ALL
    SELECT f.r, i + 1, sha256(path[i + 1].before || h || path[i + 1].after) FROM folds f JOIN paths USING (r) WHERE i < len(path)
)
SELECT doc_id, leaf, t.h AS subroot, root.h AS root,
       sha256(coalesce(array_to_string(list_transform(path, LAMBDA p: p.before || p.after), ''), '')) AS proof_sha256,
       folds.h AS folded_root, folds.h = root.h AS verified
FROM leaves l LEFT JOIN paths USING (r) JOIN folds ON folds.r = l.r AND folds.i = coalesce(len(path), 0)
JOIN tops t ON t.level = 0 AND t.source IS NOT DISTINCT FROM l.source
JOIN (SELECT h FROM tops WHERE n = 1) root ON true
"""

_NEAREST = """
    SELECT r, cluster, d FROM (
        SELECT p.r, c.cluster, list_sum([(p.v[i] - c.v[i]) * (p.v[i] - c.v[i]) FOR i IN range(1, 65)])::BIGINT AS d
        FROM points p, centroids_{0} c
    ) QUALIFY row_number() OVER (PARTITION BY r ORDER BY d, cluster) = 1
"""


def _clustering(rounds: int) -> str:
    steps = [f"nearest_0 AS ({_NEAREST.format(0)})"]
    for i in range(rounds):
        steps.append(f"""centroids_{i + 1} AS (
    SELECT c.cluster, coalesce(means.v, c.v) AS v FROM centroids_{i} c LEFT JOIN (
        SELECT cluster, list((total - ((total % n) + n) % n) // n ORDER BY i) AS v FROM (
            SELECT cluster, i, sum(v[i])::BIGINT AS total, count(*) AS n
            FROM nearest_{i} JOIN points USING (r), (SELECT unnest(range(1, 65)) AS i) GROUP BY cluster, i)
        GROUP BY cluster) means USING (cluster)
), nearest_{i + 1} AS ({_NEAREST.format(i + 1)})""")
    return ", ".join(steps)


CENTROID_CLUSTERING = f"""
WITH points AS (
    SELECT row_number() OVER () AS r, vec_id, [floor(64 * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
    WHERE len(embedding) = 64 AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), centroids_0 AS (
    SELECT row_number() OVER w - 1 AS cluster, v FROM points
    WINDOW w AS (ORDER BY sha256('1:' || vec_id::VARCHAR) NULLS LAST, v) QUALIFY row_number() OVER w <= 16
), {_clustering(3)}, inertias AS (
    SELECT cluster, sum(d) AS inertia FROM nearest_3 GROUP BY cluster
)
SELECT vec_id, cluster::INTEGER AS cluster, d AS distance, inertia::BIGINT AS cluster_inertia,
       (SELECT sum(d) FROM nearest_3)::BIGINT AS inertia, sha256(array_to_string(c.v, ',')) AS centroid_sha256
FROM nearest_3 JOIN points USING (r) JOIN centroids_3 c USING (cluster) JOIN inertias USING (cluster)
"""

ORACLES: dict[str, str] = {
    "op4_substring_dedup": SUBSTRING_DEDUP,
    "op5_source_mixing": SOURCE_MIXING,
    "op6_license_scan": LICENSE_SCAN,
    "op10_embedding_dedup": EMBEDDING_DEDUP,
    "op11_centroid_clustering": CENTROID_CLUSTERING,
    "op12_merkle_manifest": MERKLE_MANIFEST,
}
