"""The queries that SQL can express, for DuckDB over the same tables."""

from __future__ import annotations

from ledgerline.llm import linkgraph

_LOWER = "translate(coalesce({}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_FIXITY = """
WITH damaged AS (
    SELECT page_id, url, CASE
        WHEN page_id % 97 = 0 THEN '#' || substr(coalesce(html, ''), 2)
        WHEN page_id % 89 = 0 THEN substr(coalesce(html, ''), 1, CAST(floor(length(coalesce(html, '')) / 2) AS INTEGER))
        ELSE coalesce(html, '') END AS html
    FROM pages WHERE page_id % 83 <> 5
), held AS (
    SELECT 1 AS side, page_id, url, coalesce(html, '') AS html FROM pages
    UNION ALL SELECT 2, page_id, url, html FROM damaged
), written AS (
    SELECT side, page_id, E'WARC/1.1\\r\\nWARC-Type: resource\\r\\nWARC-Target-URI: ' || coalesce(url, '') || E'\\r\\nContent-Length: '
        || CAST(octet_length(encode(html)) AS VARCHAR) || E'\\r\\n\\r\\n' || html || E'\\r\\n\\r\\n' AS record
    FROM held
), placed AS (
    SELECT side, page_id, record, octet_length(encode(record)) AS size,
        sum(octet_length(encode(record))) OVER (PARTITION BY side, page_id // 2048 ORDER BY page_id) AS stop
    FROM written
)
SELECT a.page_id, CASE WHEN b.page_id IS NULL THEN 'missing' ELSE 'altered' END AS finding,
    CAST(a.stop - a.size AS BIGINT) AS "start", CAST(a.stop AS BIGINT) AS "end",
    CAST(b.stop - b.size AS BIGINT) AS replica_start, CAST(b.stop AS BIGINT) AS replica_end
FROM (SELECT * FROM placed WHERE side = 1) a LEFT JOIN (SELECT * FROM placed WHERE side = 2) b USING (page_id)
WHERE b.page_id IS NULL OR a.record <> b.record
"""

_WORDS = rf"regexp_extract_all({_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_DECONTAMINATION = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
sized AS (SELECT item, w, least(10, len(w)) AS k FROM b WHERE len(w) > 0),
runs AS (
    SELECT DISTINCT item, k, array_to_string(w[i : i + k - 1], ' ') AS g
    FROM (SELECT item, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM sized)
), places AS (
    SELECT doc_id, k, i, array_to_string(w[i : i + k - 1], ' ') AS g
    FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, (SELECT DISTINCT k FROM sized))
), met AS (SELECT doc_id, k, i, item FROM places JOIN runs USING (k, g)),
hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS p FROM met) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, item FROM met) GROUP BY doc_id
)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""

_NEAR = rf"""
WITH RECURSIVE d AS (
    SELECT doc_id, regexp_extract_all({_LOWER.format('text')}, '[^\x20\x09-\x0D]+') AS w FROM documents
), s AS (
    SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS g
    FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (
    SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 75 * (a.n + b.n - c)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS root FROM d UNION SELECT e.y, r.root FROM r JOIN e ON e.x = r.doc_id)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id, n.n
"""


def _urls() -> str:
    """The host verdicts by the walks' series: what arrives after each number of links, added up."""
    rules = sorted(linkgraph.RULES, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [(f"(host = '{h}' OR suffix(host, '.{h}')) AND prefix(path, '{p}')", h + p, says) for says, h, p in rules]
    rule = "CASE " + " ".join(f"WHEN {c} THEN '{name}'" for c, name, _ in fits) + " END"
    says = "CASE " + " ".join(f"WHEN {c} THEN '{verdict}'" for c, _, verdict in fits) + " END"
    rest = "substr(url, position('://' in url) + 3)"
    lower = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = r"""(?i)href\s*=\s*["'']?\s*((?:https?:)?//[^"''>\s]+)"""
    keep = linkgraph.DAMPING
    return f"""
WITH RECURSIVE split AS (
    SELECT page_id, html, CASE WHEN position('://' in url) > 0 THEN {lower.format(f"regexp_extract({rest}, '^([^/?#]*)', 1)")} ELSE '' END AS host,
        CASE WHEN position('://' in url) > 0 THEN regexp_extract({rest}, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
    FROM pages
), marked AS (SELECT page_id, html, host, path, {rule} AS rule, {says} AS by_rule FROM split),
links AS (
    SELECT DISTINCT source, target FROM (
        SELECT host AS source, {lower.format("regexp_extract(unnest(regexp_extract_all(html, '" + link + "', 1)), '//([^/?#]*)', 1)")} AS target
        FROM marked WHERE host <> ''
    ) WHERE target <> '' AND target <> source
), two_way AS (
    SELECT 'trust' AS kind, source AS host, target AS dest FROM links UNION ALL SELECT 'distrust', target, source FROM links
), ways AS MATERIALIZED (SELECT *, count(*) OVER (PARTITION BY kind, host) AS degree FROM two_way),
shares AS (
    SELECT host, count(*) FILTER (by_rule = 'allow') / count(*) AS good, count(*) FILTER (by_rule = 'block') / count(*) AS bad
    FROM marked WHERE host <> '' GROUP BY host
), walk AS (
    SELECT 0 AS links, kind, host, good, bad, 1 - good - bad AS other FROM shares, (VALUES ('trust'), ('distrust')) k(kind) WHERE good + bad > 0
    UNION ALL
    SELECT links + 1, kind, ways.dest, sum(good * {keep} / degree), sum(bad * {keep} / degree), sum(other * {keep} / degree)
    FROM walk JOIN ways USING (kind, host) WHERE links < 100 GROUP BY links, kind, ways.dest
), hosts AS (
    SELECT host, max(good) FILTER (kind = 'trust') AS trust, max(bad) FILTER (kind = 'distrust') AS distrust FROM (
        SELECT kind, host, sum(good) / sum(good + bad + other) AS good, sum(bad) / sum(good + bad + other) AS bad FROM walk GROUP BY kind, host
    ) GROUP BY host
), shown AS (
    SELECT page_id, host, path, rule, by_rule, CAST(coalesce(round(trust, {linkgraph.DIGITS}), 0) AS DOUBLE) AS trust,
        CAST(coalesce(round(distrust, {linkgraph.DIGITS}), 0) AS DOUBLE) AS distrust
    FROM marked LEFT JOIN hosts USING (host)
)
SELECT page_id, host, path, rule, coalesce(by_rule, CASE WHEN distrust - trust >= {linkgraph.MARGIN} THEN 'block' ELSE 'allow' END) AS verdict,
    trust, distrust
FROM shown
"""


_HARD = """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
), positive AS (
    SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.vec_id AS positive_id,
    CAST(row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positive p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
WHERE 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op4_fixity": _FIXITY, "op6_decontamination": _DECONTAMINATION, "op9_minhash": _NEAR, "op10_urls": _urls(),
        "op11_hard_negatives": _HARD,
    }
