"""SQL of the operators whose statement is long: vector codes and source divergence."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def vector_codes(parts: int = 4, entries: int = 256, rounds: int = 4, scale: int = 1024) -> str:
    """Every round as a full scan: each part against each entry of its codebook."""

    def nearest(book: str) -> str:
        # |x|^2 - 2 x e + |e|^2 in doubles, whole numbers far below 2^53
        distance = "list_inner_product(x.c, x.c) - 2 * list_inner_product(x.c, e.c) + list_inner_product(e.c, e.c)"
        return f"""SELECT x.r, x.part, min_by(e.entry, d * 1024 + e.entry) AS entry, min(d)::BIGINT AS d
            FROM (SELECT x.r, x.part, e.entry, {distance} AS d FROM x JOIN {book} e ON e.part = x.part) e, LATERAL (SELECT e.r, e.part) x GROUP BY x.r, x.part"""

    steps = []
    for i in range(rounds):
        steps.append(f"n{i} AS MATERIALIZED ({nearest(f'b{i}')})")
        steps.append(f"""m{i} AS (SELECT n.part, n.entry, u.i, floor(sum(x.c[u.i]) / count(*)) AS c FROM n{i} n JOIN x ON x.r = n.r AND x.part = n.part, unnest(generate_series(1, len(x.c))) u(i) GROUP BY ALL)""")
        steps.append(f"""b{i + 1} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.c, b.c) AS c FROM b{i} b LEFT JOIN (SELECT part, entry, list(c ORDER BY i) AS c FROM m{i} GROUP BY ALL) m ON m.part = b.part AND m.entry = b.entry)""")
    last = f"b{rounds}"
    return f"""
WITH v AS (
  SELECT row_number() OVER (ORDER BY vec_id, embedding) AS r, vec_id, label, [floor({scale} * e::DOUBLE) FOR e IN embedding] AS c FROM embeddings
  WHERE embedding IS NOT NULL AND len([e FOR e IN embedding IF e IS NULL OR NOT isfinite(e)]) = 0
), x AS MATERIALIZED (
  SELECT r, p AS part, c[p * len(c) // {parts} + 1 : (p + 1) * len(c) // {parts}] AS c FROM v, unnest(generate_series(0, {parts - 1})) t(p)
), b0 AS MATERIALIZED (SELECT part, r - 1 AS entry, c FROM x WHERE r <= {entries}),
{", ".join(steps)},
last AS MATERIALIZED ({nearest(last)}),
codes AS (SELECT r, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, sum(d)::BIGINT AS error FROM last GROUP BY r),
sha AS (SELECT sha256(string_agg(array_to_string([k::BIGINT FOR k IN c], ','), ',' ORDER BY part, entry)) AS h FROM {last})
SELECT v.vec_id, codes.code, codes.error, sum(codes.error) OVER (PARTITION BY v.label)::BIGINT AS label_error, sha.h AS codebooks_sha256 FROM v JOIN codes ON codes.r = v.r, sha
"""


def source_divergence(min_docs: int = 30, top: int = 50) -> str:
    text = LOWER.format("coalesce(text, '')")
    return rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, regexp_extract_all({text}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
), t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS MATERIALIZED (SELECT lang, term FROM t GROUP BY ALL HAVING count(DISTINCT r) >= {min_docs}),
c AS MATERIALIZED (SELECT t.lang, t.source, t.term, count(*) AS n FROM t JOIN kept k ON k.lang = t.lang AND k.term = t.term GROUP BY ALL),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS MATERIALIZED (
  SELECT g.lang, g.source, coalesce(v.v, 0) AS v, coalesce(sum(c.n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g
  LEFT JOIN v ON v.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source GROUP BY ALL
), p AS MATERIALIZED (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n, 1 + (1000000000 * (coalesce(c.n, 0) + 5)::BIGINT) // (g.n + 5 * g.v)::BIGINT AS p
  FROM g JOIN kept k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), f AS (SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value FROM p a JOIN p b ON b.lang = a.lang AND b.term = a.term AND b.source <> a.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), q AS (
  SELECT lang, term, 1 + (1000000000 * (sum(n) + 5)::BIGINT) // (sum(sum(n)) OVER (PARTITION BY lang) + 5 * count(*) OVER (PARTITION BY lang))::BIGINT AS q FROM p GROUP BY lang, term
), terms AS (SELECT p.lang, p.source, 'term' AS part, p.term AS item, (p.p - q.q)::BIGINT AS value FROM p JOIN q ON q.lang = p.lang AND q.term = p.term WHERE p.n > 0 AND p.p > q.q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INT AS rank FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
QUALIFY part = 'pair' OR rank <= {top}
"""
