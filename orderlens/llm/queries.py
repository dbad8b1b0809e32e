"""The registered queries of this package: each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.llm import decontam, divergence, lines, main_text, neardup, oracles, packing, pivots, private, quality, secrets, topk, urls, warc
from orderlens.llm.common import delete_at_end, new_folder, table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(), seq_len=2048, end_id=1)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontam.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), width=10)
    return found.drop("rid", "text_hash", "items")


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return urls.judge_urls(pages, block=BLOCK, allow=ALLOW).drop("url")


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark)
    delete_at_end(spark, path)
    warc.write_archives(warc.chunk_table(warc.plan_records(table(spark, sf_dir, "pages"))), path)
    return warc.read_archives(spark, path)


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lines.drop_repeated_lines(docs, min_docs=10, min_chars=1).select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.find_secrets(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = quality.resample(docs, table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "n_grams", "log_weight", "draw", "kept")


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), k=3, percent=85).drop("rid", "text_hash", "first_row")


def op9_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5, scale=256.0)


def op10_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    codes, books = pivots.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    return pivots.with_label_errors(codes).select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), min_docs=30, top=50)


def op13_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private.find_private(table(spark, sf_dir, "documents"))


def queries() -> dict:
    every = (
        op1_packing, op2_decontamination, op3_url_filter, op4_warc, op5_line_dedup, op6_secrets, op7_quality, op8_near_dedup, op9_top_k, op10_main_text,
        op11_vector_codes, op12_source_divergence, op13_private_data,
    )
    return {f.__name__: f for f in every}


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BLOCK, ALLOW = ("net/", "example.com/de/"), ("example.net/en/", "org/fr/")


def _lower(column: str) -> str:
    return f"translate(coalesce({column}, ''), '{UPPER}', '{LOWER}')"


def _rule_case(result: dict[str, str]) -> str:
    """A CASE over the rules, longest first."""
    cases = []
    for rule in sorted(result, key=lambda r: (-len(r), r)):
        host, slash, path = rule.partition("/")
        cases.append(f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '{slash + path}') THEN '{result[rule]}'")
    return f"CASE {' '.join(cases)} END"


def _texts(values) -> str:
    return ", ".join(f"'{v}'" for v in sorted(values))


# a term touched by no letter or digit is a whole token between other characters
URL_SQL = f"""
WITH u AS (
  SELECT page_id, {_lower(r"regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1)")} AS host, regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path,
    string_split_regex({_lower('url')}, '[^\\p{{L}}\\p{{N}}]+') AS tokens
  FROM pages
), h AS (
  SELECT *, {_rule_case({r: r for r in BLOCK + ALLOW})} AS rule, {_rule_case({r: "block" for r in BLOCK} | {r: "allow" for r in ALLOW})} AS said,
    len([x FOR x IN tokens IF x IN ({_texts(urls.STRICT)})]) AS strict_hits, list_distinct([x FOR x IN tokens IF x IN ({_texts(urls.SOFT)})]) AS soft
  FROM u
), w AS (
  SELECT *, len(soft) AS soft_hits, coalesce(list_sum([CASE WHEN x IN ({_texts(k for k, v in urls.SOFT.items() if v == 1.0)}) THEN 1.0 ELSE 0.5 END FOR x IN soft]), 0)::DOUBLE AS soft_weight FROM h
)
SELECT page_id, host, path, rule, coalesce(said, CASE WHEN strict_hits > 0 OR (soft_hits >= {urls.SOFT_DISTINCT} AND soft_weight >= {urls.SOFT_LIMIT}) THEN 'block' ELSE 'allow' END) AS verdict,
  strict_hits, soft_hits, soft_weight FROM w
"""

WORDS_SQL = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"

SQL = {
    "op2_decontamination": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_lower('text')}, {WORDS_SQL}) AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({_lower('text')}, {WORDS_SQL}) AS w FROM benchmark WHERE item_id IS NOT NULL),
win AS (SELECT DISTINCT item_id, w[i:i + 9] AS p FROM (SELECT item_id, w, unnest(generate_series(1, greatest(1, len(w) - 9))) AS i FROM b WHERE len(w) > 0)),
spots AS (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, (SELECT DISTINCT len(p) AS n FROM win) WHERE len(w) >= n),
occ AS (SELECT s.r, s.i, s.n, win.item_id FROM spots s JOIN win ON win.p = s.w[s.i:s.i + s.n - 1]),
hit AS (SELECT r, count(DISTINCT pos) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS pos FROM occ) GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS ids FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS k FROM occ) GROUP BY r)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(hit.n_hit, 0) AS n_hit, coalesce(found.n_items, 0) AS n_items, sha256(coalesce(found.ids, '')) AS items_sha256, coalesce(hit.n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.r = d.r LEFT JOIN found ON found.r = d.r
""",
    "op3_url_filter": URL_SQL,
    "op4_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
q AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS first FROM p)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN first IS NOT NULL AND page_id IS DISTINCT FROM first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to FROM q
""",
    "op8_near_dedup": r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, [x for x in string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+') if x <> ''] AS w FROM documents
), s AS (
  SELECT DISTINCT r, hash(w[i:i + 2]) AS h FROM (SELECT r, w, unnest(generate_series(1, greatest(1, len(w) - 2))) AS i FROM d WHERE len(w) > 0)
), n AS (SELECT r, count(*) AS n FROM s GROUP BY r),
i AS (SELECT a.r AS a, b.r AS b, count(*) AS shared FROM s a JOIN s b ON a.h = b.h AND a.r < b.r GROUP BY 1, 2),
l AS (SELECT a, b FROM i JOIN n x ON x.r = a JOIN n y ON y.r = b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
t AS (SELECT r, r AS c FROM d UNION SELECT t.r, e.b FROM t JOIN e ON e.a = t.c),
c AS (SELECT t.r, min(d.doc_id) AS component_id FROM t JOIN d ON d.r = t.c GROUP BY t.r)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, coalesce(d.doc_id = c.component_id, false) AS kept FROM d JOIN c ON c.r = d.r LEFT JOIN n ON n.r = d.r
""",
    "op5_line_dedup": r"""
with l as (
  select d.rowid as r, d.doc_id, u.i, u.line,
    regexp_replace(translate(u.line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g') as key
  from (select row_number() over () as rowid, doc_id, coalesce(text, '') as text from documents) d,
    lateral (select unnest(string_split(d.text, chr(10))) as line, generate_subscripts(string_split(d.text, chr(10)), 1) as i) u
), gone as (select key from l where length(key) >= 1 group by key having count(distinct r) >= 10),
flagged as (select l.*, g.key is not null as bad from l left join gone g on l.key = g.key)
select any_value(doc_id) as doc_id, count(*) as n_lines, count(*) filter (where bad) as n_dropped,
  sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not bad), '')) as kept_sha256
from flagged group by r
""",
    "op9_top_k": r"""
with v as (
  select vec_id, [floor(256 * x::double)::bigint for x in embedding] as e from embeddings
  where vec_id is not null and embedding is not null and len([x for x in embedding if x is null or not isfinite(x)]) = 0
), s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e::double[], c.e::double[])::bigint as score
  from v q join v c on q.vec_id <> c.vec_id and len(q.e) = len(c.e) where q.vec_id % 50 = 0
), r as (select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from s)
select query_id, rank::int as rank, vec_id, score from r where rank <= 5
""",
    "op11_vector_codes": oracles.vector_codes(),
    "op12_source_divergence": oracles.source_divergence(),
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
