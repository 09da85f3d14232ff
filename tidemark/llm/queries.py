"""Queries of the operators over whole tables, and their SQL where it can express them."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    divergence,
    embedding_dedup,
    exact_dedup,
    html_extract,
    langid,
    merkle,
    packing,
    pieces,
    secret_scan,
    simhash,
    span_dedup,
    toxicity,
    url_filter,
)
from tidemark.llm.common import cut, measured, table, text_key

#: File name of the tokenizer's model; its place comes from the installed package.
TOKENIZER = "piece_bpe_32k.model"


def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = measured(cut(secret_scan.find_secrets(docs)))
    keys = docs.select("doc_id", text_key(F.col("text")).alias("key"))
    same = keys["doc_id"].eqNullSafe(found["_id"]) & (keys["key"] == found["_key"])
    spans = F.coalesce("spans", F.array().cast(found.schema["spans"].dataType))

    def count(kind: str):
        return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return keys.join(found, same, "left").select(
        "doc_id",
        count("assign"),
        count("access"),
        count("hex"),
        F.sha2(secret_scan.listed(secret_scan.base_of(spans)), 256).alias("base_sha256"),
        secret_scan.listed(spans).alias("spans"),
    )


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.judge_urls(table(spark, sf_dir, "pages")).drop("score")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.withColumnRenamed("_id", "doc_id")


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    encoded = pieces.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return encoded.select(
        F.col("_id").alias("doc_id"),
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def op8_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return span_dedup.span_dedup(table(spark, sf_dir, "documents"))


def op9_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("_id").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(exact_dedup.normalised(F.col("text")), 256))
    found = exact_dedup.exact_dedup(docs, carry=["doc_id", "text_sha256"])
    return found.select("_carry.doc_id", "keep_id", "group_size", "kept", "_carry.text_sha256")


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    fields = [lowered if f == "text" else F.col(f) for f in merkle.FIELDS]
    tampered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    manifest = merkle.build(docs, found=F.when(tampered, merkle.leaf_of(fields)))
    return manifest.audit().select("_carry.doc_id", "*").drop("_carry")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(table(spark, sf_dir, "documents"))


def op13_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents")).withColumnRenamed("_id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_html_extraction,
        op2_secret_scan,
        op3_best_fit_packing,
        op4_url_filter,
        op5_toxicity,
        op6_sentencepiece,
        op7_embedding_dedup,
        op8_span_dedup,
        op9_simhash_dedup,
        op10_exact_dedup,
        op11_merkle_manifest,
        op12_source_divergence,
        op13_language_id,
    )
}

_URL_LEVEL = """
g{n} AS (
  SELECT right(gram, {n}) AS gram, left(right(gram, {n}), {m}) AS context, sum(a) AS a, sum(b) AS b
  FROM grams GROUP BY 1, 2),
c{n} AS (
  SELECT context, sum(a) AS all_a, sum(b) AS all_b,
    count(*) FILTER (a > 0) AS kinds_a, count(*) FILTER (b > 0) AS kinds_b
  FROM g{n} GROUP BY 1),
p{n} AS (
  SELECT gram,
    CASE WHEN all_a + kinds_a > 0 THEN (a + kinds_a * low_a) / (all_a + kinds_a) ELSE low_a END AS p_a,
    CASE WHEN all_b + kinds_b > 0 THEN (b + kinds_b * low_b) / (all_b + kinds_b) ELSE low_b END AS p_b
  FROM g{n} JOIN c{n} USING (context)
    JOIN (SELECT gram AS rest, p_a::DOUBLE AS low_a, p_b::DOUBLE AS low_b FROM p{m}) ON rest = right(gram, {m}))
"""

_URL_SQL = f"""
WITH found AS (
  SELECT page_id, strpos(url, '://') AS mark, substr(url, strpos(url, '://') + 3) AS rest FROM pages),
parts AS (
  SELECT page_id,
    CASE WHEN mark > 0 THEN translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN mark > 0 THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM found),
rules AS (SELECT * FROM (VALUES {", ".join(map(str, url_filter.RULES))}) t(verdict, h, p)),
fits AS (
  SELECT host, path, max_by(h || p, length(h || p)) AS rule, max_by(verdict, length(h || p)) AS verdict
  FROM (SELECT DISTINCT host, path FROM parts) JOIN rules
    ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p) GROUP BY 1, 2),
urls AS (
  SELECT host, path, rule, verdict, count(*) FILTER (verdict = 'allow') AS a,
    count(*) FILTER (verdict = 'block') AS b
  FROM parts LEFT JOIN fits USING (host, path) GROUP BY 1, 2, 3, 4),
windows AS (
  SELECT host, path, a, b, substr(repeat(chr(2), 5) || host || path || chr(3), i::BIGINT, 6) AS gram
  FROM urls, unnest(range(1, length(host || path) + 2)) AS u(i)),
grams AS (SELECT gram, sum(a) AS a, sum(b) AS b FROM windows GROUP BY 1),
p0 AS (SELECT '' AS gram, 1 / 256 AS p_a, 1 / 256 AS p_b),
{",".join(_URL_LEVEL.format(n=n, m=n - 1) for n in range(1, 7))},
scored AS (
  SELECT host, path, any_value(a) AS a, any_value(b) AS b, avg(ln(p_a) - ln(p_b)) AS score
  FROM windows JOIN p6 USING (gram) GROUP BY 1, 2),
steps AS (
  SELECT floor(greatest(-10.0::DOUBLE, least(10.0::DOUBLE, score)) / 0.01::DOUBLE)::BIGINT AS place,
    sum(a) AS a, sum(b) AS b FROM scored WHERE a > 0 OR b > 0 GROUP BY 1),
ends AS (SELECT * FROM steps UNION ALL SELECT max(place) + 1, 0, 0 FROM steps HAVING count(*) > 0),
recalls AS (
  SELECT place, (sum(a) OVER () - coalesce(sum(a) OVER before, 0)) / sum(a) OVER ()
    + coalesce(sum(b) OVER before, 0) / sum(b) OVER () AS recall
  FROM ends WINDOW before AS (ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
least_ AS (
  SELECT coalesce((SELECT place FROM recalls WHERE isfinite(recall)
    ORDER BY recall DESC, abs(place), place DESC LIMIT 1) * 0.01::DOUBLE, 0) AS least)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN score >= least THEN 'allow' ELSE 'block' END) AS verdict
FROM parts JOIN urls USING (host, path) JOIN scored USING (host, path), least_
"""


def _merkle_sql(rows: int = 6, groups: int = 4) -> str:
    """SQL for trees of at most 16^rows rows a source and 16^groups sources."""

    def field(name: str) -> str:
        return f"coalesce(octet_length(encode({name}::VARCHAR)) || ':' || {name}, '-')"

    def leaf(text: str) -> str:
        return "sha256(" + " || ".join(field(text if f == "text" else f) for f in merkle.FIELDS) + ")"

    def tree(start: str, name: str, levels: int) -> list[str]:
        found = [f"{name}0 AS ({start})"]
        for n in range(levels):
            found.append(f"""{name}{n + 1} AS (
  SELECT g, idx // 16 AS idx, (n + 15) // 16 AS n,
    CASE WHEN n = 1 THEN any_value(d) ELSE sha256(string_agg(d, '' ORDER BY idx)) END AS d
  FROM {name}{n} GROUP BY g, idx // 16, n)""")
        return found

    def climb(start: str, name: str, nodes: str, levels: int) -> list[str]:
        found = [f"{name}0 AS ({start})"]
        for n in range(levels):
            found.append(f"""{name}{n + 1} AS (
  SELECT row, p.g, p.idx // 16 AS idx, proof || a || b AS proof,
    CASE WHEN p.n > 1 THEN sha256(a || now || b) ELSE now END AS now, (p.n + 15) // 16 AS n
  FROM (SELECT p.row, p.g, p.idx, p.n, any_value(p.proof) AS proof, any_value(p.now) AS now,
      coalesce(string_agg(s.d, '' ORDER BY s.idx) FILTER (s.idx < p.idx), '') AS a,
      coalesce(string_agg(s.d, '' ORDER BY s.idx) FILTER (s.idx > p.idx), '') AS b
    FROM {name}{n} p JOIN {nodes}{n} s ON p.g = s.g AND p.idx // 16 = s.idx // 16 GROUP BY ALL) p)""")
        return found

    parts = [
        f"""leaves AS (
  SELECT *, row_number() OVER (ORDER BY g, doc_id NULLS FIRST, leaf) AS row,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY g) AS n,
    CASE WHEN crc % 5 = 0 THEN tampered ELSE leaf END AS now
  FROM (SELECT doc_id, coalesce('=' || source, '') AS g, {leaf("text")} AS leaf,
      {leaf("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS tampered,
      xor(list_reduce([ascii(x)::BIGINT FOR x IN string_split(doc_id::VARCHAR, '')], lambda c, x:
        list_reduce(range(8), lambda r, i: CASE WHEN r & 1 = 1 THEN xor(r >> 1, 3988292384) ELSE r >> 1 END,
          xor(c, x)), 4294967295::BIGINT), 4294967295::BIGINT) AS crc
    FROM documents))""",
        *tree("SELECT g, idx, n, leaf AS d FROM leaves", "l", rows),
        f"""subroots AS (SELECT g, d, row_number() OVER (ORDER BY g) - 1 AS idx, count(*) OVER () AS n FROM l{rows})""",
        *tree("SELECT '' AS g, idx, n, d FROM subroots", "t", groups),
        *climb("SELECT row, g, idx, n, '' AS proof, now FROM leaves", "p", "l", rows),
        *climb(
            f"SELECT row, '' AS g, s.idx, s.n, proof, now FROM p{rows} JOIN subroots s USING (g)", "q", "t", groups
        ),
    ]
    return f"""
WITH {",".join(parts)}
SELECT doc_id, leaf, s.d AS subroot, t.d AS root, sha256(proof) AS proof_sha256, q.now AS folded_root,
  q.now = t.d AS verified
FROM leaves JOIN subroots s USING (g) JOIN q{groups} q USING (row), t{groups} t
"""


_DIVERGENCE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS item
  FROM docs),
kept AS (
  SELECT lang, item, count(*) AS n FROM words GROUP BY 1, 2 HAVING count(DISTINCT d) >= 30),
totals AS (SELECT lang, count(*) AS v, sum(n) AS n FROM kept GROUP BY 1),
counts AS (SELECT lang, source, item, count(*) AS n FROM words GROUP BY 1, 2, 3),
used AS (
  SELECT g.lang, g.source, item, coalesce(c.n, 0) AS n,
    sum(coalesce(c.n, 0)) OVER (PARTITION BY g.lang, g.source) AS total
  FROM (SELECT DISTINCT lang, source FROM docs) g JOIN kept k USING (lang)
    LEFT JOIN counts c USING (lang, source, item)),
chances AS (
  SELECT lang, source, item, u.n, 1 + (1000000000::HUGEINT * (u.n + 5)) // (total + 5 * v)::HUGEINT AS p,
    1 + (1000000000::HUGEINT * (k.n + 5)) // (t.n + 5 * v)::HUGEINT AS q
  FROM used u JOIN kept k USING (lang, item) JOIN totals t USING (lang)),
sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM chances a JOIN chances b USING (lang, item) GROUP BY 1, 2, 3),
groups AS (SELECT DISTINCT lang, source FROM docs),
parts AS (
  SELECT lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b USING (lang)
    LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  WHERE a.source <> b.source
  UNION ALL
  SELECT lang, source, 'term', item, (p - q)::BIGINT FROM chances WHERE n > 0 AND p > q)
SELECT *, (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM parts QUALIFY part = 'pair' OR rank <= 50
"""

ORACLES: dict[str, str] = {
    "op4_url_filter": _URL_SQL,
    "op7_embedding_dedup": """
WITH RECURSIVE good AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
    ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
  SELECT vec_id AS node, vec_id AS seen FROM embeddings
  UNION SELECT node, b FROM reach JOIN links ON a = seen),
least AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY 1),
counts AS (SELECT a, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM embeddings JOIN least ON node = vec_id LEFT JOIN counts ON a = vec_id
""",
    "op10_exact_dedup": r"""
WITH texts AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
    regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents)
SELECT doc_id, first_value(doc_id) OVER best AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size,
  row_number() OVER best = 1 AS kept, sha256(norm) AS text_sha256
FROM texts WINDOW best AS (PARTITION BY norm ORDER BY chars DESC, doc_id NULLS LAST)
""",
    "op11_merkle_manifest": _merkle_sql(),
    "op12_source_divergence": _DIVERGENCE_SQL,
}
