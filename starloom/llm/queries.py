"""The registered queries of this package and, where SQL can say them, oracles."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import (bpe_codec, collocations, decontaminate, html_wrapper, license_scan,
                          ngram_join, quality_rules, secret_scan, sharding, simhash, token_count,
                          url_filter, whitening)
from starloom.llm.common import table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
TOKEN_LIMIT = 2048
# The url rules of the contract, as (host, path).
ALLOW = [("org", "/"), ("com", "/fr/")]
BLOCK = [("example.org", "/es/"), ("example.org", "/en/1"), ("com", "/de/")]


def op1_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html_wrapper.main_text(table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of ids and decoded text of every document."""
    return bpe_codec.token_digests(
        bpe_codec.encode_decode(table(spark, sf_dir, "documents"), BYTE_BPE))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule counts and verdict of every document."""
    judged = quality_rules.judge_documents(table(spark, sf_dir, "documents"),
                                           table(spark, sf_dir, "labels"))
    return judged.select("doc_id", *quality_rules.COUNTS, "base_failed", "kept", "score")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark words hit in every document."""
    found = decontaminate.contamination(table(spark, sf_dir, "documents"),
                                        table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ",").cast("binary"), 256)
                        .alias("items_sha256"), "contaminated")


def op5_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes and tokens of every document."""
    return (token_count.count_tokens(table(spark, sf_dir, "documents"), WORD_BPE)
            .select("doc_id", "n_bytes", "n_tokens",
                    (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of every document, by bytes."""
    return (sharding.shard_by_bytes(table(spark, sf_dir, "documents"))
            .withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}))


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and labels of every document."""
    found = license_scan.scan_licenses(table(spark, sf_dir, "documents"))
    return found.withColumns({c: F.array_join(c, ",") for c in ("base_labels", "labels")})


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.fingerprint_hex("code").alias("fingerprint"),
                        "component_id")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secret spans of every document."""
    return secret_scan.span_digests(
        secret_scan.scan_documents(table(spark, sf_dir, "documents"), BYTE_BPE))


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule and verdict of every page's url."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), ALLOW, BLOCK)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leading whitened components of every embedding."""
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle count and component of every document."""
    return (ngram_join.similar_documents(table(spark, sf_dir, "documents"))
            .select("doc_id", "n_shingles", "component_id"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Best collocations of every language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_html_wrapper, op2_bpe_codec, op3_quality_rules, op4_decontamination, op5_token_count, op6_sharding,
    op7_license_scan, op8_simhash, op9_secret_scan, op10_url_filter, op11_embedding_whitening,
    op12_ngram_join, op13_collocations)}

_URL_RULES = ", ".join(f"('{h}', '{p}', '{v}')" for v, rules in (("allow", ALLOW), ("block", BLOCK))
                       for h, p in rules)
ORACLE: dict[str, str] = {
    "op10_url_filter": f"""
        WITH cut AS (
            SELECT row_number() OVER () AS r, page_id, contains(coalesce(url, ''), '://') AS known,
                   substr(url, strpos(url, '://') + 3) AS rest FROM pages),
        parts AS (
            SELECT r, page_id,
                   CASE WHEN known THEN translate(regexp_extract(rest, '^[^/?#]*'),
                        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
                        ELSE '' END AS host,
                   CASE WHEN known THEN regexp_extract(rest, '^[^/?#]*([^?#]*)', 1)
                        ELSE '' END AS path
            FROM cut),
        rules(rule_host, rule_path, says) AS (VALUES {_URL_RULES}),
        best AS (
            SELECT r, max_by(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
                   max_by(says, length(rule_host || rule_path)) AS says
            FROM parts JOIN rules
              ON (host = rule_host OR ends_with(host, '.' || rule_host))
             AND starts_with(path, rule_path)
            GROUP BY r)
        SELECT page_id, host, path, rule, coalesce(says, 'allow') AS verdict
        FROM parts LEFT JOIN best USING (r)""",
    "op4_decontamination": r"""
        WITH words AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), @UPPER, lower(@UPPER)),
                                              @WORD) AS w FROM documents),
        item_words AS (
            SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), @UPPER, lower(@UPPER)),
                                               @WORD) AS w FROM benchmark),
        grams AS (
            SELECT DISTINCT item_id, n, array_to_string(w[i + 1:i + n], ' ') AS gram
            FROM (SELECT *, unnest(range(len(w) - n + 1)) AS i
                  FROM (SELECT *, least(13, len(w)) AS n FROM item_words WHERE len(w) > 0))),
        places AS (
            SELECT doc_id, n, i, array_to_string(w[i + 1:i + n], ' ') AS gram
            FROM (SELECT *, unnest(range(len(w) - n + 1)) AS i
                  FROM words, (SELECT DISTINCT n FROM grams) WHERE len(w) >= n)),
        hits AS (SELECT doc_id, n, i, item_id FROM places JOIN grams USING (n, gram)),
        hit_words AS (
            SELECT doc_id, count(DISTINCT place) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, n, i
                                                                     FROM hits)) GROUP BY doc_id),
        items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
            FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM words LEFT JOIN hit_words USING (doc_id) LEFT JOIN items USING (doc_id)"""
        .replace("@UPPER", "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'")
        .replace("@WORD", r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"),
    "op12_ngram_join": r"""
        WITH RECURSIVE words AS (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(
                   coalesce(text, ''), @UPPER, lower(@UPPER)), '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        sets AS MATERIALIZED (
            SELECT DISTINCT r, array_to_string(w[i + 1:i + n], ' ') AS gram
            FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS i
                  FROM (SELECT *, least(5, len(w)) AS n FROM words WHERE len(w) > 0))),
        sized AS MATERIALIZED (SELECT r, count(*) AS n FROM sets GROUP BY r),
        links AS MATERIALIZED (
            SELECT a, b FROM (
                SELECT x.r AS a, y.r AS b, count(*) AS c FROM sets x JOIN sets y USING (gram)
                WHERE x.r <> y.r GROUP BY x.r, y.r)
            JOIN sized s ON s.r = a JOIN sized t ON t.r = b WHERE 100 * c >= 80 * (s.n + t.n - c)),
        reach(a, b) AS (
            SELECT r, r FROM words UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT w.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(o.doc_id) AS component_id
        FROM words w JOIN reach ON reach.a = w.r JOIN words o ON o.r = reach.b LEFT JOIN sized s ON s.r = w.r
        GROUP BY w.r, w.doc_id"""
        .replace("@UPPER", "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"),
    "op13_collocations": r"""
        WITH pieces AS (
            SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
                   translate(coalesce(text, ''), @UPPER, lower(@UPPER)), '[.,;:!?\x0A-\x0D]')),
                   '[^\x20\x09]+') AS w FROM documents),
        totals AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM pieces GROUP BY lang),
        counts AS MATERIALIZED (
            SELECT lang, w[i + 1:i + k] AS p, k, count(*) AS f
            FROM (SELECT lang, w, k, unnest(range(len(w) - k + 1)) AS i
                  FROM (SELECT *, unnest(range(1, 6)) AS k FROM pieces) WHERE len(w) >= k)
            GROUP BY ALL HAVING count(*) >= 100),
        inside AS (
            SELECT lang, p[i + 1:i + m] AS p, max(f) AS longer
            FROM (SELECT lang, p, k, f, m, unnest(range(k - m + 1)) AS i
                  FROM (SELECT *, unnest(range(2, k)) AS m FROM counts WHERE k > 2)) GROUP BY ALL),
        cuts AS (
            SELECT c.lang, c.p, c.f AS a, cut, x.f AS l, y.f AS r, n,
                   CAST((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM counts WHERE k > 1) c
            JOIN counts x ON x.lang = c.lang AND x.p = c.p[1:cut]
            JOIN counts y ON y.lang = c.lang AND y.p = c.p[cut + 1:]
            JOIN totals t ON t.lang = c.lang),
        weakest AS (
            SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, cut) = 1)
        SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC,
               encode(array_to_string(p, ' '))) AS rank, array_to_string(p, ' ') AS phrase, a, l, r, n, score
        FROM weakest LEFT JOIN inside USING (lang, p) WHERE coalesce(longer, 0) < a
        QUALIFY rank <= 2000"""
        .replace("@UPPER", "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'"),
    # CRC-32 by its byte table, which the first lines compute from the polynomial
    "op6_sharding": """
        WITH steps AS (
            SELECT list(v ORDER BY b) AS t
            FROM (SELECT b, list_reduce([b::BIGINT] || list_transform(range(8), lambda x: 0::BIGINT),
                         lambda a, x: CASE WHEN a % 2 = 1 THEN xor(a // 2, 3988292384)
                                           ELSE a // 2 END) AS v FROM range(256) r(b))),
        octets AS (
            SELECT doc_id, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'),
                                          lambda x: ('0x' || x)::BIGINT) AS o FROM documents),
        sized AS (
            SELECT doc_id, CAST(len(o) + 1 AS BIGINT) AS size,
                   xor(list_reduce([4294967295::BIGINT] || o,
                       lambda a, x: xor(a // 256, t[xor(a % 256, x) + 1])), 4294967295) AS text_crc32
            FROM octets, steps),
        line AS (
            SELECT *, sum(size) OVER w AS upto, row_number() OVER w AS nth, sum(size) OVER () AS total
            FROM sized WINDOW w AS (ORDER BY doc_id, text_crc32 ROWS UNBOUNDED PRECEDING)),
        cut AS (SELECT *, CAST((2 * upto - size) * 8 // (2 * total) AS INTEGER) AS shard FROM line)
        SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
               nth - min(nth) OVER (PARTITION BY shard) AS slot, CAST(NULL AS INTEGER) AS grown_shard
        FROM cut""",
}
