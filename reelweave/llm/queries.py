"""The registered queries of the operators, over whole tables, and their SQL equivalents."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from reelweave.llm.common import ship_package
from reelweave.llm.url_filter import prefix_rule

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def add(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            ship_package(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def vocabulary(name: str) -> str:
    """Where the public tokenizer files lie; operators take the path as a parameter."""
    import public_tokenizers

    return public_tokenizers.path(name)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


@register("op2_bpe_encode_decode")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import bpe

    return bpe.round_trip(read(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(coalesce(doc_id::VARCHAR, '')) AS digest
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 AS cycle
  FROM sized GROUP BY source),
limits AS (
  SELECT *, CASE cycle WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, source_size * 2 AS most
  FROM sources),
quotients AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(most) OVER (
             ORDER BY most / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
         AS quotient
  FROM limits),
targets AS (SELECT *, least(most::DOUBLE, max(quotient) OVER () * weight) AS target FROM quotients),
begun AS (
  SELECT s.doc_id, s.size, t.source_size, t.target, t.cycle, coalesce(sum(s.size) OVER (
           PARTITION BY s.source ORDER BY digest, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS begin
  FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source),
words AS (
  SELECT *, greatest(0, least(size, floor(target)::BIGINT - begin)) AS once,
         greatest(0, least(size, floor(target)::BIGINT - begin - source_size)) AS again
  FROM begun),
used AS (SELECT *, begin / target AS f1, (begin + source_size) / target AS f2 FROM words)
SELECT doc_id, size, source_size, target, (once + again)::BIGINT AS taken,
       CASE WHEN once > 0 THEN CASE cycle WHEN 0 THEN 2.0 * f1 / (1.5::DOUBLE + sqrt(2.25::DOUBLE + -2.0 * f1))
            WHEN 1 THEN 2.0 * f1 / (1.0::DOUBLE + sqrt(1.0::DOUBLE + 0.0 * f1))
            ELSE 2.0 * f1 / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0 * f1)) END END AS position_1,
       CASE WHEN again > 0 THEN CASE cycle WHEN 0 THEN 2.0 * f2 / (1.5::DOUBLE + sqrt(2.25::DOUBLE + -2.0 * f2))
            WHEN 1 THEN 2.0 * f2 / (1.0::DOUBLE + sqrt(1.0::DOUBLE + 0.0 * f2))
            ELSE 2.0 * f2 / (0.5::DOUBLE + sqrt(0.25::DOUBLE + 2.0 * f2)) END END AS position_2
FROM used
"""


@register("op5_mix_sources", MIX_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import mixture

    return mixture.plan_mix(read(spark, sf_dir, "documents")).drop("text_hash", "source")


LINE_SQL = r"""
WITH cut AS (SELECT doc_id, source, string_split(text, chr(10)) AS lines FROM documents),
numbered AS (SELECT doc_id, source, unnest(lines) AS line, generate_subscripts(lines, 1) - 1 AS line_no FROM cut),
marked AS (SELECT *, lower(trim(line, ' ')) AS mark FROM numbered),
spread AS (
  SELECT mark, min((doc_id, line_no)) AS first FROM marked WHERE mark <> ''
  GROUP BY mark HAVING count(DISTINCT coalesce('s' || source, '')) >= 5),
kept AS (
  SELECT m.doc_id, string_agg(m.line, chr(10) ORDER BY m.line_no) FILTER (s.mark IS NULL OR s.first = (m.doc_id, m.line_no)) AS text,
         count(*) AS n_lines, count(*) FILTER (s.mark IS NOT NULL AND s.first <> (m.doc_id, m.line_no)) AS n_removed
  FROM marked m LEFT JOIN spread s ON m.mark = s.mark GROUP BY m.doc_id)
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, d.lang, d.source, d.n_chars,
       coalesce(k.n_lines, 0) AS n_lines, coalesce(k.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN kept k ON d.doc_id IS NOT DISTINCT FROM k.doc_id
"""


@register("op8_line_spread", LINE_SQL)
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import line_spread

    return line_spread.counted_rows(line_spread.remove_spread_lines(read(spark, sf_dir, "documents")))


@register("op7_simhash")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import simhash

    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_digits("fp").alias("fingerprint"), "component_id")


@register("op9_token_count")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import token_count

    return token_count.count_tokens(read(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


@register("op1_nearest_vectors")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import functions as F

    from reelweave.llm import vptree

    vectors = read(spark, sf_dir, "embeddings")
    return vptree.nearest(vptree.build_index(vectors), vectors.where(F.col("vec_id") % 50 == 0))


@register("op4_embedding_groups")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import embed_dedup

    return embed_dedup.near_duplicate_vectors(read(spark, sf_dir, "embeddings"))


WARC_SQL = """
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS digest,
         max(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS stored
  FROM pages)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         ((('0x' || substr(digest, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> stored THEN stored END AS refers_to
FROM payloads
"""


@register("op6_warc_archives", WARC_SQL)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import warc
    from reelweave.session import fresh_folder

    path = fresh_folder(spark, "warc")
    warc.write_archives(read(spark, sf_dir, "pages"), path)
    return warc.page_digests(warc.read_archives(spark, path))


@register("op10_training_order")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import training_order
    from reelweave.session import fresh_folder

    path = fresh_folder(spark, "shards")
    training_order.write_shards(read(spark, sf_dir, "documents"), path, vocabulary("byte_bpe_multi_50k.tiktoken"))
    return training_order.checked(training_order.read_slots(spark, path))


@register("op3_toxicity")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import toxicity

    return toxicity.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


#: Host and path of the rules of the query, as its contract has them.
URL_RULES = [
    prefix_rule("allow", "org"), prefix_rule("block", "example.org", "/es/"), prefix_rule("block", "example.org", "/en/1"),
    prefix_rule("allow", "com", "/fr/"), prefix_rule("block", "com", "/de/"),
]
URL_SQL = r"""
WITH cut AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
ruled AS (
  SELECT *, CASE WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
                 WHEN ends_with('.' || host, '.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
                 WHEN ends_with('.' || host, '.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
                 WHEN ends_with('.' || host, '.com') AND starts_with(path, '/de/') THEN 'com/de/'
                 WHEN ends_with('.' || host, '.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM cut)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled
"""


@register("op11_url_filter", URL_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import url_filter

    return url_filter.judge_urls(read(spark, sf_dir, "pages"), URL_RULES)


@register("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import spelling

    return spelling.spelling_variants(read(spark, sf_dir, "documents"))


SEARCH_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM documents),
items AS (
  SELECT DISTINCT i, item_id, term FROM (
    SELECT row_number() OVER () AS i, item_id,
           unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
    FROM benchmark)),
counts AS (SELECT r, any_value(doc_id) AS doc_id, term, count(*)::BIGINT AS tf FROM docs GROUP BY r, term),
sizes AS (SELECT r, sum(tf)::BIGINT AS n FROM counts GROUP BY r),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
weights AS (
  SELECT term, floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w
  FROM counts, corpus WHERE term IN (SELECT term FROM items) GROUP BY term),
scores AS (
  SELECT i.i, i.item_id, c.r, c.doc_id,
         sum(w.w * ((1000000000 * c.tf) // (1000 * c.tf + 8 * (10 + (90 * s.n * corpus.docs) // corpus.terms))))::BIGINT AS score
  FROM items i JOIN counts c USING (term) JOIN weights w USING (term) JOIN sizes s USING (r), corpus
  GROUP BY i.i, i.item_id, c.r, c.doc_id),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM scores WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@register("op13_ranked_search", SEARCH_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    from reelweave.llm import fp_search

    return fp_search.search(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
