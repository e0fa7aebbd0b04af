"""One registered query per operator, with production parameters over the whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sluice.llm.ann import nearest
from sluice.llm.chat import format_chats
from sluice.llm.divergence import source_divergence
from sluice.llm.language import identify_language, train
from sluice.llm.mixing import mix_plan
from sluice.llm.packing import pack
from sluice.llm.passages import repeats
from sluice.llm.range_join import near_duplicates
from sluice.llm.ranked import ranked_search
from sluice.llm.simhash import simhash_near_dedup
from sluice.llm.token_count import count_tokens
from sluice.llm.toxicity import score_toxicity
from sluice.llm.toxicity import train as train_toxicity
from sluice.llm.url_filter import UrlRule, judge_urls
from sluice.session import plain_unions
from sluice.sources.files import read_files

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

URL_RULES = (
    UrlRule("allow", "com"), UrlRule("block", "example.com", "/en/"), UrlRule("allow", "www.example.com", "/en/"),
    UrlRule("block", "net", "/es/"), UrlRule("block", "net", "/fr/"),
)


def query(name: str, tables: str, sql: str | None = None):
    def keep(fn: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            plain_unions(spark)
            return fn(*(read_files(spark, f"{sf_dir.rstrip('/')}/{t}.parquet") for t in tables.split()))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = sql
        return fn

    return keep


@query("op1_url_filters", "pages", r"""
    WITH cut AS (
      SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
    ), hosts AS (
      SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM cut
    ), parts AS (
      SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path
      FROM hosts
    ), rules(verdict, rhost, rpath) AS (
      VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
             ('block', 'net', '/es/'), ('block', 'net', '/fr/')
    ), best AS (
      SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
      FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
      GROUP BY page_id
    )
    SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, coalesce(verdict, 'allow') AS verdict
    FROM parts LEFT JOIN best USING (page_id)
""")
def op1(pages: DataFrame) -> DataFrame:
    return judge_urls(pages, URL_RULES)


@query("op2_nearest_neighbours", "embeddings")
def op2(vectors: DataFrame) -> DataFrame:
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))


@query("op3_chat_formatting", "conversations")
def op3(turns: DataFrame) -> DataFrame:
    return format_chats(turns)


@query("op4_substring_dedup", "documents")
def op4(docs: DataFrame) -> DataFrame:
    return repeats(docs).drop("text_hash")


@query("op5_embedding_near_dedup", "embeddings", """
    WITH RECURSIVE links AS (
      SELECT a.vec_id AS x, b.vec_id AS y FROM embeddings a JOIN embeddings b ON a.label = b.label AND a.vec_id <> b.vec_id
      WHERE list_cosine_similarity(a.embedding::DOUBLE[], b.embedding::DOUBLE[]) >= 0.98
    ), reach(x, y) AS (
      SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
    ), classes AS (
      SELECT x, min(y) AS component_id FROM reach GROUP BY x
    ), counts AS (
      SELECT x, count(*) AS n FROM links GROUP BY x
    )
    SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
    FROM embeddings JOIN classes ON vec_id = classes.x LEFT JOIN counts ON vec_id = counts.x
""")
def op5(vectors: DataFrame) -> DataFrame:
    return near_duplicates(vectors)


@query("op6_simhash_near_dedup", "documents")
def op6(docs: DataFrame) -> DataFrame:
    return simhash_near_dedup(docs)


@query("op7_packing", "documents")
def op7(docs: DataFrame) -> DataFrame:
    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


@query("op8_mixing", "documents")
def op8(docs: DataFrame) -> DataFrame:
    return mix_plan(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_token_counts", "documents")
def op9(docs: DataFrame) -> DataFrame:
    return count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


@query("op10_language_id", "documents")
def op10(docs: DataFrame) -> DataFrame:
    return identify_language(docs, train(docs))


@query("op11_source_divergence", "documents", r"""
    WITH docs AS (
      SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
      FROM documents
    ), found AS (
      SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
    ), counted AS (
      SELECT lang, source, term, count(*) AS n, count(DISTINCT doc) AS docs FROM found GROUP BY lang, source, term
    ), of_lang AS (
      SELECT lang, term, sum(n)::BIGINT AS n FROM counted GROUP BY lang, term HAVING sum(docs) >= 30
    ), kept AS (
      SELECT lang, source, term, counted.n FROM counted JOIN of_lang USING (lang, term)
    ), pairs_of AS (
      SELECT DISTINCT lang, source FROM docs
    ), langs AS (
      SELECT lang, count(term) AS v, coalesce(sum(n), 0)::BIGINT AS total
      FROM (SELECT DISTINCT lang FROM docs) LEFT JOIN of_lang USING (lang) GROUP BY lang
    ), sources AS (
      SELECT lang, source, coalesce(sum(n), 0)::BIGINT AS total FROM pairs_of LEFT JOIN kept USING (lang, source) GROUP BY lang, source
    ), shares AS (
      SELECT s.lang, s.source, t.term, coalesce(k.n, 0) AS n,
             1 + (1000000000 * (coalesce(k.n, 0) + 5)) // (s.total + 5 * l.v) AS p, 1 + (1000000000 * (t.n + 5)) // (l.total + 5 * l.v) AS q
      FROM sources s JOIN langs l USING (lang) JOIN of_lang t ON t.lang = s.lang
      LEFT JOIN kept k ON k.lang = s.lang AND k.source = s.source AND k.term = t.term
    ), sums AS (
      SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p))::BIGINT AS value
      FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source
    ), parts AS (
      SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
      FROM pairs_of a JOIN pairs_of b ON a.lang = b.lang AND a.source <> b.source
      LEFT JOIN sums ON sums.lang = a.lang AND sums.source = a.source AND sums.item = b.source
      UNION ALL
      SELECT lang, source, 'term', term, p - q FROM shares WHERE n > 0 AND p > q
    ), ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM parts
    )
    SELECT lang, source, part, item, value::BIGINT AS value, rank FROM ranked WHERE part = 'pair' OR rank <= 50
""")
def op11(docs: DataFrame) -> DataFrame:
    return source_divergence(docs)


@query("op12_ranked_search", "documents benchmark", r"""
    WITH docs AS (
      SELECT row_number() OVER () AS doc, doc_id,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
      FROM documents
    ), filled AS (
      SELECT doc, doc_id, terms, len(terms)::BIGINT AS n FROM docs WHERE len(terms) > 0
    ), whole AS (
      SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS words FROM filled
    ), tfs AS (
      SELECT doc, term, count(*)::BIGINT AS tf FROM (SELECT doc, unnest(terms) AS term FROM filled) GROUP BY doc, term
    ), weights AS (
      SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM tfs, whole GROUP BY term, docs
    ), asked AS (
      SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM benchmark
    ), scored AS (
      SELECT item_id, doc, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words))))::BIGINT AS score
      FROM asked JOIN weights USING (term) JOIN tfs USING (term) JOIN filled USING (doc), whole GROUP BY item_id, doc, doc_id
    ), ranked AS (
      SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
      FROM scored WHERE score > 0
    )
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10
""")
def op12(docs: DataFrame, items: DataFrame) -> DataFrame:
    return ranked_search(docs, items)


@query("op13_toxicity", "documents labels")
def op13(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score_toxicity(docs, train_toxicity(docs, labels))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    SQL["pipeline"] = corpus_pipeline.ORACLE_SQL
