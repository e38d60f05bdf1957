"""One query per operator over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shipflux.llm import alignment, bpe, collocations, mtree, near, pages, passages, quality, secrets, suffixes, toxicity, urls, warc
from shipflux.llm.common import table
from shipflux.session import staged

VOCABULARY = "byte_bpe_multi_50k.tiktoken"


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.score(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every document."""
    codec = bpe.codec(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return bpe.round_trip_digests(table(spark, sf_dir, "documents"), codec)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity score of every document, with its evidence."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


# Fixed values of the contract.
URL_RULES = [
    urls.Rule("com", "/", "allow"),
    urls.Rule("example.com", "/en/", "block"),
    urls.Rule("www.example.com", "/en/", "allow"),
    urls.Rule("net", "/es/", "block"),
    urls.Rule("net", "/fr/", "block"),
]


def op4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, rule and verdict of every page."""
    return urls.judge(table(spark, sf_dir, "pages"), URL_RULES)


def op5_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every document without passages of earlier ones."""
    return passages.dedup(table(spark, sf_dir, "documents")).drop("kept")


def op6_near(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The class of near duplicates of every document."""
    return near.classes(table(spark, sf_dir, "documents"))


def op8_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return pages.extract(table(spark, sf_dir, "pages"), urls.host_of)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every candidate finding in the documents, with the forest's verdict."""
    return secrets.scan(table(spark, sf_dir, "documents"))


def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best rows for every hundredth vector."""
    rows = table(spark, sf_dir, "embeddings")
    return mtree.top_k(rows, rows.filter(F.col("vec_id") % 100 == 0))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hit words and items of every document, and whether it is contaminated."""
    found = suffixes.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives of all pages say of each page's payload."""
    pages = table(spark, sf_dir, "pages")
    records = staged(warc.read(warc.write(pages)), "warc-records")
    captures = warc.payload_facts(warc.assemble(records))
    id_type = pages.schema["page_id"].dataType
    return captures.select(
        warc.first_fields(F.col("metadata"))["id"].cast(id_type).alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("record.type").alias("record_type"),
        F.col("same_payload.fields")["id"].cast(id_type).alias("refers_to"),
    )


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of the two tokenizers' tokens in every document."""
    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.align(table(spark, sf_dir, "documents"), alignment.Tokenizers.read(*files))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2,000 best phrases of each language of the documents."""
    return collocations.collocations(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_bpe": op2_bpe,
    "op3_toxicity": op3_toxicity,
    "op4_urls": op4_urls,
    "op5_passages": op5_passages,
    "op6_near": op6_near,
    "op7_secrets": op7_secrets,
    "op8_pages": op8_pages,
    "op9_decontamination": op9_decontamination,
    "op10_search": op10_search,
    "op11_warc": op11_warc,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}

_PASSAGES = r"""
WITH texts AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
windows AS (SELECT doc_id, starts, array_to_string(words[starts:starts + 12], ' ') AS passage
            FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS starts FROM texts) AS s),
firsts AS (SELECT passage, min(doc_id) AS first_id FROM windows GROUP BY passage),
gone AS (SELECT doc_id, list(DISTINCT place) AS places
         FROM (SELECT doc_id, unnest(range(starts, starts + 13)) AS place
               FROM windows JOIN firsts USING (passage) WHERE first_id < doc_id) AS p GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(len(places), 0) AS BIGINT) AS n_removed,
       sha256(array_to_string(CASE WHEN places IS NULL THEN words
         ELSE list_filter(words, lambda w, i: NOT list_contains(places, i)) END, ' ')) AS kept_sha256
FROM texts LEFT JOIN gone USING (doc_id)
"""

_CONTAMINATION = r"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[starts:starts + size - 1], ' ') AS passage
  FROM (SELECT item_id, words, least(13, len(words)) AS size, unnest(range(1, len(words) - least(13, len(words)) + 2)) AS starts
        FROM items WHERE len(words) > 0) AS s),
doc_windows AS (
  SELECT doc_id, size, starts, array_to_string(words[starts:starts + size - 1], ' ') AS passage
  FROM (SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS starts
        FROM texts, (SELECT DISTINCT size FROM item_windows) AS sizes) AS s),
found AS (SELECT doc_id, starts, d.size, item_id FROM doc_windows AS d JOIN item_windows AS i ON d.passage = i.passage AND d.size = i.size),
hits AS (SELECT doc_id, count(DISTINCT place) AS n_hit
         FROM (SELECT doc_id, unnest(range(starts, starts + size)) AS place FROM found) AS p GROUP BY doc_id),
owners AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS ids FROM found GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, CAST(coalesce(len(ids), 0) AS BIGINT) AS n_items,
       sha256(coalesce(array_to_string(ids, ','), '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM texts LEFT JOIN hits USING (doc_id) LEFT JOIN owners USING (doc_id)
"""

_SEARCH = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
  FROM usable AS q JOIN usable AS c ON q.vec_id % 100 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
FROM scored QUALIFY rank <= 10
"""

_WARC = """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, upper(sha1(coalesce(html, ''))) AS digits FROM pages),
spelled AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i:
    substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      CAST(((CAST('0x' || substr(digits, CAST(1 + 10 * (i // 8) AS BIGINT), 10) AS BIGINT)) >> CAST(35 - 5 * (i % 8) AS INTEGER)) & 31 AS BIGINT) + 1, 1)), '')
    AS payload_digest
  FROM hashed),
firsts AS (SELECT payload_digest, min(page_id) AS first_id FROM spelled GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to
FROM spelled JOIN firsts USING (payload_digest)
"""

_COLLOCATIONS = r"""
WITH pieces AS MATERIALIZED (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words
  FROM (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
        FROM documents) AS cut),
totals AS (SELECT lang, sum(len(words)) AS n FROM pieces GROUP BY lang),
counted AS MATERIALIZED (
  SELECT lang, array_to_string(words[starts:starts + size - 1], ' ') AS phrase, size, CAST(count(*) AS HUGEINT) AS f
  FROM (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS starts
        FROM pieces, (SELECT unnest(range(1, 6)) AS size) AS sizes WHERE len(words) >= size) AS s
  GROUP BY ALL HAVING count(*) >= 100),
cuts AS (
  SELECT lang, phrase, f, size, k, array_to_string(words[1:k], ' ') AS head, array_to_string(words[k + 1:], ' ') AS rest
  FROM (SELECT *, string_split(phrase, ' ') AS words, unnest(range(1, size)) AS k FROM counted WHERE size > 1) AS c),
scores AS MATERIALIZED (
  SELECT c.lang, c.phrase, c.size, c.f AS a, l.f AS l, r.f AS r, n, k, (1000 * c.f * CAST(n AS HUGEINT)) // (l.f * r.f) AS score
  FROM cuts AS c JOIN totals USING (lang)
  JOIN counted AS l ON l.lang = c.lang AND l.phrase = c.head JOIN counted AS r ON r.lang = c.lang AND r.phrase = c.rest),
weakest AS (SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT DISTINCT lang, array_to_string(words[starts:starts + part - 1], ' ') AS phrase, f AS around
  FROM (SELECT *, unnest(range(1, size - part + 2)) AS starts
        FROM (SELECT *, string_split(phrase, ' ') AS words, unnest(range(2, size)) AS part FROM counted WHERE size > 2) AS p) AS q),
kept AS (SELECT w.* FROM weakest AS w WHERE NOT EXISTS (
  SELECT 1 FROM inside AS i WHERE i.lang = w.lang AND i.phrase = w.phrase AND 100 * i.around >= 100 * w.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase,
       CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM kept QUALIFY rank <= 2000
"""

# Trained models, merges and components have no SQL here; tests/llm compares those by brute force.
ORACLE_SQL: dict[str, str] = {
    "op5_passages": _PASSAGES,
    "op9_decontamination": _CONTAMINATION,
    "op10_search": _SEARCH,
    "op11_warc": _WARC,
    "op13_collocations": _COLLOCATIONS,
}
