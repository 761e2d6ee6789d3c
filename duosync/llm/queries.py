"""The operators' queries over the given tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duosync.llm.align import align_documents
from duosync.llm.common import Scratch, table
from duosync.llm.fm_index import hits, scan
from duosync.llm.itq import link_vectors
from duosync.llm.katz import score_texts
from duosync.llm.language import identify_pages, learn
from duosync.llm.license import recognise
from duosync.llm.minhash import near_duplicates
from duosync.llm.pack import pack
from duosync.llm.shard import shard_documents
from duosync.llm.styletree import extract
from duosync.llm.token_count import count_tokens
from duosync.llm.warc import archive_pages
from duosync.llm.whiten import whiten_vectors

SHARDS = 24


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_harmonic_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), Scratch(spark), tokenizer_file())


def op2_itq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_vectors(table(spark, sf_dir, "embeddings"), Scratch(spark))


def op3_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(table(spark, sf_dir, "pages"), Scratch(spark))


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), Scratch(spark))


def op5_fm_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return hits(scan(docs, items, Scratch(spark)))


def op6_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"), Scratch(spark))


def op7_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    labelled = table(spark, sf_dir, "documents").withColumnRenamed("lang", "label")
    return identify_pages(table(spark, sf_dir, "pages"), learn(labelled), Scratch(spark))


def op8_rendezvous(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_documents(table(spark, sf_dir, "documents"), Scratch(spark), [1.0] * SHARDS)


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = recognise(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id",
        "n_sentences",
        F.array_join("sentence_ids", " | ").alias("sentence_ids"),
        F.array_join("licences", ", ").alias("licences"),
        (F.size("licences") > 0).alias("licensed"),
    )


def op10_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(table(spark, sf_dir, "pages"), Scratch(spark))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return align_documents(table(spark, sf_dir, "documents"), Scratch(spark), a, b)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = whiten_vectors(table(spark, sf_dir, "embeddings"), Scratch(spark))
    # Null beyond the range of a long, which takes millions of vectors.
    return found.withColumn("deviation", F.col("deviation").try_cast("long"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


# Components by repeated steps along links ``link(u, v)``, both ways, of ``node(id)``.
_REACH = """
reach(id, root) AS (
  SELECT id, id FROM node
  UNION
  SELECT reach.id, link.v FROM reach JOIN link ON reach.root = link.u),
label AS (SELECT id, min(root) AS component_id FROM reach GROUP BY id)
"""

# Text after lower-casing A-Z only.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_harmonic_packing": op1_harmonic_packing,
    "op2_itq": op2_itq,
    "op3_segments": op3_segments,
    "op4_minhash": op4_minhash,
    "op5_fm_index": op5_fm_index,
    "op6_katz": op6_katz,
    "op7_language": op7_language,
    "op8_rendezvous": op8_rendezvous,
    "op9_license": op9_license,
    "op10_style_tree": op10_style_tree,
    "op11_alignment": op11_alignment,
    "op12_whitening": op12_whitening,
    "op13_token_counts": op13_token_counts,
}

SQL: dict[str, str] = {
    "op2_itq": f"""
WITH RECURSIVE node AS (
  SELECT vec_id AS id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE embedding IS NOT NULL AND list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]) > 0),
link AS (
  SELECT a.id AS u, b.id AS v FROM node a JOIN node b ON a.id <> b.id
  WHERE len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.9),
{_REACH}
SELECT e.vec_id, count(link.v) AS n_links, coalesce(any_value(label.component_id), e.vec_id)
  AS component_id, e.vec_id = coalesce(any_value(label.component_id), e.vec_id) AS kept
FROM embeddings e LEFT JOIN label ON label.id = e.vec_id LEFT JOIN link ON link.u = e.vec_id
GROUP BY e.vec_id
""",
    "op3_segments": """
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
    sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
m AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS last FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN 'revisit' ELSE 'response' END
    AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id < last THEN last END AS refers_to
FROM m
""",
    "op4_minhash": f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x09-\\x0D ]+') AS w
  FROM documents),
shingle AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + least(5, len(w)) - 1], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - least(5, len(w)) + 2)) AS i
        FROM w WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS n
  FROM shingle a JOIN shingle b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY 1, 2),
link AS (
  SELECT u, v FROM shared JOIN size a ON a.doc_id = u JOIN size b ON b.doc_id = v
  WHERE 100 * shared.n >= 75 * (a.n + b.n - shared.n)),
node AS (SELECT doc_id AS id FROM documents),
{_REACH}
SELECT d.doc_id, coalesce(size.n, 0) AS n_shingles, label.component_id,
  d.doc_id = label.component_id AS kept
FROM documents d JOIN label ON label.id = d.doc_id LEFT JOIN size ON size.doc_id = d.doc_id
""",
    "op5_fm_index": f"""
WITH cut AS (SELECT '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+' AS word),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, word) AS w FROM documents, cut),
b AS (
  SELECT item_id, w, least(10, len(w)) AS n
  FROM (SELECT item_id, regexp_extract_all({_LOWER}, word) AS w FROM benchmark, cut)
  WHERE len(w) > 0),
phrase AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i : i + n - 1], ' ') AS p
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM b)),
place AS (
  SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM phrase) WHERE len(w) >= n)),
found AS (SELECT doc_id, place.n, i, item_id FROM place JOIN phrase USING (n, p)),
hit AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM found) GROUP BY doc_id),
item AS (
  SELECT doc_id, count(DISTINCT item_id) AS n_items,
    array_to_string(list_sort(list_distinct(list(item_id::VARCHAR))), ',') AS names
  FROM found GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit ON hit.doc_id = d.doc_id LEFT JOIN item ON item.doc_id = d.doc_id
""",
    # The given pages' markup is regular enough for patterns.
    "op10_style_tree": """
WITH a AS (
  SELECT page_id, url,
    regexp_extract(coalesce(html, ''), '<article>(.*)</article>', 1, 's') AS body FROM pages),
t AS (
  SELECT page_id, url, trim(regexp_replace(replace(replace(replace(replace(
    regexp_replace(regexp_replace(body, '</?(p|h1|br)[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g'),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), '\\s+', ' ', 'g')) AS text FROM a)
SELECT page_id, url, text, length(text) AS n_chars FROM t
""",
}
