"""The registered queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickloom.llm.bestfit import pack_best_fit
from tickloom.llm.centroids import centroid_clusters, clusters_sql
from tickloom.llm.common import prepare
from tickloom.llm.decontamination import contaminated
from tickloom.llm.embeddings import near_vectors
from tickloom.llm.language_id import predict_languages, train_language_model
from tickloom.llm.licenses import scan_licenses, scan_sql
from tickloom.llm.lm_scoring import held_out_column, score_texts
from tickloom.llm.packing import pack
from tickloom.llm.phrases import collocations, collocations_sql
from tickloom.llm.simhash import simhash_groups
from tickloom.llm.substrings import repeated_passages
from tickloom.llm.token_counts import count_tokens
from tickloom.llm.warc import archive_pages
from tickloom.sources import read_table

Query = Callable[[SparkSession, str], DataFrame]

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents"), BYTE_BPE)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack(read_table(spark, sf_dir, "documents"), BYTE_BPE))


def piece_digests(pieces: DataFrame) -> DataFrame:
    """A checksum in the place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(read_table(spark, sf_dir, "embeddings"))


def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"), held_out_column("doc_id", 10, 0))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    held_out = held_out_column("doc_id", 4, 2)
    model = train_language_model(docs, ~held_out)
    return predict_languages(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return archive_pages(read_table(spark, sf_dir, "pages"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(read_table(spark, sf_dir, "documents")).drop("fp")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that overlap with a benchmark text, and where."""
    return contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("doc")


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every place of a repeated passage; ``kept``: the document that keeps it."""
    return repeated_passages(read_table(spark, sf_dir, "documents")).drop("doc").withColumnsRenamed({"id": "doc_id", "first_id": "first_doc_id"})


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan_licenses(read_table(spark, sf_dir, "documents"))


def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    clusters = centroid_clusters(read_table(spark, sf_dir, "embeddings"))
    return clusters.withColumn("centroid_sha256", F.sha2(F.array_join("centroid", ","), 256)).drop("centroid")


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(read_table(spark, sf_dir, "documents"))


def op13_bestfit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return piece_digests(pack_best_fit(read_table(spark, sf_dir, "documents"), BYTE_BPE))


def prepared(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        prepare(spark)
        return query(spark, sf_dir)

    return run


ALL = {
    "op1_token_counts": op1_token_counts,
    "op2_packing": op2_packing,
    "op3_embedding_near_dedup": op3_embedding_near_dedup,
    "op4_lm_scoring": op4_lm_scoring,
    "op5_language_id": op5_language_id,
    "op6_warc": op6_warc,
    "op7_simhash": op7_simhash,
    "op8_decontamination": op8_decontamination,
    "op9_substring_dedup": op9_substring_dedup,
    "op10_license_scan": op10_license_scan,
    "op11_centroid_clustering": op11_centroid_clustering,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_bestfit_packing": op13_bestfit_packing,
}
QUERIES = {name: prepared(query) for name, query in ALL.items()}
SQL = {
    "op6_warc": """
        WITH p AS (
            SELECT page_id, coalesce(html, '') AS body, sha256(coalesce(html, '')) AS digest, strlen(coalesce(html, '')) AS size
            FROM pages
        ),
        f AS (SELECT digest, min(page_id) AS first FROM p WHERE size >= 100 GROUP BY digest)
        SELECT p.page_id, p.size AS payload_bytes, p.digest AS payload_digest,
               CASE WHEN f.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN f.first <> p.page_id THEN f.first END AS refers_to
        FROM p LEFT JOIN f USING (digest)
    """,
    # all pairs, and all that each vector reaches: for tables of some thousand vectors
    "op3_embedding_near_dedup": """
        WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
        good AS (
            SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS norm FROM v
            WHERE len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
              AND len(list_filter(e, lambda x: x <> 0)) > 0
        ),
        links AS (
            SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
            WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.9
        ),
        reached AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a),
        counts AS (SELECT a, count(*) AS n FROM links GROUP BY a),
        firsts AS (SELECT a, min(b) AS first FROM reached GROUP BY a)
        SELECT v.vec_id, coalesce(n, 0) AS n_links, least(v.vec_id, coalesce(first, v.vec_id)) AS component_id,
               v.vec_id = least(v.vec_id, coalesce(first, v.vec_id)) AS kept
        FROM v LEFT JOIN counts ON counts.a = v.vec_id LEFT JOIN firsts ON firsts.a = v.vec_id
    """,
    "op10_license_scan": scan_sql(),
    "op11_centroid_clustering": clusters_sql(),
    "op12_phrase_collocations": collocations_sql(),
}
