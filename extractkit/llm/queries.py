"""Registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from extractkit.llm import (
    alignment,
    decontaminate,
    licenses,
    negatives,
    ngram_join,
    packing,
    paragraphs,
    passages,
    preference,
    quality_rules,
    secrets,
    simhash,
    token_files,
    warc,
)
from extractkit.llm.tables import read

VOCABULARY = "word_bpe_49k.json"
ALIGNED = "byte_bpe_50k.json", "piece_bpe_32k.model"


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and risk-controlled rules over all documents."""
    return quality_rules.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Paragraphs of 50 words or more that repeat in documents, exactly or nearly."""
    return paragraphs.repeated(read(spark, sf_dir, "documents"))


def op2_shared_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words or more that repeat in documents, wherever they begin and end."""
    return passages.shared(read(spark, sf_dir, "documents"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    docs = read(spark, sf_dir, "documents")
    return packing.packed(docs, public_tokenizers.path(VOCABULARY))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License notices in all documents."""
    return licenses.scan(read(spark, sf_dir, "documents"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents from preference pairs."""
    return preference.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in all documents."""
    return decontaminate.digest(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of all documents, written in coded blocks and read back."""
    docs = read(spark, sf_dir, "documents")
    return token_files.digest(docs, public_tokenizers.path(VOCABULARY))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records and read back."""
    return warc.digest(read(spark, sf_dir, "pages"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents."""
    return secrets.digest(read(spark, sf_dir, "documents"))


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets reach a Jaccard similarity of 0.75."""
    return ngram_join.near_duplicates(read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of each anchor and positive among all embeddings."""
    return negatives.digest(read(spark, sf_dir, "embeddings"))


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints of all documents and of their edited texts."""
    return simhash.digest(read(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of all documents by two tokenizers, aligned by the bytes they cover."""
    return alignment.digest(read(spark, sf_dir, "documents"), *map(public_tokenizers.path, ALIGNED))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_substring_dedup,
        op2_shared_passages,
        op3_best_fit_packing,
        op4_license_scan,
        op5_quality_classifier,
        op6_decontamination,
        op7_token_files,
        op8_warc,
        op9_secret_scan,
        op10_ngram_jaccard_join,
        op11_hard_negatives,
        op12_simhash,
        op13_token_alignment,
    )
}

ORACLE: dict[str, str] = {
    "op11_hard_negatives": """
        with base as (
            select row_number() over () as row, vec_id as id,
                   case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: floor(256 * x::double)) as v
            from embeddings
            where vec_id is not null and label is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
            select a.row as anchor, a.id as anchor_id, r.row, r.id, a.label = r.label as same,
                   list_dot_product(a.v, r.v)::bigint as score
            from base a join base r on a.row <> r.row where a.id % 50 = 0),
        near as (
            select *, row_number() over (partition by anchor order by score desc, id, row) as place
            from scored where same),
        windows as (
            select anchor, anchor_id, row as positive, id as positive_id, score as positive_score
            from near where place <= 5),
        ranked as (
            select w.*, s.id as negative_id, s.score as negative_score,
                   row_number() over (partition by w.anchor, w.positive order by s.score desc, s.id, s.row) as rank
            from windows w join scored s on s.anchor = w.anchor and not s.same
             and 50 * w.positive_score <= 100 * s.score and 100 * s.score <= 95 * w.positive_score)
        select anchor_id, positive_id, rank::integer as rank, negative_id, positive_score, negative_score
        from ranked where rank <= 3
    """,
}
