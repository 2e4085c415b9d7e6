"""Token counts through a cache of digests.

A text is known by two digests: that of its normalised content, and that of the
tokenizer's version, which covers the model file and the normal form. The vocabulary's
own normalisation is the identity but for spaces, which become the mark U+2581, so that
is the normal form; texts with one normal form have one count. Stored counts are joined
by digest. Only contents that are not stored are encoded, each once however many
documents hold it, by the library that defines the counts; the new counts are appended to
the cache, one folder per version, and the documents read theirs from it.

Contents are reduced by digest before the shuffle, so a text with a third of all rows
moves once per task. Documents meet their counts as rows of id and digest; there adaptive
execution splits a digest with many rows. An append is one committed write: a job that is
lost leaves no part of it. Two jobs may append one digest twice, with one count, and
readers keep one row.

Defined results: a null or empty text has no bytes and no tokens. Repeated rows are
counted each, a null ``doc_id`` is carried, extra columns are ignored whatever their names
are. Very long texts are encoded whole. An empty table gives an empty result and stores
nothing.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgrid.llm.memory import small_batches, tidy
from corpusgrid.llm.tokens import blocks, vocabulary_path
from corpusgrid.session import table_path

LIMIT = 4096
MARK = "▁"
NORMAL_FORM = "spaces as U+2581"
STORED = "digest binary, n_tokens long, version string"


def tokenizer_version(model_path: str) -> str:
    """Digest of the model file and the normal form of contents."""
    with open(model_path, "rb") as model:
        return hashlib.sha256(model.read() + NORMAL_FORM.encode()).hexdigest()


def content_digest(text) -> F.Column:
    return F.unhex(F.sha2(F.translate(text, " ", MARK), 256))


def stored_counts(spark: SparkSession, cache: str, version: str) -> DataFrame:
    """``digest, n_tokens`` of the cache under one version, a digest once; a cache not begun is empty."""
    try:
        kept = spark.read.schema(STORED).parquet(cache)
    except AnalysisException as fault:
        if fault.getCondition() != "PATH_NOT_FOUND":
            raise
        kept = spark.createDataFrame([], STORED)
    return kept.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def encode_lengths(contents: DataFrame, model_path: str) -> DataFrame:
    """``digest, n_tokens`` of rows of ``digest, text``."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import sentencepiece
        coder = sentencepiece.SentencePieceProcessor(model_file=model_path)
        for batch in batches:
            texts, counts = batch.column(1).to_pylist(), []
            for a, b in blocks(texts):
                counts += map(len, coder.encode(texts[a:b], num_threads=1))
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64())], names=["digest", "n_tokens"])
        tidy()

    return small_batches(contents).select("digest", "text").mapInArrow(count, "digest binary, n_tokens long")


def count_tokens(docs: DataFrame, cache: str | None = None, model_path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """``doc_id, n_bytes, n_tokens, over_limit`` of every document.

    ``cache`` is a folder all executors reach; without it the counts are kept in a new one.
    """
    spark = docs.sparkSession
    model_path = model_path or vocabulary_path("piece_bpe_32k.model")
    cache, version = cache or table_path(spark, "token-counts"), tokenizer_version(model_path)
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    texts = texts.withColumn("digest", content_digest(F.col("text")))
    known = stored_counts(spark, cache, version)
    missed = texts.groupBy("digest").agg(F.first("text").alias("text")).join(known, "digest", "left_anti")
    (encode_lengths(missed, model_path).withColumn("version", F.lit(version))
     .write.mode("append").partitionBy("version").parquet(cache))
    counted = texts.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes")).join(
        stored_counts(spark, cache, version), "digest", "left")
    return counted.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
