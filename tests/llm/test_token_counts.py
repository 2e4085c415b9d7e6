"""Token counts against the library, and the cache of digests."""

import pyspark.sql.functions as F
import pytest
import sentencepiece

from corpusgrid.llm import token_counts as T
from corpusgrid.llm.catalog import QUERIES
from corpusgrid.llm.tokens import vocabulary_path
from corpusgrid.llm.token_counts import count_tokens, stored_counts, tokenizer_version

MODEL = vocabulary_path("piece_bpe_32k.model")
ODD = [None, "", " ", "a b", "a▁b", "  two  ", "\t\n", "<s> </s> <unk> <0x41>", "naïve 漢字 🎈", "é", "\x00", "a b", "word " * 30_000]


@pytest.fixture(scope="module")
def coder():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def docs(spark, texts, first=0):
    rows = [(first + i, t, "x", 1) for i, t in enumerate(texts)] + [(None, "no id", "y", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, digest string, n_tokens int")


def test_query_equals_the_library(spark, tmp_path, coder):
    docs(spark, ODD).write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op13_token_counts"](spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    want = [(i, len((t or "").encode()), len(coder.encode(t or ""))) for i, t in [*enumerate(ODD), (None, "no id")]]
    assert sorted(map(str, map(tuple, got.collect()))) == sorted(str((*w, w[2] > 4096)) for w in want)
    assert got.where("over_limit").count() == 1


def test_spaces_and_marks_share_a_normal_form(coder):
    for t in filter(None, ODD):
        assert len(coder.encode(t)) == len(coder.encode(t.replace(" ", T.MARK)))


def test_only_distinct_misses_are_encoded_and_appended(spark, tmp_path, monkeypatch):
    cache, asked, encode = f"{tmp_path}/cache", [], T.encode_lengths

    def watched(contents, model_path):
        asked.append(sorted(r.text for r in contents.collect()))
        return encode(contents, model_path)

    monkeypatch.setattr(T, "encode_lengths", watched)
    first = count_tokens(docs(spark, ["one", "two two", "one", None]), cache).collect()
    again = count_tokens(docs(spark, ["one", "three", "two two"], 10), cache).collect()
    assert asked == [["", "no id", "one", "two two"], ["three"]]
    kept = stored_counts(spark, cache, tokenizer_version(MODEL))
    assert kept.count() == 5
    count = {r.doc_id: r.n_tokens for r in first + again}
    assert count[0] == count[2] == count[10] and count[1] == count[12] and count[3] == 0


def test_stored_counts_are_used_under_their_version_only(spark, tmp_path):
    cache = f"{tmp_path}/cache"
    told = spark.createDataFrame([("one", 77), ("two", 78)], "text string, n_tokens long")
    for version, t in ((tokenizer_version(MODEL), "one"), ("another", "two")):
        (told.where(F.col("text") == t).select(T.content_digest(F.col("text")).alias("digest"), "n_tokens", F.lit(version).alias("version"))
         .write.mode("append").partitionBy("version").parquet(cache))
    got = {r.doc_id: r.n_tokens for r in count_tokens(docs(spark, ["one", "two"]), cache).collect()}
    assert got[0] == 77 and got[1] < 78


def test_a_digest_appended_twice_is_read_once(spark, tmp_path):
    cache, some = f"{tmp_path}/cache", docs(spark, ["a text"])
    count_tokens(some, cache)
    spark.read.parquet(cache).write.mode("append").partitionBy("version").parquet(f"{tmp_path}/cache2")
    spark.read.parquet(cache).write.mode("append").partitionBy("version").parquet(f"{tmp_path}/cache2")
    assert count_tokens(some, f"{tmp_path}/cache2").count() == 2


def test_hot_texts_and_empty_tables(spark):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, F.lit("the same")).otherwise(
        F.concat(F.lit("text "), "id")).alias("text"))
    assert count_tokens(hot).where("n_tokens > 0").count() == 3000
    assert count_tokens(hot.limit(0)).count() == 0
