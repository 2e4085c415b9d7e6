"""Inverted index as tables: postings, vocabulary, document count.

``postings(field, term, <key>, tf, field_len, positions)`` has one row per term
and document. It is built without a shuffle: each document's tokens are sorted
and cut into runs inside its own row. The stored form is partitioned by a hash
bucket of the term, so a query with known terms reads only their buckets.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.functions.offsets import with_tokens
from corpusgrid.operators import dictionary
from corpusgrid.session import spread, table_path


def term_bucket(term: Column, n_buckets: int) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(n_buckets)).cast("int")


def token_rows(df: DataFrame, tokens: Column, name: str, *keep: str) -> DataFrame:
    """One row per token.

    The outer form keeps the optimizer from adding a non-empty check, which it
    would push below the tokenizer and so run that twice.
    """
    return df.select(*keep, F.explode_outer(tokens).alias(name)).filter(F.col(name).isNotNull())


def _runs(s: str, term: str) -> str:
    """Places (from 1) in the sorted array ``s`` where a new term begins."""
    return f"filter(sequence(1, greatest(size({s}), 1)), i -> i <= size({s}) and (i = 1 or {s}[i-1]{term} <> {s}[i-2]{term}))"


def _entries(field: str, s: str, b: str, term: str) -> str:
    """One struct per run: the slice of the sorted array up to the next run."""
    length = f"coalesce(get({b}, k+1), size({s})+1) - b"
    places = f", transform(slice({s}, b, {length}), x -> x.p) as positions" if term else ""
    return f"""transform({b}, (b, k) -> struct('{field}' as field, {s}[b-1]{term} as term, {length} as tf,
        size({s}) as field_len{places}))"""


def field_analyzer(spec, role: str = "index", query=None):
    """The chain of a field for one role."""
    named = {r: A.tok_keyword if c == "exact" else c for r, c in A.roles(spec).items()}
    return A.pick_analyzer(role, query=query, **named)


def build_postings(df: DataFrame, key: str, fields: dict, positions: bool = True) -> DataFrame:
    """Postings of several fields, in one pass over the documents.

    ``fields`` maps a column to its analyzer, to a mapping of analyzers by role
    (``index``, ``search``, ``quote``), to ``"exact"`` for one untouched term per
    value, or to ``None`` for a field that is not searchable. Tokens made of one
    token share its position. Without ``positions`` only plain terms are sorted.
    """
    searched = {f: a for f, a in fields.items() if a is not None}
    if not searched:
        raise ValueError("no searchable field")
    names = {f: f"_f{i}" for i, f in enumerate(searched)}
    term = ".t" if positions else ""

    def tokens(field: str) -> Column:
        chain = field_analyzer(searched[field])
        value = F.col(field).cast("string")
        out = A.placed(chain)(value) if positions else A.terms(chain(value))
        return F.coalesce(out, F.array().cast(A.PLACED if positions else A.NO_TOKENS)).alias(names[field])

    def ordered(field: str) -> Column:
        return F.sort_array(names[field]).alias(names[field])

    out = (df.select(key, *[tokens(f) for f in searched])
           .select(key, *[ordered(f) for f in searched])
           .select("*", *[F.expr(_runs(n, term)).alias(f"{n}_b") for n in names.values()])
           .select(key, F.concat(*[F.expr(_entries(f, n, f"{n}_b", term)) for f, n in names.items()]).alias("entries"))
           # outer for the reason given in ``token_rows``
           .select(key, F.inline_outer("entries")).filter("term is not null"))
    return out.select("field", "term", key, "tf", "field_len", *(["positions"] if positions else []))


def term_stats(postings: DataFrame) -> DataFrame:
    """Vocabulary with document and collection frequency; partial counts first."""
    return postings.groupBy("field", "term").agg(
        F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))


def field_stats(postings: DataFrame, key: str) -> DataFrame:
    """Documents with a value, tokens and average length per field."""
    return postings.groupBy("field").agg(
        F.countDistinct(key).alias("n_docs"), F.sum("tf").alias("n_tokens"),
    ).withColumn("avg_len", F.col("n_tokens") / F.col("n_docs"))


@dataclass(frozen=True)
class TextIndex:
    """Postings and vocabulary tables plus what is needed to search them."""

    key: str
    postings: DataFrame
    vocab: DataFrame
    n_docs: int
    n_buckets: int
    analyzers: dict
    docs: DataFrame

    @cached_property
    def grams(self) -> DataFrame:
        """Pieces of the terms, stored when first needed."""
        return dictionary.gram_table(self.vocab, self.n_buckets)

    @cached_property
    def deletions(self) -> DataFrame:
        """Terms with letters left out, stored when first needed."""
        return dictionary.deletion_table(self.vocab, self.n_buckets)

    @property
    def has_deletions(self) -> bool:
        return "deletions" in self.__dict__

    def lookup(self, field: str, terms: list[str] | None = None) -> DataFrame:
        """Postings of a field, cut down to the buckets of known terms."""
        return self._cut(self.postings, field, terms)

    def words(self, field: str, terms: list[str] | None = None) -> DataFrame:
        return self._cut(self.vocab, field, terms)

    def _cut(self, table: DataFrame, field: str, terms: list[str] | None) -> DataFrame:
        out = table.filter(F.col("field") == field)
        if terms is None:
            return out
        # literals on both sides: folded before the scan is planned
        buckets = [term_bucket(F.lit(t), self.n_buckets) for t in terms]
        return out.filter(F.col("bucket").isin(buckets) & F.col("term").isin(terms))


def write_index(df: DataFrame, key: str, fields: dict, path: str, n_buckets: int | None = None) -> None:
    """Build and store the index.

    Rows are rebalanced by term bucket: AQE splits a bucket that outgrows the
    advisory size (a term found in every document) and merges small ones.
    """
    spark = df.sparkSession
    if n_buckets is None:
        n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    postings = build_postings(spread(df), key, fields).withColumn("bucket", term_bucket(F.col("term"), n_buckets))
    (postings.hint("rebalance", "bucket").sortWithinPartitions("bucket", "field", "term")
        .write.partitionBy("bucket").parquet(f"{path}/postings"))
    stored = spark.read.parquet(f"{path}/postings")
    (stored.groupBy("bucket", "field", "term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf"))
        .hint("rebalance", "bucket").sortWithinPartitions("bucket", "field", "term")
        .write.partitionBy("bucket").parquet(f"{path}/vocab"))
    (df.agg(F.count(F.lit(1)).alias("n_docs")).withColumn("n_buckets", F.lit(n_buckets))
        .write.parquet(f"{path}/meta"))


def open_index(df: DataFrame, key: str, fields: dict, path: str) -> TextIndex:
    spark = df.sparkSession
    meta = spark.read.parquet(f"{path}/meta").first()  # one row
    return TextIndex(key, spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/vocab"),
                     meta["n_docs"], meta["n_buckets"], fields, df)


def build_index(df: DataFrame, key: str, fields: dict, name: str = "index") -> TextIndex:
    """Store an index for ``df`` in the shared folder and open it."""
    path = table_path(df.sparkSession, name)
    write_index(df, key, fields, path)
    return open_index(df, key, fields, path)


def terms_indexed(index: TextIndex, field: str, doc_ids: list, size: int = 20) -> DataFrame:
    """Terms stored for given documents, most frequent first."""
    return (index.lookup(field).filter(F.col(index.key).isin(doc_ids))
            .groupBy("term").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "term").limit(size))


def term_vector(df: DataFrame, key: str, text: str, analyzer=None) -> DataFrame:
    """Per document: terms with position and character offsets in the raw text, by any
    analyzer of the library; all words in lower case by default."""
    chain = analyzer or A.custom_analyzer("standard", filters=["lowercase"])
    tokens = with_tokens(df.select(key, text), text, chain, "_spanned")
    return token_rows(tokens, F.col("_spanned"), "x", key).select(
        key, F.col("x.t").alias("term"), F.col("x.p").alias("pos"), F.col("x.s").alias("start"), F.col("x.e").alias("end"))


# --- work on the vocabulary instead of the text -----------------------------

def map_vocabulary(postings: DataFrame, fn, out: str = "mapped") -> DataFrame:
    """Apply an expensive term function once per distinct term, join it back.

    The partial distinct leaves one row per term and task, so a hot term costs
    nothing extra in the vocabulary; the join is split by AQE when skewed.
    """
    words = postings.select("term").distinct()
    return postings.join(words.withColumn(out, fn(F.col("term"))), "term")


def join_synonyms(tokens: DataFrame, synonyms: DataFrame) -> DataFrame:
    """Expand token rows by a synonym table ``(term, synonym)``, same position.

    A term with rules is replaced by all its synonyms.
    """
    return (tokens.join(synonyms, "term", "left")
            .withColumn("term", F.coalesce("synonym", "term")).drop("synonym"))


def decompound(vocab: DataFrame, words: DataFrame, min_word: int = 1, min_part: int = 1,
               max_part: int | None = None) -> DataFrame:
    """Dictionary parts found inside vocabulary terms: ``(term, part)``.

    Every substring of a distinct term, up to the longest dictionary word, is
    looked up by an equi-join.
    """
    if max_part is None:
        max_part = max(min_part, words.agg(F.max(F.length("word"))).first()[0] or 0)
    long_terms = vocab.select("term").distinct().filter(F.length("term") >= min_word)
    grams = A._grams(F.col("term"), min_part, max_part)
    parts = token_rows(long_terms, F.array_distinct(grams), "part", "term")
    return parts.filter(F.col("part") != F.col("term")).join(words.select(F.col("word").alias("part")), "part", "left_semi")
