"""Registration, input tables, and the SQL fragments shared by oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.functions import geo
from corpusgrid.operators.elements import ELEMENT, element_rows
from corpusgrid.operators.index import TextIndex, build_index
from corpusgrid.operators.schema import all_field
from corpusgrid.session import spread, table_path
from corpusgrid.sources.domain import as_documents, union_all
from corpusgrid.sources.snapshots import BucketStore

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}
_INDEXES: dict[tuple, TextIndex] = {}
_STORES: dict[tuple, BucketStore] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return register


class Tables:
    """The tables of one folder, as attributes, and documents derived from them."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.dir}/{name}.parquet")

    @property
    def docs(self) -> DataFrame:
        """``documents``, on all cores when it is a single split."""
        return spread(self.documents)

    def text_index(self) -> TextIndex:
        """Stored index of ``documents``; built once per application and folder."""
        return self._index("documents", lambda: self.documents.select(
            "doc_id", "lang", "source", "n_chars", title_column().alias("title"), "text"), "doc_id",
            {"text": TEXT, "title": TEXT, "source": "exact"})

    def words_index(self) -> TextIndex:
        """Stored index of ``documents`` with the text cut at white space."""
        return self._index("words", lambda: self.documents.select("doc_id", "text"), "doc_id", {"text": A.analyzer("whitespace")})

    def all_index(self) -> TextIndex:
        """Stored index of ``documents`` with one field made of language, source and text."""
        return self._index("all", lambda: all_field(self.documents.select("doc_id", "lang", "source", "text"), include=["lang", "source", "text"]),
                           "doc_id", {"_all": TEXT})

    def line_index(self) -> TextIndex:
        """Stored index of the lines of ``documents``, as elements of their document."""
        return self._index("lines", lambda: element_rows(self.documents.select("doc_id", F.transform(
            F.split("text", "\n"), lambda s: F.struct(s.alias("line"), F.length(s).alias("chars"))).alias("lines")), "doc_id", "lines"),
            ELEMENT, {"line": TEXT})

    def _index(self, name, make, key, fields) -> TextIndex:
        memo = (self.spark.sparkContext.applicationId, self.dir, name)
        if memo not in _INDEXES:
            _INDEXES[memo] = build_index(make(), key, fields, name)
        return _INDEXES[memo]

    def stored_docs(self) -> BucketStore:
        """``documents`` in buckets of their id; stored once per application and folder."""
        memo = (self.spark.sparkContext.applicationId, self.dir)
        if memo not in _STORES:
            _STORES[memo] = BucketStore.create(self.documents, table_path(self.spark, "documents"), ["doc_id"])
        return _STORES[memo]

    # -- derived documents
    def people(self) -> DataFrame:
        """Customers and suppliers as two types of two indices."""
        customers = as_documents(self.customer, "customers", "customer", "c_custkey",
                                 F.col("c_nationkey"), customer_version())
        suppliers = as_documents(self.supplier, "suppliers", "supplier", "s_suppkey", F.col("s_nationkey"))
        return union_all([customers, suppliers])

    def customers(self) -> DataFrame:
        return as_documents(self.customer, "customers", "customer", "c_custkey",
                            F.col("c_nationkey"), customer_version())

    def places(self) -> DataFrame:
        return self.customer.select("c_custkey", location().alias("p"))

    def lines(self) -> DataFrame:
        """Documents with their lines as nested objects: ``lines array<struct<chars,words,last>>``.

        Cut from each text in place, so no document is gathered from other rows.
        """
        return self.docs.select("doc_id", F.transform(F.split("text", "\n"), lambda s: F.struct(
            F.length(s).alias("chars"), F.size(A.tok_whitespace(s)).alias("words"),
            F.right(s, F.lit(1)).alias("last"))).alias("lines"))

    def parts(self) -> DataFrame:
        """Parts with multi-valued fields."""
        return self.part.withColumns({"tags": F.array("p_brand", "p_type"),
                                      "words": A.tok_whitespace(F.col("p_name"))})


TEXT = A.custom_analyzer("standard", filters=["lowercase"])


def customer_version() -> Column:
    return 1 + F.col("c_custkey") % 3


def segment() -> Column:
    return F.expr("CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_mktsegment END")


def location() -> Column:
    return geo.point((F.col("c_custkey") * 7) % 180 - 90, (F.col("c_custkey") * 13) % 360 - 180)


def title_column() -> Column:
    """First line of the text."""
    return F.regexp_extract("text", r"^[^\n]*", 0)


def joined(tokens: Column) -> Column:
    """Token array as one text, so that any engine hashes it alike."""
    return F.array_join(A.terms(tokens), "|")


def standard_sql(col: str = "lower(text)") -> str:
    return rf"regexp_extract_all({col}, '[\p{{L}}\p{{N}}]+(?:[.''][\p{{L}}\p{{N}}]+)*')"


def postings_sql(field: str = "text", expression: str | None = None, name: str = "") -> str:
    """CTEs ``tok``, ``post``, ``vocab`` of one analysed field, with a suffix."""
    source = expression or field
    return f"""
    tok{name} AS MATERIALIZED (SELECT doc_id, unnest(t) AS term, generate_subscripts(t, 1) - 1 AS pos, len(t) AS field_len
        FROM (SELECT doc_id, {standard_sql(f'lower({source})')} AS t FROM documents)),
    post{name} AS MATERIALIZED (SELECT doc_id, term, count(*) AS tf, any_value(field_len) AS field_len FROM tok{name} GROUP BY ALL),
    vocab{name} AS (SELECT term, count(*) AS df FROM post{name} GROUP BY term)"""


LINES_SQL = r"""(SELECT doc_id, length(s) AS chars, len(regexp_extract_all(s, '\S+')) AS words, right(s, 1) AS last
    FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS s FROM documents))"""
TITLE_SQL = "regexp_extract(text, '^[^\\n]*')"
N_SQL = "(SELECT count(*)::DOUBLE FROM documents)"


def term_rows(terms: list[str], boosts: list[float] | None = None) -> str:
    boosts = boosts or [1.0] * len(terms)
    return "(VALUES " + ", ".join(f"('{t}', {float(b)}::DOUBLE)" for t, b in zip(terms, boosts)) + ") q(term, boost)"


def leaf_sql(n: int, terms: list[str], need: int = 1, coord: bool = True, name: str = "",
             boosts: list[float] | None = None) -> str:
    """CTEs ``w<n>`` (weights) and ``c<n>`` (doc_id, raw score) of a term clause."""
    factor = f"* count(*) / {len(terms)}" if coord else ""
    return f"""
    w{n} AS (SELECT q.term, q.boost, 1 + ln({N_SQL} / (coalesce(v.df, 0) + 1)) AS idf
        FROM {term_rows(terms, boosts)} LEFT JOIN vocab{name} v ON v.term = q.term),
    c{n} AS (SELECT doc_id, sum(sqrt(tf) / sqrt(field_len) * idf * idf * boost) {factor} AS s
        FROM post{name} JOIN w{n} ON post{name}.term = w{n}.term GROUP BY doc_id HAVING count(*) >= {need})"""


def norm_sql(*leaves: int) -> str:
    total = " + ".join(f"(SELECT sum((idf * boost) * (idf * boost)) FROM w{n})" for n in leaves)
    return f"(1 / sqrt({total}))"
