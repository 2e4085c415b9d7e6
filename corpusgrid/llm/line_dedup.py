"""Removal of lines that many documents share, as keep bitmaps and not as text.

Every row is split at ``\\n``. The key of a line is the line without ASCII white
space at both ends and with A-Z in lower case. Keys of at least ``min_chars`` code
points found in at least ``min_docs`` documents lose all their lines, except in the
largest ``doc_id`` that holds them.

The method: the 128-bit hashes of the keys are range-partitioned and sorted by
(hash, document, position), documents descending. A hash held by a third of all
rows spans many ranges, since documents are part of the range key. One streaming
pass over a range folds the places of a key inside one document, and one partial
aggregation finds the number of documents and the first occurrence of each key. The
shared keys are written, so the join back has plain exchanges that Spark can split.
What goes back to the documents is a run-length coded bitmap: the runs of lines
that stay. Texts are never shuffled by line.

Defined results: a null or empty text is one empty line and keeps it. Rows with an
equal ``doc_id`` are one document: each keeps or loses its own lines. A null
``doc_id`` counts as one document and is never the largest. Other columns pass
through; a clash with an output name is resolved in favour of the output.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.session import materialise

BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
MIN_CHARS, MIN_DOCS = 40, 5


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def key_of(line: Column) -> Column:
    """``lower`` has a fast path for plain ASCII, where it equals the A-Z mapping."""
    bare = F.btrim(line, F.lit(BLANKS))
    return F.when(F.octet_length(bare) == F.length(bare), F.lower(bare)).otherwise(F.translate(bare, UPPER, LOWER))


def occurrences(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row per line that is long enough: key hash, document, row tag and position.

    The two halves of the hash use different seeds; the row tag tells apart rows that
    share a ``doc_id`` but not their text.
    """
    rows = docs.select("doc_id", F.xxhash64("text").alias("tag"), F.posexplode(lines_of(F.col("text"))).alias("pos", "line"))
    keyed = rows.select("doc_id", "tag", "pos", key_of(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc_id", "tag", "pos")


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, tag, dropped array<int>`` sorted, of the rows that lose a line."""
    found = materialise(occurrences(docs, min_chars), "line-keys")
    order = [F.col("h1"), F.col("h2"), F.col("doc_id").desc()]
    ranged = found.repartitionByRange(*order).sortWithinPartitions(*order, "tag", "pos")
    streamed = materialise(ranged.groupBy("h1", "h2", "doc_id").agg(
        F.collect_list(F.struct("tag", "pos")).alias("places")), "line-ranges")
    keys = materialise(streamed.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("first"))
                       .where(F.col("n") >= min_docs).select("h1", "h2", "first"), "shared-lines")
    lost = (streamed.join(keys, ["h1", "h2"]).where(~F.col("doc_id").eqNullSafe(F.col("first")))
            .select("doc_id", F.explode("places").alias("place")).select("doc_id", "place.tag", "place.pos"))
    return lost.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_set("pos")).alias("dropped"))


def keep_runs(dropped: Column, n_lines: Column) -> Column:
    """The bitmap as ``array<struct<start,len>>``: runs of kept lines between dropped ones."""
    edges = F.concat(F.array(F.lit(-1)), dropped, F.array(n_lines.cast("int")))
    runs = F.transform(F.sequence(F.lit(1), F.size(edges) - 1), lambda i: F.struct(
        (F.get(edges, i - 1) + 1).alias("start"), (F.get(edges, i) - F.get(edges, i - 1) - 1).alias("len")))
    return F.filter(runs, lambda r: r["len"] > 0)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with ``n_lines``, ``n_dropped``, the bitmap ``keep`` (null: all) and ``kept_text``."""
    bitmaps = keep_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs)
    rows, maps = docs.drop("_dropped", "n_lines", "n_dropped", "keep", "kept_text").alias("d"), bitmaps.alias("b")
    joined = rows.join(maps, F.col("d.doc_id").eqNullSafe(F.col("b.doc_id"))
                       & (F.xxhash64("d.text") == F.col("b.tag")), "left").select("d.*", F.col("b.dropped").alias("_dropped"))
    text = F.coalesce(F.col("text"), F.lit(""))
    n_lines = F.length(text) - F.length(F.replace(text, F.lit("\n"))) + 1
    lines = lines_of(F.col("text"))
    counted = joined.withColumns({"n_lines": n_lines.cast("long"),
                                  "n_dropped": F.coalesce(F.size("_dropped"), F.lit(0)).cast("long")})
    kept = counted.withColumn("keep", F.when(F.col("_dropped").isNotNull(), keep_runs(F.col("_dropped"), F.col("n_lines"))))
    return kept.withColumn("kept_text", F.when(F.col("keep").isNull(), text).otherwise(F.array_join(F.flatten(
        F.transform("keep", lambda r: F.slice(lines, r["start"] + 1, r["len"]))), "\n"))).drop("_dropped")
