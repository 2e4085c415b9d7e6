"""Tables over the vocabulary of an index, for patterns and misspelt words.

``grams``: the pieces of two and three letters of every term, whose ends are marked. The
literal parts of a pattern have pieces of their own; terms holding all of them are found
by their pieces and verified by the pattern, so no posting and no other term is looked at.

``deletions``: every term with up to ``MOST`` letters left out. Two words are within k edits
only if leaving out k letters at most in each gives one and the same string, so near words
meet in an equi-join on it, and are verified. A string is shared by the few terms around
it, however many terms there are.

Both are stored in hash buckets, so a look-up of known pieces reads their buckets. They are
made from the distinct terms when first needed, once for each index. A table of words does
not need the deletions stored: those of all terms are made on the way (``near_words``).
"""

from __future__ import annotations

import re
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.session import materialise, table_path

MOST, BOUND = 2, 1 << 18
START, END = "\x02", "\x03"


def hash_bucket(c: Column, n: int) -> Column:
    return F.pmod(F.xxhash64(c), F.lit(n)).cast("int")


def stored(rows: DataFrame, by: str, n_buckets: int, name: str) -> DataFrame:
    """``rows`` in the shared folder, in buckets of the column ``by``."""
    spark, path = rows.sparkSession, table_path(rows.sparkSession, name)
    (rows.withColumn("bucket", hash_bucket(F.col(by), n_buckets)).hint("rebalance", "bucket")
     .sortWithinPartitions("bucket", "field", by).write.partitionBy("bucket").parquet(path))
    return spark.read.parquet(path)


def at_buckets(table: DataFrame, field: str, by: str, values: list[str], n_buckets: int) -> DataFrame:
    """Rows of known values, from their buckets."""
    buckets = [hash_bucket(F.lit(v), n_buckets) for v in values]
    return table.filter((F.col("field") == field) & F.col("bucket").isin(buckets) & F.col(by).isin(values))


# --- pieces of terms --------------------------------------------------------

def gram_table(vocab: DataFrame, n_buckets: int) -> DataFrame:
    """``field, gram, term`` for all pieces of two and three letters of the marked terms."""
    marked = F.concat(F.lit(START), "term", F.lit(END))

    def pieces_of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.length(marked) - (n - 1)), lambda i: F.substring(marked, i, n))

    pieces = [pieces_of(2), pieces_of(3)]
    rows = vocab.filter(F.length("term") > 0).select("field", "term", F.explode(F.array_distinct(F.concat(*pieces))).alias("gram"))
    return stored(rows, "gram", n_buckets, "grams")


def pattern_grams(pattern: str) -> list[str]:
    """Pieces that a term must have to fit a pattern of ``?`` and ``*``: three letters where there are so many."""
    runs = [r for r in re.split(r"[?*]+", START + pattern + END) if len(r) > 1]
    return sorted({r[i:i + n] for r in runs for n in [min(len(r), 3)] for i in range(len(r) - n + 1)})


def pattern_terms(grams: DataFrame, words: DataFrame, field: str, pattern: str, test: Column, n_buckets: int) -> DataFrame:
    """``term`` of the vocabulary rows that pass ``test``, which is the pattern's.

    A pattern without two letters in a row has no pieces, and is tested on all terms.
    """
    wanted = pattern_grams(pattern)
    if not wanted:
        return words.filter(test).select("term")
    found = at_buckets(grams, field, "gram", wanted, n_buckets)
    return (found.groupBy("term").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") == len(wanted))
            .filter(test).select("term"))


# --- terms with letters left out --------------------------------------------

def left_out(words: DataFrame, word: str, most: int = MOST) -> DataFrame:
    """Adds ``variant, deleted``: the word with 0 to ``most`` letters left out.

    Letters are left out from left to right, so a set of places is met once; words with
    equal letters in a row give a few rows twice.
    """
    own = words.columns
    level = words.select(*own, F.col(word).alias("variant"), F.lit(0).alias("deleted"), F.lit(1).alias("_from"))
    out = level
    for d in range(1, most + 1):
        longer = level.filter(F.length("variant") >= F.col("_from"))
        placed = longer.select(*own, "variant", F.explode(F.expr("sequence(_from, length(variant))")).alias("_from"))
        level = placed.select(*own, F.expr("concat(substring(variant, 1, _from - 1), substring(variant, _from + 1))").alias("variant"),
                              F.lit(d).alias("deleted"), "_from")
        out = out.unionByName(level)
    return out.drop("_from")


def variants_of(word: str, most: int) -> list[str]:
    """The same for one word of a request."""
    return sorted({"".join(word[i] for i in range(len(word)) if i not in gone)
                   for d in range(min(most, len(word)) + 1) for gone in combinations(range(len(word)), d)})


def deletion_table(vocab: DataFrame, n_buckets: int) -> DataFrame:
    """``field, variant, deleted, term`` for the variants of all terms."""
    rows = left_out(vocab.select("field", "term"), "term")
    return stored(rows, "variant", n_buckets, "deletions")


def near_word(deletions: DataFrame, field: str, word: str, k: int, n_buckets: int) -> DataFrame:
    """``term, edits`` within ``k <= MOST`` edits of one word."""
    found = at_buckets(deletions, field, "variant", variants_of(word, k), n_buckets).filter(F.col("deleted") <= k)
    return (found.select("term").distinct().withColumn("edits", F.levenshtein("term", F.lit(word)))
            .filter(F.col("edits") <= k))


def near_words(words: DataFrame, seeds: DataFrame, most: int) -> DataFrame:
    """``seed, term, edits`` for a table ``(seed, allowed)`` with ``allowed <= most``, ``most <= MOST``, from the terms of
    ``words`` themselves.

    Letters are left out of them on the way: the variants of all terms are many times the vocabulary, so they are
    neither written nor shuffled to meet those of the seeds, while these are at most ``BOUND``.
    """
    asked = left_out(seeds.select("seed", "allowed"), "seed", most).filter(F.col("deleted") <= F.col("allowed"))
    asked = materialise(asked.withColumnRenamed("deleted", "own").distinct(), "seed-variants")
    known = left_out(words.select("term").distinct(), "term", most)
    few = asked.limit(BOUND + 1).count() <= BOUND
    return _verified(known.join(F.broadcast(asked) if few else asked, "variant"))


def near_stored(deletions: DataFrame, field: str, seeds: DataFrame) -> DataFrame:
    """The same with the stored variants of all terms."""
    asked = left_out(seeds.select("seed", "allowed"), "seed").filter(F.col("deleted") <= F.col("allowed")).drop("deleted")
    known = deletions.filter(F.col("field") == field).select("variant", "term", "deleted")
    return _verified(asked.join(known, "variant"))


def _verified(pairs: DataFrame) -> DataFrame:
    met = pairs.filter(F.col("deleted") <= F.col("allowed")).select("seed", "allowed", "term").distinct()
    return (met.withColumn("edits", F.levenshtein("term", "seed"))
            .filter(F.col("edits") <= F.col("allowed")).select("seed", "term", "edits"))
