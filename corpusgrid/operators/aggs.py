"""Aggregations over the documents that match a search.

All counts are partial-then-final aggregations; nothing is collected per group.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def terms(df: DataFrame, field: str, size: int | None = 10, many: bool = False,
          facet_filter: Column | None = None) -> DataFrame:
    """Top terms ``(term, count)``; a value of a multi-valued field counts once per row."""
    rows = df if facet_filter is None else df.filter(facet_filter)
    values = F.explode(F.array_distinct(field)) if many else F.col(field)
    counts = (rows.select(values.alias("term")).filter("term is not null")
              .groupBy("term").agg(F.count(F.lit(1)).alias("count")))
    ordered = counts.orderBy(F.desc("count"), "term")
    return counts if size is None else ordered.limit(size)


def terms_facet(df: DataFrame, field: str, size: int = 10, many: bool = False) -> DataFrame:
    """One row: ``total`` values, rows ``missing`` the field, values in ``other``
    terms, and the top ``terms`` as an array. Rolls up the term counts, so the
    input is read once."""
    per_row = F.array_compact(F.col(field) if many else F.array(field))
    counted = (df.select(F.explode_outer(F.array_distinct(per_row)).alias("term"))
               .groupBy("term").agg(F.count(F.lit(1)).alias("count")))
    top = counted.filter("term is not null").orderBy(F.desc("count"), "term").limit(size)
    # at most ``size`` terms, sorted by count down and term up
    listed = top.agg(F.transform(
        F.array_sort(F.collect_list(F.struct((-F.col("count")).alias("neg"), "term"))),
        lambda t: F.struct(t["term"].alias("term"), (-t["neg"]).alias("count")))).scalar()
    sums = counted.agg(
        F.coalesce(F.sum(F.when(F.col("term").isNotNull(), F.col("count"))), F.lit(0)).alias("total"),
        F.coalesce(F.sum(F.when(F.col("term").isNull(), F.col("count"))), F.lit(0)).alias("missing"))
    in_top = F.aggregate("terms", F.lit(0).cast("long"), lambda acc, t: acc + t["count"])
    return sums.withColumn("terms", listed).select(
        "total", "missing", (F.col("total") - in_top).alias("other"), "terms")


def filter_bucket(df: DataFrame, predicate: Column, **metrics: Column) -> DataFrame:
    """Bucket of the documents that match a filter."""
    return df.filter(predicate).agg(F.count(F.lit(1)).alias("doc_count"),
                                    *[m.alias(n) for n, m in metrics.items()])


def nested_buckets(df: DataFrame, levels: list[str], **metrics: Column) -> DataFrame:
    """Buckets inside buckets to any depth in one pass; ``level`` tells the depth."""
    depth = F.lit(len(levels)) - reduce(lambda a, b: a + b, [F.grouping(c).cast("int") for c in levels])
    return (df.rollup(*levels).agg(depth.alias("level"), F.count(F.lit(1)).alias("doc_count"),
                                   *[m.alias(n) for n, m in metrics.items()])
            .filter("level > 0"))


def bucket_tree(df: DataFrame, aggs: dict[str, dict]) -> DataFrame:
    """Buckets of any kind inside buckets of any kind, each level with its own size.

    A spec has one of ``terms`` (a field), ``date_histogram`` (a field, with
    ``interval``) or ``filter`` (a condition); ``size`` keeps the largest buckets of
    each parent (ties by key), ``metrics`` maps names to aggregates, and ``aggs`` holds
    the children. Returns ``path`` (``name=key`` parts, parents first), ``doc_count``
    and ``metrics``. Children only read documents of buckets that were kept.
    """
    def level(rows: DataFrame, specs: dict[str, dict], parents: list[str], trail: list[Column]) -> list[DataFrame]:
        out = []
        for name, spec in specs.items():
            own = f"_bucket{len(parents)}"
            if "terms" in spec:
                key = F.col(spec["terms"]).cast("string")
            elif "date_histogram" in spec:
                key = F.date_trunc(spec["interval"], spec["date_histogram"]).cast("string")
            elif "filter" in spec:
                rows_here, key = rows.filter(spec["filter"]), F.lit("true")
            else:
                raise ValueError(f"bucket '{name}' is of no known kind")
            here = (rows_here if "filter" in spec else rows).withColumn(own, key).filter(F.col(own).isNotNull())
            metrics = [x for m, c in spec.get("metrics", {}).items() for x in (F.lit(m), c.cast("double"))]
            values = F.create_map(*metrics) if metrics else F.create_map().cast("map<string,double>")
            found = here.groupBy(*parents, own).agg(F.count(F.lit(1)).alias("doc_count"), values.alias("metrics"))
            if spec.get("size") is not None:
                order = Window.partitionBy(*parents).orderBy(F.desc("doc_count"), own)
                found = found.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= spec["size"]).drop("_rank")
            steps = [*trail, F.concat(F.lit(f"{name}="), F.col(own))]
            out.append(found.select(F.array(*steps).alias("path"), "doc_count", "metrics"))
            if spec.get("aggs"):
                kept = here
                if spec.get("size") is not None:
                    kept = here.join(found.select(*parents, own), [*parents, own], "left_semi")
                out += level(kept, spec["aggs"], [*parents, own], steps)
        return out

    return reduce(DataFrame.unionByName, level(df, aggs, [], []))


def statistical(df: DataFrame, field: str, by: list[str] = ()) -> DataFrame:
    c = F.col(field).cast("double")
    return df.groupBy(*by).agg(
        F.count(c).alias("count"), F.min(c).alias("min"), F.max(c).alias("max"),
        F.sum(c).alias("total"), F.avg(c).alias("mean"), F.sum(c * c).alias("sum_of_squares"),
        F.var_pop(c).alias("variance"), F.stddev_pop(c).alias("std_deviation"))


def avg(df: DataFrame, field: str, by: list[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(F.avg(field).alias("avg"))


# Calendar intervals of a date histogram.
INTERVALS = {"year", "quarter", "month", "week", "day", "hour", "minute", "second"}


def date_histogram(df: DataFrame, field: str, interval: str, **metrics: Column) -> DataFrame:
    if interval not in INTERVALS:
        raise ValueError(f"unknown interval '{interval}'")
    return df.groupBy(F.date_trunc(interval, F.col(field).cast("timestamp")).alias("bucket")).agg(
        F.count(F.lit(1)).alias("count"), *[m.alias(n) for n, m in metrics.items()])


def filter_facets(df: DataFrame, **facets: Column) -> DataFrame:
    """Counts for many named filters in one pass."""
    return df.agg(*[F.count_if(F.coalesce(p, F.lit(False))).alias(n) for n, p in facets.items()])


def query_facet(hits: DataFrame) -> DataFrame:
    """Number of documents that match a scored query."""
    return hits.agg(F.count(F.lit(1)).alias("count"))


class Aggs:
    """Named metrics evaluated together in one pass over the base."""

    def __init__(self, **metrics: Column):
        self._metrics = dict(metrics)

    def add(self, name: str, metric: Column) -> "Aggs":
        return Aggs(**{**self._metrics, name: metric})

    def remove(self, name: str) -> "Aggs":
        return Aggs(**{k: v for k, v in self._metrics.items() if k != name})

    def get(self, name: str) -> Column:
        return self._metrics[name]

    def run(self, df: DataFrame, by: list[str] = ()) -> DataFrame:
        return df.groupBy(*by).agg(*[m.alias(n) for n, m in self._metrics.items()])
