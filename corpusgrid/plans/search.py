"""Search requests: an immutable set of options that turns into DataFrames."""

from __future__ import annotations

import math
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgrid.operators import queries as Q
from corpusgrid.operators import schema
from corpusgrid.operators.explain import explanation
from corpusgrid.operators.highlight import highlight, highlight_marks
from corpusgrid.operators.queries import Clause
from corpusgrid.session import materialise
from corpusgrid.sources.snapshots import BucketStore


@dataclass(frozen=True)
class View:
    """Lazy search over ``docs``. Every setter returns a changed copy."""

    docs: DataFrame
    key: str
    query: Clause | None = None
    filter_: Column | None = None
    post_filter_: Column | None = None
    sort_: tuple = ()
    from__: int = 0
    size_: int = 10
    min_score_: float | None = None
    index_boosts_: dict = field(default_factory=dict)
    routing_: tuple = ()
    track_scores_: bool = False
    columns: tuple | None = None
    store: BucketStore | None = None

    @classmethod
    def of_store(cls, store: BucketStore) -> "View":
        """A view of a stored collection, whose pages read the buckets of their rows only."""
        return cls(store.read(), store.key[0], store=store)

    # -- setters
    def where(self, filter_: Column) -> "View":
        return replace(self, filter_=filter_)

    def matching(self, query: Clause) -> "View":
        return replace(self, query=query)

    def post_filter(self, f: Column) -> "View":
        return replace(self, post_filter_=f)

    def sort(self, *keys) -> "View":
        """Field names, ``"-field"`` for descending, ``"_score"`` or any Column."""
        return replace(self, sort_=keys)

    def page(self, from_: int = 0, size: int = 10) -> "View":
        return replace(self, from__=from_, size_=size)

    def min_score(self, x: float) -> "View":
        return replace(self, min_score_=x)

    def index_boosts(self, boosts: dict) -> "View":
        return replace(self, index_boosts_=boosts)

    def routing(self, *values) -> "View":
        return replace(self, routing_=values)

    def track_scores(self, on: bool = True) -> "View":
        return replace(self, track_scores_=on)

    def select(self, *columns: str) -> "View":
        return replace(self, columns=columns)

    # -- results
    def scope(self) -> DataFrame:
        """Documents left by routing and filter, before any query."""
        docs = self.docs
        if self.routing_:
            docs = docs.filter(F.col("_routing").isin(list(self.routing_)))
        return docs if self.filter_ is None else docs.filter(self.filter_)

    def base(self) -> DataFrame:
        """Documents in scope that match query and filter, with ``_score``.

        No query and no filter matches all; a filter alone scores 1; a query
        with a filter keeps the query's scores.
        """
        if self.query is None:
            scored = self.scope().withColumn("_score", F.lit(1.0))
        else:
            scored = self.scope().join(self._scores(), self.key)
        if self.index_boosts_:
            factor = F.lit(1.0)
            for name, b in self.index_boosts_.items():
                factor = F.when(F.col("_index") == name, F.lit(float(b))).otherwise(factor)
            scored = scored.withColumn("_score", F.round(F.col("_score") * factor, 6))
        if self.min_score_ is not None:
            scored = scored.filter(F.col("_score") >= self.min_score_)
        return scored

    def _scores(self) -> DataFrame:
        return self.query.scores().select(self.key, F.col("score").alias("_score"))

    def matches(self) -> DataFrame:
        """The base after ``post_filter``: what hits are taken from."""
        base = self.base()
        return base if self.post_filter_ is None else base.filter(self.post_filter_)

    def order(self) -> list[Column]:
        """Sort keys, closed by the document key so that ties are stable."""
        keys = []
        for k in self.sort_ or ("_score",):
            if isinstance(k, Column):
                keys.append(k)
            elif k == "_score":
                keys.append(F.desc("_score"))
            elif k.startswith("-"):
                keys.append(F.col(k[1:]).desc_nulls_last())
            else:
                keys.append(F.col(k).asc_nulls_last())
        return [*keys, F.col(self.key)]

    def _page(self, df: DataFrame) -> DataFrame:
        """Top rows of each task, merged; a later page is cut from the global ranking,
        so that no task gathers all the rows before it."""
        if not self.from__:
            return df.orderBy(*self.order()).limit(self.size_)
        last = self.from__ + self.size_
        placed = ranked(df, self.order(), "_place").filter(F.col("_place").between(self.from__ + 1, last))
        return placed.orderBy("_place").drop("_place").limit(self.size_)

    def hits(self) -> DataFrame:
        """One page, in order. Spark keeps the top ``from + size`` of each task
        and merges these, so no full sort runs."""
        if self.query is not None and not self.sort_ and not self.index_boosts_:
            out = self._query_then_fetch()
        else:
            out = self._page(self.matches())
        if self.sort_ and "_score" not in [k for k in self.sort_ if isinstance(k, str)] and not self.track_scores_:
            out = out.withColumn("_score", F.lit(None).cast("double"))
        return out.select(self.key, "_score", *self.columns) if self.columns is not None else out

    def _query_then_fetch(self) -> DataFrame:
        """The page is found on ids and scores alone; only its documents are
        fetched. How the page meets the documents is left to its measured size."""
        scores = self._scores()
        if self.min_score_ is not None:
            scores = scores.filter(F.col("_score") >= self.min_score_)
        kept = self.scope() if self.post_filter_ is None else self.scope().filter(self.post_filter_)
        if self.routing_ or self.filter_ is not None or self.post_filter_ is not None:
            scores = scores.join(kept.select(self.key), self.key, "left_semi")
        page = self._page(scores)
        if self.columns == ():
            return page
        if self.store is not None:
            return self.store.find(page, few=self.size_).orderBy(*self.order()).limit(self.size_)
        return self.docs.join(page, self.key).orderBy(*self.order()).limit(self.size_)

    def fetch(self) -> DataFrame:
        """The same page, found now: its ids (at most ``size``) go into the scan as
        a filter, so that only row groups holding them are read."""
        page = replace(self, columns=()).hits().collect()
        ids = [r[self.key] for r in page]
        scores = F.create_map(*[F.lit(x) for r in page for x in (r[self.key], r["_score"])]) if page else None
        docs = self.docs.filter(F.col(self.key).isin(ids))
        out = docs.withColumn("_score", scores[F.col(self.key)] if page else F.lit(None).cast("double"))
        out = out.orderBy(F.array_position(F.array(*[F.lit(i) for i in ids]), F.col(self.key))) if page else out
        return out.select(self.key, "_score", *self.columns) if self.columns else out

    def highlight(self, terms: list[str] | None, fields: dict, settings: dict | None = None) -> DataFrame:
        """Hits with tagged snippets: of the given words, or of what the query matched."""
        if terms is not None:
            return highlight(self.hits(), terms, fields, settings)
        page = self.hits()
        shown = highlight_marks(page, self.key, self.query.marks, fields, settings)
        return shown.orderBy(*self.order()) if "_score" in page.columns else shown

    def fields(self, *names: str) -> DataFrame:
        """Hits with a list of fields, every value as an array."""
        return schema.fields(self.hits(), list(names), self.key)

    def script_fields(self, scripts: dict, **params) -> DataFrame:
        return schema.script_fields(self.hits(), scripts, **params)

    def source(self, include: list[str] = ("*",), exclude: list[str] = ()) -> DataFrame:
        """Partial hits: nested fields chosen by wildcard paths."""
        return schema.source_filter(self.hits(), include, exclude)

    def first(self) -> DataFrame:
        return replace(self, size_=1).hits()

    def total(self) -> DataFrame:
        return self.matches().agg(F.count(F.lit(1)).alias("total"))

    def max_score(self) -> DataFrame:
        return self.matches().agg(F.max("_score").alias("max_score"))

    def summary(self) -> DataFrame:
        """Total and maximum score in one pass."""
        return self.matches().agg(F.count(F.lit(1)).alias("total"), F.max("_score").alias("max_score"))

    def aggs(self, *metrics: Column) -> DataFrame:
        """Metrics over query and filter, untouched by ``post_filter``; no hits branch."""
        return self.base().agg(*metrics)

    def scan(self) -> DataFrame:
        """Everything, in no order, with score 0."""
        if self.sort_:
            raise ValueError("a scan cannot be sorted")
        return self.matches().withColumn("_score", F.lit(0.0))

    def scroll(self, size: int) -> DataFrame:
        """The full result in sort order with its rank and tranche number.

        Ranks come from a range-partitioned sort: each partition counts its own
        rows, and the few partition totals shift the local ranks. No task sees
        more than one range.
        """
        rows, keys = self.matches(), self.sort_ or ("_score",)
        tranche = F.floor((F.col("rank") - 1) / size).cast("long")
        if any(isinstance(k, Column) for k in keys):
            return ranked(rows, self.order()).withColumn("tranche", tranche)
        # only keys are sorted and written; the documents come back by key
        narrow = list(dict.fromkeys([self.key, *(k.removeprefix("-") for k in keys)]))
        places = ranked(rows.select(*narrow), self.order()).withColumn("tranche", tranche)
        rest = [c for c in rows.columns if c not in narrow]
        return rows.join(places.select(self.key, "rank", "tranche"), self.key) if rest else places

    def slice(self, first: int = 0, length: int | None = None) -> DataFrame:
        """Window of the page; negative positions count from the end. Without a
        length it goes to the end of the page."""
        hits = self.hits()
        if length is None and first >= 0:
            return hits.orderBy(*self.order()).offset(first) if first else hits
        n = hits.count()  # a page, bounded by size
        start = max(n + first, 0) if first < 0 else first
        length = n if length is None else length
        stop = n + length if length < 0 else min(start + length, n)
        if start >= stop:
            return hits.limit(0)
        return hits.orderBy(*self.order()).offset(start).limit(stop - start)

    def delete_by_query(self) -> tuple[DataFrame, DataFrame]:
        """``(kept rows, deletions per index)``; options other than scope, query,
        filter and routing are ignored."""
        doomed = replace(self, sort_=(), min_score_=None, post_filter_=None, index_boosts_={}).base()
        kept = self.docs.join(doomed.select(self.key), self.key, "left_anti")
        by_index = ["_index"] if "_index" in self.docs.columns else []
        return kept, doomed.groupBy(*by_index).agg(F.count(F.lit(1)).alias("deleted"))

    def explain(self) -> DataFrame:
        """Hits with ``explanation``, derived from the query itself: the nodes of its tree,
        see ``operators.explain``. The page is written once and only its rows are explained;
        weights of indices are no part of the query and not shown."""
        page = materialise(self.hits(), "page")
        query = self.query or Q.match_all(self.docs, self.key)
        return page.join(explanation(query, page.select(self.key)), self.key, "left")

    def explain_scores(self, parts: list[tuple[str, Clause]]) -> DataFrame:
        """Hits with ``explanation``: the score and one detail per clause of the query.

        ``parts`` are the clauses whose scores the query adds up. They are computed
        under the norm of the whole query and times the share of them that matched,
        so the details add up to the score. Details are kept for the page only.
        """
        norm = 1 / math.sqrt(self.query.ssw) if self.query.ssw else 1.0
        page = self.hits()
        ids = page.select(self.key)
        rows = None
        for name, clause in parts:
            part = clause.hits(norm).join(ids, self.key, "left_semi").select(self.key, F.struct(
                F.lit(name).alias("description"), F.col("score").alias("value")).alias("detail"))
            rows = part if rows is None else rows.unionByName(part)
        coord = F.size("found") / len(parts)
        details = rows.groupBy(self.key).agg(F.array_sort(F.collect_list("detail")).alias("found")).select(
            self.key, coord.alias("coord"), F.transform("found", lambda d: F.struct(
                d["description"].alias("description"), F.round(d["value"] * coord, 6).alias("value"))).alias("details"))
        return page.join(details, self.key, "left").withColumn("explanation", F.struct(
            F.lit("sum of:").alias("description"), F.col("_score").alias("value"), "coord", "details")).drop("details", "coord")


def ranked(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """Global 1-based rank without a single-partition window.

    The range-partitioned sort is written once, so that the row positions seen by
    the totals and by the ranks are the same.
    """
    numbered = materialise(df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "ranked")
    # the id is (partition << 33) + position inside the partition
    part, position = F.shiftrightunsigned("_at", 33), F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    totals = numbered.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))  # a row per partition
    ahead = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("_part", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_before"))
    return (numbered.withColumn("_part", part).join(F.broadcast(before), "_part")
            .withColumn(name, F.col("_before") + position + 1).drop("_at", "_part", "_before"))


def combine(docs: DataFrame, key: str, query: Clause | None, filter_: Column | None) -> Clause:
    """No query is match_all, a filter alone a constant score, both a filtered query."""
    if query is None:
        return Q.match_all(docs, key) if filter_ is None else Q.constant_score(docs, key, filter_)
    return query if filter_ is None else Q.filtered(query, docs, filter_)


def search(view: View, aggs: dict[str, Column] | None = None) -> dict[str, DataFrame]:
    """Hits, summary and aggregations of one request as lazy DataFrames."""
    out = {"hits": view.hits(), "summary": view.summary()}
    if aggs:
        out["aggs"] = view.aggs(*[m.alias(n) for n, m in aggs.items()])
    return out
