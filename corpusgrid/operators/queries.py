"""Scored queries over the index tables.

Scores are classic TF-IDF in doubles:

    idf = 1 + ln(N / (df + 1))        clause = sqrt(tf) * idf^2 * boost / sqrt(len)
    query norm = 1 / sqrt(sum((idf * boost)^2)), applied once, outermost
    coord = matched clauses / all clauses

A ``Clause`` answers one query, or a whole table of queries ``(qid, text)`` in
one job. For one query the document frequencies of its terms are looked up when
the clause is made (as many rows as the query has terms, from their buckets), so
that scoring is a single pass over the matching postings without any join. For a
table of queries the weights stay a DataFrame that is joined to the postings.

``ssw`` is what the clause adds to the query norm: a number, or ``(qid, ssw)``
rows; ``hits`` turns the norm (a number, or ``(qid, qnorm)`` rows) into scored
rows ``(qid, key, score)``.
"""

from __future__ import annotations

import math
import operator
import re
from collections import Counter
from collections.abc import Callable
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A
from corpusgrid.functions import filters as flt
from corpusgrid.operators import dictionary
from corpusgrid.operators.index import TextIndex, field_analyzer
from corpusgrid.operators.tables import ROWS, TableHits
from corpusgrid.session import literal_rows, materialise


@dataclass(frozen=True)
class Made:
    """What an explanation tells of a clause: its value is what ``how`` makes of those clauses
    ``of`` it that matched, times its factors. ``coord`` is the number of clauses of which the
    matched share is a factor."""

    how: str
    of: Callable[[], list[Clause]] = list
    factors: Callable[[float, DataFrame], DataFrame] | None = None  # (key, ord, description, value)
    coord: int = 0


@dataclass(frozen=True)
class Clause:
    """``ssw`` is 0 for clauses that score the same whatever is asked."""

    key: str
    hits: Callable[[float | DataFrame], DataFrame]
    ssw: float | DataFrame = 0.0
    marks: tuple = ()  # (index, field, terms as a table made on demand): what a highlight shows
    made: Made = Made("score")

    def raw(self) -> DataFrame:
        """Scored rows with the query norm applied, full precision."""
        return self.hits(self.norm())

    def norm(self) -> float | DataFrame:
        if isinstance(self.ssw, DataFrame):
            return self.ssw.groupBy("qid").agg((1 / F.sqrt(F.sum("ssw"))).alias("qnorm"))
        return 1 / math.sqrt(self.ssw) if self.ssw else 1.0

    def _rounded(self, rows: DataFrame) -> DataFrame:
        return rows.select("qid", self.key, F.round("score", 6).alias("score"))

    def scores(self) -> DataFrame:
        """``(qid, key, score)``, rounded so that summing order cannot show."""
        return self._rounded(self.raw())

    def best(self, size: int) -> DataFrame:
        """The ``size`` best of each query, ties by key; every task keeps its own best first."""
        order = Window.partitionBy("qid").orderBy(F.desc("score"), self.key)
        some = self._rounded(self.hits.within(self.norm(), size)) if isinstance(self.hits, TableHits) and size > 0 else self.scores()
        return some.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= size)


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _factors(*told: tuple[str, Column]) -> Column:
    """Generator of factor rows ``(ord, description, value)``."""
    return F.inline(F.array(*[F.struct(F.lit(i).alias("ord"), F.lit(name).alias("description"), value.cast("double").alias("value"))
                              for i, (name, value) in enumerate(told)]))


def _constant_factor(key: str, name: str, value: float) -> Callable[[float, DataFrame], DataFrame] | None:
    return None if value == 1 else lambda _norm, ids_: ids_.select(key, _factors((name, F.lit(float(value)))))


def _total_ssw(clauses: list[Clause], factor: float = 1.0) -> float | DataFrame:
    tables = [c.ssw for c in clauses if isinstance(c.ssw, DataFrame)]
    if not tables:
        return factor * factor * sum(c.ssw for c in clauses)
    if any(c.ssw for c in clauses if not isinstance(c.ssw, DataFrame)):
        raise ValueError("one query and a table of queries cannot be combined")
    return _union(tables).select("qid", (F.col("ssw") * (factor * factor)).alias("ssw"))


# --- query terms ------------------------------------------------------------

def analyse_query(index: TextIndex, field: str, text: str, analyzer=None) -> list[str]:
    """Terms of one query text; the optimizer folds the one-row plan, no job runs."""
    return [t for t, _ in query_places(index, field, text, analyzer, "search")]


def query_places(index: TextIndex, field: str, text: str, analyzer=None, role: str = "quote") -> list[tuple[str, int]]:
    """``(term, place)`` of one query text; removed words leave their places empty."""
    if text is None:
        raise ValueError("a query needs a value")
    chain = A.placed(field_analyzer(index.analyzers[field], role, analyzer))
    one = literal_rows(index.docs.sparkSession, text=[text])
    return [(r["t"], r["p"]) for r in one.select(chain(F.col("text")).alias("t")).first()["t"]]


def query_terms(index: TextIndex, field: str, texts: DataFrame, analyzer=None) -> DataFrame:
    """``(qid, ord, term)`` for a table of queries ``(qid, text)``."""
    chain = field_analyzer(index.analyzers[field], "search", analyzer)
    return (texts.select("qid", F.posexplode_outer(A.terms(chain(F.col("text")))).alias("ord", "term"))
            .filter("term is not null"))


def _idf(index: TextIndex, df: Column) -> Column:
    return 1 + F.log(F.lit(float(index.n_docs)) / (F.coalesce(df, F.lit(0)) + 1))


def _idfs(index: TextIndex, field: str, terms: list[str]) -> dict[str, float]:
    """idf of the terms of one query; a term absent from the vocabulary has df 0."""
    found = index.words(field, sorted(set(terms))).select("term", "df").collect()
    df = {r["term"]: r["df"] for r in found}
    return {t: 1 + math.log(index.n_docs / (df.get(t, 0) + 1)) for t in terms}


def _by_term(values: dict[str, float]) -> Column:
    """Number that belongs to the row's term."""
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("term"))


def _one_query(index: TextIndex, field: str, terms: list[str], boosts: list[float],
               need: int = 1, coord: bool = True, idf: dict[str, float] | None = None) -> Clause:
    """Sum of term scores for one query; at least ``need`` clauses must match."""
    idf = idf or _idfs(index, field, terms)
    ssw = sum((idf[t] * b) ** 2 for t, b in zip(terms, boosts))
    uses = Counter(terms)

    def hits(qnorm: float) -> DataFrame:
        coef: dict[str, float] = dict.fromkeys(uses, 0.0)
        for t, b in zip(terms, boosts):
            coef[t] += idf[t] ** 2 * b * qnorm
        part = F.sqrt("tf") / F.sqrt("field_len") * _by_term(coef)
        rows = index.lookup(field, list(uses))
        if len(uses) == 1:
            # one posting per document: nothing to add up
            kept = rows.filter(F.lit(need <= len(terms)))
            return kept.select(F.lit(0).alias("qid"), index.key, part.alias("score"))
        matched = F.count(F.lit(1)) if len(uses) == len(terms) else F.sum(_by_term(dict(uses)))
        sums = rows.groupBy(index.key).agg(F.sum(part).alias("score"), matched.alias("matched"))
        score = F.col("score") * F.col("matched") / len(terms) if coord else F.col("score")
        return sums.filter(F.col("matched") >= need).select(F.lit(0).alias("qid"), index.key, score.alias("score"))

    def factors(qnorm: float, ids_: DataFrame) -> DataFrame:
        rows = index.lookup(field, terms).join(ids_, index.key, "left_semi")
        told = [("tf", F.sqrt("tf")), ("idf squared", F.lit(idf[terms[0]] ** 2)), ("field norm", 1 / F.sqrt("field_len")),
                ("query norm", F.lit(float(qnorm)))]
        return rows.select(index.key, _factors(*told, *([("boost", F.lit(boosts[0]))] if boosts[0] != 1 else [])))

    if len(terms) == 1:
        made = Made(f"{field}:{terms[0]}", factors=factors)
    else:
        made = Made("sum of:", lambda: [_one_query(index, field, [t], [b], idf=idf) for t, b in zip(terms, boosts)],
                    coord=len(terms) if coord else 0)
    return Clause(index.key, hits, ssw, _marks(index, field, list(uses)), made)


def _marks(index: TextIndex, field: str, terms_: list[str]) -> tuple:
    return ((index, field, lambda: literal_rows(index.docs.sparkSession, term=terms_)),)


def _many_queries(index: TextIndex, field: str, qterms: DataFrame, need: Column, coord: bool = True) -> Clause:
    """The same for rows ``(qid, term, boost)``; ``need`` is over ``n_terms``.

    The weighed query terms are written once, so the texts are analysed once; they meet the
    postings document by document (``tables``).
    """
    vocab = index.words(field).select("term", "df")
    weighted = materialise(
        qterms.select("qid", "term", "boost").join(vocab, "term", "left").withColumn("idf", _idf(index, F.col("df")))
        .withColumn("ssw", (F.col("idf") * F.col("boost")) ** 2).drop("df"), "query-terms")
    totals = weighted.groupBy("qid").agg(F.count(F.lit(1)).alias("n_terms"))

    def asked(norm: DataFrame) -> DataFrame:
        coef = F.col("idf") ** 2 * F.col("boost") * F.col("qnorm")
        rows = weighted.join(norm, "qid").groupBy("qid", F.col("term").alias("grp")).agg(
            F.sum(coef).alias("coef"), F.count(F.lit(1)).alias("uses"))
        return rows.join(totals, "qid").withColumn("need", need)

    return Clause(index.key, TableHits(index, field, asked, coord=coord), weighted.select("qid", "ssw"))


def required(n_terms: int, operator_: str, minimum_should_match) -> int:
    """Least number of clauses: a count, a negative count, or a percentage."""
    if operator_ == "and":
        return n_terms
    m = minimum_should_match
    if isinstance(m, str) and m.endswith("%"):
        share = int(m[:-1])
        part = math.floor(n_terms * abs(share) / 100)
        return max(part if share >= 0 else n_terms - part, 1)
    return max(int(m) if int(m) >= 0 else n_terms + int(m), 1)


def _required(operator_: str, minimum_should_match) -> Column:
    """The same as an expression over ``n_terms``."""
    n = F.col("n_terms")
    if operator_ == "and":
        return n
    m = minimum_should_match
    if isinstance(m, str) and m.endswith("%"):
        part = F.floor(n * abs(int(m[:-1])) / 100)
        return F.greatest(part if int(m[:-1]) >= 0 else n - part, F.lit(1))
    return F.greatest(F.lit(int(m)) if int(m) >= 0 else n + int(m), F.lit(1))


# --- full text --------------------------------------------------------------

def match(index: TextIndex, field: str, text: str | DataFrame, operator: str = "or",
          minimum_should_match=1, boost: float = 1.0, analyzer=None, fuzziness=None,
          prefix_length: int = 0, max_expansions: int | None = None) -> Clause:
    """Analysed full-text match of one text, or of a table ``(qid, text)``."""
    if isinstance(text, DataFrame):
        qterms = query_terms(index, field, text, analyzer).withColumn("boost", F.lit(float(boost)))
        if fuzziness is not None:
            return _fuzzy_queries(index, field, qterms, _required(operator, minimum_should_match), fuzziness,
                                  prefix_length, max_expansions, boost)
        return _many_queries(index, field, qterms, _required(operator, minimum_should_match))
    words = analyse_query(index, field, text, analyzer)
    if not words:
        return no_hits(index)
    need = required(len(words), operator, minimum_should_match)
    if fuzziness is not None:
        parts = [fuzzy(index, field, w, fuzziness, prefix_length, max_expansions, boost) for w in words]
        return bool_(should=parts, minimum_should_match=need)
    return _one_query(index, field, words, [float(boost)] * len(words), need)


ALL = "_all"


def anywhere(index: TextIndex, text: str | DataFrame, **options) -> Clause:
    """Query text without a field: a match on the field that ``schema.all_field`` makes of
    the others; options and tables of queries as for ``match``."""
    if ALL not in index.analyzers:
        raise ValueError(f"the index has no field {ALL}")
    return match(index, ALL, text, **options)


def term(index: TextIndex, field: str, value: str, boost: float = 1.0) -> Clause:
    """Exact term, not analysed."""
    return terms(index, field, [value], 1, boost)


def terms(index: TextIndex, field: str, values: list[str], minimum_match=1, boost: float = 1.0) -> Clause:
    if not values or any(v is None for v in values):
        raise ValueError("a term query needs values")
    return _one_query(index, field, list(values), [float(boost)] * len(values),
                      required(len(values), "or", minimum_match))


def multi_match(index: TextIndex, fields: list[str], text: str, use_dis_max: bool = True,
                tie_breaker: float = 0.0, type_: str = "boolean", slop: int = 0, **options) -> Clause:
    """One text on several fields (``"title^2"`` weighs a field)."""
    parts = []
    for spec in fields:
        field, _, weight = spec.partition("^")
        b = float(weight or 1)
        if type_ == "phrase":
            parts.append(match_phrase(index, field, text, slop=slop, boost=b))
        elif type_ == "phrase_prefix":
            parts.append(match_phrase_prefix(index, field, text, slop=slop, boost=b))
        else:
            parts.append(match(index, field, text, boost=b, **options))
    return dis_max(parts, tie_breaker) if use_dis_max else bool_(should=parts)


# --- phrases ----------------------------------------------------------------

def _phrase_freq(slop: int) -> Column:
    """How often a phrase stands in a document, from the ``starts`` that each of its words asks for."""
    if slop == 0:
        return F.size(F.array_distinct(F.reduce("starts", F.col("starts")[0], F.array_intersect))).cast("double")
    anchors = F.array_distinct(F.flatten("starts"))
    spreads = F.transform(anchors, lambda s: F.array_max(F.transform(
        "starts", lambda a: F.coalesce(
            F.array_min(F.filter(a, lambda x: x >= s)), s + F.lit(slop + 1)))) - s)
    return F.aggregate(F.filter(spreads, lambda d: d <= slop), F.lit(0.0), lambda acc, d: acc + 1 / (1 + d))


def _phrase(index: TextIndex, field: str, groups: dict[int, list[str]], slop: int, boost: float,
            tail: tuple[int, DataFrame] | None = None) -> Clause:
    """Terms at their offsets; each offset of the phrase has a group of alternatives.

    ``tail`` is one more group whose alternatives are a table ``(term, df)``.
    """
    if not groups and tail is None:
        return no_hits(index)
    slots = [(at, t) for at, g in groups.items() for t in g]
    idf = _idfs(index, field, [t for _, t in slots]) if slots else {}
    weight = sum(idf[t] for _, t in slots)
    n = len(groups) + (tail is not None)
    if tail is not None:
        weight += tail[1].agg(F.sum(_idf(index, F.col("df")))).first()[0] or 0.0
    if not weight:
        return no_hits(index)
    # places of a term in the phrase, as offsets to take off its positions
    places = {t: F.array(*[F.lit(at) for at, u in slots if u == t]) for t in idf}

    def hits(qnorm: float) -> DataFrame:
        parts = []
        if idf:
            offsets = F.element_at(F.create_map(*[x for t, p in places.items() for x in (F.lit(t), p)]), F.col("term"))
            parts.append(index.lookup(field, list(idf)).select(index.key, "field_len", "positions", F.explode(offsets).alias("ord")))
        if tail is not None:
            parts.append(index.lookup(field).join(tail[1].select("term"), "term").select(
                index.key, "field_len", "positions", F.lit(tail[0]).alias("ord")))
        # start = where the phrase would begin if this occurrence is the one at offset ord
        placed = _union(parts).select(index.key, "field_len", "ord", F.transform("positions", lambda p: p - F.col("ord")).alias("starts"))
        if tail is not None or any(len(g) > 1 for g in groups.values()):
            placed = placed.groupBy(index.key, "ord").agg(
                F.flatten(F.collect_list("starts")).alias("starts"), F.first("field_len").alias("field_len"))
        # at most one row per place of the phrase meets in a document
        docs = placed.groupBy(index.key).agg(
            F.collect_list("starts").alias("starts"), F.first("field_len").alias("field_len")).filter(F.size("starts") == n)
        found = docs.select(index.key, "field_len", _phrase_freq(slop).alias("freq")).filter("freq > 0")
        score = F.sqrt("freq") * (weight ** 2 * boost * qnorm) / F.sqrt("field_len")
        return found.select(F.lit(0).alias("qid"), index.key, score.alias("score"))

    def wanted() -> DataFrame:
        """``(term, ord)``: the words of the phrase and their offsets in it."""
        told = [literal_rows(index.docs.sparkSession, term=[t for _, t in slots], ord=[at for at, _ in slots])] if slots else []
        return _union(told + ([tail[1].select("term", F.lit(tail[0]).cast("long").alias("ord"))] if tail is not None else []))

    marks = ((index, field, lambda: wanted().select("term").distinct(),
              lambda tokens: phrase_places(tokens, index.key, wanted(), n, slop)),)
    words = " ".join(t for _, t in sorted(slots)) + ("*" if tail is not None else "")
    return Clause(index.key, hits, (weight * boost) ** 2, marks, Made(f'{field}:"{words}"'))


def _phrase_slots(index: TextIndex, field: str, texts: DataFrame, analyzer=None) -> DataFrame:
    """``(qid, ord, term)`` of a table of phrases: every term at its distance from the first place."""
    chain = A.placed(field_analyzer(index.analyzers[field], "quote", analyzer))
    words = texts.select("qid", chain(F.col("text")).alias("words"))
    return words.select("qid", F.inline(F.transform("words", lambda w: F.struct(
        (w["p"] - F.col("words")[0]["p"]).cast("long").alias("ord"), w["t"].alias("term"))))).distinct()


def _many_phrases(index: TextIndex, field: str, slots: DataFrame, slop: int, boost: float, tail: DataFrame | None = None) -> Clause:
    """``_phrase`` for rows ``(qid, ord, term)``; ``tail`` has such rows for expanded last places.

    Documents that hold a word for each place are found first, document by document and
    without positions (``tables``); of a query with a word that no document holds, none is.
    Only there are positions looked up, and expanded last words looked for. A group is one
    phrase in one document; alternatives of a place are put together before its places are
    counted.
    """
    n_places = slots.groupBy("qid").agg(F.count_distinct("ord").alias("n"))
    slots = slots.withColumn("expanded", F.lit(False))
    if tail is not None:
        last = slots.groupBy("qid").agg(F.max("ord").alias("ord"))
        slots = slots.join(last, ["qid", "ord"], "left_anti").unionByName(tail.withColumn("expanded", F.lit(True)))
    weighed = materialise(slots.join(n_places, "qid").join(index.words(field).select("term", "df"), "term", "left")
                          .withColumn("idf", _idf(index, F.col("df"))), "phrase-words")
    places = weighed.groupBy("qid", "ord").agg(
        F.sum(F.coalesce("df", F.lit(0))).alias("df"), F.sum("idf").alias("idf"), F.first("n").alias("n"))
    asked = materialise(
        places.groupBy("qid").agg(F.min("df").alias("rarest"), F.sum("idf").alias("weight"),
                                  F.first("n").alias("n"), F.count(F.lit(1)).alias("found"))
        .withColumn("able", (F.col("found") == F.col("n")) & (F.col("rarest") > 0)), "phrases")

    def hits(norm: DataFrame) -> DataFrame:
        able = asked.filter("able")
        words = weighed.join(able.select("qid"), "qid", "left_semi").select("qid", "ord", "term", "expanded")
        fixed, last = words.filter("NOT expanded").drop("expanded"), words.filter("expanded").drop("expanded")

        def whole(_norm) -> DataFrame:
            groups = fixed.groupBy("qid", "ord").agg(F.sort_array(F.collect_set("term")).alias("grp"))
            need = groups.groupBy("qid").agg(F.count(F.lit(1)).cast("double").alias("need"))
            uses = groups.groupBy("qid", "grp").agg(F.count(F.lit(1)).alias("uses"))
            return uses.join(need, "qid").withColumns({"coef": F.lit(1.0), "n_terms": F.col("need")})

        near = TableHits(index, field, whole, coord=False, once=True, scored=False)(norm).select("qid", index.key)
        if tail is not None:  # of a phrase of one place nothing is fixed
            alone = last.join(fixed.select("qid").distinct(), "qid", "left_anti")
            near = near.unionByName(index.lookup(field).join(alone.hint("merge"), "term").select("qid", index.key).distinct())
        near = materialise(near, "phrase-documents")
        wanted = materialise(near.join(fixed, "qid"), "phrase-places")
        postings, columns = index.lookup(field).select("term", index.key, "field_len", "positions"), ["qid", index.key, "ord", "field_len", "positions"]
        rows = postings.join(_few(wanted), ["term", index.key]).select(*columns)
        if tail is not None:
            here = postings.join(_few(near), index.key)
            rows = rows.unionByName(here.join(last.hint("merge"), ["qid", "term"]).select(*columns))
        rows = rows.select("qid", index.key, "ord", "field_len", F.transform("positions", lambda p: p - F.col("ord")).alias("starts"))
        placed = rows.groupBy("qid", index.key, "ord").agg(
            F.flatten(F.collect_list("starts")).alias("starts"), F.first("field_len").alias("field_len"))
        docs = placed.groupBy("qid", index.key).agg(F.collect_list("starts").alias("starts"), F.first("field_len").alias("field_len"))
        told = able.join(norm, "qid").select("qid", "n", (F.col("weight") ** 2 * boost * F.col("qnorm")).alias("coef"))
        found = (docs.join(told, "qid").filter(F.size("starts") == F.col("n"))
                 .withColumn("freq", _phrase_freq(slop)).filter("freq > 0"))
        return found.select("qid", index.key, (F.sqrt("freq") * F.col("coef") / F.sqrt("field_len")).alias("score"))

    return Clause(index.key, hits, asked.select("qid", ((F.col("weight") * boost) ** 2).alias("ssw")))


def _few(rows: DataFrame) -> DataFrame:
    """Written rows, broadcast while there are at most ``ROWS``."""
    return F.broadcast(rows) if rows.limit(ROWS + 1).count() <= ROWS else rows


def phrase_places(tokens: DataFrame, key: str, wanted: DataFrame, n: int, slop: int) -> DataFrame:
    """The tokens ``(key, term, pos, start, end)`` of a page that make up a phrase of ``n`` words.

    A token at offset ord would begin the phrase at ``pos - ord``; a beginning counts where
    every word has a token that begins there or up to ``slop`` places later.
    """
    found = tokens.join(wanted, "term").withColumn("at", F.col("pos") - F.col("ord"))
    first = found.select(key, F.col("at").alias("begin")).distinct()
    near = found.join(first, key).filter(F.col("at").between(F.col("begin"), F.col("begin") + slop))
    chosen = near.groupBy(key, "begin", "ord").agg(F.min("at").alias("at"))
    whole = chosen.groupBy(key, "begin").agg(F.count(F.lit(1)).alias("words")).filter(F.col("words") == n)
    kept = chosen.join(whole, [key, "begin"]).select(key, "ord", "at").distinct()
    return found.join(kept, [key, "ord", "at"], "left_semi")


def _offsets(places: list[tuple[str, int]]) -> dict[int, list[str]]:
    """Terms by their distance from the first place; several at one place are alternatives."""
    groups: dict[int, list[str]] = {}
    for term_, at in places:
        group = groups.setdefault(at - places[0][1], [])
        if term_ not in group:
            group.append(term_)
    return groups


def match_phrase(index: TextIndex, field: str, text: str | DataFrame, slop: int = 0, boost: float = 1.0,
                 analyzer=None) -> Clause:
    """All terms in order, of one text or of each of a table ``(qid, text)``; ``slop`` is the
    total displacement allowed.

    The text goes through the field's quote analyzer. Words that it removes keep
    their places, in the query as in the stored text.
    """
    if isinstance(text, DataFrame):
        return _many_phrases(index, field, _phrase_slots(index, field, text, analyzer), slop, float(boost))
    return _phrase(index, field, _offsets(query_places(index, field, text, analyzer)), slop, boost)


def match_phrase_prefix(index: TextIndex, field: str, text: str | DataFrame, max_expansions: int | None = None,
                        slop: int = 0, boost: float = 1.0, analyzer=None) -> Clause:
    """Phrase whose last word is a prefix, expanded over the vocabulary; a table gives many phrases.

    The expansions stay a table; ``max_expansions`` cuts them only if it is given.
    """
    if isinstance(text, DataFrame):
        slots = materialise(_phrase_slots(index, field, text, analyzer), "phrase-slots")
        return _many_phrases(index, field, slots, slop, float(boost), _expanded_tails(index, field, slots, max_expansions))
    groups = _offsets(query_places(index, field, text, analyzer))
    if not groups:
        return no_hits(index)
    last = max(groups)
    starts = [F.col("term").startswith(t) for t in groups.pop(last)]
    found = index.words(field).filter(reduce(operator.or_, starts)).select("term", "df")
    if max_expansions is not None:
        found = found.orderBy("term").limit(max_expansions)
    return _phrase(index, field, groups, slop, boost, (last, found))


def _expanded_tails(index: TextIndex, field: str, slots: DataFrame, max_expansions: int | None) -> DataFrame:
    """``(qid, ord, term)``: the terms that begin as the last words of phrases do.

    All beginnings of the vocabulary's terms meet the words in an equi-join.
    """
    last = slots.groupBy("qid").agg(F.max("ord").alias("ord"))
    starts = slots.join(last, ["qid", "ord"]).withColumnRenamed("term", "start")
    begun = index.words(field).select("term", F.explode(F.sequence(F.lit(1), F.length("term"))).alias("size")).select(
        "term", F.substr("term", F.lit(1), F.col("size")).alias("start"))
    found = begun.join(starts, "start").select("qid", "ord", "term").distinct()
    if max_expansions is not None:
        order = Window.partitionBy("qid").orderBy("term")
        found = found.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= max_expansions).drop("place")
    return found


# --- multi-term queries -----------------------------------------------------

def no_hits(index: TextIndex) -> Clause:
    """What a query text without terms finds."""
    return _constant(index.key, index.docs.select(index.key).filter(F.lit(False)), 1.0)


def _constant(key: str, rows: DataFrame, boost: float) -> Clause:
    scored = rows.select(F.lit(0).alias("qid"), key, F.lit(float(boost)).alias("score"))
    return Clause(key, lambda _norm: scored, made=Made("constant"))


def _vocab_match(index: TextIndex, field: str, test: Column, boost: float) -> Clause:
    """Documents holding any term that passes ``test``; the test is pushed into
    the postings scan, no vocabulary join is needed."""
    docs = index.lookup(field).filter(test).select(index.key).distinct()
    marks = ((index, field, lambda: index.words(field).filter(test).select("term")),)
    return replace(_constant(index.key, docs, boost), marks=marks)


def prefix(index: TextIndex, field: str, start: str, boost: float = 1.0) -> Clause:
    if start is None:
        raise ValueError("a prefix query needs a value")
    return _vocab_match(index, field, F.col("term").startswith(start), boost)


def glob_regex(pattern: str) -> str:
    """``?`` is one character and ``*`` any run."""
    return "^" + "".join({"?": ".", "*": ".*"}.get(c, re.escape(c)) for c in pattern) + "$"


def wildcard(index: TextIndex, field: str, pattern: str, boost: float = 1.0) -> Clause:
    if pattern is None:
        raise ValueError("a wildcard query needs a value")
    test = F.col("term").rlike(glob_regex(pattern))
    start = re.match(r"[^?*]*", pattern)[0]
    if start:  # the terms are sorted, so the scan skips those before and after
        return _vocab_match(index, field, F.col("term").startswith(start) & test, boost)
    found = dictionary.pattern_terms(index.grams, index.words(field), field, pattern, test, index.n_buckets)
    return _of_terms(index, field, materialise(found, "pattern-terms"), boost)


FEW_TERMS = 1000


def _of_terms(index: TextIndex, field: str, found: DataFrame, boost: float) -> Clause:
    """Documents holding any term of a written table: up to ``FEW_TERMS`` are looked up in
    their buckets, more are joined."""
    some = [r["term"] for r in found.limit(FEW_TERMS + 1).collect()]
    if len(some) <= FEW_TERMS:
        rows = index.lookup(field, some) if some else index.lookup(field).filter(F.lit(False))
    else:
        rows = index.lookup(field).join(found, "term", "left_semi")
    return replace(_constant(index.key, rows.select(index.key).distinct(), boost), marks=((index, field, lambda: found),))


def max_edits(value: str, min_similarity: float) -> int:
    """Below 1 a share of the term length, from 1 an edit count."""
    return math.floor((1 - min_similarity) * len(value)) if min_similarity < 1 else int(min_similarity)


def fuzzy_terms(index: TextIndex, field: str, value: str, min_similarity: float = 0.5,
                prefix_length: int = 0, max_expansions: int | None = None) -> DataFrame:
    """Vocabulary terms within the edit distance; the nearest ones if their number is limited.

    One word is looked up in the stored deletions of the index where they have been made
    (``index.deletions`` makes them), else the terms of
    fitting lengths are tested.
    """
    k = max_edits(value, min_similarity)
    head = F.col("term").startswith(value[:prefix_length]) if prefix_length else F.lit(True)
    if k <= dictionary.MOST and index.has_deletions:
        pairs = dictionary.near_word(index.deletions, field, value, k, index.n_buckets).filter(head)
        near = pairs.join(index.words(field).select("term", "df"), "term").select("term", "edits", "df")
    else:
        words = index.words(field).filter(F.length("term").between(len(value) - k, len(value) + k)).filter(head)
        near = words.withColumn("edits", F.levenshtein(F.col("term"), F.lit(value), k)).filter("edits >= 0")
        near = near.select("term", "edits", "df")
    return near if max_expansions is None else near.orderBy("edits", "term").limit(max_expansions)


def fuzzy(index: TextIndex, field: str, value: str, min_similarity: float = 0.5, prefix_length: int = 0,
          max_expansions: int | None = None, boost: float = 1.0) -> Clause:
    """Score of the nearest terms, each weighed by 1 - edits / length; no coord.

    The expansions stay a table that is joined to the postings.
    """
    if value is None:
        raise ValueError("a fuzzy query needs a value")
    near = fuzzy_terms(index, field, value, min_similarity, prefix_length, max_expansions)
    share = (1 - F.col("edits") / max(len(value), 1)) * float(boost)
    weighted = materialise(near.select("term", share.alias("boost"), _idf(index, F.col("df")).alias("idf")), "expansions")
    ssw = weighted.agg(F.sum((F.col("idf") * F.col("boost")) ** 2)).first()[0] or 0.0

    def hits(qnorm: float) -> DataFrame:
        coef = weighted.select("term", (F.col("idf") ** 2 * F.col("boost") * qnorm).alias("coef"))
        sums = index.lookup(field).join(coef, "term").groupBy(index.key).agg(
            F.sum(F.sqrt("tf") / F.sqrt("field_len") * F.col("coef")).alias("score"))
        return sums.select(F.lit(0).alias("qid"), index.key, "score")

    return Clause(index.key, hits, ssw, ((index, field, lambda: weighted.select("term")),))


# --- like this --------------------------------------------------------------

def pick_like_terms(index: TextIndex, field: str, seeds: DataFrame, min_term_freq: int = 1,
                    max_query_terms: int | None = None, stop_words=(), min_doc_freq: int = 1,
                    max_doc_freq: int | None = None, min_word_len: int = 0, max_word_len: int = 0) -> DataFrame:
    """Terms of each seed text ``(qid, text)`` as ``(qid, term, tf, idf)``.

    Nothing is left out unless the request says so; ``max_query_terms`` keeps
    the best by tf * idf.
    """
    counted = (query_terms(index, field, seeds).groupBy("qid", "term")
               .agg(F.count(F.lit(1)).alias("tf")).filter(F.col("tf") >= min_term_freq))
    if stop_words:
        counted = counted.filter(~F.col("term").isin(list(stop_words)))
    if min_word_len:
        counted = counted.filter(F.length("term") >= min_word_len)
    if max_word_len:
        counted = counted.filter(F.length("term") <= max_word_len)
    known = index.words(field).select("term", "df").filter(F.col("df") >= min_doc_freq)
    if max_doc_freq is not None:
        known = known.filter(F.col("df") <= max_doc_freq)
    rated = counted.join(known, "term").withColumn("idf", _idf(index, F.col("df")))
    if max_query_terms is not None:
        # rounded, so that equal products tie the same way everywhere
        best = Window.partitionBy("qid").orderBy(F.desc(F.round(F.col("tf") * F.col("idf"), 6)), "term")
        rated = rated.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= max_query_terms)
    return rated.select("qid", "term", "tf", "idf")


def more_like_this(index: TextIndex, field: str, seeds: DataFrame, percent_terms_to_match: float = 0.3,
                   boost_terms: float | None = None, boost: float = 1.0, **selection) -> Clause:
    """Documents sharing enough of the best terms of each seed text."""
    picked = pick_like_terms(index, field, seeds, **selection)
    if boost_terms:
        best = F.max(F.col("tf") * F.col("idf")).over(Window.partitionBy("qid"))
        picked = picked.withColumn("boost", F.col("tf") * F.col("idf") / best * (boost_terms * boost))
    else:
        picked = picked.withColumn("boost", F.lit(float(boost)))
    need = F.greatest(F.floor(F.col("n_terms") * percent_terms_to_match), F.lit(1))
    return _many_queries(index, field, picked.select("qid", "term", "boost"), need)


def near_pairs(seeds: DataFrame, words: DataFrame, min_similarity: float, prefix_length: int = 0) -> DataFrame:
    """``(seed, term, edits)`` of vocabulary terms within the edit distance of seed terms.

    A seed that may differ by k edits is cut into k + 1 pieces; one of them must stand
    unchanged in the term, at most k places from its own. So an equi-join on the piece
    loses nothing. Seeds too short for that many pieces meet terms by length.
    """
    size = F.length("seed")
    allowed = (F.floor((1 - F.lit(min_similarity)) * size) if min_similarity < 1 else F.lit(int(min_similarity))).cast("int")
    head = lambda c: F.substring(c, 1, prefix_length) if prefix_length else F.lit("")
    wanted = seeds.select("seed", allowed.alias("allowed"), size.alias("size"), head("seed").alias("head"))
    known = words.select("term", F.length("term").alias("len"), head("term").alias("term_head"))
    k = F.col("allowed")
    cut = (wanted.filter(F.col("size") > k).select("*", F.explode(F.sequence(F.lit(0), k)).alias("i"))
           .withColumn("at", F.floor(F.col("i") * F.col("size") / (k + 1)).cast("int"))
           .withColumn("piece_len", (F.floor((F.col("i") + 1) * F.col("size") / (k + 1)) - F.col("at")).cast("int"))
           .withColumn("piece", F.expr("substring(seed, at + 1, piece_len)")))
    sizes = F.array_sort(F.array_distinct(F.array(*[F.lit(r[0]) for r in cut.select("piece_len").distinct().collect()] or [F.lit(0)])))
    grams = (known.select("*", F.explode(F.filter(sizes, lambda n: (n > 0) & (n <= F.col("len")))).alias("n"))
             .select("*", F.explode(F.expr("sequence(0, len - n)")).alias("place"))
             .withColumn("piece", F.expr("substring(term, place + 1, n)")))
    near_length = F.abs(F.col("len") - F.col("size")) <= k
    by_piece = cut.join(grams, "piece").filter(near_length & (F.abs(F.col("place") - F.col("at")) <= k))
    lengths = F.explode(F.sequence(F.greatest(F.col("size") - k, F.lit(1)), F.col("size") + k)).alias("len")
    by_length = wanted.filter(F.col("size") <= k).select("*", lengths).join(known, "len")
    keep = ["seed", "term", "allowed", "head", "term_head"]
    pairs = by_piece.select(*keep).unionByName(by_length.select(*keep)).filter("head = term_head").distinct()
    return (pairs.withColumn("edits", F.levenshtein("term", "seed")).filter(F.col("edits") <= k)
            .select("seed", "term", "edits"))


def near_seeds(index: TextIndex, field: str, seeds: DataFrame, min_similarity: float, prefix_length: int = 0) -> DataFrame:
    """``near_pairs`` for an index: seeds that may differ by few edits meet the terms with letters left out."""
    size = F.length("seed")
    allowed = F.floor((1 - F.lit(min_similarity)) * size) if min_similarity < 1 else F.lit(int(min_similarity))
    seeds = materialise(seeds.select("seed", allowed.cast("int").alias("allowed")).distinct(), "seeds")
    close = seeds.filter(F.col("allowed") <= dictionary.MOST)
    if index.has_deletions:
        few = dictionary.near_stored(index.deletions, field, close)
    else:
        most = close.agg(F.max("allowed")).first()[0] or 0
        few = dictionary.near_words(index.words(field), close, max(0, most))
    if prefix_length:
        few = few.filter(F.substring("seed", 1, prefix_length) == F.substring("term", 1, prefix_length))
    if 1 <= min_similarity < dictionary.MOST + 1:
        return few
    far = seeds.filter(F.col("allowed") > dictionary.MOST).select("seed")
    return few.unionByName(near_pairs(far, index.words(field), min_similarity, prefix_length))


def _fuzzy_queries(index: TextIndex, field: str, qterms: DataFrame, need: Column, similarity: float,
                   prefix_length: int, max_expansions: int | None, boost: float) -> Clause:
    """A table of queries whose words are widened: what ``fuzzy`` per word in a bool gives for one text."""
    near = near_seeds(index, field, qterms.select(F.col("term").alias("seed")), similarity, prefix_length)
    if max_expansions is not None:
        nearest = Window.partitionBy("seed").orderBy("edits", "term")
        near = near.withColumn("_place", F.row_number().over(nearest)).filter(F.col("_place") <= max_expansions).drop("_place")
    share = (1 - F.col("edits") / F.greatest(F.length("seed"), F.lit(1))) * float(boost)
    known = near.join(index.words(field).select("term", "df"), "term").select(
        "seed", "term", share.alias("boost"), _idf(index, F.col("df")).alias("idf"))
    weighted = materialise(qterms.select("qid", "ord", F.col("term").alias("seed")).join(known, "seed", "left"), "widened")
    totals = weighted.groupBy("qid").agg(F.countDistinct("ord").alias("n_terms"))
    # a query none of whose words is widened finds nothing, and has no norm
    ssw = weighted.groupBy("qid").agg(F.sum((F.col("idf") * F.col("boost")) ** 2).alias("ssw")).filter("ssw > 0")

    members = weighted.filter("term is not null").select(
        F.col("seed").alias("grp"), "term", (F.col("idf") ** 2 * F.col("boost")).alias("weight")).distinct()

    def asked(norm: DataFrame) -> DataFrame:
        rows = weighted.filter("term is not null").groupBy("qid", F.col("seed").alias("grp")).agg(F.count_distinct("ord").alias("uses"))
        rows = rows.join(norm, "qid").withColumn("coef", F.col("qnorm") * F.col("uses")).drop("qnorm")
        return rows.join(totals, "qid").withColumn("need", need)

    return Clause(index.key, TableHits(index, field, asked, members, once=True), ssw)


def fuzzy_like_this(index: TextIndex, field: str, seeds: DataFrame, min_similarity: float = 0.5,
                    prefix_length: int = 0, max_query_terms: int | None = None, ignore_tf: bool = False,
                    boost: float = 1.0) -> Clause:
    """The seed's terms, each widened to vocabulary terms within the edit distance.

    Widening runs once per distinct seed term.
    """
    picked = pick_like_terms(index, field, seeds, max_query_terms=max_query_terms)
    near = near_seeds(index, field, picked.select(F.col("term").alias("seed")), min_similarity, prefix_length)
    strength = (1 - F.col("edits") / F.length("seed")) * (F.lit(1.0) if ignore_tf else F.sqrt("tf")) * boost
    widened = (picked.select("qid", F.col("term").alias("seed"), "tf").join(near, "seed")
               .groupBy("qid", "term").agg(F.max(strength).alias("boost")))
    return _many_queries(index, field, widened, F.lit(1), coord=False)


# --- constant-score clauses -------------------------------------------------

def constant_score(docs: DataFrame, key: str, predicate: Column, boost: float = 1.0) -> Clause:
    """Filter with a fixed score."""
    return _constant(key, docs.filter(predicate), boost)


def match_all(docs: DataFrame, key: str, boost: float = 1.0) -> Clause:
    return _constant(key, docs, boost)


def range_(docs: DataFrame, key: str, field: str, boost: float = 1.0, include_lower: bool = True,
           include_upper: bool = True, **bounds) -> Clause:
    """Range by ``gt/gte/lt/lte`` or ``from_/to`` with the include flags."""
    low, high = bounds.pop("from_", None), bounds.pop("to", None)
    if low is not None:
        if {"gt", "gte"} & bounds.keys():
            raise ValueError("two lower bounds")
        bounds["gte" if include_lower else "gt"] = low
    if high is not None:
        if {"lt", "lte"} & bounds.keys():
            raise ValueError("two upper bounds")
        bounds["lte" if include_upper else "lt"] = high
    return constant_score(docs, key, flt.range_(field, **bounds), boost)


def ids(docs: DataFrame, key: str, values, type_=None, boost: float = 1.0) -> Clause:
    return constant_score(docs, key, flt.ids(values, type_), boost)


def ref_is(docs: DataFrame, key: str, field: str, uids, boost: float = 1.0) -> Clause:
    return constant_score(docs, key, flt.ref_is(field, uids), boost)


def has_child(parents: DataFrame, key: str, children: DataFrame, parent_key: str, boost: float = 1.0) -> Clause:
    """Parents with at least one of the given (already filtered) children."""
    found = children.select(F.col(parent_key).alias(key))
    return _constant(key, parents.join(found, key, "left_semi"), boost)


def has_parent(children: DataFrame, key: str, parents: DataFrame, parent_key: str, parent_id: str,
               boost: float = 1.0) -> Clause:
    """Children whose parent is among the given (already filtered) parents."""
    found = parents.select(F.col(parent_id).alias(parent_key))
    return _constant(key, children.join(found, parent_key, "left_semi"), boost)


def top_children(parents: DataFrame, key: str, child_scores: DataFrame, parent_key: str,
                 score: str = "max") -> Clause:
    """Parents scored by their matching children; exact, so no hit-count factor
    is needed. Partial aggregation takes care of parents with many children."""
    fold = {"max": F.max, "sum": F.sum, "avg": F.avg}[score]
    best = child_scores.groupBy(F.col(parent_key).alias(key)).agg(fold("score").alias("score"))
    scored = parents.select(key).join(best, key).select(F.lit(0).alias("qid"), key, "score")
    return Clause(key, lambda _norm: scored)


def nested(docs: DataFrame, key: str, path: str, score: Callable[[Column], Column],
           predicate: Callable[[Column], Column], score_mode: str = "avg") -> Clause:
    """Per-element match folded inside the row: no explode, no shuffle."""
    hits = F.filter(F.col(path), predicate)
    values = F.transform(hits, lambda e: score(e).cast("double"))
    total = F.aggregate(values, F.lit(0.0), operator.add)
    folded = {"avg": total / F.size(values), "total": total, "max": F.array_max(values),
              "none": F.lit(1.0)}[score_mode]
    scored = docs.filter(F.exists(F.col(path), predicate)).select(
        F.lit(0).alias("qid"), key, folded.alias("score"))
    return Clause(key, lambda _norm: scored)


# --- combinations -----------------------------------------------------------

def boost(clause: Clause, factor: float) -> Clause:
    """Weigh a clause inside a larger query."""
    made = Made("product of:", lambda: [clause], _constant_factor(clause.key, "boost", factor))
    return Clause(clause.key, lambda norm: _times(clause.hits(norm), factor), _total_ssw([clause], factor), clause.marks, made)


def _all_marks(clauses: list[Clause]) -> tuple:
    return tuple(m for c in clauses for m in c.marks)


def _times(rows: DataFrame, factor: float) -> DataFrame:
    return rows.withColumn("score", F.col("score") * float(factor))


def _tagged(rows: DataFrame, key: str, role: str) -> DataFrame:
    return rows.select("qid", key, "score", F.lit(role).alias("role"))


def _of_table(clause: Clause) -> bool:
    """Whether a clause answers a table of queries."""
    return isinstance(clause.ssw, DataFrame)


def _for_queries(rows: DataFrame, key: str, asked: DataFrame) -> DataFrame:
    """Rows that hold for any query, for each query that has that document among ``asked``."""
    return asked.join(rows.drop("qid"), key)


def bool_(must=(), should=(), must_not=(), minimum_should_match: int | None = None,
          disable_coord: bool = False, factor: float = 1.0, docs: DataFrame | None = None) -> Clause:
    """Scores of matching clauses add up, times matched / all scoring clauses.

    One aggregation over the tagged union of the clause results. Without must
    and should clauses every document of ``docs`` not excluded scores 1.
    """
    must, should, must_not = ([c for c in g if c is not None] for g in (must, should, must_not))
    if not must and not should:
        if docs is None:
            raise ValueError("a purely negative query needs the documents")
        must, disable_coord = [match_all(docs, must_not[0].key)], True
    key = (must + should)[0].key
    total = len(must) + len(should)
    least = minimum_should_match if minimum_should_match is not None else (0 if must else 1)
    many = any(_of_table(c) for c in must + should)
    if many and not any(_of_table(c) for c in must) and not all(_of_table(c) for c in should):
        raise ValueError("with a table of queries, a clause that holds for all of them needs a must clause of the table")

    def of_one_table(norm) -> DataFrame:
        """One clause of the table, in must: what holds for all queries is met by document, and excluded before scoring."""
        others = [(c, role) for g, role in ((must, "must"), (should, "should")) for c in g if not _of_table(c)]

        def keep(rows: DataFrame) -> DataFrame:
            for clause in must_not:
                rows = rows.join(clause.raw().select(key).distinct(), key, "left_anti")
            for clause, role in others:
                if role == "must":
                    rows = rows.join(clause.hits(norm).select(key).distinct(), key, "left_semi")
            return rows

        rows = table[0].hits.within(norm, None, keep)
        if others:
            found = _union([_tagged(c.hits(norm), key, role) for c, role in others]).groupBy(key).agg(
                F.sum("score").alias("_score"), F.count(F.lit(1)).alias("_matched"),
                F.count_if(F.col("role") == "must").alias("_must"), F.count_if(F.col("role") == "should").alias("_should"))
            rows = rows.join(found, key, "left").filter(
                (F.coalesce("_must", F.lit(0)) == len(must) - 1) & (F.coalesce("_should", F.lit(0)) >= least))
            matched, score = F.coalesce("_matched", F.lit(0)) + 1, F.col("score") + F.coalesce("_score", F.lit(0.0))
        else:
            matched, score = F.lit(1), F.col("score")
        coord = F.lit(1.0) if disable_coord else matched / total
        return rows.select("qid", key, (score * coord * float(factor)).alias("score"))

    table = [c for c in must + should if _of_table(c)]

    def hits(norm):
        if (len(table) == 1 and any(c is table[0] for c in must) and isinstance(table[0].hits, TableHits)
                and not any(_of_table(c) for c in must_not) and least <= len(should)):
            return of_one_table(norm)
        asked = None
        if many and any(_of_table(c) for c in must):
            asked = reduce(lambda a, b: a.join(b, ["qid", key], "left_semi"),
                           [c.hits(norm).select("qid", key) for c in must if _of_table(c)])

        def rows_of(clause: Clause, role: str) -> DataFrame:
            # an excluded clause never scores, so it is normalised by itself
            rows = clause.raw() if role == "not" else clause.hits(norm)
            if many and not _of_table(clause):
                own = asked if asked is not None else _union([c.hits(norm).select("qid", key) for c in should]).distinct()
                rows = _for_queries(rows, key, own)
            return _tagged(rows, key, role)

        rows = _union([*[rows_of(c, "must") for c in must], *[rows_of(c, "should") for c in should],
                       *[rows_of(c, "not") for c in must_not]])
        scoring = F.col("role") != "not"
        folded = rows.groupBy("qid", key).agg(
            F.sum(F.when(scoring, F.col("score"))).alias("score"),
            F.count_if(scoring).alias("matched"),
            F.count_if(F.col("role") == "must").alias("n_must"),
            F.count_if(F.col("role") == "should").alias("n_should"),
            F.count_if(~scoring).alias("n_not"))
        kept = folded.filter((F.col("n_must") == len(must)) & (F.col("n_should") >= least) & (F.col("n_not") == 0))
        coord = F.lit(1.0) if disable_coord else F.col("matched") / total
        return kept.select("qid", key, (F.col("score") * coord * float(factor)).alias("score"))

    made = Made("sum of:", lambda: must + should, _constant_factor(key, "boost", factor), 0 if disable_coord else total)
    return Clause(key, hits, _total_ssw(must + should, factor), _all_marks(must + should), made)


def not_(clause: Clause, docs: DataFrame) -> Clause:
    """Everything the clause does not match, score 1."""
    rest = docs.join(clause.raw().select(clause.key), clause.key, "left_anti")
    return _constant(clause.key, rest, 1.0)


def dis_max(clauses: list[Clause], tie_breaker: float = 0.0, factor: float = 1.0) -> Clause:
    """Best clause score plus a share of the others."""
    key = clauses[0].key
    if len({_of_table(c) for c in clauses}) > 1:
        raise ValueError("a table of queries and a clause that holds for all of them cannot be compared")

    def hits(norm):
        best = _union([c.hits(norm).select("qid", key, "score") for c in clauses]).groupBy("qid", key).agg(
            F.max("score").alias("best"), F.sum("score").alias("total"))
        score = F.col("best") + (F.col("total") - F.col("best")) * float(tie_breaker)
        return best.select("qid", key, (score * float(factor)).alias("score"))

    how = "max of:" if not tie_breaker else f"max plus {float(tie_breaker)} times the others of:"
    made = Made(how, lambda: list(clauses), _constant_factor(key, "boost", factor))
    return Clause(key, hits, _total_ssw(clauses, factor), _all_marks(clauses), made)


def boosting(positive: Clause, negative: Clause, negative_boost: float) -> Clause:
    """Demote the positive hits that also match the negative query."""
    if _of_table(negative) and not _of_table(positive):
        raise ValueError("a table of negative queries needs a table of positive ones")

    def hits(norm):
        on = ["qid", positive.key] if _of_table(negative) == _of_table(positive) else [positive.key]
        bad = negative.raw().select(*on, F.lit(True).alias("bad"))
        return positive.hits(norm).join(bad, on, "left").select(
            "qid", positive.key,
            (F.col("score") * F.when(F.col("bad"), F.lit(float(negative_boost))).otherwise(1.0)).alias("score"))

    def factors(_norm, ids_):
        rows = ids_.join(negative.raw().select(positive.key), positive.key, "left_semi")
        return rows.select(positive.key, _factors(("negative boost", F.lit(float(negative_boost)))))

    return replace(positive, hits=hits, made=Made("product of:", lambda: [positive], factors))


def custom_boost(clause: Clause, factor: float) -> Clause:
    """Multiply the final score (not part of the query norm)."""
    made = Made("product of:", lambda: [clause], _constant_factor(clause.key, "boost", factor))
    return replace(clause, hits=lambda norm: _times(clause.hits(norm), factor), made=made)


def custom_score(clause: Clause, docs: DataFrame, expression, **params) -> Clause:
    """Score from an expression over document fields and ``_score``."""
    def hits(norm):
        rows = clause.hits(norm).withColumnRenamed("score", "_score").join(docs, clause.key)
        value = flt.script_value(expression, **params).cast("double")
        return rows.select("qid", clause.key, value.alias("score"))
    return replace(clause, hits=hits, made=Made("script over:", lambda: [clause]))


def custom_filters_score(clause: Clause, docs: DataFrame, filters: list[tuple[Column, object]],
                         score_mode: str = "first", max_boost: float | None = None) -> Clause:
    """Boost by the filters a document satisfies.

    Each filter comes with a number or a script Column. ``first`` takes the
    first match; min, max, total, avg and multiply fold all matches.
    """
    def weighed(norm):
        rows = clause.hits(norm).withColumnRenamed("score", "_score").join(docs, clause.key)
        factors = F.array_compact(F.array(*[
            F.when(p, v.cast("double") if isinstance(v, Column) else F.lit(float(v))) for p, v in filters]))
        rows = rows.select("qid", clause.key, "_score", factors.alias("_f"))
        f = F.col("_f")
        total = F.aggregate(f, F.lit(0.0), operator.add)
        folded = {"first": F.get(f, F.lit(0)), "min": F.array_min(f), "max": F.array_max(f),
                  "total": total, "avg": total / F.size(f),
                  "multiply": F.aggregate(f, F.lit(1.0), operator.mul)}[score_mode]
        factor = F.when(F.size(f) == 0, F.lit(1.0)).otherwise(folded)
        if max_boost is not None:
            factor = F.least(factor, F.lit(float(max_boost)))
        return rows.select("qid", clause.key, "_score", factor.alias("_factor"))

    def hits(norm):
        return weighed(norm).select("qid", clause.key, (F.col("_score") * F.col("_factor")).alias("score"))

    def factors(norm, ids_):
        rows = weighed(norm).join(ids_, clause.key, "left_semi")
        return rows.select(clause.key, _factors(("filters", F.col("_factor"))))

    return replace(clause, hits=hits, made=Made("product of:", lambda: [clause], factors))


def filtered(clause: Clause, docs: DataFrame, predicate: Column) -> Clause:
    """Rows of query and filter, score of the query.

    The filter never changes document frequencies. The semi join sits below the
    caller's sort, and AQE broadcasts whichever side turns out small.
    """
    kept = docs.filter(predicate).select(clause.key)
    return replace(clause, hits=lambda norm: clause.hits(norm).join(kept, clause.key, "left_semi"))


def indices(docs: DataFrame, names: list[str], clause: Clause, no_match: Clause | str = "all",
            index_column: str = "_index") -> Clause:
    """One query for documents of the named indices; for the rest another one, ``"all"`` or ``"none"``.

    Both branches take the outer query norm, which both add to.
    """
    named = F.coalesce(F.col(index_column).isin(names), F.lit(False))
    parts = [filtered(clause, docs, named)]
    if no_match == "all":
        parts.append(match_all(docs.filter(~named), clause.key))
    elif isinstance(no_match, Clause):
        parts.append(filtered(no_match, docs, ~named))
    elif no_match != "none":
        raise ValueError("no_match is a clause, 'all' or 'none'")
    return Clause(clause.key, lambda norm: _union([p.hits(norm).select("qid", clause.key, "score") for p in parts]),
                  _total_ssw(parts), _all_marks(parts), Made("sum of:", lambda: parts))


def text_query(index: TextIndex, fields: list[str], required: str = "", optional: str = "",
               prohibited: str = "", phrases: list[str] = (), wildcards: list[str] = (),
               default_operator: str = "or", phrase_slop: int = 0,
               minimum_should_match: int | None = None, use_dis_max: bool = True) -> Clause:
    """Required, optional and prohibited words, phrases and wildcards over
    weighted fields, given as arguments instead of query syntax."""
    def over_fields(make) -> Clause:
        parts = []
        for spec in fields:
            field, _, weight = spec.partition("^")
            parts.append(boost(make(field), float(weight or 1)) if weight else make(field))
        if len(parts) == 1:
            return parts[0]
        return dis_max(parts) if use_dis_max else bool_(should=parts)

    def words(text: str) -> list[Clause]:
        return [over_fields(lambda f, w=w: match(index, f, w)) for w in text.split()]

    must, should, must_not = words(required), words(optional), words(prohibited)
    extra = [over_fields(lambda f, p=p: match_phrase(index, f, p, phrase_slop)) for p in phrases]
    extra += [over_fields(lambda f, p=p: wildcard(index, f, p)) for p in wildcards]
    if default_operator == "and":
        must, should = must + should + extra, []
    else:
        should = should + extra
    return bool_(must, should, must_not, minimum_should_match, docs=index.docs)
