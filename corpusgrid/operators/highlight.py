"""Snippets with the matched words wrapped in tags."""

from __future__ import annotations

import re
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.operators.index import field_analyzer, term_vector

WORD = r"[\p{L}\p{N}]"


@dataclass(frozen=True)
class HighlightOptions:
    pre_tag: str = "<em>"
    post_tag: str = "</em>"
    encoder: str = "default"
    number_of_fragments: int = 5
    fragment_words: int = 18


def _encode(text: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        text = F.replace(text, F.lit(char), F.lit(entity))
    return text


def _pattern(terms: list[str]) -> str:
    words = "|".join(re.escape(t) for t in sorted(terms, key=len, reverse=True))
    return f"(?iu)(?<!{WORD})({words})(?!{WORD})"


def wrap_terms(text: Column, terms: list[str], options: HighlightOptions = HighlightOptions()) -> Column:
    """Whole text with every matched word tagged, found without regard to case."""
    if options.encoder == "html":
        text = _encode(text)
    tagged = options.pre_tag.replace("$", r"\$") + "$1" + options.post_tag.replace("$", r"\$")
    return F.regexp_replace(text, _pattern(terms), tagged)


def apart(spans: Column) -> Column:
    """Places in order, those that overlap as one; n-grams and synonyms share characters."""
    def add(done: Column, s: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        joins = (F.size(done) > 0) & (F.try_element_at(done, F.lit(-1))["end"] > s["start"])
        return F.when(joins, F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(longer))).otherwise(F.concat(done, F.array(s)))

    return F.aggregate(F.array_sort(spans), F.array().cast("array<struct<start:int,end:int>>"), add)


def wrap_offsets(text: Column, spans: Column, options: HighlightOptions = HighlightOptions()) -> Column:
    """Whole text with stored ``array<struct<start,end>>`` places tagged, for
    fields that were analysed beforehand."""
    encode = _encode if options.encoder == "html" else (lambda c: c)

    def cut(start: Column, end: Column) -> Column:
        return encode(F.substring(text, start + 1, end - start))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    done = F.aggregate(apart(spans), start, lambda acc, s: F.struct(
        F.concat(acc["out"], cut(acc["at"], s["start"]), F.lit(options.pre_tag), cut(s["start"], s["end"]),
                 F.lit(options.post_tag)).alias("out"), s["end"].alias("at")))
    return F.concat(done["out"], cut(done["at"], F.length(text)))


def fragments(text: Column, terms: list[str], options: HighlightOptions = HighlightOptions()) -> Column:
    """Array of tagged fragments: runs of words that hold a match, in text order.

    A fragment count of 0 means the whole field as one fragment.
    """
    if options.number_of_fragments == 0:
        pieces = F.array(text)
    else:
        pieces = F.regexp_extract_all(text, F.lit(r"(?:\S+\s*){1,%d}" % options.fragment_words), F.lit(0))
        pieces = F.transform(pieces, lambda p: F.trim(p))
    found = F.filter(pieces, lambda p: p.rlike(_pattern(terms)))
    if options.number_of_fragments:
        found = F.slice(found, 1, options.number_of_fragments)
    return F.transform(found, lambda p: wrap_terms(p, terms, options))


#: Stand-ins for the tags while a text is cut into fragments; private code points.
OPEN, SHUT = "\ue000", "\ue001"


def cut_marked(marked: Column, options: HighlightOptions) -> Column:
    """Fragments of a text whose matches stand between the stand-ins."""
    if options.number_of_fragments == 0:
        pieces = F.array(marked)
    else:
        pieces = F.regexp_extract_all(marked, F.lit(r"(?:\S+\s*){1,%d}" % options.fragment_words), F.lit(0))
        pieces = F.transform(pieces, lambda p: F.trim(p))
    found = F.filter(pieces, lambda p: F.contains(p, F.lit(OPEN)))
    if options.number_of_fragments:
        found = F.slice(found, 1, options.number_of_fragments)
    return F.transform(found, lambda p: F.replace(F.replace(p, F.lit(OPEN), F.lit(options.pre_tag)), F.lit(SHUT), F.lit(options.post_tag)))


def highlight_marks(hits: DataFrame, key: str, marks: tuple, fields: dict, settings: dict | None = None) -> DataFrame:
    """``highlight`` from the marks of a query: what its clauses matched, expansions too.

    A hit's text goes through the field's analyzer with offsets; what a marked term comes
    from is tagged, and of a phrase only the places where it stands. Terms and marks meet
    in a join, so a prefix may expand to any number of terms. Only the hits are looked at.
    """
    if settings and "fields" in settings:
        raise ValueError("the field list is not a global setting")
    base, out, entries = HighlightOptions(**(settings or {})), hits, []
    for n, (name, own) in enumerate(fields.items()):
        options, parts = replace(base, **(own or {})), [m for m in marks if m[1] == name]
        if not parts:
            continue
        tokens = term_vector(hits, key, name, field_analyzer(parts[0][0].analyzers[name]))
        shown = [places(tokens) for _, _, _, *rest in parts for places in rest]
        wanted = [make() for _, _, make, *rest in parts if not rest]
        if wanted:
            shown.append(tokens.join(reduce(DataFrame.unionByName, wanted).distinct(), "term", "left_semi"))
        spans = (reduce(DataFrame.unionByName, [t.select(key, "start", "end") for t in shown]).groupBy(key)
                 .agg(F.collect_set(F.struct("start", "end")).alias(f"_spans{n}")))
        stand_ins = replace(options, pre_tag=OPEN, post_tag=SHUT)
        out = out.join(spans, key, "left")
        marked = wrap_offsets(F.col(name), F.col(f"_spans{n}"), stand_ins)
        pieces = F.when(F.col(f"_spans{n}").isNotNull(), cut_marked(marked, options)).otherwise(F.array().cast("array<string>"))
        entries += [F.lit(name), pieces]
    empty = F.create_map().cast("map<string,array<string>>")
    shown = F.map_filter(F.create_map(*entries), lambda _k, v: F.size(v) > 0) if entries else empty
    return out.withColumn("highlight", shown).select(*hits.columns, "highlight")


def highlight(hits: DataFrame, terms: list[str], fields: dict, settings: dict | None = None) -> DataFrame:
    """Add ``highlight: map<field, array<string>>``.

    ``fields`` maps a field to its own settings, which override the global ones.
    """
    if settings and "fields" in settings:
        raise ValueError("the field list is not a global setting")
    base = HighlightOptions(**(settings or {}))
    entries = []
    for name, own in fields.items():
        entries += [F.lit(name), fragments(F.col(name), terms, replace(base, **(own or {})))]
    return hits.withColumn("highlight", F.map_filter(F.create_map(*entries), lambda _k, v: F.size(v) > 0))
