"""Analysis that keeps character offsets, as Column functions.

``with_tokens`` runs an analyzer on ``array<struct<t,p,s,e>>``: the terms with their place and
the characters of the original text they come from. Tokenizers tell offsets from the
lengths of tokens and of what lies between them, by running sums. Char filters are lists of
replacements; each keeps the stretches it changed, and offsets are taken back through them,
the last one first. Token filters keep the offsets of the token they change, and a filter
that makes several tokens of one gives all of them its offsets.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusgrid.functions import analysis as A

SPANNED = "array<struct<t:string,p:int,s:int,e:int>>"
EDITED = "array<struct<f0:int,f1:int,o0:int,o1:int>>"
EIGHTS = 8  # levels of a running sum: arrays of up to 8^8 items


def running_sum(numbers: Column) -> Column:
    """Sums of an array up to each item, in a pass for every power of eight in its size."""
    def step(d: int) -> Callable[[Column], Column]:
        def add(a: Column) -> Column:
            def of_eight(v: Column, i: Column) -> Column:  # each item has the sum of the d up to it
                for j in range(1, 8):
                    v = v + F.coalesce(F.get(a, i - j * d), F.lit(0))
                return v
            return F.when(F.size(a) > d, F.transform(a, of_eight)).otherwise(a)
        return add

    for k in range(EIGHTS):
        numbers = A._let(numbers, step(8 ** k))
    return numbers


def lengths(texts: Column) -> Column:
    return F.transform(texts, lambda t: F.length(t))


def token(t: Column, s: Column, e: Column) -> Column:
    return F.struct(t.alias("t"), s.cast("int").alias("s"), e.cast("int").alias("e"))


# --- tokenizers -------------------------------------------------------------

def alternating(between: Column, tokens: Column, first_between: bool) -> Column:
    """Tokens with offsets, from all tokens and all texts between them in order."""
    def placed(both: Column) -> Column:
        tokens_, between_ = both["tokens"], both["between"]
        pairs = F.zip_with(lengths(tokens_), F.slice(lengths(between_), 1, F.size(tokens_)), lambda a, b: F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0)))

        def cut(ends: Column) -> Column:
            # ends: of a token with the text before it, or of a token with the text after it
            def at(t: Column, i: Column) -> Column:
                end = F.get(ends, i) if first_between else F.coalesce(F.get(ends, i - 1), F.lit(0)) + F.length(t)
                return token(t, end - F.length(t), end)
            return F.transform(tokens_, at)

        return A._let(running_sum(pairs), cut)
    return A._let(F.struct(tokens.alias("tokens"), between.alias("between")), placed)


def matches(text: Column, pattern: str) -> Column:
    """The matches of a pattern with their offsets."""
    return A._let(text, lambda x: alternating(F.split(x, pattern, -1), F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), True))


def split_tokens(text: Column, pattern: str) -> Column:
    def cut(x: Column) -> Column:
        return alternating(F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), F.split(x, pattern, -1), False)
    return F.filter(A._let(text, cut), lambda x: x["t"] != "")


def gram_spans(text: Column, low: int, high: int) -> Column:
    def cut(x: Column) -> Column:
        def starting_at(i: Column) -> Column:
            return F.transform(F.sequence(F.lit(low), F.least(F.lit(high), F.length(x) - i + 1)),
                               lambda n: token(F.substring(x, i, n), i - 1, i - 1 + n))
        some = F.flatten(F.transform(F.sequence(F.lit(1), F.length(x) - low + 1), starting_at))
        return F.when(F.length(x) >= low, some).otherwise(F.array().cast("array<struct<t:string,s:int,e:int>>"))
    return A._let(text, cut)


def from_start(tokens: Column) -> Column:
    """Offsets of tokens that are beginnings of the text."""
    return F.transform(tokens, lambda t: token(t, F.lit(0), F.length(t)))


def token_spans(tokenizer: A.TextFn, text: Column) -> Column:
    """``array<struct<t,s,e>>`` of a tokenizer of this library."""
    kind, *options = getattr(tokenizer, "offsets", (None,))
    if kind == "matches":
        return matches(text, *options)
    if kind == "lower matches":
        return F.transform(matches(text, *options), lambda x: token(F.lower(x["t"]), x["s"], x["e"]))
    if kind == "split":
        return split_tokens(text, *options)
    if kind == "grams":
        return gram_spans(text, *options)
    if kind == "starts":
        return from_start(tokenizer(text))
    raise ValueError("a tokenizer that does not tell its offsets")


# --- char filters -----------------------------------------------------------

def edited(text: Column, pattern: str, replacement: str) -> Column:
    """The stretches that a replacement changes: where they lie after it, and before."""
    def found(x: Column) -> Column:
        matched, between = F.regexp_extract_all(x, F.lit(pattern), F.lit(0)), F.split(x, pattern, -1)

        def placed(tokens: Column) -> Column:
            return F.transform(tokens, lambda m, k: F.struct(
                (m["s"] - taken(m, k)).alias("f0"), (m["s"] - taken(m, k) + len(replacement)).alias("f1"),
                m["s"].alias("o0"), m["e"].alias("o1")))

        def taken(m: Column, k: Column) -> Column:
            return m["before"] - k * len(replacement)

        def numbered(tokens: Column) -> Column:
            sizes = running_sum(F.transform(tokens, lambda m: m["e"] - m["s"]))
            return A._let(sizes, lambda sums: F.transform(tokens, lambda m, k: F.struct(
                m["s"].alias("s"), m["e"].alias("e"), F.coalesce(F.get(sums, k - 1), F.lit(0)).alias("before"))))

        return A._let(A._let(alternating(between, matched, True), numbered), placed)
    return A._let(text, found).cast(EDITED)


def original(at: Column, edits: Column, end: bool = False) -> Column:
    """The place of a character of the filtered text in the text before, or where it ends there.

    Inside a replacement these are places of what it replaced.
    """
    def moved(before: Column) -> Column:
        x = F.try_element_at(before, F.lit(-1))
        inside = x["o1"] if end else F.least(x["o0"] + at - x["f0"], F.greatest(x["o1"] - 1, x["o0"]))
        return F.when(F.size(before) == 0, at + int(end)).when(at < x["f1"], inside).otherwise(at + x["o1"] - x["f1"] + int(end))
    return A._let(F.filter(edits, lambda x: x["f0"] <= at), moved)


def taken_back(tokens: Column, edits: Column) -> Column:
    """Tokens of a filtered text with offsets in the text before; the last character decides the end."""
    def back(e: Column) -> Column:
        return F.transform(tokens, lambda x: token(
            x["t"], original(x["s"], e), F.greatest(original(x["e"] - 1, e, True), original(x["s"], e))))
    return A._let(edits, back)


# --- analyzers --------------------------------------------------------------

def parts_of(analyzer: A.TextFn) -> tuple[list, A.TextFn, list]:
    """(replacements of the char filters, tokenizer, token filters) of a chain."""
    steps = getattr(analyzer, "steps", [analyzer])
    at = next((i for i, step in enumerate(steps) if hasattr(step, "offsets")), None)
    if at is None:
        raise ValueError("a chain without a tokenizer that tells its offsets")
    return [e for step in steps[:at] for e in step.edits], steps[at], list(steps[at + 1:])


def filtered(tokens: Column, filters: list) -> Column:
    """Places for the tokens of a tokenizer, and the token filters on them."""
    tokens = F.transform(tokens, lambda x, i: F.struct(x["t"].alias("t"), i.cast("int").alias("p"), x["s"].alias("s"), x["e"].alias("e")))
    for step in filters:
        tokens = step_spanned(step)(tokens)
    return F.coalesce(tokens, F.array().cast(SPANNED))


def with_tokens(df: DataFrame, text: str, analyzer: A.TextFn, name: str) -> DataFrame:
    """Adds ``name``: the chain on ``array<struct<t,p,s,e>>`` of the original text.

    Each replacement of a char filter is a projection of its own, as one expression of all
    would be nested too deeply.
    """
    edits, tokenizer, filters = parts_of(analyzer)
    own = [c for c in df.columns if c != name]
    out = df.select(*own, F.col(text).alias("_text"))
    kept = [f"_edit{k}" for k in range(len(edits))]
    for k, (pattern, replacement) in enumerate(edits):
        changed = F.regexp_replace("_text", pattern, re.sub(r"([\\$])", r"\\\1", replacement))
        out = out.select(*own, *kept[:k], edited(F.col("_text"), pattern, replacement).alias(kept[k]), changed.alias("_text"))
    out = out.select(*own, *kept, token_spans(tokenizer, F.col("_text")).alias("_tokens"))
    for k in reversed(range(len(edits))):
        out = out.select(*own, *kept[:k], taken_back(F.col("_tokens"), F.col(kept[k])).alias("_tokens"))
    return out.select(*own, filtered(F.col("_tokens"), filters).alias(name))


def step_spanned(step: A.TextFn) -> A.TextFn:
    def same(x: Column, t: Column) -> Column:
        return F.struct(t.alias("t"), x["p"].alias("p"), x["s"].alias("s"), x["e"].alias("e"))

    if hasattr(step, "each"):
        return lambda tokens: F.filter(F.transform(tokens, lambda x: same(x, step.each(x["t"]))), lambda x: x["t"].isNotNull())
    if hasattr(step, "many"):
        return lambda tokens: F.flatten(F.transform(tokens, lambda x: F.transform(step.many(x["t"]), lambda t: same(x, t))))
    if hasattr(step, "width"):  # terms of several tokens in a row
        n, separator = step.width

        def rows(a: Column) -> Column:
            return F.when(F.size(a) >= n, F.transform(F.sequence(F.lit(1), F.size(a) - n + 1), lambda i: F.struct(
                F.array_join(F.transform(F.slice(a, i, F.lit(n)), lambda x: x["t"]), separator).alias("t"), F.get(a, i - 1)["p"].alias("p"),
                F.get(a, i - 1)["s"].alias("s"), F.get(a, i + (n - 2))["e"].alias("e")))).otherwise(F.array().cast(SPANNED))
        return lambda tokens: A._let(tokens, rows)
    if hasattr(step, "placed"):  # drops tokens by their terms
        return lambda tokens: A._let(tokens, step.placed)
    raise ValueError("a token filter that does not tell where its terms come from")
