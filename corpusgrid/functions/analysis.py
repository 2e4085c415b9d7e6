"""Text analysis as Column functions.

A *char filter* maps a text column to a text column, a *tokenizer* maps text to
``array<string>``, and a *token filter* maps ``array<string>`` to
``array<string>``. A removed token leaves a null behind, so positions (the array
index) keep their gaps; ``terms`` drops the nulls when positions do not matter.

A filter that makes several tokens of one (synonyms, n-grams, word parts) would shift
the index. ``placed`` runs the same chain on ``array<struct<t,p>>``, where all of them
keep the place of the token they come from; the index and phrases use that form.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

TextFn = Callable[[Column], Column]

# --- fixed values -----------------------------------------------------------
# Patterns and word lists that decide which tokens come out.
LETTERS = r"\p{L}+"
WORDS = r"[\p{L}\p{N}]+"
STANDARD = r"[\p{L}\p{N}]+(?:[.'][\p{L}\p{N}]+)*"
EMAIL = r"[\p{L}\p{N}._%+-]+@[\p{L}\p{N}-]+(?:\.[\p{L}\p{N}-]+)+"
URL = r"[a-zA-Z][a-zA-Z0-9+.-]*://[^\s<>\x22]+"
ENGLISH_STOP = (
    "a an and are as at be but by for if in into is it no not of on or such "
    "that the their then there these they this to was will with"
).split()
FRENCH_STOP = (
    "au aux avec ce ces dans de des du elle en et eux il je la le les leur lui "
    "ma mais me mes mon ne nos notre nous on ou par pas pour qu que qui sa se "
    "ses son sur ta te tes ton tu un une vos votre vous"
).split()
GERMAN_STOP = (
    "aber als am an auch auf aus bei bin bis das dass dem den der des die doch "
    "du ein eine einem einen einer er es für hat ich ihr im in ist ja mit nach "
    "nicht noch nur oder sich sie sind so über um und uns von vor war wenn wie "
    "wir zu zum zur"
).split()
SPANISH_STOP = (
    "a al como con de del el ella en es esta este ha la las le lo los más me mi "
    "no nos o para pero por que se si sin sobre su sus te tu un una y ya yo"
).split()
STOP_WORDS = {
    "english": ENGLISH_STOP,
    "french": FRENCH_STOP,
    "german": GERMAN_STOP,
    "spanish": SPANISH_STOP,
}
HTML_ENTITIES = {
    "&lt;": "<",
    "&gt;": ">",
    "&quot;": '"',
    "&#39;": "'",
    "&apos;": "'",
    "&nbsp;": " ",
    "&amp;": "&",
}
FOLD_FROM = "àáâãäåçèéêëìíîïñòóôõöøùúûüýÿÀÁÂÃÄÅÇÈÉÊËÌÍÎÏÑÒÓÔÕÖØÙÚÛÜÝ"
FOLD_TO = "aaaaaaceeeeiiiinoooooouuuuyyAAAAAACEEEEIIIINOOOOOOUUUUY"
FOLD_PAIRS = {"ß": "ss", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE"}
ELISION_ARTICLES = ["l", "m", "t", "qu", "n", "s", "j", "d", "c"]
# Ordered suffix rules (pattern, replacement); the first that fits is applied.
LIGHT_STEM = {
    "french": [(r"(.{2,})eaux$", "$1eau"), (r"(.{3,})aux$", "$1al"), (r"(.{3,})[sx]$", "$1"),
               (r"(.{3,})er$", "$1"), (r"(.{3,})[eé]e?$", "$1")],
    "german": [(r"(.{3,})ern$", "$1"), (r"(.{3,})(?:em|en|er|es)$", "$1"), (r"(.{3,})[ens]$", "$1")],
    "spanish": [(r"(.{3,})eses$", "$1es"), (r"(.{3,})ces$", "$1z"), (r"(.{3,})(?:os|as|es)$", "$1"),
                (r"(.{3,})[oae]$", "$1")],
    "english": [(r"(.+)sses$", "$1ss"), (r"(.{2,})ies$", "$1y"), (r"(.+)ss$", "$1ss"),
                (r"(.{2,})s$", "$1")],
}
# ----------------------------------------------------------------------------


def terms(tokens: Column) -> Column:
    """Tokens without the gaps left by removed ones."""
    return F.array_compact(tokens)


def _told(fn: TextFn, *offsets) -> TextFn:
    """A tokenizer with what ``offsets`` needs to know to place its tokens in the text."""
    fn.offsets = offsets
    return fn


def _extract(pattern: str) -> TextFn:
    return _told(lambda text: F.regexp_extract_all(text, F.lit(pattern), F.lit(0)), "matches", pattern)


def _each(fn: TextFn) -> TextFn:
    def apply(tokens: Column) -> Column:
        return F.transform(tokens, fn)
    apply.each = fn
    return apply


def _let(value: Column, fn: TextFn) -> Column:
    """``fn(value)`` with the value computed once.

    An expression used inside a lambda is evaluated again for every element;
    as a lambda variable it is not.
    """
    return F.get(F.transform(F.array(value), fn), F.lit(0))


def _fan_out(fn: TextFn) -> TextFn:
    """Per-token function that yields an array; gaps yield nothing."""
    def apply(tokens: Column) -> Column:
        return F.flatten(F.transform(terms(tokens), fn))
    apply.many = fn
    return apply


# --- char filters -----------------------------------------------------------

def cf_mapping(mapping: Mapping[str, str]) -> TextFn:
    def apply(text: Column) -> Column:
        for src in sorted(mapping, key=len, reverse=True):
            text = F.replace(text, F.lit(src), F.lit(mapping[src]))
        return text
    apply.edits = [(re.escape(src), mapping[src]) for src in sorted(mapping, key=len, reverse=True)]
    return apply


MARKUP = (r"(?is)<script[^>]*>.*?</script>", r"(?is)<style[^>]*>.*?</style>", r"(?s)<!--.*?-->", r"(?s)<[^>]*>")


def cf_html_strip(text: Column) -> Column:
    """Scripts, styles, comments and tags become a blank; entities are decoded."""
    for pattern in MARKUP:
        text = F.regexp_replace(text, pattern, " ")
    for entity, char in HTML_ENTITIES.items():
        text = F.replace(text, F.lit(entity), F.lit(char))
    return text


cf_html_strip.edits = [*((p, " ") for p in MARKUP), *((re.escape(e), c) for e, c in HTML_ENTITIES.items())]


# --- tokenizers -------------------------------------------------------------

tok_whitespace = _extract(r"\S+")
tok_letter = _extract(LETTERS)
tok_standard = _extract(STANDARD)
tok_uax_url_email = _extract(f"{EMAIL}|{URL}|{STANDARD}")


def tok_lowercase(text: Column) -> Column:
    return tok_letter(F.lower(text))


def tok_keyword(text: Column) -> Column:
    return F.array(text)


_told(tok_lowercase, "lower matches", LETTERS)
_told(tok_keyword, "starts")


def tok_pattern(pattern: str = r"\W+", flags: str = "", group: int = -1) -> TextFn:
    """Split on ``pattern``; with ``group`` >= 0 the matches are the tokens."""
    regex = f"(?{flags}){pattern}" if flags else pattern
    if group >= 0:
        found = lambda text: F.regexp_extract_all(text, F.lit(regex), F.lit(group))
        return found if group else _told(found, "matches", regex)
    return _told(lambda text: F.filter(F.split(text, regex, -1), lambda t: t != ""), "split", regex)


NO_TOKENS = "array<string>"
PLACED = "array<struct<t:string,p:int>>"


def _grams(text: Column, low: int, high: int) -> Column:
    def cut(s: Column) -> Column:
        size = F.length(s)

        def starting_at(i: Column) -> Column:
            return F.transform(F.sequence(F.lit(low), F.least(F.lit(high), size - i + 1)),
                               lambda n: F.substring(s, i, n))

        return F.when(size >= low, F.flatten(
            F.transform(F.sequence(F.lit(1), size - low + 1), starting_at)
        )).otherwise(F.array().cast(NO_TOKENS))
    return _let(text, cut)


def _edge_grams(text: Column, low: int, high: int) -> Column:
    def cut(s: Column) -> Column:
        longest = F.least(F.lit(high), F.length(s))
        return F.when(longest >= low, F.transform(
            F.sequence(F.lit(low), longest), lambda n: F.substring(s, F.lit(1), n)
        )).otherwise(F.array().cast(NO_TOKENS))
    return _let(text, cut)


def tok_ngram(low: int = 1, high: int = 2) -> TextFn:
    return _told(lambda text: _grams(text, low, high), "grams", low, high)


def tok_edge_ngram(low: int = 1, high: int = 1) -> TextFn:
    return _told(lambda text: _edge_grams(text, low, high), "starts")


def tok_path_hierarchy(delimiter: str = "/") -> TextFn:
    def levels(parts: Column) -> Column:
        paths = F.transform(parts, lambda _p, i: F.array_join(F.slice(parts, F.lit(1), i + 1), delimiter))
        return F.filter(paths, lambda t: t != "")
    return _told(lambda text: _let(F.split(text, re.escape(delimiter), -1), levels), "starts")


# --- token filters ----------------------------------------------------------

tf_lowercase = _each(F.lower)
tf_reverse = _each(F.reverse)
tf_trim = _each(lambda t: F.regexp_replace(t, r"^\s+|\s+$", ""))


def tf_stop(words: Iterable[str]) -> TextFn:
    words = list(words)
    return _each(lambda t: F.when(~t.isin(words), t))


def fold(text: Column) -> Column:
    for src, dst in FOLD_PAIRS.items():
        text = F.replace(text, F.lit(src), F.lit(dst))
    return F.translate(text, FOLD_FROM, FOLD_TO)


tf_asciifolding = _each(fold)
tf_icu_folding = _each(lambda t: F.lower(fold(t)))


def tf_length(low: int = 0, high: int = 2**31 - 1) -> TextFn:
    return _each(lambda t: F.when(F.length(t).between(low, high), t))


def tf_ngram(low: int = 1, high: int = 2) -> TextFn:
    return _fan_out(lambda t: _grams(t, low, high))


def tf_edge_ngram(low: int = 1, high: int = 1) -> TextFn:
    return _fan_out(lambda t: _edge_grams(t, low, high))


def tf_shingle(n: int = 2, separator: str = " ") -> TextFn:
    def pairs(t: Column) -> Column:
        return F.when(F.size(t) >= n, F.transform(
            F.sequence(F.lit(1), F.size(t) - n + 1),
            lambda i: F.array_join(F.slice(t, i, F.lit(n)), separator),
        )).otherwise(F.array().cast(NO_TOKENS))
    def placed_pairs(t: Column) -> Column:
        return F.when(F.size(t) >= n, F.transform(
            F.sequence(F.lit(1), F.size(t) - n + 1), lambda i: F.struct(
                F.array_join(F.transform(F.slice(t, i, F.lit(n)), lambda x: x["t"]), separator).alias("t"),
                F.get(t, i - 1)["p"].alias("p")),
        )).otherwise(F.array().cast(PLACED))

    def apply(tokens: Column) -> Column:
        return _let(terms(tokens), pairs)
    apply.placed = lambda tokens: _let(tokens, placed_pairs)
    apply.width = (n, separator)
    return apply


def tf_light_stem(language: str) -> TextFn:
    """First fitting suffix rule of the language, as one chained expression."""
    def stem(t: Column) -> Column:
        out = None
        for pattern, replacement in LIGHT_STEM[language]:
            hit = F.regexp_replace(t, f"^{pattern}", replacement)
            fits = F.regexp_like(t, F.lit(f"^{pattern}"))
            out = F.when(fits, hit) if out is None else out.when(fits, hit)
        return out.otherwise(t)
    return _each(stem)


tf_phonetic = _each(F.soundex)


def tf_synonym(mapping: Mapping[str, Sequence[str]]) -> TextFn:
    """Replace a token by all its synonyms at the same place in the stream.

    For rule sets too long for a literal use ``operators.index.join_synonyms``.
    """
    def expand(t: Column) -> Column:
        out = F.array(t)
        for word, synonyms in mapping.items():
            out = F.when(t == word, F.array(*[F.lit(s) for s in synonyms])).otherwise(out)
        return out
    return _fan_out(expand)


# A part ends where lower case turns to upper, letters to digits, or at any mark.
WORD_PARTS = r"\p{Lu}*\p{Ll}+|\p{Lu}+|\p{N}+|\p{Lo}+"


def _word_parts(t: Column) -> Column:
    return F.regexp_extract_all(F.regexp_replace(t, "['’]s$", ""), F.lit(WORD_PARTS), F.lit(0))


tf_word_delimiter = _fan_out(_word_parts)


def tf_elision(articles: Iterable[str] = tuple(ELISION_ARTICLES)) -> TextFn:
    pattern = "^(?i)(?:" + "|".join(articles) + ")['’]"
    return _each(lambda t: F.regexp_replace(t, pattern, ""))


def tf_truncate(n: int = 10) -> TextFn:
    return _each(lambda t: F.substring(t, 1, n))


def tf_unique(tokens: Column) -> Column:
    return F.array_distinct(terms(tokens))


def _first_places(tokens: Column) -> Column:
    """The first place of each term."""
    return F.filter(tokens, lambda x, i: F.array_position(F.transform(tokens, lambda y: y["t"]), x["t"]) == i + 1)


tf_unique.placed = lambda tokens: _let(tokens, _first_places)


def tf_pattern_replace(pattern: str, replacement: str = "") -> TextFn:
    return _each(lambda t: F.regexp_replace(t, pattern, replacement))


def collation_key_equal(a: Column, b: Column, collation: str = "UNICODE_CI_AI") -> Column:
    """Equality under a Unicode collation (case and accents ignored by default)."""
    return F.collate(a, collation) == F.collate(b, collation)


# --- analyzers --------------------------------------------------------------

CHAR_FILTERS = {"html_strip": lambda: cf_html_strip, "mapping": cf_mapping}
TOKENIZERS = {
    "whitespace": lambda: tok_whitespace, "letter": lambda: tok_letter,
    "lowercase": lambda: tok_lowercase, "keyword": lambda: tok_keyword,
    "standard": lambda: tok_standard, "uax_url_email": lambda: tok_uax_url_email,
    "pattern": tok_pattern, "ngram": tok_ngram, "edge_ngram": tok_edge_ngram,
    "path_hierarchy": tok_path_hierarchy,
}
TOKEN_FILTERS = {
    "lowercase": lambda: tf_lowercase, "stop": tf_stop, "asciifolding": lambda: tf_asciifolding,
    "icu_folding": lambda: tf_icu_folding, "length": tf_length, "ngram": tf_ngram,
    "edge_ngram": tf_edge_ngram, "shingle": tf_shingle, "light_stem": tf_light_stem,
    "phonetic": lambda: tf_phonetic, "synonym": tf_synonym,
    "word_delimiter": lambda: tf_word_delimiter, "reverse": lambda: tf_reverse,
    "elision": tf_elision, "trim": lambda: tf_trim, "truncate": tf_truncate,
    "unique": lambda: tf_unique, "pattern_replace": tf_pattern_replace,
    "porter_stem": lambda: _by_python("tf_porter_stem"),
    "icu_normalizer": lambda *options: _by_python("tf_unicode_normalise")(*options),
}


def _by_python(name: str) -> TextFn:
    """Filters that need a Python function are loaded when they are named."""
    from corpusgrid.functions import stemming
    return getattr(stemming, name)


def chain(*steps: TextFn) -> TextFn:
    flat = [inner for step in steps for inner in getattr(step, "steps", (step,))]

    def apply(col: Column) -> Column:
        for step in flat:
            col = step(col)
        return col
    apply.steps = flat
    return apply


def placed(analyzer_: TextFn) -> TextFn:
    """The chain on ``array<struct<t,p>>``: terms with their place in the text.

    As long as each token yields one token or a gap, the place is the array index, so
    plain arrays are used up to the first filter that fans out.
    """
    steps = getattr(analyzer_, "steps", [analyzer_])
    fans = [i for i, step in enumerate(steps) if hasattr(step, "many") or hasattr(step, "placed")]
    first = fans[0] if fans else len(steps)

    def numbered(tokens: Column) -> Column:
        spots = F.transform(tokens, lambda t, i: F.struct(t.alias("t"), i.cast("int").alias("p")))
        return F.filter(spots, lambda x: x["t"].isNotNull())

    def apply(text: Column) -> Column:
        col = text
        for step in steps[:first]:
            col = step(col)
        col = numbered(col)
        for step in steps[first:]:
            col = _step_placed(step)(col)
        return col
    return apply


def _step_placed(step: TextFn) -> TextFn:
    if hasattr(step, "placed"):
        return step.placed
    if hasattr(step, "many"):
        return lambda tokens: F.flatten(F.transform(tokens, lambda x: F.transform(
            step.many(x["t"]), lambda t: F.struct(t.alias("t"), x["p"].alias("p")))))
    if hasattr(step, "each"):
        return lambda tokens: F.filter(F.transform(tokens, lambda x: F.struct(
            step.each(x["t"]).alias("t"), x["p"].alias("p"))), lambda x: x["t"].isNotNull())
    raise ValueError("a filter of whole token arrays cannot follow one that makes several tokens of one")


def _part(kind: str, registry: Mapping, spec) -> TextFn:
    """``spec`` is a name, a ``(name, *args)`` tuple, or a Column function."""
    if callable(spec):
        return spec
    name, *args = (spec,) if isinstance(spec, str) else spec
    if name not in registry:
        raise ValueError(f"unknown {kind} '{name}'")
    return registry[name](*args)


def custom_analyzer(tokenizer="standard", char_filters: Sequence = (), filters: Sequence = ()) -> TextFn:
    return chain(
        *(_part("char filter", CHAR_FILTERS, s) for s in char_filters),
        _part("tokenizer", TOKENIZERS, tokenizer),
        *(_part("token filter", TOKEN_FILTERS, s) for s in filters),
    )


def _language(name: str) -> TextFn:
    parts = ["lowercase", ("stop", STOP_WORDS[name]), ("light_stem", name)]
    if name == "french":
        parts.insert(1, "elision")
    return custom_analyzer("standard", filters=parts)


def analyzer(name: str) -> TextFn:
    """Built-in analyzer by name. ``snowball`` stems with the Porter rules."""
    if name in LIGHT_STEM:
        return _language(name)
    if name == "snowball":
        from corpusgrid.functions.stemming import tf_porter_stem
        return chain(analyzer("standard"), tf_porter_stem)
    built_in = {
        "standard": ("standard", ["lowercase", ("stop", ENGLISH_STOP)]),
        "simple": ("lowercase", []),
        "whitespace": ("whitespace", []),
        "stop": ("lowercase", [("stop", ENGLISH_STOP)]),
        "keyword": ("keyword", []),
        "pattern": ("pattern", ["lowercase"]),
    }
    if name not in built_in:
        raise ValueError(f"unknown analyzer '{name}'")
    tokenizer, filters = built_in[name]
    return custom_analyzer(tokenizer, filters=filters)


LANG_CODES = {"en": "english", "fr": "french", "de": "german", "es": "spanish"}


def analyze_by_language(text: Column, lang: Column) -> Column:
    """Pick the language analyzer per row from a two-letter code."""
    out = None
    for code, name in LANG_CODES.items():
        tokens = analyzer(name)(text)
        out = F.when(lang == code, tokens) if out is None else out.when(lang == code, tokens)
    return out.otherwise(analyzer("standard")(text))


def roles(spec) -> dict:
    """The chains of a field: one for all roles, or a mapping of index, search and quote."""
    return dict(spec) if isinstance(spec, Mapping) else {"index": spec}


def pick_analyzer(role: str, *, index: TextFn | None = None, search: TextFn | None = None,
                  quote: TextFn | None = None, query: TextFn | None = None,
                  default: TextFn | None = None) -> TextFn:
    """Which chain a text goes through.

    Stored text uses the index analyzer. Query text uses the analyzer given with
    the query, else the search analyzer, else the index analyzer; quoted query
    text prefers the quote analyzer to the search analyzer.
    """
    fallback = default or analyzer("standard")
    order = {"index": [index], "search": [query, search, index],
             "quote": [query, quote, search, index]}
    if role not in order:
        raise ValueError(f"unknown analyzer role '{role}'")
    return next((a for a in order[role] if a is not None), fallback)
