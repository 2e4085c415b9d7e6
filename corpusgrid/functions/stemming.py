"""Porter stemming and Unicode normalisation for the vocabulary job.

Neither has a Spark expression. Both run as Arrow-batched UDFs, meant for the
distinct vocabulary (see ``operators.index.map_vocabulary``) and not for text.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The suffix tables of the published Porter algorithm (1980).
STEP2 = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize",
    "abli": "able", "alli": "al", "entli": "ent", "eli": "e", "ousli": "ous",
    "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive",
    "fulness": "ful", "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble",
}
STEP3 = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
STEP4 = (
    "al ance ence er ic able ible ant ement ment ent sion tion ou ism ate iti ous ive ize"
).split()

_C = "[^aeiou](?:[^aeiouy])*"
_V = "[aeiouy][aeiou]*"
_M_GT_0 = re.compile(f"^(?:{_C})?{_V}{_C}")
_M_GT_1 = re.compile(f"^(?:{_C})?(?:{_V}{_C}){{2}}")
_M_EQ_1 = re.compile(f"^(?:{_C})?{_V}{_C}(?:{_V})?$")
_HAS_VOWEL = re.compile(f"^(?:{_C})?{_V}")
_CVC = re.compile("[^aeiou][aeiouy][^aeiouwxy]$")


def _swap(word: str, table: dict[str, str]) -> str:
    for suffix in sorted(table, key=len, reverse=True):
        if word.endswith(suffix):
            stem = word[: -len(suffix)]
            return stem + table[suffix] if _M_GT_0.match(stem) else word
    return word


def porter(word: str) -> str:
    """Porter stem of one lower-case word."""
    if word is None or len(word) < 3 or not word.isascii():
        return word
    # plural and -ed / -ing
    if word.endswith(("sses", "ies")):
        word = word[:-2]
    elif word.endswith("s") and not word.endswith("ss"):
        word = word[:-1]
    if word.endswith("eed"):
        if _M_GT_0.match(word[:-3]):
            word = word[:-1]
    else:
        for suffix in ("ed", "ing"):
            if word.endswith(suffix):
                stem = word[: -len(suffix)]
                if _HAS_VOWEL.match(stem):
                    word = stem
                    if word.endswith(("at", "bl", "iz")):
                        word += "e"
                    elif len(word) > 1 and word[-1] == word[-2] and word[-1] not in "aeioulsz":
                        word = word[:-1]
                    elif _M_EQ_1.match(word) and _CVC.search(word):
                        word += "e"
                break
    if word.endswith("y") and _HAS_VOWEL.match(word[:-1]):
        word = word[:-1] + "i"
    word = _swap(_swap(word, STEP2), STEP3)
    for suffix in sorted(STEP4, key=len, reverse=True):
        if word.endswith(suffix):
            cut = 3 if suffix in ("sion", "tion") else len(suffix)
            if _M_GT_1.match(word[:-cut]):
                word = word[:-cut]
            break
    if word.endswith("e"):
        stem = word[:-1]
        if _M_GT_1.match(stem) or (_M_EQ_1.match(stem) and not _CVC.search(stem)):
            word = stem
    if word.endswith("ll") and _M_GT_1.match(word[:-1]):
        word = word[:-1]
    return word


@F.pandas_udf(T.StringType())
def porter_stem(words: pd.Series) -> pd.Series:
    return words.map(porter, na_action="ignore")


@F.pandas_udf(T.ArrayType(T.StringType()))
def tf_porter_stem(tokens: pd.Series) -> pd.Series:
    """Stem whole token arrays; each distinct word of a batch is stemmed once."""
    known: dict[str, str] = {}

    def stem(word):
        if word not in known:
            known[word] = porter(word) if word is not None else None  # a gap stays one
        return known[word]

    return tokens.map(lambda ts: [stem(t) for t in ts], na_action="ignore")


def unicode_normalise(form: str = "NFKC", casefold: bool = True):
    @F.pandas_udf(T.StringType())
    def normalise(words: pd.Series) -> pd.Series:
        out = words.map(lambda w: unicodedata.normalize(form, w), na_action="ignore")
        return out.str.casefold() if casefold else out

    return normalise


def tf_unicode_normalise(form: str = "NFKC", casefold: bool = True):
    """The same for whole token arrays; gaps stay."""
    @F.pandas_udf(T.ArrayType(T.StringType()))
    def normalise(tokens: pd.Series) -> pd.Series:
        def one(word):
            out = unicodedata.normalize(form, word)
            return out.casefold() if casefold else out

        return tokens.map(lambda ts: [None if t is None else one(t) for t in ts], na_action="ignore")

    return normalise
