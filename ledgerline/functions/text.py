"""Text columns: normalisation, tokens and placeholders, JVM-side but for NFKC of non-ASCII rows."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: What counts as white space in the data's definition, in a Java character class.
WS = r"\s\x1c-\x1f\x85\p{Z}"
#: Placeholder tokens, in their report order.
PLACEHOLDERS = ("null", "n/a", "na", "nan", "none", "unknown", "undefined")
#: What a data-frame reader takes for missing by default, in lower case.
DEFAULT_NA = ("", "#n/a", "#n/a n/a", "#na", "-1.#ind", "-1.#qnan", "-nan", "1.#ind", "1.#qnan", "<na>", "n/a", "na", "null", "nan", "none")
#: Characters stripped from a token's ends.
TOKEN_STRIP = " ,.<>()[]{}!?:;\"'\t\r\n"


@F.pandas_udf(T.StringType())
def _nfkc(text: pd.Series) -> pd.Series:
    return text.map(lambda t: None if t is None else unicodedata.normalize("NFKC", t))


def normalise(text: Column, nfkc: bool = True) -> Column:
    """Lower case, all but letters, numbers, ``_`` and white space as blanks, white space collapsed; null gives an empty text.

    With ``nfkc``, texts beyond ASCII are brought to NFKC first, in Arrow
    batches; ASCII rows never leave the JVM. Combining marks count as marks, not
    letters.
    """
    text = F.coalesce(text, F.lit(""))
    if nfkc:
        beyond = text.rlike(r"[^\x00-\x7F]")
        text = F.when(beyond, _nfkc(F.when(beyond, text))).otherwise(text)
    marks = F.regexp_replace(F.lower(text), rf"[^\p{{L}}\p{{N}}_{WS}]", " ")
    return F.trim(F.regexp_replace(marks, rf"[{WS}]+", " "))


def strip(text: Column) -> Column:
    """Without white space at both ends."""
    return F.regexp_replace(text, rf"^[{WS}]+|[{WS}]+\z", "")


def tokens(text: Column) -> Column:
    """The tokens between white space of a stripped text."""
    return F.split(text, rf"[{WS}]+")


def clean_token(token: Column) -> Column:
    return F.btrim(token, F.lit(TOKEN_STRIP))


def is_placeholder(token: Column) -> Column:
    return F.lower(token).isin(*PLACEHOLDERS)


def whole_field_placeholder(text: Column) -> Column:
    """The placeholder that a stripped field is, bare or in one pair of <>, [] or (), else null."""
    bare = F.lower(text)
    enclosed = text.rlike(r"(?s)^<.*>\z|^\[.*\]\z|^\(.*\)\z") & (F.length(text) > 1)
    inner = F.lower(strip(text.substr(F.lit(2), F.greatest(F.length(text) - 2, F.lit(0)))))
    return F.when(bare.isin(*PLACEHOLDERS), bare).when(enclosed & inner.isin(*PLACEHOLDERS), inner)


def casing(token: Column) -> Column:
    """``upper``, ``lower``, ``title`` or ``other``, the first that holds."""
    return (
        F.when(token == F.upper(token), "upper")
        .when(token == F.lower(token), "lower")
        .when(token.rlike("^[A-Z][a-z]*(/[A-Z][a-z]*)*$"), "title")
        .otherwise("other")
    )
