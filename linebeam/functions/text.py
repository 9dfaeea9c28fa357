"""Tokenising and per-token predicates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word delimiters of a classic string tokenizer
# (space, tab, newline, carriage return, form feed). Not ``\s``: that also
# splits at vertical tab.
WORD_DELIMITERS = "[ \\t\\n\\r\\f]+"

# A word counts for the first-letter report when its first
# character is a Unicode letter.
LETTER_START = "^\\p{L}"

# Hot-list token cleaning -- apostrophes are removed, then every
# character outside A-Z and a-z becomes one blank.
HOT_DROP = "'"
HOT_BLANK = "[^a-zA-Z]"


def tokens(text: Column | str) -> Column:
    """array<string> of the non-empty tokens of ``text``."""
    col = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(col, WORD_DELIMITERS), lambda w: w != F.lit(""))


def words(df, text: str, alias: str = "w", keep: tuple = ()):
    """One row per non-empty token of ``text`` (Generate + codegen'd filter;
    no per-row lambda)."""
    return (df.select(*keep, F.explode(F.split(F.col(text), WORD_DELIMITERS)).alias(alias))
            .where(F.col(alias) != F.lit("")))


def first_letter(word: Column) -> Column:
    """Lower-cased first character of ``word`` when it is a letter, else NULL."""
    return F.when(word.rlike(LETTER_START), F.lower(F.substring(word, 1, 1)))


def hot_token(word: Column, strip: bool = False, lower: bool = False) -> Column:
    """Token cleaned the way the hot-list lookup cleans it.

    Apostrophes vanish and every other non-ASCII-letter becomes a blank, so
    ``word.`` is looked up as ``word `` (and misses) unless ``strip`` is set.
    """
    out = F.regexp_replace(F.regexp_replace(word, HOT_DROP, ""), HOT_BLANK, " ")
    if strip:
        out = F.trim(out)
    if lower:
        out = F.lower(out)
    return out
