"""Column functions over source text and identifiers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import patterns as P


def n_whitespaces(text: Column) -> Column:
    """Characters that are Unicode whitespace."""
    return F.regexp_count(text, F.lit(P.WS)).cast("bigint")


def n_words(text: Column) -> Column:
    """Maximal runs of word characters."""
    return F.regexp_count(text, F.lit(P.WORD)).cast("bigint")


def nloc(text: Column) -> Column:
    """Lines holding at least one character that is not whitespace.

    Each match runs from a line's first such character to its end: no array of lines is built.
    """
    return F.regexp_count(text, F.lit(rf"{P.NOT_WS}[^\n]*")).cast("bigint")


def text_metrics(text: Column) -> list[Column]:
    """X1-X3 as three named columns."""
    return [
        n_whitespaces(text).alias("n_whitespaces"),
        n_words(text).alias("n_words"),
        nloc(text).alias("nloc"),
    ]


def standardize_repo_name(name: Column) -> Column:
    """P10: whitespace stripped from both ends, lower case."""
    return F.lower(F.regexp_replace(name, F.lit(P.EDGE_WS), F.lit("")))


def standardize_path(path: Column) -> Column:
    """Forward slashes only, none leading or trailing."""
    return F.btrim(F.translate(path, "\\", "/"), F.lit("/"))


def normalize_signature(signature: Column) -> Column:
    """Every run of whitespace becomes one space; ends stripped."""
    return F.trim(F.regexp_replace(signature, F.lit(f"{P.WS}+"), F.lit(" ")))


def split_words_and_symbols(text: Column) -> Column:
    """Tokens of plain text: words, and single characters between them."""
    return F.regexp_extract_all(text, F.lit(P.WORD_OR_SYMBOL), F.lit(0))


def decode_tokens(col: Column, python_repr: bool = False) -> Column:
    """A stored token list as ``array<string>``; null where it cannot be parsed.

    ``python_repr`` also accepts lists written with single quotes and backslash escapes.
    Nothing is ever evaluated as code.
    """
    options = {"mode": "PERMISSIVE"}
    if python_repr:
        options |= {"allowSingleQuotes": "true", "allowBackslashEscapingAnyCharacter": "true"}
    else:
        options |= {"allowSingleQuotes": "false"}
    return F.from_json(col, "array<string>", options)


def encode_tokens(col: Column) -> Column:
    """Inverse of ``decode_tokens``: the list as JSON text."""
    return F.to_json(col)
