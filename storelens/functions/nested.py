"""Typed arrays and structs out of text that holds Python literals.

The catalogue stores ``categories`` as a list of lists and ``related`` as a
dictionary of lists, both printed by Python.  Text that is read the same as lenient JSON goes to
``from_json`` as it is.  Other text (``None``, prefixes such as ``u'x'``, ``\\xe9``
escapes, trailing commas) is cut into tokens and written again as strict JSON, all in Spark's own expressions.
One pattern tells beforehand whether a text has the shape that these can read.  Rows that have it not
(tuples, floats, joined strings, lists nested deeper) are split off to a small
Arrow function built on the standard library's safe literal reader, and united with the others again.
"""

from __future__ import annotations

import ast
import operator
from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from storelens.functions.columns import concat_lists

# The id lists that a product's ``related`` text may hold.
RELATED_LISTS = ("also_bought", "also_viewed", "bought_together", "buy_after_viewing")

NESTED_LIST = T.ArrayType(T.ArrayType(T.StringType()))
RELATED = T.StructType([T.StructField(name, T.ArrayType(T.StringType())) for name in RELATED_LISTS])

_UNREADABLE = "_unreadable"
_JSON_OPTIONS = {"allowSingleQuotes": "true", "columnNameOfCorruptRecord": _UNREADABLE}
# Words that mean something else in JSON than in a Python literal, or only in one.
_WORDS = ("None", "True", "False", "null", "true", "false", "NaN", "Infinity")


def _ambiguous(text: Column) -> Column:
    """True for text with a backslash escape or with one of the words.

    Plain searches first: a pattern over every row would cost more than parsing.
    """
    present = reduce(operator.or_, [text.contains(word) for word in _WORDS])
    as_word = text.rlike(r"\b(" + "|".join(_WORDS) + r")\b")
    return text.contains("\\") | (present & as_word)


def _literal_readers():
    """The two Arrow functions.

    They are made of local functions only, so they travel to the Python workers
    as they are and this package need not be installed there.
    """

    def parse(text: str | None) -> object:
        if text is None:
            return None
        try:
            return ast.literal_eval(text)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None

    def strings(value: object) -> list[str | None] | None:
        if not isinstance(value, list):
            return None
        return [item if item is None or isinstance(item, str) else str(item) for item in value]

    @F.pandas_udf(NESTED_LIST)
    def lists(texts: pd.Series) -> pd.Series:
        values = map(parse, texts)
        return pd.Series([[strings(item) for item in value] if isinstance(value, list) else None for value in values])

    names = RELATED_LISTS

    @F.pandas_udf(T.StructType([*RELATED.fields, T.StructField("readable", T.BooleanType())]))
    def related(texts: pd.Series) -> pd.DataFrame:
        values = [parse(text) for text in texts]
        columns = {
            name: [strings(value.get(name)) if isinstance(value, dict) else None for value in values]
            for name in names
        }
        columns["readable"] = [isinstance(value, dict) for value in values]
        return pd.DataFrame(columns)

    return lists, related


_literal_lists, _literal_related = _literal_readers()


# Patterns of a literal; quantifiers are possessive, so that long text needs no stack.
_STRING = r"""[uU]?+(?:'[^'\\\r\n\x00]*+(?:\\[^\r\n\x00][^'\\\r\n\x00]*+)*+'|"[^"\\\r\n\x00]*+(?:\\[^\r\n\x00][^"\\\r\n\x00]*+)*+")"""
_PLAIN = r"(?:-?[1-9][0-9]*+|0|None|True|False)(?![0-9A-Za-z_.])"
# A comma before a closing bracket is one token with it.
_TOKEN = f"{_STRING}|{_PLAIN}|,[ \\t]*+[\\]}}]|[\\[\\]{{}},:]"
_GAP = r"[ \t]*+"


def _series(item: str) -> str:
    """Items between commas, one more comma allowed, or nothing."""
    return f"(?:{item}{_GAP}(?:,{_GAP}{item}{_GAP})*+(?:,{_GAP})?+)?+"


_INNER = rf"\[{_GAP}{_series(f'(?:{_STRING}|{_PLAIN})')}\]"
_LIST = rf"^{_GAP}\[{_GAP}{_series(_INNER)}\]{_GAP}$"
_DICT = rf"^{_GAP}\{{{_GAP}{_series(f'{_STRING}{_GAP}:{_GAP}(?:{_INNER}|None)')}\}}{_GAP}$"
# Escapes other than those that mean one character in both notations, or can be written so; halves of a pair count as odd.
_ODD_ESCAPE = r"""\\(?![\\'"nrtbf]|x[0-9a-fA-F]{2}|u(?![dD][89a-fA-F])[0-9a-fA-F]{4})"""
_PIECE = r"""\\.|[^\\"]++|\""""


def _readable(text: Column, pattern: str) -> Column:
    """Whether the text is a literal of the pattern's shape that can be read without Python; one match, no parsing."""
    return text.rlike(pattern) & ~(text.contains("\\") & text.rlike(_ODD_ESCAPE))


def _json_string(token: Column) -> Column:
    """A string token as a JSON string."""
    start = F.when(F.left(token, F.lit(1)).isin("u", "U"), 3).otherwise(2)
    body = F.substring(token, start, F.length(token) - start)

    def rewritten(piece: Column) -> Column:
        return F.when(piece == "\\'", "'").when(piece == '"', '\\"').when(piece == "\\x", "\\u00").otherwise(piece)

    pieces = F.transform(F.regexp_extract_all(body, F.lit(_PIECE), F.lit(0)), rewritten)
    plain = ~(body.contains("\\") | body.contains('"'))
    return F.concat(F.lit('"'), F.when(plain, body).otherwise(F.array_join(pieces, "")), F.lit('"'))


def _as_json(text: Column) -> Column:
    """A readable literal as strict JSON: strings and values other than None as strings, no comma before a closing bracket."""

    def rewritten(token: Column) -> Column:
        return (
            F.when(token.isin("[", "]", "{", "}", ",", ":"), token).when(F.left(token, F.lit(1)) == ",", F.right(token, F.lit(1)))
            .when(token == "None", "null").when(F.right(token, F.lit(1)).isin("'", '"'), _json_string(token))
            .otherwise(F.concat(F.lit('"'), token, F.lit('"')))
        )

    return F.array_join(F.transform(F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0)), rewritten), "")


_STRICT = {"allowUnquotedControlChars": "true"}


def _native_list(text: Column) -> Column:
    """``array<array<string>>`` of a readable text."""
    lenient = F.when(~_ambiguous(text), F.from_json(text, NESTED_LIST, _JSON_OPTIONS))
    return F.coalesce(lenient, F.from_json(_as_json(text), NESTED_LIST, _STRICT))


def _native_related(text: Column) -> Column:
    """The struct of the id lists of a readable text."""
    lenient = F.from_json(text, T.StructType([*RELATED.fields, T.StructField(_UNREADABLE, T.StringType())]), _JSON_OPTIONS)
    strict = F.from_json(_as_json(text), RELATED, _STRICT)

    def lists(value: Column) -> Column:
        return F.struct(*[value.getField(name).alias(name) for name in RELATED_LISTS])

    return F.when(~_ambiguous(text) & lenient.isNotNull() & lenient.getField(_UNREADABLE).isNull(), lists(lenient)).otherwise(lists(strict))


def read_nested(df: DataFrame, *, lists: Sequence[str] = (), related: Sequence[str] = ()) -> DataFrame:
    """Replace text columns by ``array<array<string>>`` (``lists``) and by structs of the four id lists (``related``), and add ``<column>_bad``.

    Unreadable text becomes null and is marked true in the added column; a dictionary's entry that is not a list gives
    null for that list only.  Rows that a pattern shows to be readable are parsed without Python.  Whether there are others is
    looked up first, by a job that ends with the first one; only then do they get a branch of their own, with a scan of its own.
    """
    names = [*lists, *related]
    text = {name: F.col(f"`{name}`") for name in names}
    readable = reduce(operator.and_, [text[name].isNull() | _readable(text[name], _LIST if name in lists else _DICT) for name in names])

    def replaced(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
        read = rows.withColumns({f"_value_{k}": values[name] for k, name in enumerate(names)})
        value = {name: F.col(f"_value_{k}") for k, name in enumerate(names)}
        marks = [(text[name].isNotNull() & value[name].isNull()).alias(f"{name}_bad") for name in names]
        return read.select(*[value.get(name, F.col(f"`{name}`")).alias(name) for name in df.columns], *marks)

    def native(name: str) -> Column:
        return F.when(text[name].isNotNull(), _native_list(text[name]) if name in lists else _native_related(text[name]))

    def literal(name: str) -> Column:
        if name in lists:
            return _literal_lists(text[name])
        read = _literal_related(text[name])
        return F.when(read.getField("readable"), F.struct(*[read.getField(part).alias(part) for part in RELATED_LISTS]))

    if not df.where(~readable).take(1):
        return replaced(df, {name: native(name) for name in names})
    clean = replaced(df.where(readable), {name: native(name) for name in names})
    return clean.unionAll(replaced(df.where(~readable), {name: literal(name) for name in names}))


def read_nested_list(df: DataFrame, column: str) -> DataFrame:
    """``read_nested`` of one column of lists of lists."""
    return read_nested(df, lists=[column])


def read_related(df: DataFrame, column: str = "related") -> DataFrame:
    """``read_nested`` of one column of dictionaries of id lists."""
    return read_nested(df, related=[column])


def related_ids(related: Column) -> Column:
    """Ids of all four lists in one array, repeats kept."""
    return concat_lists(related.getField(name) for name in RELATED_LISTS)
