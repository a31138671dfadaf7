"""Exact Python literals (U1): an Arrow step for the texts that the built-in reading leaves.

The built-in reading (``text``) takes plain lists and dictionaries of quoted strings; any other text (escapes,
prefixes, tuples, nesting, comments, joined strings, numbers, ``None``) is marked as left over.  Only the
left-over texts are handed to Python: in the other rows the step gets a NULL and does nothing.
"""
from __future__ import annotations

from functools import cache

import pandas as pd
from pyspark.sql import functions as F


@cache
def exact_list():
    """Pandas UDF: text -> array<string> as ``ast.literal_eval`` reads it; no list -> NULL.

    Items that are not strings become text, ``None`` becomes NULL.
    """
    def items(text):
        import ast
        try:
            value = ast.literal_eval(text)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None
        return [v if v is None or isinstance(v, str) else str(v) for v in value] if isinstance(value, list) else None

    def read(texts: pd.Series) -> pd.Series:
        out = pd.Series([None] * len(texts), index=texts.index, dtype=object)
        some = texts[texts.notna()]
        out[some.index] = some.map(items)
        return out

    return F.pandas_udf(read, "array<string>")


@cache
def exact_groups():
    """Pandas UDF: text -> array<struct<category, skills>> as ``ast.literal_eval`` reads a dictionary; else NULL.

    Entries whose value is no list are skipped; keys and items that are not strings become text.
    """
    def entries(text):
        import ast
        try:
            value = ast.literal_eval(text)
        except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
            return None, None
        if not isinstance(value, dict):
            return None, None
        kept = [(k, v) for k, v in value.items() if isinstance(v, list)]
        return ([k if k is None or isinstance(k, str) else str(k) for k, _ in kept],
                [[i if i is None or isinstance(i, str) else str(i) for i in v] for _, v in kept])

    def read(texts: pd.Series) -> pd.DataFrame:
        out = pd.DataFrame({"category": [None] * len(texts), "skills": [None] * len(texts)}, index=texts.index, dtype=object)
        some = texts[texts.notna()]
        if len(some):
            pairs = some.map(entries)
            out.loc[some.index, "category"] = pairs.str[0]
            out.loc[some.index, "skills"] = pairs.str[1]
        return out

    return F.pandas_udf(read, "struct<category:array<string>,skills:array<array<string>>>")
