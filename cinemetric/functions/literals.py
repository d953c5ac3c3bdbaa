"""Python-literal text → JSON text, the slow path of the literal-list parser (C-01, C-02).

``from_json`` already reads the single-quoted lists the catalogue CSVs hold.  It gives up on
Python-only tokens (``None``, ``True``), ``\\xa0``-style escapes and similar; only those rows
are sent here, as one Arrow batch per task, and come back as JSON for ``from_json``.
"""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _literal_to_json(text):
    if text is None:
        return None
    try:
        value = ast.literal_eval(text)
    except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
        try:
            value = json.loads(text)
        except ValueError:
            return None
    try:
        return json.dumps(value)
    except (TypeError, ValueError):
        return None


def _literal_then_json_first(text):
    """C-02 order: JSON first, then Python literal."""
    if text is None:
        return None
    try:
        return json.dumps(json.loads(text))
    except ValueError:
        pass
    try:
        return json.dumps(ast.literal_eval(text))
    except (ValueError, SyntaxError, MemoryError, RecursionError, TypeError):
        return None


def _literal_batch(texts: pd.Series) -> pd.Series:
    return texts.map(_literal_to_json)


def _jsonish_batch(texts: pd.Series) -> pd.Series:
    return texts.map(_literal_then_json_first)


_UDFS: dict = {}


def _arrow_udf(fn):
    # created on first use: declaring a pandas UDF needs an active session
    if fn not in _UDFS:
        _UDFS[fn] = F.pandas_udf(fn, "string")
    return _UDFS[fn]


def literal_to_json(texts: Column) -> Column:
    """Arrow UDF: Python literal (then JSON) text → JSON text, NULL when neither parses."""
    return _arrow_udf(_literal_batch)(texts)


def jsonish_to_json(texts: Column) -> Column:
    """Arrow UDF: JSON (then Python literal) text → JSON text, NULL when neither parses."""
    return _arrow_udf(_jsonish_batch)(texts)


def only_when(cond: Column, value: Column) -> Column:
    """Pass ``value`` to a UDF only on rows that need it (NULL elsewhere keeps batches light)."""
    return F.when(cond, value)
