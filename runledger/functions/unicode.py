"""Normal forms of Unicode texts, in Arrow batches: each different text of a batch is normalised once."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType


def _each(texts: pa.Array, change) -> pa.Array:
    coded = texts.dictionary_encode()
    return pa.array([None if t is None else change(t) for t in coded.dictionary.to_pylist()], pa.string()).take(coded.indices)


@F.arrow_udf(StringType())
def _nfkc(texts: pa.Array) -> pa.Array:
    return _each(texts, lambda t: t if t.isascii() else unicodedata.normalize("NFKC", t))


@F.arrow_udf(StringType())
def _normal(texts: pa.Array) -> pa.Array:
    return _each(texts, lambda t: "".join(unicodedata.normalize("NFKC", t).split()))


@F.arrow_udf(StringType())
def _fold(texts: pa.Array) -> pa.Array:
    return _each(texts, lambda t: "".join(c for c in unicodedata.normalize("NFKD", t) if not unicodedata.combining(c)).lower())


def nfkc(x: Column) -> Column:
    """Compatibility composition: full-width, half-width and circled forms become plain ones."""
    return _nfkc(x)


def normal(x: Column) -> Column:
    """The form in which texts are compared: NFKC without white space."""
    return _normal(x)


def fold(x: Column) -> Column:
    """Lower case without accents, by decomposition: every letter that has one, not a list."""
    return _fold(x)


def alnum_key(x: Column) -> Column:
    """Letters and digits of any script, NFKC, in lower case."""
    return F.regexp_replace(F.lower(_nfkc(x)), r"[^\p{L}\p{N}]", "")
