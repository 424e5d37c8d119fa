"""Keys and normal forms of names and numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Letters with accents and what they fold to.
ACCENTS, PLAIN = "ÁÀÂÄÉÈÊËÍÌÎÏÓÒÔÖÚÙÛÜÇÑáàâäéèêëíìîïóòôöúùûüçñ", "AAAAEEEEIIIIOOOOUUUUCNaaaaeeeeiiiioooouuuucn"


def slug(x: Column) -> Column:
    """Letters and digits in lower case with single hyphens; 'x' where nothing is left."""
    return F.coalesce(F.nullif(F.regexp_replace(F.regexp_replace(F.lower(x), "[^a-z0-9]+", "-"), "^-|-$", ""), F.lit("")), F.lit("x"))


def name_key(x: Column) -> Column:
    return F.lower(F.regexp_replace(x, "[^A-Za-z0-9]", ""))


def number_key(x: Column) -> Column:
    """Digits without leading zeros; null where none are left."""
    return F.nullif(F.regexp_replace(F.regexp_replace(x, "[^0-9]", ""), "^0+", ""), F.lit(""))


def placeholder(x: Column) -> Column:
    return F.coalesce(x.rlike("^9999[0-9]{3}$"), F.lit(False))


def fold(x: Column) -> Column:
    return F.lower(F.translate(x, ACCENTS, PLAIN))
