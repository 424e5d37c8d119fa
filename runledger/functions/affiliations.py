"""Names with affiliations printed into them, and keys of affiliations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from runledger.functions.unicode import nfkc

# Endings that a printed prefecture may carry; half-width kana, which only clubs are printed in.
ENDINGS, HALF_WIDTH = ("都", "府", "県"), "[｡-ﾟ]"


def remainder(key: Column, other: Column) -> Column:
    """The letters of key that are left when other's letters are taken out of it in order; null where other is no subsequence of it. Each letter is
    taken at its first chance."""
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("rest"))
    taken = lambda s, c: (s["i"] < F.length(other)) & (c == F.substring(other, s["i"] + 1, F.lit(1)))
    step = lambda s, c: F.struct((s["i"] + taken(s, c).cast("int")).alias("i"), F.when(taken(s, c), s["rest"]).otherwise(F.concat(s["rest"], c)).alias("rest"))
    end = F.aggregate(F.filter(F.split(key, ""), lambda c: c != ""), start, step)
    return F.when(end["i"] == F.length(other), end["rest"])


def name_key(name: Column) -> Column:
    return F.regexp_replace(name, r"\s", "")


def glued(name: Column, others: Column, known: Column) -> Column:
    """Whether a name is one of the others with the letters of a known affiliation (or of a half-width club name) mixed in."""
    key = name_key(name)

    def is_of(other):
        okey = name_key(other)
        rest = F.regexp_replace(F.regexp_replace(remainder(key, okey), HALF_WIDTH, ""), "県$", "")
        return (okey != "") & (okey != key) & F.coalesce(F.array_contains(known, rest), F.lit(False))

    return F.exists(others, is_of)


def surname_changed(old: Column, new: Column) -> Column:
    """The same given name behind a surname that shares no letter with the old one."""
    a, b = F.split(old, " ", 2), F.split(new, " ", 2)
    letters = lambda x: F.filter(F.split(F.lower(x[0]), ""), lambda c: c != "")
    whole = (F.size(a) == 2) & (F.size(b) == 2)
    return F.coalesce(whole & (F.get(a, F.lit(1)) == F.get(b, F.lit(1))) & (a[0] != "") & (b[0] != "") & ~F.arrays_overlap(letters(a), letters(b)), F.lit(False))


def affiliation_key(pref: Column, club: Column, known: Column) -> tuple[Column, Column]:
    """(affiliation, club) under which print forms are one: no blanks, middle dots, widths, case or ending. What is no known affiliation is part of the club's name."""
    plain = lambda x: F.lower(F.regexp_replace(nfkc(F.coalesce(x, F.lit(""))), r"[\s 　・･]", ""))
    p, c = plain(pref), plain(club)
    short = F.regexp_replace(p, f"({'|'.join(ENDINGS)})$", "")
    p = F.when((short != p) & F.array_contains(known, short), short).otherwise(p)
    fits = F.array_contains(known, p)
    return F.when(fits, p), F.when(fits | (p == ""), c).otherwise(F.concat(p, c))


def split_interleaved(text: Column, known: Column) -> tuple[Column, Column, Column]:
    """(ASCII letters, the others, the others where they are a known affiliation) of a text in which two fields ran into each other."""
    ascii_, rest = F.regexp_replace(text, r"[^\x00-\x7F]", ""), F.regexp_replace(text, r"[\x00-\x7F]", "")
    return F.trim(ascii_), rest, F.when(F.array_contains(known, rest), rest)
