"""Column helpers for text that the built-in functions leave to the caller."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """`c` without outer white space of any kind (`trim` takes only spaces)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def is_blank(c: Column) -> Column:
    """True where `c` is null or holds only white space; never null."""
    return F.coalesce(~c.rlike(r"(?U)[^\s]"), F.lit(True))


def filled(c: Column) -> Column:
    """`c`, or null where it is blank."""
    return F.when(c.rlike(r"(?U)[^\s]"), c)


def truthy_coalesce(*cs: Column) -> Column:
    """The first value that is neither null nor the empty text; white space counts as a value."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cs])


def contains_any(c: Column, needles: list[str]) -> Column:
    """True where the lower-cased `c` contains one of `needles`; false for null."""
    quoted = "|".join(f"\\Q{n}\\E" for n in needles)
    return F.coalesce(F.lower(c).rlike(quoted), F.lit(False))


def holds_any(lowered: Column, needles: list[str]) -> Column:
    """`contains_any` for a column that is in lower case already: plain searches, faster than one pattern."""
    short = [n for n in needles if not any(m != n and m in n for m in needles)]
    return F.coalesce(reduce(lambda a, b: a | b, [lowered.contains(n) for n in short]), F.lit(False))


def quantise(c: Column, digits: int = 4) -> Column:
    """`c` rounded half up on its double value, the same in every engine."""
    scale = float(10**digits)
    return F.floor(c * scale + 0.5) / F.lit(scale)


def any_of(cs: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, cs)


def fingerprint(*cs: Column) -> Column:
    """A 64-bit hash in which null differs from every value and neighbours do not run together."""
    return F.xxhash64(*[x for c in cs for x in (c, c.isNull())])


def fingerprint_pair(*cs: Column) -> Column:
    """Two independent 64-bit hashes of the same columns, compared where equality of long texts decides."""
    parts = [x for c in cs for x in (c, c.isNull())]
    return F.struct(F.xxhash64(*parts).alias("a"), F.xxhash64(F.lit("salt"), *parts).alias("b"))
