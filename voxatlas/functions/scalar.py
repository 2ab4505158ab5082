"""Scalar functions that Spark has under another name or not at all."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_even(c: Column | str) -> Column:
    """Nearest integer, halves to the even one, as int."""
    return F.rint(c).cast("int")


def saturate(c: Column | str, low: int = 0, high: int = 65535) -> Column:
    """Rounded half to even and clamped, as an unsigned integer of that range would hold it."""
    return F.least(F.greatest(F.rint(c), F.lit(low)), F.lit(high)).cast("int")


def truncate(c: Column | str, bits: int | None = None) -> Column:
    """Toward zero; with ``bits`` wrapped as an unsigned integer of that width."""
    whole = F.col(c).cast("bigint") if isinstance(c, str) else c.cast("bigint")
    return whole if bits is None else F.pmod(whole, F.lit(1 << bits))


def negate_unsigned(c: Column | str, bits: int = 16) -> Column:
    """Minus x in unsigned arithmetic: 0 stays 0, others become 2**bits - x."""
    return F.pmod(-(F.col(c) if isinstance(c, str) else c), F.lit(1 << bits))


def ratio(a: Column | str, b: Column | str) -> Column:
    """a / b as double; NULL where b is 0."""
    return F.try_divide((F.col(a) if isinstance(a, str) else a).cast("double"), (F.col(b) if isinstance(b, str) else b).cast("double"))


def natural_key(c: Column | str) -> Column:
    """A key that sorts digit runs by their value: alternating text and numbers."""
    parts = F.regexp_extract_all(c, F.lit("(\\d+|\\D+)"), F.lit(1))
    return F.transform(parts, lambda p: F.when(p.rlike("^\\d"), F.concat(F.lit("0"), F.lpad(p, 20, "0"))).otherwise(F.concat(F.lit("1"), p)))


def zero_padded(c: Column | str, width: int = 4) -> Column:
    """The last digit run of a name, padded with zeros to ``width``."""
    name = F.col(c) if isinstance(c, str) else c
    digits = F.regexp_extract(name, "(\\d+)(?=\\D*$)", 1)
    return F.when(digits == "", name).otherwise(F.concat(F.regexp_extract(name, "^(.*?)\\d+\\D*$", 1), F.lpad(digits, width, "0"), F.regexp_extract(name, "(\\D*)$", 1)))
