"""Phred quality strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

REVERSE = 16


def phred(quality: Column) -> Column:
    """Array of Phred scores of an offset-33 string."""
    return F.transform(F.split(quality, ""), lambda c: F.ascii(c) - 33)


def printable(quality: Column) -> Column:
    """True when each character lies in the 33..126 range of the format."""
    return quality.rlike("^[!-~]+$")


def stored_order(original: Column, flag: Column) -> Column:
    """The order in which an aligner stores original qualities: reversed on the reverse strand."""
    return F.when(flag.bitwiseAND(REVERSE) != 0, F.reverse(original)).otherwise(original)
