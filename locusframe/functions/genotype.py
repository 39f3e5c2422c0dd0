"""Genotypes and variant classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

GENOTYPE = r"^([0-9]+|\.)([/|]([0-9]+|\.))*$"
CLASSES = ("SNP", "INDEL", "OTHER")


def alleles(gt: Column) -> Column:
    """Allele indexes, null where the call is a dot."""
    return F.transform(F.split(gt, r"[/|]"), lambda a: a.try_cast("int"))


def well_formed(gt: Column) -> Column:
    return gt.rlike(GENOTYPE)


def ploidy(gt: Column) -> Column:
    return F.size(F.split(gt, r"[/|]"))


def alt_copies(gt: Column, allele: int = 1) -> Column:
    """Copies of one ALT allele in a called genotype."""
    return copies_in(alleles(gt), allele)


def copies_in(calls: Column, allele: int = 1) -> Column:
    return F.size(F.filter(calls, lambda a: a == allele))


def index_in_range(gt: Column, alt_count: Column) -> Column:
    return F.forall(alleles(gt), lambda a: a.isNull() | (a <= alt_count))


def exclusion_reason(gt: Column) -> Column:
    """Why a call is not compared, or null. Missing outranks ploidy, ploidy outranks reference."""
    return exclusion_of(alleles(gt))


def exclusion_of(calls: Column) -> Column:
    """``exclusion_reason`` of the allele indexes of a call."""
    return (
        F.when(F.exists(calls, lambda a: a.isNull()), "missing_genotype")
        .when(F.size(calls) != 2, "non_diploid")
        .when(F.forall(calls, lambda a: a == 0), "reference_genotype")
    )


def split_genotype(gt: Column, allele: Column) -> Column:
    """Genotype of one ALT after splitting: that allele becomes 1, the others 0, dots stay."""
    rewritten = F.transform(
        F.split(gt, r"[/|]"),
        lambda a: F.when(a == ".", a).when(a.try_cast("int") == allele, "1").otherwise("0"),
    )
    separator = F.when(F.contains(gt, F.lit("|")), F.lit("|")).otherwise(F.lit("/"))
    return F.when(separator == "|", F.array_join(rewritten, "|")).otherwise(F.array_join(rewritten, "/"))


def variant_class(ref: Column, alt: Column) -> Column:
    return (
        F.when((F.length(ref) == 1) & (F.length(alt) == 1), "SNP")
        .when(F.length(ref) != F.length(alt), "INDEL")
        .otherwise("OTHER")
    )


def end_position(pos: Column, ref: Column, info: Column) -> Column:
    """1-based inclusive end: INFO END when present, else the REF span."""
    declared = F.regexp_extract(info, r"(?:^|;)END=([0-9]+)(?:;|$)", 1).try_cast("bigint")
    return F.coalesce(declared, pos + F.length(ref) - 1)


def allele_multiset(gt: Column, ref: Column, alts: Column) -> Column:
    """Sorted allele strings a genotype carries; null when an index is a dot or out of range."""
    pool = F.concat(F.array(ref), alts)
    calls = alleles(gt)
    valid = F.forall(calls, lambda a: a.isNotNull() & (a < F.size(pool)))
    return F.when(valid, F.array_sort(F.transform(calls, lambda a: F.get(pool, a))))
