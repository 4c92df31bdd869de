"""Lineage expressions. Inside the library a lineage is text joined by '|'."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from rrnlake.config import RANK_NAMES, TaxonomySystem

SEP = "|"


def recode_sep(lineage: Column) -> Column:
    return F.translate(lineage, ";", SEP)


def levels(lineage: Column) -> Column:
    return F.split(lineage, r"\|")


def split_ranks(lineage: Column, system: TaxonomySystem) -> list[Column]:
    """One column per rank, NULL where the lineage is shorter."""
    return [
        F.try_element_at(levels(lineage), F.lit(i + 1)).alias(rank.lower())
        for i, rank in enumerate(system.ranks)
    ]


def unite_ranks(ranks: list[Column]) -> Column:
    """Ranks joined to one lineage; a missing rank is written as NA."""
    return F.concat_ws(SEP, *[F.coalesce(r, F.lit("NA")) for r in ranks])


def strip_strain(lineage: Column) -> Column:
    return F.substring_index(lineage, "|t__", 1)


def cut_below(lineage: Column, level: Column, system: TaxonomySystem) -> Column:
    """Lineage text with everything under rank number `level` (1 = top) removed.

    The cut looks for the prefix of the next rank, so a lineage whose next rank
    is missing stays as it is.
    """
    out = lineage
    for i in range(1, len(RANK_NAMES)):
        mark = f"{SEP}{system.letters[i]}__"
        out = F.when(level == i, F.substring_index(lineage, mark, 1)).otherwise(out)
    return out


def rank_letter(taxon: Column) -> Column:
    return F.upper(F.substring_index(taxon, "__", 1))


def rank_order(letter: Column, system: TaxonomySystem) -> Column:
    """1 for the top rank; NULL for letters the system does not have."""
    found = F.instr(F.lit(system.letters[: len(RANK_NAMES)].upper()), letter)
    return F.when(found > 0, found)
