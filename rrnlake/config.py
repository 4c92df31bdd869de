"""Parameters shared by the operators."""

from __future__ import annotations

from dataclasses import dataclass

# Rank names from the root down, and the gene names that count.
RANK_NAMES = ("Kingdom", "Phylum", "Class", "Order", "Family", "Genus", "Species")
GENE_NAMES_16S = ("16S ribosomal RNA", "16S Ribosomal RNA", "ribosomal RNA-16S")
GENE_NAMES_23S = ("23S ribosomal RNA", "23S Ribosomal RNA", "ribosomal RNA-23S")

COMPLETE = "Complete"
INCOMPLETE = "Incomplete"


@dataclass(frozen=True)
class TaxonomySystem:
    """How one taxonomy writes a lineage: rank letters and separator."""

    name: str
    letters: str
    sep: str

    @property
    def ranks(self) -> tuple[str, ...]:
        return RANK_NAMES + (("Strain",) if len(self.letters) > len(RANK_NAMES) else ())


GTDB = TaxonomySystem("GTDB", "dpcofgs", ";")
NCBI = TaxonomySystem("NCBI", "kpcofgst", "|")


@dataclass(frozen=True)
class OperonRules:
    """Quality rules for one 16S-23S pair."""

    max_its: int = 1500
    # Operon id prefixes by genome set.
    complete_prefix: str = "C_"
    incomplete_prefix: str = "U_"
