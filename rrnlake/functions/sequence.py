"""Sequence expressions.

Cuts work on BINARY: a substring of a string counts characters from its start,
so cutting many pieces from a long contig would be quadratic.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Nucleotide codes and their complements.
COMPLEMENT_FROM = "ACGTURYKMBVDHSWN"
COMPLEMENT_TO = "TGCAAYRMKVBHDSWN"

# The bases each IUPAC code stands for.
IUPAC = {
    "A": "A", "C": "C", "G": "G", "T": "T", "U": "T",
    "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC",
    "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT",
}


def reverse_complement(seq: Column) -> Column:
    """Reverse complement that keeps letter case."""
    return F.reverse(
        F.translate(
            seq,
            COMPLEMENT_FROM + COMPLEMENT_FROM.lower(),
            COMPLEMENT_TO + COMPLEMENT_TO.lower(),
        )
    )


def reverse_complement_text(primer: str) -> str:
    return primer.translate(str.maketrans(COMPLEMENT_FROM, COMPLEMENT_TO))[::-1]


def primer_pattern(primer: str) -> str:
    """Degenerate primer as a regular expression of fixed width."""
    return "".join(IUPAC[c] if len(IUPAC[c]) == 1 else f"[{IUPAC[c]}]" for c in primer.upper())


def cut(seq: Column, start: Column, end: Column) -> Column:
    """Bases start..end, 1-based and closed, of an ASCII sequence."""
    return F.substring(seq.cast("binary"), start.cast("int"), (end - start + 1).cast("int")).cast("string")


def stranded_cut(seq: Column, start: Column, end: Column, strand: Column) -> Column:
    piece = cut(seq, start, end)
    return F.when(strand == "-", reverse_complement(piece)).otherwise(piece)


