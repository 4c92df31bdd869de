"""Accession and sequence id expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

ID_SEP = "__"


def strip_source_prefix(accession: Column) -> Column:
    """Drop the database prefix of a taxonomy accession (RS_ or GB_)."""
    return F.regexp_replace(accession, "^(RS|GB)_", "")


def strip_version(accession: Column) -> Column:
    """Drop the version of an accession, one digit or more."""
    return F.regexp_replace(accession, r"\.\d+$", "")


def accession_from_file(path: Column) -> Column:
    """Accession without version from a download name such as ACC.1_ASM1_genomic.fna.gz."""
    name = F.substring_index(path, "/", -1)
    return F.regexp_replace(name, r"(\.\d+_.*|\.(fna|gff)(\.gz)?)$", "")


def strip_path(label: Column) -> Column:
    """Genome name from a file path label."""
    return F.regexp_replace(F.substring_index(label, "/", -1), r"\.fna\.gz$", "")


def first_word(header: Column) -> Column:
    """A header cut at its first space."""
    return F.substring_index(header, " ", 1)


def prefix_id(accession: Column, header: Column) -> Column:
    """ACC__SEQID, with the header cut at its first space."""
    return F.concat_ws(ID_SEP, accession, first_word(header))


def assembly_of(seqid: Column) -> Column:
    return F.split(seqid, ID_SEP, 2)[0]


def contig_of(seqid: Column) -> Column:
    return F.try_element_at(F.split(seqid, ID_SEP, 2), F.lit(2))


def pad_id(number: Column, prefix: Column, width: int = 8) -> Column:
    """Prefix and zero padded number; longer numbers keep all their digits."""
    text = number.cast("string")
    padded = F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)
    return F.concat(prefix, padded)


def clean_consensus_header(header: Column) -> Column:
    """centroid=X;seqs=N becomes X."""
    return F.regexp_replace(F.regexp_replace(header, "centroid=", ""), ";seqs=.*", "")
