"""Choosing assemblies and naming their files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rrnlake.config import COMPLETE, INCOMPLETE
from rrnlake.functions.ids import accession_from_file, prefix_id

# Status and level that select assemblies.
LATEST = "latest"
COMPLETE_LEVEL = "Complete Genome"

# Download suffix and folder by kind of file.
DOWNLOADS = {
    "genome": ("_genomic.fna.gz", "Genomes_", ".fna.gz"),
    "annotation": ("_genomic.gff.gz", "Annotation_", ".gff.gz"),
}


def genome_set_of(level: Column) -> Column:
    """Complete or Incomplete; NULL when the level is unknown."""
    return F.when(level == COMPLETE_LEVEL, COMPLETE).when(level.isNotNull(), INCOMPLETE)


def split_complete(assemblies: DataFrame, latest_only: bool = True) -> DataFrame:
    """Add genome_set. Rows without a level go; with latest_only, replaced versions go too."""
    kept = assemblies.filter(F.col("version_status") == LATEST) if latest_only else assemblies
    return kept.withColumn("genome_set", genome_set_of(F.col("assembly_level"))).filter(
        F.col("genome_set").isNotNull()
    )


def assembly_lookup(accessions: DataFrame, assemblies: DataFrame) -> DataFrame:
    """One summary row per listed accession that has a download path.

    The row is the smallest one in column order, where the reference takes the
    first in file order. The path is tested after the choice, as there.
    """
    fields = [c for c in assemblies.columns if c != "accession"]
    wanted = accessions.select("accession").distinct()
    found = assemblies.join(wanted, "accession", "left_semi")
    first = found.groupBy("accession").agg(F.min(F.struct(*fields)).alias("_row"))
    return first.select("accession", "_row.*").filter(F.col("ftp_path").isNotNull())


def download_manifest(assemblies: DataFrame, kinds: tuple[str, ...] = ("genome", "annotation")) -> DataFrame:
    """URL and target file for every assembly with a genome_set and a download path.

    Nothing is fetched. The file stem is part ten of the path, as in the
    directory layout of the public archive.
    """
    stem = F.try_element_at(F.split("ftp_path", "/"), F.lit(10))
    files = F.array(
        *[
            F.struct(
                F.lit(kind).alias("kind"),
                F.concat("ftp_path", F.lit("/"), stem, F.lit(DOWNLOADS[kind][0])).alias("url"),
                F.concat(
                    F.lit(DOWNLOADS[kind][1]), "genome_set", F.lit("/"),
                    accession_from_file(stem), F.lit(DOWNLOADS[kind][2]),
                ).alias("target"),
            )
            for kind in kinds
        ]
    )
    return (
        assemblies.filter(F.col("ftp_path").isNotNull())
        .withColumn("_file", F.explode(files))
        .select("accession", "genome_set", "_file.*")
    )


def missing_annotation(genomes: DataFrame, annotations: DataFrame, key: str = "accession") -> DataFrame:
    """Genomes without an annotation file; these need a gene finder run outside Spark."""
    return genomes.join(annotations.select(key).distinct(), key, "left_anti")


def header_rewrite(records: DataFrame, file: str = "file", header: str = "header") -> DataFrame:
    """Give every sequence header the accession of its file: ACC__SEQID."""
    accession = accession_from_file(F.col(file))
    return records.withColumns({"accession": accession, "seqid": prefix_id(accession, F.col(header))})
