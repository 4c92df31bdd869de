"""Genome length and operon copy number per taxon at every rank."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rrnlake.config import COMPLETE, GTDB, TaxonomySystem
from rrnlake.functions.ids import assembly_of, contig_of
from rrnlake.functions.lineage import SEP, levels, rank_letter, rank_order, strip_strain
from rrnlake.plans.quantiles import weighted_median


def split_id(df: DataFrame) -> DataFrame:
    """Add assembly and contig from the composite seqid."""
    return df.withColumns({"assembly": assembly_of(F.col("seqid")), "contig": contig_of(F.col("seqid"))})


def genome_length(contigs: DataFrame) -> DataFrame:
    """Total length per assembly of (seqid, length, genome_set)."""
    return (
        split_id(contigs)
        .groupBy("assembly")
        .agg(
            F.sum("length").alias("genome_length"),
            F.bool_or(F.col("genome_set") == COMPLETE).alias("is_complete"),
        )
    )


def copy_number(operons: DataFrame) -> DataFrame:
    """Operons per assembly of a master table; assemblies without operons are absent."""
    return (
        split_id(operons)
        .groupBy("assembly")
        .agg(
            F.count("*").alias("copy_number"),
            F.bool_or(F.col("genome_set") == COMPLETE).alias("is_complete"),
        )
    )


def rank_explode(lineage: DataFrame, system: TaxonomySystem = GTDB, keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per rank: taxon, its rank letter and order, and the lineage down to it.

    A missing lineage stays as one row of NULLs.
    """
    parts = levels(strip_strain(F.col("lineage")))
    exploded = lineage.select(*keep, parts.alias("_parts"), F.posexplode_outer(parts).alias("_pos", "taxon"))
    letter = rank_letter(F.col("taxon"))
    order = rank_order(letter, system)
    return exploded.select(
        *keep,
        "taxon",
        F.when(order.isNotNull(), letter).alias("rank"),
        order.alias("rank_ord"),
        F.when(order.isNotNull(), F.array_join(F.slice("_parts", 1, F.col("_pos") + 1), SEP)).alias("lineage"),
    )


def taxon_stats(
    genomes: DataFrame, lineage: DataFrame, value: str, label: str, system: TaxonomySystem = GTDB
) -> DataFrame:
    """Count, mean and median of a whole number per taxon, for all and for complete genomes.

    Genomes (assembly, value, is_complete) are folded to counts per lineage and
    value before the ranks are exploded, so a taxon that holds most genomes
    reaches its task as counts of distinct values.
    """
    flagged = genomes.join(lineage.select("assembly", "lineage"), "assembly", "left")
    folded = flagged.groupBy("lineage", value).agg(
        F.count("*").alias("n_all"), F.count_if("is_complete").alias("n_complete")
    )
    taxa = rank_explode(folded, system, (value, "n_all", "n_complete"))
    counts = (
        taxa.withColumn("key", F.struct("taxon", "rank", "lineage"))
        .groupBy("key", value)
        .agg(F.sum("n_all").alias("n_all"), F.sum("n_complete").alias("n_complete"))
    )

    def mean(weight: str):
        return F.sum(F.col(value) * F.col(weight)) / F.nullif(F.sum(weight), F.lit(0))

    base = counts.groupBy("key").agg(
        F.sum("n_all").alias("genome_count_all"),
        mean("n_all").alias(f"{label}_mean_all"),
        F.nullif(F.sum("n_complete"), F.lit(0)).alias("genome_count_complete"),
        mean("n_complete").alias(f"{label}_mean_complete"),
    )
    # Both scopes go through one median plan, told apart by a scope field in the key.
    scoped = counts.select(
        value,
        F.inline(F.array(*[
            F.struct(F.struct("key", F.lit(scope).alias("scope")).alias("sk"), F.col(weight).alias("n"))
            for scope, weight in (("all", "n_all"), ("complete", "n_complete"))
        ])),
    )
    medians = weighted_median(scoped, "sk", value, "n", "median")
    wide = medians.groupBy(F.col("sk.key").alias("_key")).agg(*[
        F.max(F.when(F.col("sk.scope") == scope, F.col("median"))).alias(f"{label}_median_{scope}")
        for scope in ("all", "complete")
    ])
    joined = base.join(wide, F.col("key").eqNullSafe(F.col("_key")))
    scopes = [c for scope in ("all", "complete")
              for c in (f"genome_count_{scope}", f"{label}_mean_{scope}", f"{label}_median_{scope}")]
    return joined.select("key.taxon", "key.rank", "key.lineage", *scopes)


def genome_length_stats(contigs: DataFrame, lineage: DataFrame, system: TaxonomySystem = GTDB) -> DataFrame:
    return taxon_stats(genome_length(contigs), lineage, "genome_length", "genome_length", system)


def copy_number_stats(operons: DataFrame, lineage: DataFrame, system: TaxonomySystem = GTDB) -> DataFrame:
    return taxon_stats(copy_number(operons), lineage, "copy_number", "copy_number", system)
