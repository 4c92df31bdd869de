"""rRNA genes to operons: pairing, numbering, quality rules, regions.

Tables here have a genome_set column instead of one code path per set.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rrnlake.config import COMPLETE, GENE_NAMES_16S, GENE_NAMES_23S, OperonRules
from rrnlake.functions.ids import pad_id
from rrnlake.plans.ordering import dense_index, number_within, with_neighbours


def select_rrna(features: DataFrame) -> DataFrame:
    return features.filter(F.col("type") == "rRNA")


def classify_rrna(features: DataFrame) -> DataFrame:
    """Whole 16S and 23S genes only, by the text after the last 'product='."""
    product = F.substring_index("attributes", "product=", -1)
    gene = F.when(product.isin(*GENE_NAMES_16S), "16S").when(product.isin(*GENE_NAMES_23S), "23S")
    return (
        features.filter(~F.col("attributes").contains("partial=true"))
        .withColumn("gene", gene)
        .filter(F.col("gene").isNotNull())
    )


def rrna_genes(features: DataFrame) -> DataFrame:
    """16S and 23S rows of a feature table (genome_set, seqid, start, end, strand, attributes)."""
    return classify_rrna(select_rrna(features)).select(
        "genome_set", "seqid", "start", "end", "strand", "gene", "attributes"
    )


def pair_adjacent(genes: DataFrame) -> DataFrame:
    """Each 16S with the 23S right after it (+) or right before it (-), in coordinate order.

    `place` is the position of the 16S in the order of all genes.
    """
    keys = [F.col(c) for c in ("genome_set", "seqid", "start", "end", "strand", "attributes")]
    placed = dense_index(genes, keys, "place")
    near = with_neighbours(placed, "place", ["genome_set", "seqid", "start", "end", "strand", "gene"])
    mate = F.when(F.col("strand") == "+", F.col("next")).when(F.col("strand") == "-", F.col("prev"))
    return (
        near.filter(F.col("gene") == "16S")
        .withColumn("mate", mate)
        .filter(
            (F.col("mate.gene") == "23S")
            & (F.col("mate.seqid") == F.col("seqid"))
            & (F.col("mate.strand") == F.col("strand"))
            & (F.col("mate.genome_set") == F.col("genome_set"))
        )
        .select(
            "genome_set",
            "seqid",
            "strand",
            F.col("start").alias("start_16s"),
            F.col("end").alias("end_16s"),
            F.col("mate.start").alias("start_23s"),
            F.col("mate.end").alias("end_23s"),
            "place",
        )
    )


def number_operons(pairs: DataFrame, rules: OperonRules = OperonRules()) -> DataFrame:
    """operon_id per genome set in gene order, given to all pairs before any quality rule."""
    prefix = F.when(F.col("genome_set") == COMPLETE, rules.complete_prefix).otherwise(rules.incomplete_prefix)
    return (
        number_within(pairs, "genome_set", "place", "operon_no")
        .withColumn("operon_id", pad_id(F.col("operon_no"), prefix))
        .drop("operon_no", "place")
    )


def its_length(strand: Column) -> Column:
    """Distance between the genes; may be negative when they overlap."""
    return F.when(strand == "+", F.col("start_23s") - F.col("end_16s")).otherwise(
        F.col("start_16s") - F.col("end_23s")
    )


def operon_start() -> Column:
    return F.least("start_16s", "end_16s", "start_23s", "end_23s")


def operon_end() -> Column:
    return F.greatest("start_16s", "end_16s", "start_23s", "end_23s")


def operon_qc(operons: DataFrame, contig_lengths: DataFrame, rules: OperonRules = OperonRules()) -> DataFrame:
    """Add ITS length, linkage, contig length, span and the boundary test.

    cross_boundary is NULL when the contig length is unknown, unless the span
    starts at 1.
    """
    lengths = contig_lengths.select("seqid", F.col("length").alias("sequence_length"))
    return (
        operons.join(lengths, "seqid", "left")
        .withColumns({
            "its_length": its_length(F.col("strand")),
            "operon_start": operon_start(),
            "operon_end": operon_end(),
        })
        .withColumns({
            "linkage": F.when(F.col("its_length") > rules.max_its, "Unlinked").otherwise("Linked"),
            "cross_boundary": (F.col("operon_start") == 1)
            | (F.col("operon_end") >= F.col("sequence_length")),
        })
    )


def build_operons(features: DataFrame, contig_lengths: DataFrame, rules: OperonRules = OperonRules()) -> DataFrame:
    """Features to numbered operons with all quality columns."""
    pairs = pair_adjacent(rrna_genes(features))
    return operon_qc(number_operons(pairs, rules), contig_lengths, rules)


def rejected_operons(operons: DataFrame) -> DataFrame:
    """Unlinked or boundary-crossing operons. A linked one of unknown contig length is in neither table."""
    return operons.filter(F.col("cross_boundary") | (F.col("linkage") == "Unlinked"))


def good_operons(operons: DataFrame) -> DataFrame:
    """The master table: linked operons inside their contig, with ITS coordinates."""
    plus = F.col("strand") == "+"
    return operons.filter(~F.col("cross_boundary") & (F.col("linkage") == "Linked")).select(
        "genome_set",
        "seqid",
        "operon_id",
        F.lit("Dummy").alias("source"),
        F.lit("rRNA").alias("type"),
        F.when(plus, F.col("end_16s")).otherwise(F.col("end_23s")).alias("start_its"),
        F.when(plus, F.col("start_23s")).otherwise(F.col("start_16s")).alias("end_its"),
        "start_16s", "end_16s", "start_23s", "end_23s",
        F.lit(None).cast("string").alias("score"),
        "strand",
        F.lit(None).cast("string").alias("phase"),
    )


def its_regions(master: DataFrame) -> DataFrame:
    """Headerless region rows of the ITS; the id is 'seqid operon_id'."""
    return master.select(
        F.concat_ws(" ", "seqid", "operon_id").alias("seqid_operon"),
        "source", "type", F.col("start_its").alias("start"), F.col("end_its").alias("end"),
        "score", "strand", "phase",
    )


def operon_regions(master: DataFrame) -> DataFrame:
    """Headerless region rows of whole operons; the id is the seqid."""
    return master.select(
        "seqid", "source", "type", operon_start().alias("start"), operon_end().alias("end"),
        "score", "strand", "phase",
    )


def operon_identifiers(master: DataFrame) -> DataFrame:
    return master.select(F.concat_ws(" ", "seqid", "operon_id").alias("seqid_operon"))


def operon_wide(genes: DataFrame) -> DataFrame:
    """Gene rows (operon_id, seqid, strand, gene, start, end) to one row per operon."""
    def pick(gene: str, field: str) -> Column:
        return F.max(F.when(F.col("gene") == gene, F.col(field))).alias(f"{field}_{gene.lower()}")

    return genes.groupBy("operon_id", "seqid", "strand").agg(
        pick("16S", "start"), pick("16S", "end"), pick("23S", "start"), pick("23S", "end")
    )


def operon_long(operons: DataFrame) -> DataFrame:
    """One row per gene of each operon."""
    genes = F.array(*[
        F.struct(
            F.lit(g.upper()).alias("gene"), F.col(f"start_{g}").alias("start"), F.col(f"end_{g}").alias("end")
        )
        for g in ("16s", "23s")
    ])
    return operons.select("operon_id", "seqid", "strand", F.inline(genes))
