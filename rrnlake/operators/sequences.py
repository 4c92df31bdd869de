"""Sequence tables: lengths, extraction, order, exact duplicates."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rrnlake.functions.sequence import stranded_cut
from rrnlake.plans.sizing import broadcast_if_small


def sequence_length(seqs: DataFrame) -> DataFrame:
    return seqs.select("seqid", F.octet_length("seq").cast("bigint").alias("length"))


def extract_regions(regions: DataFrame, seqs: DataFrame) -> DataFrame:
    """Cut (operon_id, seqid, start, end, strand) out of the sequences; '-' is reverse complemented.

    Regions are narrow and are broadcast when counted small, so contigs are cut
    where they are read. Above that bound both sides shuffle on seqid.
    """
    wanted = regions.select("operon_id", "seqid", "start", "end", "strand")
    return seqs.select("seqid", "seq").join(broadcast_if_small(wanted), "seqid").select(
        "operon_id",
        stranded_cut(F.col("seq"), F.col("start"), F.col("end"), F.col("strand")).alias("seq"),
    )


def sort_by_length(seqs: DataFrame, seqid: str = "operon_id") -> DataFrame:
    """Longest first; ties by name."""
    return seqs.orderBy(F.octet_length("seq").desc(), seqid)


def sort_by_name(seqs: DataFrame, seqid: str = "operon_id") -> DataFrame:
    return seqs.orderBy(seqid)


def exact_dedupe(seqs: DataFrame, order: list[str], seqid: str = "seqid") -> DataFrame:
    """One row per distinct sequence: the first id in `order`, and the number of copies.

    Copies meet on a digest and partial aggregates keep one candidate per task,
    so a very common sequence costs no more than a rare one.
    """
    rank = F.struct(*order, seqid)
    return (
        seqs.withColumn("digest", F.sha2(F.col("seq"), 256))
        .groupBy("digest")
        .agg(F.min(rank).alias("_first"), F.count("*").alias("copies"))
        .select("digest", F.col(f"_first.{seqid}").alias(seqid), "copies")
    )
