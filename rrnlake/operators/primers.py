"""In-silico PCR and amplicon reads.

A primer list is a handful of literals given by the caller; it is part of the
plan, not a table to join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rrnlake.functions.primers import amplicons
from rrnlake.functions.sequence import stranded_cut

# Primer pairs of the three amplicon designs (name, forward, reverse).
PRIMER_PAIRS = [
    ("A", "CAGCMGCCGCGGTAA", "CCRAMCTGTCTCACGACG"),
    ("B", "AGRGTTTGATYHTGGCTCAG", "ACCRCCCCAGTHAAACT"),
    ("C", "AGRGTTTGATYHTGGCTCAG", "CCRAMCTGTCTCACGACG"),
]
MAX_AMPLICON = 10_000
MIN_READ = 1_000
MIN_IDENTITY = 0.8  # share of primer positions that must match when reads are extracted


def insilico_pcr(seqs: DataFrame, primers=PRIMER_PAIRS, max_len: int = MAX_AMPLICON) -> DataFrame:
    """Amplicons of exact (degenerate) primer matches on both strands.

    One row per left primer site and right site in reach; the amplicon reads in
    primer direction.
    """
    hits = seqs.select("seqid", "seq", F.explode(amplicons(F.col("seq"), primers, max_len, 1.0)).alias("h"))
    return hits.select(
        "seqid", "h.pair", "h.strand", F.col("h.start").alias("start"), F.col("h.end").alias("end"),
        (F.col("h.end") - F.col("h.start") + 1).alias("length"),
        stranded_cut(F.col("seq"), F.col("h.start"), F.col("h.end"), F.col("h.strand")).alias("amplicon"),
    )


def primer_yield(seqs: DataFrame, primers=PRIMER_PAIRS, max_len: int = MAX_AMPLICON) -> DataFrame:
    """Sequences, amplified sequences and their share in percent per primer pair."""
    names = F.array(*[F.lit(p[0]) for p in primers])
    hits = seqs.select(F.transform(amplicons(F.col("seq"), primers, max_len, 1.0, "nearest"), lambda h: h["pair"]).alias("found"))
    each = hits.select("found", F.explode(names).alias("pair"))
    counts = each.groupBy("pair").agg(
        F.count("*").alias("sequences"), F.count_if(F.array_contains("found", F.col("pair"))).alias("amplified")
    )
    return counts.withColumn("percentage", 100 * F.col("amplified") / F.col("sequences"))


def extract_reads(
    seqs: DataFrame, primers=PRIMER_PAIRS, min_len: int = MIN_READ, min_identity: float = MIN_IDENTITY
) -> DataFrame:
    """The region between the primers, one read per sequence and pair.

    Of all pairs of a left and a later right site the one with the fewest primer
    mismatches is taken, then the plus strand, then the leftmost start and end. Primers are trimmed before the length test.
    """
    best = F.transform(
        amplicons(F.col("seq"), primers, None, min_identity, "best"),
        lambda h: F.struct(
            h["pair"].alias("pair"), h["mismatches"].alias("mismatches"), h["strand"].alias("strand"),
            (h["start"] + h["left_len"]).alias("start"), (h["end"] - h["right_len"]).alias("end"),
        ),
    )
    sites = seqs.withColumn("_sites", best)
    def first_of(pair: str) -> Column:
        return F.array_min(F.filter("_sites", lambda h: h["pair"] == pair))

    firsts = F.array(*[first_of(p[0]) for p in primers])
    reads = sites.select(
        *[c for c in seqs.columns if c != "seq"], "seq", F.explode(F.array_compact(firsts)).alias("h")
    )
    return reads.filter(F.col("h.end") - F.col("h.start") + 1 >= min_len).select(
        *[c for c in seqs.columns if c != "seq"], "h.pair", "h.strand", "h.mismatches",
        stranded_cut(F.col("seq"), F.col("h.start"), F.col("h.end"), F.col("h.strand")).alias("read"),
    )
