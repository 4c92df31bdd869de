from pyspark.sql import functions as F

from rrnlake.functions.primers import amplicons


def test_best_sites_are_one_row_per_pair_and_strand(spark):
    seqs = spark.createDataFrame([("a", "ACGTACGTT" * 500), ("b", "TT")], "seqid string, seq string")
    pairs = [("P1", "ACGTR", "YACG"), ("P2", "GGNA", "TTRC")]
    best = {r.seqid: r.h for r in seqs.select("seqid", amplicons(F.col("seq"), pairs, None, 0.8, "best").alias("h")).collect()}
    every = seqs.limit(1).select(F.explode(amplicons(F.col("seq"), pairs, 60, 0.8)).alias("h")).select("h.*").collect()
    assert best["b"] == [] and 0 < len(best["a"]) <= 4
    assert len({(h.pair, h.strand) for h in best["a"]}) == len(best["a"])
    for h in best["a"]:
        near = min((e.mismatches, e.start, e.end) for e in every if (e.pair, e.strand) == (h.pair, h.strand))
        assert (h.mismatches, h.start, h.end) == near
