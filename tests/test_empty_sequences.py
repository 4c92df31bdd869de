"""Empty sequences in clusters."""

from rrnlake.operators import cluster


def test_an_empty_sequence_has_identity_one(spark):
    rows = [("a", "ACGT" * 30), ("none", "")]
    df = spark.createDataFrame(rows, "seqid string, seq string")
    got = {tuple(r) for r in cluster.similarity_pairs(cluster.greedy_cluster(df, 0.99)).collect()}
    assert got == {("none", "a", 0, 1.0)}
