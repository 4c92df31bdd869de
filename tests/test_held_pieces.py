"""Every pair of a sequence and a centroid that holds it."""

import random

from rrnlake.functions.pieces import Finder
from rrnlake.operators import cluster


def make_rows(seed):
    rng = random.Random(seed)
    roots = ["".join(rng.choice("ACGT") for _ in range(rng.randrange(150, 500))) for _ in range(8)]
    common = roots[0][20:60]
    rows = [r[:100] + common + r[100:] for r in roots] + [common, common[3:30], "A", "AC", roots[1][60:110], roots[2][40:49]]
    rows += [r[-len(r) // 2:] for r in roots] + ["TTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTTT"]
    return [(f"s{i:02d}", s) for i, s in enumerate(rows)]


def held(rows, owner):
    """(seqid, centroid) of every distinct hit and each centroid that holds it, by looking."""
    seqs, heads = dict(rows), set(owner.values())
    return {(n, c) for n, s in rows for c in heads if n not in heads and s in seqs[c]}


def test_a_short_sequence_is_listed_with_all_that_hold_it(spark):
    rows = make_rows(1)
    df = spark.createDataFrame(rows, "seqid string, seq string")
    out = cluster.greedy_cluster(df, 1.0)
    owner = {r.seqid: r.centroid for r in out.members.collect()}
    pairs = [(r.seqid, r.centroid) for r in cluster.similarity_pairs(out).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == held(rows, owner)
    assert sum(n == "s08" for n, _ in pairs) == 8


def test_short_sequences_in_slices_and_beside_existing_centroids(spark, monkeypatch):
    monkeypatch.setattr(cluster, "PIECES", 2)
    rows = make_rows(2)
    old, new = [rows[0], rows[3], rows[9]], [r for r in rows if r not in (rows[0], rows[3], rows[9])]
    a, b = (spark.createDataFrame(x, "seqid string, seq string") for x in (old, new))
    out = cluster.cluster_incremental(a, b, 1.0)
    heads = {r.centroid for r in out.members.collect()}
    seqs = dict(rows)
    want = {(n, c) for n, _ in new for c in heads if n not in heads and (
        seqs[n] in seqs[c] or c in dict(old) and seqs[c] in seqs[n])}
    pairs = [(r.seqid, r.centroid) for r in cluster.similarity_pairs(out).collect()]
    assert len(pairs) == len(set(pairs)) and set(pairs) == want


def test_an_empty_sequence_is_in_all_centroids_with_identity_one(spark):
    rows = [("a", "ACGT" * 30), ("b", "GGCA" * 40), ("none", "")]
    df = spark.createDataFrame(rows, "seqid string, seq string")
    got = {tuple(r) for r in cluster.similarity_pairs(cluster.greedy_cluster(df, 0.99)).collect()}
    assert got == {("none", "a", 0, 1.0), ("none", "b", 0, 1.0)}
    out = cluster.cluster_incremental(df.filter("seqid = 'none'"), df.filter("seqid <> 'none'"), 0.99)
    assert {tuple(r) for r in cluster.similarity_pairs(out).collect()} == {("a", "none", 0, 1.0), ("b", "none", 0, 1.0)}


def test_finder_equals_looking():
    rng = random.Random(3)
    for _ in range(60):
        text = "".join(rng.choice("ACGT"[: rng.choice([1, 2, 4])]) for _ in range(rng.randrange(1, 300)))
        words = []
        for n in range(30):
            at = rng.randrange(len(text))
            words.append(text[at:at + rng.randrange(0, 64)] if n % 3 else "".join(rng.choice("ACGT") for _ in range(rng.randrange(64))))
        words = list(enumerate(w.encode() for w in dict.fromkeys(words)))
        want = [n for n, w in words if len(w) < len(text) and w in text.encode()]
        assert sorted(Finder(words).inside(text.encode())) == want
