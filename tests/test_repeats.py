"""Sequences that are runs of repeats, and the keys that meet."""

from collections import Counter
import random

from pyspark.sql import functions as F

from rrnlake.functions.minimizers import shared_keys
from rrnlake.operators import cluster


def test_runs_of_repeats_do_not_pair_all_that_share_one(spark):
    """Runs of thirty equal words, one of them in every sequence: a long run has many windows, not one."""
    rng = random.Random(51)

    def run(n=6):
        return "".join(rng.choice("ACGT") for _ in range(n)) * 30

    common, rows = run(4), []
    for i in range(40):
        runs = [run(rng.randrange(3, 8)) for _ in range(7)]
        rows.append((f"r{i:02d}", "".join(runs[:3] + [common] + runs[3:])))
    rows.append(("near", rows[4][1][:300] + "G" + rows[4][1][301:]))
    df = spark.createDataFrame(rows, "seqid string, seq string")
    reps = cluster._representatives(df.selectExpr("seqid", "seq", "sha2(seq, 256) AS digest", "1 AS priority"))
    sketches = cluster._sketches(reps, 0.99)
    met = cluster._share_enough(cluster._meet(*cluster._anchors(sketches)), sketches)
    assert met.count() <= 3
    names = {r.place: r.seqid for r in reps.collect()}
    found = cluster._verify(met, reps, 0.99).collect()
    assert [{names[r.place], names[r.centroid_place]} for r in found] == [{"r04", "near"}]


def test_shared_keys_are_counted(spark):
    rng = random.Random(52)
    rows = [([rng.randrange(1 << 48) for _ in range(20)] + list({rng.choice([0, 5, (1 << 48) - 1, 1 << 40]) for _ in range(2)}),) for _ in range(50)]
    df = spark.createDataFrame(rows, "keys array<bigint>").repartition(7)
    want = {k: n for k, n in Counter(k for r in rows for k in r[0]).items() if n > 1}
    assert {r["key"]: r.n for r in shared_keys(df).collect()} == want
    assert shared_keys(df.filter(F.size("keys") < 0)).count() == 0
