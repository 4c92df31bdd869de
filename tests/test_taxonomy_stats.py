"""Consensus rules, medians and lineage resolution on hand-made rows."""

import random
import statistics

from pyspark.sql import functions as F

from rrnlake.config import NCBI
from rrnlake.operators import stats, taxonomy
from rrnlake.plans.quantiles import weighted_median

MEMBER = "cluster_id long, operon_id string, is_centroid boolean, assembly string"


def lineages(spark):
    rows = {
        "x1": "d__B|p__1|c__1|o__1|f__1|g__1|s__1", "x2": "d__B|p__1|c__1|o__1|f__1|g__1|s__2",
        "x3": "d__A|p__1|c__2|o__2|f__2|g__2|s__3", "x4": "d__A|p__2|c__3|o__3|f__3|g__3|s__4",
        "x5": "d__B|p__1|c__1|o__1|f__1|g__1",
    }
    return spark.createDataFrame(list(rows.items()), "assembly string, lineage string")


def members(spark, clusters):
    rows = [(c, f"op{c}_{i}", i == 0, a) for c, many in clusters.items() for i, a in enumerate(many)]
    return spark.createDataFrame(rows, MEMBER)


def test_lca(spark):
    m = members(spark, {1: ["x1", "x1"], 2: ["x1", "x2"], 3: ["x1", "x3"], 4: ["x1", "x4"], 5: ["x5", "x5"],
                        6: ["x1", "x5"], 7: ["none", "none"]})
    rows = taxonomy.cluster_lineages(m, lineages(spark))
    levels = taxonomy.lca_levels(rows)
    lca = taxonomy.tax_lca(rows, levels, m.filter("is_centroid"))
    got = sorted((r.cluster_id, r.lca_rank, r.lineage) for r in lca.collect())
    na = "|NA"
    assert got == [
        (1, "Species", "d__B|p__1|c__1|o__1|f__1|g__1|s__1"),
        (2, "Genus", "d__B|p__1|c__1|o__1|f__1|g__1|NA"),
        (3, "Phylum", "d__A|p__1" + na * 5),   # the phylum agrees, the domain does not: two rows
        (3, "Phylum", "d__B|p__1" + na * 5),
        (4, "Unknown", "NA" + na * 6),
        (5, "Species", "d__B|p__1|c__1|o__1|f__1|g__1|NA"),  # a missing species is a value
        (6, "Genus", "d__B|p__1|c__1|o__1|f__1|g__1|NA"),
        (7, "Species", "NA" + na * 6),
    ]
    assert taxonomy.tax_lca(rows, levels, m.filter("is_centroid"), drop_unknown=True).count() == 7
    open_species = taxonomy.conflicting_species(rows, levels).filter("cluster_id = 6").collect()
    assert {(r.species, r.operon_count) for r in open_species} == {("s__1", 1), (None, 1)}


def test_majority(spark):
    m = members(spark, {1: ["x1", "x2", "x2"], 2: ["x1", "x2"], 3: ["x1", "x4"], 4: ["x5", "x1", "x2"]})
    levels = taxonomy.maj_levels(taxonomy.cluster_lineages(m, lineages(spark)))
    got = {r.cluster_id: r.lineage for r in taxonomy.tax_maj(levels, m, lineages(spark)).collect()}
    assert got == {
        1: "d__B|p__1|c__1|o__1|f__1|g__1|s__1",  # the centroid's own species, not the winning one
        2: "d__B|p__1|c__1|o__1|f__1|g__1",
        3: "d__B",                                 # no majority anywhere
        4: "d__B|p__1|c__1|o__1|f__1|g__1|NA",     # nothing to cut below the genus
    }
    summary = {r.maj_rank: (r.n, r.percentage) for r in taxonomy.maj_rank_summary(levels).collect()}
    assert summary["Species"] == (1, 100 / 3) and summary["Genus"][0] == 2 and summary["Kingdom"][0] == 0


def test_taxon_stats(spark):
    rows = [("x1", 10, True), ("x2", 20, False), ("x3", 5, True), ("x4", 8, True), ("none", 7, False)]
    genomes = spark.createDataFrame(rows, "assembly string, v long, is_complete boolean")
    out = {r.lineage: r for r in stats.taxon_stats(genomes, lineages(spark), "v", "v").collect()}
    top = out["d__B"]
    assert (top.genome_count_all, top.v_mean_all, top.v_median_all) == (2, 15.0, 15.0)
    assert (top.genome_count_complete, top.v_median_complete) == (1, 10.0)
    assert out["d__B|p__1|c__1|o__1|f__1|g__1|s__2"].genome_count_complete is None
    assert out[None].taxon is None and out[None].v_median_all == 7.0
    assert out["d__A|p__1"].genome_count_all == 1


def test_weighted_median_equals_plain_median(spark):
    rng = random.Random(5)
    groups = {k: [rng.choice([rng.randrange(20), rng.randrange(10 ** 7)]) for _ in range(n)]
              for k, n in (("a", 1), ("b", 2), ("c", 101), ("d", 400))}
    rows = [(k, v) for k, many in groups.items() for v in many]
    counts = spark.createDataFrame(rows, "k string, v long").groupBy("k", "v").agg(F.count("*").alias("n"))
    out = {r.k: r.m for r in weighted_median(counts, "k", "v", "n", "m").collect()}
    assert out == {k: statistics.median(v) for k, v in groups.items()}


def test_lineage_resolution(spark):
    nodes = spark.createDataFrame(
        [(1, 1, "no rank"), (2, 1, "superkingdom"), (3, 2, "clade"), (4, 3, "phylum"), (5, 4, "genus"), (6, 5, "species"),
         (7, 6, "strain")], "tax_id long, parent_id long, rank string")
    names = spark.createDataFrame(
        [(1, "root"), (2, "Bacteria"), (3, "Some"), (4, "P"), (5, "G"), (6, "G s"), (7, "G s x")], "tax_id long, name string")
    merged = spark.createDataFrame([(99, 6)], "old_id long, new_id long")
    taxids = spark.createDataFrame([("a", 7), ("b", 99), ("c", None), ("d", 1234)], "accession string, taxid long")
    full = taxonomy.lineage_resolve(taxids, nodes, names, merged)
    got = {r.accession: r.lineage for r in full.collect()}
    assert got == {"a": "Bacteria;Some;P;G;G s;G s x", "b": "Bacteria;Some;P;G;G s", "d": None}
    line = {r.accession: r.lineage for r in taxonomy.lineage_format(full.filter("path IS NOT NULL")).collect()}
    assert line["a"] == "k__Bacteria|p__P|c__|o__|f__|g__G|s__G s|t__G s x"


def test_cycles_end_and_deleted_taxids_are_told(spark):
    up = {1: 1, 2: 1, 3: 2, 4: 3, 10: 11, 11: 12, 12: 10, 13: 12, 14: 13, 20: 99, 30: 30, **{k: k - 1 for k in range(101, 140)}, 100: 1}
    nodes = spark.createDataFrame([(k, v, "no rank") for k, v in up.items()], "tax_id long, parent_id long, rank string")
    names = spark.createDataFrame([(k, f"n{k}") for k in up], "tax_id long, name string")
    merged = spark.createDataFrame([(500, 4), (501, 14)], "old_id long, new_id long")
    deleted = spark.createDataFrame([(600,), (600,), (4,)], "tax_id long")
    wanted = [4, 10, 13, 14, 20, 500, 501, 600, 700, 139, 1, None]
    taxids = spark.createDataFrame([(str(t), t) for t in wanted], "accession string, taxid long")
    got = {r.taxid: (r.status, r.lineage) for r in taxonomy.lineage_resolve(taxids, nodes, names, merged, deleted).collect()}
    assert got == {
        4: ("current", "n2;n3;n4"), 500: ("merged", "n2;n3;n4"), 10: ("cycle", None), 13: ("cycle", None), 14: ("cycle", None),
        501: ("cycle", None), 20: ("current", "n20"), 600: ("deleted", None), 700: ("unknown", None), 1: ("current", ""),
        139: ("current", ";".join(f"n{k}" for k in range(100, 140)))}
    kept = {r.tax_id for r in taxonomy.with_ancestors(nodes, spark.createDataFrame([(4,), (14,)], "tax_id long")).collect()}
    assert kept == {1, 2, 3, 4, 10, 11, 12, 13, 14}


def test_rank_explode_keeps_missing_lineage(spark):
    df = spark.createDataFrame([("a", "k__B|p__P|c__C|o__O|f__F|g__G|s__S|t__T"), ("b", None)], "assembly string, lineage string")
    rows = stats.rank_explode(df, NCBI, ("assembly",)).collect()
    assert [r.rank for r in rows if r.assembly == "a"] == list("KPCOFGS")
    assert [(r.taxon, r.lineage) for r in rows if r.assembly == "b"] == [(None, None)]
