import re

from pyspark.sql import functions as F

from rrnlake.catalog import bindings, queries
from rrnlake.operators import taxonomy

SMALL = "/root/testdata/sf0.001"


def test_combined_joins_move_no_lineage_text(spark, capsys):
    queries.QUERIES["tax_combined"](spark, SMALL).explain()
    plan = capsys.readouterr().out
    assert re.search(r"Exchange hashpartitioning\(cluster_id#", plan)
    assert not re.search(r"Exchange hashpartitioning\((cluster_id#\d+L?, )?(operon_id|kingdom|pos|tax_)", plan)


def test_majority_of_ties_and_single_lineages(spark):
    rows = [(1, "a", "x", 2), (1, "b", "x", 2), (2, None, None, 5), (3, "a", "x", 1), (3, "a", "y", 1), (3, "a", None, 2), (4, "a", None, 1), (4, "a", "y", 1)]
    cols = [F.lit("k").alias(r) for r in taxonomy.RANKS[:5]]
    frame = spark.createDataFrame(rows, "cluster_id long, genus string, species string, n long").select("cluster_id", *cols, "genus", "species", "n")
    got = {r.cluster_id: r.level for r in taxonomy.maj_levels(frame).collect()}
    assert got == {1: 7, 2: 7, 3: 7, 4: 6}


def test_records_of_repeated_ids(spark, tmp_path):
    source = spark.read.parquet(f"{SMALL}/lineitem.parquet")
    source.unionByName(source.limit(50)).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = bindings.cluster_records(spark, str(tmp_path))
    rows = bindings.cluster_rows(spark, str(tmp_path)).groupBy("cluster_id").agg(F.min("operon_id").alias("query"), F.count("*").alias("size"))
    sums = got.filter("rec_type = 'C'").select("cluster_id", "query", "size")
    assert sums.exceptAll(rows).isEmpty() and rows.exceptAll(sums).isEmpty()
    seeds = got.filter("rec_type = 'S'").select("cluster_id", "query")
    assert seeds.exceptAll(rows.select("cluster_id", "query")).isEmpty() and seeds.count() == rows.count()
    assert got.filter("rec_type = 'H'").join(seeds, ["cluster_id", "query"]).isEmpty()
