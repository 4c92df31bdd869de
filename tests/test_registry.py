"""The registered queries against their SQL twins on the smallest tables, and their plans."""

import os

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, compare
from rrnlake.catalog import bindings as b
from rrnlake.catalog.oracles import ORACLES
from rrnlake.catalog.queries import QUERIES
from rrnlake.operators import operons, stats, taxonomy

# A selection; with ALL_TWINS=1 all of them.
SELECTED = [
    "fasta_scan", "gff_scan", "assembly_lookup", "operon_qc", "copy_number_stats", "genome_length_stats", "split_id",
    "tax_combined", "lineage_resolve", "lineage_format", "extract_operons", "exact_dedupe", "insilico_pcr", "extract_reads",
    "extract_reads_tolerant", "nb_classify", "ani_pairs", "contained_clusters", "contained_pairs", "contained_merge",
    "cluster_consensus",
]
NAMES = sorted(ORACLES) if os.environ.get("ALL_TWINS") else SELECTED


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, small, name):
    ok, text = compare(spark, con, small, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, text


def test_twins_belong_to_queries():
    assert set(ORACLES) <= set(entry.queries())
    assert set(QUERIES) - set(ORACLES) == {
        "similarity_pairs", "greedy_clusters", "novel_only_merge", "consensus"}


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def test_plans_have_no_cross_join_and_no_python(spark, small):
    m = taxonomy.cluster_members(b.cluster_records(spark, small), b.operon_assemblies(spark, small))
    rows = taxonomy.cluster_lineages(m, b.member_lineage(spark, small))
    built = operons.build_operons(b.features(spark, small), b.contigs(spark, small))
    stat = stats.copy_number_stats(operons.good_operons(built), b.lineage(spark, small))
    for df in (taxonomy.maj_levels(rows), taxonomy.lca_levels(rows), built, stat):
        logical, physical = plan(df)
        assert "CartesianProduct" not in physical and "BroadcastNestedLoopJoin" not in physical
        assert "Python" not in physical


def test_rrna_filter_reaches_the_scan(spark, small):
    df = operons.select_rrna(b.features(spark, small)).select("seqid", "start")
    _, physical = plan(df)
    assert "PushedFilters" in physical and "props" not in physical.split("ReadSchema")[1]
