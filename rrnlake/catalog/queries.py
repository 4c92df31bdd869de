"""The registered queries. Each takes (spark, folder) and returns a DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rrnlake.catalog import bindings as b
from rrnlake.config import COMPLETE, GTDB, NCBI
from rrnlake.functions.ids import clean_consensus_header
from rrnlake.operators import assemblies, cluster, kmers, operons, primers, sequences, stats, taxonomy
from rrnlake.plans.durable import durable, written
from rrnlake.plans.ordering import dense_index
from rrnlake.plans.sizing import parts_for
from rrnlake.sources import sinks
from rrnlake.sources.fasta import parse_fasta
from rrnlake.sources.gff import parse_gff
from rrnlake.sources.tables import parse_assembly_summary, parse_lineage, parse_uc, uc_lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources -----------------------------------------------------------------


@query
def fasta_scan(spark, folder):
    """Sequences written as multi-line FASTA records and read back."""
    s = b.sequences(spark, folder)
    lines = F.regexp_replace("seq", "(.{60})", "$1\n")
    text = F.concat(F.lit(">"), "seqid", F.lit(" "), "lang", F.lit(" > "), "source", F.lit("\n"), lines, F.lit("\n"))
    return parse_fasta(s.select(text.alias("value"))).select(
        "seqid", "description", F.octet_length("seq").cast("bigint").alias("length"), F.md5("seq").alias("digest")
    )


@query
def gff_scan(spark, folder):
    """Annotation lines parsed, rRNA rows kept."""
    f = b.features(spark, folder)
    dot = F.lit(".")
    line = F.concat_ws("\t", "seqid", F.lit("src"), "type", F.col("start").cast("string"),
                       F.col("end").cast("string"), dot, "strand", dot, "attributes")
    return operons.select_rrna(parse_gff(f.select(line.alias("value")))).drop("source", "type")


@query
def assembly_scan(spark, folder):
    return parse_assembly_summary(b.summary_lines(spark, folder))


@query
def lineage_scan(spark, folder):
    return parse_lineage(b.lineage_lines(spark, folder))


@query
def cluster_records(spark, folder):
    return parse_uc(uc_lines(b.cluster_records(spark, folder)))


# --- assemblies and ids -------------------------------------------------------


@query
def assembly_split(spark, folder):
    return assemblies.split_complete(b.assemblies(spark, folder)).select(
        "accession", "taxid", "assembly_level", "genome_set"
    )


@query
def assembly_lookup(spark, folder):
    a = b.assemblies(spark, folder).drop("o_orderkey")
    # Every tenth assembly is listed twice, the second time with an older status.
    number = F.substring("accession", 5, 9).cast("bigint")
    twice = a.unionByName(a.filter(number % 10 == 0).withColumn("version_status", F.lit("suppressed")))
    return assemblies.assembly_lookup(b.listed_accessions(spark, folder), twice)


@query
def download_manifest(spark, folder):
    return assemblies.download_manifest(assemblies.split_complete(b.assemblies(spark, folder)))


@query
def missing_annotation(spark, folder):
    return assemblies.missing_annotation(b.assemblies(spark, folder).select("accession"), b.annotated(spark, folder))


@query
def header_rewrite(spark, folder):
    a = b.assemblies(spark, folder)
    records = a.select(
        F.concat("accession", F.lit("_ASM"), "o_orderkey", F.lit("_genomic.fna.gz")).alias("file"),
        F.concat(F.lit("NZ_"), "o_orderkey", F.lit(" "), "assembly_level").alias("header"),
        F.concat(F.lit("centroid=C_"), "o_orderkey", F.lit(";seqs="), F.col("taxid")).alias("consensus_header"),
    )
    return assemblies.header_rewrite(records).select(
        "accession", "seqid", clean_consensus_header(F.col("consensus_header")).alias("consensus_id")
    )


@query
def lineage_ranks(spark, folder):
    return taxonomy.lineage_ranks(b.lineage_eight(spark, folder), NCBI)


# --- operons ------------------------------------------------------------------


def _built(spark, folder) -> DataFrame:
    return operons.build_operons(b.features(spark, folder), b.contigs(spark, folder))


def _master(spark, folder) -> DataFrame:
    return operons.good_operons(_built(spark, folder))


@query
def rrna_genes(spark, folder):
    return operons.rrna_genes(b.features(spark, folder))


@query
def operon_pairs(spark, folder):
    return operons.pair_adjacent(operons.rrna_genes(b.features(spark, folder))).drop("place")


@query
def operon_ids(spark, folder):
    pairs = operons.pair_adjacent(operons.rrna_genes(b.features(spark, folder)))
    return operons.number_operons(pairs).select("operon_id", "seqid", "start_16s", "start_23s")


@query
def operon_wide(spark, folder):
    pairs = operons.pair_adjacent(operons.rrna_genes(b.features(spark, folder)))
    return operons.operon_wide(operons.operon_long(operons.number_operons(pairs)))


@query
def operon_qc(spark, folder):
    return _built(spark, folder)


@query
def rejected_operons(spark, folder):
    return operons.rejected_operons(_built(spark, folder))


@query
def master_operons(spark, folder):
    return _master(spark, folder)


@query
def its_regions(spark, folder):
    return operons.its_regions(_master(spark, folder))


@query
def operon_regions(spark, folder):
    return operons.operon_regions(_master(spark, folder))


@query
def operon_identifiers(spark, folder):
    return operons.operon_identifiers(_master(spark, folder))


# --- sequences ----------------------------------------------------------------


@query
def contig_lengths(spark, folder):
    return sequences.sequence_length(b.sequences(spark, folder))


@query
def extract_operons(spark, folder):
    return sequences.extract_regions(b.cut_regions(spark, folder), b.sequences(spark, folder))


@query
def length_sort(spark, folder):
    """Position of every sequence in the order clustering reads them: longest first."""
    s = b.sequences(spark, folder).select("seqid", F.octet_length("seq").cast("bigint").alias("length"))
    return dense_index(s, [F.col("length").desc(), F.col("seqid")], "place")


@query
def exact_dedupe(spark, folder):
    s = b.sequences(spark, folder).withColumn("priority", F.col("doc_id") % 2)
    return sequences.exact_dedupe(s, ["priority"]).select("seqid", "copies")


# --- statistics ---------------------------------------------------------------


@query
def split_id(spark, folder):
    return stats.split_id(b.all_contigs(spark, folder)).select("seqid", "assembly", "contig")


@query
def rank_explode(spark, folder):
    return stats.rank_explode(b.lineage(spark, folder), GTDB, ("assembly",))


@query
def rank_explode_strain(spark, folder):
    return stats.rank_explode(b.lineage_eight(spark, folder), NCBI, ("assembly",))


@query
def genome_length(spark, folder):
    return stats.genome_length(b.all_contigs(spark, folder))


@query
def genome_length_stats(spark, folder):
    out = stats.genome_length_stats(b.all_contigs(spark, folder), b.lineage(spark, folder))
    return _rounded(out, "genome_length_mean_all", "genome_length_mean_complete")


@query
def copy_number(spark, folder):
    return stats.copy_number(_master(spark, folder))


@query
def copy_number_stats(spark, folder):
    out = stats.copy_number_stats(_master(spark, folder), b.lineage(spark, folder))
    return _rounded(out, "copy_number_mean_all", "copy_number_mean_complete")


@query
def copy_number_stats_strain(spark, folder):
    out = stats.copy_number_stats(_master(spark, folder), b.lineage_eight(spark, folder), NCBI)
    return _rounded(out, "copy_number_mean_all", "copy_number_mean_complete")


# --- taxonomy -----------------------------------------------------------------


def _members(spark, folder) -> DataFrame:
    return taxonomy.cluster_members(b.cluster_records(spark, folder), b.operon_assemblies(spark, folder))


def _centroids(spark, folder) -> DataFrame:
    """Centroid rows straight from the S records."""
    seeds = b.cluster_records(spark, folder).filter("rec_type = 'S'")
    return taxonomy.cluster_members(seeds, b.operon_assemblies(spark, folder))


def _lineages_and_centroids(spark, folder) -> tuple[DataFrame, DataFrame]:
    """Both from members written once; centroids lie by cluster, as the folded lineages do."""
    members = written(_members(spark, folder), "members")
    parts = parts_for(members)
    rows = taxonomy.cluster_lineages(members, b.member_lineage(spark, folder), parts=parts)
    return rows, members.filter("is_centroid").repartition(parts, "cluster_id")


def _lineages(spark, folder) -> DataFrame:
    return _lineages_and_centroids(spark, folder)[0]


@query
def cluster_members(spark, folder):
    return _members(spark, folder)


@query
def cluster_sizes(spark, folder):
    return taxonomy.cluster_sizes(_members(spark, folder))


@query
def tax_full(spark, folder):
    return taxonomy.tax_full(b.operon_assemblies(spark, folder), b.member_lineage(spark, folder))


@query
def tax_rep(spark, folder):
    return taxonomy.tax_rep(_centroids(spark, folder), b.member_lineage_eight(spark, folder))


def _lca(rows: DataFrame, centroids: DataFrame, drop_unknown: bool = False) -> DataFrame:
    return taxonomy.tax_lca(rows, taxonomy.lca_levels(rows), centroids, drop_unknown)


@query
def tax_lca(spark, folder):
    return _lca(*_lineages_and_centroids(spark, folder))


@query
def tax_lca_known(spark, folder):
    """Only clusters that agree on some rank, the form of the second taxonomy system."""
    return _lca(*_lineages_and_centroids(spark, folder), drop_unknown=True)


@query
def lca_rank_summary(spark, folder):
    out = taxonomy.lca_rank_summary(_lca(*_lineages_and_centroids(spark, folder)))
    return out.withColumn("percentage", F.round("percentage", 6))


@query
def conflicting_species(spark, folder):
    rows = _lineages(spark, folder)
    return taxonomy.conflicting_species(rows, taxonomy.lca_levels(rows))


@query
def tax_maj(spark, folder):
    rows, centroids = _lineages_and_centroids(spark, folder)
    return taxonomy.tax_maj(taxonomy.maj_levels(rows), centroids, b.member_lineage(spark, folder))


@query
def maj_rank_summary(spark, folder):
    out = taxonomy.maj_rank_summary(taxonomy.maj_levels(_lineages(spark, folder)))
    return out.withColumn("percentage", F.round("percentage", 6))


def _combined(spark, folder) -> DataFrame:
    rows, centroids = _lineages_and_centroids(spark, folder)
    lineage = b.member_lineage(spark, folder)
    return taxonomy.tax_combined(
        taxonomy.tax_rep(centroids, lineage),
        _lca(rows, centroids),
        taxonomy.tax_maj(taxonomy.maj_levels(rows), centroids, lineage),
    )


@query
def tax_combined(spark, folder):
    return _combined(spark, folder)


@query
def complete_subset(spark, folder):
    complete = b.operon_assemblies(spark, folder).filter(F.col("operon_id").startswith("C_"))
    return taxonomy.complete_subset(_combined(spark, folder), complete)


def _resolved(spark, folder) -> DataFrame:
    tree = b.taxonomy_tree(spark, folder)
    taxids = b.assemblies(spark, folder).select("accession", "taxid")
    return taxonomy.lineage_resolve(taxids, tree["nodes"], tree["names"], tree["merged"])


@query
def lineage_resolve(spark, folder):
    return _resolved(spark, folder).select("accession", "taxid", "current_taxid", "lineage")


@query
def lineage_format(spark, folder):
    return taxonomy.lineage_format(_resolved(spark, folder)).select("accession", "lineage")


@query
def export_union(spark, folder):
    """Master and rejected operons of both genome sets under their origin."""
    built = _built(spark, folder)
    keep = ["operon_id", "seqid", "operon_start", "operon_end", "linkage"]
    parts = {}
    for name in (COMPLETE, "Incomplete"):
        one = built.filter(F.col("genome_set") == name).drop("genome_set")
        parts[("GTDB", name)] = one.filter(~F.col("cross_boundary") & (F.col("linkage") == "Linked")).select(*keep)
        parts[("NCBI", name)] = operons.rejected_operons(one).select(*keep, "cross_boundary")
    return sinks.export_union(parts)


# --- clustering ---------------------------------------------------------------

IDENTITY = 0.999  # the default of the database build
LOOSE = 0.99


def _seqs(spark, folder) -> DataFrame:
    return b.sequences(spark, folder).select("seqid", "seq", "doc_id")


@query
def similarity_pairs(spark, folder):
    return _rounded(cluster.similarity_pairs(cluster.greedy_cluster(_seqs(spark, folder), LOOSE)), "identity")


@query
def greedy_clusters(spark, folder):
    return _rounded(cluster.greedy_cluster(_seqs(spark, folder), IDENTITY).members, "identity")


@query
def novel_only_merge(spark, folder):
    """Even documents clustered first; odd ones enter where no centroid represents them."""
    s = _seqs(spark, folder)
    old = cluster.greedy_cluster(s.filter("doc_id % 2 = 0"), IDENTITY).centroids()
    new = s.filter("doc_id % 2 = 1")
    return cluster.cluster_incremental(old.withColumnRenamed("operon_id", "seqid"), new, IDENTITY).records()


@query
def contained_clusters(spark, folder):
    """Clusters at identity 1: a sequence belongs to the earliest one that holds it whole."""
    return _rounded(cluster.greedy_cluster(_seqs(spark, folder), 1.0).members.drop("cluster_id", "offset"), "identity")


@query
def contained_pairs(spark, folder):
    """Every match with a centroid at identity 1, among whole sequences and their halves."""
    s = _seqs(spark, folder)
    half = s.select(F.concat("seqid", F.lit("h")).alias("seqid"), F.expr("right(seq, cast(length(seq) / 2 as int))").alias("seq"))
    found = cluster.greedy_cluster(s.select("seqid", "seq").unionByName(half), 1.0)
    return _rounded(cluster.similarity_pairs(found), "identity")


@query
def contained_merge(spark, folder):
    """Centroids of even documents first, at identity 1; odd ones enter where no centroid holds them or is held by them."""
    s = _seqs(spark, folder)
    old = cluster.greedy_cluster(s.filter("doc_id % 2 = 0"), 1.0).centroids()
    new = s.filter("doc_id % 2 = 1").select("seqid", "seq")
    found = cluster.cluster_incremental(old.withColumnRenamed("operon_id", "seqid"), new, 1.0)
    return found.members.select("seqid", "centroid", "is_centroid")


@query
def cluster_consensus(spark, folder):
    """Consensus of given clusters of near copies, whose majority has an edit that the centroid may lack."""
    rows = b.near_copies(spark, folder).withColumns({"is_centroid": F.col("seqid").endswith("a"), "edits": F.lit(1)})
    return cluster.consensus_of(rows).select("cluster_id", "operon_id", F.length("seq").alias("n"), F.md5("seq").alias("seq_md5"))


@query
def consensus(spark, folder):
    return cluster.consensus(cluster.greedy_cluster(_seqs(spark, folder), LOOSE))


# --- primers and k-mers -------------------------------------------------------


@query
def insilico_pcr(spark, folder):
    """All products of up to 10,000 bases; primers of eight bases, as shorter ones have sites everywhere."""
    return primers.insilico_pcr(_seqs(spark, folder), b.LONG_PRIMERS)


@query
def primer_yield(spark, folder):
    return _rounded(primers.primer_yield(_seqs(spark, folder), b.SHORT_PRIMERS), "percentage")


@query
def extract_reads(spark, folder):
    s = b.sequences(spark, folder).select("seqid", "seq")
    return primers.extract_reads(s, b.SHORT_PRIMERS, min_len=100, min_identity=1.0)


@query
def extract_reads_tolerant(spark, folder):
    """Reads with the default share of primer mismatches."""
    s = b.sequences(spark, folder).select("seqid", "seq")
    return primers.extract_reads(s, b.SHORT_PRIMERS, min_len=100)


@query
def kmer_counts(spark, folder):
    return kmers.kmer_counts(b.sequences(spark, folder), kmers.WORD, ["lang"])


@query
def nb_classify(spark, folder):
    """Documents sorted into languages by a model of all documents."""
    s = b.sequences(spark, folder).withColumn("model", F.lit("all"))
    counts = kmers.kmer_counts(s, kmers.WORD, ["model", "lang"])
    found = kmers.predict_nb(kmers.train_nb(durable(counts), "model", "lang"), s, "seqid")
    return found.select("seqid", "label", F.round("score", 3).alias("score"))


@query
def ani_pairs(spark, folder):
    # md5 in place of the default hash, since the SQL twin has it too.
    rows = kmers.sketches(b.genomes(spark, folder), hash_fn=lambda w: F.substring(F.md5(w), 1, 16))
    return _rounded(kmers.ani_pairs(kmers.sketch_groups(rows)), "est_ani")
