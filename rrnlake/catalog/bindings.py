"""The given tables in the schemas the operators read.

Each function takes (spark, folder) and returns a lazy DataFrame over whole tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from rrnlake.config import COMPLETE, INCOMPLETE
from rrnlake.plans.sizing import spread

# Letters of the documents mapped to bases.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
BASES = "ACGTACGTACGTACGTACGTACGTAC"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def accession(number: Column) -> Column:
    return F.concat(F.lit("GCF_"), F.lpad(number.cast("string"), 9, "0"))


def _set(flag: Column) -> Column:
    return F.when(flag, COMPLETE).otherwise(INCOMPLETE)


def features(spark: SparkSession, folder: str) -> DataFrame:
    """events as annotation rows: genome_set, seqid, type, start, end, strand, attributes."""
    e = table(spark, folder, "events")
    number = F.expr("user_id div 3")
    start = F.expr("timestampdiff(MINUTE, TIMESTAMP_NTZ'2024-01-01 00:00:00', ts)") + 1
    product = (
        F.when(F.col("event_type") == "view", "16S ribosomal RNA")
        .when(F.col("event_type") == "purchase", "23S ribosomal RNA")
        .when(F.col("event_type") == "error", "16S ribosomal RNA")
        .otherwise("5S ribosomal RNA")
    )
    lead = F.when(F.col("event_type") == "error", ";partial=true;product=").otherwise(";product=")
    return e.select(
        _set(number % 2 == 0).alias("genome_set"),
        F.concat(accession(number), F.lit("__NZ_"), F.col("user_id")).alias("seqid"),
        F.when(F.col("event_type") == "signup", "tRNA").otherwise("rRNA").alias("type"),
        start.cast("bigint").alias("start"),
        (start + F.round("value")).cast("bigint").alias("end"),
        F.when(F.col("event_id") % 3 == 0, "-").otherwise("+").alias("strand"),
        F.concat(F.lit("ID=rna-"), F.col("event_id"), lead, product).alias("attributes"),
    )


def all_contigs(spark: SparkSession, folder: str) -> DataFrame:
    """Length per contig with its genome set."""
    return features(spark, folder).groupBy("genome_set", "seqid").agg(F.max("end").alias("length"))


def contigs(spark: SparkSession, folder: str) -> DataFrame:
    """The contig lengths that quality control gets; some are missing on purpose, to test its rule for them."""
    number = F.substring_index("seqid", "__NZ_", -1).cast("bigint")
    return all_contigs(spark, folder).filter(number % 25 != 24)


def lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Seven-rank lineages of customer assemblies."""
    c = table(spark, folder, "customer")
    n = table(spark, folder, "nation")
    r = table(spark, folder, "region")
    key = F.col("c_custkey")
    return (
        c.join(n, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            accession(key).alias("assembly"),
            F.concat_ws(
                "|",
                F.concat(F.lit("d__"), "r_name"), F.concat(F.lit("p__"), "n_name"),
                F.concat(F.lit("c__"), "c_mktsegment"), F.concat(F.lit("o__O"), key % 7),
                F.concat(F.lit("f__F"), key % 5), F.concat(F.lit("g__G"), key % 3), F.concat(F.lit("s__S"), key),
            ).alias("lineage"),
        )
    )


def lineage_eight(spark: SparkSession, folder: str) -> DataFrame:
    """The same lineages with the k__ top rank and a strain."""
    text = F.concat(F.regexp_replace("lineage", "^d__", "k__"), F.lit("|t__"), F.substring("assembly", 5, 9))
    return lineage(spark, folder).withColumn("lineage", text)


def lineage_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Lineages as they come in a taxonomy file: prefixed, versioned, ';' joined."""
    number = F.substring("assembly", 5, 9).cast("bigint")
    source = F.when(number % 2 == 0, "RS_").otherwise("GB_")
    return lineage(spark, folder).select(
        F.concat(
            source, "assembly", F.lit("."), (number % 12 + 1).cast("string"), F.lit("\t"),
            F.translate("lineage", "|", ";"),
        ).alias("value")
    )


def sequences(spark: SparkSession, folder: str) -> DataFrame:
    """documents as sequences over ACGT, whole texts."""
    d = spread(table(spark, folder, "documents").select("doc_id", "text", "lang", "source"), "doc_id")
    seq = F.translate(F.regexp_replace(F.lower("text"), "[^a-z]", ""), LETTERS, BASES)
    return d.select(
        "doc_id", F.concat(F.lit("DOC"), F.col("doc_id")).alias("seqid"), "lang", "source", seq.alias("seq")
    )


def near_copies(spark: SparkSession, folder: str) -> DataFrame:
    """Clusters of near copies: every sequence and, from 40 bases on, a copy with an edit and that copy without two bases.

    The edit, by doc_id: another base, a base less, or a base more, at a place inside. (cluster_id, seqid, seq, copies).
    """
    s = sequences(spark, folder).select("doc_id", "seq").withColumn("n", F.octet_length("seq"))
    at = F.lit(15) + F.pmod(F.col("doc_id") * 37, F.greatest(F.col("n") - 30, F.lit(1)))  # bases before the edit
    s = s.withColumn("at", at.cast("int"))
    own = F.substring("seq", F.col("at") + 1, F.lit(1))
    other = F.translate(own, "ACGT", "CGTA")
    base = F.when(F.col("doc_id") % 3 == 0, other).when(F.col("doc_id") % 3 == 1, "").otherwise(F.concat(own, other))
    edited = F.concat(F.substring("seq", F.lit(1), F.col("at")), base, F.substring("seq", F.col("at") + 2, F.col("n")))
    copies = s.select("doc_id", "seq", edited.alias("edited"))
    made = F.explode(F.array(
        F.struct(F.lit("a").alias("kind"), F.col("seq").alias("seq")),
        F.struct(F.lit("b").alias("kind"), F.col("edited").alias("seq")),
        F.struct(F.lit("c").alias("kind"), F.substring("edited", F.lit(3), F.length("edited")).alias("seq"))))
    return copies.select("doc_id", made.alias("m"), F.octet_length("seq").alias("n")).filter("m.kind = 'a' or n >= 40").select(
        F.col("doc_id").alias("cluster_id"), F.concat(F.lit("DOC"), F.col("doc_id"), "m.kind").alias("seqid"), "m.seq", F.lit(1).cast("bigint").alias("copies"))


def cut_regions(spark: SparkSession, folder: str) -> DataFrame:
    """One region per sequence that is long enough: (operon_id, seqid, start, end, strand)."""
    s = sequences(spark, folder).withColumn("n", F.octet_length("seq").cast("bigint"))
    start = F.col("doc_id") % 50 + 1
    return s.filter(F.col("n") >= start).select(
        F.concat(F.lit("C_"), F.lpad(F.col("doc_id").cast("string"), 8, "0")).alias("operon_id"),
        "seqid",
        start.alias("start"),
        F.least(start + 199, "n").alias("end"),
        F.when(F.col("doc_id") % 2 == 0, "-").otherwise("+").alias("strand"),
    )


def cluster_rows(spark: SparkSession, folder: str) -> DataFrame:
    """lineitem as cluster members: (cluster_id, operon_id, assembly)."""
    li = spread(
        table(spark, folder, "lineitem").select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", "l_linestatus",
            "l_extendedprice", "l_quantity", "l_shipdate", "l_discount", "l_tax",
        ),
        "l_orderkey", "l_partkey",
    )
    flag = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint")
    return li.select(
        (F.col("l_orderkey") * 3 + flag).alias("cluster_id"),
        F.concat(
            F.when(F.col("l_linestatus") == "F", "C_").otherwise("U_"),
            F.concat_ws(
                ".", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_returnflag", cents,
                F.round("l_quantity").cast("bigint"), F.unix_date(F.col("l_shipdate").cast("date")),
                F.round(F.col("l_discount") * 100).cast("bigint"), F.round(F.col("l_tax") * 100).cast("bigint"),
            ),
        ).alias("operon_id"),
        accession(F.col("l_suppkey")).alias("assembly"),
    )


def operon_assemblies(spark: SparkSession, folder: str) -> DataFrame:
    return cluster_rows(spark, folder).select("operon_id", "assembly")


def cluster_records(spark: SparkSession, folder: str) -> DataFrame:
    """S, H and C records: the first operon id of a cluster is its centroid."""
    rows = cluster_rows(spark, folder).select("cluster_id", "operon_id")
    # Rows move once, and each looks only at the one before it and at the first.
    order = Window.partitionBy("cluster_id").orderBy("operon_id")
    placed = rows.select(
        "cluster_id", "operon_id", F.lag(F.lit(1)).over(order).isNull().alias("_first"),
        F.first("operon_id").over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("_head"),
    )
    nothing = F.lit(None).cast("bigint")
    members = placed.filter(F.col("_first") | (F.col("operon_id") != F.col("_head"))).select(
        F.when(F.col("_first"), "S").otherwise("H").alias("rec_type"), "cluster_id", nothing.alias("size"),
        F.col("operon_id").alias("query"))
    sums = placed.groupBy("cluster_id").agg(F.count("*").alias("size"), F.max(F.when(F.col("_first"), F.col("operon_id"))).alias("query"))
    return members.unionByName(sums.select(F.lit("C").alias("rec_type"), "cluster_id", "size", "query"))


def member_lineage(spark: SparkSession, folder: str) -> DataFrame:
    """Lineages of supplier assemblies; phyla are shared by both domains, some species are missing."""
    s = table(spark, folder, "supplier")
    nk = F.col("s_nationkey")
    species = F.when(F.col("s_suppkey") % 10 != 9, F.concat(F.lit("s__"), F.col("s_suppkey")))
    return s.select(
        accession(F.col("s_suppkey")).alias("assembly"),
        F.concat_ws(
            "|",
            F.when(nk < 20, "d__Bacteria").otherwise("d__Archaea"), F.concat(F.lit("p__"), nk % 5),
            F.concat(F.lit("c__"), nk), F.concat(F.lit("o__"), nk), F.concat(F.lit("f__"), nk),
            F.concat(F.lit("g__"), nk), species,
        ).alias("lineage"),
    )


def member_lineage_eight(spark: SparkSession, folder: str) -> DataFrame:
    text = F.concat(F.regexp_replace("lineage", "^d__", "k__"), F.lit("|t__"), F.col("assembly"))
    return member_lineage(spark, folder).withColumn("lineage", text)


def assemblies(spark: SparkSession, folder: str) -> DataFrame:
    """orders as an assembly summary."""
    o = table(spark, folder, "orders")
    key = F.col("o_orderkey")
    full = F.concat(accession(key), F.lit("."), key % 12 + 1)
    level = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "Complete Genome")
        .when(F.col("o_orderpriority") == "2-HIGH", "Chromosome")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "Scaffold")
        .otherwise("Contig")
    )
    merged = F.col("o_custkey") < 10
    return o.select(
        full.alias("accession"),
        F.when(merged, F.col("o_custkey") + 900000).otherwise(F.col("o_custkey") + 10000).alias("taxid"),
        F.when(F.col("o_orderstatus") != "F", "latest").otherwise("replaced").alias("version_status"),
        level.alias("assembly_level"),
        F.when(
            key % 13 != 0,
            F.concat(F.lit("https://ftp.example/genomes/all/GCF/000/000/001/"), full, F.lit("_ASM"), key),
        ).alias("ftp_path"),
        "o_orderkey",
    )


def summary_lines(spark: SparkSession, folder: str) -> DataFrame:
    """The assembly summary as the twenty column text it comes in."""
    pad = F.lit("x")
    a = assemblies(spark, folder)
    cells = [
        "accession", *[pad] * 4, F.col("taxid").cast("string"), *[pad] * 4, "version_status", "assembly_level",
        *[pad] * 7, F.coalesce("ftp_path", F.lit("na")),
    ]
    head = F.when(F.col("o_orderkey") % 1000 == 0, F.array(F.lit("# assembly_accession"), F.concat_ws("\t", *cells)))
    return a.select(F.explode(F.coalesce(head, F.array(F.concat_ws("\t", *cells)))).alias("value"))


def listed_accessions(spark: SparkSession, folder: str) -> DataFrame:
    """Accessions a taxonomy lists: those of orders with a returned item, and some unknown ones."""
    li = table(spark, folder, "lineitem").filter(F.col("l_returnflag") != "N").select("l_orderkey").distinct()
    key = F.col("l_orderkey")
    return li.select(F.concat(accession(key), F.lit("."), F.when(key % 17 == 0, 99).otherwise(key % 12 + 1)).alias("accession"))


def annotated(spark: SparkSession, folder: str) -> DataFrame:
    key = F.col("l_orderkey")
    li = table(spark, folder, "lineitem").select("l_orderkey").distinct()
    return li.select(F.concat(accession(key), F.lit("."), key % 12 + 1).alias("accession"))


def taxonomy_tree(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """Regions, nations and customers as a taxonomy dump."""
    r, n, c = (table(spark, folder, t) for t in ("region", "nation", "customer"))
    root = r.filter("r_regionkey = 0").select(F.lit(1).cast("bigint"), F.lit(1).cast("bigint"), F.lit("no rank"), F.lit("root"))
    every = (
        root.toDF("tax_id", "parent_id", "rank", "name")
        .union(r.select(F.col("r_regionkey").cast("bigint") + 10, F.lit(1).cast("bigint"), F.lit("domain"), "r_name"))
        .union(n.select(F.col("n_nationkey").cast("bigint") + 100, F.col("n_regionkey").cast("bigint") + 10, F.lit("phylum"), "n_name"))
        .union(c.select(F.col("c_custkey") + 10000, F.col("c_nationkey").cast("bigint") + 100, F.lit("species"), "c_name"))
    )
    old = c.filter("c_custkey < 10").select(
        (F.col("c_custkey") + 900000).alias("old_id"), (F.col("c_custkey") + 10000).alias("new_id")
    )
    return {"nodes": every.select("tax_id", "parent_id", "rank"), "names": every.select("tax_id", "name"), "merged": old}


# Short primers that the document sequences contain (name, forward, reverse).
SHORT_PRIMERS = [("P1", "ACGTR", "YACG"), ("P2", "GGNA", "TTRC")]
# Primers of eight bases, rare enough for products of the reference's length.
LONG_PRIMERS = [("L1", "CACNCGYA", "TAGGNTAR"), ("L2", "CACCACTA", "AGTGYATT")]


def genomes(spark: SparkSession, folder: str) -> DataFrame:
    """documents as genomes: each source in runs of 200 documents."""
    run = F.expr("doc_id div 200").cast("string")
    return sequences(spark, folder).select(F.concat_ws("_", "source", run).alias("genome"), "seq")
