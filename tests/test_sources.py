"""Readers and writers on small files."""

import glob
import gzip

from rrnlake.functions import ids
from rrnlake.operators import assemblies, sequences
from rrnlake.sources import fasta, gff, sinks, tables
from pyspark.sql import functions as F


def put(path, text):
    opener = gzip.open if str(path).endswith(".gz") else open
    with opener(path, "wt") as f:
        f.write(text)
    return str(path)


def read(folder):
    lines = []
    for name in sorted(glob.glob(f"{folder}/part-*")):
        with (gzip.open if name.endswith(".gz") else open)(name, "rt") as f:
            lines += f.read().splitlines()
    return lines


def test_fasta_files(spark, tmp_path):
    put(tmp_path / "GCF_1.1_ASM1_genomic.fna.gz", ">n1 first > of two\nACGT\nAC\n>n2\nGG\n")
    put(tmp_path / "GCF_2.12_ASM2_genomic.fna", ">n3\r\nac\r\ngt\r\n\n>n4 x\nT")
    df = fasta.read_fasta(spark, str(tmp_path))
    rows = {r.seqid: (r.description, r.seq) for r in df.collect()}
    assert rows == {"n1": ("first > of two", "ACGTAC"), "n2": (None, "GG"), "n3": (None, "acgt"), "n4": ("x", "T")}
    named = assemblies.header_rewrite(df.withColumnRenamed("seqid", "header"))
    assert {r.seqid for r in named.collect()} == {"GCF_1__n1", "GCF_1__n2", "GCF_2__n3", "GCF_2__n4"}


def test_fasta_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("C_2", "ACGT"), ("C_1", "GG")], "operon_id string, seq string")
    fasta.write_fasta(sequences.sort_by_name(df), str(tmp_path / "out"))
    assert read(tmp_path / "out") == [">C_1", "GG", ">C_2", "ACGT"]
    assert fasta.read_fasta(spark, str(tmp_path / "out")).count() == 2


def test_gff_files(spark, tmp_path):
    put(tmp_path / "GCF_7.2_X_genomic.gff.gz", "##gff-version 3\n#!x\nN1\tsrc\trRNA\t5\t9\t.\t-\t.\tID=1;product=a b\n\n")
    (row,) = gff.read_gff3(spark, str(tmp_path), prefix_accession=True).collect()
    assert row.asDict() == {"seqid": "GCF_7__N1", "source": "src", "type": "rRNA", "start": 5, "end": 9, "score": None,
                            "strand": "-", "phase": None, "attributes": "ID=1;product=a b"}


def test_tables(spark, tmp_path):
    cells = ["GCF_1.1"] + ["x"] * 4 + ["77"] + ["x"] * 4 + ["latest", "Complete Genome"] + ["x"] * 7 + ["https://a/b"]
    bad = cells[:]
    bad[0], bad[5], bad[19] = "GCF_2.1", "", "na"
    a = put(tmp_path / "a.txt", "# See\n#assembly_accession\n" + "\t".join(cells) + "\n")
    b = put(tmp_path / "b.txt", "# See\n" + "\t".join(bad) + "\n")
    rows = {r.accession: (r.taxid, r.ftp_path) for r in tables.read_assembly_summary(spark, [a, b]).collect()}
    assert rows == {"GCF_1.1": (77, "https://a/b"), "GCF_2.1": (None, None)}

    arc = put(tmp_path / "ar.tsv", "RS_GCF_1.1\td__A;p__B\n")
    bac = put(tmp_path / "ba.tsv", "RS_GCF_2.1\td__X\nGB_GCA_3.12\td__B;p__C\n")
    tables.write_lineage_union(spark, arc, bac, str(tmp_path / "tax"))
    got = {(r.assembly, r.lineage) for r in tables.read_lineage(spark, str(tmp_path / "tax")).collect()}
    assert got == {("GCF_1", "d__A|p__B"), ("GCF_2", "d__X"), ("GCA_3", "d__B|p__C")}
    tables.write_lineage_union(spark, arc, bac, str(tmp_path / "less"), drop_assembly="RS_GCF_2.1")
    assert {r.assembly for r in tables.read_lineage(spark, str(tmp_path / "less")).collect()} == {"GCF_1", "GCA_3"}

    uc = put(tmp_path / "c.uc", "S\t0\t9\t*\t*\t*\t*\t*\tC_1\t*\nH\t0\t8\t99.9\t+\t0\t0\t=\tC_2\tC_1\nC\t0\t2\t*\t*\t*\t*\t*\tC_1\t*\n")
    assert [tuple(r) for r in tables.read_uc(spark, uc).collect()] == [
        ("S", 0, None, "C_1"), ("H", 0, None, "C_2"), ("C", 0, 2, "C_1")]


def test_taxdump(spark, tmp_path):
    put(tmp_path / "names.dmp", "1\t|\troot\t|\t\t|\tscientific name\t|\n1\t|\tall\t|\t\t|\tsynonym\t|\n")
    put(tmp_path / "nodes.dmp", "1\t|\t1\t|\tno rank\t|\t\t|\n2\t|\t1\t|\tsuperkingdom\t|\t\t|\n")
    put(tmp_path / "merged.dmp", "9\t|\t2\t|\n")
    put(tmp_path / "delnodes.dmp", "5\t|\n")
    d = tables.read_taxdump(spark, str(tmp_path))
    assert [tuple(r) for r in d["names"].collect()] == [(1, "root")]
    assert [tuple(r) for r in d["nodes"].collect()] == [(1, 1, "no rank"), (2, 1, "superkingdom")]
    assert [tuple(r) for r in d["merged"].collect()] == [(9, 2)]
    assert [tuple(r) for r in d["delnodes"].collect()] == [(5,)]


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", None, 1.5), ('say "x"', "b", None)], "x string, y string, z double").coalesce(1)
    sinks.write_tsv(df, str(tmp_path / "t"))
    assert sorted(read(tmp_path / "t")) == sorted(["x\ty\tz", "a\tNA\t1.5", 'say "x"\tb\tNA'])
    sinks.write_gff(df, str(tmp_path / "g"))
    assert len(read(tmp_path / "g")) == 2
    seqs = spark.createDataFrame([("C_1", "AC")], "operon_id string, seq string")
    tax = spark.createDataFrame([("C_1", "d__B")], "operon_id string, lineage string")
    sinks.release_layout({"full": seqs, "nr_rep": seqs, "tax_rep": tax, "copy_number_stats": df}, str(tmp_path / "db"))
    assert read(tmp_path / "db/NR/taxRep.tsv") == ["C_1\td__B"]
    assert read(tmp_path / "db/Full/full.fna.gz") == [">C_1", "AC"]
    union = sinks.export_union({("GTDB", "Complete"): tax, ("NCBI", "Complete"): seqs})
    sinks.write_export(union, str(tmp_path / "exp"))
    assert spark.read.parquet(str(tmp_path / "exp")).filter("taxonomy_system = 'NCBI'").collect()[0].lineage is None


def test_id_rules(spark):
    df = spark.createDataFrame([("RS_GCF_000005845.2",), ("GB_GCA_1.12",), ("GCF_3",)], "a string")
    got = [r[0] for r in df.select(ids.strip_version(ids.strip_source_prefix(F.col("a")))).collect()]
    assert got == ["GCF_000005845", "GCA_1", "GCF_3"]
    n = spark.createDataFrame([(7,), (123456789,)], "n long")
    assert [r[0] for r in n.select(ids.pad_id(F.col("n"), F.lit("C_"))).collect()] == ["C_00000007", "C_123456789"]
    p = spark.createDataFrame([("Genomes_Complete/GCF_1.fna.gz",)], "p string")
    assert p.select(ids.strip_path(F.col("p"))).first()[0] == "GCF_1"


def test_extract_both_join_paths(spark, monkeypatch):
    seqs = spark.createDataFrame([("s", "AACCGGTTNN"), ("u", "ACGT")], "seqid string, seq string")
    regions = spark.createDataFrame(
        [("o1", "s", 3, 6, "+"), ("o2", "s", 1, 4, "-"), ("o3", "gone", 1, 2, "+")],
        "operon_id string, seqid string, start long, end long, strand string")
    want = {("o1", "CCGG"), ("o2", "GGTT")}
    assert {tuple(r) for r in sequences.extract_regions(regions, seqs).collect()} == want
    from rrnlake.plans import sizing
    monkeypatch.setattr(sequences, "broadcast_if_small", lambda df: sizing.broadcast_if_small(df, 1))
    assert {tuple(r) for r in sequences.extract_regions(regions, seqs).collect()} == want
