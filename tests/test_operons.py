"""Hand-made rows for the operon rules, and checks that order and size do not change them."""

from pyspark.sql import functions as F

from rrnlake.operators import operons
from rrnlake.plans import ordering

GFF = "genome_set string, seqid string, type string, start long, end long, strand string, attributes string"


def gene(seqid, start, end, strand, product, extra="", genome_set="Complete", kind="rRNA"):
    return (genome_set, seqid, kind, start, end, strand, f"ID=r{start};{extra}product={product}")


S, L = "16S ribosomal RNA", "23S ribosomal RNA"


def build(spark, rows, lengths):
    features = spark.createDataFrame(rows, GFF).orderBy(F.rand(3))
    contigs = spark.createDataFrame(lengths, "seqid string, length long")
    return operons.build_operons(features, contigs)


def test_pairing_rules(spark):
    rows = [
        gene("A__1", 100, 1600, "+", S), gene("A__1", 2000, 4900, "+", L),              # plus pair
        gene("A__1", 10000, 12900, "-", "23S Ribosomal RNA"), gene("A__1", 13300, 14800, "-", "16S Ribosomal RNA"),
        gene("A__2", 50, 1500, "+", S),                                                  # last row of its contig
        gene("A__3", 50, 2950, "+", L), gene("A__3", 3000, 4500, "-", S),               # strands differ
        gene("B__1", 10, 1500, "+", S), gene("B__1", 1600, 1700, "+", "5S ribosomal RNA"),
        gene("B__1", 1800, 4700, "+", "ribosomal RNA-23S"),                              # 5S between does not count
        gene("C__1", 10, 1500, "+", S, "partial=true;"), gene("C__1", 1800, 4700, "+", L),
        gene("D__1", 10, 1500, "+", S + ";note=x"), gene("D__1", 1800, 4700, "+", L),    # text after product
        gene("E__1", 10, 1500, ".", S), gene("E__1", 1800, 4700, ".", L),                # no strand
        gene("F__1", 10, 1500, "+", S, kind="tRNA"), gene("F__1", 1800, 4700, "+", L),
        gene("G__1", 10, 1500, "+", S), gene("G__1", 1500, 3000, "+", S), gene("G__1", 3100, 6000, "+", L),
    ]
    out = build(spark, rows, [("A__1", 90000), ("B__1", 90000), ("G__1", 90000)])
    got = {(r.seqid, r.start_16s): (r.operon_id, r.start_23s, r.its_length) for r in out.collect()}
    assert got == {
        ("A__1", 100): ("C_00000001", 2000, 400),
        ("A__1", 13300): ("C_00000002", 10000, 400),
        ("B__1", 10): ("C_00000003", 1800, 300),
        ("G__1", 1500): ("C_00000004", 3100, 100),
    }


def test_quality_rules(spark):
    def pair(seqid, start, its, genome_set="Incomplete"):
        end = start + 1499
        return [gene(seqid, start, end, "+", S, genome_set=genome_set),
                gene(seqid, end + its, end + its + 2900, "+", L, genome_set=genome_set)]

    rows = (pair("A__ok", 10, 1500) + pair("A__far", 10, 1501) + pair("A__one", 1, 300) + pair("A__end", 10, 300)
            + pair("A__past", 10, 300) + pair("A__nolen", 10, 300) + pair("A__nolen1", 1, 300)
            + pair("A__nolenfar", 10, 1600) + pair("B__c", 10, 300, "Complete"))
    end = 10 + 1499 + 300 + 2900
    lengths = [("A__ok", 99999), ("A__far", 99999), ("A__one", 99999), ("A__end", end), ("A__past", end + 1), ("B__c", 9999)]
    out = build(spark, rows, lengths)
    good = {r.seqid for r in operons.good_operons(out).collect()}
    bad = {r.seqid for r in operons.rejected_operons(out).collect()}
    assert good == {"A__ok", "A__past", "B__c"}
    # A linked operon on a contig of unknown length is in neither table.
    assert bad == {"A__far", "A__one", "A__end", "A__nolen1", "A__nolenfar"}
    ids = {r.operon_id for r in out.collect()}
    assert ids == {f"U_{i:08d}" for i in range(1, 9)} | {"C_00000001"}


def test_regions(spark):
    rows = [gene("A__1", 100, 1600, "+", S), gene("A__1", 2000, 4900, "+", L),
            gene("A__1", 10000, 12900, "-", L), gene("A__1", 13300, 14800, "-", S)]
    master = operons.good_operons(build(spark, rows, [("A__1", 90000)]))
    its = {(r.seqid_operon, r.start, r.end) for r in operons.its_regions(master).collect()}
    assert its == {("A__1 C_00000001", 1600, 2000), ("A__1 C_00000002", 12900, 13300)}
    whole = {(r.seqid, r.start, r.end) for r in operons.operon_regions(master).collect()}
    assert whole == {("A__1", 100, 4900), ("A__1", 10000, 14800)}


def test_order_helpers_over_block_edges(spark):
    rows = spark.range(100).select((F.col("id") * 7 % 101).alias("v"), F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("g"))
    placed = ordering.dense_index(rows.repartition(7), [F.col("v")], "place")
    near = ordering.with_neighbours(placed, "place", ["v"], block=8).orderBy("place").collect()
    values = sorted(r.v for r in rows.collect())
    assert [r.v for r in near] == values and [r.place for r in near] == list(range(1, 101))
    assert [r.prev.v if r.prev else None for r in near] == [None] + values[:-1]
    assert [r.next.v if r.next else None for r in near] == values[1:] + [None]
    numbered = ordering.number_within(placed, "g", "place", "n", block=8).orderBy("place").collect()
    seen = {"a": 0, "b": 0}
    for r in numbered:
        seen[r.g] += 1
        assert r.n == seen[r.g]
