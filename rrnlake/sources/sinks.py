"""Table sinks and the release layout."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rrnlake.sources.fasta import write_fasta


def write_tsv(df: DataFrame, path: str, header: bool = True, na: str = "NA", compression: str = "none") -> None:
    """Unquoted TSV; NULL is written as `na`."""
    (
        df.write.mode("overwrite")
        .option("sep", "\t")
        .option("quote", "")
        .option("escape", "")
        .option("nullValue", na)
        .option("emptyValue", "")
        .option("header", header)
        .option("compression", compression)
        .csv(path)
    )


def write_gff(df: DataFrame, path: str) -> None:
    """Headerless GFF-like file of operon or ITS regions."""
    write_tsv(df, path, header=False)


def write_master(operons: DataFrame, path: str) -> None:
    """The operon table with header, one folder per genome set."""
    operons.write.mode("overwrite").partitionBy("genome_set").option("sep", "\t").option(
        "quote", ""
    ).option("nullValue", "NA").option("header", True).csv(path)


# Where each table of a release goes.
RELEASE_TABLES = {
    "tax_full": "Full/taxFull.tsv",
    "tax_rep": "NR/taxRep.tsv",
    "tax_lca": "NR/taxLCA.tsv",
    "tax_maj": "NR/taxMaj.tsv",
    "genome_length_stats": "stats_genomelength.tsv",
    "copy_number_stats": "stats_copynumber.tsv",
}
RELEASE_SEQUENCES = {
    "full": "Full/full.fna.gz",
    "nr_rep": "NR/nrRep.fna.gz",
    "nr_con": "NR/nrCon.fna.gz",
}


def release_layout(tables: dict[str, DataFrame], root: str) -> list[str]:
    """Write a database release: sequences and taxonomies under Full/ and NR/, statistics at the root.

    Sequence tables have (operon_id, seq) and are sorted by name; taxonomy tables
    have (operon_id, lineage) and no header; statistics have a header.
    """
    written = []
    for name, df in tables.items():
        if name in RELEASE_SEQUENCES:
            path = f"{root}/{RELEASE_SEQUENCES[name]}"
            write_fasta(df.orderBy("operon_id"), path)
        else:
            path = f"{root}/{RELEASE_TABLES[name]}"
            write_tsv(df, path, header=name.endswith("_stats"))
        written.append(path)
    return written


def export_union(tables: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Tables of several builds as one, with their origin as columns.

    Keys are (taxonomy_system, genome_set). Columns a table lacks are NULL.
    """
    out = None
    for (system, genome_set), df in tables.items():
        part = df.withColumns({"taxonomy_system": F.lit(system), "genome_set": F.lit(genome_set)})
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError("no tables given")
    return out


def write_export(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("taxonomy_system", "genome_set").parquet(path)
