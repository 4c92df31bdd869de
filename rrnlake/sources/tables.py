"""Readers for the delimited tables: assembly summaries, lineages, taxonomy dumps, cluster records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rrnlake.functions.ids import strip_source_prefix, strip_version
from rrnlake.functions.lineage import recode_sep


def _cells(line: str, places: dict[str, int], sep: str = "\t") -> list[Column]:
    cells = F.split(line, sep)
    return [F.try_element_at(cells, F.lit(i)).alias(name) for name, i in places.items()]


def parse_assembly_summary(lines: DataFrame, line: str = "value") -> DataFrame:
    """Summary lines to the columns in use; header lines start with '#'. Empty cells and 'na' are NULL."""
    # Places of the columns in the summary file.
    places = {"accession": 1, "taxid": 6, "version_status": 11, "assembly_level": 12, "ftp_path": 20}
    rows = lines.filter(~F.col(line).startswith("#")).select(*_cells(line, places))
    return rows.select(
        *[
            F.when(~F.col(c).isin("", "na"), F.col(c)).cast("bigint" if c == "taxid" else "string").alias(c)
            for c in places
        ]
    )


def read_assembly_summary(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """One or more summary files (archaea and bacteria) as one table."""
    return parse_assembly_summary(spark.read.text(paths))


def parse_lineage(lines: DataFrame, line: str = "value") -> DataFrame:
    """Headerless accession / lineage lines to (assembly, lineage) with '|' between ranks."""
    accession, lineage = _cells(line, {"a": 1, "l": 2})
    return lines.select(
        strip_version(strip_source_prefix(accession)).alias("assembly"),
        recode_sep(lineage).alias("lineage"),
    )


def read_lineage(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    return parse_lineage(spark.read.text(paths))


def write_lineage_union(
    spark: SparkSession, archaea: str, bacteria: str, path: str, drop_assembly: str | None = None
) -> None:
    """Archaea lines, then bacteria lines, as one file set.

    The lineage files have no header, so every line is a genome. drop_assembly
    leaves out the bacteria line of that first column, as the original data set
    does with the first genome of its file.
    """
    lines = spark.read.text(bacteria)
    if drop_assembly is not None:
        lines = lines.filter(F.substring_index("value", "\t", 1) != drop_assembly)
    spark.read.text(archaea).unionByName(lines).write.mode("overwrite").text(path)


def _dump(spark: SparkSession, path: str, places: dict[str, int]) -> DataFrame:
    """A taxonomy dump file: cells between '\\t|\\t', each line closed by '\\t|'."""
    raw = spark.read.text(path).select(F.regexp_replace("value", r"\t\|$", "").alias("value"))
    return raw.select(*_cells("value", places, r"\t\|\t"))


def read_taxdump(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    """names (scientific only), nodes, merged and delnodes of a taxonomy dump folder."""
    names = _dump(spark, f"{folder}/names.dmp", {"tax_id": 1, "name": 2, "class": 4})
    nodes = _dump(spark, f"{folder}/nodes.dmp", {"tax_id": 1, "parent_id": 2, "rank": 3})
    merged = _dump(spark, f"{folder}/merged.dmp", {"old_id": 1, "new_id": 2})
    deleted = _dump(spark, f"{folder}/delnodes.dmp", {"tax_id": 1})
    big = {c: F.col(c).cast("bigint") for c in ("tax_id", "parent_id", "old_id", "new_id")}

    def typed(df: DataFrame) -> DataFrame:
        return df.select(*[big[c].alias(c) if c in big else F.col(c) for c in df.columns])

    return {
        "names": typed(names).filter(F.col("class") == "scientific name").select("tax_id", "name"),
        "nodes": typed(nodes),
        "merged": typed(merged),
        "delnodes": typed(deleted),
    }


def parse_uc(lines: DataFrame, line: str = "value") -> DataFrame:
    """Cluster record lines to (rec_type, cluster_id, size, query); size is set on C records."""
    # Places of the columns in a ten column cluster record.
    places = {"rec_type": 1, "cluster_id": 2, "size": 3, "query": 9}
    rows = lines.select(*_cells(line, places))
    return rows.select(
        "rec_type",
        F.col("cluster_id").cast("bigint").alias("cluster_id"),
        F.when(F.col("rec_type") == "C", F.col("size").cast("bigint")).alias("size"),
        "query",
    )


def read_uc(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return parse_uc(spark.read.text(path))


def uc_lines(records: DataFrame) -> DataFrame:
    """Cluster records as ten column lines, cells that are not kept written as '*'."""
    star = F.lit("*")
    size = F.coalesce(F.col("size").cast("string"), star)
    cells = ["rec_type", F.col("cluster_id").cast("string"), size, *[star] * 5, "query", star]
    return records.select(F.concat_ws("\t", *cells).alias("value"))


def read_primers(spark: SparkSession, path: str) -> list[tuple[str, str, str]]:
    """Primer pairs (name, forward, reverse) from a TSV: they are parameters of a plan, so they are read to the driver."""
    rows = spark.read.text(path).select(*_cells("value", {"pair": 1, "fwd": 2, "rev": 3})).collect()
    return [(r.pair, r.fwd, r.rev) for r in rows]
