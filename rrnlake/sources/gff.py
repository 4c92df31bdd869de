"""GFF3 in, GFF-like tables out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rrnlake.functions.ids import accession_from_file, ID_SEP

# The nine GFF3 columns in order.
GFF_COLUMNS = ("seqid", "source", "type", "start", "end", "score", "strand", "phase", "attributes")


def parse_gff(lines: DataFrame, line: str = "value") -> DataFrame:
    """GFF3 lines to the nine columns; comments are dropped and '.' is NULL."""
    cells = F.split(line, "\t")
    rest = [c for c in lines.columns if c != line]

    def cell(i: int, name: str) -> Column:
        text = F.try_element_at(cells, F.lit(i + 1))
        if name in ("start", "end"):
            return text.cast("bigint").alias(name)
        return F.when(text != ".", text).alias(name)

    kept = lines.filter(~F.col(line).startswith("#") & (F.length(line) > 0))
    return kept.select(*rest, *[cell(i, n) for i, n in enumerate(GFF_COLUMNS)])


def read_gff3(spark: SparkSession, path: str | list[str], prefix_accession: bool = False) -> DataFrame:
    """GFF3 files, plain or gz. With prefix_accession, seqids become ACC__SEQID by file name."""
    raw = spark.read.text(path)
    if not prefix_accession:
        return parse_gff(raw.select("value"))
    named = raw.select(accession_from_file(F.col("_metadata.file_path")).alias("accession"), "value")
    return (
        parse_gff(named)
        .withColumn("seqid", F.concat_ws(ID_SEP, "accession", "seqid"))
        .drop("accession")
    )


def features(gff: DataFrame) -> DataFrame:
    """The columns the operon operators use."""
    return gff.select("seqid", "type", "start", "end", "strand", "attributes")
