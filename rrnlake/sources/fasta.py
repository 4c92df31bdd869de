"""FASTA in and out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rrnlake.functions.ids import first_word


def parse_fasta(records: DataFrame, record: str = "value") -> DataFrame:
    """Records `>header\\nlines` to seqid, description, seq; other columns are kept."""
    body = F.regexp_replace(record, "^>", "")
    header = F.rtrim(F.regexp_replace(F.substring_index(body, "\n", 1), "\r", ""))
    lines = F.substring(body, F.length(F.substring_index(body, "\n", 1)) + 2, F.length(body))
    rest = [c for c in records.columns if c != record]
    return records.filter(F.length(F.trim(F.col(record))) > 0).select(
        *rest,
        first_word(header).alias("seqid"),
        F.when(F.instr(header, " ") > 0, _after_space(header)).alias("description"),
        F.translate(lines, "\n\r\t ", "").alias("seq"),
    )


def _after_space(header: Column) -> Column:
    return F.substring(header, F.instr(header, " ") + 1, F.length(header))


def read_fasta(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Many multi-FASTA files, plain or gz, as (file, seqid, description, seq).

    A record ends at a line that starts with '>', so headers may contain '>'.
    Plain files are split and read in parallel; a gz file is one task.
    """
    raw = spark.read.option("lineSep", "\n>").text(path)
    return parse_fasta(raw.select(F.col("_metadata.file_path").alias("file"), "value"))


def fasta_record(seqid: Column, seq: Column) -> Column:
    return F.concat(F.lit(">"), seqid, F.lit("\n"), seq)


def write_fasta(df: DataFrame, path: str, seqid: str = "operon_id", seq: str = "seq") -> None:
    """One gz file per partition, in the order df has."""
    (
        df.select(fasta_record(F.col(seqid), F.col(seq)).alias("value"))
        .write.mode("overwrite")
        .option("compression", "gzip")
        .text(path)
    )
