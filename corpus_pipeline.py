"""A corpus from raw documents to piece ids: quality, line dedup, SimHash near-dedup, source mix, encoding.

STAGES lists (name, function); a function takes (spark, docs, sf_dir), docs being what the stage before kept, and all but
the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rrnlake.llm import linedup, mixing, quality, segmentation, simhash
from rrnlake.llm.common import staged, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier does not reject."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, model)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without runs of lines that occur earlier."""
    return linedup.dedup_lines(docs).drop("deleted_lines")


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component: SimHash of three-word shingles, linked at three or fewer differing bits.

    Texts without words have fingerprint zero and are one component; rows without a doc_id all stay.
    """
    return simhash.keep_one(docs, most=3, shingle=3)


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.apply_mix(docs)


def encode_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the best segmentation, their number, and the scores of the four best."""
    encoded = segmentation.encode_nbest(docs)
    return encoded.select("doc_id", F.size("ids").alias("n_pieces"), "ids", F.col("nbest.score").alias("scores"))


STAGES = [
    ("quality classifier", quality_stage),
    ("line dedup", line_stage),
    ("simhash near-dedup", near_stage),
    ("mixing sources", mix_stage),
    ("sentencepiece encoding", encode_stage),
]

# Compression, window minima and segmentation are not for SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet and read again. Runs jobs."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
