"""Quality from compression: a text that a dictionary of good text compresses better than one of bad text is good.

Two zstandard dictionaries are trained, one per label. A text is cut into blocks, each block is compressed with either
dictionary, and (bad - good) / (bad + good) over the summed sizes is turned into a probability by a logistic curve that is
fitted to labelled rows which the dictionaries have not seen.
"""

from __future__ import annotations

import random
import sys
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

FOLDS = 5  # fold 0 is held out, fold 1 calibrates, the others make the dictionaries


@dataclass(frozen=True)
class QualityRules:
    """The fit is bounded: at most dictionary_rows documents per label, of each at most blocks_per_row blocks of
    sample_bytes spread over its text, and calibration_rows whole documents for the curve. Scoring has no bounds."""

    dictionary_rows: int = 4000
    blocks_per_row: int = 4
    sample_bytes: int = 2048
    calibration_rows: int = 6000
    dictionary_bytes: int = 112_640
    block_bytes: int = 512
    level: int = 3
    threshold: float = 0.3


@dataclass(frozen=True)
class QualityModel:
    """Dictionaries as bytes and the curve 1 / (1 + exp(-(slope * difference + offset))).

    Without a dictionary for either label, all texts score the share of label 1, or 0.5 without labels.
    """

    good: bytes = b""
    bad: bytes = b""
    slope: float = 0.0
    offset: float = 0.0
    rules: QualityRules = field(default_factory=QualityRules)


def fold(doc_id: Column) -> Column:
    """CRC-32 of the id as text, modulo the folds; a null id counts as empty text."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(FOLDS)).cast("int")


def _compressor(dictionary: bytes, rules: QualityRules) -> zstandard.ZstdCompressor:
    shared = zstandard.ZstdCompressionDict(dictionary)
    shared.precompute_compress(level=rules.level)
    return zstandard.ZstdCompressor(
        level=rules.level, dict_data=shared, write_content_size=False, write_checksum=False, write_dict_id=False)


class Differences:
    """Normalised compressed-size difference of texts, from -1 (like bad text) to 1 (like good text)."""

    def __init__(self, model: QualityModel):
        self.model = model
        self.pair = [_compressor(d, model.rules) for d in (model.good, model.bad)] if model.good and model.bad else []

    def __call__(self, text: str | None) -> float:
        data = (text or "").encode("utf-8", "replace")
        if not data or not self.pair:
            return 0.0
        step = self.model.rules.block_bytes
        blocks = [data[i : i + step] for i in range(0, len(data), step)]
        good, bad = (sum(len(c.compress(b)) for b in blocks) for c in self.pair)
        return (bad - good) / (bad + good)


def _difference_udf(model: QualityModel):
    @F.pandas_udf("double")
    def difference(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        measure = Differences(model)
        for batch in texts:
            yield pd.Series([measure(t) for t in batch], dtype="float64")

    return difference


def score(text: Column, model: QualityModel) -> Column:
    """Probability of label 1 for whole texts; null counts as empty, and empty texts have difference 0."""
    line = _difference_udf(model)(text) * F.lit(model.slope) + F.lit(model.offset)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-line))


def _sampled(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, quality) of the `rows` labelled documents with the smallest hash of the id."""
    chosen = labels.orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    return docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")  # bounded by rows


def _dictionary(samples: list[bytes], rules: QualityRules) -> bytes:
    try:
        return zstandard.train_dictionary(rules.dictionary_bytes, samples, level=rules.level).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself is the dictionary
        return b"".join(samples)[-rules.dictionary_bytes :]


def fit_curve(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset of a logistic curve by Newton's method, with a weak pull of the slope to 0."""
    n1 = y.sum()
    target = np.where(y == 1, (n1 + 1) / (n1 + 2), 1 / (len(y) - n1 + 2))  # Platt's smoothed targets
    scale = x.std() or 1.0
    design = np.stack([(x - x.mean()) / scale, np.ones_like(x)])
    w = np.zeros(2)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(w @ design, -30, 30)))
        slope = design @ (target - p) - np.array([1e-3, 0]) * w
        curve = (design * (p * (1 - p))) @ design.T + np.diag([1e-3, 1e-9])
        step = np.linalg.solve(curve, slope)
        w = w + step
        if np.abs(step).max() < 1e-9:
            break
    return float(w[0] / scale), float(w[1] - w[0] * x.mean() / scale)


def fit(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> QualityModel:
    """Fit to the labelled rows outside fold 0. Rows with a null id, label or text teach nothing. Runs jobs."""
    known = (
        labels.select("doc_id", F.col("quality").cast("int").alias("quality"))
        .filter("doc_id IS NOT NULL AND quality IN (0, 1)").distinct().withColumn("_fold", fold(F.col("doc_id")))
    )
    share = known.filter("_fold > 0").agg(F.avg("quality")).first()[0]
    prior = min(max(0.5 if share is None else share, 0.001), 0.999)
    flat = QualityModel(offset=float(np.log(prior / (1 - prior))), rules=rules)
    data, most = F.col("text").cast("binary"), rules.blocks_per_row
    spread = F.expr(f"sequence(0, least({most}, 1 + octet_length(text) div {rules.sample_bytes}) - 1)")
    gap = F.greatest(F.lit(1), F.expr(f"octet_length(text) div {most}"))
    parts = {}
    for label in (1, 0):
        rows = _sampled(docs, known.filter(f"_fold > 1 AND quality = {label}"), rules.dictionary_rows)
        cut = F.transform(spread, lambda i: F.substring(data, (i * gap + 1).cast("int"), F.lit(rules.sample_bytes)))
        blocks = [bytes(b) for r in rows.filter("text <> ''").select(cut.alias("b")).distinct().collect() for b in r.b]
        random.Random(label).shuffle(blocks := sorted(blocks))
        if not blocks:
            return flat
        parts[label] = _dictionary(blocks, rules)
    model = QualityModel(parts[1], parts[0], rules=rules)
    rows = _sampled(docs, known.filter("_fold = 1"), rules.calibration_rows).filter("text IS NOT NULL")
    seen = rows.select(_difference_udf(model)(F.col("text")).alias("d"), "quality").collect()
    y = np.array([r.quality for r in seen])
    if len(y) == 0 or y.min() == y.max():
        return flat
    slope, offset = fit_curve(np.array([r.d for r in seen]), y)
    return QualityModel(parts[1], parts[0], slope, offset, rules)


def score_documents(docs: DataFrame, labels: DataFrame, rules: QualityRules = QualityRules()) -> DataFrame:
    """doc_id, held_out, score and predicted of every document.

    Repeated rows score alike, other columns of docs are ignored, an empty table gives no rows. Without labels of either
    kind every score is the share of label 1 (0.5 if there are none at all).
    """
    model = fit(docs, labels, rules)
    return docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), score(F.col("text"), model).alias("score")).withColumn(
        "predicted", (F.col("score") >= rules.threshold).cast("int"))


def keep_good(docs: DataFrame, model: QualityModel) -> DataFrame:
    """The rows of docs, with all their columns, whose text scores at least the threshold."""
    return docs.filter(score(F.col("text"), model) >= model.rules.threshold)
