"""Comparing the rows of a group with each other, a bounded number at a time."""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def paired_blocks(rows: DataFrame, keys: list[str], spread: str, block_rows: int) -> DataFrame:
    """Rows of groups with two rows or more, once per pair of blocks; adds `_i`, `_j` and `_second`.

    A group of n rows is cut into ceil(n / block_rows) blocks by a hash of the column spread. Rows with the same
    (keys, _i, _j) are at most about two blocks; `_second` marks those of block _j where _i < _j. Each two rows of a group
    meet under exactly one (_i, _j).
    """
    sizes = rows.groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    cut = rows.join(sizes, keys).withColumn("_blocks", F.ceil(F.col("_n") / block_rows).cast("int"))
    own = F.pmod(F.xxhash64(F.lit(7), F.col(spread)), F.col("_blocks")).cast("int")
    cut = cut.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_blocks") - 1)))
    return cut.withColumns({
        "_i": F.least("_own", "_other"), "_j": F.greatest("_own", "_other"), "_second": F.col("_own") > F.col("_other"),
    }).drop("_n", "_blocks", "_own", "_other")


def per_block(df: DataFrame, keys: list[str], work: Callable[[pa.Table], pa.Table], schema: str) -> DataFrame:
    """Apply work to the rows of each (keys, _i, _j). Many small groups share an Arrow batch, so none pays for its own."""
    names = [*keys, "_i", "_j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            held = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            ends = _ends(held, names)
            if len(ends) > 1:  # the last group may go on in the next batch
                yield from _apply(held.slice(0, ends[-2]).combine_chunks(), ends[:-1], work)
                held = held.slice(ends[-2])
        if held is not None and held.num_rows:
            held = held.combine_chunks()
            yield from _apply(held, _ends(held, names), work)

    return df.repartition(*names).sortWithinPartitions(*names).mapInArrow(run, schema)


def _ends(rows: pa.Table, names: list[str]) -> np.ndarray:
    """Where the runs of equal keys end."""
    change = np.zeros(rows.num_rows - 1, dtype=bool)
    for n in names:
        values = rows.column(n).to_numpy()
        change |= values[1:] != values[:-1]
    return np.append(np.flatnonzero(change) + 1, rows.num_rows)


def _apply(rows: pa.Table, ends: np.ndarray, work: Callable[[pa.Table], pa.Table]) -> Iterator[pa.RecordBatch]:
    made, first = [], 0
    for end in ends:
        out = work(rows.slice(first, end - first))
        if out is not None and out.num_rows:
            made.append(out)
        first = end
    if made:
        yield from pa.concat_tables(made).combine_chunks().to_batches()


def index_pairs(second: np.ndarray, within: bool) -> tuple[np.ndarray, np.ndarray]:
    """Positions of all pairs to compare: within one block, or of the first block with the second."""
    if within:
        return np.triu_indices(len(second), 1)
    a, b = np.flatnonzero(~second), np.flatnonzero(second)
    return np.repeat(a, len(b)), np.tile(b, len(a))


def least_labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For positions 0..n-1 linked by pairs (i, j), the least position reachable."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[i], label[j])
        new = label.copy()
        np.minimum.at(new, i, low)
        np.minimum.at(new, j, low)
        new = new[new]
        if (new == label).all():
            return label
        label = new
