"""Near-duplicate vectors by collision counting over one-dimensional projections.

Every vector is projected on many random directions. A pair collides under a projection when one lies in the window
centred at the other, and pairs that collide often enough are verified by their cosine. Window and count come from the
recall wanted at the cosine limit. In one dimension a window still holds a fair part of all vectors, so counting over
whole sorted projections would touch every pair; vectors first meet where several projections, sorted into cells, agree,
under many such groups of projections, and collisions over all projections are counted for pairs that meet.
"""

from __future__ import annotations

import sys
from dataclasses import dataclass
from math import comb, erf, exp, pi, sqrt

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from rrnlake.llm.blocks import index_pairs, least_labels, paired_blocks, per_block
from rrnlake.llm.common import staged
from rrnlake.llm.components import components

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class CollisionRules:
    """cell and window are in units of the distance of two unit vectors at the cosine limit.

    A group joins cells of per_group projections. meeting_recall() and the recall of the count hold for pairs exactly at
    the limit and are higher for closer ones.
    """

    least_cosine: float = 0.98
    groups: int = 12
    per_group: int = 6
    cell: float = 6.0
    window: float = 2.0
    count_recall: float = 0.999
    seed: int = 42
    block_rows: int = 1000

    @property
    def distance(self) -> float:
        return sqrt(2 - 2 * self.least_cosine)

    @property
    def projections(self) -> int:
        return self.groups * self.per_group

    @property
    def collide(self) -> float:
        """Chance that a pair at the limit collides under one projection."""
        return erf(self.window / sqrt(2))

    @property
    def least_count(self) -> int:
        """The largest count that a pair at the limit reaches with chance count_recall (binomial)."""
        m, p, missed = self.projections, self.collide, 0.0
        for k in range(m + 1):
            missed += comb(m, k) * p**k * (1 - p) ** (m - k)
            if missed > 1 - self.count_recall:
                return k
        return m

    def meeting_recall(self) -> float:
        """Chance that a pair at the limit shares the cells of one group at least."""
        t = self.cell
        same = erf(t / sqrt(2)) - 2 / (sqrt(2 * pi) * t) * (1 - exp(-t * t / 2))
        return 1 - (1 - same**self.per_group) ** self.groups


def directions(size: int, rules: CollisionRules) -> tuple[np.ndarray, np.ndarray]:
    """Gaussian directions (projections x size) and the shifts of their cells."""
    made = np.random.default_rng(rules.seed)
    return made.standard_normal((rules.projections, size)), made.random(rules.projections)


def _units(lists: pa.ListArray, size: int) -> np.ndarray:
    """Rows as unit vectors in double precision. Dividing by the largest component first keeps squares finite."""
    v = lists.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(lists), size)
    v = v / np.abs(v).max(axis=1, keepdims=True)
    return v / np.linalg.norm(v, axis=1, keepdims=True)


def classes_of(vectors: DataFrame) -> DataFrame:
    """Fold equal vectors of a label: label, class_id (least vec_id), members, v.

    Left out, because they link with nothing: null labels, vectors that are null, empty, zero, or hold null, NaN or
    infinite components. -0.0 counts as 0.0.
    """
    v = F.col("embedding")
    sound = (
        F.col("label").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0)
    )
    clean = vectors.select("vec_id", "label", "embedding").filter(sound)
    return clean.groupBy("label", _plain(v).alias("v")).agg(F.min("vec_id").alias("class_id"), F.count("*").alias("members"))


def _plain(v: Column) -> Column:
    """v with 0.0 for -0.0."""
    return F.transform(v, lambda x: F.when(x == 0, F.abs(x)).otherwise(x))


def with_cells(classes: DataFrame, rules: CollisionRules) -> DataFrame:
    """Add `size`, the number of components, and `cells`: per group of projections a hash of the cells it falls into."""
    schema = StructType([*classes.schema.fields, StructField("size", IntegerType()), StructField("cells", ArrayType(LongType()))])

    def run(batches):
        axes = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = np.diff(batch.column("v").offsets.to_numpy())
            for size in np.unique(sizes):
                rows = batch.filter(pa.array(sizes == size))
                if size not in axes:
                    axes[size] = directions(size, rules)
                along, shift = axes[size]
                at = np.floor((_units(rows.column("v"), size) @ along.T) / (rules.cell * rules.distance) + shift).astype(np.int64)
                mixed = np.zeros((len(rows), rules.groups), np.int64)
                for k in range(rules.per_group):  # projection p belongs to group p % groups
                    mixed = mixed * 1_000_003 + at[:, k * rules.groups : (k + 1) * rules.groups]
                ends = np.arange(0, mixed.size + 1, rules.groups, dtype=np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.array(np.full(len(rows), size, np.int32)), pa.ListArray.from_arrays(ends, pa.array(mixed.ravel()))],
                    [*rows.schema.names, "size", "cells"])

    return classes.mapInArrow(run, schema)


def _count_and_verify(rules: CollisionRules):
    """Per block: how many members of other classes each class links to, and a star of links."""
    half = rules.window * rules.distance

    def work(rows: pa.Table) -> pa.Table | None:
        unit = _units(rows.column("v").combine_chunks(), rows.column("size")[0].as_py())
        cells = rows.column("cells").combine_chunks().flatten().to_numpy().reshape(rows.num_rows, -1)
        ids, members = rows.column("class_id").to_numpy(), rows.column("members").to_numpy()
        within = rows.column("_i")[0] == rows.column("_j")[0]
        group = rows.column("g")[0].as_py()
        i, j = index_pairs(rows.column("_second").to_numpy(), within)
        axes, _ = directions(unit.shape[1], rules)
        place = unit @ axes.T
        hits, missed = np.zeros(len(i), np.int16), rules.projections - rules.least_count
        for k in range(rules.projections):
            hits += np.abs(place[i, k] - place[j, k]) <= half
            if k >= missed and k % 8 == 0:  # too few hits to get there any more
                alive = hits + (rules.projections - 1 - k) >= rules.least_count
                i, j, hits = i[alive], j[alive], hits[alive]
        enough = hits >= rules.least_count
        i, j = i[enough], j[enough]
        for earlier in range(group):  # a pair counts in the first group where it meets
            fresh = cells[i, earlier] != cells[j, earlier]
            i, j = i[fresh], j[fresh]
        near = np.einsum("ij,ij->i", unit[i], unit[j]) >= rules.least_cosine
        i, j = i[near], j[near]
        if not len(i):
            return None
        count = np.bincount(i, members[j], len(ids)) + np.bincount(j, members[i], len(ids))
        label = least_labels(len(ids), i, j)
        own = np.flatnonzero(count)
        return pa.table({"class_id": ids[own], "linked": count[own].astype(np.int64), "root": ids[label[own]]})

    return work


def linked_classes(classes: DataFrame, rules: CollisionRules = CollisionRules()) -> DataFrame:
    """(class_id, linked, root) in parts: linked adds up to the vectors of other classes within the limit."""
    keys = ["label", "size", "g", "cell"]
    placed = staged(with_cells(classes, rules), "cells")
    met = placed.select("label", "size", "class_id", F.posexplode("cells").alias("g", "cell"))
    blocks = paired_blocks(met, keys, "class_id", rules.block_rows)
    # Vectors join their blocks last, so that they are moved once per group and not for the counts before.
    full = blocks.join(placed.select("class_id", "members", "v", "cells"), "class_id")
    return per_block(full, keys, _count_and_verify(rules), "class_id long, linked long, root long")


def near_vectors(vectors: DataFrame, rules: CollisionRules = CollisionRules()) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row of vectors (vec_id, embedding, label).

    Vectors link when their labels are equal and their cosine in double precision is at least the limit; of the pairs
    found none is below it. Equal vectors link always. Rows that can't link (see classes_of), and those with a null
    vec_id only, are components of their own. Vectors of different sizes don't link. Repeated rows count as rows of
    their own in n_links. An empty table gives no rows; other columns are ignored. Runs jobs.
    """
    folded = staged(classes_of(vectors), "classes")
    parts = staged(linked_classes(folded.filter("class_id IS NOT NULL"), rules), "linked")
    counts = parts.groupBy(F.col("class_id").alias("_c")).agg(F.sum("linked").alias("_linked"))
    roots = components(parts, "class_id", "root")
    named = (
        folded.join(counts, F.col("class_id") == F.col("_c"), "left").join(roots, F.col("class_id") == F.col("node"), "left")
        .select(F.col("label").alias("_label"), F.col("v").alias("_v"), (F.coalesce("_linked", F.lit(0)) + F.col("members") - 1).alias("_links"),
                F.coalesce("root", "class_id").alias("_root"))
    )
    rows = vectors.select("vec_id", "label", _plain(F.col("embedding")).alias("_vec"))
    found = rows.join(named, (F.col("label") == F.col("_label")) & (F.col("_vec") == F.col("_v")), "left")
    component = F.coalesce("_root", "vec_id").cast("long")
    return found.select(
        "vec_id", F.coalesce("_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"))
