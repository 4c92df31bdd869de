"""Whitening of vectors on their leading principal components, by Chebyshev-filtered subspace iteration.

The covariance is never formed. A pass over the fit list gives the product of the centred covariance with a thin block of
directions, X'(XQ) summed over tasks. A Chebyshev polynomial of the covariance, by its three-term recurrence of such passes,
damps the part of the spectrum below the block (Zhou et al. 2006); QR and a Rayleigh-Ritz step on the filtered block follow,
and rounds go on until the residuals of the wanted pairs certify them.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import acosh, ceil, log

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

from rrnlake.llm.common import staged

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SAFE = 1 << 62
LONG = (1 << 63) - 1


@dataclass(frozen=True)
class WhiteningRules:
    """scale turns entries into whole numbers; block is the number of directions iterated, guard ones included.

    Pairs count as certified when no residual exceeds tolerance times the largest eigenvalue. An eigenvalue below
    least_share of the largest is taken for zero and gives no component.
    """

    scale: int = 256
    components: int = 4
    block: int = 24
    tolerance: float = 2e-14
    least_share: float = 1e-12
    max_degree: int = 24
    max_rounds: int = 60
    seed: int = 42


@dataclass(frozen=True)
class Whitening:
    """What was fitted: n vectors, sums per dimension, unit directions as columns, eigenvalues, trace, identity_error."""

    n: int
    sums: list[int]
    directions: np.ndarray
    values: np.ndarray
    trace: float
    identity_error: float
    passes: int


def clean_vectors(vectors: DataFrame, column: str, scale: int) -> DataFrame:
    """vectors without those that are null or hold null or non-finite entries, with x, the entries as whole numbers."""
    entry = lambda e: e.cast("double")
    odd = F.exists(column, lambda e: e.isNull() | F.isnan(entry(e)) | (F.abs(entry(e)) == F.lit(float("inf"))))
    whole = F.transform(column, lambda e: F.floor(entry(e) * scale).cast("long"))
    return vectors.filter(F.col(column).isNotNull() & ~odd).withColumn("x", whole)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list array as whole numbers, padded with zeros to the width."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), np.int64)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _numerators(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n*x - sums, exact: as 64-bit numbers if they fit, else as Python's."""
    most = int(max(abs(int(x.min())), abs(int(x.max())))) if x.size else 0
    if n * most + max(map(abs, sums), default=0) < SAFE:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_numerators(x, n, sums) / n).astype(np.float64)


def _blocks(fit: DataFrame, width: int) -> DataFrame:
    """The fit list as blocks of many vectors, so that a pass reads bytes and not rows."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, 4096):
                part = batch.slice(first, 4096)
                x = _matrix(part.column("x"), width)
                small = np.abs(x).max(initial=0) < 1 << 15 and x.min(initial=0) > -(1 << 15)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([len(x)], pa.int32()), pa.array([2 if small else 8], pa.int32()),
                     pa.array([x.astype("<i2" if small else "<i8").tobytes()], pa.binary())], ["n", "bytes", "body"])

    return fit.mapInArrow(run, "n int, bytes int, body binary")


def _opened(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[np.ndarray]:
    for batch in batches:
        for n, size, body in zip(*(batch.column(c).to_pylist() for c in ("n", "bytes", "body"))):
            yield np.frombuffer(body, f"<i{size}").reshape(n, width).astype(np.int64)


def _sums(blocks: DataFrame, width: int) -> tuple[int, list[int]]:
    """Number of vectors and exact sums per dimension. Every task sends one row per dimension."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * width
        for x in _opened(batches, width):
            wide = len(x) * int(np.abs(x.astype(np.float64)).max(initial=0)) >= SAFE
            n, own = n + len(x), x.sum(axis=0, dtype=object if wide else np.int64)
            total = [a + int(b) for a, b in zip(total, own)]
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array(range(width), pa.int32()), pa.array([n] * width, pa.int64()), pa.array(total, pa.decimal128(38, 0))], ["d", "n", "s"])

    found = blocks.mapInArrow(run, "d int, n bigint, s decimal(38,0)").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    by = {r.d: r for r in found}
    return (by[0].n if by else 0), [int(by[d].s) if d in by else 0 for d in range(width)]


def _product(blocks: DataFrame, width: int, n: int, sums: list[int]) -> Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """A function that gives (V @ q, the variances of the dimensions) by one pass over the fit list."""
    def multiply(q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        names = [f"q{j}" for j in range(q.shape[1] + 1)]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, seen = np.zeros((width, q.shape[1] + 1)), False
            for x in _opened(batches, width):
                c, seen = _centred(x, n, sums), True
                total[:, :-1] += c.T @ (c @ q)
                total[:, -1] += np.einsum("ij,ij->j", c, c)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(range(width), pa.int32()), *(pa.array(np.ascontiguousarray(total[:, j])) for j in range(len(names)))], ["d", *names])

        schema = "d int, " + ", ".join(f"{c} double" for c in names)
        # width rows of block + 1 numbers come back, whatever the number of vectors.
        rows = blocks.mapInArrow(run, schema).groupBy("d").agg(*(F.sum(c).alias(c) for c in names)).collect()
        out = np.array([list(r)[1:] for r in sorted(rows, key=lambda r: r.d)]) / n
        return out[:, :-1], out[:, -1]

    return multiply


def leading_pairs(multiply: Callable, width: int, rules: WhiteningRules) -> tuple[np.ndarray, np.ndarray, float, int]:
    """(directions, eigenvalues, trace, passes) of the leading components, fewer where the rest is zero.

    The polynomial damps [0, the least Ritz value of the block]; its degree follows from the ratio that the last wanted
    value has to that end. The product that a Rayleigh-Ritz step needs also starts the next recurrence.
    """
    size = min(width, max(rules.block, rules.components + 1))
    q = np.linalg.qr(np.random.default_rng(rules.seed).standard_normal((width, size)))[0]
    vq, variances = multiply(q)
    trace, passes, best, stuck = float(variances.sum()), 1, np.inf, 0
    if not trace > 0:
        return np.empty((width, 0)), np.empty(0), trace, passes
    for _ in range(rules.max_rounds):
        inner = q.T @ vq
        values, turn = np.linalg.eigh((inner + inner.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        wanted = [i for i in range(min(rules.components, size)) if values[i] > rules.least_share * values[0]]
        residual = max(np.linalg.norm(vq[:, i] - values[i] * q[:, i]) for i in wanted) / values[0]
        # Rounding of the sums sets a floor; rounds that no longer gain are at it.
        stuck = stuck + 1 if residual > best / 2 else 0
        best = min(best, residual)
        if residual <= rules.tolerance or stuck >= 2 and residual <= 50 * rules.tolerance:
            keep = len(wanted)
            return q[:, :keep] / np.linalg.norm(q[:, :keep], axis=0), values[:keep], trace, passes
        low = max(float(values[-1]), rules.least_share * float(values[0]))
        ratio = max(2 * float(values[wanted[-1]]) / low - 1, 1 + 1e-9)
        degree = max(2, min(rules.max_degree, ceil(log(2 * max(residual / rules.tolerance, 2)) / acosh(ratio))))
        half = low / 2
        growth = max(2 * float(values[0]) / low - 1, 1 + 1e-9)
        # Scaled so that the largest value stays near one.
        sigma = first = 1 / growth
        before, now = q, (vq - half * q) * (sigma / half)
        for _ in range(degree - 1):
            product, _ = multiply(now)
            passes += 1
            after = 1 / (2 / first - sigma)
            before, now = now, (product - half * now) * (2 * after / half) - sigma * after * before
            sigma = after
        q = np.linalg.qr(now)[0]
        q = np.linalg.qr(q)[0]
        vq, _ = multiply(q)
        passes += 1
    raise RuntimeError(f"no certified components after {passes} passes: residual {best:.1e}")


def fit_whitening(x: DataFrame, rules: WhiteningRules = WhiteningRules()) -> Whitening:
    """Fit on the distinct whole-number vectors in column x of any number of rows. Runs jobs.

    The dimension is that of the longest vector; shorter ones count as filled with zeros.
    """
    width = x.agg(F.max(F.size("x"))).first()[0] or 0
    if width == 0:
        return Whitening(0, [], np.empty((0, 0)), np.empty(0), 0.0, 0.0, 0)
    filled = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
    fit = x.select(F.when(F.size("x") < width, filled).otherwise(F.col("x")).alias("x")).distinct()
    blocks = staged(_blocks(fit, width), "fit-list")
    n, sums = _sums(blocks, width)
    multiply = _product(blocks, width, n, sums)
    directions, values, trace, passes = leading_pairs(multiply, width, rules)
    error = 0.0
    if len(values):
        # Measured on the whitened vectors of the fit list, by a pass of its own.
        scaled = directions / np.sqrt(values)
        error = float(np.abs(scaled.T @ multiply(scaled)[0] - np.eye(len(values))).max())
        passes += 1
    return Whitening(n, sums, directions, values, trace, error, passes)


def whiten_vectors(vectors: DataFrame, rules: WhiteningRules = WhiteningRules(), key: str = "vec_id", column: str = "embedding") -> DataFrame:
    """key, component, n, deviation, whitened, explained, identity_error per remaining vector and component.

    Vectors that are null or hold null or non-finite entries are dropped. An entry becomes floor(scale * entry), held to the
    range of a long. Repeated keys and vectors stay rows of their own but count once in the fit; a null key stays null;
    shorter vectors count as filled with zeros; other columns are ignored. deviation is null where the exact number is no
    long. Components without variance are not returned: one distinct vector, or none, gives no rows. Runs jobs.
    """
    rows = clean_vectors(vectors.select(key, column), column, rules.scale)
    fitted = fit_whitening(rows.select("x"), rules)
    width, m = fitted.directions.shape if fitted.n else (0, 0)
    kind = dict(vectors.dtypes)[key]
    schema = f"{key} {kind}, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    scaled = fitted.directions / np.sqrt(fitted.values) if m else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            top = _numerators(_matrix(batch.column("x"), width), fitted.n, fitted.sums)
            if top.dtype != object and width * float(np.abs(top).max(initial=0)) ** 2 >= SAFE:
                top = top.astype(object)
            apart = [int(v) if int(v) <= LONG else None for v in (top * top).sum(axis=1)]
            white = (top / fitted.n).astype(np.float64) @ scaled
            names = batch.column(key)
            for j in range(m):
                size = len(names)
                yield pa.RecordBatch.from_arrays(
                    [names, pa.array(np.full(size, j + 1, np.int32)), pa.array(np.full(size, fitted.n)), pa.array(apart, pa.int64()),
                     pa.array(np.ascontiguousarray(white[:, j])), pa.array(np.full(size, fitted.values[j] / fitted.trace)),
                     pa.array(np.full(size, fitted.identity_error))],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    if not m:
        return vectors.sparkSession.createDataFrame([], schema)
    return rows.select(key, "x").mapInArrow(run, schema)
