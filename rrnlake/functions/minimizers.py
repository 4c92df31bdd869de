"""Window minimizers (Roberts et al. 2004) of a batch of sequences."""

from __future__ import annotations

import hashlib
import sys

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

_KEYS = StructType([StructField("keys", ArrayType(LongType())), StructField("starts", ArrayType(IntegerType()))])

_BASE = np.uint64(0x9E3779B97F4A7C15)


def _kmer_hashes(codes: np.ndarray, k: int) -> np.ndarray:
    """Hash of every k-mer by doubling: a 2n-mer hash is made of two n-mer hashes."""
    out, out_len = None, 0
    block, block_len = codes.astype(np.uint64) + np.uint64(1), 1
    factor = _BASE
    left = k
    with np.errstate(over="ignore"):
        while left:
            if left & 1:
                if out is None:
                    out, out_len = block, block_len
                else:
                    keep = len(block) - out_len
                    out = block[:keep] * _power(out_len) + out[block_len:block_len + keep]
                    out_len += block_len
            left >>= 1
            if left:
                keep = len(block) - block_len
                block = block[:keep] * factor + block[block_len:block_len + keep]
                factor = factor * factor
                block_len *= 2
        out = out ^ (out >> np.uint64(31))
        out = out * np.uint64(0xBF58476D1CE4E5B9)
        return (out ^ (out >> np.uint64(29))).view(np.int64)


def _power(n: int) -> np.uint64:
    return np.uint64(pow(int(_BASE), n, 1 << 64))


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over every window of `width` values, by doubling."""
    out, size = values, 1
    while size * 2 <= width:
        out = pick(out[:-size], out[size:])
        size *= 2
    rest = width - size
    return pick(out[:-rest], out[rest:]) if rest else out


def minimizer_keys(seq: str, k: int, w: int) -> tuple[np.ndarray, np.ndarray]:
    """Minimizer hashes of the runs of windows of w+k-1 bases that have the same one, in order, and where each run begins.

    A repeat is one long run. A hash that comes again has another run, so every window belongs to one.
    """
    codes = np.frombuffer(seq.encode(), np.uint8)
    if len(codes) < k + w - 1:
        return np.empty(0, np.int64), np.empty(0, np.int32)
    low = _sliding(_kmer_hashes(codes, k), w, np.minimum)
    starts = np.concatenate([[0], np.flatnonzero(low[1:] != low[:-1]) + 1])
    return low[starts], starts.astype(np.int32)


def minimizers(seq: Column, k: int, w: int) -> Column:
    """Struct of `keys` and `starts` (see minimizer_keys)."""
    def run(batch: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([minimizer_keys(s, k, w) for s in batch], columns=["keys", "starts"])

    return F.pandas_udf(run, _KEYS)(seq)


@F.pandas_udf(LongType())
def whole_word(seq: pd.Series) -> pd.Series:
    """Hash of a whole sequence as one word."""
    return pd.Series([int(_kmer_hashes(np.frombuffer(s.encode(), np.uint8), len(s))[0]) if s else 0 for s in seq], dtype="int64")


@F.pandas_udf(IntegerType())
def whole_at(seq: pd.Series, size: pd.Series, word: pd.Series, digest: pd.Series) -> pd.Series:
    """First place in seq of the bases that have this whole_word and SHA-256, -1 if there is none."""
    out = []
    for s, n, key, sha in zip(seq, size, word, digest):
        text = s.encode()
        hits = np.flatnonzero(_kmer_hashes(np.frombuffer(text, np.uint8), n) == key) if n <= len(text) else []
        out.append(next((int(at) for at in hits if hashlib.sha256(text[at:at + n]).hexdigest() == sha), -1))
    return pd.Series(out, dtype="int32")


def _apart(starts: np.ndarray, stops: np.ndarray, span: int, most: int) -> list[int]:
    """Places of the runs of as many windows as lie apart, `most` at most. As many edits hit all windows.

    The windows of a run begin at `starts` to `stops`; a long run has several that lie apart.
    """
    out, free = [], 0
    while len(out) < most:
        at = int(np.searchsorted(stops, free))
        if at == len(stops):
            break
        out.append(at)
        free = max(free, int(starts[at])) + span
    return out


def _stops(starts: np.ndarray, length: int, span: int) -> np.ndarray:
    """Last window of each run, if the runs are those of a whole sequence."""
    return np.append(starts[1:] - 1, length - span)


def rare_keys(starts: np.ndarray, counts: np.ndarray, span: int, edits: int, stops: np.ndarray | None = None) -> np.ndarray:
    """Places of keys one of which is left after `edits` edits, none more common than it must be; starts ascend.

    edits + 1 windows that lie apart aren't all hit. Where there are not so many, all keys are taken. Without `stops` a
    key has one window.
    """
    stops = starts if stops is None else stops
    bounds = np.unique(counts)
    low, high = 0, len(bounds)
    while low < high:
        middle = (low + high) // 2
        some = counts <= bounds[middle]
        if len(_apart(starts[some], stops[some], span, edits + 1)) > edits:
            high = middle
        else:
            low = middle + 1
    if low == len(bounds):
        return np.arange(len(starts))
    rare = np.flatnonzero(counts <= bounds[low])
    return rare[np.unique(_apart(starts[rare], stops[rare], span, edits + 1))]


@F.pandas_udf(ArrayType(LongType()))
def probe_keys(
    starts: pd.Series, length: pd.Series, span: pd.Series, edits: pd.Series, at: pd.Series, keys: pd.Series, counts: pd.Series
) -> pd.Series:
    """Keys that others have too among those a sequence must be found by (see rare_keys).

    `at` are the places among `starts` of the keys that others have, in any order, and `counts` how many sequences have one.
    """
    out = []
    for start, n, s, d, where, key, count in zip(starts, length, span, edits, at, keys, counts):
        seen, known = np.ones(len(start), np.int64), np.zeros(len(start), np.int64)
        seen[where], known[where] = count, key
        chosen = rare_keys(start, seen, s, d, _stops(start, n, s))
        out.append(np.unique(known[chosen[seen[chosen] > 1]]))
    return pd.Series(out, dtype=object)


KEY_BITS = 48  # of a hash; two words with the same ones only meet needlessly
_BUCKET_KEYS = 1 << 20


def shared_keys(rows: DataFrame) -> DataFrame:
    """(key, n) of the keys in more than one row of `keys`, which has each of its own once. Keys move as five bytes."""
    total = rows.agg(F.sum(F.size("keys"))).first()[0] or 0
    buckets = 1 << 8
    parts = max(1, total // (_BUCKET_KEYS << 8))  # buckets are split where they are large

    def pack(batches):
        for batch in batches:
            keys = batch.column(0).flatten().to_numpy(zero_copy_only=False)
            keys = np.sort(keys)
            cuts = np.searchsorted(keys, np.arange(buckets + 1, dtype=np.int64) << 40)
            rest = np.ascontiguousarray(keys.astype("<i8")).view(np.uint8).reshape(-1, 8)[:, :5]
            owner = keys % parts
            rows = [(b, p, rest[lo:hi][owner[lo:hi] == p].tobytes()) for b, (lo, hi) in enumerate(zip(cuts[:-1], cuts[1:])) if hi > lo for p in range(parts)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int32(), pa.int32(), pa.binary()))], ["bucket", "part", "packed"])

    def count(key, frame):
        raw = np.frombuffer(b"".join(frame["packed"]), np.uint8).reshape(-1, 5)
        full = np.zeros((len(raw), 8), np.uint8)
        full[:, :5], full[:, 5] = raw, key[0]
        found, n = np.unique(full.view("<i8")[:, 0], return_counts=True)
        return pd.DataFrame({"key": found[n > 1], "n": n[n > 1].astype(np.int64)})

    packed = rows.select("keys").mapInArrow(pack, "bucket int, part int, packed binary")
    return packed.groupBy("bucket", "part").applyInPandas(count, "key long, n long")


@F.pandas_udf(BooleanType())
def lost_by_edits(
    keys: pd.Series, starts: pd.Series, length: pd.Series, others: pd.Series, span: pd.Series, edits: pd.Series
) -> pd.Series:
    """False only if more than `edits` edits are needed to lose all keys that are not among the others."""
    out = []
    for key, start, n, other, s, d in zip(keys, starts, length, others, span, edits):
        lost = ~np.isin(key, other)
        out.append(len(_apart(start[lost], _stops(start, n, s)[lost], s, d + 1)) <= d)
    return pd.Series(out, dtype=bool)


def anchor_span(identity: float, shortest: int, longest: int) -> int:
    """Longest exact stretch that any two matching sequences of these lengths (of the shorter one) are sure to share.

    With at most d = floor((1-t)L) edits on L bases, some stretch of ceil((L-d)/(d+1)) bases is unchanged. For one d the
    least L has the least stretch, so only the lengths at which d grows are looked at.
    """
    share = max(1 - identity, 1e-12)
    least, length = longest, shortest
    while length <= longest:
        edits = int(share * length + 1e-9)
        least = min(least, -(-(length - edits) // (edits + 1)))
        length = max(length + 1, int((edits + 1 - 1e-9) / share))
        while length <= longest and int(share * length + 1e-9) == edits:
            length += 1
    return max(1, least)
