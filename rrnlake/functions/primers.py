"""Primer site search on a batch of sequences.

Spark has no expression for all positions of a pattern in linear time, so the
search runs on Arrow batches: one pass per sequence for all primer pairs.
"""

from __future__ import annotations

import re
import sys
from collections import deque

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from rrnlake.functions.sequence import IUPAC, primer_pattern, reverse_complement_text

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SITE = ArrayType(StructType([
    StructField("pair", StringType()),
    StructField("strand", StringType()),
    StructField("start", IntegerType()),
    StructField("end", IntegerType()),
    StructField("left_len", IntegerType()),
    StructField("right_len", IntegerType()),
    StructField("mismatches", IntegerType()),
]))


def _bits(letters: str, table: dict[str, str]) -> np.ndarray:
    order = "ACGT"
    return np.array([sum(1 << order.index(c) for c in table[x]) for x in letters], np.uint8)


def _sites(seq: str, codes: np.ndarray | None, primer: str, allowed: int, table: dict[str, str], pattern):
    """(0-based starts, mismatches) of a primer with at most `allowed` mismatches."""
    if not allowed:
        at = np.array([m.start() for m in pattern.finditer(seq)], np.int64)
        return at, np.zeros(len(at), np.int64)
    room = len(codes) - len(primer) + 1
    if room < 1:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    wrong = np.zeros(room, np.int32)
    for j, bit in enumerate(_bits(primer, table)):
        wrong += (codes[j:j + room] & bit) == 0
    at = np.flatnonzero(wrong <= allowed)
    return at, wrong[at]


def _least_in_reach(wrong: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """For each range first..last-1 the first place of the least value; either end grows with the index of the range."""
    out, line, at = np.empty(len(first), np.int64), deque(), 0
    for k, (low, high) in enumerate(zip(first.tolist(), last.tolist())):
        while at < high:  # places in line have growing values
            while line and wrong[line[-1]] > wrong[at]:
                line.pop()
            line.append(at)
            at += 1
        while line[0] < low:
            line.popleft()
        out[k] = line[0]
    return out


def amplicons(
    seq: Column, primers: list[tuple[str, str, str]], max_len: int | None, min_identity: float, pick: str = "all"
) -> Column:
    """Array of amplicon places (1-based, closed, with primers) of every primer pair on both strands.

    A left site goes with right sites that begin behind it and, with max_len, end in reach. pick is `all` for each of
    them, `nearest` for the first; `best` is one place per pair and strand, that with the fewest mismatches, the leftmost
    start and end of equals. Letter case does not count.
    """
    plans = []
    for pair, fwd, rev in primers:
        for strand, left, right in (
            ("+", fwd, reverse_complement_text(rev)), ("-", rev, reverse_complement_text(fwd))
        ):
            sides = [(p, int((1 - min_identity) * len(p) + 1e-9), primer_pattern(p)) for p in (left, right)]
            plans.append((pair, strand, *sides))
    fuzzy = min_identity < 1
    table = dict(IUPAC)

    def run(batch: pd.Series) -> pd.Series:
        ready = [
            (pair, strand, a, b, re.compile(f"(?={a[2]})"), re.compile(f"(?={b[2]})"))
            for pair, strand, a, b in plans
        ]
        lookup = np.zeros(256, np.uint8)
        if fuzzy:
            for letter in table:
                if len(table[letter]) == 1:
                    lookup[ord(letter)] = _bits(letter, table)[0]
        out = []
        for seq in batch:
            seq = seq.upper()
            codes = lookup[np.frombuffer(seq.encode(), np.uint8)] if fuzzy else None
            rows = []
            for pair, strand, a, b, a_re, b_re in ready:
                starts, wrong_a = _sites(seq, codes, a[0], a[1], table, a_re)
                stops, wrong_b = _sites(seq, codes, b[0], b[1], table, b_re)
                first = np.searchsorted(stops, starts + len(a[0]))
                if max_len is None:
                    last = np.full(len(starts), len(stops))
                else:
                    last = np.searchsorted(stops, starts + max_len - len(b[0]), "right")
                if pick == "all":
                    count = np.maximum(last - first, 0)
                    left = np.repeat(np.arange(len(starts)), count)
                    right = np.arange(len(left)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(first, count)
                else:
                    left = np.flatnonzero(first < last)
                    right = first[left]
                    if pick == "best":
                        right = _least_in_reach(wrong_b, right, last[left])
                ends, wrong = stops[right] + len(b[0]), wrong_a[left] + wrong_b[right]
                if pick == "best" and len(wrong):
                    one = [int(wrong.argmin())]  # starts grow, so the first of equals is the leftmost
                    left, ends, wrong = left[one], ends[one], wrong[one]
                rows += [(pair, strand, x + 1, y, len(a[0]), len(b[0]), w)
                         for x, y, w in zip(starts[left].tolist(), ends.tolist(), wrong.tolist())]
            out.append(rows)
        return pd.Series(out)

    return F.pandas_udf(run, SITE)(seq)
