"""Short words looked for in whole sequences, a batch of sequences at a time."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, LongType

from rrnlake.functions.minimizers import _kmer_hashes

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEAST = 8  # shorter words are in nearly every sequence
_SLOTS = 16  # bits of a hash that are looked up first


class Finder:
    """Words (number, bases) to be found in sequences that are longer than they are."""

    def __init__(self, words: list[tuple[int, bytes]]):
        self.short = [(n, w) for n, w in words if len(w) < LEAST]
        self.starts: dict[int, dict[int, list[tuple[int, bytes]]]] = {}
        for n, w in words:
            if len(w) >= LEAST:
                size = 1 << (len(w).bit_length() - 1)
                first = int(_kmer_hashes(np.frombuffer(w[:size], np.uint8), size)[0])
                self.starts.setdefault(size, defaultdict(list))[first].append((n, w))
        self.slots = {}
        for size, by in self.starts.items():
            self.slots[size] = np.zeros(1 << _SLOTS, bool)
            self.slots[size][np.array(list(by), np.int64).view(np.uint64) >> np.uint64(64 - _SLOTS)] = True

    def inside(self, seq: bytes) -> list[int]:
        """Numbers of the words that stand in seq."""
        found = [n for n, w in self.short if len(w) < len(seq) and w in seq]
        codes = np.frombuffer(seq, np.uint8)
        for size, by in self.starts.items():
            if len(seq) <= size:
                continue
            hashes = _kmer_hashes(codes, size)
            near = np.flatnonzero(self.slots[size][hashes.view(np.uint64) >> np.uint64(64 - _SLOTS)])
            seen = set()
            for at, key in zip(near.tolist(), hashes[near].tolist()):
                for n, w in by.get(key, ()):
                    if n not in seen and len(w) < len(seq) and seq.startswith(w, at):
                        seen.add(n)
            found += seen
        return found


def pieces_inside(words: list[tuple[int, bytes]]) -> Callable[[str], Column]:
    """Column function: the numbers of the words (number, bases) that a longer sequence holds."""
    finder = Finder(words)

    def run(batch: pd.Series) -> pd.Series:
        return pd.Series([np.array(finder.inside(s.encode()), np.int64) for s in batch], dtype=object)

    return F.pandas_udf(run, ArrayType(LongType()))
