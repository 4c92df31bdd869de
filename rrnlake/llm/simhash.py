"""SimHash near-duplicates with pivot distance tables.

Equal fingerprints fold to one. Two fingerprints that differ in at most three of 64 bits agree on three of six blocks of
bits, so those that agree on three blocks meet, each under 20 keys. The distances of every fingerprint to many reference
fingerprints (pivots) are computed once beforehand; of two fingerprints that meet, no pivot's distances can differ by
more than the two do from each other, so pairs with a larger coordinate difference go, and the rest is verified. Distances
to pivots of random fingerprints are alike in 64 dimensions, so they cannot find candidates by themselves without pairing
everything; the blocks of bits do that.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from rrnlake.llm.blocks import index_pairs, least_labels, paired_blocks, per_block
from rrnlake.llm.common import staged
from rrnlake.llm.components import components

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS, SEED, LEAST = 64, 42, 3
BLOCK_ROWS = 1000
AT_ONCE = 1 << 16  # shingles whose bits are unpacked at once


def pivots(count: int = 32) -> np.ndarray:
    """Reference fingerprints: hashes of the numbers from 0."""
    return np.array([xxhash.xxh64_intdigest(str(i), SEED) for i in range(count)], dtype=np.uint64)


def shingle_hashes(text: str | None, shingle: int) -> np.ndarray:
    """Hashes of the word shingles, repeats included; of all words where there are no more than `shingle`."""
    words = (text or "").encode("utf-8", "replace").lower().split()  # bytes: A-Z only, ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    if len(words) <= shingle:
        return np.array([xxhash.xxh64_intdigest(joined, SEED)], dtype=np.uint64)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths)[: len(words) - shingle + 1].tolist()
    view, digest = memoryview(joined), xxhash.xxh64_intdigest
    return np.array([digest(view[s:e], SEED) for s, e in zip(starts, ends[shingle - 1 :].tolist())], dtype="<u8")


def _bits(hashes: np.ndarray) -> int:
    if not len(hashes):
        return 0
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), AT_ONCE):
        part = hashes[k : k + AT_ONCE]
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def simhash(text: str | None, shingle: int = 3) -> int:
    """64-bit SimHash over word shingles, repeats included, as an unsigned number; 0 without words."""
    return _bits(shingle_hashes(text, shingle))


def fingerprint(text: Column, shingle: int = 3) -> Column:
    """simhash() as a signed long."""

    @F.pandas_udf("bigint")
    def run(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series(np.array([simhash(t, shingle) for t in batch], dtype=np.uint64).view(np.int64))

    return run(text)


def _keys(most: int) -> list[int]:
    """Masks of the bit groups of which one at least is equal in fingerprints that differ in at most `most` bits."""
    ends = np.linspace(0, BITS, 2 * most + 1).astype(int)
    parts = [((1 << int(b)) - 1) ^ ((1 << int(a)) - 1) for a, b in zip(ends, ends[1:])]
    masks = [sum(c) for c in combinations(parts, most)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def pivot_table(prints: DataFrame, refs: np.ndarray) -> DataFrame:
    """Add `distances`: of fp to each pivot, one byte each."""
    each = [F.bit_count(F.col("fp").bitwiseXOR(F.lit(int(p)))).cast("byte") for p in refs.view(np.int64)]
    return prints.withColumn("distances", F.array(*each))


def _links(most: int):
    def work(rows: pa.Table) -> pa.Table | None:
        fp = rows.column("fp").to_numpy().view(np.uint64)
        within = rows.column("_i")[0] == rows.column("_j")[0]
        i, j = index_pairs(rows.column("_second").to_numpy(), within)
        lists = rows.column("distances").combine_chunks()
        table = lists.flatten().to_numpy().reshape(len(fp), -1)
        for column in table.T:
            if not len(i):
                return None
            near = np.abs(column[i] - column[j]) <= most
            i, j = i[near], j[near]
        near = np.bitwise_count(fp[i] ^ fp[j]) <= most
        i, j = i[near], j[near]
        if not len(i):
            return None
        label = least_labels(len(fp), i, j)
        moved = np.flatnonzero(label != np.arange(len(fp)))
        signed = fp.view(np.int64)
        return pa.table({"a": signed[label[moved]], "b": signed[moved]})

    return work


def linked_prints(prints: DataFrame, most: int = LEAST, pivot_count: int = 32) -> DataFrame:
    """(a, b): links that join the same distinct fingerprints as all pairs within `most` bits do, per block a star."""
    masks = F.array(*[F.struct(F.lit(k).alias("t"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for k, m in enumerate(_keys(most))])
    table = pivot_table(prints.select("fp"), pivots(pivot_count))
    rows = table.withColumn("_k", F.explode(masks)).select("_k.t", "_k.key", "fp", "distances")
    return per_block(paired_blocks(rows, ["t", "key"], "fp", BLOCK_ROWS), ["t", "key"], _links(most), "a bigint, b bigint")


def near_duplicates(docs: DataFrame, most: int = LEAST, shingle: int = 3) -> DataFrame:
    """doc_id, fp (signed long), fingerprint (hex) and component_id of every document.

    Null texts, and texts without words, have fingerprint zero and link like any other. component_id is the least doc_id
    of the component; null ids are passed over, and a component of null ids only has null. Repeated rows are one
    component. An empty table gives no rows; other columns of docs are ignored. Runs jobs.
    """
    rows = staged(docs.select("doc_id", fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    prints = staged(rows.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(linked_prints(prints, most))
    named = prints.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    firsts = named.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = named.join(firsts, "root").select("fp", "component_id")
    return rows.join(classes, "fp").select(
        "doc_id", "fp", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def _first_rows(docs: DataFrame, rows: DataFrame) -> DataFrame:
    """The rows of docs that are the first, by doc_id and then hash of text, of their `root` in rows (doc_id, _x, root).

    Rows equal in doc_id and text stay once, the least in all columns; those with a null id all stay.
    """
    firsts = rows.filter("doc_id IS NOT NULL").groupBy("root").agg(F.min(F.struct("doc_id", "_x")).alias("_f"))
    firsts = firsts.select(F.col("_f.doc_id").alias("__id"), F.col("_f._x").alias("__x"))
    keyed = docs.select(F.struct(*docs.columns).alias("__row"), F.col("doc_id").alias("__a"), _text_hash().alias("__b"))
    kept = keyed.join(firsts, (F.col("__a") == F.col("__id")) & (F.col("__b") == F.col("__x")), "left_semi")
    kept = kept.groupBy("__a", "__b").agg(F.min("__row").alias("__row")).select("__row.*")
    return kept.unionAll(docs.filter("doc_id IS NULL"))


def _text_hash() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def keep_one(docs: DataFrame, most: int = LEAST, shingle: int = 3) -> DataFrame:
    """The rows of docs, with all their columns, that are the first of their component; see _first_rows."""
    rows = staged(docs.select("doc_id", _text_hash().alias("_x"), fingerprint(F.col("text"), shingle).alias("fp")), "simhash")
    roots = components(linked_prints(staged(rows.select("fp").distinct(), "prints"), most))
    named = rows.join(roots, F.col("fp") == F.col("node"), "left").withColumn("root", F.coalesce("root", "fp"))
    return _first_rows(docs, named)
