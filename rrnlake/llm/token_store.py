"""Token ids of documents in one array on disk, with Elias-Fano coded document boundaries.

The ids of all documents, in ascending doc_id order, form one array. It is cut into segments of whole documents; a segment
is one record of a Parquet table: the ids in two or four bytes each, and the ends of its documents as an Elias-Fano sequence
(Elias 1974, Fano 1971): low bits packed, high bits in unary, and the place of every 64th one, from which select() finds any
end. That is about 2 + log2(ids / documents) bits a document instead of a 64-bit table. Where a segment starts follows from
the ids before it in its part of the sort and from one number per part.
"""

from __future__ import annotations

import json
import os
import re
import struct
import sys
import types
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from rrnlake.llm.common import shared_path

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
# Fixed values of the file format: mark, then documents, ids, bytes an id, low bits, bytes of highs, number of samples.
MAGIC = b"IDEF"
HEADER = "<4sIQBBxxII"
SAMPLE = 64
# Ends between a sign that isn't white space and one space before another such sign: no pre-token goes over them.
SURE_END = re.compile(r"(?<=\S)(?= \S)")
KEEP_LENGTH, KEEP_BYTES = 48, 256 << 20  # of pieces of text whose ids a Python worker remembers

STORED = "part int, segment int, before bigint, n_ids bigint, first_id bigint, last_id bigint, doc_ids array<bigint>, body binary"


@dataclass(frozen=True)
class StoreRules:
    """end_id follows every document; a segment ends with the document that brings it to segment_ids."""

    end_id: int = 0
    segment_ids: int = 1 << 18


class EliasFano:
    """A sequence of whole numbers that never falls, in near-minimal space."""

    def __init__(self, count: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.count, self.low_bits, self.low, self.high, self.samples = count, low_bits, low, high, samples

    @classmethod
    def of(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, dtype=np.int64)
        n = len(values)
        low_bits = max(0, (int(values[-1]) // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(low_bits)) & 1).astype(np.uint8)
        places = (values >> low_bits) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        unary[places] = 1
        return cls(n, low_bits, np.packbits(bits.ravel(), bitorder="little"), np.packbits(unary, bitorder="little"),
                   places[::SAMPLE].astype("<u4"))

    def select(self, first: int, stop: int) -> np.ndarray:
        """Values number first up to, not with, stop. Only the stretch of the high bits that holds them is read."""
        if not 0 <= first <= stop <= self.count:
            raise IndexError(f"{first}, {stop} of {self.count}")
        if first == stop:
            return np.empty(0, np.int64)
        block, last = first // SAMPLE, (stop - 1) // SAMPLE + 1
        begin = int(self.samples[block]) // 8
        end = int(self.samples[last]) // 8 + 1 if last < len(self.samples) else len(self.high)
        ones = np.flatnonzero(np.unpackbits(self.high[begin:end], bitorder="little")) + begin * 8
        ones = ones[ones >= self.samples[block]][first - block * SAMPLE:][: stop - first]
        high = ones - np.arange(first, stop)
        if not self.low_bits:
            return high
        begin, end = first * self.low_bits, stop * self.low_bits
        bits = np.unpackbits(self.low[begin // 8: -(-end // 8)], bitorder="little")[begin % 8:][: end - begin]
        low = bits.reshape(-1, self.low_bits).astype(np.int64) @ (1 << np.arange(self.low_bits, dtype=np.int64))
        return high << self.low_bits | low


def pack_segment(ids: list[np.ndarray]) -> bytes:
    """One segment from the ids of its documents, all of one unsigned type."""
    ends = EliasFano.of(np.cumsum([len(i) for i in ids], dtype=np.int64))
    flat = np.concatenate(ids) if ids else np.empty(0, "<u2")
    head = struct.pack(HEADER, MAGIC, len(ids), len(flat), flat.dtype.itemsize, ends.low_bits, len(ends.high), len(ends.samples))
    return b"".join((head, ends.low.tobytes(), ends.high.tobytes(), ends.samples.tobytes(), flat.tobytes()))


class Segment:
    """A segment as written: ends by select, ids as a view of its bytes."""

    def __init__(self, body: bytes):
        mark, self.documents, n_ids, width, low_bits, highs, samples = struct.unpack_from(HEADER, body)
        if mark != MAGIC:
            raise ValueError("not a segment of token ids")
        at = struct.calcsize(HEADER)
        lows = -(-self.documents * low_bits // 8)
        low = np.frombuffer(body, np.uint8, lows, at)
        high = np.frombuffer(body, np.uint8, highs, at + lows)
        picks = np.frombuffer(body, "<u4", samples, at + lows + highs)
        self.ends = EliasFano(self.documents, low_bits, low, high, picks)
        self.ids = np.frombuffer(body, f"<u{width}", n_ids, at + lows + highs + 4 * samples)

    def bounds(self, first: int = 0, stop: int | None = None) -> np.ndarray:
        """Where documents first to stop start, and where the last of them ends."""
        ends = self.ends.select(max(first - 1, 0), self.documents if stop is None else stop)
        return np.concatenate([[0], ends]) if first == 0 else ends


class PieceEncoder:
    """Ids of texts by a tokenizer, with a memory of short pieces of text.

    Where the pre-tokenizer is the byte-level one without a leading space, no token goes over an end as in SURE_END, so a
    text is the chain of its pieces. New ones are joined, encoded in one go and cut by the bytes of their tokens. Batches
    with an added token in them, and all texts under another tokenizer, are encoded whole.
    """

    def __init__(self, source: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        own = json.loads(source)
        self.tokenizer = Tokenizer.from_str(source)
        before, model = own.get("pre_tokenizer") or {}, own["model"]
        self.added = [t["content"] for t in own.get("added_tokens") or ()]
        self.cuts = (
            before.get("type") == "ByteLevel" and not before.get("add_prefix_space") and before.get("use_regex", True)
            and not any(own.get(k) for k in ("normalizer", "truncation", "padding")) and model["type"] == "BPE"
            and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix"))
        )
        size = max(self.tokenizer.get_vocab(True).values()) + 1
        self.kind = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.widths = np.zeros(size, np.int64)  # a sign of a byte-level token is one byte of text
        for token, i in self.tokenizer.get_vocab(False).items():
            self.widths[i] = len(token)
        self.known: dict[str, bytes] = {}
        self.held = 0

    def whole(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        """Ids of words, each with one space before it."""
        made: dict[str, bytes] = {}
        for first in range(0, len(words), 5000):
            own = words[first: first + 5000]
            ids = np.frombuffer(self.whole([" " + " ".join(own)])[0], self.kind)
            sizes = np.cumsum([len(w.encode()) + 1 for w in own])
            ends = np.cumsum(self.widths[ids])
            if ends[-1] != sizes[-1]:
                raise ValueError("token bytes don't add up to the text")
            step, data = self.kind.itemsize, ids.tobytes()
            cuts = ((np.searchsorted(ends, sizes) + 1) * step).tolist()
            made.update(zip(own, [data[a:b] for a, b in zip([0, *cuts], cuts)]))
        return made

    def _cut(self, texts: list[str]) -> list[list[str]]:
        """Texts as their head, words that stand between one space and a sure end, and their tail with its space."""
        out = [t.split(" ") for t in texts]
        # Words in memory are known to be regular, so only new ones are looked at.
        odd = {w for w in set().union(*out).difference(self.known) if not w or w[0].isspace() or w[-1].isspace()}
        for k, words in enumerate(out):
            if len(words) == 1:
                continue
            regular = words[0] and not words[0][-1].isspace() and words[-1] and not words[-1][0].isspace()
            if not regular or odd and not odd.isdisjoint(words[1:-1]):
                pieces = SURE_END.split(texts[k])
                out[k] = pieces[:1] + [p[1:] for p in pieces[1:-1]] + pieces[1:][-1:]
            else:
                words[-1] = " " + words[-1]
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian ids of every text."""
        if not self.cuts or any(a in t for t in texts for a in self.added):
            return self.whole(texts)
        pieces = self._cut(texts)
        inner = [p[1:-1] for p in pieces]
        seen = set().union(*inner)
        new = seen.difference(self.known)
        if self.held > KEEP_BYTES and len(new) > len(seen) / 2:  # filled with words of other texts
            self.known, self.held, new = {}, 0, seen
        known, full = self.known, self.held > KEEP_BYTES
        made = self._learn(list(new))
        known.update(made)
        # What may start or end anyhow is encoded by itself.
        ends = self.whole([p[0] for p in pieces] + [p[-1] if len(p) > 1 else "" for p in pieces])
        find, n = known.__getitem__, len(texts)
        out = [b"".join((ends[k], *map(find, own), ends[n + k])) for k, own in enumerate(inner)]
        for w, ids in made.items():
            if full or len(w) > KEEP_LENGTH:
                del known[w]
            else:
                self.held += 180 + len(w) + len(ids)
        return out


def _encoder(source: str) -> PieceEncoder:
    """One encoder per Python worker, which runs many tasks; it hangs on a module of its own, as this one is new per task."""
    keep = sys.modules.setdefault("rrnlake_token_memory", types.ModuleType("rrnlake_token_memory"))
    key = zlib.crc32(source.encode())
    if getattr(keep, "key", None) != key:
        keep.key, keep.encoder = key, PieceEncoder(source)
    return keep.encoder


def write_store(docs: DataFrame, path: str, tokenizer: str = TOKENIZER, rules: StoreRules = StoreRules()) -> None:
    """Encode doc_id and text of docs and write them under path, in ascending doc_id order (null first).

    A null text is empty; other columns are ignored. Rows that share a doc_id are all written, ordered by a hash of their
    text. Texts are shuffled once; a doc_id of many rows is spread by that hash and by chance. A very long text is a segment
    of its own. The tokenizer file is read here and goes with the task. Runs a job.
    """
    with open(tokenizer, encoding="utf-8") as f:
        source = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(source)
        end = np.array([rules.end_id], encoder.kind).tobytes()
        part, segment, before = TaskContext.get().partitionId(), 0, 0
        names, held, size = [], [], 0

        def full() -> pa.RecordBatch:
            known = [n for n in names if n is not None]
            row = [part, segment, before, size, known[0] if known else None, known[-1] if known else None, names, pack_segment(held)]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(row, (
                pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                ["part", "segment", "before", "n_ids", "first_id", "last_id", "doc_ids", "body"])

        for batch in batches:
            for first in range(0, batch.num_rows, 500):
                rows = batch.slice(first, 500)
                encoded = encoder.encode(rows.column("text").to_pylist())
                for name, ids in zip(rows.column("doc_id").to_pylist(), encoded):
                    names.append(name)
                    held.append(np.frombuffer(ids + end, encoder.kind))
                    size += len(held[-1])
                    if size >= rules.segment_ids:
                        yield full()
                        segment, before = segment + 1, before + size
                        names, held, size = [], [], 0
        if names:
            yield full()

    keys = [F.col("doc_id").asc_nulls_first(), F.col("_tie").asc()]
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("_tie", F.xxhash64("text")).withColumn("_any", F.rand(7))
    ordered = rows.repartitionByRange(*keys, F.col("_any").asc()).sortWithinPartitions(*keys)
    # Partitions of a range sort are numbered in key order, so (part, segment) is the order of the array.
    ordered.select("doc_id", "text").mapInArrow(run, STORED).write.option("compression", "zstd").parquet(path)


def _segments(spark: SparkSession, path: str, low: int | None, high: int | None) -> DataFrame:
    """Segments that may hold doc_ids from low to high, with the ids before each (start)."""
    stored = spark.read.schema(STORED).parquet(path)
    # One row per part, of which there are as many as tasks wrote the store; the window and the broadcast are that small.
    sizes = stored.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_start"))
    found = stored
    if low is not None:
        found = found.filter(F.col("last_id") >= low)
    if high is not None:
        found = found.filter(F.col("first_id") <= high)
    return found.join(F.broadcast(starts), "part").select((F.col("_start") + F.col("before")).alias("start"), "doc_ids", "body")


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document of a store, from its segments alone.

    start counts the ids of all documents before; ids_crc32 is over the ids as little-endian unsigned 32-bit numbers.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                own = Segment(batch.column("body")[k].as_buffer())
                bounds = own.bounds()
                wide = own.ids.astype("<u4")
                sums = [zlib.crc32(wide[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_ids")[k].values, pa.array(bounds[:-1] + batch.column("start")[k].as_py()),
                     pa.array(np.diff(bounds)), pa.array(sums, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return _segments(spark, path, None, None).mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def read_documents(spark: SparkSession, path: str, low: int | None = None, high: int | None = None) -> DataFrame:
    """(doc_id, start, ids) of the documents from low to high, ends included; None is open and brings null ids too.

    Segments outside are pruned by their first and last id; in the others select() reads the bounds of the wanted ones.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                names = batch.column("doc_ids")[k].as_py()
                wanted = [i for i, n in enumerate(names) if n is None and low is None and high is None
                          or n is not None and (low is None or n >= low) and (high is None or n <= high)]
                if not wanted:
                    continue
                own, first, stop = Segment(batch.column("body")[k].as_buffer()), wanted[0], wanted[-1] + 1
                bounds = own.bounds(first, stop)
                values = pa.array(own.ids[bounds[0]: bounds[-1]].astype(np.int64))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names[first:stop], pa.int64()), pa.array(bounds[:-1] + batch.column("start")[k].as_py()),
                     pa.ListArray.from_arrays(pa.array(bounds - bounds[0], pa.int32()), values)], ["doc_id", "start", "ids"])

    return _segments(spark, path, low, high).mapInArrow(run, "doc_id bigint, start bigint, ids array<bigint>")


def store_documents(docs: DataFrame, tokenizer: str = TOKENIZER, rules: StoreRules = StoreRules()) -> DataFrame:
    """Write docs to a new store in the shared folder and return its token_index. An empty table gives no rows. Runs a job."""
    path = shared_path(docs.sparkSession, "token-store")
    write_store(docs, path, tokenizer, rules)
    return token_index(docs.sparkSession, path)
