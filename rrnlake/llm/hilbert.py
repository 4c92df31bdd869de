"""Sharding along a Hilbert curve over several metadata dimensions.

Columns are quantised to cells of equal width, the cells of a row give its index on the curve, rows are put in the order
of that index and cut into runs. Rows of a shard are then close in every dimension, so the least and greatest values that
a file format keeps of each column rule out most shards for a filter on any of them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from rrnlake.llm.common import staged
from rrnlake.plans.ordering import dense_index

SHARDS = 40
BITS = 6  # per dimension


def _rotate_right(x: int, by: int, n: int) -> int:
    by %= n
    return ((x >> by) | (x << (n - by))) & ((1 << n) - 1)


def curve_tables(n: int) -> tuple[list[int], list[int]]:
    """(digit, next state) by state * 2**n + the bits of one level.

    A state is the corner where the curve enters a cell and the axis along which it leaves, entry * n + axis
    (Hamilton and Rau-Chaplin, "Compact Hilbert indices", 2008).
    """
    size = 1 << n
    gray = [i ^ (i >> 1) for i in range(size)]
    rank = {g: i for i, g in enumerate(gray)}

    def turn(i: int) -> int:  # the axis that changes between sub-cells i and i + 1
        return (~i & (i + 1)).bit_length() - 1

    def entry(w: int) -> int:
        return 0 if w == 0 else gray[2 * ((w - 1) // 2)]

    def axis(w: int) -> int:
        if w == 0:
            return 0
        return (turn(w) if w % 2 else turn(w - 1)) % n

    digits, states = [], []
    for state in range(size * n):
        e, d = divmod(state, n)
        for cell in range(size):
            w = rank[_rotate_right(cell ^ e, d + 1, n)]
            new_e = e ^ _rotate_right(entry(w), n - ((d + 1) % n), n)
            digits.append(w)
            states.append(new_e * n + (d + axis(w) + 1) % n)
    return digits, states


def curve_index(cells: list[Column], bits: int) -> Column:
    """The index of the point given by its cells, each from 0 to 2**bits - 1."""
    n = len(cells)
    digits, states = curve_tables(n)
    as_array = lambda x: F.expr(f"array({','.join(map(str, x))})")
    levels = F.array(*[
        sum((F.shiftright(c, level).bitwiseAND(F.lit(1)) * (1 << (n - 1 - i)) for i, c in enumerate(cells)), F.lit(0)).cast("int")
        for level in range(bits - 1, -1, -1)
    ])

    def step(acc: Column, cell: Column) -> Column:
        at = acc["state"] * (1 << n) + cell
        return F.struct(
            (acc["index"] * (1 << n) + F.get(as_array(digits), at)).alias("index"), F.get(as_array(states), at).alias("state")
        )

    start = F.struct(F.lit(0).cast("long").alias("index"), F.lit(0).alias("state"))
    return F.aggregate(levels, start, step, lambda acc: acc["index"])


def string_key(c: Column) -> Column:
    """The first seven UTF-8 bytes as a number, in code point order; null stays null."""
    head = F.rpad(F.hex(F.substring(c.cast("binary"), 1, 7)), 14, "0")
    return F.conv(head, 16, 10).cast("double")


def curve_order(df: DataFrame, dims: dict[str, Column], ties: list[str], bits: int = BITS, name: str = "place") -> DataFrame:
    """Number the rows of df 1..n along the curve over dims (numeric expressions); adds `curve` and name.

    Each dimension is cut into 2**bits cells of equal width between its least and greatest value; null and NaN lie in the
    first cell. Rows of one cell follow in the order of the columns in ties. Runs jobs.
    """
    rows = staged(df.withColumns({f"_dim{i}": c.cast("double") for i, c in enumerate(dims.values())}), "curve")
    names = [f"_dim{i}" for i in range(len(dims))]
    clean = {d: F.when(~F.isnan(d), F.col(d)) for d in names}
    ends = rows.agg(*[f(clean[d]).alias(f"{f.__name__}{d}") for d in names for f in (F.min, F.max)]).first()
    last = (1 << bits) - 1
    cells = []
    for d in names:
        low, high = ends[f"min{d}"], ends[f"max{d}"]
        width = (high - low) if low is not None and high > low else 1.0
        at = F.floor((clean[d] - F.lit(low or 0.0)) / F.lit(width) * (last + 1)).cast("int")
        cells.append(F.coalesce(F.least(at, F.lit(last)), F.lit(0)))
    placed = rows.withColumns({f"_cell{i}": c for i, c in enumerate(cells)})
    curve = curve_index([F.col(f"_cell{i}") for i in range(len(cells))], bits)
    placed = placed.withColumn("curve", curve).drop(*names, *[f"_cell{i}" for i in range(len(cells))])
    return dense_index(placed, [F.col(c) for c in ("curve", *ties)], name)


def shard_documents(docs: DataFrame, shards: int = SHARDS, bits: int = BITS) -> DataFrame:
    """doc_id, size, text_crc32, curve, law, shard, slot of every document, cut under the law `rows`.

    Dimensions: doc_id, size, lang, source. Shards hold counts that differ by one at most; slot counts from 0 along the
    curve. Null text counts as empty for text_crc32 and size; null metadata lies in the first cell. Repeated rows keep
    their own slots. An empty table gives no rows; columns other than doc_id, text, lang and source are ignored.
    """
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 16).cast("long").alias("size"),
        F.crc32(F.coalesce("text", F.lit(""))).alias("text_crc32"),
        string_key(F.col("lang")).alias("_lang"), string_key(F.col("source")).alias("_source"),
    )
    dims = {"doc_id": F.col("doc_id"), "size": F.log2("size"), "lang": F.col("_lang"), "source": F.col("_source")}
    ordered = curve_order(rows, dims, ["text_crc32", "doc_id"], bits)
    total = ordered.count()
    before = F.col("place") - 1
    shard = F.expr(f"(place - 1) * {shards} div {max(total, 1)}")
    first = F.expr(f"(shard * {total} + {shards - 1}) div {shards}")
    return (
        ordered.withColumn("shard", shard.cast("int"))
        .withColumn("slot", (before - first).cast("long"))
        .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                F.lit(None).cast("int").alias("grown_shard"), "curve")
    )


def write_shards(docs: DataFrame, placed: DataFrame, path: str) -> None:
    """Write docs (with unique doc_id) as one folder per shard, each sorted by slot."""
    rows = docs.join(placed.select("doc_id", "shard", "slot"), "doc_id")
    rows.repartition("shard").sortWithinPartitions("shard", "slot").drop("slot").write.partitionBy("shard").parquet(path)
