"""Repair of conversation structure by grammar-compressed dynamic programming.

A row of a conversation is one of nine symbols: its role (user, assistant, system, other), whole or truncated, or a row that
must go. The cheapest edits are a shortest path through four states - nothing written, a system row, a user row, an
assistant row - so a symbol is a 4 x 4 matrix of costs, and a stretch of rows their min-plus product. Role and fault
sequences are alike across conversations: Re-Pair (Larsson and Moffat 1999) replaces their commonest pairs by rules, and a
rule's matrix is computed once from those of its two parts, bottom-up, for all conversations.

The edits behind an entry are an audit rope: an entry knows the middle state at which its two parts meet, so the string is
the join of theirs. Ties go to the ASCII-least string. Entries also carry the rank of their string among the 16 of their
matrix; strings of equal cost are compared by the ranks of their parts and never spelled out. That is exact for strings of
equal length, and optimal ones have one letter per row: where an insertion costs more than two deletions, no optimum inserts.
"""

from __future__ import annotations

import hashlib
import sys
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window, functions as F

from rrnlake.llm.common import staged
from rrnlake.plans.ordering import with_neighbours

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Signs that aren't white space, sentence ends, symbols of rows (capitals are truncated, x must go).
SOLID = r"[^\x20\x09-\x0D]"
SYMBOLS = "uasoUASOx"
START, SYSTEM, USER, ASSISTANT = range(4)
FIRST_RULE = 0xE000  # rules are characters of a private range, so that a sequence stays a string
NEVER = 1 << 40
_ROW_BITS = 33  # low bits of monotonically_increasing_id() count rows of a partition


@dataclass(frozen=True)
class RepairRules:
    """Costs of edits, sizes of the work. piece_rows bounds what one task holds of a conversation, fan the nodes joined at once."""

    rerole: int = 1
    delete: int = 2
    insert: int = 5
    keep_truncated: int = 5
    piece_rows: int = 2048
    fan: int = 64
    max_rules: int = 512
    pairs_a_round: int = 48
    least_count: int = 2

    def __post_init__(self):
        if not self.insert > 2 * self.delete:
            raise ValueError("an insertion must cost more than two deletions")


def damage_rows(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text), damaged by crc32 of `conv_id:turn` modulo 20; null ids, turns, roles and texts count as one space.

    0 drops the row, 1 empties its text, 2 takes out its sentence ends, 3 repeats it, 4 sets the role user.
    """
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    text = F.coalesce("text", space)
    made = rows.select("conv_id", "turn", F.coalesce("role", space).alias("role"), text.alias("text"), (F.crc32(name.cast("binary")) % 20).alias("_c"))
    return made.filter("_c <> 0").select(
        "conv_id", "turn", F.when(F.col("_c") == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(F.col("_c") == 1, "").when(F.col("_c") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.explode(F.when(F.col("_c") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("_copy"),
    ).drop("_copy")


# ---- matrices ----

def _ranks(keys: np.ndarray) -> np.ndarray:
    """Dense ranks of the 16 keys of each matrix, 0 the least."""
    flat = keys.reshape(len(keys), 16)
    order = np.argsort(flat, axis=1, kind="stable")
    ordered = np.take_along_axis(flat, order, 1)
    steps = np.concatenate([np.zeros((len(flat), 1), np.int64), (ordered[:, 1:] != ordered[:, :-1]).astype(np.int64)], axis=1)
    out = np.empty_like(order)
    np.put_along_axis(out, order, np.cumsum(steps, axis=1), 1)
    return out.reshape(keys.shape)


def product(cost_a, rank_a, cost_b, rank_b) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Min-plus products of matrices (n, 4, 4): costs, ranks of the joined strings, and the middle states."""
    ranks = rank_a[:, :, :, None] * 16 + rank_b[:, None, :, :]
    costs = np.minimum(cost_a[:, :, :, None] + cost_b[:, None, :, :], NEVER)
    middle = (costs * 256 + ranks).argmin(axis=2)
    pick = middle[:, :, None, :]
    cost = np.take_along_axis(costs, pick, 2)[:, :, 0, :]
    return cost, _ranks(np.take_along_axis(ranks, pick, 2)[:, :, 0, :]), middle


def _inserts(rules: RepairRules) -> list[tuple[int, int, int, str]]:
    """What insertions do without a row: (from, to, cost, letters)."""
    one = [(i, USER, rules.insert, "I") for i in (START, SYSTEM, ASSISTANT)] + [(USER, ASSISTANT, rules.insert, "I")]
    two = [(i, ASSISTANT, 2 * rules.insert, "II") for i in (START, SYSTEM)]
    return [(i, i, 0, "") for i in range(4)] + one + two


def _row_moves(symbol: str, rules: RepairRules) -> list[tuple[int, int, int, str]]:
    """What one row may become: (from, to, cost, letter)."""
    moves = [(i, i, rules.delete, "D") for i in range(4)]
    if symbol != "x":
        extra = rules.keep_truncated if symbol.isupper() else 0
        kept = {"u": [(i, USER) for i in (START, SYSTEM, ASSISTANT)], "a": [(USER, ASSISTANT)], "s": [(START, SYSTEM)], "o": []}
        moves += [(i, j, extra, "K") for i, j in kept[symbol.lower()]]
        moves += [(i, j, extra + rules.rerole, "R") for i, j in kept["u"] + kept["a"]]
    return moves


class Grammar:
    """Symbols and rules with their matrices. A rule is a pair of characters; its parts come before it."""

    def __init__(self, pairs: list[str], rules: RepairRules):
        self.pairs = pairs
        self.place = {c: i for i, c in enumerate(SYMBOLS)} | {chr(FIRST_RULE + r): len(SYMBOLS) + r for r in range(len(pairs))}
        n = len(SYMBOLS) + len(pairs)
        self.cost, self.rank, self.middle = np.full((n, 4, 4), NEVER), np.zeros((n, 4, 4), np.int64), np.zeros((n, 4, 4), np.int64)
        self.parts = [(0, 0)] * n
        self.texts: dict[tuple[int, int, int], str] = {}
        inserts = _inserts(rules)
        self.lead = {}  # what insertions do before the first row
        for i, j, cost, letters in inserts:
            self.lead[i, j] = (cost, letters)
        for place, symbol in enumerate(SYMBOLS):
            best: dict[tuple[int, int], tuple[int, str]] = {}
            for i, k, cost, letter in _row_moves(symbol, rules):
                for _, j, more, letters in (x for x in inserts if x[0] == k):
                    best[i, j] = min(best.get((i, j), (NEVER, "")), (cost + more, letter + letters))
            order = {t: r for r, t in enumerate(sorted({t for _, t in best.values()}))}
            for (i, j), (cost, letters) in best.items():
                self.cost[place, i, j], self.rank[place, i, j], self.texts[place, i, j] = cost, order[letters], letters
        # Bottom-up: all rules whose parts are done at once.
        done, left = len(SYMBOLS), list(range(len(pairs)))
        for r in left:
            self.parts[done + r] = (self.place[pairs[r][0]], self.place[pairs[r][1]])
        ready = set(range(done))
        while left:
            now = [r for r in left if set(self.parts[done + r]) <= ready]
            a, b = (np.array([self.parts[done + r][k] for r in now]) for k in (0, 1))
            at = done + np.array(now)
            self.cost[at], self.rank[at], self.middle[at] = product(self.cost[a], self.rank[a], self.cost[b], self.rank[b])
            ready.update(at.tolist())
            left = [r for r in left if done + r not in ready]

    def compress(self, sequence: str) -> str:
        for r, pair in enumerate(self.pairs):
            if pair in sequence:
                sequence = sequence.replace(pair, chr(FIRST_RULE + r))
        return sequence

    def letters(self, place: int, i: int, j: int) -> str:
        """The audit of one entry: the rope spelled out, each part once."""
        stack = [(place, i, j)]
        while stack:
            node = stack[-1]
            if node in self.texts:
                stack.pop()
                continue
            p, a, b = node
            k, (left, right) = int(self.middle[p, a, b]), self.parts[p]
            halves = [(left, a, k), (right, k, b)]
            missing = [h for h in halves if h not in self.texts]
            if missing:
                stack.extend(missing)
            else:
                self.texts[node] = self.texts[halves[0]] + self.texts[halves[1]]
        return self.texts[place, i, j]

    def chain(self, sequence: str):
        """Product of a sequence's matrices: (cost, rank, [middle states per join], places)."""
        places = [self.place[c] for c in self.compress(sequence)]
        cost, rank, middles = self.cost[places[0]][None], self.rank[places[0]][None], []
        for p in places[1:]:
            cost, rank, middle = product(cost, rank, self.cost[p][None], self.rank[p][None])
            middles.append(middle[0])
        return cost[0], rank[0], middles, places

    def audit(self, middles, places, i: int, j: int) -> str:
        """Letters of a chain that goes from state i to state j."""
        found, end = [], j
        for p, middle in zip(reversed(places[1:]), reversed(middles)):
            k = int(middle[i, end])
            found.append(self.letters(p, k, end))
            end = k
        found.append(self.letters(places[0], i, end))
        return "".join(reversed(found))

    def ends(self, cost: np.ndarray, rank: np.ndarray) -> tuple[int, int, int]:
        """(cost, first state, last state) of the cheapest valid whole: it ends with nothing written or an assistant row."""
        best = []
        for k in range(4):
            if (START, k) in self.lead:
                more, letters = self.lead[START, k]
                # A leading insertion never is in an optimum, so its letters needn't enter the order.
                best += [(more + int(cost[k, j]), len(letters), int(rank[k, j]), k, j) for j in (START, ASSISTANT)]
        found = min(best)
        return found[0], found[3], found[4]


def _count_pairs(sequences: DataFrame, pairs: list[str], rules: RepairRules) -> list[tuple[str, int]]:
    """Commonest pairs of neighbours over all sequences as compressed so far; each run of equal symbols counts halves."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, counts = Grammar(pairs, rules), Counter()
        for batch in batches:
            for sequence, n in zip(batch.column("seq").to_pylist(), batch.column("n").to_pylist()):
                own, last, at = grammar.compress(sequence), "", -2
                for i in range(len(own) - 1):
                    pair = own[i:i + 2]
                    if pair != last or i > at + 1:  # the second of "aaa" overlaps the first
                        counts[pair] += n
                        last, at = pair, i
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["pair", "n"])

    found = sequences.mapInArrow(run, "pair string, n bigint").groupBy("pair").agg(F.sum("n").alias("n")).filter(F.col("n") >= rules.least_count)
    top = found.orderBy(F.col("n").desc(), "pair").limit(4 * rules.pairs_a_round)  # rows of a bounded alphabet
    return [(r.pair, r.n) for r in top.collect()]


def learn_pairs(sequences: DataFrame, rules: RepairRules = RepairRules()) -> list[str]:
    """Re-Pair rules of all sequences (seq, n), n being how often each occurs. Runs a job per round.

    A round replaces many pairs at once: the commonest ones that can't overlap, no symbol being the end of one and the
    begin of another. Rules serve speed alone; any set of them gives the same repairs.
    """
    pairs: list[str] = []
    while len(pairs) < rules.max_rules:
        firsts, seconds, chosen = set(), set(), []
        for pair, _ in _count_pairs(sequences, pairs, rules):
            a, b = pair
            alone = a == b and a not in firsts | seconds
            if len(chosen) < min(rules.pairs_a_round, rules.max_rules - len(pairs)) and (
                    alone or a != b and a not in seconds and b not in firsts):
                chosen.append(pair)
                firsts.add(a)
                seconds.add(b)
        if not chosen:
            break
        pairs += chosen
    return pairs


# ---- tables ----

def _ordered(rows: DataFrame) -> DataFrame:
    """rows as a table in the shared folder, numbered by conv_id, turn (nulls first), role and SHA-256 of the text."""
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    last = F.regexp_extract(text, r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    made = rows.select("conv_id", "turn", role.alias("role"), text.alias("text")).withColumns({
        "digest": F.unhex(F.sha2("text", 256)), "last": F.when(F.octet_length("text") < 64, last).otherwise(
            F.coalesce(F.nullif(F.regexp_extract(F.right("text", F.lit(64)), r"(?s)([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1), F.lit("")), last))})
    keys = [F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role").asc(), F.col("digest").asc()]
    spread = made.withColumn("_any", F.rand(11)).repartitionByRange(*keys, F.col("_any").asc())
    return staged(spread.drop("_any").sortWithinPartitions(*keys).withColumn("_slot", F.monotonically_increasing_id()), "turns")


def _numbered(turns: DataFrame) -> DataFrame:
    """turns with idx, 1..n in order."""
    part = F.shiftright("_slot", _ROW_BITS)
    # One row per partition of the sort, so the window and the broadcast are small.
    sizes = turns.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    place = F.col("_before") + F.col("_slot").bitwiseAND((1 << _ROW_BITS) - 1) + 1
    return turns.withColumn("_part", part).join(F.broadcast(offsets), "_part").withColumn("idx", place).drop("_part", "_slot", "_before")


def _marked(turns: DataFrame, block: int) -> DataFrame:
    """Narrow rows: conv_id, turn, idx, symbol, fault, illegal, new_turn, starts, ends."""
    own = F.left("role", F.lit(1))
    narrow = turns.select("conv_id", "turn", "idx", "role", "digest", own.alias("initial"), "last")
    # First places of what occurs more than once. Written, so that the join below shuffles both sides and can split a hot one.
    first = narrow.groupBy("conv_id", "role", "digest").agg(F.min("idx").alias("first"), F.count("*").alias("n")).filter("n > 1")
    first = staged(first.select(F.col("conv_id").alias("_c"), F.col("role").alias("_r"), F.col("digest").alias("_d"), "first"), "repeats")
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("role") == F.col("_r")) & (F.col("digest") == F.col("_d"))
    seen = narrow.join(first, same, "left").withColumn("again", F.coalesce(F.col("idx") > F.col("first"), F.lit(False)))
    fault = F.when(F.col("last") == "", "blank").when(F.col("again"), "duplicate").when(~F.col("last").isin(".", "!", "?"), "truncated").otherwise("")
    near = with_neighbours(seen.select("conv_id", "turn", "idx", "initial", fault.alias("fault")), "idx", ["conv_id", "turn", "initial"], block)
    starts = F.col("prev").isNull() | ~F.col("prev.conv_id").eqNullSafe(F.col("conv_id"))
    ends = F.col("next").isNull() | ~F.col("next.conv_id").eqNullSafe(F.col("conv_id"))
    role = F.when(F.col("initial").isin("u", "a", "s"), F.col("initial")).otherwise("o")
    symbol = F.when(F.col("fault").isin("blank", "duplicate"), "x").when(F.col("fault") == "truncated", F.upper(role)).otherwise(role)
    return near.select(
        "conv_id", "turn", "idx", "fault", symbol.alias("symbol"), starts.alias("starts"), ends.alias("ends"),
        (~starts & ~F.concat("prev.initial", "initial").isin("su", "ua", "au")).alias("illegal"),
        (F.col("turn").isNotNull() & (starts | ~F.col("prev.turn").eqNullSafe(F.col("turn")))).alias("new_turn"),
    )


def _pieces(marked: DataFrame, piece_rows: int) -> DataFrame:
    """Symbols of up to piece_rows neighbouring rows of a conversation: conv_id, node, first, seq, starts, ends."""
    node = F.floor((F.col("idx") - 1) / piece_rows)
    symbols = F.array_sort(F.collect_list(F.struct("idx", "symbol")))
    return marked.groupBy("conv_id", node.alias("node")).agg(
        F.min("idx").alias("first"), F.array_join(F.transform(symbols, lambda s: s["symbol"]), "").alias("seq"),
        F.bool_or("starts").alias("starts"), F.bool_or("ends").alias("ends"))


def _solve(pieces: DataFrame, pairs: list[str], rules: RepairRules, kind: str) -> DataFrame:
    """Whole conversations: their cost and audit. Parts of longer ones: cost and rank, 16 numbers each."""
    schema = f"conv_id {kind}, node bigint, first bigint, seq string, starts boolean, ends boolean, cost bigint, audit string, costs array<bigint>, ranks array<bigint>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar, known = Grammar(pairs, rules), {}
        for batch in batches:
            if len(known) > 50_000:
                known = {}
            total, audits, costs, ranks = [], [], [], []
            for seq, whole in zip(batch.column("seq").to_pylist(), (a and b for a, b in zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist()))):
                found = known.get((seq, whole))
                if found is None:
                    cost, rank, middles, places = grammar.chain(seq)
                    if whole:
                        least, i, j = grammar.ends(cost, rank)
                        found = (least, grammar.lead[START, i][1] + grammar.audit(middles, places, i, j), None, None)
                    else:
                        found = (None, None, cost.ravel().tolist(), rank.ravel().tolist())
                    if len(seq) <= 256:
                        known[seq, whole] = found
                for out, value in zip((total, audits, costs, ranks), found):
                    out.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(total, pa.int64()), pa.array(audits, pa.string()), pa.array(costs, pa.list_(pa.int64())), pa.array(ranks, pa.list_(pa.int64()))],
                [*batch.schema.names, "cost", "audit", "costs", "ranks"])

    return pieces.select("conv_id", "node", "first", "seq", "starts", "ends").mapInArrow(run, schema)


def _joined(nodes: list[dict]) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Product over neighbouring nodes in order, with the middle states."""
    own = [tuple(np.array(n[c], np.int64).reshape(1, 4, 4) for c in ("costs", "ranks")) for n in nodes]
    (cost, rank), middles = own[0], []
    for c, r in own[1:]:
        cost, rank, middle = product(cost, rank, c, r)
        middles.append(middle[0])
    return cost[0], rank[0], middles


def _levels(parts: DataFrame, rules: RepairRules, kind: str) -> tuple[DataFrame, DataFrame]:
    """For parts of long conversations: (conv_id, cost) and (conv_id, node, i, j), the states each part goes between.

    Neighbouring nodes join, fan at a time, into a node of the next level, until each conversation is one; then the states
    go down the same tree. A task holds fan nodes at most of a conversation.
    """
    member = "array<struct<node: bigint, costs: array<bigint>, ranks: array<bigint>>>"
    state = f"conv_id {kind}, node bigint, i int, j int"

    def up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar([], rules)
        for batch in batches:
            made = []
            for nodes, whole in zip(batch.column("members").to_pylist(), batch.column("whole").to_pylist()):
                cost, rank, _ = _joined(nodes)
                found = grammar.ends(cost, rank) if whole else (None, None, None)
                made.append((cost.ravel().tolist(), rank.ravel().tolist(), *found))
            kinds = (pa.list_(pa.int64()), pa.list_(pa.int64()), pa.int64(), pa.int32(), pa.int32())
            new = [pa.array(v, t) for v, t in zip(zip(*made) if made else [()] * 5, kinds)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, "costs", "ranks", "cost", "i", "j"])

    def down(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, rows = [], []
            for at, (nodes, i, j) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("members", "i", "j")))):
                _, _, middles = _joined(nodes)
                for n, middle in zip(reversed(nodes[1:]), reversed(middles)):
                    k = int(middle[i, j])
                    rows.append((n["node"], k, j))
                    take.append(at)
                    j = k
                rows.append((nodes[0]["node"], i, j))
                take.append(at)
            new = [pa.array(v, t) for v, t in zip(zip(*rows) if rows else [()] * 3, (pa.int64(), pa.int32(), pa.int32()))]
            yield pa.RecordBatch.from_arrays([batch.column("conv_id").take(pa.array(take, pa.int64())), *new], ["conv_id", "node", "i", "j"])

    levels, nodes, done = [], parts.select("conv_id", "node", "starts", "ends", "costs", "ranks"), []
    while not nodes.isEmpty():
        groups = nodes.groupBy("conv_id", F.floor(F.col("node") / rules.fan).alias("node")).agg(
            F.array_sort(F.collect_list(F.struct("node", "costs", "ranks"))).cast(member).alias("members"),
            F.bool_or("starts").alias("starts"), F.bool_or("ends").alias("ends")).withColumn("whole", F.col("starts") & F.col("ends"))
        schema = f"conv_id {kind}, node bigint, members {member}, starts boolean, ends boolean, whole boolean, costs array<bigint>, ranks array<bigint>, cost bigint, i int, j int"
        level = staged(groups.mapInArrow(up, schema), "repair-level")
        levels.append(level)
        done.append(level.filter("whole").select("conv_id", "cost"))
        nodes = level.filter("not whole").select("conv_id", "node", "starts", "ends", "costs", "ranks")
    costs, states = done[0] if done else parts.sparkSession.createDataFrame([], f"conv_id {kind}, cost bigint"), None
    for more in done[1:]:
        costs = costs.unionByName(more)
    for level in reversed(levels):
        given = level.filter("whole").select("conv_id", "members", "i", "j")
        if states is not None:
            up_states = states.withColumnsRenamed({"conv_id": "_c", "node": "_n"})
            inner = level.filter("not whole").select("conv_id", "node", "members")
            given = given.unionByName(inner.join(up_states, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("node") == F.col("_n"))).select("conv_id", "members", "i", "j"))
        states = staged(given.mapInArrow(down, state), "repair-states")
    return costs, states if states is not None else parts.sparkSession.createDataFrame([], state)


def _part_audits(parts: DataFrame, states: DataFrame, pairs: list[str], rules: RepairRules, kind: str) -> DataFrame:
    """(conv_id, first, audit) of every part of a long conversation."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        grammar = Grammar(pairs, rules)
        for batch in batches:
            found = []
            for seq, starts, i, j in zip(*(batch.column(c).to_pylist() for c in ("seq", "starts", "i", "j"))):
                _, _, middles, places = grammar.chain(seq)
                found.append((grammar.lead[START, i][1] if starts else "") + grammar.audit(middles, places, i, j))
            yield pa.RecordBatch.from_arrays([batch.column("conv_id"), batch.column("first"), pa.array(found, pa.string())], ["conv_id", "first", "audit"])

    at = states.withColumnsRenamed({"conv_id": "_c", "node": "_n"})
    placed = parts.join(at, F.col("conv_id").eqNullSafe(F.col("_c")) & (F.col("node") == F.col("_n"))).select("conv_id", "first", "seq", "starts", "i", "j")
    return placed.mapInArrow(run, f"conv_id {kind}, first bigint, audit string")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(conv_id, new conversation?, edit, role, text) in order from rows sorted by conversation and place.

    The record of a piece comes before its first row and brings its audit; a letter I stands for a row without source.
    """
    now, opened, letters, at, wanted = None, False, "", 0, "user"

    def insertions():
        nonlocal at, wanted
        while at < len(letters) and letters[at] == "I":
            at += 1
            role, wanted = wanted, "assistant" if wanted == "user" else "user"
            yield now, False, "I", role, ""

    for batch in batches:
        for conv, audit, role, text in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "audit", "role", "text"))):
            if not opened or conv != now:
                yield from insertions()
                now, opened, letters, at, wanted = conv, True, "", 0, "user"
                yield now, True, "", "", ""
            if audit is not None:
                yield from insertions()
                letters, at = audit, 0
                yield from insertions()
                continue
            yield from insertions()
            edit, at = letters[at], at + 1
            if edit == "R":
                role = wanted
            if edit != "D" and role[:1] != "s":
                wanted = "assistant" if role[:1] == "u" else "user"
            yield now, False, edit, role, text
    yield from insertions()


@dataclass(frozen=True)
class Repair:
    """What repair() found: marked rows, cost and audit pieces, and rows with the records of pieces, by conversation."""

    marked: DataFrame
    costs: DataFrame
    stream: DataFrame
    kind: str


def repair(rows: DataFrame, rules: RepairRules = RepairRules()) -> Repair:
    """Find the cheapest edits of rows (conv_id, turn, role, text). Runs jobs."""
    kind = dict(rows.dtypes)["conv_id"]
    turns = _numbered(_ordered(rows))
    marked = staged(_marked(turns, rules.piece_rows), "marked-turns")
    pieces = staged(_pieces(marked, rules.piece_rows), "turn-pieces")
    sequences = staged(pieces.groupBy("seq").agg(F.count("*").alias("n")), "turn-sequences")
    pairs = learn_pairs(sequences, rules)
    solved = staged(_solve(pieces, pairs, rules, kind), "solved-pieces")
    parts = solved.filter("not (starts and ends)")
    whole = solved.filter("starts and ends")
    costs, states = _levels(parts, rules, kind)
    audits = whole.select("conv_id", "first", "audit").unionByName(_part_audits(parts, states, pairs, rules, kind))
    none = F.lit(None).cast("string")
    records = audits.select("conv_id", F.col("first").alias("idx"), F.lit(0).alias("_kind"), "audit", none.alias("role"), none.alias("text"))
    texts = turns.select("conv_id", "idx", F.lit(1).alias("_kind"), none.alias("audit"), "role", "text")
    # A digest of a whole conversation is a chain over its rows: one task streams them and holds one batch.
    stream = records.unionByName(texts).repartition("conv_id").sortWithinPartitions("conv_id", "idx", "_kind")
    return Repair(marked, whole.select("conv_id", "cost").unionByName(costs), stream.select("conv_id", "audit", "role", "text"), kind)


def repaired_rows(rows: DataFrame, rules: RepairRules = RepairRules()) -> DataFrame:
    """(conv_id, place, edit, role, text): the rows of every repaired conversation in order, deleted ones with place null."""
    found = repair(rows, rules)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, place = [], 0
        names = pa.schema([("conv_id", conv), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string())])
        for key, first, edit, role, text in _edited(batches):
            place = 0 if first else place + (edit != "D")
            if not first:
                held.append((key, None if edit == "D" else place, edit, role, text))
            if len(held) >= 1000:
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held), names.types)], schema=names)
                held = []
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*held), names.types)], schema=names)

    from pyspark.sql.pandas.types import to_arrow_type
    conv = to_arrow_type(found.stream.schema["conv_id"].dataType)
    return found.stream.mapInArrow(run, f"conv_id {found.kind}, place bigint, edit string, role string, text string")


def _digests(found: Repair) -> DataFrame:
    """(conv_id, audit, repaired_sha256) per conversation."""
    from pyspark.sql.pandas.types import to_arrow_type
    conv = to_arrow_type(found.stream.schema["conv_id"].dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def record(made):
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*made), (conv, pa.string(), pa.string()))], ["conv_id", "audit", "repaired_sha256"])

        made, letters, digest, written, now = [], None, None, False, None
        for key, first, edit, role, text in _edited(batches):
            if first:
                if letters is not None:
                    made.append((now, "".join(letters), digest.hexdigest()))
                now, letters, digest, written = key, [], hashlib.sha256(), False
                if len(made) >= 5000:
                    yield record(made)
                    made = []
                continue
            letters.append(edit)
            if edit != "D":
                digest.update(b"\n" * written + f"{role}:{text}".encode())
                written = True
        if letters is not None:
            made.append((now, "".join(letters), digest.hexdigest()))
        if made:
            yield record(made)

    return found.stream.mapInArrow(run, f"conv_id {found.kind}, audit string, repaired_sha256 string")


def repair_conversations(rows: DataFrame, keys: DataFrame | None = None, rules: RepairRules = RepairRules()) -> DataFrame:
    """Faults and cheapest repair of every conversation of rows (conv_id, turn, role, text).

    conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256. keys (conv_id) adds conversations
    without rows: zeros, an empty audit, the digest of nothing. Rows are taken by turn (nulls first), then role, then SHA-256
    of the text, so equal rows are neighbours. A null role or text is one space; an empty or unknown role is never kept. A
    null conv_id is a conversation of its own; other columns are ignored; no rows and no keys give no rows. A conversation
    of any length is cut into pieces; only its digest is one task's work, which streams. Runs jobs.
    """
    found = repair(rows, rules)
    count = lambda name: F.sum(F.when(F.col("fault") == name, 1).otherwise(0)).alias(name)
    wide: Column = F.max("turn").cast("decimal(38,0)") - F.min("turn") + 1 - F.sum(F.col("new_turn").cast("long"))
    counted = found.marked.groupBy("conv_id").agg(
        F.coalesce(wide.try_cast("bigint"), F.lit(0)).alias("gaps"), count("blank"), count("duplicate"), count("truncated"),
        F.sum(F.col("illegal").cast("long")).alias("illegal"))
    every = rows.select("conv_id") if keys is None else rows.select("conv_id").unionByName(keys.select("conv_id"))
    out = every.distinct()
    for name, more in (("_a", counted), ("_b", found.costs), ("_c", _digests(found))):
        out = out.join(more.withColumnRenamed("conv_id", name), F.col("conv_id").eqNullSafe(F.col(name)), "left").drop(name)
    zero = {c: F.coalesce(c, F.lit(0)).cast("long") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    return out.withColumns(zero | {
        "audit": F.coalesce("audit", F.lit("")), "repaired_sha256": F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)),
    }).select("conv_id", *zero, "audit", "repaired_sha256")
