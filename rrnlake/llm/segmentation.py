"""SentencePiece encoding with the N best segmentations, and decoding.

The pieces of the vocabulary that match a text form a lattice. A forward Viterbi pass gives the best score up to every
position; these scores are the exact rest cost of an A* search that runs backward from the end, so complete paths leave
its agenda in order of their score (Nagata 1994). No piece goes over the start of a white space run, so a text is a chain
of chunks, and its N best segmentations differ from the best only in chunks whose second-best path loses least: the search
runs in those, and its results are combined. The forward pass goes over many chunks at a time, a position after the other.
"""

from __future__ import annotations

import hashlib
import heapq
import sys
import types
from array import array
from collections import Counter
from collections.abc import Iterator
from itertools import chain, pairwise, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark import cloudpickle
from pyspark.sql import DataFrame

# Executors need no copy of this package: the helpers travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"
KEEP_LENGTH, KEEP_BYTES = 64, 32 << 20  # of chunks whose segmentations a Python worker remembers
PART_BYTES, PART_ROWS = 512 << 10, 2000  # of texts encoded together; a longer text is alone
TOGETHER = 4096  # chunks in one forward pass
CHUNK_BYTES, OPTION_BYTES = 220, 200  # about what one remembered chunk, or one alternative of it, takes beside its signs and ids
ENCODED = "doc_id bigint, ids array<int>, nbest array<struct<score: double, edits: array<struct<start: int, length: int, ids: array<int>>>>>"


def _plain(own: sentencepiece.SentencePieceProcessor) -> list[int]:
    """Ids of the pieces that stand for characters."""
    return [i for i in range(own.get_piece_size()) if not (own.is_control(i) or own.is_unknown(i) or own.is_byte(i) or own.is_unused(i))]


class PieceSurface:
    """Bytes of the pieces of a SentencePiece model (bytes of the model file), which decoding needs, without the lattice."""

    def __init__(self, model: bytes):
        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        surface = [b""] * own.get_piece_size()
        for i in _plain(own):
            surface[i] = own.id_to_piece(i).replace(SPACE, " ").encode()
        byte_ids = [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if all(own.is_byte(i) for i in byte_ids):
            for b, i in enumerate(byte_ids):
                surface[i] = bytes([b])
        surface[own.unk_id()] = " ⁇ ".encode()
        self.surface = np.array(surface, dtype=object)

    def decode(self, ids: np.ndarray) -> str:
        """Text of a list of ids, without the leading space that encoding adds. A text's own U+2581 comes back as space."""
        data = b"".join(self.surface[ids].tolist())
        return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


class _EdgeTable:
    """The tree of the pieces' characters as arrays: a node is a slot, the root slot 0.

    Its child by a character's code is slot base[node] + code if owner[] of that slot is the node. Code 0 has no child; a
    space has the code of U+2581. piece[] is the number of the piece that ends at a node, in scores and ids, or -1.
    """

    def __init__(self, pieces: dict[str, tuple[float, int]]):
        counts = Counter(c for p in pieces for c in p)
        codes = {c: k for k, (c, _) in enumerate(counts.most_common(), 1)}
        self.codes = np.zeros(sys.maxunicode + 1, np.int32)
        self.codes[[ord(c) for c in codes]] = list(codes.values())
        self.codes[ord(" ")] = self.codes[ord(SPACE)]
        children: dict[str, list[str]] = {}  # of prefixes that more characters follow
        for prefix in {p[:k] for p in pieces for k in range(1, len(p) + 1)}:
            children.setdefault(prefix[:-1], []).append(prefix)
        # Nodes with most children first, at the next base where the slots of all their children are free.
        edges = sum(map(len, children.values()))
        free = np.ones(2 * (edges + len(codes) + 1), bool)
        free[0] = False
        bases, at, before = {}, 1, 0
        branching = [x for x in children if len(children[x]) > 1]
        for prefix in sorted(branching, key=lambda x: (-len(children[x]), x)):
            wanted = np.sort([codes[x[-1]] for x in children[prefix]])
            if len(wanted) != before:  # start anew
                at, before = int(free.argmax()), len(wanted)
            width = 256
            while prefix not in bases:
                if at + width + len(codes) >= len(free):
                    free = np.concatenate([free, np.ones(width + len(free), bool)])
                fits = np.flatnonzero(free[at : at + width]) + at - wanted[0]
                fits = fits[fits >= 0]
                for code in wanted[1:]:
                    fits = fits[free[fits + code]]
                if fits.size:
                    bases[prefix] = int(fits[0])
                    free[fits[0] + wanted] = False
                else:
                    at, width = at + width, 2 * width
        single = [x for x in children if len(children[x]) == 1]
        left = np.flatnonzero(free[len(codes) :])[: len(single)] + len(codes)
        left = np.append(left, np.arange(len(single) - len(left)) + len(free))
        bases |= {x: at - codes[children[x][0][-1]] for x, at in zip(single, left.tolist())}
        slots = {x: bases[prefix] + codes[x[-1]] for prefix, xs in children.items() for x in xs}
        slots[""] = 0
        size = max(slots.values()) + len(codes) + 2
        self.base, self.owner, self.piece = np.zeros(size, np.int64), np.full(size, -1), np.full(size, -1)
        for prefix, xs in children.items():
            self.base[slots[prefix]] = bases[prefix]
            self.owner[[slots[x] for x in xs]] = slots[prefix]
        # Leaves have no child: from the last base no slot is owned.
        leaves = [at for x, at in slots.items() if x not in children]
        self.base[leaves] = size - len(codes) - 1
        self.piece[[slots[p] for p in pieces]] = np.arange(len(pieces))
        self.scores = np.array([score for score, _ in pieces.values()], float)
        self.ids = np.array([i for _, i in pieces.values()] + [-1], np.int32)

    def matches(self, codes: np.ndarray, ahead: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Of pieces of 1, 2, 3 characters and so on: places where one begins, where it ends, its number.

        The character after that at place k is at place k + ahead[k].
        """
        start = at = np.arange(len(codes))
        node, found = np.zeros(len(codes), np.int64), []
        while True:
            below = self.base[node]
            below += codes[at]
            live = np.flatnonzero(self.owner[below] == node)
            if not live.size:
                return found
            start, node, at = start[live], below[live], at[live]
            at += ahead[at]
            ends = np.flatnonzero(self.piece[node] >= 0)
            found.append((start[ends], at[ends], self.piece[node[ends]]))


class PieceLattice:
    """Vocabulary and scores of a SentencePiece model (bytes of the model file).

    Characters without a piece of their own are unknown: they cost the least score less 10, and are written as byte pieces
    if the model has them. The normaliser must be the identity with a leading space.
    """

    def __init__(self, model: bytes):
        own = sentencepiece.SentencePieceProcessor(model_proto=model)
        probe = "A é  ﬁ\n"
        if own.normalize(probe) != SPACE + probe.replace(" ", SPACE):
            raise ValueError("the model's normaliser isn't the identity with a leading space")
        self.pieces = {own.id_to_piece(i): (own.get_score(i), i) for i in _plain(own)}
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("a piece goes over the start of a white space run")
        # A tree of characters; a node is [lookup of the nodes by next character, score or None, id].
        grown: dict[str, list] = {}
        every = []
        for piece, (score, i) in self.pieces.items():
            nodes = grown
            for c in piece:
                if c not in nodes:
                    nodes[c] = [{}, None, -1]
                    every.append(nodes[c])
                node = nodes[c]
                nodes = node[0]
            node[1:] = score, i
        for node in every:
            node[0] = node[0].get
        self.tree = grown.get
        self.table = _EdgeTable(self.pieces)
        self.longest = max(map(len, self.pieces), default=0)
        self.unknown_id = own.unk_id()
        self.unknown_score = min((s for s, _ in self.pieces.values()), default=0.0) - 10
        self.byte_ids = [own.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        self.has_bytes = all(own.is_byte(i) for i in self.byte_ids)

    def forward(self, chunk: str) -> tuple[list[float], list[list[tuple[int, float, int]]]]:
        """Best score up to each position, and the pieces (start, score, id) that end there; id -1 is unknown."""
        n, longest = len(chunk), self.longest
        best, ends = [0.0] + [-np.inf] * n, [[] for _ in range(n + 1)]
        for s in range(n):
            follow, e = self.tree, s
            for c in chunk[s : s + max(longest, 1)]:
                e += 1
                node = follow(c)
                follow, score, piece = node or (None, None, -1)
                if score is None and e == s + 1:
                    score, piece = self.unknown_score, -1
                if score is not None:
                    ends[e].append((s, score, piece))
                    best[e] = max(best[e], best[s] + score)
                if node is None:
                    break
        return best, ends

    def _ids(self, chunk: str, path: list[tuple[int, int, int]]) -> tuple[int, ...]:
        out = []
        for start, end, i in path:
            if i >= 0:
                out.append(i)
            elif self.has_bytes:
                out.extend(self.byte_ids[b] for b in chunk[start:end].replace(SPACE, " ").encode("utf-8", "replace"))
            else:
                out.append(self.unknown_id)
        return tuple(out)

    def best(self, chunk: str) -> tuple[float, tuple[int, ...], float]:
        """Score and ids of the best path, and what the second-best path loses against it (infinite if there is none).

        The second-best path leaves the best one, seen from the end, at one position by the second-best way to get there.
        """
        n, tree, longest = len(chunk), self.tree, self.longest
        best, second, back = [0.0] + [-np.inf] * n, [-np.inf] * (n + 1), [(0, -1)] * (n + 1)
        for s in range(n):
            here, e = best[s], s + 1
            node = tree(chunk[s])
            if node is None or node[1] is None:
                value, piece = here + self.unknown_score, -1
            else:
                value, piece = here + node[1], node[2]
            if value > best[e]:
                second[e], best[e], back[e] = best[e], value, (s, piece)
            elif value > second[e]:
                second[e] = value
            if node is None:
                continue
            follow = node[0]
            for c in chunk[e : s + longest]:
                node = follow(c)
                if node is None:
                    break
                e += 1
                follow, score, piece = node
                if score is not None:
                    value = here + score
                    if value > best[e]:
                        second[e], best[e], back[e] = best[e], value, (s, piece)
                    elif value > second[e]:
                        second[e] = value
        at, path, gap = n, [], np.inf
        while at:
            lost = best[at] - second[at]
            if lost < gap:
                gap = lost
            start, piece = back[at]
            path.append(piece)
            at = start
        path.reverse()
        if not path or min(path) >= 0:
            return best[n], tuple(path), gap
        steps, at = [], n
        while at:
            steps.append((back[at][0], at, back[at][1]))
            at = back[at][0]
        return best[n], self._ids(chunk, steps[::-1]), gap

    def nbest(self, chunk: str, n: int) -> list[tuple[float, tuple[int, ...]]]:
        """Up to n (loss against the best score, ids), best first.

        The agenda is ordered by the loss of the best complete path through a hypothesis; among equals the one nearer to
        the start of the chunk, then the older one, goes first.
        """
        best, ends = self.forward(chunk)
        agenda, count, out = [(0.0, len(chunk), 0, None)], 0, []
        while agenda and len(out) < n:
            loss, at, _, path = heapq.heappop(agenda)
            if at == 0:
                steps = []
                while path is not None:
                    step, path = path
                    steps.append(step)
                out.append((loss, self._ids(chunk, steps)))
                continue
            for _, start, score, piece in sorted((best[at] - best[s] - score, s, score, i) for s, score, i in ends[at]):
                count += 1
                heapq.heappush(agenda, (loss + best[at] - best[start] - score, start, count, ((start, at, piece), path)))
        return out

    def _unknown(self, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids that stand for unknown characters, a row each, and their numbers."""
        distinct, which = np.unique(marks, return_inverse=True)
        ids = [self._ids(chr(c), [(0, 1, -1)]) for c in distinct.tolist()]
        widths = np.array([len(x) for x in ids], np.int64)
        rows = np.zeros((len(ids), max(widths, default=0)), np.int32)
        for k, x in enumerate(ids):
            rows[k, : len(x)] = x
        return rows[which], widths[which]

    def bests(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """best() of many chunks, none empty: scores, ids one chunk after the other, numbers of ids, gaps.

        Chunks stand side by side, the longest first; a column holds the same position of all that reach it. Columns lie
        one after the other, so a place is a position of a chunk and columns[p] + k the place of chunk k at position p.
        """
        table, count = self.table, len(chunks)
        lengths = np.fromiter(map(len, chunks), np.int64, count)
        order = np.argsort(-lengths, kind="stable")
        lengths = lengths[order]
        reach = np.searchsorted(-lengths, -np.arange(lengths[0] + 1), "right")  # chunks that have the position, or end there
        columns = np.concatenate([[0], np.cumsum(reach)])
        signs = np.frombuffer("".join([chunks[k] for k in order.tolist()]).encode("utf-32-le", "surrogatepass"), np.uint32)
        owner = np.repeat(np.arange(count), lengths)
        position = np.arange(len(signs)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        places = columns[-1]
        marks, codes = np.zeros(places, np.uint32), np.zeros(places, np.int32)  # characters and their codes, 0 at the ends
        stand = columns[position] + owner
        marks[stand], codes[stand] = signs, table.codes[signs]
        found = table.matches(codes, np.repeat(reach, reach))
        best, second = np.full(places, -np.inf), np.full(places, -np.inf)
        best[:count] = 0.0
        back, piece = np.zeros(places, np.int64), np.full(places, -1)
        # Single characters: every position but the last has one, of a piece or unknown.
        single, number = np.full(places, self.unknown_score), np.full(places, -1)
        for begin, _, which in found[:1]:
            single[begin], number[begin] = table.scores[which], which
        longer = [(begin, end, table.scores[which], which, np.searchsorted(begin, columns).tolist()) for begin, end, which in found[1:]]
        for p in range(lengths[0]):
            here, last = columns[p], columns[p] + reach[p + 1]
            a, b = columns[p + 1], columns[p + 1] + reach[p + 1]
            value, known = best[here:last] + single[here:last], best[a:b]
            up = np.flatnonzero(value > known)
            second[a:b] = np.maximum(second[a:b], np.minimum(known, value))
            best[a:b] = np.maximum(known, value)
            back[a + up], piece[a + up] = here + up, number[here + up]
            for begin, end, score, which, bounds in longer:
                lo, hi = bounds[p], bounds[p + 1]
                if lo == hi:
                    continue
                s, e = begin[lo:hi], end[lo:hi]
                value, known = best[s] + score[lo:hi], best[e]
                up = np.flatnonzero(value > known)
                second[e] = np.maximum(second[e], np.minimum(known, value))
                best[e] = np.maximum(known, value)
                back[e[up]], piece[e[up]] = s[up], which[lo:hi][up]
        # From the ends back; ids of all steps are placed when their number is known.
        last = columns[lengths] + np.arange(count)
        lost = best - second
        gaps, at, who = np.full(count, np.inf), last, np.arange(count)
        steps, sizes = [], np.zeros(count, np.int64)
        while who.size:
            gaps[who] = np.minimum(gaps[who], lost[at])
            which, at = piece[at], back[at]
            strange = np.flatnonzero(which < 0)
            instead, widths = self._unknown(marks[at[strange]])
            steps.append((who, which, who[strange], instead, widths))
            sizes[who] += 1
            sizes[who[strange]] += widths - 1
            more = np.flatnonzero(at >= count)
            at, who = at[more], who[more]
        # Back to the order of the caller.
        turned = np.empty(count, np.int64)
        turned[order] = np.arange(count)
        stops = np.cumsum(sizes[turned])[order]
        flat = np.empty(int(sizes.sum()), np.int32)
        for who, which, strange, instead, widths in steps:
            stops[who] -= 1
            stops[strange] -= widths - 1
            flat[stops[who]] = table.ids[which]
            for k in range(instead.shape[1]):
                wide = np.flatnonzero(widths > k)
                flat[stops[strange[wide]] + k] = instead[wide, k]
        return best[last][turned], flat, sizes[turned], gaps[turned]


def _chunks(texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(distinct chunks, which of them stand in the texts, where each text begins among those). Spaces stand for U+2581 here."""
    texts = pc.replace_substring(pc.fill_null(texts.cast(pa.large_string()), ""), SPACE, " ")
    lead = pc.if_else(pc.equal(texts, ""), pa.scalar("", pa.large_string()), pa.scalar(" ", pa.large_string()))
    texts = pc.binary_join_element_wise(lead, texts, pa.scalar("", pa.large_string()))
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    if bounds[-1] == bounds[0]:
        return [], np.empty(0, np.int32), np.zeros(len(bounds), np.int64)
    signs = np.frombuffer(texts.buffers()[2], np.uint8)[: bounds[-1]]
    space = signs == ord(" ")
    first = space.copy()
    first[1:] &= ~space[:-1]
    first[bounds[:-1][bounds[1:] > bounds[:-1]]] = True
    first[: bounds[0]] = False
    starts = np.flatnonzero(first)
    offsets = np.append(starts, bounds[-1])
    coded = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), texts.buffers()[2]).dictionary_encode()
    return coded.dictionary.to_pylist(), coded.indices.to_numpy(), np.searchsorted(starts, bounds)


class _Memory:
    """Best segmentations of the chunks met so far. When they take too many bytes, the quarter that is used most stays.

    Ids of all chunks lie one after the other in one array; chunk k has flat[starts[k] : starts[k + 1]].
    """

    def __init__(self, lattice: PieceLattice, n: int, limit: int = KEEP_BYTES):
        self.lattice, self.n, self.limit = lattice, n, limit
        self._clear()

    def _clear(self) -> None:
        self.places: dict[str, int] = {}
        self.texts: list[str] = []
        self.flat, self.starts = array("i"), array("q", [0])
        self.scores, self.gaps, self.uses = array("d"), array("d"), array("i")
        self.lists: dict[int, list] = {}
        self.long: list[int] = []
        self.held = 0

    def _add(self, chunks: list[str], scores: np.ndarray, ids: np.ndarray, sizes: np.ndarray, gaps: np.ndarray, uses: np.ndarray) -> None:
        at, end = len(self.texts), len(self.flat)
        for kept, new in ((self.scores, scores), (self.gaps, gaps), (self.uses, uses), (self.flat, ids), (self.starts, end + np.cumsum(sizes))):
            kept.frombytes(np.ascontiguousarray(new, kept.typecode).tobytes())
        self.texts += chunks
        self.places.update(zip(chunks, range(at, at + len(chunks))))
        self.held += CHUNK_BYTES * len(chunks) + 2 * sum(map(len, chunks)) + 4 * len(ids)

    def find(self, chunks: list[str]) -> np.ndarray:
        """Places of distinct chunks; those not met before are segmented."""
        found = np.array(list(map(self.places.get, chunks, repeat(-1))), np.int64)
        new = np.flatnonzero(found < 0)
        lengths = np.fromiter((len(chunks[k]) for k in new.tolist()), np.int64, len(new))
        short, long = new[lengths <= KEEP_LENGTH], new[lengths > KEEP_LENGTH]
        found[np.concatenate([short, long])] = len(self.texts) + np.arange(len(new))
        for first in range(0, len(short), TOGETHER):
            part = [chunks[k] for k in short[first : first + TOGETHER].tolist()]
            self._add(part, *self.lattice.bests(part), np.zeros(len(part)))
        if long.size:  # few reach the later positions
            part = [chunks[k] for k in long.tolist()]
            scores, ids, gaps = zip(*(self.lattice.best(c.replace(" ", SPACE)) for c in part))
            self.long += range(len(self.texts), len(self.texts) + len(part))
            flat = np.fromiter(chain.from_iterable(ids), np.int32)
            self._add(part, np.array(scores), flat, np.array(list(map(len, ids))), np.array(gaps), np.zeros(len(part)))
        return found

    def own(self, at: int) -> tuple[int, ...]:
        return tuple(self.flat[self.starts[at] : self.starts[at + 1]])

    def alternatives(self, at: int) -> list[tuple[float, tuple[int, ...]]]:
        if at not in self.lists:
            found = self.lattice.nbest(self.texts[at].replace(" ", SPACE), self.n)
            # The best path comes first in either pass; equal scores are told apart by its ids.
            own = self.own(at)
            self.lists[at] = [(0.0, own)] + [x for x in found if x[1] != own][: self.n - 1]
            self.held += sum(OPTION_BYTES + 8 * len(ids) for _, ids in self.lists[at])
        return self.lists[at]

    def ids(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """ids of chunks one after the other, and where each chunk begins in them, and the end."""
        starts, flat = np.frombuffer(self.starts, np.int64), np.frombuffer(self.flat, np.int32)
        first = starts[places]
        sizes = starts[places + 1] - first
        begins = np.concatenate([[0], np.cumsum(sizes)])
        where = np.repeat(first - begins[:-1], sizes)
        where += np.arange(len(where))
        return flat[where] if len(where) else np.empty(0, np.int32), begins

    def worth(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Scores and gaps of chunks."""
        return np.frombuffer(self.scores)[places], np.frombuffer(self.gaps)[places]

    def used(self, places: np.ndarray, times: np.ndarray) -> None:
        uses = np.frombuffer(self.uses, np.int32)
        uses[places] = np.minimum(uses[places] + times, 1 << 30)

    def trim(self) -> None:
        """Between parts: forget what is not worth its room."""
        if self.held <= self.limit and len(self.long) <= 1000:
            return
        uses = np.array(self.uses)
        uses[self.long] = 0  # long chunks hardly come again
        most = np.flatnonzero(uses > 0)
        most = most[np.argsort(-uses[most], kind="stable")]
        room = self.limit if self.held <= self.limit else self.limit // 4
        lengths = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        bytes_of = CHUNK_BYTES + 2 * lengths[most] + 4 * np.diff(np.frombuffer(self.starts, np.int64))[most]
        most = most[np.cumsum(bytes_of) <= room]
        ids, begins = self.ids(most)
        kept = [self.texts[k] for k in most.tolist()], *self.worth(most), ids, np.diff(begins), uses[most] // 2
        self._clear()
        chunks, scores, gaps, ids, sizes, uses = kept
        self._add(chunks, scores, ids, sizes, gaps, uses)


def _memory(model: bytes, n: int) -> _Memory:
    """One memory per Python worker, which runs many tasks.

    It hangs on a module made for it, since this one comes anew with each task.
    """
    keep = sys.modules.setdefault("rrnlake_segmentation_memory", types.ModuleType("rrnlake_segmentation_memory"))
    key = (hashlib.sha256(model).digest(), n)
    if getattr(keep, "key", None) != key:
        keep.key, keep.memory = key, _Memory(PieceLattice(model), n)
    return keep.memory


def _forget() -> None:
    """Free what the worker remembers of encoding: only room is lost while it decodes, and later encoding starts anew."""
    sys.modules.pop("rrnlake_segmentation_memory", None)


def _encoded(memory: _Memory, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, list[list[tuple[float, list]]]]:
    """ids of the best segmentations of texts, where each text begins in them and the end, and for each text a list of
    (score, edits) of up to n segmentations, best first.

    An edit (start, length, ids) replaces ids of the best segmentation. Null and empty texts have no ids and one
    segmentation of score 0.
    """
    memory.trim()
    distinct, which, firsts = _chunks(texts)
    if not distinct:
        return np.empty(0, np.int32), np.zeros(len(firsts), np.int64), [[(0.0, [])] for _ in range(len(texts))]
    known = memory.find(distinct)
    memory.used(known, np.bincount(which, minlength=len(distinct)))
    places = known[which]
    ids, begins = memory.ids(places)
    scores, gaps = memory.worth(places)
    lists = [_lists(memory, places[a:b], begins[a : b + 1], scores[a:b], gaps[a:b]) if a < b else [(0.0, [])] for a, b in pairwise(firsts.tolist())]
    return ids, begins[firsts], lists


def _lists(memory: _Memory, places: np.ndarray, begins: np.ndarray, scores: np.ndarray, gaps: np.ndarray) -> list[tuple[float, list]]:
    """[(score, edits)] of a text of chunks."""
    want = memory.n - 1
    if len(gaps) > 4 * want:  # the least gaps, and all that equal the last of them
        near = np.flatnonzero(gaps <= np.partition(gaps, max(want - 1, 0))[max(want - 1, 0)])
        chosen = near[np.argsort(gaps[near], kind="stable")[:want]]
    else:
        chosen = np.argsort(gaps, kind="stable")[:want]
    total, chosen = float(scores.sum()), sorted(int(c) for c in chosen if np.isfinite(gaps[c]))
    sums = [(0.0, ())]
    options = {c: memory.alternatives(int(places[c])) for c in chosen}
    for c in chosen:
        grown = [(loss + more, picks + ((c, k),) if k else picks) for loss, picks in sums for k, (more, _) in enumerate(options[c])]
        grown.sort()
        sums = grown[: memory.n]
    return [(total - loss, [(int(begins[c] - begins[0]), int(begins[c + 1] - begins[c]), list(options[c][k][1])) for c, k in picks]) for loss, picks in sums]


def encode_text(memory: _Memory, text: str | None) -> tuple[list[int], list[tuple[float, list]]]:
    """As _encoded, of one text."""
    ids, _, lists = _encoded(memory, pa.array([text], pa.string()))
    return ids.tolist(), lists[0]


def _parts(texts: pa.Array) -> Iterator[tuple[int, int]]:
    """(first, number) of texts to encode together, by their bytes."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < len(texts):
        past = int(np.searchsorted(upto, (upto[first - 1] if first else 0) + PART_BYTES, "right"))
        end = min(max(past, first + 1), first + PART_ROWS)
        yield first, end - first
        first = end


def encode_nbest(docs: DataFrame, n: int = 4, model_path: str = MODEL) -> DataFrame:
    """doc_id, ids and nbest of every document (see encode_text); other columns of docs are ignored.

    The model file is read where this is called and its bytes go with the task, so executors need no file. Repeated rows
    give repeated results, an empty table none. A very long text is one row of one batch.
    """
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(model, n)
        edit = pa.struct([("start", pa.int32()), ("length", pa.int32()), ("ids", pa.list_(pa.int32()))])
        kind = pa.list_(pa.struct([("score", pa.float64()), ("edits", pa.list_(edit))]))
        for batch in batches:
            for first, rows in _parts(batch.column("text")):
                part = batch.slice(first, rows)
                ids, ends, found = _encoded(memory, part.column("text"))
                lists = [[{"score": s, "edits": [{"start": a, "length": k, "ids": i} for a, k, i in e]} for s, e in one] for one in found]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids)), pa.array(lists, kind)],
                    ["doc_id", "ids", "nbest"])

    return docs.select("doc_id", "text").mapInArrow(run, ENCODED)


def decode_ids(encoded: DataFrame, model_path: str = MODEL) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); null ids give null."""
    with open(model_path, "rb") as f:
        model = f.read()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _forget()
        surface = PieceSurface(model)
        for batch in batches:
            for first in range(0, batch.num_rows, 200):
                part = batch.slice(first, 200)
                texts = [surface.decode(i.values.to_numpy()) if i.is_valid else None for i in part.column("ids")]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id bigint, text string")
