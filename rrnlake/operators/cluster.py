"""Greedy clustering by identity, in parallel rounds that equal the sequential scan.

The scan reads sequences in order (existing centroids first, then longest
first). A sequence that matches an earlier centroid is a hit, any other becomes
a centroid. Two sequences match when the shorter one turns into a stretch of the
longer one with at most floor((1 - identity) * length of the shorter) edits. A
hit belongs to the matching centroid with the fewest edits, the earliest one on
a tie.

Work is kept near linear without losing a match:

* exact copies are folded first, so a third of all rows being copies is one row;
* a pair meets only on rare minimizers of its shorter sequence. Each stands for a
  window of bases; of d+1 windows that lie apart, d edits leave one, so d+1 keys
  are looked up, the rarest such. Minimizers seen once meet nobody. Windows are half
  as long as the stretch that a match must share, so that common ones can be left
  out, and a repeat counts with all its windows. Lengths are in classes with words
  of their own; each class looks for its words in all longer sequences;
* the windows whose keys the longer sequence lacks must be hit by d edits. This is
  counted on arrays of keys, before any bases move, where keys are few;
* a round looks only at the first `m` open sequences of each minimizer. Those
  that no earlier open sequence matches are centroids for sure. They are compared
  to what follows them, and what they cover leaves the round. `m` grows, so a
  family with many centroids takes few rounds. No group is ever paired with itself;
* sequences under 64 bases that allow no edit come last: containment carries over,
  so one is a hit exactly if a centroid or another such sequence holds it, and the
  earliest holder is its centroid. They need no rounds (_pieces), and are looked up
  where the bases of the holders are, so a common word moves none. Only who asks for
  all pairs (similarity_pairs) has them looked for in all centroids.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from rrnlake.functions.alignment import compare_pairs, member_scripts
from rrnlake.functions.minimizers import KEY_BITS, anchor_span, lost_by_edits, minimizers, probe_keys, shared_keys, whole_at, whole_word
from rrnlake.functions.pieces import pieces_inside
from rrnlake.plans.durable import durable, written
from rrnlake.plans.ordering import dense_index
from rrnlake.plans.sizing import BROADCAST_ROWS, broadcast_if_small, spread

LONG = 64  # classes of words double up to here
LONGER = (256, 512)  # least lengths of further classes, where their sequences share longer stretches
LOW_K = 20
LEAST_SPAN = 24  # windows of fewer bases are in too many sequences
# Row limits up to this size are applied before the shuffle (WindowGroupLimit).
MAX_HEADS = 1000
# Keys are compared per pair only where windows have at least so many words; else they are no smaller than the bases.
COUNTED_WINDOW = 8
# Short sequences look for their earliest holder among so many first ones before they meet all.
FIRST_HOLDERS = (64, 4096)
TILE = 1 << 14
PAIRS = 2_000  # compared in a task, about
PIECES = 100_000  # short sequences looked for at a time in all centroids


@dataclass(frozen=True)
class Clusters:
    """Result of a clustering run.

    members: cluster_id, seqid, centroid, is_centroid, edits, offset, identity - one row per input row.
    representatives: place, seqid, seq, priority, copies - one row per distinct sequence.
    matches: place, centroid_place, edits, offset - every match of a sequence with a centroid, but those of `pieces`
        inside one.
    pieces: place - hits under 64 bases that allow no edit.
    heads: place - the centroids.
    """

    members: DataFrame
    representatives: DataFrame
    matches: DataFrame
    pieces: DataFrame
    heads: DataFrame

    def centroids(self) -> DataFrame:
        """Centroid sequences (operon_id, seq)."""
        heads = self.members.filter("is_centroid").select("seqid")
        return self.representatives.join(heads, "seqid", "left_semi").select(
            F.col("seqid").alias("operon_id"), "seq"
        )

    def records(self) -> DataFrame:
        """S, H and C cluster records."""
        none = F.lit(None).cast("bigint")
        rows = self.members.select(
            F.when(F.col("is_centroid"), "S").otherwise("H").alias("rec_type"),
            "cluster_id", none.alias("size"), F.col("seqid").alias("query"),
        )
        sums = self.members.groupBy("cluster_id").agg(
            F.count("*").alias("size"), F.max(F.when(F.col("is_centroid"), F.col("seqid"))).alias("query")
        )
        return rows.unionByName(sums.select(F.lit("C").alias("rec_type"), "cluster_id", "size", "query"))


def _numbered(rows: DataFrame) -> DataFrame:
    """Rows as a table, with a number: names and digests are read again without their bases."""
    return rows if "row" in rows.columns else written(rows.withColumn("row", F.monotonically_increasing_id()), "sequences")


def _representatives(rows: DataFrame) -> DataFrame:
    """One row per distinct sequence, numbered in scan order, as a table whose bases are read only where they are named.

    What is folded and sorted has no bases; they are picked by row.
    """
    rows = _numbered(rows).withColumn("length", F.octet_length("seq"))
    folded = rows.groupBy("digest").agg(
        F.min(F.struct("priority", "seqid", "row")).alias("r"), F.any_value("length").alias("length"), F.count("*").alias("copies")
    )
    reps = folded.select("r.*", "copies", "length")
    placed = durable(
        dense_index(reps, [F.col("priority"), F.col("length").desc(), F.col("seqid")], "place").select("row", "place", "copies"))
    return written(rows.join(broadcast_if_small(placed), "row").drop("row").withColumn("word", whole_word("seq")), "representatives")


def _edit_length(identity: float) -> int:
    """The least length that allows an edit, LONG at most: shorter sequences are pieces (see _pieces)."""
    return next((n for n in range(1, LONG) if int((1 - identity) * n + 1e-9) >= 1), LONG)


def _doubling(length: Column) -> Column:
    """The least length of the class: a power of two under LONG."""
    return F.when(length >= LONG, LONG).otherwise(F.pow(F.lit(2.0), F.floor(F.log2(F.greatest(length, F.lit(1)))))).cast("int")


def _bounds(identity: float, longest: int) -> list[int]:
    """Least lengths of the classes from LONG up: another one only where its sequences share much longer stretches."""
    out = [LONG]
    for low in LONGER:
        if low <= longest and 3 * anchor_span(identity, low, longest) >= 4 * anchor_span(identity, out[-1], longest):
            out.append(low)
    return out


def _span(identity: float, low: int, high: int) -> int:
    """Bases of a window. Half of what a match must share leaves a choice of windows; short ones are too common for that."""
    whole = anchor_span(identity, low, high)
    return max(min(whole, LEAST_SPAN), whole // 2)


def _sketches(reps: DataFrame, identity: float) -> DataFrame:
    """place, cls, own, keys, starts, length, span, edits, counted per sequence and class of words.

    A sequence has all words of its own class, and of each shorter class those that sequences of that class have. A word
    stands for the windows of `span` bases from `starts` to the next; a longer sequence that matches has the words of all
    windows without an edit.
    """
    sized = reps.filter(F.col("length") >= _edit_length(identity))
    longest = sized.agg(F.max("length")).first()[0] or 0
    own = _doubling(F.col("length"))
    for bound in _bounds(identity, longest)[1:]:
        own = F.when(F.col("length") >= bound, bound).otherwise(own)
    present = sized.groupBy(own.alias("cls")).agg(F.min("length").alias("lo"), F.max("length").alias("hi"))
    edits = F.floor(F.lit(1 - identity) * F.col("length") + F.lit(1e-9))
    made = reps.sparkSession.createDataFrame([], (
        "place bigint, cls int, own boolean, keys array<bigint>, starts array<int>, length int, span int, edits bigint, counted boolean"))
    classes = sorted(tuple(r) for r in present.collect())  # one row per doubling of lengths under LONG, few above
    for cls, low, high in classes:
        span = _span(identity, low, high)
        k = max(1, min(LOW_K, span * 2 // 3), span // 2)
        w = span - k + 1

        def words(some: DataFrame) -> DataFrame:
            return (
                spread(some.select("place", "length", "seq"), "place")
                .select("place", "length", edits.alias("edits"), minimizers(F.col("seq"), k, w).alias("m"))
                .select("place", "length", "edits", F.transform("m.keys", lambda key: F.shiftrightunsigned(F.xxhash64(F.lit(cls), key), 64 - KEY_BITS)).alias("keys"), "m.starts")
            )

        home = [F.lit(span).alias("span"), "edits", F.lit(w >= COUNTED_WINDOW).alias("counted")]
        sketch = written(words(sized.filter(own == cls)).select(
            "place", F.lit(cls).alias("cls"), F.lit(True).alias("own"), "keys", "starts", "length", *home), "sketches")
        made = made.unionByName(sketch)
        if cls != classes[-1][0]:
            asked = sketch.select(F.explode("keys").alias("key")).distinct()
            longer = words(sized.filter(own > cls)).select("place", F.explode(F.array_distinct("keys")).alias("key"))
            # A sequence has at most its own length of keys, so this list is bounded.
            found = longer.join(broadcast_if_small(asked), "key", "left_semi").groupBy("place").agg(F.collect_list("key").alias("keys"))
            made = made.unionByName(written(found.select(
                "place", F.lit(cls).alias("cls"), F.lit(False).alias("own"), "keys", F.lit(None).cast("array<int>").alias("starts"),
                F.lit(None).cast("int").alias("length"), F.lit(span).alias("span"), F.lit(None).cast("bigint").alias("edits"),
                F.lit(w >= COUNTED_WINDOW).alias("counted")), "sketches"))
    return made


def _anchors(sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(probes, index): keys a sequence must be found by, and all places of those keys."""
    shared = durable(shared_keys(sketches.select(F.array_distinct("keys").alias("keys"))))
    own = sketches.filter("own")
    # A sequence has at most its own length of keys, so these lists are bounded. Only keys that others have move.
    listed = (
        own.select("place", F.posexplode("keys").alias("at", "key")).join(broadcast_if_small(shared), "key")
        .groupBy("place").agg(F.collect_list(F.struct("at", "key", "n")).alias("x"))
    )
    probes = durable(own.select("place", "starts", "length", "span", "edits").join(listed, "place").select(
        "place", F.explode(probe_keys("starts", "length", "span", "edits", "x.at", "x.key", "x.n")).alias("key")))
    wanted = broadcast_if_small(probes.select("key").distinct())
    every = sketches.select("place", F.explode(F.array_distinct("keys")).alias("key"))
    index = durable(every.join(wanted, "key", "left_semi"))
    return probes, index


def _meet(probes: DataFrame, index: DataFrame) -> DataFrame:
    """Distinct (place, centroid_place) that share a key, centroid first; place is the shorter one."""
    heads = index.select("key", F.col("place").alias("centroid_place"))
    return (
        probes.join(heads, "key")
        .filter(F.col("centroid_place") < F.col("place"))
        .select("place", "centroid_place")
        .distinct()
    )


def _of(rows: DataFrame, pairs: DataFrame, side: str, n: int) -> DataFrame:
    """The rows whose place is in one of the n pairs; the others don't move."""
    some = pairs.select(F.col(side).alias("place")).distinct()
    return rows.join(F.broadcast(some) if n <= BROADCAST_ROWS else some, "place", "left_semi")


def _share_enough(pairs: DataFrame, sketches: DataFrame, shorter: str = "place", longer: str = "centroid_place") -> DataFrame:
    """Pairs whose longer sequence has all keys of the shorter one but those its edits can touch. No bases move."""
    pairs = durable(pairs)
    n = pairs.count()
    if not n:
        return pairs.select("place", "centroid_place")
    own = _of(sketches.filter("own"), pairs, shorter, n).select(
        F.col("place").alias(shorter), "cls", "starts", "length", "span", "edits", "counted", F.col("keys").alias("_k"))
    other = _of(sketches, pairs, longer, n).select(F.col("place").alias(longer), "cls", F.col("keys").alias("_l"))
    counted = pairs.join(own.filter("counted"), shorter).join(other, [longer, "cls"])
    kept = counted.filter(lost_by_edits("_k", "starts", "length", "_l", "span", "edits")).select("place", "centroid_place")
    return kept.union(pairs.join(own.filter("not counted").select(shorter), shorter, "left_semi").select("place", "centroid_place"))


def _verify(pairs: DataFrame, reps: DataFrame, identity: float) -> DataFrame:
    """The pairs that match, with edits and ungapped offset."""
    facts = ["place", "length", "word", "digest"]
    pairs = durable(pairs)
    n = pairs.count()
    if not n:
        return pairs.select("place", "centroid_place", F.lit(0).alias("edits"), F.lit(0).alias("offset"))
    a = _of(reps.select(*facts), pairs, "place", n).toDF("place", "_n", "_aw", "_ad")
    b = _of(reps.select(*facts), pairs, "centroid_place", n).toDF("centroid_place", "_m", "_bw", "_bd")
    inner = F.col("_n") <= F.col("_m")
    sided = durable(pairs.join(a, "place").join(b, "centroid_place").select(
        "place", "centroid_place", inner.alias("inner"), F.least("_n", "_m").alias("size"),
        F.when(inner, F.col("_aw")).otherwise(F.col("_bw")).alias("w"), F.when(inner, F.col("_ad")).otherwise(F.col("_bd")).alias("d"),
        F.when(inner, F.col("centroid_place")).otherwise(F.col("place")).alias("longer")))
    edits = F.floor(F.lit(1 - identity) * F.col("size") + F.lit(1e-9))
    # Where no edit is allowed, the hashes of the shorter one go to the bases of the longer one.
    exact = sided.filter(edits == 0)
    whole = reps.select(F.col("place").alias("longer"), "seq").join(F.broadcast(exact) if n <= BROADCAST_ROWS else exact, "longer")
    whole = whole.withColumn("at", whole_at("seq", "size", "w", "d")).filter("at >= 0").select(
        "place", "centroid_place", F.lit(0).alias("edits"), F.when(F.col("inner"), F.col("at")).otherwise(-F.col("at")).alias("offset"))
    near = sided.filter(edits > 0).select("place", "centroid_place")
    left = _of(reps, near, "place", n).select("place", F.col("seq").alias("_a"))
    right = _of(reps, near, "centroid_place", n).select(F.col("place").alias("centroid_place"), F.col("seq").alias("_b"))
    # Pairs are few bytes but much work: a number of partitions that is given is not made smaller.
    parts = max(reps.sparkSession.sparkContext.defaultParallelism, n // PAIRS)
    joined = near.repartition(parts, "place").join(left, "place").repartition(parts, "centroid_place").join(right, "centroid_place")
    compared = joined.withColumn("v", compare_pairs("_a", "_b", F.lit(identity)))
    return compared.filter("v.edits >= 0").select("place", "centroid_place", "v.edits", "v.offset").unionByName(whole)


def _standing(pieces: DataFrame, reps: DataFrame, early: bool = False) -> DataFrame:
    """(place, holder, at): pieces (place, _p, cls) inside longer ones of reps, with their first place there.

    Every word of a class's least length is looked up among the pieces that begin with it, where the bases of the longer
    sequence are, so these do not move. Pieces are broadcast, a counted number at a time.
    """
    ends = F.octet_length("seq")
    tiles = reps.filter(F.col("length") > 0).select(
        F.col("place").alias("holder"), "length", F.col("seq").cast("binary").alias("_s"),
        F.explode(F.sequence(F.lit(1), ends, F.lit(TILE))).alias("_t"),
    ).select("holder", "length", "_t", F.substring("_s", F.col("_t"), F.lit(TILE + LONG - 1)).alias("_s"))
    if early:  # few long sequences
        tiles = tiles.repartition(reps.sparkSession.sparkContext.defaultParallelism)
    found = None
    for cls, n in sorted(tuple(r) for r in pieces.groupBy("cls").count().collect()):  # LONG's doublings at most
        slices = -(-n // BROADCAST_ROWS)
        words = tiles.filter(F.octet_length("_s") >= cls).select(
            "holder", "length", "_t", "_s",
            F.explode(F.sequence(F.lit(1), F.least(F.lit(TILE), F.octet_length("_s") - (cls - 1)))).alias("_i"))
        words = words.withColumn("key", F.xxhash64(F.substring("_s", F.col("_i"), F.lit(cls))))
        own = pieces.filter(F.col("cls") == cls).select("place", "_p", F.xxhash64(F.substring("_p", 1, cls)).alias("key"))
        for part in range(slices):
            some = own.filter(F.pmod(F.xxhash64("place"), F.lit(slices)) == part)
            inside = (F.octet_length("_p") < F.col("length")) & (F.substring("_s", F.col("_i"), F.octet_length("_p")) == F.col("_p"))
            met = words.join(F.broadcast(some), "key").filter(inside)
            met = met.select("place", "holder", (F.col("_t") + F.col("_i") - 2).alias("at"))
            found = met if found is None else found.unionByName(met)
    if found is None:
        return reps.sparkSession.createDataFrame([], "place bigint, holder bigint, at int")
    return found.groupBy("place", "holder").agg(F.min("at").alias("at"))


def _looked_for(pieces: DataFrame, reps: DataFrame) -> DataFrame:
    """(place, _p, cls) of pieces (place) that have a base."""
    own = reps.filter((F.col("length") > 0) & (F.col("length") < LONG)).join(pieces.select("place"), "place", "left_semi")
    return durable(own.select("place", F.col("seq").cast("binary").alias("_p"), _doubling(F.col("length")).alias("cls")))


def _earliest(pieces: DataFrame, holders: DataFrame, reps: DataFrame) -> DataFrame:
    """(place, centroid_place, offset): the earliest of the holders (place) that has a piece inside, without edits.

    The first holders, which are the longest, are looked at first: they hold nearly all words of a few bases. Only pieces
    that are in none of them go on, so a word that all sequences hold does not meet them all.
    """
    left, found, after = _looked_for(pieces, reps), None, 0
    # As many places as FIRST_HOLDERS has at most.
    first = [r[0] for r in holders.select("place").orderBy("place").limit(FIRST_HOLDERS[-1]).collect()]
    for bound in [*(first[n - 1] for n in FIRST_HOLDERS if n <= len(first)), None]:
        near = reps.filter(F.col("place") > after)
        near = near if bound is None else near.filter(F.col("place") <= bound)
        met = _standing(left, near, bound is not None).join(holders.select(F.col("place").alias("holder")), "holder", "left_semi")
        best = durable(met.groupBy("place").agg(F.min(F.struct("holder", "at")).alias("b")).select(
            "place", F.col("b.holder").alias("centroid_place"), F.col("b.at").alias("offset")))
        found = best if found is None else found.unionByName(best)
        if bound is None:
            return found
        left, after = durable(_without(left, best)), bound
        if left.isEmpty():
            return found


def _pieces(reps: DataFrame, places: DataFrame, centroids: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(centroids, matches) among new pieces: sequences under 64 bases that allow no edit.

    places are those of the new ones not matched so far; they meet all centroids and each other.
    """
    pieces = reps.select("place", "length").join(places, "place", "left_semi")
    holders = durable(centroids.select("place").union(pieces.select("place")))
    found = _earliest(pieces, holders, reps)
    # An empty sequence is a stretch of any other.
    head = holders.agg(F.min("place")).first()[0]
    empty = pieces.filter(F.col("length") == 0).filter(F.col("place") > F.lit(head)).select(
        "place", F.lit(head).cast("bigint").alias("centroid_place"), F.lit(0).alias("offset"))
    matches = durable(found.unionByName(empty).select("place", "centroid_place", F.lit(0).alias("edits"), "offset"))
    return durable(_without(pieces.select("place"), matches.select("place"))), matches


def _without(df: DataFrame, other: DataFrame, key: str = "place") -> DataFrame:
    return df.join(other.select(F.col(key).alias("place")), "place", "left_anti")


def _only(df: DataFrame, other: DataFrame) -> DataFrame:
    return df.join(other.select("place"), "place", "left_semi")


def _rounds(
    reps: DataFrame, sketches: DataFrame, probes: DataFrame, index: DataFrame, open_: DataFrame, rest: DataFrame,
    identity: float,
):
    """Resolve all open places; yields (centroids, matches) per round.

    `rest` are the sequences that may still be given a closer centroid.
    """
    m = 1
    while not open_.isEmpty():
        order = Window.partitionBy("key").orderBy("place")
        seen = _only(index, open_).withColumn("r", F.row_number().over(order)).filter(F.col("r") <= m)
        heads = durable(seen.select("key", "place"))
        ours = _only(probes, open_)
        # A sequence is settled when every key it must be found by shows all open ones before it.
        unsettled = ours.join(heads, ["key", "place"], "left_anti")
        settled = _without(open_, unsettled.select("place").distinct())
        if m > 1:
            blocked = _verify(_share_enough(_meet(_only(ours, settled), heads), sketches), reps, identity)
            new = durable(_without(settled, blocked.select("place").distinct()))
        else:
            new = durable(settled)
        rest = _without(rest, new)
        found = durable(_verify(_share_enough(_meet(_only(probes, rest), _only(index, new)), sketches), reps, identity))
        yield new, found
        covered = found.select("place").distinct()
        open_ = durable(_without(_without(open_, new), covered))
        rest = durable(rest)
        m = min(m * 4, MAX_HEADS)


def _against_existing(reps: DataFrame, sketches: DataFrame, probes: DataFrame, index: DataFrame, identity: float) -> DataFrame:
    """Matches of new sequences with existing centroids; either may be the shorter one."""
    sides = reps.select("place", "priority", "length")
    old, new = sides.filter("priority = 0"), sides.filter("priority = 1")
    sizes = reps.select("place", "length")
    old_sizes = sizes.withColumnsRenamed({"place": "centroid_place", "length": "_c"})
    by_new = _meet(_only(probes, new), _only(index, old)).join(sizes, "place").join(old_sizes, "centroid_place").filter("length <= _c")
    by_old = _only(probes, old).select("key", F.col("place").alias("centroid_place")).join(
        _only(index, new), "key"
    ).select("place", "centroid_place").distinct().join(sizes, "place").join(old_sizes, "centroid_place").filter("_c < length")
    names = ["place", "centroid_place"]
    pairs = _share_enough(by_new.select(*names), sketches).union(
        _share_enough(by_old.select(*names), sketches, "centroid_place", "place"))
    # Existing pieces may stand in any longer new sequence.
    pieces = old.filter(F.col("length") < _edit_length(identity))
    held = _standing(_looked_for(pieces, reps), reps.filter("priority = 1")).select(
        F.col("holder").alias("place"), F.col("place").alias("centroid_place"), F.lit(0).alias("edits"), (-F.col("at")).alias("offset"))
    empty = pieces.filter("length = 0").agg(F.min("place")).first()[0]  # there is one at most
    if empty is not None:
        held = held.unionByName(new.filter("length > 0").select(
            "place", F.lit(empty).cast("bigint").alias("centroid_place"), F.lit(0).alias("edits"), F.lit(0).alias("offset")))
    return durable(_verify(pairs, reps, identity).unionByName(held))


def greedy_cluster(seqs: DataFrame, identity: float = 0.999, existing: DataFrame | None = None) -> Clusters:
    """Cluster (seqid, seq). With `existing`, its sequences stay centroids and win.

    `existing` holds the centroids of an earlier run, which do not match each
    other; new sequences become centroids only where none of them represents them.
    """
    def rows(df: DataFrame, priority: int) -> DataFrame:
        return df.select("seqid", "seq", F.sha2(F.col("seq"), 256).alias("digest"), F.lit(priority).alias("priority"))

    every = rows(seqs, 1) if existing is None else rows(existing, 0).unionByName(rows(seqs, 1))
    every = _numbered(every)
    reps = _representatives(every)
    sketches = _sketches(reps, identity)
    probes, index = _anchors(sketches)
    places = reps.select("place", "priority", "length")
    new = places.filter("priority = 1")
    centroids = places.filter("priority = 0").select("place")
    none = places.filter("false").select(
        "place", F.col("place").alias("centroid_place"), F.lit(0).alias("edits"), F.lit(0).alias("offset")
    )
    matches = none if existing is None else _against_existing(reps, sketches, probes, index, identity)
    with_edits = durable(new.filter(F.col("length") >= _edit_length(identity)).select("place"))
    covered = matches.select("place").distinct()
    open_ = with_edits if existing is None else durable(_without(with_edits, covered))
    for found_heads, found in _rounds(reps, sketches, probes, index, open_, with_edits, identity):
        centroids = centroids.union(found_heads.select("place"))
        matches = matches.unionByName(found)
    centroids = durable(centroids)
    pieces, first = new.filter(F.col("length") < _edit_length(identity)).select("place"), none
    if not pieces.isEmpty():
        heads, first = _pieces(reps, pieces if existing is None else _without(pieces, covered), centroids)
        centroids = durable(centroids.union(heads))
    return _result(every, reps, centroids, matches, first, _without(pieces, centroids))


def _result(
    every: DataFrame, reps: DataFrame, centroids: DataFrame, matches: DataFrame, first: DataFrame, pieces: DataFrame
) -> Clusters:
    # Best centroid per hit: fewest edits, then earliest.
    best = matches.unionByName(first).groupBy("place").agg(F.min(F.struct("edits", "centroid_place", "offset")).alias("b"))
    hits = best.select("place", "b.centroid_place", "b.edits", "b.offset")
    own = centroids.select(
        "place", F.col("place").alias("centroid_place"), F.lit(0).alias("edits"), F.lit(0).alias("offset")
    )
    placed = own.unionByName(hits)
    names = reps.select("place", F.col("seqid").alias("rep"), "digest", "length")
    heads = reps.select(F.col("place").alias("centroid_place"), F.col("seqid").alias("centroid"), F.col("length").alias("_cl"))
    resolved = placed.join(names, "place").join(heads, "centroid_place")
    shorter: Column = F.least("length", "_cl")
    identity = F.when(shorter > 0, 1 - F.col("edits") / shorter).otherwise(F.lit(1.0))
    members = durable(
        every.select("seqid", "digest")
        .join(resolved, "digest")
        .select(
            F.col("centroid_place").alias("cluster_id"), "seqid", "centroid",
            (F.col("seqid") == F.col("centroid")).alias("is_centroid"),
            "edits", "offset", identity.alias("identity"),
        )
    )
    return Clusters(members, reps.select("place", "seqid", "seq", "priority", "copies"), matches, pieces, centroids)


def cluster_incremental(existing: DataFrame, new: DataFrame, identity: float = 0.999) -> Clusters:
    """Add sequences to a centroid set (seqid, seq): only those it does not represent become centroids."""
    return greedy_cluster(new, identity, existing)


def similarity_pairs(clusters: Clusters) -> DataFrame:
    """Every match of a distinct sequence with a centroid: (seqid, centroid, edits, identity)."""
    named = clusters.representatives.select("place", "seqid", F.octet_length("seq").alias("_n"))
    heads = named.toDF("centroid_place", "centroid", "_m")
    shorter = F.least("_n", "_m")
    identity = F.when(shorter > 0, 1 - F.col("edits") / F.greatest(shorter, F.lit(1))).otherwise(F.lit(1.0))
    pairs = (
        clusters.matches.join(named, "place")
        .join(heads, "centroid_place")
        .select("seqid", "centroid", "edits", identity.alias("identity"))
    )
    return pairs.unionByName(_held(clusters))


def _held(clusters: Clusters) -> DataFrame:
    """The pairs of all pieces with all centroids that hold them, each found where the bases of the centroid are.

    There are as many as pieces and centroids multiplied where all hold a short word, so none of them is moved.
    """
    reps = clusters.representatives
    wanted = durable(reps.filter(F.octet_length("seq") < LONG).join(clusters.pieces, "place", "left_semi").select("place", "seqid", "seq"))
    n, found = wanted.count(), []
    holders = reps.join(broadcast_if_small(clusters.heads), "place", "left_semi")
    for part in range(-(-n // PIECES)):
        some = wanted.filter(F.pmod(F.xxhash64("place"), F.lit(-(-n // PIECES))) == part)
        words = [(r.place, r.seq.encode()) for r in some.select("place", "seq").collect()]  # PIECES of them, about
        inside = holders.select(F.col("seqid").alias("centroid"), F.explode(pieces_inside(words)("seq")).alias("place"))
        names = F.broadcast(some.select("place", "seqid"))
        found.append(inside.join(names, "place").select("seqid", "centroid", F.lit(0).alias("edits"), F.lit(1.0).alias("identity")))
    none = reps.filter("false").select("seqid", F.col("seqid").alias("centroid"), F.lit(0).alias("edits"), F.lit(1.0).alias("identity"))
    return reduce(DataFrame.unionByName, found, none)


def consensus(clusters: Clusters) -> DataFrame:
    """Majority base per centroid column: (cluster_id, operon_id, seq). See consensus_of."""
    reps = clusters.representatives.select("seqid", "seq", "copies")
    # Copies other than the representative have no row here; they vote with its number of copies.
    return consensus_of(clusters.members.select("cluster_id", "seqid", "is_centroid", "edits").join(reps, "seqid"))


def consensus_of(ballots: DataFrame, identity: float | None = None) -> DataFrame:
    """(cluster_id, operon_id, seq) of given clusters: the most common base in every column of the centroid.

    ballots: cluster_id, seqid, seq, is_centroid, copies, and edits, the most that a member may differ; without edits,
    identity gives them. Every member votes on the columns it covers, with its copies: a base, a gap, or bases behind a
    column. A base behind a column enters when more members have it than have not. The centroid wins ties, then the
    greater base. A member above its limit does not vote.

    Votes are sparse: only where a member differs from its centroid is there a row, and what agrees follows from the
    number of members that cover the column. Windows run over the columns of one centroid that differ.
    """
    heads = ballots.filter("is_centroid").select("cluster_id", F.col("seqid").alias("operon_id"), F.col("seq").alias("_c"), F.col("copies").alias("_own"))
    short = F.least(F.octet_length("seq"), F.octet_length("_c"))
    limit = F.col("edits") if identity is None else F.floor(F.lit(1 - identity) * short + F.lit(1e-9)).cast("int")
    script = member_scripts("seq", "_c", limit)
    others = ballots.filter(~F.col("is_centroid")).join(heads.drop("operon_id", "_own"), "cluster_id")
    scripts = written(others.select("cluster_id", "copies", script.alias("s")).filter("s.start is not null").select("cluster_id", "copies", "s.*"), "member-scripts")
    votes = scripts.select("cluster_id", "copies", F.explode("diffs").alias("d")).groupBy("cluster_id", "d.column", "d.place", "d.base").agg(F.sum("copies").alias("n"))
    votes = durable(votes.withColumn("behind", F.col("place") > 0))
    # Members that cover a column, or both a column and the next one: a running sum over where stretches begin and end.
    ends = scripts.select("cluster_id", F.explode(F.array(
        F.struct(F.lit(False).alias("behind"), F.col("start").alias("at"), F.col("copies").alias("by")),
        F.struct(F.lit(False).alias("behind"), F.col("stop").alias("at"), (-F.col("copies")).alias("by")),
        F.struct(F.lit(True).alias("behind"), F.col("start").alias("at"), F.col("copies").alias("by")),
        F.struct(F.lit(True).alias("behind"), F.greatest(F.col("stop") - 1, F.col("start")).alias("at"), (-F.col("copies")).alias("by")),
    )).alias("e")).groupBy("cluster_id", "e.behind", "e.at").agg(F.sum("e.by").alias("by"))
    columns = votes.select("cluster_id", "behind", F.col("column").alias("at")).distinct()
    order = Window.partitionBy("cluster_id", "behind").orderBy("at", "asked").rowsBetween(Window.unboundedPreceding, 0)
    cover = (
        ends.filter(F.col("by") != 0).withColumn("asked", F.lit(False))
        .unionByName(columns.withColumns({"by": F.lit(0).cast("bigint"), "asked": F.lit(True)}))
        .withColumn("cover", F.sum("by").over(order)).filter("asked")
        .select("cluster_id", "behind", F.col("at").alias("column"), "cover")
    )
    against = votes.groupBy("cluster_id", "column", "place", "behind").agg(
        F.sum("n").alias("differ"), F.max(F.struct("n", "base")).alias("top"))
    won = (
        against.join(cover, ["cluster_id", "behind", "column"]).join(heads.select("cluster_id", "_own"), "cluster_id")
        .filter(F.col("top.n") > F.col("_own") + F.col("cover") - F.col("differ"))
        .select("cluster_id", F.struct("column", "place", F.col("top.base").alias("base")).alias("change"))
    )
    # At most a few changes per column of one sequence.
    changes = won.groupBy("cluster_id").agg(F.array_sort(F.collect_list("change")).alias("changes"))

    def step(done: Column, change: Column) -> Column:
        keep = change["column"] + F.when(change["place"] > 0, 1).otherwise(0) - done["at"]
        kept = F.substring(F.col("_c"), done["at"] + 1, keep)
        base = F.when(change["base"] == "-", "").otherwise(change["base"])
        return F.struct(F.concat(done["out"], kept, base).alias("out"), (change["column"] + 1).alias("at"))

    folded = F.aggregate("changes", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step)
    merged = heads.join(changes, "cluster_id", "left").withColumn("f", F.when(F.col("changes").isNotNull(), folded))
    tail = F.substring(F.col("_c"), F.col("f.at") + 1, F.length("_c"))
    return merged.select("cluster_id", "operon_id", F.coalesce(F.concat("f.out", tail), F.col("_c")).alias("seq"))
