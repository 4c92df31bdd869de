"""Clustering against a sequential twin in plain Python."""

import itertools
import random

import numpy as np
import pytest

from rrnlake.functions.alignment import infix_edits, member_script
from rrnlake.functions.minimizers import anchor_span, rare_keys
from rrnlake.operators import cluster


def edit_table(short, long):
    """Edits of short inside long, by the full table."""
    row = [0] * (len(long) + 1)
    for i, a in enumerate(short, 1):
        now = [i]
        for j, b in enumerate(long, 1):
            now.append(min(row[j - 1] + (a != b), row[j] + 1, now[j - 1] + 1))
        row = now
    return min(row)


def mutate(rng, seq, edits):
    seq = list(seq)
    for _ in range(edits):
        at = rng.randrange(len(seq))
        kind = rng.randrange(3)
        if kind == 0:
            seq[at] = rng.choice("ACGT")
        elif kind == 1:
            seq.insert(at, rng.choice("ACGT"))
        else:
            del seq[at]
    return "".join(seq)


def make_sequences(seed, families=12, members=9):
    """Families of near copies and pieces, with a block shared by most of them, and exact copies."""
    rng = random.Random(seed)
    block = "".join(rng.choice("ACGT") for _ in range(120))
    out = []
    for f in range(families):
        root = "".join(rng.choice("ACGT") for _ in range(rng.randrange(80, 700)))
        if f % 3:
            root = root[:40] + block + root[40:]
        for _ in range(members):
            piece = root
            if rng.random() < 0.3:
                cut = rng.randrange(0, max(1, len(root) - 70))
                piece = root[cut:cut + rng.randrange(70, 700)]
            out.append(mutate(rng, piece, rng.choice([0, 0, 1, 2, 4, 8])))
    out += [block, block, out[0], "ACGT", "ACGT", "GG", "", ""]
    roots = [s for s in out if len(s) > 66]
    for _ in range(40):  # pieces of every length, most of them inside a longer sequence
        root = rng.choice(roots)
        cut = rng.randrange(0, len(root) - 65)
        piece = root[cut:cut + rng.randrange(1, 64)]
        out.append(mutate(rng, piece, 1) if rng.random() < 0.4 else piece)
    rng.shuffle(out)
    return [(f"s{i:03d}", s) for i, s in enumerate(out)]


def match(a, b, identity):
    """Edits if the two match, else None."""
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    limit = int((1 - identity) * len(short) + 1e-9)
    edits = infix_edits(short.encode(), long.encode(), limit)  # checked against edit_table below
    return edits if edits >= 0 else None


def sequential(rows, identity, existing=()):
    """seqid -> centroid by one scan; best centroid over the final centroid list before it."""
    order = [(0, n, s) for n, s in existing] + [(1, n, s) for n, s in rows]
    order.sort(key=lambda r: (r[0], -len(r[2]), r[1]))
    first = {}
    for r in order:
        first.setdefault(r[2], r)
    centroids, owner = [], {}
    for r in order:
        if first[r[2]] is not r:
            owner[r[1]] = owner[first[r[2]][1]]
            continue
        best = None
        for place, c in enumerate(centroids):
            edits = match(r[2], c[2], identity) if r[0] == 1 else None
            if edits is not None and (best is None or (edits, place) < best[:2]):
                best = (edits, place, c[1])
        if best is None:
            centroids.append(r)
            owner[r[1]] = r[1]
        else:
            owner[r[1]] = best[2]
    return owner


@pytest.mark.parametrize("identity,seed", [(0.999, 1), (0.99, 2), (0.97, 3)])
def test_equals_sequential_scan(spark, identity, seed):
    rows = make_sequences(seed)
    df = spark.createDataFrame(rows, "seqid string, seq string").repartition(5)
    found = cluster.greedy_cluster(df, identity).members.collect()
    assert {r.seqid: r.centroid for r in found} == sequential(rows, identity)
    assert len(found) == len(rows)


def test_many_centroids_share_every_key(spark):
    """A chain of near copies, each beyond the limit of the next: many centroids in one family."""
    rng = random.Random(7)
    seq = "".join(rng.choice("ACGT") for _ in range(300))
    rows = []
    for i in range(60):
        rows.append((f"c{i:02d}", seq))
        seq = mutate(rng, seq, rng.choice([1, 2, 3]))
    df = spark.createDataFrame(rows, "seqid string, seq string")
    found = cluster.greedy_cluster(df, 0.99).members.collect()
    assert {r.seqid: r.centroid for r in found} == sequential(rows, 0.99)


def test_existing_centroids_win(spark):
    rows = make_sequences(5)
    old, new = rows[:50], rows[50:]
    first = sequential(old, 0.97)
    seqs = dict(rows)
    kept = [(n, seqs[n]) for n in sorted(set(first.values()))]
    a = spark.createDataFrame(kept, "seqid string, seq string")
    b = spark.createDataFrame(new, "seqid string, seq string")
    out = cluster.cluster_incremental(a, b, 0.97)
    assert {r.seqid: r.centroid for r in out.members.collect()} == sequential(new, 0.97, kept)
    kinds = [r.rec_type for r in out.records().collect()]
    assert kinds.count("S") == kinds.count("C")
    assert kinds.count("S") + kinds.count("H") == len(kept) + len(new)


def test_result_does_not_depend_on_partitions(spark):
    rows = make_sequences(9, families=6)
    df = spark.createDataFrame(rows, "seqid string, seq string")
    got = []
    for n, parts in ((1, "1"), (13, "5")):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        got.append(sorted(cluster.greedy_cluster(df.repartition(n), 0.97).members.collect()))
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert got[0] == got[1]


def test_consensus_outvotes_the_centroid(spark):
    rng = random.Random(3)
    base = "".join(rng.choice("ACGT") for _ in range(200))
    other = "A" if base[100] != "A" else "C"
    better = base[:100] + other + base[101:]
    rows = [("a", base), ("b", better[5:]), ("c", better[:-3]), ("d", better[2:]), ("e", "ACGT" * 30)]
    df = spark.createDataFrame(rows, "seqid string, seq string")
    out = cluster.greedy_cluster(df, 0.97)
    assert {r.operon_id: r.seq for r in cluster.consensus(out).collect()} == {"a": better, "e": "ACGT" * 30}
    pairs = {(r.seqid, r.centroid): r.edits for r in cluster.similarity_pairs(out).collect()}
    assert pairs == {("b", "a"): 1, ("c", "a"): 1, ("d", "a"): 1}


def test_infix_edits_equals_full_table():
    rng = random.Random(11)
    for _ in range(300):
        long = "".join(rng.choice("ACGT"[: rng.choice([2, 4])]) for _ in range(rng.randrange(8, 60)))
        cut = rng.randrange(0, len(long) - 5)
        short = mutate(rng, long[cut:cut + rng.randrange(5, 40)], rng.randrange(4))
        if len(short) > len(long):
            short, long = long, short
        for limit in range(min(5, len(short))):
            want = edit_table(short, long)
            assert infix_edits(short.encode(), long.encode(), limit) == (want if want <= limit else -1)


def rebuilt(centroid, start, stop, differences):
    """The member that a script describes, as far as the centroid's columns go."""
    own = {(c, p): b for c, p, b in differences}
    out = []
    for column in range(start - 1, stop):
        if column >= start:
            base = own.get((column, 0), centroid[column])
            out.append("" if base == "-" else base)
        place = 1
        while (column, place) in own:
            out.append(own[column, place])
            place += 1
    return "".join(out)


def test_scripts_rebuild_members_with_fewest_edits():
    rng = random.Random(12)
    for _ in range(400):
        letters = "ACGT"[: rng.choice([2, 4])]
        one = "".join(rng.choice(letters) for _ in range(rng.randrange(8, 60)))
        cut = rng.randrange(0, len(one) - 5)
        two = mutate(rng, one[cut:cut + rng.randrange(5, 40)], rng.randrange(5))
        want = edit_table(*sorted((one, two), key=len)) if len(one) != len(two) else edit_table(two, one)
        for member, centroid in ((two, one), (one, two)):
            if len(one) == len(two) and member is one:
                continue
            assert want == 0 or member_script(member.encode(), centroid.encode(), want - 1) is None
            start, stop, differences = member_script(member.encode(), centroid.encode(), want + 1)
            assert len(differences) == want
            back = rebuilt(centroid, start, stop, differences)
            assert back == member if len(member) <= len(centroid) else back in member


def test_equal_gaps_get_one_place():
    centroid = "ACGTTTTTACGCGCGCAGT"
    for cut in range(3, 8):
        assert member_script((centroid[:cut] + centroid[cut + 1:]).encode(), centroid.encode(), 2)[2] == [(3, 0, "-")]
        assert member_script((centroid[:cut] + "T" + centroid[cut:]).encode(), centroid.encode(), 2)[2] == [(2, 1, "T")]
    for cut in (9, 10, 11, 12, 13):
        assert member_script((centroid[:cut] + centroid[cut + 2:]).encode(), centroid.encode(), 2)[2] == [(9, 0, "-"), (10, 0, "-")]


def test_consensus_counts_gaps_and_insertions(spark):
    """Votes known from planted edits, at places where an edit can be read in one way only."""
    rng = random.Random(8)
    rows, want = [], {}
    for cluster_id in range(40):
        centroid = "ACGT" * 3 + "".join(rng.choice("ACGT") for _ in range(280))
        sites = [c for c in range(30, 260, 25) if len({centroid[c - 1], centroid[c], centroid[c + 1]}) == 3]
        edits = {c: rng.choice(["sub", "del", "ins"]) for c in sites}
        letter = {c: next(x for x in "GATC" if x not in (centroid[c - 1], centroid[c], centroid[c + 1])) for c in sites}
        weights = rng.randrange(1, 4)
        rows.append((cluster_id, f"c{cluster_id}", centroid, True, weights, 0))
        members = []
        for m in range(rng.randrange(1, 8)):
            start, stop = rng.randrange(0, 20), rng.randrange(240, len(centroid) + 1)
            own = {c for c in sites if rng.random() < 0.55 and start + 8 < c < stop - 8}
            seq = "".join(
                (letter[c] if edits[c] == "sub" else "" if edits[c] == "del" else centroid[c] + letter[c]) if c in own else centroid[c]
                for c in range(start, stop))
            copies = rng.randrange(1, 4)
            members.append((start, stop, own, copies))
            rows.append((cluster_id, f"m{cluster_id}_{m}", seq, False, copies, len(own)))
        out = []
        for c in range(len(centroid)):
            base, behind = centroid[c], ""
            if c in edits:
                have = sum(w for _, _, own, w in members if c in own)
                cover = sum(w for a, b, _, w in members if a <= c and c + (edits[c] == "ins") < b)
                if have > weights + cover - have:
                    base, behind = {"sub": (letter[c], ""), "del": ("", ""), "ins": (base, letter[c])}[edits[c]]
            out.append(base + behind)
        want[cluster_id] = "".join(out)
    df = spark.createDataFrame(rows, "cluster_id long, seqid string, seq string, is_centroid boolean, copies long, edits int")
    got = {r.cluster_id: (r.operon_id, r.seq) for r in cluster.consensus_of(df).collect()}
    assert got == {k: (f"c{k}", v) for k, v in want.items()}
    assert sum(want[r[0]] != r[2] for r in rows if r[3]) > 20
    loose = {r.cluster_id: r.seq for r in cluster.consensus_of(df.drop("edits"), 0.95).collect()}
    assert loose == want
    assert cluster.consensus_of(df.limit(0)).count() == 0


def test_spans_hold_for_all_lengths():
    for identity in (0.9, 0.97, 0.985, 0.99, 0.999, 1.0):
        for low, high in ((64, 64), (64, 300), (8, 15), (34, 63), (100, 3000)):
            spans = [-(-(n - d) // (d + 1)) for n in range(low, high + 1) for d in [int((1 - identity) * n + 1e-9)]]
            assert anchor_span(identity, low, high) == min(spans)


def test_pieces_join_and_existing_pieces_win(spark):
    rng = random.Random(21)
    root = "".join(rng.choice("ACGT") for _ in range(300))
    rows = [("long", root), ("p60", root[50:110]), ("p63", root[200:263]), ("p9", root[100:109]), ("other", "GTCA" * 12), ("none", "")]
    df = spark.createDataFrame(rows, "seqid string, seq string")
    found = {r.seqid: r.centroid for r in cluster.greedy_cluster(df, 0.999).members.collect()}
    assert found == sequential(rows, 0.999) and found["p60"] == found["p63"] == found["p9"] == found["none"] == "long"
    for old in ([rows[1]], [rows[3], rows[4]], [rows[5]]):
        new = [r for r in rows if r not in old]
        got = cluster.cluster_incremental(*(spark.createDataFrame(x, df.schema) for x in (old, new)), 0.999)
        assert {r.seqid: r.centroid for r in got.members.collect()} == sequential(new, 0.999, old)


def test_short_sequences_find_the_earliest_holder_where_its_bases_are(spark, monkeypatch):
    """A word that all sequences hold must not move all of them to the pieces that begin with it."""
    rng = random.Random(31)
    common = "".join(rng.choice("ACGT") for _ in range(16))
    rows = [(f"h{i:03d}", "".join(rng.choice("ACGT") for _ in range(200)) + common + "".join(rng.choice("ACGT") for _ in range(200 - i))) for i in range(60)]
    rows += [(f"p{i:03d}", rows[i][1][200:200 + n]) for i, n in zip(range(0, 60, 3), range(17, 60, 2))]
    rows += [("tiny", common[:5]), ("one", "A"), ("lost", common + common), ("none", "")]
    monkeypatch.setattr(cluster, "FIRST_HOLDERS", (2, 7))
    monkeypatch.setattr(cluster, "TILE", 50)
    df = spark.createDataFrame(rows, "seqid string, seq string")
    out = cluster.greedy_cluster(df, 1.0)
    found = {r.seqid: r for r in out.members.collect()}
    assert {k: r.centroid for k, r in found.items()} == sequential(rows, 1.0)
    seqs = dict(rows)
    assert all(seqs[r.centroid].find(seqs[k]) == r.offset for k, r in found.items())
    reps = cluster._representatives(df.selectExpr("seqid", "seq", "sha2(seq, 256) AS digest", "1 AS priority"))
    met = cluster._standing(cluster._looked_for(reps.filter("length < 64"), reps), reps)
    plan = met._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert moved and not any("holder" not in line for line in moved)  # only pairs move, folded
    want = {(p, h, b.find(a)) for p, a in seqs.items() if 0 < len(a) < 64 for h, b in seqs.items() if len(a) < len(b) and a in b}
    names = {r.place: r.seqid for r in reps.collect()}
    assert {(names[r.place], names[r.holder], r["at"]) for r in met.collect()} == want


def test_sequences_with_a_common_run_do_not_meet(spark):
    """A run of short repeats that all hold must not pair all of them, above or below the length that allows an edit."""
    rng = random.Random(41)

    def text(n):
        return "".join(rng.choice("ACGT") for _ in range(n))

    rows = [(f"r{i:02d}", text(420 + i) + "CGAA" * 60 + text(420)) for i in range(30)]
    rows += [(f"s{i:02d}", text(150 + i) + "CGAA" * 60 + text(150)) for i in range(30)]
    rows += [("near", rows[3][1][:700] + "G" + rows[3][1][700:]), ("piece", rows[5][1][100:1000]), ("small", rows[31][1][40:190])]
    df = spark.createDataFrame(rows, "seqid string, seq string")
    reps = cluster._representatives(df.selectExpr("seqid", "seq", "sha2(seq, 256) AS digest", "1 AS priority"))
    sketches = cluster._sketches(reps, 0.999)
    probes, index = cluster._anchors(sketches)
    names = {r.place: r.seqid for r in reps.collect()}
    pairs = cluster._share_enough(cluster._meet(probes, index), sketches)
    met = {frozenset((names[r.place], names[r.centroid_place])) for r in pairs.collect()}
    assert met == {frozenset(p) for p in (("near", "r03"), ("piece", "r05"), ("small", "s01"))}
    assert {r.seqid: r.centroid for r in cluster.greedy_cluster(df, 0.999).members.collect()} == sequential(rows, 0.999)


def test_rare_keys_outlast_all_edits():
    rng = random.Random(42)
    for _ in range(300):
        starts = np.array(sorted(rng.sample(range(60), rng.randrange(1, 9))))
        counts = np.array([rng.randrange(1, 5) for _ in starts])
        span, edits = rng.randrange(1, 20), rng.randrange(3)
        chosen = rare_keys(starts, counts, span, edits)
        hits = [{int(s) for s in starts if s <= at < s + span} for at in range(80)]
        ways = [set().union(*way) for way in itertools.combinations(hits, edits)]
        if any(way >= {int(s) for s in starts} for way in ways):
            assert len(chosen) == len(starts)
        else:
            assert len(chosen) == edits + 1 and not any(way >= {int(s) for s in starts[chosen]} for way in ways)
            fewer = starts[counts < counts[chosen].max()]
            assert any(way >= {int(s) for s in fewer} for way in ways)


@pytest.mark.parametrize("identity", [0.99, 0.999, 1.0])
def test_classes_of_long_sequences_equal_the_scan(spark, identity):
    """Pieces and near copies over all classes, which look for each other's words."""
    rng = random.Random(43)
    rows = []
    for f in range(6):
        root = "".join(rng.choice("ACGT") for _ in range(rng.randrange(900, 2600)))
        rows.append(root)
        for _ in range(8):
            cut = rng.randrange(0, len(root) - 80)
            rows.append(mutate(rng, root[cut:cut + rng.choice([70, 200, 256, 300, 512, 700, 2600])], rng.choice([0, 0, 1, 2, 3, 9])))
    rows = [(f"s{i:03d}", s) for i, s in enumerate(rows)]
    df = spark.createDataFrame(rows, "seqid string, seq string")
    found = cluster.greedy_cluster(df, identity).members.collect()
    assert {r.seqid: r.centroid for r in found} == sequential(rows, identity)
