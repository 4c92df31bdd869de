"""Primer search, classifier and sketches against brute force."""

import math
import random

from pyspark.sql import functions as F

from rrnlake.functions.sequence import IUPAC, reverse_complement_text
from rrnlake.operators import kmers, primers

PAIRS = [("P", "ACGTR", "YACG"), ("Q", "GGNA", "TTRC")]


def random_seqs(seed, n, low, high):
    rng = random.Random(seed)
    return [(f"s{i}", "".join(rng.choice("ACGT") for _ in range(rng.randrange(low, high)))) for i in range(n)]


def sites(seq, primer, allowed):
    out = []
    for i in range(len(seq) - len(primer) + 1):
        wrong = sum(seq[i + j] not in IUPAC[c] for j, c in enumerate(primer))
        if wrong <= allowed:
            out.append((i, wrong))
    return out


def products(seq, fwd, rev, identity):
    out = []
    for strand, left, right in (("+", fwd, reverse_complement_text(rev)), ("-", rev, reverse_complement_text(fwd))):
        stops = sites(seq, right, int((1 - identity) * len(right) + 1e-9))
        for i, w in sites(seq, left, int((1 - identity) * len(left) + 1e-9)):
            after = [(j, v) for j, v in stops if j >= i + len(left)]
            out += [(w + v, strand, i, j + len(right), len(left), len(right)) for j, v in after]
    return out


def test_pcr(spark):
    rows = random_seqs(1, 20, 0, 400)
    df = spark.createDataFrame(rows, "seqid string, seq string")
    got = {tuple(r) for r in primers.insilico_pcr(df, PAIRS, max_len=150).collect()}
    want = set()
    for name, seq in rows:
        for pair, fwd, rev in PAIRS:
            for _, strand, i, end, _, _ in products(seq, fwd, rev, 1.0):
                if end - i <= 150:
                    piece = seq[i:end] if strand == "+" else reverse_complement_text(seq[i:end])
                    want.add((name, pair, strand, i + 1, end, end - i, piece))
    assert got == want and got
    shares = {r.pair: r.amplified for r in primers.primer_yield(df, PAIRS, max_len=150).collect()}
    assert shares == {p: len({w[0] for w in want if w[1] == p}) for p in ("P", "Q")}


def test_the_better_far_site_wins(spark):
    rng = random.Random(11)
    fwd, rev = "ACGTACGTACGTACG", "TTGGCCAATTGGCCA"
    near = list(reverse_complement_text(rev))
    for i in (2, 7, 11):
        near[i] = "A" if near[i] != "A" else "C"
    filler = lambda n: "".join(rng.choice("AG") for _ in range(n))
    seq = filler(50) + fwd + filler(500) + "".join(near) + filler(1500) + reverse_complement_text(rev) + filler(50)
    df = spark.createDataFrame([("s", seq), ("low", seq.lower())], "seqid string, seq string")
    for least in (100, 1000):
        rows = primers.extract_reads(df, [("P", fwd, rev)], min_len=least).collect()
        assert [(len(r.read), r.mismatches) for r in rows] == [(2015, 0)] * 2
    both = seq[:600].replace("".join(near), "") + reverse_complement_text(rev) + filler(300) + reverse_complement_text(rev)
    found = primers.insilico_pcr(spark.createDataFrame([("s", both)], "seqid string, seq string"), [("P", fwd, rev)]).count()
    assert found == 2


def test_reads_with_mismatches(spark):
    rows = random_seqs(2, 20, 50, 400)
    df = spark.createDataFrame(rows, "seqid string, seq string")
    got = {(r.seqid, r.pair, r.strand, r.mismatches, r.read)
           for r in primers.extract_reads(df, PAIRS, min_len=10, min_identity=0.8).collect()}
    want = set()
    for name, seq in rows:
        for pair, fwd, rev in PAIRS:
            found = [(w, s, i + a, e - b) for w, s, i, e, a, b in products(seq, fwd, rev, 0.8)]
            if found:
                w, strand, lo, hi = min(found)
                if hi - lo >= 10:
                    piece = seq[lo:hi] if strand == "+" else reverse_complement_text(seq[lo:hi])
                    want.add((name, pair, strand, w, piece))
    assert got == want and got


def test_real_primers(spark):
    fwd, rev = "AGAGTTTGATCATGGCTCAG", "CCGACCTGTCTCACGACG"
    body = "".join(random.Random(4).choice("ACGT") for _ in range(1200))
    seq = "TTTT" + fwd + body + reverse_complement_text(rev) + "GGG"
    df = spark.createDataFrame([("x", seq), ("y", reverse_complement_text(seq))], "seqid string, seq string")
    got = {(r.seqid, r.pair, r.strand): r.read for r in primers.extract_reads(df).collect()}
    assert got[("x", "C", "+")] == body and got[("y", "C", "-")] == body
    # U is read like T, and its complement is A.
    assert reverse_complement_text("ACGURYN") == "NRYACGT"


def test_classifier(spark):
    rng = random.Random(6)
    parts = {lab: "".join(rng.choice("ACGT") for _ in range(400)) for lab in ("a", "b", "c")}
    train = [(lab, lab, s) for lab, s in parts.items()]
    reads = [(f"r{i}", "m", parts["abc"[i % 3]][i:i + 90]) for i in range(30)]
    counts = kmers.kmer_counts(spark.createDataFrame([("m", lab, s) for _, lab, s in train], "model string, lab string, seq string"), 7, ["model", "lab"])
    df = spark.createDataFrame(reads, "seqid string, model string, seq string")
    out = kmers.predict_nb(kmers.train_nb(counts, "model", "lab"), df, "seqid").collect()
    assert {r.seqid: r.label for r in out} == {n: "abc"[int(n[1:]) % 3] for n, _, _ in reads}
    table = {}
    for r in counts.collect():
        table.setdefault(r.lab, {})[r.kmer] = r.n
    words = {w for t in table.values() for w in t}
    _, _, seq = reads[0]
    want = sum(math.log((table["a"].get(seq[i:i + 7], 0) + 0.001) / (sum(table["a"].values()) + 0.001 * len(words)))
               for i in range(len(seq) - 6))
    assert abs({r.seqid: r.score for r in out}["r0"] - want) < 1e-6


def test_sketch_pairs(spark):
    rng = random.Random(8)
    root = "".join(rng.choice("ACGT") for _ in range(40000))
    near = "".join(c if rng.random() > 0.03 else rng.choice("ACGT") for c in root)
    far = "".join(rng.choice("ACGT") for _ in range(40000))
    rows = [("g1", root), ("g2", near), ("g3", far), ("g4", reverse_complement_text(root)), ("g5", root[:20000])]
    df = spark.createDataFrame(rows, "genome string, seq string")
    groups = kmers.sketch_groups(kmers.sketches(df, size=500))
    assert {r.genome: r.representative for r in groups.collect()}["g4"] == "g1"  # strand does not matter
    got = {(r.a, r.b): r for r in kmers.ani_pairs(groups, size=500).collect()}
    hashes = {r.genome: set(r.hashes) for r in groups.collect()}
    want = {}
    names = ["g1", "g2", "g3", "g5"]
    for i, a in enumerate(names):
        for b in names[i + 1:]:
            union = set(sorted(hashes[a] | hashes[b])[:500])
            j = len(hashes[a] & hashes[b] & union) / len(union)
            if j and 100 * (1 + math.log(2 * j / (1 + j)) / 16) >= 80:
                want[(a, b)] = len(hashes[a] & hashes[b] & union)
    assert {k: r.shared for k, r in got.items()} == want and ("g1", "g2") in want and ("g1", "g5") in want
    assert 96 < got[("g1", "g2")].est_ani < 99


def test_pairs_of_sketches_move_no_sketch(spark):
    """Random sketches with common hashes against all pairs; the plan joins numbers, not arrays."""
    rng = random.Random(13)
    pool = [rng.getrandbits(60) for _ in range(400)]
    rows = [(f"g{i:02d}", sorted(rng.sample(pool, rng.randrange(3, 41)) if i % 4 else pool[:20] + rng.sample(pool[20:], 20))) for i in range(60)]
    df = spark.createDataFrame([(g, g, h) for g, h in rows], "genome string, representative string, hashes array<bigint>")
    out = kmers.ani_pairs(df, size=40)
    want = {}
    for i, (a, x) in enumerate(rows):
        for b, y in rows[i + 1:]:
            union = sorted({*x, *y})[:40]
            both = len({*x} & {*y} & {*union})
            j = both / len(union)
            if j and 100 * (1 + math.log(2 * j / (1 + j)) / 16) >= 80 - 1e-9:
                want[a, b] = both
    assert len(want) > 300 and {(r.a, r.b): r.shared for r in out.collect()} == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashes" not in plan


def test_sketches_of_words_that_repeat_are_full(spark):
    """Below the bound are too few distinct hashes where a genome repeats itself."""
    rng = random.Random(14)
    part = "".join(rng.choice("ACGT") for _ in range(700))
    rows = [("plain", "".join(rng.choice("ACGT") for _ in range(30000))), ("again", part * 60), ("short", part[:100]), ("none", "ACG")]
    df = spark.createDataFrame(rows, "genome string, seq string")
    for name, hashed in (("bigint", None), ("string", lambda w: F.substring(F.md5(w), 1, 16))):
        more = {} if hashed is None else {"hash_fn": hashed}
        got = {}
        for r in kmers.sketches(df, size=300, **more).collect():
            got.setdefault(r.genome, []).append(r.hash)
        for g, s in rows:
            words = {min(w, reverse_complement_text(w)) for w in (s[i:i + 16] for i in range(len(s) - 15))}
            frame = spark.createDataFrame([(w,) for w in sorted(words)] or [("x",)], "w string")
            every = sorted(r[0] for r in frame.select((hashed or F.xxhash64)(F.col("w"))).collect()) if words else []
            assert sorted(got.get(g, [])) == every[:300], (name, g)
