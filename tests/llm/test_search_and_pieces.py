import hashlib
import re
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rrnlake.llm import embeddings, licenses, segmentation, winnowing
from rrnlake.llm.common import table
from tests.llm.helpers import HARD, clashing, docs


def vectors(spark, rows, kind="float"):
    return spark.createDataFrame([(i, v, l, "x", "y") for i, v, l in rows], f"vec_id long, embedding array<{kind}>, label int, size string, cells string")


def test_links_equal_brute_force(spark):
    made = np.random.default_rng(1)
    rows, n = [], 0
    for label in (0, 1):
        for centre in made.standard_normal((40, 24)):
            for _ in range(made.integers(1, 8)):
                rows.append((n, (centre + made.normal(0, 0.08, 24)).astype(np.float32).tolist(), label))
                n += 1
    rows += [(n, rows[0][1], 0), (n + 1, rows[0][1], 0), (n + 2, rows[0][1], 1), (n + 2, rows[0][1], 1)]
    odd = [(n + 10, None, 0), (n + 11, [0.0] * 24, 0), (n + 12, [None] + [1.0] * 23, 0), (n + 13, [float("nan")] * 24, 0),
           (n + 14, [float("inf")] + [1.0] * 23, 0), (n + 15, rows[0][1], None), (n + 16, [], 0), (n + 17, [1.0, 2.0], 0), (n + 18, [2.0, 4.0], 0)]
    got = embeddings.near_vectors(vectors(spark, rows + odd)).collect()
    assert len(got) == len(rows) + len(odd)
    unit = np.array([r[1] for r in rows], dtype=np.float64)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    label = np.array([r[2] for r in rows])
    link = (unit @ unit.T >= 0.98) & (label[:, None] == label) & ~np.eye(len(rows), dtype=bool)
    want = link.sum(axis=1)
    found = {}
    for r in got:
        found.setdefault(r.vec_id, []).append(r)
    have = np.array([found[r[0]][0].n_links for r in rows])
    assert (have <= want).all() and have.sum() >= 0.97 * want.sum() and want.sum() > 100
    assert found[n][0].component_id == 0 and not found[n][0].kept and found[0][0].kept
    assert all(found[n + k][0].n_links == 0 and found[n + k][0].component_id == n + k and found[n + k][0].kept for k in range(10, 17))
    assert found[n + 17][0].n_links == 1 and found[n + 18][0].component_id == n + 17


def test_links_of_hot_groups_and_no_rows(spark):
    made = np.random.default_rng(2)
    centre = made.standard_normal(16)
    rows = [(i, (centre + made.normal(0, 0.01, 16)).tolist(), 3) for i in range(150)]
    got = embeddings.near_vectors(vectors(spark, rows, "double"), embeddings.CollisionRules(block_rows=20)).collect()
    assert all(r.n_links == 149 and r.component_id == 0 for r in got)
    assert embeddings.near_vectors(vectors(spark, [])).count() == 0


def test_calibration():
    rules = embeddings.CollisionRules()
    assert rules.meeting_recall() > 0.99 and 0 < rules.least_count < rules.projections
    made = np.random.default_rng(5)
    a = made.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = made.standard_normal((4000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.98 * a + np.sqrt(1 - 0.98**2) * b / np.linalg.norm(b, axis=1, keepdims=True)
    axes, _ = embeddings.directions(64, rules)
    hits = (np.abs(a @ axes.T - b @ axes.T) <= rules.window * rules.distance).sum(axis=1)
    assert (hits >= rules.least_count).mean() > 0.99


def test_phrases_and_templates(spark):
    rows = [(1, "Released under the MIT License.\nNothing else"), (2, "the mit-license, CC-BY and cc by! Apache LICENSE apache license"),
            (3, "GNU General\nPublic License"), (4, "This work is licensed under the GNU General Public License, version 3."),
            (5, "licensed under cc by nc 4 0 by all"), (6, "all rights  are reserved"), (7, "ÀPACHE LICENSE é apache license"), *[(100 + (r[0] or 0), r[1]) for r in HARD]]
    got = {r.doc_id: r for r in licenses.scan_documents(clashing(docs(spark, rows))).collect()}
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].base_labels) == (5, 1, 10, "apache,cc-by,mit")
    assert got[3].n_base == 1 and got[3].base_labels == "gpl" and got[3].first_word == 0
    assert "gpl-3.0" in got[4].labels.split(",") and "gpl" in got[4].labels.split(",")
    assert got[2].n_words == 12 and got[7].first_word == 3
    assert "cc-by-nc-4.0" in got[5].labels and got[6].labels == "all-rights-reserved" and got[6].n_base == 0
    assert got[5].score == 1.0 and got[6].score == 1.0 and got[102].score == 0.0 and got[105].n_words == 30_000
    assert licenses.scan_documents(docs(spark, [])).count() == 0


@pytest.mark.parametrize("limit", [0.5, 0.8, 1.0])
def test_scan_equals_all_pairs(spark, limit):
    rules = licenses.LicenseRules(containment=limit)
    made = np.random.default_rng(int(limit * 10))
    words = sorted({w for _, t in rules.templates for w in re.findall(r"[0-9a-z]+", t.lower())}) + ["filler", "text"]
    rows = [(i, "\n".join(" ".join(made.choice(words, made.integers(0, 14))) for _ in range(4))) for i in range(80)]
    rows += [(100 + i, t) for i, (_, t) in enumerate(rules.templates)]
    d = docs(spark, rows)
    got = {(r.doc_id, r.block, r.label): r.containment for r in licenses.scan_blocks(licenses.template_blocks(d, rules), rules).collect()}
    want = {}
    for i, text in rows:
        for k, line in enumerate(text.lower().split("\n")):
            have = set(re.findall(r"[0-9a-z]+", line))
            for label, body in rules.templates:
                t = set(re.findall(r"[0-9a-z]+", body.lower()))
                if len(t & have) >= limit * len(t) - 1e-9:
                    want[i, k, label] = len(t & have) / len(t)
    assert got == pytest.approx(want) and len(want) > 10


def x64(data, seed=42):
    import xxhash
    v = xxhash.xxh64_intdigest(data, seed)
    return v - (1 << 64) if v >> 63 else v


def brute_marks(text, gram=4, window=16):
    hashes = [x64(w) for w in re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())]
    pair = lambda a, b: x64(b.to_bytes(8, "little", signed=True), x64(a.to_bytes(8, "little", signed=True)) % (1 << 64))
    if not hashes:
        return []
    two = [pair(a, b) for a, b in zip(hashes, hashes[1:])] or hashes
    four = [pair(a, b) for a, b in zip(two, two[2:])] or [pair(two[0], two[-1])] if len(two) > 1 else two
    out = []
    for i in range(max(len(four) - window + 1, 1)):
        part = [h >> 24 for h in four[i : i + window]]
        at = i + max(k for k, h in enumerate(part) if h == min(part))
        if not out or out[-1][1] != at:
            out.append((four[at], at))
    return out


def test_marks_equal_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").limit(60).collect()] + HARD + [(50, "a b a b a b a b a b a b a b a b a b a b a b a b")]
    got = winnowing.fingerprints(clashing(docs(spark, rows))).collect()
    texts = {}
    for i, t in rows:
        texts.setdefault(i, []).append([tuple(x) for x in brute_marks(t)])
    assert len(got) == len(rows)
    for r in got:
        assert [tuple(m) for m in r.marks] in texts[r.doc_id], r.doc_id


def test_match_guarantee(spark):
    made = np.random.default_rng(7)
    common = ["c%d" % i for i in range(winnowing.WinnowRules().guarantee)]
    rows = [(i, " ".join([*("a%d" % x for x in made.integers(0, 10**6, 40)), *common, *("b%d" % x for x in made.integers(0, 10**6, 40))])) for i in range(10)]
    got = {r.doc_id for r in winnowing.matches(winnowing.fingerprints(docs(spark, rows))).collect()}
    assert got == set(range(1, 10))


def test_edited_texts(spark):
    rows = [(10, "abcdefg"), (20, "漢字😀x"), (30, None), (40, "one two three four five six"), (25, ""), (5, "last goes to first")]
    ordered = sorted(rows)
    got = {r.doc_id: r for r in winnowing.compare_edited(clashing(docs(spark, rows))).collect()}
    for k, (i, t) in enumerate(ordered):
        t, after = t or "", ordered[(k + 1) % len(ordered)][1] or ""
        half = len(t) // 2
        edited = t[: len(t) - half] + after[:half]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest() and got[i].n_chars == len(t)
        assert got[i].fingerprint == got[i].edited_fingerprint if edited == t else True
        a, b, c = ({h for h, _ in brute_marks(x)} for x in (t, edited, after))
        same = lambda p, q: len(p & q) / len(p | q) if p | q else 1.0
        assert got[i].near_edited == pytest.approx(same(a, b)) and got[i].near_next == pytest.approx(same(a, c))


def test_edits_of_hard_rows(spark):
    got = winnowing.compare_edited(docs(spark, HARD)).collect()
    assert len(got) == len(HARD)
    assert len({r.fingerprint for r in got if r.doc_id in (1, 7)}) == 1
    one = winnowing.compare_edited(docs(spark, [(1, "abcd")])).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest()
    assert winnowing.compare_edited(docs(spark, [])).count() == 0


@pytest.fixture(scope="module")
def model():
    with open(segmentation.MODEL, "rb") as f:
        return f.read()


def applied(ids, edits):
    out = list(ids)
    for start, length, new in sorted(edits, key=lambda e: -e[0]):
        out[start : start + length] = new
    return out


def test_nbest_equals_the_library(model):
    pb = pytest.importorskip("sentencepiece.sentencepiece_model_pb2")
    import sentencepiece
    proto = pb.ModelProto()
    proto.ParseFromString(model)
    proto.trainer_spec.model_type = 1  # the same pieces and scores, searched as a lattice
    library = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString())
    memory = segmentation._Memory(segmentation.PieceLattice(model), 5)
    for text in ["the cat sat on the mat", "onestheathing", "Hällo wörld", "a", "Licensed under CC", "antidisestablishmentarianism"]:
        ids, found = segmentation.encode_text(memory, text)
        want = [list(x) for x in library.nbest_encode_as_ids(text, 5)]
        lattice = memory.lattice
        mine = [applied(ids, e) for _, e in found]
        worth = lambda x: sum(lattice.pieces[library.id_to_piece(i)][0] for i in x)
        assert len(mine) == len(want) and mine[0] == want[0] and len(set(map(tuple, mine))) == len(mine)
        if all(not library.is_byte(i) for x in mine for i in x):
            assert [worth(x) for x in mine] == [worth(x) for x in want] == [s for s, _ in found]


def test_search_equals_enumeration(model):
    lattice = segmentation.PieceLattice(model)
    for chunk in ["▁thing", "▁aaa", "▁Ünß", "▁▁▁x", "漢"]:
        best, ends = lattice.forward(chunk)

        def paths(at):
            if at == 0:
                yield ()
            for s, score, i in ends[at]:
                for p in paths(s):
                    yield (*p, (s, at, i, score))

        every = sorted(((-sum(x[3] for x in p)) for p in paths(len(chunk))))
        found = lattice.nbest(chunk, 6)
        assert [best[-1] - loss for loss, _ in found] == pytest.approx([-x for x in every[:6]])
        score, ids, gap = lattice.best(chunk)
        assert score == best[-1] and ids == found[0][1]
        assert gap == pytest.approx(every[1] - every[0]) if len(every) > 1 else gap == np.inf


def test_texts_come_back(spark):
    rows = HARD + [(60, "tab\tand\nnew  lines   "), (61, "\x00\x01"), (62, "ab" * 3000 + " end")]
    encoded = segmentation.encode_nbest(clashing(docs(spark, rows))).cache()
    back = [(r.doc_id, r.text) for r in segmentation.decode_ids(encoded).collect()]
    want = [(i, (t or "").replace("▁", " ")) for i, t in rows]
    assert sorted(back, key=str) == sorted(want, key=str)
    for r in encoded.collect():
        scores = [x.score for x in r.nbest]
        assert scores == sorted(scores, reverse=True) and len(r.nbest) <= 4
        whole = {tuple(applied(r.ids, [tuple(e) for e in x.edits])) for x in r.nbest}
        assert len(whole) == len(r.nbest)
    assert segmentation.encode_nbest(docs(spark, [])).count() == 0
    nothing = spark.createDataFrame([(1, None)], "doc_id long, ids array<int>")
    assert segmentation.decode_ids(nothing).first().text is None


def test_decoding_holds_no_lattice():
    """Workers that encoded before decode without their lattice and what they remember, which took an executor over its memory."""
    with open(segmentation.MODEL, "rb") as f:
        model = f.read()
    text = "Hello wörld  \n x 日本 \U0001F600 end"
    memory = segmentation._memory(model, 3)
    ids, _ = segmentation.encode_text(memory, text)
    assert segmentation._memory(model, 3) is memory
    segmentation._forget()
    assert segmentation._memory(model, 3) is not memory
    tracemalloc.start()
    surface = segmentation.PieceSurface(model)
    held = tracemalloc.get_traced_memory()[0]
    tracemalloc.stop()
    assert held < 5 << 20 and surface.decode(np.array(ids, np.int32)) == text


def test_short_chunks_are_searched_together(model, monkeypatch):
    """A search chunk by chunk took encoding over its CPU budget; all results are those of that search."""
    made = np.random.default_rng(3)
    signs = list("abcdeth  \n▁é漢😀ß\x00\tの")
    texts = ["".join(made.choice(signs, made.integers(0, 50))) for _ in range(400)] + [None, "", " ", "  ", "▁", "▁ ▁x", " a", "a ", "ab" * 20 + " end"]
    lattice = segmentation.PieceLattice(model)
    want = []
    for text in texts:
        marked = "▁" + text.replace(" ", "▁") if text else ""
        chunks = re.findall("▁*[^▁]+|▁+", marked)
        found = [lattice.best(c) for c in chunks]
        want.append((sum(score for score, _, _ in found), [i for _, ids, _ in found for i in ids], min((gap for _, _, gap in found), default=np.inf)))
    monkeypatch.setattr(lattice, "best", None)
    for limit in (segmentation.KEEP_BYTES, 20_000):
        memory = segmentation._Memory(lattice, 4, limit)
        for text, (score, ids, gap) in zip(texts, want):
            mine, found = segmentation.encode_text(memory, text)
            assert mine == ids and found[0] == (score, [])
            assert found[1][0] == score - gap if len(found) > 1 else gap == np.inf
    one = segmentation._Memory(lattice, 4)
    ids, ends, lists = segmentation._encoded(segmentation._Memory(lattice, 4), pa.array(["not in the slice", *texts]).slice(1))
    for k, text in enumerate(texts):
        assert (ids[ends[k] : ends[k + 1]].tolist(), lists[k]) == segmentation.encode_text(one, text)


def test_parts_hold_all_texts(monkeypatch):
    monkeypatch.setattr(segmentation, "PART_BYTES", 10)
    monkeypatch.setattr(segmentation, "PART_ROWS", 3)
    texts = pa.array(["", None, "a", "b", "long" * 9, "12345", "12345", "x", None, None, None, None])
    assert list(segmentation._parts(texts)) == [(0, 3), (3, 1), (4, 1), (5, 2), (7, 3), (10, 2)]
    assert list(segmentation._parts(texts.slice(0, 0))) == []
