import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

import corpus_pipeline
from rrnlake.llm import components, linedup, mixing, quality, simhash
from rrnlake.llm.common import table
from tests.llm.helpers import HARD, clashing, docs

RULES = linedup.LineRules()


def brute_lines(rows):
    """{(doc_id, text): new text} by comparing every stretch with all before it."""
    cut, seen, out = re.compile(r"(?<=\n)(?!\n)|(?<=[.!?] )(?!\n)"), {}, {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0)):
        units = [u for u in cut.split(text or "") if u]
        plain = [u.replace("\n", "").rstrip(" ") for u in units]
        spaced = not re.search(r"[\t\v\f\r]", text or "")
        words = [(p.count(" ") + 1 if p else 0) if spaced else len(re.findall(r"[^\x20\x09-\x0D]+", p)) for p in plain]
        spans = set()
        for i in range(len(units)):
            for step in (1, -1):
                total = 0
                for k in range(RULES.most_lines):
                    j = i + k * step
                    if not 0 <= j < len(units):
                        break
                    total += words[j]
                    if total >= RULES.least_words or k + 1 == RULES.most_lines <= total:
                        spans.add((min(i, j), max(i, j)))
                        break
        dead = set()
        for a, b in sorted(spans):
            own = tuple(plain[a : b + 1])
            if seen.setdefault(own, (doc_id, a)) != (doc_id, a):
                dead |= set(range(a, b + 1))
        out[doc_id, text] = None if text is None else "".join(u for k, u in enumerate(units) if k not in dead)
    return out


def sentences(seed, n):
    made = np.random.default_rng(seed)
    return [" ".join("w%d" % w for w in made.integers(0, 500, made.integers(3, 20))).capitalize() + "." for _ in range(n)]


def test_repeated_passages_go(spark):
    own = [sentences(i, 12) for i in range(8)]
    passage = sentences(99, 6)
    rows = [
        (1, "\n".join(own[0])), (2, " ".join(own[1][:5] + passage + own[1][5:])), (3, "\n".join(own[2][:3] + passage + own[2][3:])),
        (4, "\n".join(own[0])), (5, own[3][0] + " " + own[3][0]), (6, "\n".join(["Same line."] * 100)), (7, "\n".join(own[4] + own[4])),
        (8, own[5][0] + "\n" + own[0][0]), *[(100 + r[0], r[1]) for r in HARD[1:6]], (30, None), (31, "a " * 60 + "\n" + "b " * 60), (32, "b " * 60 + "\n" + "a " * 60),
    ]
    d = clashing(docs(spark, rows))
    out = linedup.dedup_lines(d)
    assert out.columns == [*d.columns, "deleted_lines"]
    want = brute_lines([(r[0], r[1]) for r in rows])
    texts = defaultdict(set)
    for r in out.collect():
        texts[r.doc_id].add(r.text)
        assert r.text is None or r.deleted_lines == 0 or r.n_chars == len(r.text)
    for (doc_id, _), text in want.items():
        assert text in texts[doc_id], doc_id
    got = {r.doc_id: r for r in out.collect()}
    assert got[4].text == "" and got[3].deleted_lines == 6 and got[1].deleted_lines == 0 and got[2].deleted_lines == 0
    assert got[6].text == "Same line.\n"


def test_empty_lines_and_tabs(spark):
    tabbed = "\t".join("t%d" % i for i in range(60))
    rows = [(1, "\n" * 14), (2, "a\n" + "\n" * 30 + "b\n"), (3, "  \n" * 20), (4, "\n\n".join(["one two"] * 3)), (5, "\n\n".join(["one two"] * 3)),
            (6, "own first line\n" + tabbed), (7, "own other line\n" + tabbed), (8, "\n\n" + sentences(5, 1)[0] + "\n\n\n")]
    got = {r.doc_id: r.text for r in linedup.dedup_lines(docs(spark, rows)).collect()}
    assert got == {i: t for (i, _), t in brute_lines(rows).items()}
    assert {i: got[i] for i in got if i != 7} == {i: t for i, t in rows if i != 7} and got[7] == "own other line\n"


def test_line_dedup_equals_brute_force(spark, small):
    rows = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    want = brute_lines(rows)
    got = linedup.dedup_lines(table(spark, small, "documents")).collect()
    assert len(got) == len(rows) and all(r.text == want[key] for r in got for key in want if key[0] == r.doc_id)


def test_lines_of_no_documents(spark):
    assert linedup.dedup_lines(docs(spark, [])).count() == 0


def brute_simhash(text, k=3):
    import xxhash
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    grams = [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(pairs, nodes):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_fingerprints_and_components(spark, small):
    base = [(r.doc_id, r.text) for r in table(spark, small, "documents").collect()]
    words = base[0][1].split()
    near = [(5000 + i, " ".join(words[:i] + ["changed"] + words[i + 1 :])) for i in range(0, min(len(words), 60), 3)]
    rows = base + near + HARD
    got = simhash.near_duplicates(clashing(docs(spark, rows))).collect()
    assert len(got) == len(rows)
    fp = {}
    for r in got:
        fp.setdefault(r.doc_id, set()).add(int(r.fingerprint, 16))
    for i, t in rows:
        assert brute_simhash(t) in fp[i]
    prints = sorted({f for fs in fp.values() for f in fs})
    find = roots([(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3], prints)
    least = {}
    for i, t in rows:
        if i is not None:
            c = find[brute_simhash(t)]
            least[c] = min(least.get(c, i), i)
    for r in got:
        assert r.component_id == least.get(find[int(r.fingerprint, 16)])


def test_hot_group_is_split(spark, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    made = np.random.default_rng(3)
    base = int(made.integers(1 << 62))
    prints = {base ^ sum(1 << int(b) for b in made.choice(20, made.integers(0, 4), replace=False)) for _ in range(300)}
    prints |= {int(x) for x in made.integers(1 << 62, size=50)}
    df = spark.createDataFrame([(p,) for p in prints], "fp long")
    links = [(r.a, r.b) for r in simhash.linked_prints(df).collect()]
    assert all(0 < (a ^ b).bit_count() <= 3 for a, b in links) or all(a != b for a, b in links)
    full = roots([(a, b) for a in prints for b in prints if a < b and (a ^ b).bit_count() <= 3], prints)
    assert roots(links, prints) == full


def test_keep_one(spark):
    rows = [(4, "a b c d e f"), (2, "a b c d e f"), (9, "other words entirely here now"), (9, "other words entirely here now"), (None, "a b c d e f"), (1, None), (3, "")]
    d = clashing(docs(spark, rows))
    out = simhash.keep_one(d)
    assert out.columns == d.columns
    assert sorted((r.doc_id or 0) for r in out.collect()) == [0, 1, 2, 9]
    assert simhash.keep_one(docs(spark, [])).count() == 0


def test_components_of_chains_and_stars(spark):
    chain = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (7, 7), (None, 3)] + [(200, i) for i in range(201, 230)]
    got = {r.node: r.root for r in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, **dict.fromkeys(range(200, 230), 200)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_quality_separates_held_out_rows(spark, small):
    folder = small.replace("0.001", "0.01")
    d, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = quality.score_documents(clashing(d), labels).collect()
    assert len(scored) == d.count() and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in scored)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in scored)
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [(r.score, truth[r.doc_id]) for r in scored if r.held_out and r.doc_id in truth]
    good, bad = [s for s, q in held if q], [s for s, q in held if not q]
    assert sum((g > b) + (g == b) / 2 for g in good for b in bad) / (len(good) * len(bad)) > 0.95
    kept = quality.keep_good(d, quality.fit(d, labels))
    assert kept.columns == d.columns and kept.count() == sum(r.predicted for r in scored)


def test_quality_of_hard_rows_and_missing_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.score_documents(docs(spark, HARD), none).collect()} == {0.5}
    ones = spark.createDataFrame([(i, 1, 0) for i in range(50)] + [(None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    assert len({r.score for r in quality.score_documents(docs(spark, HARD), ones).collect()}) == 1
    both = spark.createDataFrame([(i, i % 2, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    rows = [(i, ("good plain words follow here " if i % 2 else "!!!! #### ") * 20 + str(i)) for i in range(300)]
    scored = {r.doc_id: r.score for r in quality.score_documents(docs(spark, rows + [(900, None), (901, ""), (902, "é" * 200_000)]), both).collect()}
    assert min(s for i, s in scored.items() if i < 300 and i % 2) > max(s for i, s in scored.items() if i < 300 and i % 2 == 0)
    assert 0 <= scored[900] == scored[901] <= 1
    assert quality.score_documents(docs(spark, []), both).count() == 0


@pytest.fixture(scope="module")
def pipeline_input(spark, small):
    return table(spark, small, "documents")


def test_pipeline_stages(spark, small, pipeline_input):
    assert [len(s) for s in corpus_pipeline.STAGES] == [2] * 5
    d, seen = pipeline_input, [pipeline_input.count()]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, small).cache()
        assert d.columns == pipeline_input.columns
        seen.append(d.count())
    assert seen[0] > seen[1] == seen[2] > seen[3]
    last = corpus_pipeline.STAGES[-1][1](spark, d, small)
    assert last.count() == seen[-1]


def test_pipeline_equals_its_parts_in_plain_python(spark, small, pipeline_input):
    from rrnlake.llm import segmentation
    out = corpus_pipeline.run(spark, small).collect()
    model = quality.fit(pipeline_input, table(spark, small, "labels"))
    measure = quality.Differences(model)
    rows = [(r.doc_id, r.text) for r in pipeline_input.collect()]
    rows = [r for r in rows if 1 / (1 + np.exp(-(measure(r[1]) * model.slope + model.offset))) >= 0.3]
    rows = [(i, t) for (i, _), t in brute_lines(rows).items()]
    prints = {i: brute_simhash(t) for i, t in rows}
    find = roots([(a, b) for a in set(prints.values()) for b in set(prints.values()) if a < b and (a ^ b).bit_count() <= 3], set(prints.values()))
    first = {}
    for i in sorted(prints):
        first.setdefault(find[prints[i]], i)
    kept = {i: t for i, t in rows if i in set(first.values())}
    with open(segmentation.MODEL, "rb") as f:
        memory = segmentation._Memory(segmentation.PieceLattice(f.read()), 4)
    source = {r.doc_id: r.source for r in pipeline_input.collect()}
    mixed = mixing.apply_mix(docs(spark, [(i, t, source[i]) for i, t in kept.items()]))
    assert sorted(r.doc_id for r in out) == sorted(r.doc_id for r in mixed.collect())
    for r in out:
        assert r.ids == segmentation.encode_text(memory, kept[r.doc_id])[0]
