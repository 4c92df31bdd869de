import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest

from rrnlake.llm import dialogue, token_store, whitening
from rrnlake.llm.common import shared_path
from tests.llm.helpers import HARD, clashing, docs

TURNS = "conv_id long, turn long, role string, text string"
NOTHING = hashlib.sha256(b"").hexdigest()


# ---- dialogue repair ----

def _faults(rows):
    seen, out = set(), []
    for role, text in rows:
        solid = text.strip(" \t\n\v\f\r")
        out.append("blank" if not solid else "duplicate" if (role, text) in seen else "" if solid[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def _cheapest(rows, rules=dialogue.RepairRules()):
    """Best (cost, audit, text) row by row over (initials so far in short, all strings kept)."""
    marks = _faults(rows)

    def after(state, initial):
        return {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}.get((state, initial))

    def insert(found):
        out = dict(found)
        for _ in range(2):
            for state, options in list(out.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    new = after(state, initial)
                    if new:
                        more = {(c + rules.insert, a + "I", t + (role + ":",)) for c, a, t in options}
                        out[new] = out.get(new, set()) | more
        return {s: set(sorted(o)[:60]) for s, o in out.items()}

    found = insert({"": {(0, "", ())}})
    for (role, text), mark in zip(rows, marks):
        new = {}
        for state, options in found.items():
            moves = [(state, rules.delete, "D", None)]
            if mark in ("", "truncated"):
                extra = rules.keep_truncated * (mark == "truncated")
                moves.append((after(state, role[:1]), extra, "K", role))
                moves += [(after(state, i), extra + rules.rerole, "R", r) for i, r in (("u", "user"), ("a", "assistant"))]
            for end, cost, letter, own in moves:
                if end is not None:
                    new.setdefault(end, set()).update(
                        (c + cost, a + letter, t + ((f"{own}:{text}",) if own is not None else ())) for c, a, t in options)
        found = insert({s: set(sorted(o)[:60]) for s, o in new.items()})
    return min(o for s in ("", "a") for o in found.get(s, ()))


def _expected(rows):
    """rows: [(turn, role, text)] of one conversation."""
    rows = sorted(((t, r if r is not None else " ", x if x is not None else " ") for t, r, x in rows),
                  key=lambda v: (v[0] is not None, v[0] or 0, v[1].encode(), hashlib.sha256(v[2].encode()).digest()))
    plain = [(r, x) for _, r, x in rows]
    marks, turns = _faults(plain), {t for t, _, _ in rows if t is not None}
    cost, audit, text = _cheapest(plain)
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(plain, plain[1:]))
    return (max(turns) - min(turns) + 1 - len(turns) if turns else 0, marks.count("blank"), marks.count("duplicate"), marks.count("truncated"),
            illegal, cost, audit, hashlib.sha256("\n".join(text).encode()).hexdigest())


def _random_rows(made, length):
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "User", "", None]
    texts = ["Hi.", "Yes!", "and so", "", " \n", None, "no?", "x" * 300 + ". ", "y" * 200 + "\t" * 90]
    return [(made.choice([None, made.randrange(4 * length)] + [k] * 6), made.choice(roles[:made.randint(2, 9)]), made.choice(texts) or made.choice(texts))
            for k in range(length)]


@pytest.fixture(scope="module")
def conversations():
    made = random.Random(5)
    own = {k: _random_rows(made, made.randint(1, 12)) for k in range(150)}
    return own | {None: _random_rows(made, 9), 900: _random_rows(made, 60), 901: [(k, ("user", "assistant")[k % 2], f"{k}.") for k in range(70)]}


@pytest.mark.parametrize("sizes", [{}, {"piece_rows": 3, "fan": 2}, {"max_rules": 0, "piece_rows": 7}])
def test_repairs_equal_brute_force(spark, conversations, sizes):
    rows = [(c, *r) for c, own in conversations.items() for r in own]
    random.Random(1).shuffle(rows)
    df = clashing(spark.createDataFrame(rows, TURNS))
    keys = spark.createDataFrame([(5000,), (3,)], "conv_id long")
    got = dialogue.repair_conversations(df, keys, dialogue.RepairRules(**sizes)).collect()
    assert len(got) == len(conversations) + 1
    for r in got:
        want = (0, 0, 0, 0, 0, 0, "", NOTHING) if r.conv_id == 5000 else _expected(conversations[r.conv_id])
        assert tuple(r)[1:] == want, (r, conversations.get(r.conv_id))


def test_long_conversations_use_levels_and_rules(spark):
    made = random.Random(2)
    rows = [(1, k, made.choice(("user", "assistant")), f"{k}" + made.choice((".", ".", ""))) for k in range(1500)]
    rows += [(c, k, ("user", "assistant")[k % 2], f"{k}.") for c in (2, 3) for k in range(100)]
    df = spark.createDataFrame(rows, TURNS)
    got = {r.conv_id: r for r in dialogue.repair_conversations(df, None, dialogue.RepairRules(piece_rows=50, fan=4)).collect()}
    assert tuple(got[1])[1:] == _expected([r[1:] for r in rows if r[0] == 1])
    assert got[2].audit == "K" * 100 == got[3].audit and got[2].repaired_sha256 == got[3].repaired_sha256
    assert {tuple(r) for r in dialogue.repair_conversations(df).collect()} == {tuple(r) for r in got.values()}


def test_repaired_rows_and_none(spark):
    df = spark.createDataFrame([(1, 0, "user", "a."), (1, 1, "user", "b."), (1, 2, "user", " "), (2, 0, "assistant", "c.")], TURNS)
    got = {(r.conv_id, r.edit, r.place, r.role, r.text) for r in dialogue.repaired_rows(df).collect()}
    assert got == {(1, "K", 1, "user", "a."), (1, "R", 2, "assistant", "b."), (1, "D", None, "user", " "), (2, "D", None, "assistant", "c.")}
    assert dialogue.repair_conversations(spark.createDataFrame([], TURNS)).count() == 0
    with pytest.raises(ValueError):
        dialogue.RepairRules(insert=4)


def test_damage(spark):
    rows = [(c, t, "assistant", "One. Two!") for c in range(30) for t in range(30)] + [(None, None, None, None)]
    got = dialogue.damage_rows(spark.createDataFrame(rows, TURNS)).collect()
    want = []
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if kind == 4 else role or " ", {1: "", 2: "One Two"}.get(kind, text or " "))
        want += [row] * (0 if kind == 0 else 2 if kind == 3 else 1)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_rules_compress_and_agree():
    rules = dialogue.RepairRules()
    grammar = dialogue.Grammar(["ua", "", "", "xs"], rules)
    assert grammar.compress("uauauauaxs") == ""
    plain = dialogue.Grammar([], rules)
    for seq in map("".join, itertools.product("uasUx", repeat=5)):
        a, b = grammar.chain(seq), plain.chain(seq)
        assert (a[0] == b[0]).all()
        ends = grammar.ends(a[0], a[1]), plain.ends(b[0], b[1])
        assert grammar.audit(a[2], a[3], *ends[0][1:]) == plain.audit(b[2], b[3], *ends[1][1:])


# ---- token store ----

@pytest.mark.parametrize("values", [[], [0], [5], [1, 2, 3], list(range(1, 1000)), [10**9], sorted(random.Random(3).choices(range(10**6), k=3000)), [7] * 200 + [10**7] * 130])
def test_elias_fano_select(values):
    ef = token_store.EliasFano.of(np.array(values, np.int64))
    assert ef.select(0, len(values)).tolist() == values
    for i in range(0, len(values), 37):
        assert ef.select(i, i + 1).tolist() == values[i:i + 1]
        assert ef.select(i, min(i + 90, len(values))).tolist() == values[i:i + 90]
    if len(values) > 900:
        size = (len(ef.low) + len(ef.high) + 4 * len(ef.samples)) * 8 / len(values)
        assert size < 3.1 + np.log2(max(values) / len(values) + 1)
    with pytest.raises(IndexError):
        ef.select(0, len(values) + 1)


@pytest.fixture(scope="module")
def tokenizer():
    pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(token_store.TOKENIZER)
    return lambda texts: [e.ids + [0] for e in own.encode_batch(texts, add_special_tokens=False)]


def test_store_equals_library(spark, tokenizer):
    rows = HARD + [(9, "a<|endoftext|> b  <|endoftext|>"), (11, "it's  two\n\n lines \t end "), (-4, "neg"), (12, " lead"), (13, "日本語テキスト")]
    df = clashing(docs(spark, rows))
    path = shared_path(spark, "test-store")
    token_store.write_store(df, path, rules=token_store.StoreRules(segment_ids=50))
    got = sorted(token_store.token_index(spark, path).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in got] == sorted((r[0] for r in rows), key=lambda v: (v is not None, v))
    texts, at = {}, 0
    for name, text in rows:
        texts.setdefault(name, []).append(tokenizer([text or ""])[0])
    for r in got:
        ids = next(i for i in texts[r.doc_id] if len(i) == r.n_tokens)
        assert (r.start, r.ids_crc32) == (at, zlib.crc32(np.array(ids, "<u4").tobytes()))
        at += r.n_tokens
    whole = {(r.doc_id, r.start): r.ids for r in token_store.read_documents(spark, path).collect()}
    assert len(whole) == len(rows) and whole[-4, got[1].start] == texts[-4][0]
    some = token_store.read_documents(spark, path, 4, 7).collect()
    assert sorted(r.doc_id for r in some) == [4, 5, 6, 7, 7] and all(whole[r.doc_id, r.start] == r.ids for r in some)
    assert token_store.store_documents(docs(spark, [])).count() == 0


def test_pieces_equal_whole_texts(tokenizer):
    with open(token_store.TOKENIZER) as f:
        own = token_store.PieceEncoder(f.read())
    assert own.cuts
    made = random.Random(4)
    parts = [" ", "  ", "\n", "\t", " \n", "a", "bc", "'s", "'", "don't", ".", ",,", "12", "é", "漢字", " ", "\x1c", "\x85", "😀", "ß", "x1", "\r\n", "　", "​"]
    for _ in range(60):
        texts = ["".join(made.choices(parts, k=made.randint(0, 25))) for _ in range(40)]
        assert own.encode(texts) == [np.array(i[:-1], "<u2").tobytes() for i in tokenizer(texts)]


# ---- whitening ----

VECTORS = "vec_id long, embedding array<float>, label int, n string, x string"


def _whitened(rows, scale=256, components=4):
    x = np.array([np.floor(scale * np.array(v, np.float64)) for _, v in rows]).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(axis=0)
    centred = (n * fit - s) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    return n, ((n * x - s) ** 2).sum(axis=1), (n * x - s) / n @ (vectors[:, :components] / np.sqrt(values[:components])), values / values.sum()


@pytest.mark.parametrize("width,count", [(3, 200), (40, 150), (64, 900)])
def test_whitening_equals_dense(spark, width, count):
    made = np.random.default_rng(width)
    turn = np.linalg.qr(made.standard_normal((width, width)))[0]
    raw = (made.standard_normal((count, width)) * np.linspace(3, 1, width)) @ turn
    rows = [(k, v.astype(np.float32).tolist()) for k, v in enumerate(raw)]
    rows += [(7, rows[7][1])] * 40 + [(None, rows[3][1])]
    odd = [(1000, None), (1001, [None] * width), (1002, [float("nan")] + [1.0] * (width - 1)), (1003, [float("inf")] * width)]
    df = spark.createDataFrame([(i, v, 1, "a", "b") for i, v in rows + odd], VECTORS)
    n, apart, white, explained = _whitened(rows)
    got = whitening.whiten_vectors(df, whitening.WhiteningRules(block=12)).toPandas()
    m = min(4, width)
    assert len(got) == len(rows) * m and (got.n == n).all() and (got.identity_error < 1e-10).all()
    for j in range(m):
        own = got[got.component == j + 1].drop_duplicates("vec_id").set_index("vec_id")
        at = [k for k, r in enumerate(rows) if r[0] is not None][:count]
        mine, want = own.loc[[rows[k][0] for k in at]], white[at, j]
        sign = np.sign(mine.whitened.to_numpy() @ want)
        assert np.abs(mine.whitened.to_numpy() - sign * want).max() < 1e-9
        assert (mine.deviation.to_numpy() == apart[at]).all() and abs(mine.explained.iloc[0] - explained[j]) < 1e-12


def test_whitening_of_few_flat_and_extreme_vectors(spark):
    def run(vectors):
        return whitening.whiten_vectors(spark.createDataFrame([(k, v, 1, "", "") for k, v in enumerate(vectors)], VECTORS)).collect()

    assert run([]) == run([None]) == run([[]]) == run([[1.0, 2.0]]) == run([[1.0, 2.0]] * 5) == []
    two = run([[1.0, 2.0], [3.0, 2.0], [3.0, 2.0]])
    assert {(r.component, round(abs(r.whitened), 9), r.n) for r in two} == {(1, 1.0, 2)}
    ragged = run([[1.0], [1.0, 4.0], [], [2.0, 2.0]])
    assert len(ragged) == 8 and {r.n for r in ragged} == {4}
    huge = run([[3e38, 1.0], [-3e38, 5.0], [1.0, 9.0]])
    assert {(r.vec_id, r.deviation) for r in huge} == {(0, None), (1, None), (2, 9700353)} and all(np.isfinite(r.whitened) for r in huge)
    equal = run([[float(i == j) for i in range(6)] for j in range(6)])  # five equal eigenvalues
    assert len(equal) == 24 and abs(equal[0].identity_error) < 1e-10
