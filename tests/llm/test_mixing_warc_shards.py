import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

import __spark_entry__ as entry
from check_oracles import TABLES, compare
from pyspark.sql import functions as F
from rrnlake.llm import hilbert, mixing, warc
from tests.llm.helpers import DOCS, HARD, clashing, docs


@pytest.fixture(scope="module")
def con(small):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", ["op1_mix_sources", "op2_warc_archive"])
def test_query_equals_sql(spark, con, small, name):
    ok, text = compare(spark, con, small, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, text


def test_mix_meets_targets(spark):
    rows = [(i, "w " * (1 + i % 7), s) for i, s in enumerate(["a"] * 300 + ["b"] * 900 + [None] * 50 + ["c"] * 2)] + [(5000, "big " * 500, "b")]
    got = mixing.mix_sources(clashing(docs(spark, rows))).collect()
    assert len(got) == len(rows)
    taken, target, size = Counter(), {}, {}
    for r in got:
        taken[r.source] += r.taken
        target[r.source], size[r.source] = r.target, r.source_size
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
    weights = {"a": 5.0, "b": 2.0, "c": 1.0, None: 5.0}  # null last, weights repeat
    assert abs(sum(target.values()) - sum(size.values())) < 1e-6
    assert target["c"] == 3 * size["c"] and target[None] == 3 * size[None]
    open_ = [s for s in target if target[s] < 3 * size[s] - 1e-9]
    assert len({round(target[s] / weights[s], 6) for s in open_}) <= 1
    largest = max(r.size for r in got if r.doc_id != 5000)
    for s in target:
        assert abs(taken[s] - target[s]) <= (500 if s == "b" else largest)
    again = mixing.mix_sources(docs(spark, rows).repartition(7)).collect()
    assert sorted((r.doc_id, r.taken) for r in got) == sorted((r.doc_id, r.taken) for r in again)


def test_mix_is_nested(spark):
    d = docs(spark, [(i, "w " * (1 + i % 5), "a" if i % 3 else "b") for i in range(400)])
    less = {r.doc_id: r.taken for r in mixing.mix_sources(d, mixing.MixRules(share=0.3)).collect()}
    more = {r.doc_id: r.taken for r in mixing.mix_sources(d, mixing.MixRules(share=0.6)).collect()}
    assert all(less[i] <= more[i] for i in less)


def test_mix_hard_rows_and_empty_table(spark):
    got = mixing.mix_sources(docs(spark, HARD)).collect()
    assert len(got) == len(HARD) and {r.doc_id: r.size for r in got}[2] == 0
    assert mixing.mix_sources(docs(spark, [])).count() == 0
    assert all(r.target == 0 and r.taken == 0 for r in mixing.mix_sources(docs(spark, [(1, None), (2, "")])).collect())


def test_apply_mix_repeats_rows(spark):
    d = clashing(docs(spark, [(i, "w " * 4, s) for i, s in enumerate(["a"] * 20 + ["b"] * 60 + [None] * 2)]))
    times = {r.doc_id: r.taken // 4 for r in mixing.mix_sources(d).collect()}
    out = mixing.apply_mix(d)
    assert out.columns == d.columns
    assert Counter(r.doc_id for r in out.collect()) == {i: n for i, n in times.items() if n}


PAGES = "page_id long, url string, html string, digest string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(i, f"http://x/{i}\r\n", h, "d", "p") for i, h in rows], PAGES)


def test_archive_round_trip(spark, tmp_path):
    long, short = "é" * 60, "tiny"
    rows = [(5, long), (3, long), (9, long), (1, short), (2, short), (4, None), (6, ""), (7, "a\r\n\r\nWARC/1.1\r\n" * 20), (3, long), (None, "z" * 200)]
    path = str(tmp_path / "archive")
    warc.write_archive(pages(spark, rows), path)
    read = warc.read_archive(spark, path)
    got = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.parse_records(read).collect()}
    assert got == {(3, "response", None, 120), (5, "revisit", 3, 120), (9, "revisit", 3, 120), (1, "response", None, 4), (2, "response", None, 4),
                   (4, "response", None, 0), (6, "response", None, 0), (7, "response", None, 300), (None, "response", None, 200)}
    assert spark.read.parquet(f"{path}/payloads").count() == 5  # each payload once
    record = read.filter(F.octet_length("payload") == 300).select("record").first()[0]
    head, _, rest = bytes(record).partition(b"\r\n\r\n")
    assert head.startswith(b"WARC/1.1\r\n") and b"Content-Length: 300" in head and rest == rows[7][1].encode() + b"\r\n\r\n"
    warc.write_warc_files(read, str(tmp_path / "files"))
    text = b"".join(p.read_bytes() for p in sorted((tmp_path / "files").glob("part-*")))
    records = 0
    while text:  # by Content-Length, as any reader does
        head, _, rest = text.partition(b"\r\n\r\n")
        size = int(head.split(b"Content-Length: ")[1].split(b"\r\n")[0])
        assert rest[size : size + 4] == b"\r\n\r\n"
        text, records = rest[size + 4 :], records + 1
    assert records == len(rows)


def test_archive_notices_damage(spark, tmp_path):
    path = str(tmp_path / "a")
    warc.write_archive(pages(spark, [(1, "q" * 300)]), path)
    bad = spark.read.parquet(f"{path}/payloads").withColumn("payload", F.lit(b"other")).collect()
    spark.createDataFrame(bad, "digest string, payload binary").write.mode("overwrite").parquet(f"{path}/payloads")
    with pytest.raises(Exception, match="digest"):
        warc.parse_records(warc.read_archive(spark, path)).collect()


def test_archive_of_no_pages(spark):
    assert warc.archive_pages(pages(spark, [])).count() == 0


def test_curve_visits_neighbours(spark):
    for n, bits in ((2, 3), (3, 2), (4, 2)):
        cells = [[i >> (bits * k) & ((1 << bits) - 1) for k in range(n)] for i in range(1 << bits * n)]
        df = spark.createDataFrame(cells, [f"c{k}" for k in range(n)])
        rows = sorted(df.select("*", hilbert.curve_index([F.col(f"c{k}") for k in range(n)], bits).alias("at")).collect(), key=lambda r: r["at"])
        assert [r["at"] for r in rows] == list(range(len(cells)))
        assert all(sum(abs(x - y) for x, y in zip(p[:n], q[:n])) == 1 for p, q in zip(rows, rows[1:]))


def test_shards_are_even_runs(spark):
    rows = [(i, "t" * (i * 37 % 900), f"src{i % 11}") for i in range(503)] + [(1000 + (r[0] or 0), r[1]) for r in HARD]
    got = hilbert.shard_documents(clashing(docs(spark, rows)), 40).collect()
    assert len(got) == len(rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "rows" and r.grown_shard is None
    counts = [len(by[s]) for s in range(40)]
    assert max(counts) - min(counts) <= 1
    for s in range(40):
        assert sorted(r.slot for r in by[s]) == list(range(counts[s]))
    order = sorted(got, key=lambda r: (r.shard, r.slot))
    assert [r.curve for r in order] == sorted(r.curve for r in order)
    texts = {r[0]: r[1] for r in rows}
    assert all(r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode()) and r.size == len((texts[r.doc_id] or "").encode()) + 16 for r in got)


def test_shards_of_few_and_no_rows(spark):
    assert hilbert.shard_documents(docs(spark, [])).count() == 0
    got = hilbert.shard_documents(docs(spark, [(1, "a"), (2, "b"), (2, "b")])).collect()
    assert len({r.shard for r in got}) == 3 and all(r.slot == 0 for r in got)


def test_shard_files_prune(spark, tmp_path):
    d = docs(spark, [(i, "t" * (i % 100), f"src{i % 4}") for i in range(400)])
    hilbert.write_shards(d, hilbert.shard_documents(d), str(tmp_path / "s"))
    back = spark.read.parquet(str(tmp_path / "s"))
    assert back.count() == 400
    hit = back.filter("source = 'src3' AND doc_id < 50").select("shard").distinct().count()
    assert hit < 20
