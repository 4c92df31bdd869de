from __spark_entry__ import oracle_sql, queries


def test_products_reach_the_reference_length(spark, small):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{small}/documents.parquet'")
    rows = queries()["insilico_pcr"](spark, small)
    want = con.execute(f"SELECT seqid, pair, strand, start, \"end\", length, amplicon FROM ({oracle_sql()['insilico_pcr']})").fetchall()
    got = [tuple(r) for r in rows.collect()]
    assert sorted(got) == sorted(want)
    lengths = [r[5] for r in got]
    assert max(lengths) <= 10_000 and sum(n > 400 for n in lengths) > len(lengths) / 2
