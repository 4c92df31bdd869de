"""Small tables with the cases every operator must bear."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Columns beside those an operator needs, with names it may use itself.
CLASHING = ", size string, score string, target string, hash string, key string, fp string, component_id string, place string, _id string"


def docs(spark, rows, schema=DOCS):
    """rows: (doc_id, text) or (doc_id, text, source)."""
    wide = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", None if r[1] is None else len(r[1])) for r in rows]
    return spark.createDataFrame(wide, schema)


def clashing(df):
    from pyspark.sql import functions as F
    names = [c.split()[0] for c in CLASHING.strip(", ").split(", ")]
    return df.withColumns({c: F.lit("x") for c in names})


HARD = [(1, "one two three four"), (2, None), (3, ""), (4, " \t\n"), (5, "word " * 30_000), (6, "x" * 40_000),
        (7, "one two three four"), (7, "one two three four"), (None, "no id here"), (8, "Ünïcode ß 漢字 😀 ▁ tést")]
