"""Line dedup by winnowing over line hashes, with column expressions only.

A text is cut into lines, and lines at the ends of sentences, so that a passage inside a line is found as well. A stretch
starts at a line and goes on until it has `least_words` words, or `most_lines` lines with as many words. The hashes of each two lines in a row
are combined, and winnowing keeps of every stretch the pair with the least hash, the rightmost of equals: equal stretches
keep the same one, so a repeated stretch always has a repeated fingerprint. Only at repeated fingerprints whole stretches
are compared, forward from each line and backward from each line: with both directions a match extends to all lines it
has. Lines of a stretch that occurs earlier, in order of doc_id and position, are deleted.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from rrnlake.llm.common import WORD, staged
from rrnlake.plans.sizing import broadcast_if_small

NO_ID = -(1 << 63)  # stands for a null doc_id


@dataclass(frozen=True)
class LineRules:
    """A line ends behind each of `ends`, and line breaks that follow belong to it: empty lines are none of their own."""

    least_words: int = 50
    most_lines: int = 12
    ends: tuple[str, ...] = ("\n", ". ", "! ", "? ")


SPAN = 64  # a stretch is coded as its first line times this, plus its number of lines
PLACE_BITS = 24  # of a pair's code hold its line
MARK = "\x01"  # set behind the ends of lines, where a text has none itself


def split_lines(text: Column, rules: LineRules) -> Column:
    """Lines with their ends: joined they are the text again."""
    marked = text
    for end in rules.ends:
        marked = F.replace(marked, F.lit(end), F.lit(end + MARK))
    marked = F.replace(marked, F.lit(MARK + "\n"), F.lit("\n"))
    pattern = "|".join(f"(?<={re.escape(end)})(?!\n)" for end in rules.ends)
    units = F.when(F.contains(text, F.lit(MARK)), F.split(text, pattern)).otherwise(F.split(marked, MARK))
    return F.filter(units, lambda u: u != "")


def _plain(line: Column) -> Column:
    return F.rtrim(F.replace(line, F.lit("\n"), F.lit("")))


def _with_sums(df: DataFrame, source: str, keep: list[str]) -> DataFrame:
    """Add n2, n4 and n8: words of so many lines from each line on, or of those there are; source has the words of each."""
    for name, old, step in (("n2", source, 1), ("n4", "n2", 2), ("n8", "n4", 4)):
        df = df.select(*keep, F.transform(old, lambda x, i: x + F.coalesce(F.get(old, i + step), F.lit(0))).alias(name))
        keep = [*keep, name]
    return df


def _reach(source: str, i: Column, rules: LineRules) -> Column:
    """Lines of the stretch from line i on: 0 if the text ends before it is complete."""

    def words(count: int) -> Column:  # of `count` lines, from sums of eight, four, two and one
        total, done = None, 0
        for size, name in ((8, "n8"), (4, "n4"), (2, "n2"), (1, source)):
            while count - done >= size:
                one = F.coalesce(F.get(name, i + done), F.lit(0)) if done else F.get(name, i)
                total, done = one if total is None else total + one, done + size
        return total

    def search(low: int, high: int) -> Column:  # the least count with enough words, which `high` has
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(words(middle) >= rules.least_words, search(low, middle)).otherwise(search(middle + 1, high))

    most = rules.most_lines
    whole = F.get(source, i + most - 1).isNotNull() & (words(most) >= min(most, rules.least_words))
    found = F.when(words(most - 1) >= rules.least_words, search(1, most - 1)).when(whole, most)
    return found.otherwise(0).cast("tinyint")


def _lined(docs: DataFrame, rules: LineRules) -> DataFrame:
    """_id, _x (hash of the text), h and n (hash and words of each line), ahead (length of the stretch from each line)."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(
        F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_x"), split_lines(text, rules).alias("_u"),
        text.rlike(r"[\t\x0B\f\r]").alias("_t"))
    rows = rows.select("_id", "_x", "_t", F.transform("_u", _plain).alias("_p"))
    spaced = lambda p: F.when(p == "", 0).otherwise(F.length(p) - F.length(F.replace(p, F.lit(" "), F.lit(""))) + 1)
    count = lambda p: F.when(F.col("_t"), F.regexp_count(p, F.lit(WORD))).otherwise(spaced(p))
    rows = rows.select("_id", "_x", F.transform("_p", lambda p: F.xxhash64(p)).alias("h"), F.transform("_p", count).alias("n"))
    rows = _with_sums(rows, "n", ["_id", "_x", "h", "n"])
    return rows.select("_id", "_x", "h", "n", F.transform("n", lambda _, i: _reach("n", i, rules)).alias("ahead"))


def _fingerprints(lined: DataFrame) -> DataFrame:
    """Add `marks`: how far behind each line the least pair of lines of its stretch begins, the rightmost of equals; -1
    without a stretch. A stretch of one line is marked at itself.

    A code holds the leading 40 bits of a pair's hash and its line turned round, so that the least one is the rightmost.
    """
    index, low = F.sequence(F.lit(0), F.size("h") - 1), (1 << PLACE_BITS) - 1

    def code(i: Column) -> Column:  # the last line is alone
        pair = F.xxhash64(F.get("h", i), F.get("h", i + 1)).bitwiseAND(F.lit(~low))
        return pair.bitwiseOR(F.lit(low) - i.cast("long").bitwiseAND(F.lit(low)))

    keep = [F.col(c) for c in lined.columns]
    rows = lined.select(*keep, F.when(F.size("h") > 0, F.transform(index, code)).alias("m1"))
    for span in (2, 4, 8):  # least codes of so many pairs from each line on; least() passes over what lies beyond the end
        keep, old = [*keep, F.col(f"m{span // 2}")], f"m{span // 2}"
        rows = rows.select(*keep, F.transform(old, lambda x, i: F.least(x, F.get(old, i + span // 2))).alias(f"m{span}"))

    def least(i: Column, length: Column) -> Column:
        found = F.lit(None).cast("long")
        for span in (1, 2, 4, 8):  # two spans that overlap cover a stretch
            both = F.least(F.get(f"m{span}", i), F.get(f"m{span}", i + length - 1 - span))
            found = F.when(length > span, both) if span == 1 else F.when(length > span, both).otherwise(found)
        return found

    def mark(length: Column, i: Column) -> Column:
        offset = (F.lit(low) - least(i, length.cast("int")).bitwiseAND(F.lit(low)) - i).bitwiseAND(F.lit(low))
        return F.when(length > 1, offset).when(length == 1, 0).otherwise(-1).cast("tinyint")

    return rows.select(*lined.columns, F.transform("ahead", mark).alias("marks"))


def repeated_stretches(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """(_id, _x, start, end, first_id, first_start): every stretch of lines that occurs earlier, with where.

    Positions count lines from 0. Rows equal in doc_id and text are one document. Runs jobs.
    """
    # Filtered only once written: a filter pushed into the projections would compute their arrays again for each element.
    wide = _fingerprints(_lined(docs, rules)).withColumn("n", F.transform("n", lambda n: F.least(n, F.lit(rules.least_words)).cast("smallint")))
    lined = staged(wide, "lines").filter("exists(ahead, a -> a > 0)")
    # A fingerprint is a pair of lines, or a line of a stretch by itself: its line times two, plus one if by itself. Sets are
    # of numbers here, since distinct structs of an array are found by comparing all of them with each other.
    alone = lambda i: (F.get("ahead", i) == 1).cast("int")
    code = F.transform("marks", lambda m, i: F.when(m >= 0, (i + m) * 2 + alone(i)))
    marked = lined.select("_id", "_x", "h", F.explode(F.array_distinct(F.array_compact(code))).alias("_m"))
    line = F.shiftright("_m", 1)
    own = F.xxhash64(F.get("h", line), F.when(F.col("_m") % 2 == 0, F.get("h", line + 1)))
    marked = marked.select("_id", "_x", "_m", own.alias("hash"))
    # Written first: Spark splits a hot fingerprint only where both sides of a join are plain exchanges.
    twice = staged(marked.groupBy("hash").agg(F.count("*").alias("_n")).filter("_n > 1").select("hash"), "fingerprints")
    live = marked.join(broadcast_if_small(twice), "hash").groupBy("_id", "_x").agg(F.collect_set("_m").alias("live"))  # bounded by the document
    near = lined.join(live, ["_id", "_x"]).select("_id", "_x", "h", "ahead", "marks", "live", F.reverse("n").alias("back"))
    near = _with_sums(near, "back", ["_id", "_x", "h", "ahead", "marks", "live", "back"])
    last, most = F.size("h") - 1, rules.most_lines

    def starts_of(m: Column) -> Column:  # the lines whose stretch has this fingerprint
        p = F.shiftright(m, 1)
        around = F.sequence(F.greatest(p - (most - 1), F.lit(0)), p)
        return F.filter(around, lambda i: (F.get("marks", i).cast("int") == p - i) & (alone(i) == m % 2))

    behind = F.reverse(F.transform("back", lambda _, i: _reach("back", i, rules)))
    near = near.select("_id", "_x", "h", "ahead", behind.alias("behind"), F.flatten(F.transform("live", starts_of)).alias("starts"))

    # A stretch back to a line holds the forward stretch from there, so it repeats only where that one is live.
    def ends_of(i: Column) -> Column:
        around = F.sequence(i, F.least(i + (most - 1), last))
        back = F.filter(around, lambda j: F.get("behind", j).cast("int") == j - i + 1)
        return F.transform(back, lambda j: i * SPAN + (j - i + 1))

    forward = F.transform("starts", lambda i: i * SPAN + F.get("ahead", i).cast("int"))
    near = near.select("_id", "_x", "h", F.array_distinct(F.concat(forward, F.flatten(F.transform("starts", ends_of)))).alias("_all"))
    # 96 bits stand for the lines of a stretch, made before the rows part, so that none carries the lines of its document.
    lines = lambda s: F.slice("h", F.floor(s / SPAN).cast("int") + 1, (s % SPAN).cast("int"))
    keys = F.transform("_all", lambda s: F.struct(s.alias("s"), F.xxhash64(lines(s)).alias("k"), F.hash(lines(s)).alias("l")))
    rows = near.select("_id", "_x", F.explode(keys).alias("_s")).select("_id", "_x", "_s.*")
    start = F.floor(F.col("s") / SPAN).cast("int")
    rows = rows.select("_id", "_x", start.alias("start"), (start + (F.col("s") % SPAN).cast("int") - 1).alias("end"), F.col("k").alias("_k"), F.col("l").alias("_l"))
    rows = staged(rows, "stretches")  # read twice
    first = rows.groupBy("_k", "_l").agg(F.min(F.struct("_id", "start", "_x")).alias("_f"), F.count("*").alias("_n")).filter("_n > 1")
    first = staged(first.drop("_n"), "firsts").hint("merge")  # as many as repeats: shuffled at every size
    here = F.struct("_id", "start", "_x")
    return rows.join(first, ["_k", "_l"]).filter(here != F.col("_f")).select(
        "_id", "_x", "start", "end", F.col("_f._id").alias("first_id"), F.col("_f.start").alias("first_start"))


def deleted_runs(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """(_id, _x, runs): per document with repeated stretches the runs of lines to delete, merged, in order. Runs jobs."""
    spans = repeated_stretches(docs, rules).select("_id", "_x", "start", "end").distinct()
    own = Window.partitionBy("_id", "_x").orderBy("start", "end")  # one document
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    fresh = spans.withColumn("_new", F.coalesce((F.col("start") > before + 1).cast("int"), F.lit(1)))
    runs = fresh.withColumn("_run", F.sum("_new").over(own)).groupBy("_id", "_x", "_run").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return runs.groupBy("_id", "_x").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("runs"))


def dedup_lines(docs: DataFrame, rules: LineRules = LineRules()) -> DataFrame:
    """The rows of docs with later repeated runs of lines deleted from `text`; adds `deleted_lines`.

    All columns of docs stay; n_chars, if there is one, becomes the length of the new text. The first occurrence of a run
    stays, later ones go, in the same document or others; a document that is all repeats keeps an empty text. Null and
    empty texts, and texts without a repeated stretch, stay as they are. Rows equal in doc_id and text are one document and
    change alike; a null doc_id counts as the smallest. docs may have any other columns but deleted_lines. Runs jobs.
    """
    runs = deleted_runs(docs, rules).select(F.col("_id").alias("__id"), F.col("_x").alias("__x"), F.col("runs").alias("__runs"))
    keyed = docs.withColumns({"__a": F.coalesce("doc_id", F.lit(NO_ID)), "__b": F.xxhash64(F.coalesce("text", F.lit("")))})
    both = keyed.join(runs, (F.col("__a") == F.col("__id")) & (F.col("__b") == F.col("__x")), "left")
    both = both.withColumn("__u", F.when(F.col("__runs").isNotNull(), split_lines(F.col("text"), rules)))
    count = F.size("__runs")

    def kept(i: Column) -> Column:  # lines between the runs
        start = F.when(i == 0, 0).otherwise(F.get("__runs", i - 1)["end"] + 1)
        stop = F.when(i == count, F.size("__u")).otherwise(F.get("__runs", i)["start"])
        return F.array_join(F.slice("__u", start + 1, stop - start), "")

    text = F.array_join(F.transform(F.sequence(F.lit(0), count), kept), "")
    gone = F.aggregate("__runs", F.lit(0), lambda n, r: n + r["end"] - r["start"] + 1)
    both = both.withColumns({
        "text": F.when(F.col("__runs").isNull(), F.col("text")).otherwise(text), "deleted_lines": F.coalesce(gone, F.lit(0))})
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        both = both.withColumn("n_chars", F.when(F.col("deleted_lines") > 0, changed).otherwise(F.col("n_chars")))
    return both.select(*docs.columns, "deleted_lines")
