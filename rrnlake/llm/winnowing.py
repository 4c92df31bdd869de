"""Document fingerprints by winnowing (Schleimer, Wilkerson, Aiken 2003), with column expressions only.

Words are hashed, the hashes of k words in a row are combined, and of every window of w such k-grams the least hash is kept
with its position, the rightmost of equals. Two texts that share k + w - 1 words in a row share a fingerprint at matching
positions.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from rrnlake.llm.common import staged
from rrnlake.plans.ordering import dense_index, with_neighbours


@dataclass(frozen=True)
class WinnowRules:
    """Grams of `gram` words, windows of `window` grams."""

    gram: int = 4
    window: int = 16

    @property
    def guarantee(self) -> int:
        """Any match of so many words shares a fingerprint."""
        return self.gram + self.window - 1


def word_hashes(text: Column) -> Column:
    """XXH64 of each word; words are told apart by ASCII white space. Empty for null."""
    words = F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+")
    return F.transform(F.filter(words, lambda w: w != ""), lambda w: F.xxhash64(w))


def _merged(df: DataFrame, name: str, span: int, merge, keep: list[str]) -> DataFrame:
    """Replace each element of an array column by what merge makes of it and its span - 1 successors.

    A step joins elements with those `shift` places on and doubles what an element stands for; the halves of the last step
    may overlap. Arrays shorter than the span end as one element over all of them, empty ones stay empty. Each step is a
    projection of its own, so that none is computed twice.
    """
    done = 1
    while done < span:
        shift = min(done, span - done)
        old, count = F.col(name), F.size(name)
        # Without a full pair a single element is left, which merge takes from both ends.
        last = F.greatest(count - shift - 1, F.lit(0))
        joined = F.transform(F.sequence(F.lit(0), last), lambda i: merge(F.get(old, i), F.get(old, F.least(i + shift, count - 1))))
        df = df.select(*keep, F.when(count > 1, joined).otherwise(old).alias(name))
        done += shift
    return df


CODE_BITS = 24  # of a code's 64 bits hold the position, turned round so that the rightmost of equal hashes is the least


def _codes(grams: Column) -> Column:
    low = (1 << CODE_BITS) - 1
    return F.transform(grams, lambda h, i: h.bitwiseAND(F.lit(~low)).bitwiseOR(F.lit(low) - i.cast("long").bitwiseAND(F.lit(low))))


def _marked(df: DataFrame, source: str, name: str, rules: WinnowRules, *keep: str) -> DataFrame:
    """Add the marks (hash, pos) of the text in column source.

    Windows compare the leading 40 bits of the hashes; positions count grams from 0, and stay exact in texts of up to
    2**24 words (beyond, they count from the last multiple of it). Grams of texts with fewer words than a gram, and windows
    of texts with fewer grams than a window, are over all there is.
    """
    low = (1 << CODE_BITS) - 1
    df = df.select(*keep, word_hashes(F.col(source)).alias("_g"))
    df = _merged(df, "_g", rules.gram, F.xxhash64, [*keep])
    df = df.select(*keep, "_g", _codes(F.col("_g")).alias("_c"))
    df = _merged(df, "_c", rules.window, F.least, [*keep, "_g"])
    fresh = F.filter("_c", lambda x, i: (i == 0) | (F.get("_c", i - 1) != x))  # windows that share a minimum follow each other
    df = df.select(*keep, "_g", fresh.alias("_c"))
    place = lambda c: (F.lit(low) - c.bitwiseAND(F.lit(low))).cast("int")
    return df.select(*keep, F.transform("_c", lambda c: F.struct(F.get("_g", place(c)).alias("hash"), place(c).alias("pos"))).alias(name))


def fingerprints(docs: DataFrame, rules: WinnowRules = WinnowRules()) -> DataFrame:
    """doc_id and marks (array of hash, pos) of every document.

    Null and empty texts, and texts without words, have no marks. Texts of fewer words than a gram have one mark over all
    words. Repeated rows repeat; other columns are ignored.
    """
    return _marked(docs.select("doc_id", "text"), "text", "marks", rules, "doc_id")


def matches(prints: DataFrame) -> DataFrame:
    """(hash, doc_id, pos, first_id, first_pos): every later mark with the first one of its hash. Runs a job.

    Marks are written first: the optimizer would push a test of their arrays into the steps that make them, and have them
    made again for each element.
    """
    rows = staged(prints, "marks").select("doc_id", F.explode("marks").alias("_m")).select("doc_id", "_m.hash", "_m.pos")
    first = rows.groupBy("hash").agg(F.min(F.struct("doc_id", "pos")).alias("_f"), F.count("*").alias("_n")).filter("_n > 1")
    return rows.join(first, "hash").select(
        "hash", "doc_id", "pos", F.col("_f.doc_id").alias("first_id"), F.col("_f.pos").alias("first_pos")
    ).filter("doc_id <> first_id OR pos <> first_pos")


def digest(marks: Column) -> Column:
    """A fingerprint as a string: the number of marks and a SHA-256 of their hashes and positions in order."""
    listed = F.transform(marks, lambda m: F.concat(m["hash"].cast("string"), F.lit(":"), m["pos"].cast("string")))
    return F.concat(F.size(marks).cast("string"), F.lit("-"), F.sha2(F.array_join(listed, ","), 256))


def likeness(a: Column, b: Column) -> Column:
    """Share of common hashes among those of either of two arrays of distinct hashes; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    either = F.size(a) + F.size(b) - both
    return F.when(either == 0, F.lit(1.0)).otherwise(both / F.greatest(either, F.lit(1)))


def _hashes(marks: Column) -> Column:
    return F.array_distinct(F.transform(marks, lambda m: m["hash"]))


NO_ID = -(1 << 63)  # stands for a null doc_id, so that joins on it need no null-safe keys


def compare_edited(docs: DataFrame, rules: WinnowRules = WinnowRules()) -> DataFrame:
    """Fingerprint every text, its edited text and the next document's, and their likeness.

    The edited text has its last n_chars div 2 code points replaced by as many, or all, first ones of the document next in
    order of doc_id; after the last comes the first, and a single document follows itself. Null ids come first. Rows that
    share a doc_id follow each other in an order fixed by their texts; rows equal in doc_id and text are one document, and
    each gets its result. Null text counts as empty. An empty table gives no rows. Runs jobs.

    Only ids and lengths are sorted. Texts are shuffled once by id, and of each text only what the edit of the document
    before it needs goes there, together with its hashes.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.coalesce("doc_id", F.lit(NO_ID)).alias("_id"), F.xxhash64(text).alias("_x"), text.alias("text"))
    narrow = rows.groupBy("_id", "_x").agg(F.max(F.length("text")).alias("n_chars"), F.count("*").alias("_copies"))
    order = dense_index(narrow, [F.col("_id"), F.col("_x")], "place")
    order = staged(with_neighbours(order, "place", ["_id", "_x", "n_chars"], block=1 << 12), "order")
    last = order.orderBy(F.col("place").desc()).select("_id", "_x", "n_chars").first()
    if last is not None:  # the last document comes before the first
        wrap = F.struct(F.lit(last[0]).cast("long").alias("_id"), F.lit(last[1]).cast("long").alias("_x"), F.lit(last[2]).alias("n_chars"))
        order = order.withColumn("prev", F.coalesce("prev", wrap))
    once = rows.dropDuplicates(["_id", "_x"])
    sent = once.join(order.select("_id", "_x", "prev"), ["_id", "_x"]).select(
        F.col("prev._id").alias("_id"), F.col("prev._x").alias("_x"),
        F.expr("substring(text, 1, prev.n_chars div 2)").alias("_head"), "text")
    sent = _marked(sent, "text", "_next", rules, "_id", "_x", "_head").select("_id", "_x", "_head", _hashes(F.col("_next")).alias("_next"))
    base = once.join(order.select("_id", "_x", "n_chars", "_copies"), ["_id", "_x"]).join(sent, ["_id", "_x"])
    edited = F.concat(F.expr("substring(text, 1, n_chars - n_chars div 2)"), F.col("_head"))
    kept = ["_id", "n_chars", "_copies", "_next"]
    base = base.select(*kept, "text", edited.alias("_edited"))
    base = base.withColumn("edited_sha256", F.sha2(F.col("_edited").cast("binary"), 256))
    base = _marked(base, "text", "_own", rules, *kept, "edited_sha256", "_edited")
    base = _marked(base, "_edited", "_changed", rules, *kept, "edited_sha256", "_own")
    base = base.withColumns({"_o": _hashes(F.col("_own")), "_c": _hashes(F.col("_changed"))})
    return base.select(
        F.when(F.col("_id") != NO_ID, F.col("_id")).alias("doc_id"), F.col("n_chars").cast("long").alias("n_chars"), "edited_sha256",
        digest(F.col("_own")).alias("fingerprint"), digest(F.col("_changed")).alias("edited_fingerprint"),
        likeness(F.col("_o"), F.col("_c")).alias("near_edited"), likeness(F.col("_o"), F.col("_next")).alias("near_next"),
        F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))).alias("_copy"),
    ).drop("_copy")
