"""License scans: an exact set-similarity join of text blocks with templates, with column expressions only.

A block is a line of a text, a template the words of a known notice. Of notices wrapped over lines, see wrapped_notices. A template is found in a block that holds at least
`containment` of its distinct words. Tokens are ordered by how many blocks of the whole corpus hold them, rarest first. A
block that reaches the threshold shares a token with the template's prefix, so only blocks with such a token meet a
template (prefix filter). A block with fewer template tokens than needed is too short (length filter). Once the first
shared token in that order is known, only the tokens behind it can be shared as well; if they are too few, the pair goes
(positional filter). The rest is verified.

Templates that differ in a word or two meet the same blocks, so each names a phrase that tells it from the others of its
family ("public license version 3", "cc by nc 4"); a block is given its label only when that phrase stands in the block.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from rrnlake.llm.common import ascii_lower, staged

# Characters outside words; phrases and their labels.
BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
# Notices as they are commonly written, by label.
TEMPLATES = (
    ("gpl-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("gpl-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("mit-notice", "Released under the MIT License."),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
                  "documentation files (the Software), to deal in the Software without restriction"),
    ("cc-by-4.0", "Licensed under CC BY 4.0."),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0."),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0."),
    ("bsd-3-clause", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
                     "the following conditions are met"),
    ("mpl-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("all-rights-reserved", "All rights reserved."),
)
# The phrase without which a notice is not the one of its label; other labels need none.
TELLING = (
    ("gpl-3.0", "public license version 3"),
    ("gpl-2.0", "public license version 2"),
    ("apache-2.0", "apache license version 2"),
    ("mit-notice", "mit license"),
    ("cc-by-4.0", "cc by 4"),
    ("cc-by-nc-4.0", "cc by nc 4"),
    ("cc-by-sa-4.0", "cc by sa 4"),
    ("mpl-2.0", "mozilla public license"),
)


@dataclass(frozen=True)
class LicenseRules:
    containment: float = 0.8
    phrases: tuple[tuple[str, str], ...] = tuple(PHRASES.items())
    templates: tuple[tuple[str, str], ...] = TEMPLATES
    telling: tuple[tuple[str, str], ...] = TELLING


def _words(text: Column) -> Column:
    return F.filter(F.split(ascii_lower(text), BREAK), lambda w: w != "")


def _spaced(words: Column) -> Column:
    """Words in one string, a space around each."""
    return F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" "))


def _told(spaced: Column, rules: LicenseRules) -> Column:
    """Labels of the templates whose telling phrase stands in the words, and of those that need none."""
    phrases = dict(rules.telling)
    labels = sorted({label for label, _ in rules.templates})
    each = [F.when(F.contains(spaced, F.lit(f" {phrases[t]} ")), t) if t in phrases else F.lit(t) for t in labels]
    return F.array_compact(F.array(*each)) if each else F.array().cast("array<string>")


def template_table(spark: SparkSession, rules: LicenseRules) -> DataFrame:
    """(label, token, total, needed) per distinct word of each template: as many rows as the rules have words."""
    source = spark.createDataFrame(list(rules.templates), "label string, body string")
    needed = F.ceil(F.col("total") * F.lit(rules.containment) - F.lit(1e-9)).cast("int")
    return (
        source.select("label", F.array_distinct(_words(F.col("body"))).alias("_t")).filter(F.size("_t") > 0)
        .select("label", F.explode("_t").alias("token"), F.size("_t").alias("total")).withColumn("needed", needed)
    )


def template_blocks(docs: DataFrame, rules: LicenseRules) -> DataFrame:
    """(doc_id, block, tokens, told): the distinct template words of each line that has any; block counts lines from 0.

    told: labels whose telling phrase the line holds, looked for where a line has words enough for the shortest template.
    """
    templates = template_table(docs.sparkSession, rules).select("token", "needed").collect()
    known, fewest = sorted({r.token for r in templates}), min((r.needed for r in templates), default=1)
    vocabulary = F.array(*[F.lit(t) for t in known])
    lines = docs.select("doc_id", F.posexplode(F.split(ascii_lower(F.coalesce("text", F.lit(""))), "\n")).alias("block", "_line"))
    tokens = F.array_intersect(F.split("_line", BREAK), vocabulary)
    # Unpacked from an array of one, so that the filter does not cut the line a second time.
    held = lines.select("doc_id", "block", "_line", F.explode(F.array(tokens)).alias("tokens")).filter(F.size("tokens") > 0)
    told = F.when(F.size("tokens") >= fewest, _told(_spaced(F.split("_line", BREAK)), rules))
    return held.select("doc_id", "block", "tokens", told.alias("told"))


def scan_blocks(blocks: DataFrame, rules: LicenseRules = LicenseRules()) -> DataFrame:
    """(doc_id, block, label, containment, told) of every pair of a block and a template at or above the threshold.

    told: the block holds the telling phrase of the template too.
    """
    counts = blocks.select(F.explode("tokens").alias("token")).groupBy("token").agg(F.count("*").alias("blocks"))
    templates = template_table(blocks.sparkSession, rules).join(counts, "token", "left").fillna(0, ["blocks"])
    # As many rows as the rules have words, so they may go to the driver and be broadcast.
    words = templates.select("token", "blocks").distinct().orderBy("blocks", "token").collect()
    order = F.array(*[F.lit(r.token) for r in words]) if words else F.array().cast("array<string>")
    ranked = templates.groupBy("label", "total", "needed").agg(F.collect_set("token").alias("_t"))
    ranked = ranked.withColumn("sorted", F.array_intersect(order, "_t")).drop("_t")
    prefix = F.slice("sorted", F.lit(1), F.col("total") - F.col("needed") + 1)
    heads = ranked.select("label", "total", "needed", "sorted", F.posexplode(prefix).alias("at", "token"))
    sorted_blocks = blocks.select("doc_id", "block", "told", F.array_intersect(order, "tokens").alias("tokens"))
    met = sorted_blocks.select("doc_id", "block", "tokens", "told", F.posexplode("tokens").alias("block_at", "token")).join(F.broadcast(heads), "token")
    long_enough = met.filter("size(tokens) >= needed")
    in_reach = long_enough.filter("least(size(tokens) - block_at, total - at) >= needed")
    # Of the shared tokens the first one stands for the pair.
    shared = F.array_intersect(F.col("sorted"), F.col("tokens"))
    found = in_reach.withColumn("_shared", shared).filter((F.get("_shared", F.lit(0)) == F.col("token")) & (F.size("_shared") >= F.col("needed")))
    own = F.coalesce(F.array_contains("told", F.col("label")), F.lit(False))
    return found.select("doc_id", "block", "label", (F.size("_shared") / F.col("total")).alias("containment"), own.alias("told"))


def _whole_texts(blocks: DataFrame, rules: LicenseRules) -> DataFrame:
    """(doc_id, block, tokens, told): the template words of all lines of a doc_id; told: labels whose telling words are among them."""
    # There are no more distinct tokens than the rules have words.
    whole = blocks.select("doc_id", F.explode("tokens").alias("token")).groupBy("doc_id").agg(F.collect_set("token").alias("tokens"))
    phrases = dict(rules.telling)

    def among(label: str) -> Column:
        parts = F.array(*[F.lit(w) for w in phrases.get(label, "").split()]).cast("array<string>")
        return F.when(F.size(F.array_except(parts, F.col("tokens"))) == 0, label)

    told = F.array_compact(F.array(*[among(label) for label in sorted({label for label, _ in rules.templates})]).cast("array<string>"))
    return whole.select("doc_id", F.lit(0).alias("block"), "tokens", told.alias("told"))


def wrapped_notices(docs: DataFrame, rules: LicenseRules = LicenseRules(), blocks: DataFrame | None = None) -> DataFrame:
    """(doc_id, block, label, containment) of templates whose words stand close together in a text of several lines; block is -1.

    Texts that hold enough words of a template at all, and those of its telling phrase, are found by the same join, on the
    words of their lines (blocks: those of template_blocks, if they are there). Of texts with that phrase, each window of a
    quarter more words than the template has is looked at, wherever lines end. The phrase must stand inside it.
    """
    several = docs.select("doc_id", "text").filter(F.contains("text", F.lit("\n")))
    blocks = staged(template_blocks(several, rules), "blocks") if blocks is None else blocks
    met = scan_blocks(staged(_whole_texts(blocks, rules), "texts"), rules).filter("told").select("doc_id", "label").distinct()
    phrases = dict(rules.telling)
    bodies = docs.sparkSession.createDataFrame(
        [(label, body, phrases.get(label)) for label, body in rules.templates], "label string, body string, _phrase string")
    sized = bodies.select("label", "_phrase", _words(F.col("body")).alias("_b")).select(
        "label", "_phrase", F.array_distinct("_b").alias("_t"), F.ceil(F.size("_b") * F.lit(1.25)).cast("int").alias("_size"))
    pairs = met.join(F.broadcast(sized), "label").withColumnRenamed("doc_id", "_d")
    rows = several.join(pairs, several["doc_id"].eqNullSafe(F.col("_d"))).select(
        "doc_id", "label", "_phrase", "_t", "_size", _words(F.col("text")).alias("_w"))
    spoken = F.col("_phrase").isNull() | F.contains(_spaced(F.col("_w")), F.concat(F.lit(" "), "_phrase", F.lit(" ")))
    rows = staged(rows.filter("size(_w) > 0").filter(spoken), "words")  # written, as the lambdas below would else cut the text again for each word
    needed = F.ceil(F.size("_t") * F.lit(rules.containment) - F.lit(1e-9))

    def window(i: Column) -> Column:
        return F.slice("_w", i, F.col("_size"))

    def held(i: Column) -> Column:
        return F.size(F.array_intersect(window(i), F.col("_t")))

    starts = F.filter(F.sequence(F.lit(1), F.size("_w")), lambda i: F.array_contains("_t", F.get("_w", i - 1)))
    full = staged(rows.withColumn("_full", F.filter(starts, lambda i: held(i) >= needed)).filter("size(_full) > 0"), "windows")
    own = F.filter("_full", lambda i: F.col("_phrase").isNull() | F.contains(_spaced(window(i)), F.concat(F.lit(" "), "_phrase", F.lit(" "))))
    best = full.select("doc_id", "label", F.size("_t").alias("total"), F.array_max(F.transform(own, held)).alias("most"))
    return best.filter("most is not null").select("doc_id", F.lit(-1).alias("block"), "label", (F.col("most") / F.col("total")).alias("containment"))


def _places(words: Column, spaced: Column, phrase: str) -> Column:
    """Where the words of a phrase stand one after the other, counted from 0. spaced: the words with a space around each."""
    parts = phrase.split(" ")

    def here(i: Column) -> Column:
        out = None
        for k, p in enumerate(parts):
            one = F.get(words, i + k) == F.lit(p)
            out = one if out is None else out & one
        return F.coalesce(out, F.lit(False))

    # Looking for the phrase in the joined words is quick; positions are wanted of few texts only.
    none = F.array().cast("array<int>")
    found = F.filter(F.sequence(F.lit(0), F.size(words) - 1), here)
    return F.when(F.contains(spaced, F.lit(f" {phrase} ")), found).otherwise(none)


def phrase_places(docs: DataFrame, rules: LicenseRules = LicenseRules()) -> DataFrame:
    """doc_id, n_words, and places: array of (label, at) of every phrase, in whole texts."""
    rows = docs.select("doc_id", _words(F.coalesce("text", F.lit(""))).alias("_w"))
    rows = rows.select("doc_id", "_w", _spaced(F.col("_w")).alias("_spaced"))

    def placed(phrase: str, label: str) -> Column:
        at = _places(F.col("_w"), F.col("_spaced"), phrase)
        return F.transform(at, lambda x: F.struct(F.lit(label).alias("label"), x.alias("at")))

    each = [placed(phrase, label) for phrase, label in rules.phrases]
    return rows.select("doc_id", F.size("_w").cast("long").alias("n_words"), F.concat(*each).alias("places"))


def scan_documents(docs: DataFrame, rules: LicenseRules = LicenseRules()) -> DataFrame:
    """n_words, base places and labels, and template labels of every document.

    score is 1 with a base place, else the best containment of a template, else 0. Null and empty texts have no words.
    Rows that share a doc_id share their template labels; a null doc_id is one such id. An empty table gives no rows; other columns are ignored.
    Runs jobs.
    """
    base = phrase_places(docs, rules)
    blocks = staged(template_blocks(docs, rules), "blocks")
    lines = scan_blocks(blocks, rules).filter("told").drop("told")
    found = lines.unionByName(wrapped_notices(docs, rules, blocks))
    extra = found.groupBy(F.col("doc_id").alias("_d")).agg(F.collect_set("label").alias("_more"), F.max("containment").alias("_best"))
    own = F.array_distinct(F.transform("places", lambda p: p["label"]))
    starts = F.transform("places", lambda p: p["at"])
    empty = F.array().cast("array<string>")
    joined = base.join(extra, base["doc_id"].eqNullSafe(extra["_d"]), "left")
    return joined.select(
        "doc_id", "n_words", F.size("places").cast("long").alias("n_base"),
        F.array_min(starts).cast("long").alias("first_word"), F.array_max(starts).cast("long").alias("last_word"),
        F.array_join(F.sort_array(own), ",").alias("base_labels"),
        F.array_join(F.sort_array(F.array_union(own, F.coalesce("_more", empty))), ",").alias("labels"),
        F.when(F.size("places") > 0, F.lit(1.0)).otherwise(F.coalesce("_best", F.lit(0.0))).alias("score"),
    )
