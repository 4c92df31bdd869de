"""The registered corpus queries and their SQL twins. Each query takes (spark, folder)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from rrnlake.llm import (
    dialogue, embeddings, hilbert, licenses, linedup, mixing, quality, segmentation, simhash, token_store, warc, whitening, winnowing,
)
from rrnlake.llm.common import staged, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_mix_sources(spark, folder):
    """Words that a mix of all sources takes from each document."""
    mixed = mixing.mix_sources(table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", F.round("target", 6).alias("target"), "taken")


@query
def op2_warc_archive(spark, folder):
    """All pages through a content-addressed WARC archive and back."""
    return warc.archive_pages(table(spark, folder, "pages")).drop("url")


@query
def op3_hilbert_shards(spark, folder):
    """All documents in 40 shards along a Hilbert curve."""
    return hilbert.shard_documents(table(spark, folder, "documents"))


@query
def op4_line_dedup(spark, folder):
    """Lines deleted from every document as later repeats, and a digest of what is left."""
    left = linedup.dedup_lines(table(spark, folder, "documents"))
    return left.select("doc_id", "deleted_lines", F.col("n_chars").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


@query
def op5_simhash_near_dedup(spark, folder):
    """SimHash fingerprint and component of every document."""
    return simhash.near_duplicates(table(spark, folder, "documents")).drop("fp")


@query
def op6_compression_quality(spark, folder):
    """Quality score of every document by compression with dictionaries of good and bad text."""
    return quality.score_documents(table(spark, folder, "documents"), table(spark, folder, "labels"))


@query
def op7_license_scan(spark, folder):
    """License phrases and templates of every document."""
    return licenses.scan_documents(table(spark, folder, "documents"))


@query
def op8_collision_counting(spark, folder):
    """Links and component of every embedding among those of its label."""
    return embeddings.near_vectors(table(spark, folder, "embeddings"))


@query
def op9_winnowing(spark, folder):
    """Fingerprints of every document, its edited text and its successor."""
    return winnowing.compare_edited(table(spark, folder, "documents"))


@query
def op10_nbest_segmentation(spark, folder):
    """The four best segmentations of every document: scores, digests, and whether the best decodes to the text."""
    docs = table(spark, folder, "documents")
    encoded = staged(segmentation.encode_nbest(docs), "encoded")
    back = segmentation.decode_ids(encoded).select("doc_id", F.sha2("text", 256).alias("decoded_sha256"))
    return encoded.select(
        "doc_id", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_xxh64"), F.col("nbest.score").alias("scores"),
        F.to_json("nbest.edits").alias("edits"),
    ).join(back, "doc_id")


@query
def op11_dialogue_repair(spark, folder):
    """Faults of damaged conversations, and their cheapest repair."""
    rows = table(spark, folder, "conversations")
    return dialogue.repair_conversations(dialogue.damage_rows(rows), rows.select("conv_id"))


@query
def op12_token_store(spark, folder):
    """All documents through files of token ids with Elias-Fano coded bounds and back."""
    import public_tokenizers

    return token_store.store_documents(table(spark, folder, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op13_whitened_vectors(spark, folder):
    """Every embedding on the four leading whitened components."""
    return whitening.whiten_vectors(table(spark, folder, "embeddings"))


ORACLES: dict[str, str] = {
    "op1_mix_sources": r"""
        WITH d AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
                   ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS key
            FROM documents),
        s AS (
            SELECT source, sum(size)::BIGINT AS source_size,
                   CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0 ELSE 1.0 END AS weight
            FROM d GROUP BY source),
        o AS (
            SELECT *, 3.0::DOUBLE * source_size AS room,
                   row_number() OVER (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST) AS i,
                   sum(source_size) OVER () AS total
            FROM s),
        l AS (
            SELECT *, (total - coalesce(sum(room) OVER (ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
                      / sum(weight) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
            FROM o),
        t AS (
            SELECT source, source_size,
                   least(room, weight * (SELECT min_by(level, i) FROM l WHERE level * weight <= room)) AS target
            FROM l),
        p AS (
            SELECT *, CASE WHEN source_size > 0 THEN least(floor(target / source_size), 3) ELSE 0 END::BIGINT AS passes FROM t),
        k AS (
            SELECT source, key, sum(size)::BIGINT AS g, sum(sum(size)) OVER (PARTITION BY source ORDER BY key)::BIGINT AS upto
            FROM d GROUP BY source, key),
        b AS (
            SELECT p.source, min_by(CASE WHEN upto - (target - passes * source_size) < (target - passes * source_size) - (upto - g)
                                         THEN key ELSE key - 1 END, key) AS last_key
            FROM k JOIN p ON k.source IS NOT DISTINCT FROM p.source
            WHERE upto > target - passes * source_size GROUP BY p.source)
        SELECT doc_id, size, source_size, round(target, 6) AS target,
               size * (passes + CASE WHEN b.last_key IS NOT NULL AND key > b.last_key THEN 0 ELSE 1 END) AS taken
        FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source LEFT JOIN b ON d.source IS NOT DISTINCT FROM b.source""",
    "op2_warc_archive": """
        WITH p AS (
            SELECT page_id, sha256(coalesce(html, '')) AS payload_digest, strlen(coalesce(html, ''))::BIGINT AS payload_bytes
            FROM pages),
        f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM p)
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_id OR payload_bytes < 100 THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id AND payload_bytes >= 100 THEN first_id END AS refers_to
        FROM f""",
}


def _dialogue_sql() -> str:
    """Damage, faults and the cheapest repair, row by row over the four states, with whole strings."""
    moves = [f"({i}, {i}, 'D')" for i in range(4)]
    moves += ["(0, 1, 's')", *(f"({i}, 2, 'u')" for i in (0, 1, 3)), "(2, 3, 'a')"]
    inserts = [*(f"({i}, 2, 'user')" for i in (0, 1, 3)), "(2, 3, 'assistant')"]
    return f"""
        WITH RECURSIVE crc AS (
            SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i, range(8)),
                lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
        named AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   xor(list_reduce(list_prepend(4294967295::BIGINT,
                       list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
                       lambda c, b: xor(c >> 8, crc.t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS c
            FROM conversations, crc),
        damaged AS (
            SELECT conv_id, turn, CASE WHEN c = 4 THEN 'user' ELSE role END AS role,
                   CASE c WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                   unnest(CASE WHEN c = 3 THEN [0, 1] ELSE [0] END) AS copy
            FROM named WHERE c <> 0),
        r AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS i FROM damaged),
        f AS (
            SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                           WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                           WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
                   left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) || left(role, 1) AS pair
            FROM r),
        moves AS (SELECT * FROM (VALUES {", ".join(moves)}) v(s, e, c)),
        inserts AS (SELECT * FROM (VALUES {", ".join(inserts)}) v(s, e, name)),
        more AS (
            SELECT s, e, 5 AS cost, 'I' AS letters, chr(10) || name || ':' AS new FROM inserts
            UNION ALL SELECT a.s, b.e, 10, 'II', chr(10) || a.name || ':' || chr(10) || b.name || ':' FROM inserts a JOIN inserts b ON a.e = b.s
            UNION ALL SELECT i, i, 0, '', '' FROM range(4) v(i)),
        step AS (
            SELECT f.conv_id, f.i, m.s, x.e,
                   x.cost + CASE WHEN m.c = 'D' THEN 2 ELSE (left(role, 1) <> m.c)::INT + 5 * (fault = 'truncated')::INT END AS cost,
                   CASE WHEN m.c = 'D' THEN 'D' WHEN left(role, 1) = m.c THEN 'K' ELSE 'R' END || x.letters AS letters,
                   CASE WHEN m.c = 'D' THEN '' ELSE chr(10) || CASE WHEN left(role, 1) = m.c THEN role WHEN m.c = 'u' THEN 'user' ELSE 'assistant' END
                        || ':' || text END || x.new AS new
            FROM f JOIN moves m ON (m.c = 'D' OR fault NOT IN ('blank', 'duplicate')) AND (m.c <> 's' OR left(role, 1) = 's') JOIN more x ON x.s = m.e),
        walk AS (
            SELECT conv_id, 0::BIGINT AS i, e AS state, {{'cost': more.cost, 'letters': more.letters, 'new': more.new}} AS best
            FROM (SELECT DISTINCT conv_id FROM f), more WHERE more.s = 0
            UNION ALL
            SELECT w.conv_id, w.i + 1, p.e,
                   min({{'cost': w.best.cost + p.cost, 'letters': w.best.letters || p.letters, 'new': w.best.new || p.new}})
            FROM walk w JOIN step p ON p.conv_id IS NOT DISTINCT FROM w.conv_id AND p.i = w.i + 1 AND p.s = w.state
            GROUP BY w.conv_id, w.i, p.e),
        last AS (SELECT conv_id, count(*) AS n FROM f GROUP BY conv_id),
        won AS (
            SELECT w.conv_id, min(best) AS best FROM walk w JOIN last l ON l.conv_id IS NOT DISTINCT FROM w.conv_id AND w.i = l.n
            WHERE state IN (0, 3) GROUP BY w.conv_id),
        counts AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal
            FROM f GROUP BY conv_id)
        SELECT k.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
               coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
               coalesce(w.best.cost, 0)::BIGINT AS cost, coalesce(w.best.letters, '') AS audit, sha256(coalesce(w.best.new[2:], '')) AS repaired_sha256
        FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM k.conv_id
        LEFT JOIN won w ON w.conv_id IS NOT DISTINCT FROM k.conv_id"""


ORACLES["op11_dialogue_repair"] = _dialogue_sql()


def _license_sql() -> str:
    """The license scan over all pairs of a line and a template, without filters."""
    rules = licenses.LicenseRules()
    split = r"list_filter(regexp_split_to_array({}, '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"
    low = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    told = dict(rules.telling)
    bodies = ", ".join(
        "('{}', '{}', ' {} ')".format(label, body.lower().replace("'", "''"), told[label]) if label in told
        else "('{}', '{}', ' ')".format(label, body.lower().replace("'", "''")) for label, body in rules.templates)
    phrases = " UNION ALL ".join(
        f"SELECT doc_id, i, '{label}' AS label FROM places WHERE w[i + 1 : i + {len(p.split())}] = {p.split()}" for p, label in rules.phrases)
    return f"""
        WITH d AS (SELECT doc_id, {split.format(low)} AS w, string_split({low}, chr(10)) AS lines FROM documents),
        places AS (SELECT doc_id, w, unnest(range(len(w))) AS i FROM d),
        p AS ({phrases}),
        b AS (SELECT doc_id, count(*) AS n, min(i) AS lo, max(i) AS hi, list(DISTINCT label) AS own FROM p GROUP BY doc_id),
        l AS (
            SELECT doc_id, list_distinct(t) AS t, ' ' || array_to_string(t, ' ') || ' ' AS spaced
            FROM (SELECT doc_id, {split.format('line')} AS t FROM (SELECT doc_id, unnest(lines) AS line FROM d))),
        m AS (SELECT label, phrase, list_distinct({split.format('body')}) AS t FROM (VALUES {bodies}) v(label, body, phrase)),
        f AS (
            SELECT doc_id, list(DISTINCT label) AS more, max(len(list_intersect(m.t, l.t)) / len(m.t)) AS best
            FROM l, m WHERE len(list_intersect(m.t, l.t)) >= ceil(len(m.t) * {rules.containment} - 1e-9) AND contains(l.spaced, m.phrase) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_base, lo::BIGINT AS first_word, hi::BIGINT AS last_word,
               coalesce(array_to_string(list_sort(own), ','), '') AS base_labels,
               coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(own, []), coalesce(more, [])))), ','), '') AS labels,
               CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END::DOUBLE AS score
        FROM d LEFT JOIN b USING (doc_id) LEFT JOIN f USING (doc_id)"""


ORACLES["op7_license_scan"] = _license_sql()
