"""The registered queries: each applies its operator to whole tables and derives the result's columns."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopsight.llm import (
    bpe,
    impact_index,
    langid,
    licenses,
    mixing,
    neardup,
    permutation_index,
    prefix_trie,
    runs,
    substring,
    tokenfiles,
    toxicity,
    warc,
)
from shopsight.llm.registry import query
from shopsight.llm.tables import read

_MIX_SQL = r"""
WITH sized AS (
    SELECT doc_id, source, md5('mix|' || doc_id) AS ord,
           coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
    FROM documents
), sizes AS (
    SELECT source, sum(size)::BIGINT AS source_size,
           (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight
    FROM sized GROUP BY source
), fills AS (
    SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / weight AS fill FROM sizes
), levels AS (
    SELECT a.*, (
        SELECT (sum(b.source_size) - sum(CASE WHEN b.fill < a.fill THEN b.cap ELSE 0 END))::DOUBLE
               / sum(CASE WHEN b.fill >= a.fill THEN b.weight ELSE 0 END)::DOUBLE FROM fills b
    ) AS water
    FROM fills a
), targets AS (
    SELECT source, source_size,
           least(cap::DOUBLE, (SELECT max(water) FROM levels WHERE water <= fill) * weight) AS target
    FROM levels
), placed AS (
    SELECT s.doc_id, s.size, t.source_size, t.target,
           CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
           coalesce(sum(s.size) OVER (PARTITION BY s.source ORDER BY s.ord, s.doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
    FROM sized s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, round(target - epochs * source_size)::BIGINT - ahead)))::BIGINT AS taken
FROM placed
"""


@query("op4_mix_sources", _MIX_SQL)
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(read(spark, sf_dir, "documents"), max_epochs=3)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def bpe_digests(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): ids of whole texts and the bytes they decode to."""
    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    coded = bpe.round_trip(docs.select("doc_id", "text"), path)
    joined = F.concat_ws(" ", F.col("ids").cast("array<string>"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(joined, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op2_byte_bpe")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digests(read(spark, sf_dir, "documents"))


@query("op3_token_files")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    index = tokenfiles.write_token_files(read(spark, sf_dir, "documents"), path, end_id=2, added_tokens=True)
    return tokenfiles.read_token_files(index).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


_PRODUCT_SQL = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS a, len(embedding) AS dim
    FROM embeddings
    WHERE vec_id IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           list_sum(list_transform(range(1, q.dim + 1), lambda i: q.a[i] * c.a[i]))::BIGINT AS score
    FROM v q JOIN v c ON q.dim = c.dim AND q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""


@query("op1_impact_topk", _PRODUCT_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return impact_index.search(impact_index.build_index(vectors), vectors.filter(F.col("vec_id") % 50 == 0), k=5)


@query("op6_permutation_knn")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    index, pivots = permutation_index.build_index(vectors)
    return permutation_index.search(index, pivots, vectors.filter(F.col("vec_id") % 20 == 0), k=20)


_REPEATS_SQL = r"""
WITH w AS (
    SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws FROM documents
), win AS (
    SELECT doc_id, i, ws[i:i + 12] AS g FROM w, unnest(range(1, len(ws) - 11)) AS t(i)
), earliest AS (
    SELECT g, min(doc_id) AS m FROM win GROUP BY g
), gone AS (
    SELECT DISTINCT doc_id, i + o AS p FROM win JOIN earliest USING (g), range(13) AS r(o) WHERE m < doc_id
), placed AS (
    SELECT doc_id, p, ws[p] AS word FROM w, unnest(range(1, len(ws) + 1)) AS t(p)
), kept AS (
    SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS words
    FROM placed ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed,
       sha256(coalesce(words, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)
"""


@query("op7_substring_dedup", _REPEATS_SQL)
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    kept = substring.remove_repeats(docs, width=13, join_words=True)
    digest = F.sha2(F.coalesce(F.col("text"), F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_words", "n_removed", digest.alias("kept_sha256"))


@query("op8_setsketch_neardup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(read(spark, sf_dir, "documents"), width=2, similarity=(80, 100))


def _fold(parts: int) -> Column:
    """crc32 of doc_id as text modulo ``parts``; null for a null doc_id."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


@query("op9_toxicity_mil")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(_fold(5) != 0)
    weights = toxicity.train(toxicity.training_sample(docs, labels))
    return toxicity.score(docs, weights).select(
        "doc_id",
        F.coalesce(_fold(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query("op10_language_id")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    net = langid.fit(langid.training_sample(docs.filter(_fold(3) != 1)))
    return langid.identify(docs.select("doc_id", "text"), net).select(
        "doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score"
    )


_WARC_SQL = """
WITH p AS (
    SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages
), r AS (
    SELECT *, max(page_id) OVER (PARTITION BY sha) AS stored FROM p
)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes,
       -- four base32 digits are five hexadecimal ones
       array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(sha, (5 * (i // 4) + 1)::INT, 5))::INT >> (15 - 5 * (i % 4))::INT) & 31) + 1, 1)), '')
           AS payload_digest,
       CASE WHEN page_id = stored THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> stored THEN stored END AS refers_to
FROM r
"""


@query("op5_warc_archives", _WARC_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = warc.write(read(spark, sf_dir, "pages"), revisit_from=0)
    return warc.read(index).select(
        "page_id", "payload_bytes", F.col("digest").alias("payload_digest"), "record_type", "refers_to"
    )


def _license_sql() -> str:
    """Every place of every template by joining all words with all template words."""
    templates = licenses.PHRASES + licenses.NOTICES
    rows = ",\n        ".join(
        f"({n}, '{t.label}', {t.exact}, {i}, '{w}', {i in t.required_places})"
        for n, t in enumerate(templates)
        for i, w in enumerate(t.words)
    )
    return rf"""
WITH w AS MATERIALIZED (
    SELECT row_number() OVER () AS id, doc_id,
           coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS ws
    FROM documents
), t(template, label, exact, pos, word, required) AS (VALUES
        {rows}
), placed AS (
    SELECT id, i - 1 AS p, ws[i] AS word FROM w, unnest(range(1, len(ws) + 1)) AS u(i)
    WHERE ws[i] IN (SELECT word FROM t)
), seen AS (
    SELECT word, count(DISTINCT id) AS n FROM placed GROUP BY word
), weighed AS (
    SELECT t.*, ln(1 + (SELECT count(*) FROM documents) / (coalesce(n, 0) + 0.5)) AS idf FROM t LEFT JOIN seen USING (word)
), needs AS (
    SELECT template, sum(required::INT) AS needed, min(CASE WHEN required THEN pos END) AS first, sum(idf) AS total
    FROM weighed GROUP BY template
), places AS (
    SELECT id, template, label, exact, p - pos AS start, sum(required::INT) AS found, sum(idf) AS weight
    FROM placed JOIN weighed USING (word) GROUP BY ALL
), matches AS (
    SELECT id, label, exact, start + first AS first_word,
           CASE WHEN exact THEN 1.0 ELSE round(weight / total, 6) END AS share
    FROM places JOIN needs USING (template)
    WHERE found = needed AND (exact OR round(weight / total, 6) >= {licenses.MIN_SHARE})
), digests AS (
    SELECT id, count(*) FILTER (exact) AS n_base, min(first_word) FILTER (exact) AS first_word,
           max(first_word) FILTER (exact) AS last_word,
           string_agg(DISTINCT label, ',' ORDER BY label) FILTER (exact) AS base_labels,
           string_agg(DISTINCT label, ',' ORDER BY label) AS labels, max(share) AS score
    FROM matches GROUP BY id
)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_base, 0)::BIGINT AS n_base, first_word::BIGINT AS first_word,
       last_word::BIGINT AS last_word, coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0)::DOUBLE AS score
FROM w LEFT JOIN digests USING (id)
"""


@query("op11_license_scan", _license_sql())
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.summary(licenses.scan(read(spark, sf_dir, "documents")))


#: crc32 of the decimal doc_id or conv_id in SQL, bit by bit.
_CRC_SQL = """xor(4294967295, list_reduce(
    [4294967295::BIGINT] || list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT),
    lambda crc, byte: list_reduce([xor(crc, byte), 0, 0, 0, 0, 0, 0, 0, 0],
                                  lambda x, bit: xor(x >> 1, 3988292384 * (x & 1)))))"""

_RUNS_SQL = rf"""
WITH plain AS MATERIALIZED (
    SELECT row_number() OVER () AS id, doc_id, {_CRC_SQL.format("doc_id")} AS h,
           coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS ws
    FROM documents
), shape AS (
    SELECT *, len(ws) AS n, (h // 10) % len(ws) AS a,
           1 + (len(ws) - (h // 10) % len(ws)) // (3 + (h // 10) % 8) AS p
    FROM plain
), w AS MATERIALIZED (
    SELECT id, doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN
           list_transform(range(n), lambda i: ws[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE ws END AS ws
    FROM shape
), grams AS (
    -- a run repeats at least five words at its distance
    SELECT id, i, ws[i:i + 4] AS g FROM w, unnest(range(1, len(ws) - 3)) AS t(i)
), again AS (
    SELECT a.id, a.i, a.i - b.i AS lag FROM grams a JOIN grams b ON a.id = b.id AND a.g = b.g AND b.i < a.i
), islands AS (
    SELECT *, i - row_number() OVER (PARTITION BY id, lag ORDER BY i) AS island FROM again
), stretches AS (
    SELECT id, lag, min(i) - lag - 1 AS start, max(i) + 5 - min(i) + lag AS length FROM islands GROUP BY id, lag, island
), runs AS (
    SELECT id, start, length, min(lag) AS period FROM stretches WHERE length >= greatest(6, 4 * lag) GROUP BY ALL
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY id ORDER BY length::DOUBLE / period DESC, start, period) AS rank FROM runs
), listed AS (
    SELECT id, count(*) AS n_runs, min(start) FILTER (rank = 1) AS start, min(length) FILTER (rank = 1) AS length,
           min(period) FILTER (rank = 1) AS period,
           string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
    FROM ranked GROUP BY id
), gone AS (
    SELECT DISTINCT id, i FROM runs, unnest(range(start + period, start + length)) AS t(i)
), words AS (
    SELECT id, i, ws[i + 1] AS word FROM w, unnest(range(len(ws))) AS t(i)
), kept AS (
    SELECT id, string_agg(word, ' ' ORDER BY i) AS words FROM words ANTI JOIN gone USING (id, i) GROUP BY id
)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length,
       period::BIGINT AS period, (1000 * length // period)::BIGINT AS exponent_milli,
       sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM w LEFT JOIN listed USING (id) LEFT JOIN kept USING (id)
"""


@query("op13_periodic_runs", _RUNS_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = runs.repeat_tails(read(spark, sf_dir, "documents"))
    best, all_runs = F.col("best"), F.col("runs")
    lines = F.transform(all_runs, lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = runs.periodic_runs(docs).select("*", runs.greatest(all_runs).alias("best"))
    return found.select(
        "doc_id",
        F.size(all_runs).cast("long").alias("n_runs"),
        best["start"].alias("start"),
        best["length"].alias("length"),
        best["period"].alias("period"),
        F.floor(1000 * best["length"] / best["period"]).cast("long").alias("exponent_milli"),
        F.sha2(F.concat_ws("", lines), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_TRIE_SQL = rf"""
WITH turns AS (
    SELECT conv_id, struct_pack(role := coalesce(role, ''), text := coalesce(text, '')) AS said,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS MATERIALIZED (
    SELECT conv_id, list(said ORDER BY pos) AS said, {_CRC_SQL.format("conv_id")} % 4 AS h FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.said[1:c.h], []), c.said[c.h + 1:]) AS said
    FROM convs c LEFT JOIN convs b ON b.conv_id = c.conv_id - c.conv_id % 20
), members AS (
    SELECT conv_id, d AS depth, said[1:d] AS path, len(said) = d AS ends
    FROM rebuilt, unnest(range(len(said) + 1)) AS t(d)
), nodes AS MATERIALIZED (
    SELECT path, depth, path[1:depth - 1] AS parent, min(conv_id) AS conv_id, count(*) AS n_convs,
           string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends) AS ends,
           (count(*) - 1) * CASE WHEN depth = 0 THEN 0 ELSE
               len(regexp_extract_all(path[depth].text, '[^\x20\x09-\x0D]+')) END AS saved
    FROM members GROUP BY path, depth
), children AS (
    SELECT parent AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
), sums AS (
    SELECT n.path[1:d] AS path, sum(saved) AS saved_tokens, count(*) FILTER (n_children IS NULL) AS n_leaves
    FROM nodes n LEFT JOIN children USING (path), unnest(range(depth + 1)) AS t(d) GROUP BY 1
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
       coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves,
       saved_tokens::BIGINT AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n LEFT JOIN children c ON c.path = n.path LEFT JOIN sums s ON s.path = n.path
     LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.parent
"""


@query("op12_prefix_trie", _TRIE_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(read(spark, sf_dir, "conversations"))
    return prefix_trie.build(*prefix_trie.share_openings(turns, group=20, most=4)).drop("id", "parent")
