"""The registered queries of the operators, with production parameters, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    audit, binary_ids, byte_bpe, common, ctw, decontaminate, line_dedup, packing, quality, resampling, simhash,
    substring_dedup, token_counts, warc)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(common.read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.dedup_lines(common.read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    text = F.coalesce("text", F.lit(""))
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2(text, 256).alias("kept_sha256"))


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.dedup_substrings(common.read_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op4_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    out = quality.judged(docs)
    return out.select("doc_id", *quality.COUNTS, "base_failed", "kept")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    return token_counts.count_lines(docs, tokenizer_path("byte_bpe_50k.json"))


def op6_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    return binary_ids.read_ids(binary_ids.write_ids(docs, tokenizer_path("word_bpe_49k.json")))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(common.read_table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = warc.read_archives(warc.archive(common.read_table(spark, sf_dir, "pages")))
    page = lambda c: F.regexp_extract(c, r"^urn:page:(-?\d+)$", 1).try_cast("long")
    return read.select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type",
                       F.when(F.col("refers_to").isNotNull(), page("refers_to")).alias("refers_to"))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.contamination(docs, common.read_table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_words", "n_hit", F.size("hit_items").cast("long").alias("n_items"),
                      F.sha2(F.array_join("hit_items", ","), 256).alias("items_sha256"),
                      (F.col("n_hit") > 0).alias("contaminated"))


def op10_ctw_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.read_table(spark, sf_dir, "documents")
    return ctw.score(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target).select("doc_id", "n_features", "weight", "score", "rank")


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(common.read_table(spark, sf_dir, "documents"), common.read_table(spark, sf_dir, "labels"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = byte_bpe.round_trip(common.read_table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_multi_50k.tiktoken"))
    return out.select("doc_id", "n_tokens", "ids_sha256", F.sha2("decoded", 256).alias("decoded_sha256"))


QUERIES = {f.__name__: f for f in (
    op1_curve_packing, op2_line_dedup, op3_substring_dedup, op4_host_rules, op5_token_counts, op6_packed_ids,
    op7_simhash, op8_warc, op9_decontaminate, op10_ctw_score, op11_resampling, op12_filter_audit, op13_byte_bpe)}

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k FROM lines),
held AS (SELECT k, min(doc_id) AS keeper FROM keyed WHERE length(k) >= 10 GROUP BY k
         HAVING count(DISTINCT doc_id) >= 2),
judged AS (SELECT keyed.*, held.keeper IS NOT NULL AND held.keeper <> doc_id AS gone FROM keyed LEFT JOIN held USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id""",
    "op3_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
wins AS (
  SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM words WHERE len(w) >= 35) s),
hashed AS (SELECT doc_id, i, md5_number(g) AS h FROM wins),
twice AS (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM hashed SEMI JOIN twice USING (h)),
lost AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
each AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM words),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t FROM each ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ps), 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM words LEFT JOIN lost USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op4_host_rules": r"""
WITH words AS (
  SELECT doc_id, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1),
         lambda x: w[x] || ' ' || w[x + 1] || ' ' || w[x + 2])) AS g
  FROM words WHERE len(w) >= 3),
repeated AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) >= 2),
covered AS (SELECT doc_id, count(DISTINCT i + o) AS n_repeat_words FROM repeated, (VALUES (0), (1), (2)) v(o) GROUP BY doc_id),
lines AS (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM words),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, count(*) AS n_lines FROM lines
        WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
base AS (
  SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(n_lines, 0) AS n_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words
  FROM words LEFT JOIN dup USING (doc_id) LEFT JOIN covered USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
rule AS (
  SELECT source, unnest([n_words < 50, 100 * n_repeat_words > 50 * n_words, 100 * n_symbols > 10 * n_words,
                         100 * n_dup_lines > 30 * n_lines, word_chars < 3 * n_words OR word_chars > 10 * n_words]) AS failed,
         unnest(range(5)) AS r FROM base),
per AS (SELECT source, r, count(*)::DOUBLE AS docs, count(*) FILTER (failed)::DOUBLE AS failures FROM rule GROUP BY source, r),
total AS (SELECT r, sum(docs) AS n, sum(failures) AS k, count(*) AS hosts, sum(docs * docs) AS n2,
                 sum(failures * failures / docs) AS k2 FROM per GROUP BY r),
moments AS (SELECT r, k / n AS m, (k2 - n * (k / n) * (k / n) - (hosts - 1) * (k / n) * (1 - k / n)) / nullif(n - n2 / n, 0) AS v
            FROM total),
prior AS (SELECT r, m, CASE WHEN v > 0 THEN least(greatest(m * (1 - m) / v - 1, 1.0), 1e6) ELSE 1e6 END AS strength FROM moments),
rates AS (SELECT source, r, m, (failures + m * strength) / (docs + strength) AS rate FROM per JOIN prior USING (r)),
hosts AS (SELECT source, bool_or(rate > greatest(least(greatest(3 * m, 0.25), 0.5), m * 1.25)) AS rejected FROM rates GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT rejected AS kept
FROM judged JOIN hosts ON judged.source IS NOT DISTINCT FROM hosts.source""",
    "op9_decontaminate": r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
iw AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
wins AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM iw WHERE len(w) > 0) s),
sizes AS (SELECT DISTINCT n FROM wins),
dwin AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, sizes WHERE len(w) >= n) s),
occ AS (SELECT DISTINCT doc_id, dwin.n, i, item_id FROM dwin JOIN wins USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM occ) s GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM occ) s GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op8_warc": r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha1(body) AS hex FROM p),
bits AS (
  SELECT page_id, payload_bytes, hex, max(page_id) OVER (PARTITION BY hex, payload_bytes) AS last,
         list_transform(range(0, 8), lambda c: ('0x' || substr(hex, 5 * c + 1, 5))::INTEGER) AS quints
  FROM (SELECT * FROM d) s)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(quints, lambda q:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (q >> 15) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (q >> 10) % 32 + 1, 1)
         || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (q >> 5) % 32 + 1, 1) || substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', q % 32 + 1, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM bits""",
    # a CRC is linear but for its start: each byte's part, moved to the end of the feature, is one row
    "op11_resampling": r"""
WITH RECURSIVE dw AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (
  SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
df AS (SELECT doc_id, unnest(w) AS f FROM dw UNION ALL
       SELECT doc_id, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM dw WHERE len(w) > 1),
bf AS (SELECT unnest(w) AS f FROM bw UNION ALL
       SELECT unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM bw WHERE len(w) > 1),
names AS MATERIALIZED (SELECT f, hex(encode(f)) AS h, octet_length(encode(f)) AS n
                       FROM (SELECT f FROM df UNION SELECT f FROM bf) s),
longest AS MATERIALIZED (SELECT coalesce(max(n), 0) AS most FROM names),
t AS MATERIALIZED (
  SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
  FROM range(256) r(b)),
moved AS (SELECT 0::BIGINT AS d, b, c FROM t UNION ALL
          SELECT d + 1, m.b, xor(m.c >> 8, t.c) FROM moved m JOIN t ON t.b = m.c & 255, longest WHERE d + 1 < most),
zeros AS (SELECT 0::BIGINT AS n, 4294967295::BIGINT AS c UNION ALL
          SELECT n + 1, xor(z.c >> 8, t.c) FROM zeros z JOIN t ON t.b = z.c & 255, longest WHERE n < most),
bytes AS (SELECT f, n, n - 1 - i AS d, ('0x' || substr(h, 2 * i + 1, 2))::BIGINT AS b
          FROM (SELECT f, h, n, unnest(range(n)) AS i FROM names) s),
linear AS (SELECT f, any_value(n) AS n, bit_xor(c) AS c FROM bytes JOIN moved USING (d, b) GROUP BY f),
bucketed AS MATERIALIZED (
  SELECT f, xor(xor(linear.c, zeros.c), 4294967295) % 10000 AS bucket FROM linear JOIN zeros USING (n)),
db AS MATERIALIZED (SELECT doc_id, bucket FROM df JOIN bucketed USING (f)),
bb AS MATERIALIZED (SELECT bucket FROM bf JOIN bucketed USING (f)),
gains AS (
  SELECT r.bucket, floor(1000 * ln((coalesce(b.k, 0) + 1)::DOUBLE * ((SELECT count(*) FROM db) + 10000)
                / ((coalesce(d.k, 0) + 1)::DOUBLE * ((SELECT count(*) FROM bb) + 10000))))::BIGINT AS gain
  FROM range(10000) r(bucket) LEFT JOIN (SELECT bucket, count(*) AS k FROM db GROUP BY bucket) d USING (bucket)
  LEFT JOIN (SELECT bucket, count(*) AS k FROM bb GROUP BY bucket) b USING (bucket)),
summed AS (SELECT doc_id, floor(sum(gain) / count(*))::BIGINT AS weight FROM db JOIN gains USING (bucket) GROUP BY doc_id),
scored AS (
  SELECT doc_id, len(w) AS n_words, (len(w) + greatest(len(w) - 1, 0))::BIGINT AS n_features, coalesce(weight, 0) AS weight,
         coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id::VARCHAR), 1, 8))::BIGINT + 0.5)::DOUBLE
                                                    / 4294967296)))::BIGINT AS score
  FROM dw LEFT JOIN summed USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS pos, count(*) OVER () AS n FROM scored WHERE n_words >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN pos <= n * 25 // 100 THEN pos END AS rank
FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op12_filter_audit": r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
f AS (
  SELECT doc_id, part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
         + 4 * (100 * len(regexp_extract_all(t, '[A-Z]')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
         + 16 * (doc_id > min(doc_id) OVER (PARTITION BY t))::INT AS mask FROM d),
l AS (SELECT doc_id, bool_or(quality = 1) AS good, bool_or(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
      FROM f LEFT JOIN l USING (doc_id) GROUP BY part, mask),
x(l, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
p AS (SELECT x1.l || x2.l || x3.l || x4.l || x5.l AS filter_order, [x1.b, x2.b, x3.b, x4.b, x5.b] AS bits
      FROM x x1, x x2, x x3, x x4, x x5 WHERE len(list_distinct([x1.l, x2.l, x3.l, x4.l, x5.l])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before
      FROM (SELECT *, unnest([1, 2, 3, 4, 5]) AS step FROM p) q),
r AS (
  SELECT part, filter_order, step, bit,
         coalesce(sum(n) FILTER (mask & (before | bit) = 0), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (mask & bit <> 0 AND mask & before <> 0), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (mask = bit), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (mask & bit <> 0 AND mask & before = 0), 0)::BIGINT AS toxic_lost
  FROM c, s GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM r""",
}
