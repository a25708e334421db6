"""The registered queries of this folder, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txnwatch.llm import (
    bpe, conversations, crf, cuckoo, decontaminate, langid, mixing, pii, quality_rules, ranking, simhash, spelling, warc,
)

Query = Callable[[SparkSession, str], DataFrame]


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def _labels(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/labels.parquet")


def op1_personal_data(spark: SparkSession, sf: str) -> DataFrame:
    return pii.find(_documents(spark, sf))


def op2_simhash(spark: SparkSession, sf: str) -> DataFrame:
    return simhash.membership(_documents(spark, sf))


def op3_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    return warc.archived(pages).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "digest_ok"
    )


def vocabulary_path() -> str:
    """The public byte-level tokenizer file of the machine this runs on."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op4_bpe(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode_and_decode(_documents(spark, sf), vocabulary_path())


def op5_language(spark: SparkSession, sf: str) -> DataFrame:
    return langid.identify(_documents(spark, sf))


def op6_exact_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return cuckoo.membership(_documents(spark, sf))


def op7_quality_ranking(spark: SparkSession, sf: str) -> DataFrame:
    return ranking.score(_documents(spark, sf), _labels(spark, sf))


def op8_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    return crf.score(_documents(spark, sf), _labels(spark, sf))


def op9_quality_rules(spark: SparkSession, sf: str) -> DataFrame:
    rows = quality_rules.judge(_documents(spark, sf), keep=("doc_id",))
    return rows.select(
        "_row.doc_id", "_m.n_words", "_m.word_chars", "_m.n_symbols", "_m.n_dup_lines", "_m.n_repeat_words",
        F.col("_base_failed").alias("base_failed"), F.col("_kept").alias("kept"),
    )


def op10_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf)).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


def op11_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    found = decontaminate.find(_documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["stop"] - s["start"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"),
    )


def op12_repair(spark: SparkSession, sf: str) -> DataFrame:
    rows = conversations.damaged(spark.read.parquet(f"{sf}/conversations.parquet"))
    text = F.array_join(F.transform("repaired", lambda row: F.concat(row["role"], F.lit(":"), row["text"])), "\n")
    return conversations.repair(rows, F.col("there")).select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit",
        F.sha2(text, 256).alias("repaired_sha256"),
    )


def op13_spelling(spark: SparkSession, sf: str) -> DataFrame:
    return spelling.variants(_documents(spark, sf))


QUERIES: tuple[Query, ...] = (
    op1_personal_data, op2_simhash, op3_warc, op4_bpe, op5_language, op6_exact_dedup, op7_quality_ranking,
    op8_toxicity, op9_quality_rules, op10_mix_sources, op11_decontaminate, op12_repair, op13_spelling,
)


def registry() -> dict[str, Query]:
    return {run.__name__: run for run in QUERIES}


SQL: dict[str, str] = {
    "op3_warc": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS b FROM pages),
d AS (SELECT page_id, octet_length(b) AS payload_bytes, sha256(b) AS payload_digest FROM p),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first < page_id THEN first END AS refers_to, TRUE AS digest_ok
FROM f
""",
    "op6_exact_dedup": """
WITH d AS (SELECT doc_id, sha256(coalesce(text, '')) AS h FROM documents),
r AS (SELECT doc_id, h, max(doc_id) OVER (PARTITION BY h) AS keep_id, count(*) OVER (PARTITION BY h) AS group_size,
             row_number() OVER (PARTITION BY h ORDER BY doc_id DESC) AS place FROM d)
SELECT doc_id, keep_id, group_size, place = 1 AS kept, h AS text_sha256 FROM r
""",
    # the sketch's cells are integers, so SQL counts the same ones
    "op9_quality_rules": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
w AS (SELECT rid, unnest(range(1, len(words) - 1)) AS i, words FROM d WHERE len(words) >= 3),
g AS (SELECT rid, i, words[i:i + 2] AS three FROM w),
t AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, three) AS n FROM g),
r AS (SELECT rid, count(DISTINCT i + k) AS n FROM t, (VALUES (0), (1), (2)) s(k) WHERE n > 1 GROUP BY rid),
m AS MATERIALIZED (
  SELECT d.rid, doc_id, lang, source, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN r USING (rid)),
x AS (
  SELECT rid, lang, source, 'symbols' AS metric, coalesce(1000 * n_symbols // nullif(n_words, 0), 0)::BIGINT AS v FROM m
  UNION ALL SELECT rid, lang, source, 'dup_lines', coalesce(1000 * n_dup_lines // nullif(n_lines, 0), 0)::BIGINT FROM m
  UNION ALL SELECT rid, lang, source, 'repeats', coalesce(1000 * n_repeat_words // nullif(n_words, 0), 0)::BIGINT FROM m
  UNION ALL SELECT rid, lang, source, 'word_length', coalesce(1000 * word_chars // nullif(n_words, 0), 0)::BIGINT FROM m),
c AS (SELECT lang, source, metric, (v >> greatest(length(bin(v)) - 6, 0)) << greatest(length(bin(v)) - 6, 0) AS cell, count(*) AS n
      FROM x GROUP BY ALL),
l AS (SELECT 0 AS level, lang, source, metric, cell, n FROM c
      UNION ALL SELECT 1, lang, NULL, metric, cell, n FROM c UNION ALL SELECT 2, NULL, NULL, metric, cell, n FROM c),
s AS (SELECT level, lang, source, metric, cell, sum(n) AS n FROM l GROUP BY ALL),
u AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, metric ORDER BY cell) AS upto,
             sum(n) OVER (PARTITION BY level, lang, source, metric) AS total FROM s),
q AS (SELECT level, lang, source, metric, total, min(cell) FILTER (4 * upto >= total) AS low, min(cell) FILTER (4 * upto >= 3 * total) AS high
      FROM u GROUP BY ALL),
f AS (SELECT level, lang, source, metric, total, low, high, greatest(CASE metric WHEN 'word_length' THEN 6 ELSE 3 END * (high - low),
             CASE metric WHEN 'symbols' THEN 200 WHEN 'dup_lines' THEN 500 WHEN 'repeats' THEN 400 ELSE 1000 END) AS reach FROM q),
b AS (SELECT x.rid, x.metric, x.v, arg_min(high + reach, level) AS most,
             arg_min(CASE WHEN x.metric = 'word_length' THEN low - reach ELSE -1 END, level) AS least
      FROM x JOIN f ON x.metric = f.metric AND (f.total >= 100 OR f.level = 2)
        AND (f.level = 2 OR x.lang IS NOT DISTINCT FROM f.lang) AND (f.level > 0 OR x.source IS NOT DISTINCT FROM f.source)
      GROUP BY x.rid, x.metric, x.v),
j AS (SELECT rid, bool_and(v <= most AND v >= least) AS inside FROM b GROUP BY rid)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
       NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND inside AS kept
FROM m JOIN j USING (rid)
""",
    "op11_decontaminate": r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
i AS MATERIALIZED (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
s AS (SELECT item_id, words, least(10, len(words)) AS n, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS pos
      FROM i WHERE len(words) > 0),
w AS MATERIALIZED (SELECT DISTINCT item_id, n, array_to_string(words[pos:pos + n - 1], ' ') AS piece FROM s),
k AS (SELECT DISTINCT n FROM w),
p AS (SELECT rid, words, n, unnest(range(1, len(words) - n + 2)) AS pos FROM d, k WHERE len(words) >= n),
f AS MATERIALIZED (SELECT rid, pos, p.n, item_id FROM p JOIN w ON p.n = w.n AND array_to_string(words[pos:pos + p.n - 1], ' ') = piece),
c AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + n)) AS place FROM f) GROUP BY rid),
l AS (SELECT rid, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
      FROM (SELECT DISTINCT rid, item_id::VARCHAR AS id FROM f WHERE item_id IS NOT NULL) GROUP BY rid)
SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN c USING (rid) LEFT JOIN l USING (rid)
""",
    # CRC-32 by its table, a byte at a time; pairs meet by equal words less one letter
    "op13_spelling": r"""
WITH RECURSIVE z AS (
  SELECT b AS code, b::BIGINT AS v, 0 AS step FROM range(256) t(b)
  UNION ALL SELECT code, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, step + 1 FROM z WHERE step < 8),
y AS MATERIALIZED (SELECT list(v ORDER BY code) AS crc FROM z WHERE step = 8),
r AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{00C0}-\x{00FF}]+')) AS run FROM documents),
g AS MATERIALIZED (
  SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS n FROM r GROUP BY ALL),
x AS (SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes FROM g),
h AS (
  SELECT run, n, xor(list_reduce(list_transform(range(0, length(bytes) // 2),
           lambda i: (16 * (instr('0123456789ABCDEF', bytes[2 * i + 1]) - 1) + instr('0123456789ABCDEF', bytes[2 * i + 2]) - 1)::BIGINT),
         lambda a, b: xor(a >> 8, crc[(xor(a, b) & 255) + 1]), 4294967295::BIGINT), 4294967295) AS h
  FROM x, y),
q AS (SELECT CASE WHEN h % 97 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word, n FROM h),
w AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM q WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
v AS MATERIALIZED (SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(0, length(word))) AS i FROM w)),
e AS MATERIALIZED (
  SELECT a.word AS a, b.word AS b FROM v a JOIN v b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT a.word, b.word FROM v a JOIN w b ON a.rest = b.word
  UNION SELECT b.word, a.word FROM v a JOIN w b ON a.rest = b.word),
f AS (SELECT a, b, w.n, row_number() OVER (PARTITION BY a ORDER BY w.n DESC, b) AS place, count(*) OVER (PARTITION BY a) AS n_near
      FROM e JOIN w ON b = w.word),
j AS MATERIALIZED (
  SELECT word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN f.n >= 2 * w.n THEN b END AS form, CASE WHEN f.n >= 2 * w.n THEN f.n END AS form_n
  FROM w LEFT JOIN f ON a = word AND place = 1),
o AS (SELECT word, word AS root, form AS next FROM j
      UNION ALL SELECT o.word, j.word, j.form FROM o JOIN j ON o.next = j.word)
SELECT j.word, form, root, n, n_near, form_n FROM j JOIN o ON j.word = o.word AND next IS NULL
""",
}


def oracles() -> dict[str, str]:
    return dict(SQL)