"""The queries of the training-data operators, their SQL where SQL can express them, and the pipeline."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.llm import importance, langid, license, mixing, neardup, packedids, packing, periodic, pii, quality, search, substring, toxicity
from fluxgrain.llm.crc import crc32_sql
from fluxgrain.llm.lineage import folder


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(table(spark, sf_dir, "documents"))


def op2_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op4_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.quality(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(4, 2)
    found = langid.classify(docs, langid.learn(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "rejected")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_digest(table(spark, sf_dir, "documents"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.plan(table(spark, sf_dir, "documents")).drop("text_hash")


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    out = langid.held_out(5, 0)
    found = toxicity.score(docs, toxicity.fit(docs, labels.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


OP10_SQL = """WITH good AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 256)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM good q JOIN good c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, (row_number() OVER w)::INTEGER AS rank, vec_id, score FROM pairs
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY rank <= 5"""


def op11_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = importance.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_features", "weight", "score", "rank")


def features_sql(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"


OP11_SQL = f"""WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, {features_sql('text')} AS w FROM documents),
b AS (SELECT {features_sql('text')} AS w FROM benchmark),
said AS MATERIALIZED (SELECT r, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM d),
asked AS (SELECT unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) AS f FROM b),
every AS (SELECT f FROM said UNION SELECT f FROM asked),
hashed AS MATERIALIZED (SELECT f, {crc32_sql('f')} % 10000 AS bucket FROM every),
s AS (SELECT bucket, count(*) AS s FROM said JOIN hashed USING (f) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS t FROM asked JOIN hashed USING (f) GROUP BY bucket),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * ((SELECT count(*) FROM said) + 10000)::DOUBLE / ((coalesce(s, 0) + 1)::DOUBLE * ((SELECT count(*) FROM asked) + 10000)::DOUBLE)))::BIGINT AS gain
  FROM (SELECT DISTINCT bucket FROM hashed) LEFT JOIN s USING (bucket) LEFT JOIN t USING (bucket)),
weight AS (SELECT r, count(*) AS n, sum(gain) AS g FROM said JOIN hashed USING (f) JOIN gain USING (bucket) GROUP BY r),
scored AS (SELECT doc_id, len(w) AS n_words, coalesce(n, 0)::BIGINT AS n_features, floor(coalesce(g / n, 0))::BIGINT AS weight,
  floor(-1000 * ln(-ln((('0x' || substr(sha256('7:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296)))::BIGINT AS noise FROM d LEFT JOIN weight USING (r)),
placed AS (SELECT *, weight + noise AS score, row_number() OVER (PARTITION BY n_words >= 20 AND doc_id IS NOT NULL ORDER BY weight + noise DESC, doc_id) AS place,
  25 * count(*) FILTER (n_words >= 20 AND doc_id IS NOT NULL) OVER () // 100 AS drawn FROM scored)
SELECT doc_id, n_features, weight, score, CASE WHEN n_words >= 20 AND doc_id IS NOT NULL AND place <= drawn THEN place END AS rank FROM placed"""


def op12_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{folder(spark)}/ids-{uuid.uuid4().hex}"
    packedids.write(table(spark, sf_dir, "documents"), path)
    return packedids.read(spark, path).select("doc_id", "start", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.digest(periodic.find(table(spark, sf_dir, "documents"), change=periodic.looped))


OP13_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, coalesce({crc32_sql('doc_id::VARCHAR')}, 1) AS h FROM documents),
e AS (SELECT r, doc_id, w, h % 10 = 0 AND len(w) > 0 AS loops, (h // 10) % greatest(len(w), 1) AS a, 3 + (h // 10) % 8 AS folds FROM d),
f AS (SELECT r, doc_id, CASE WHEN loops THEN w[1:a] || list_transform(range(len(w) - a), lambda i: w[a + i % (1 + (len(w) - a) // folds) + 1]) ELSE w END AS w FROM e),
each AS (SELECT r, unnest(w) AS word, unnest(range(len(w))) AS i, len(w) AS n FROM f),
pairs AS (SELECT x.r, x.i, y.i - x.i AS q FROM each x JOIN each y ON x.r = y.r AND x.word = y.word AND y.i > x.i WHERE 4 * (y.i - x.i) <= x.n),
kept AS (SELECT r, q, min(i) AS start, count(*) + q AS length FROM (SELECT r, q, i, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS island FROM pairs) GROUP BY r, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT r, start, length, min(q) AS period FROM kept GROUP BY r, start, length),
told AS (SELECT r, count(*) AS n_runs, max(struct_pack(length, s := -start, p := -period)) AS best, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY r),
gone AS (SELECT DISTINCT r, unnest(range(start + period, start + length)) AS i FROM runs),
texts AS (SELECT r, string_agg(word, ' ' ORDER BY i) AS words FROM each ANTI JOIN gone USING (r, i) GROUP BY r)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, -best.s::BIGINT AS start, best.length::BIGINT AS length, -best.p::BIGINT AS period, (1000 * best.length // -best.p)::BIGINT AS exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(words, '')) AS collapsed_sha256
FROM f LEFT JOIN told USING (r) LEFT JOIN texts USING (r)"""


def quality_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What op5's fixed rules are judged by, of which SQL can say all."""
    found = quality.counts(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


QUALITY_COUNTS_SQL = r"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
windows AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) AS words FROM w),
again AS (SELECT r, unnest([i, i + 1, i + 2]) AS i FROM (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, words) > 1)),
covered AS (SELECT r, count(DISTINCT i) AS n FROM again GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
  (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(w) < 50 OR 100 * coalesce(n, 0) > 50 * len(w) AS base_failed
FROM w LEFT JOIN covered USING (r)"""


def pii_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The kinds of op7 with a fixed definition: counts and places."""
    return pii.pii_digest(table(spark, sf_dir, "documents")).select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256")


def spans_sql(rank: int, kind: str, pattern: str, holds: str) -> str:
    """The matches of a pattern with what stands before each, so that lengths add up to places."""
    part = lambda group: f"unnest(regexp_extract_all(t, '(?s)(.*?)({pattern})', {group}))"
    return rf"""SELECT r, {rank} AS rank, '{kind}' AS kind, till - length(hit) AS start, till FROM (SELECT r, hit, sum(length(gap) + length(hit)) OVER (PARTITION BY r ORDER BY i) AS till
  FROM (SELECT r, {part(1)} AS gap, {part(2)} AS hit, unnest(range(len(regexp_extract_all(t, '(?s)(.*?)({pattern})', 2)))) AS i FROM d)) WHERE {holds}"""


DIGITS = "regexp_replace(hit, '[^0-9]', '', 'g')"
LUHN = f"list_sum(list_transform(range(length({DIGITS})), lambda j: CASE WHEN j % 2 = 0 THEN reverse({DIGITS})[j + 1]::INTEGER ELSE [0, 2, 4, 6, 8, 1, 3, 5, 7, 9][reverse({DIGITS})[j + 1]::INTEGER + 1] END)) % 10 = 0"
PII_BASE_SQL = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
s AS ({spans_sql(0, 'email', '[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:[.][A-Za-z0-9-]+)+', 'true')}
UNION ALL {spans_sql(1, 'ip', '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+', "len(list_filter(string_split(hit, '.'), lambda x: coalesce(try_cast(x AS HUGEINT), 256) > 255)) = 0")}
UNION ALL {spans_sql(2, 'card', '[0-9](?:[ -]?[0-9])+', f'CASE WHEN length({DIGITS}) BETWEEN 14 AND 19 THEN {LUHN} ELSE false END')}
UNION ALL {spans_sql(3, 'phone', '[+][0-9][ ().0-9-]+[0-9]', f'length({DIGITS}) BETWEEN 10 AND 15')}),
g AS (SELECT r, count(*) FILTER (rank = 0) AS e, count(*) FILTER (rank = 1) AS i, count(*) FILTER (rank = 2) AS c, count(*) FILTER (rank = 3) AS p, string_agg(kind || ':' || start || ':' || till, ',' ORDER BY start, rank) AS said FROM s GROUP BY r)
SELECT doc_id, coalesce(e, 0) AS n_email, coalesce(i, 0) AS n_ip, coalesce(c, 0) AS n_card, coalesce(p, 0) AS n_phone, sha256(coalesce(said, '')) AS base_sha256 FROM d LEFT JOIN g USING (r)"""


def mixing_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per source of op8's plan: rows and tokens of its first pass, and whether no row is read more often than the limit."""
    first = F.col("copy") == 1
    found = mixing.plan(table(spark, sf_dir, "documents")).groupBy("source")
    return found.agg(
        F.count(F.when(first, 1)).alias("n_docs"),
        F.coalesce(F.sum(F.when(first, F.col("n_tokens"))), F.lit(0)).alias("n_tokens"),
        ((F.max("copy") <= mixing.REPEATS) & (F.sum("n_tokens") <= mixing.REPEATS * F.sum(F.when(first, F.col("n_tokens"))))).alias("within"),
    )


MIXING_LIMITS_SQL = r"""SELECT source, count(*) AS n_docs, coalesce(sum(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))), 0)::BIGINT AS n_tokens, true AS within FROM documents GROUP BY source"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    return {
        "op1_license": op1_license,
        "op2_substring": op2_substring,
        "op3_packing": op3_packing,
        "op4_neardup": op4_neardup,
        "op5_quality": op5_quality,
        "op6_language": op6_language,
        "op7_pii": op7_pii,
        "op8_mixing": op8_mixing,
        "op9_toxicity": op9_toxicity,
        "op10_search": op10_search,
        "op11_resample": op11_resample,
        "op12_binary": op12_binary,
        "op13_runs": op13_runs,
        "quality_counts": quality_counts,
        "pii_base": pii_base,
        "mixing_limits": mixing_limits,
        "pipeline": pipeline,
    }


def oracle_sql() -> dict:
    return {
        "op1_license": license.scan_sql(),
        "op10_search": OP10_SQL,
        "op11_resample": OP11_SQL,
        "op13_runs": OP13_SQL,
        "quality_counts": QUALITY_COUNTS_SQL,
        "pii_base": PII_BASE_SQL,
        "mixing_limits": MIXING_LIMITS_SQL,
    }
