"""Queries on dead letters after they were opened, statuses, names of the contract, previews per item and windows of a limited length."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fluxgrain.functions import formula
from fluxgrain.operators import letters, maintenance, metrics
from fluxgrain.plans import tables
from fluxgrain.plans.register import registry
from fluxgrain.sources.telemetry import from_events, from_events_sql

QUERIES, ORACLES, query = registry()
T = from_events_sql()
at = tables.at
NOW = "2024-01-20 00:00:00"
STATES = ("OPEN", "REPROCESSING", "RESOLVED", "DISCARDED")

ITEMS = f"""(SELECT raw_message_id AS id, organization_id, raw_message_id + 1 AS raw_message_id, 'DECODE' AS stage, 'ING_DECODE_FAILED' AS code, ['OPEN', 'REPROCESSING', 'RESOLVED', 'DISCARDED'][raw_message_id % 4 + 1] AS status,
  1 + raw_message_id % 3 AS attempts, CASE WHEN raw_message_id % 4 = 1 THEN 7 END AS locked_by, CASE WHEN raw_message_id % 4 = 1 THEN received_at + INTERVAL 5 DAY END AS locked_until, received_at AS created_at,
  NULL::TIMESTAMP AS resolved_at, NULL::VARCHAR AS discard_reason FROM {T})"""


def dlq_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, i = from_events(spark, sf_dir), F.col("raw_message_id")
    busy = i % 4 == 1
    return p.select(
        i.alias("id"), "organization_id", (i + 1).alias("raw_message_id"), F.lit("DECODE").alias("stage"), F.lit("ING_DECODE_FAILED").alias("code"),
        F.element_at(F.array(*map(F.lit, STATES)), (i % 4 + 1).cast("int")).alias("status"), (1 + i % 3).alias("attempts"),
        F.when(busy, F.lit(7).cast("bigint")).alias("locked_by"), F.when(busy, F.col("received_at") + F.expr("interval 5 days")).alias("locked_until"),
        F.col("received_at").alias("created_at"), F.lit(None).cast("timestamp").alias("resolved_at"), F.lit(None).cast("string").alias("discard_reason"),
    )


@query(
    "dlq_lifecycle",
    f"""WITH i AS (SELECT *, raw_message_id % 3 = 0 AND (status = 'OPEN' OR (status = 'REPROCESSING' AND locked_until < TIMESTAMP '{NOW}')) AS lock, id % 5 = 0 AS done, id % 7 = 0 AS failed, id % 11 = 0 AS dropped, status IN ('OPEN', 'REPROCESSING') AS live FROM {ITEMS} WHERE created_at >= TIMESTAMP '{NOW}' - INTERVAL 14 DAY)
SELECT id, organization_id, raw_message_id, stage, CASE WHEN live AND failed AND NOT done THEN 'AGAIN' ELSE code END AS code,
  CASE WHEN live AND done THEN 'RESOLVED' WHEN live AND dropped THEN 'DISCARDED' WHEN live AND failed THEN 'OPEN' WHEN lock THEN 'REPROCESSING' ELSE status END AS status,
  attempts + CASE WHEN live AND failed AND NOT done THEN 1 ELSE 0 END AS attempts,
  CASE WHEN live AND (done OR failed OR dropped) THEN NULL WHEN lock THEN 9 ELSE locked_by END AS locked_by, CASE WHEN live AND (done OR failed OR dropped) THEN NULL WHEN lock THEN TIMESTAMP '2024-01-20 00:05:00' ELSE locked_until END AS locked_until,
  created_at, CASE WHEN live AND (done OR dropped) THEN TIMESTAMP '{NOW}' END AS resolved_at, CASE WHEN live AND dropped AND NOT done THEN 'old firmware' END AS discard_reason FROM i""",
)
def dlq_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items locked, then some resolved, some failed again and some discarded; those older than 14 days are gone."""
    items, now = dlq_items(spark, sf_dir), at(NOW)
    wanted = lambda c: items.where(c).select("organization_id", "id")
    out = letters.locked(items, wanted("raw_message_id % 3 = 0"), F.lit(9), now)
    out = letters.resolved(out, items.where("id % 5 = 0"), now)
    out = letters.reopened(out, wanted("id % 7 = 0").withColumn("code", F.lit("AGAIN")))
    return letters.unexpired(letters.discarded(out, wanted("id % 11 = 0"), F.lit("old firmware"), now), now)


@query(
    "dlq_answers",
    f"""WITH i AS (SELECT * FROM {ITEMS}), raw AS (SELECT raw_message_id AS id, organization_id, ['OK', 'DECODE_ERROR', 'DUPLICATE', 'STORE_ERROR'][device_id % 4 + 1] AS state FROM {T}),
q AS (SELECT organization_id, 'DLQ' AS kind, CASE WHEN raw_message_id % 13 = 0 THEN -raw_message_id ELSE raw_message_id END AS id FROM {T} UNION ALL SELECT organization_id, 'RAW', CASE WHEN raw_message_id % 17 = 0 THEN -raw_message_id ELSE raw_message_id END FROM {T}),
j AS (SELECT q.*, i.id AS found, i.status, i.locked_until, CASE kind WHEN 'DLQ' THEN i.raw_message_id ELSE q.id END AS raw_id FROM q LEFT JOIN i ON kind = 'DLQ' AND i.id = q.id AND i.organization_id = q.organization_id)
SELECT j.organization_id, kind, j.id, raw_id AS raw_message_id, CASE WHEN kind = 'DLQ' AND found IS NULL THEN 'RESOURCE_NOT_FOUND' WHEN status = 'REPROCESSING' AND locked_until >= TIMESTAMP '{NOW}' THEN 'ING_DLQ_ITEM_LOCKED' WHEN status IN ('RESOLVED', 'DISCARDED') THEN 'DLQ_' || status
  WHEN state IS NULL THEN 'ING_RAW_MESSAGE_NOT_FOUND' WHEN kind = 'RAW' AND state IN ('OK', 'DUPLICATE') THEN 'ING_REPROCESS_SAME_RESULT' END AS skipped
FROM j LEFT JOIN raw ON raw.id = raw_id AND raw.organization_id = j.organization_id""",
)
def dlq_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    p, i = from_events(spark, sf_dir), F.col("raw_message_id")
    asked = lambda kind, step: p.select("organization_id", F.lit(kind).alias("kind"), F.when(i % step == 0, -i).otherwise(i).alias("id"))
    state = F.element_at(F.array(*map(F.lit, ("OK", "DECODE_ERROR", "DUPLICATE", "STORE_ERROR"))), (F.col("device_id") % 4 + 1).cast("int"))
    raw = p.select("organization_id", i.alias("id"), state.alias("status"))
    return letters.answers(asked("DLQ", 13).unionByName(asked("RAW", 17)), dlq_items(spark, sf_dir), raw, at(NOW))


@query(
    "status_transitions",
    f"""WITH s AS (SELECT raw_message_id AS id, ['RECEIVED', 'OK', 'DUPLICATE', 'DECODE_ERROR', 'SCRIPT_ERROR', 'STORE_ERROR', 'PUBLISH_ERROR', 'UNKNOWN_DEVICE_REJECTED', 'INVALID'] AS n FROM {T}),
x AS (SELECT id, n[id % 9 + 1] AS a, n[id // 9 % 9 + 1] AS b FROM s)
SELECT id, a = 'RECEIVED' AND b <> 'RECEIVED' AS first_time, (a LIKE '%ERROR' OR a LIKE 'UNKNOWN%') AND b <> 'RECEIVED' AS again FROM x""",
)
def status_transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    i, names = F.col("raw_message_id"), F.array(*map(F.lit, metrics.STATUSES))
    a, b = F.get(names, (i % 9).cast("int")), F.get(names, (F.floor(i / 9) % 9).cast("int"))
    return from_events(spark, sf_dir).select(i.alias("id"), metrics.may_become(a, b).alias("first_time"), metrics.may_become(a, b, again=True).alias("again"))


@query(
    "contract_names",
    f"""SELECT raw_message_id AS id, CASE raw_message_id % 4 WHEN 0 THEN 'JSON' WHEN 1 THEN 'SPARKPLUG_B' END AS format, CASE raw_message_id % 3 WHEN 0 THEN 'VERIFIED' END AS signature FROM {T}""",
)
def contract_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    i = F.col("raw_message_id")
    shape = F.when(i % 4 == 0, "JSON").when(i % 4 == 1, "SPARKPLUG_B").when(i % 4 == 2, "json")
    sign = F.when(i % 3 == 0, "VERIFIED").when(i % 3 == 1, "FORGED")
    return from_events(spark, sf_dir).select(i.alias("id"), metrics.known_name(shape, metrics.PAYLOAD_FORMATS).alias("format"), metrics.known_name(sign, metrics.SIGNATURES).alias("signature"))


POLICY = [("ORG", None, "TELEMETRY", 10), ("METRIC", "view", "TELEMETRY", 5), ("ORG", None, "RAW", 20), ("METRIC", "click", "RAW", 3), ("ORG", None, "TELEMETRY", 0)]


@query(
    "retention_preview_items",
    f"""WITH i(position, scope, scope_ref, data_class, days, bytes) AS (VALUES (0, 'ORG', NULL, 'TELEMETRY', 10, 1000000007), (1, 'METRIC', 'view', 'TELEMETRY', 5, 1000000007), (2, 'ORG', NULL, 'RAW', 20, 77777), (3, 'METRIC', 'click', 'RAW', 3, 77777), (4, 'ORG', NULL, 'TELEMETRY', 0, 1000000007)),
c AS (SELECT i.*, (SELECT count(*) FROM {T} t WHERE days > 0 AND organization_id = 1 AND (CASE data_class WHEN 'RAW' THEN received_at ELSE time END) < TIMESTAMP '2024-02-01' - to_days(days) AND (scope = 'ORG' OR data_class = 'RAW' OR metric_key = scope_ref)) AS n FROM i)
SELECT position, scope, scope_ref, data_class, n AS n_rows, (bytes::HUGEINT * n // (SELECT count(*) FROM {T}))::BIGINT AS n_bytes FROM c""",
)
def retention_preview_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = from_events(spark, sf_dir)
    stored = {"TELEMETRY": (p, "time", 1_000_000_007), "RAW": (p.select("organization_id", "received_at"), "received_at", 77_777)}
    return maintenance.retention_preview_items(stored, POLICY, 1, at("2024-02-01 00:00:00"))


@query(
    "formula_rolling_latest",
    f"""WITH p AS (SELECT * FROM {from_events_sql(5, 30)} WHERE metric_key = 'view'), now AS (SELECT device_id, time, max(value) AS v, bool_or(flags & 1 = 1) AS late FROM p GROUP BY ALL), old AS (SELECT device_id, time, max(value) AS s FROM p WHERE flags & 1 = 0 GROUP BY ALL),
j AS (SELECT n.device_id, n.time, n.v, o.s FROM now n LEFT JOIN old o ON NOT n.late AND o.device_id = n.device_id AND o.time < n.time AND o.time >= n.time - INTERVAL 18 HOUR QUALIFY row_number() OVER (PARTITION BY n.device_id, n.time ORDER BY o.time DESC) <= 10),
a AS (SELECT device_id, time, any_value(v) AS v, coalesce(sum(s::DECIMAL(18,6)), 0) + any_value(v)::DECIMAL(18,6) AS total, count(s) + 1 AS n, least(min(s), any_value(v)) AS low, greatest(max(s), any_value(v)) AS high FROM j GROUP BY ALL)
SELECT device_id, time, unnest(['mean', 'sum', 'count', 'low', 'high']) AS metric_key, unnest([total::DOUBLE / n, total::DOUBLE, n::DOUBLE, low, high]) AS value FROM a""",
)
def formula_rolling_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows of 18 hours that hold at most the ten latest points."""
    names = {"mean": "rolling_mean", "sum": "rolling_sum", "count": "rolling_count", "low": "rolling_min", "high": "rolling_max"}
    return formula.evaluate(from_events(spark, sf_dir, 5, 30), {k: f"{f}(view, 18h)" for k, f in names.items()}, most=10)
