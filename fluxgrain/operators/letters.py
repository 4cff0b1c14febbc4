"""The life of dead letters after they were opened: locks for another try, outcomes, discarding, expiry; and what a request to try again gets.

Items: (id, organization_id, raw_message_id, stage, code, status, attempts, locked_by, locked_until, created_at, resolved_at, discard_reason).
Every function returns all items, changed or not. Requests are small tables of at most ``MOST`` rows, so the optimizer can broadcast them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fluxgrain.operators.metrics import REPROCESSABLE

MOST, LOCK, KEEP_DAYS = 5000, "interval 5 minutes", 14


def is_open() -> Column:
    return F.coalesce(F.col("status").isin("OPEN", "REPROCESSING"), F.lit(False))


def lockable(now: Column) -> Column:
    """Open items, and those whose lock has run out."""
    return F.coalesce((F.col("status") == "OPEN") | ((F.col("status") == "REPROCESSING") & (F.col("locked_until") < now)), F.lit(False))


def changed(items: DataFrame, wanted: DataFrame, key: list[str], when: Column, values: dict[str, Column]) -> DataFrame:
    """items with values in the rows that wanted names by key and for which ``when`` holds; wanted's other columns may be used as _name."""
    extra = [F.col(c).alias(f"_{c}") for c in wanted.columns if c not in key]
    named = wanted.select(*key, *extra, F.lit(True).alias("_named")).dropDuplicates(key)
    rows = items.join(named, key, "left")
    hit = F.coalesce(F.col("_named"), F.lit(False)) & when
    return rows.select(*[F.when(hit, values[c]).otherwise(F.col(c)).cast(items.schema[c].dataType).alias(c) if c in values else F.col(c) for c in items.columns])


def checked(wanted: DataFrame) -> DataFrame:
    """The request itself, or an error if it names more than ``MOST`` items."""
    if wanted.limit(MOST + 1).count() > MOST:
        raise ValueError(f"a request names at most {MOST} items")
    return wanted


def locked(items: DataFrame, wanted: DataFrame, user: Column, now: Column) -> DataFrame:
    """Lock the lockable ones of wanted (organization_id, id) for five minutes."""
    values = {"status": F.lit("REPROCESSING"), "locked_by": user, "locked_until": now + F.expr(LOCK)}
    return changed(items, wanted.select("organization_id", "id"), ["organization_id", "id"], lockable(now), values)


def resolved(items: DataFrame, done: DataFrame, now: Column) -> DataFrame:
    """Resolve the open items of messages (organization_id, raw_message_id) that were processed."""
    values = {"status": F.lit("RESOLVED"), "resolved_at": now, "locked_by": F.lit(None), "locked_until": F.lit(None)}
    return changed(items, done.select("organization_id", "raw_message_id"), ["organization_id", "raw_message_id"], is_open(), values)


def reopened(items: DataFrame, failed: DataFrame) -> DataFrame:
    """Open the items of failed (organization_id, id, code) again, one attempt more, under the new code."""
    values = {"status": F.lit("OPEN"), "attempts": F.col("attempts") + 1, "code": F.col("_code"), "locked_by": F.lit(None), "locked_until": F.lit(None)}
    return changed(items, failed.select("organization_id", "id", "code"), ["organization_id", "id"], is_open(), values)


def discarded(items: DataFrame, wanted: DataFrame, reason: Column, now: Column) -> DataFrame:
    """Discard the open ones of wanted (organization_id, id); their messages stay."""
    values = {"status": F.lit("DISCARDED"), "discard_reason": reason, "resolved_at": now, "locked_by": F.lit(None), "locked_until": F.lit(None)}
    return changed(items, wanted.select("organization_id", "id"), ["organization_id", "id"], is_open(), values)


def unexpired(items: DataFrame, now: Column, days: int = KEEP_DAYS) -> DataFrame:
    return items.where(~F.coalesce(F.col("created_at") < now - F.make_dt_interval(days=F.lit(days)), F.lit(False)))


def answers(requests: DataFrame, items: DataFrame, raw: DataFrame, now: Column) -> DataFrame:
    """requests (organization_id, kind DLQ or RAW, id) with raw_message_id and skipped, the code why one is not tried again (null: it is).

    raw: (organization_id, id, status). ``items`` is the table before anything is locked.
    """
    known = items.select("organization_id", F.lit("DLQ").alias("kind"), "id", F.col("raw_message_id").alias("_raw"), "status", "locked_until")
    rows = requests.join(known, ["organization_id", "kind", "id"], "left")
    rows = rows.withColumn("raw_message_id", F.when(F.col("kind") == "DLQ", F.col("_raw")).otherwise(F.col("id")))
    rows = rows.join(raw.select("organization_id", F.col("id").alias("raw_message_id"), F.col("status").alias("_state")), ["organization_id", "raw_message_id"], "left")
    letter = F.col("kind") == "DLQ"
    skipped = (
        F.when(letter & F.col("status").isNull(), "RESOURCE_NOT_FOUND")
        .when(letter & ~lockable(now), F.when(F.col("status") == "REPROCESSING", "ING_DLQ_ITEM_LOCKED").otherwise(F.concat(F.lit("DLQ_"), "status")))
        .when(F.col("_state").isNull(), "ING_RAW_MESSAGE_NOT_FOUND")
        .when(~letter & ~F.col("_state").isin(*REPROCESSABLE), "ING_REPROCESS_SAME_RESULT")
    )
    return rows.select(*requests.columns, "raw_message_id", skipped.alias("skipped"))
