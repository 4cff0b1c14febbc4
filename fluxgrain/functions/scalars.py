"""Small column functions: identifiers, normalised names, units of time, value coercion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that stand for numbers where a metric defines none of its own (fixed values).
COMMON_WORDS = {"open": 1.0, "close": 0.0, "closed": 0.0, "on": 1.0, "off": 0.0, "true": 1.0, "false": 0.0}
#: The shape of a metric's key (fixed value).
METRIC_KEY = "^[A-Za-z][A-Za-z0-9_]{0,63}$"


def name_uuid(name: Column) -> Column:
    """The version-3 UUID of a name: its MD5 with the version and variant bits set."""
    h = F.md5(name.cast("binary"))
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 2), 16, 10).cast("int").bitwiseAND(63).bitwiseOR(128)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("3"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 19, 2)), F.substring(h, 21, 12))


def telemetry_id(organization_id: Column, message_id: Column) -> Column:
    return name_uuid(F.concat_ws(":", F.lit("telemetry"), organization_id.cast("string"), message_id.cast("string")))


def uplink_id(organization_id: Column, message_id: Column) -> Column:
    return name_uuid(F.concat_ws(":", F.lit("uplink"), organization_id.cast("string"), message_id.cast("string")))


def instant_text(t: Column) -> Column:
    """An instant in ISO 8601, with no fraction, milliseconds or microseconds, whatever it takes."""
    shown = lambda digits: F.date_format(t, f"yyyy-MM-dd'T'HH:mm:ss{digits}'Z'")
    return F.when(F.unix_micros(t) % 1_000_000 == 0, shown("")).when(F.unix_micros(t) % 1000 == 0, shown(".SSS")).otherwise(shown(".SSSSSS"))


def derived_id(device_id: Column, t: Column, keys: Column) -> Column:
    """The id of a message of derived points: the same for the same device, instant and set of keys."""
    return name_uuid(F.concat_ws(":", F.lit("derived"), device_id.cast("string"), instant_text(t), F.array_join(F.sort_array(F.array_distinct(keys)), ",")))


def external_id(raw: Column) -> Column:
    return F.lower(F.trim(raw))


def number(text: Column, kind: Column, words: Column) -> Column:
    """A decoded value as a finite number, or null.

    kind is 'number', 'bool' or 'text'; words is a metric's map of words, which if not empty is the only one that counts.
    """
    plain = F.lower(F.trim(text))
    own = F.size(F.coalesce(words, F.create_map().cast("map<string,double>"))) > 0
    common = F.create_map(*[F.lit(x) for kv in COMMON_WORDS.items() for x in kv])
    parsed = F.try_cast(plain, "double") if hasattr(F, "try_cast") else plain.try_cast("double")
    value = (
        F.when(kind == "bool", F.when(plain == "true", 1.0).otherwise(0.0))
        .when(kind == "number", parsed)
        .when(own, F.try_element_at(words, plain))
        .otherwise(F.coalesce(F.try_element_at(common, plain), parsed))
    )
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)


def epoch(v: Column, fmt: str = "AUTO") -> Column:
    """An instant from epoch seconds or milliseconds; AUTO takes numbers below 1e11 for seconds."""
    seconds, millis = F.timestamp_seconds(v), F.timestamp_millis(v)
    return {"EPOCH_S": seconds, "EPOCH_MS": millis}.get(fmt, F.when(v < 100_000_000_000, seconds).otherwise(millis))


def inherited(*values: Column) -> Column:
    """The first positive one of a device's, its model's and a default value."""
    return F.coalesce(*[F.when(v > 0, v) for v in values])


def clamp_battery(v: Column) -> Column:
    return F.when(v.isNotNull(), F.least(F.greatest(v, F.lit(0.0)), F.lit(999.99)))
