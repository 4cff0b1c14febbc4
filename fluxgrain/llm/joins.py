"""Joins of rows with a small table of their groups, of which one group may hold a third of all rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import AtomicType

#: Rows of a table of groups up to which it is broadcast (about 300 bytes each), and parts that a group's rows are dealt to beyond.
SMALL, SALTS = 50_000, 64


def with_groups(rows: DataFrame, groups: DataFrame, on: list[str], small: int = SMALL, how: str = "inner") -> DataFrame:
    """rows joined with groups (one row per key), which is counted first: broadcast if it is small, else each group's rows are salted."""
    if groups.count() <= small:
        return rows.join(F.broadcast(groups), on, how)
    plain = [f.name for f in rows.schema.fields if isinstance(f.dataType, AtomicType)]
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(*plain), F.lit(SALTS)).cast("int"))
    every = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(every, [*on, "_salt"], how).drop("_salt")
