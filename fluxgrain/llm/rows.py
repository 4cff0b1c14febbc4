"""Functions of ids and texts over Arrow batches. Ids never become floats, whatever rows have none."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType


def map_rows(df: DataFrame, run: Callable, schema: str, streamed: bool = False, most: int = 512) -> DataFrame:
    """df's batches through run, as lists of Python values (null: None) by column; run returns a dict of lists for ``schema``.

    A batch goes in slices of at most ``most`` rows, so that few texts are Python values at once. With ``streamed`` run gets an iterator of all batches of a partition (tuples of lists) and yields dicts.
    """
    shape = to_arrow_schema(StructType.fromDDL(schema))

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = (b.slice(at, most) for b in batches for at in range(0, max(1, b.num_rows), most))
        lists = (tuple(c.to_pylist() for c in b.columns) for b in parts)
        for out in run(lists) if streamed else (run(*x) for x in lists):
            yield pa.RecordBatch.from_pydict({f.name: pa.array(out[f.name], type=f.type) for f in shape}, schema=shape)

    return df.mapInArrow(apply, schema)
