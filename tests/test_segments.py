"""The log of segments: gapless offsets, resumption, pieces, gaps, pruning of columns, empty logs, and ingest from it."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from test_streams import SOURCES, dims, frame, message

from fluxgrain.sources import segments, store
from fluxgrain.streaming import ingest

SCHEMA = "partition int, offset bigint, id bigint, text string"


@pytest.fixture
def log(spark, tmp_path):
    spark.dataSource.register(segments.Segments)
    return f"{tmp_path}/log"


def more(spark, log, ids, group_rows=3):
    df = spark.createDataFrame([(i, "x" * (i % 5) if i % 7 else None, None if i % 11 == 0 else i % 3) for i in ids], "id bigint, text string, p int").repartition(3)
    return segments.append(df, log, F.col("p"), ("id",), group_rows)


def table(spark, log, schema=SCHEMA, most=2):
    return spark.read.format("segments").schema(schema).option("rowsPerTask", most).load(log)


def test_offsets_and_pieces(spark, log):
    assert more(spark, log, range(1, 21)) == {0: 7, 1: 7, 2: 6}
    assert more(spark, log, range(21, 24)) == {0: 2, 2: 1}
    got = sorted((r["partition"], r["offset"], r["id"]) for r in table(spark, log).collect())
    want = {p: [i for i in range(1, 24) if (0 if i % 11 == 0 else i % 3) == p] for p in range(3)}
    assert got == [(p, n, i) for p in range(3) for n, i in enumerate(want[p])]
    assert {r["id"]: r["text"] for r in table(spark, log, "text string, id bigint").collect()} == {i: "x" * (i % 5) if i % 7 else None for i in range(1, 24)}
    found = segments.pieces(log, {"0": 1}, {"0": 9, "1": 3}, 2)
    assert [(x.partition, x.low, x.high) for x in found] == [(0, 1, 3), (0, 3, 5), (0, 5, 7), (0, 7, 9), (1, 0, 2), (1, 2, 3)]


def test_empty_log(spark, log):
    assert table(spark, log).count() == 0
    assert more(spark, log, []) == {} and table(spark, log).count() == 0


def test_gaps_and_lost_fronts_are_errors(spark, log):
    for ids in (range(3, 6), range(6, 9), range(9, 12)):
        segments.append(spark.createDataFrame([(i, "") for i in ids], "id bigint, text string"), log, F.lit(0), ("id",))
    first, second, _ = sorted(glob.glob(f"{log}/partition=0/*.parquet"))
    os.rename(first, first + ".gone")
    assert [r["offset"] for r in table(spark, log).orderBy("offset").collect()] == list(range(3, 9))  # a table begins at what is there
    with pytest.raises(ValueError, match="begins at 3, after 2"):
        segments.pieces(log, {"0": 2}, {"0": 9}, 10)
    os.rename(first + ".gone", first)
    os.rename(second, second + ".gone")
    with pytest.raises(ValueError, match="no messages from 3 to before 6"):
        segments.listed(log)


def test_stream_goes_on_after_a_failed_batch(spark, log, tmp_path):
    seen = []

    def run(fail):
        def handle(batch, number):
            rows = [(r["partition"], r["offset"]) for r in batch.collect()]
            if fail:
                raise RuntimeError("lost")
            seen.append(rows)

        source = spark.readStream.format("segments").schema(SCHEMA).load(log)
        ingest.run(source, f"{tmp_path}/checkpoint", handle).awaitTermination()

    more(spark, log, range(1, 7))
    run(False)
    segments.append(spark.createDataFrame([(100, "new")], "id bigint, text string"), log, F.lit(5), ("id",))
    more(spark, log, range(7, 10))
    with pytest.raises(Exception, match="lost"):
        run(True)
    run(False)
    run(False)
    assert sorted(seen[0]) == [(p, o) for p in range(3) for o in range(2)]
    assert sorted(seen[1]) == [(0, 2), (1, 2), (2, 2), (5, 0)] and len(seen) == 2


def test_ingest_from_a_log(spark, log):
    base = store.scratch(spark, "logged")
    for rows in ([message(1, 0), message(2, 1, key="k")], [message(3, 2, key="k"), message(4, 3)]):
        segments.append(frame(spark, rows), log, F.col("organization_id") % 3, ("received_at", "id"))
        ingest.run_stored(ingest.read_log(spark, log), base, SOURCES, *dims(spark)).awaitTermination()
    got = {r["id"]: r["status"] for r in spark.read.parquet(f"{base}/messages").collect()}
    assert got == {1: "OK", 2: "OK", 3: "DUPLICATE", 4: "OK"} and spark.read.parquet(f"{base}/messages").count() == 4
