"""A partitioned log of messages in segment files, as a stream and as a table: every message has a partition and an offset, offsets of a partition are gapless from 0.

A segment is an immutable Parquet file ``partition=<p>/<first offset>-<count>.parquet``, so that offsets are known from names alone. The folder is one that pyarrow's file systems
reach (file, hdfs, s3, gs). Register the source once per session: ``spark.dataSource.register(segments.Segments)``; then ``spark.readStream.format("segments").schema(...).load(path)``.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

#: Columns that a reader adds if its schema names them.
PARTITION, OFFSET = "partition", "offset"


def _files(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


@dataclass
class Piece(InputPartition):
    """Offsets from low to before high, which one segment file holds; first is the file's own."""

    file: str
    partition: int
    first: int
    low: int
    high: int


def listed(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """Per partition its segments (first offset, count, file) in order; a segment missing between two others is an error, not skipped."""
    from pyarrow import fs

    files, base = _files(path)
    out: dict[int, list[tuple[int, int, str]]] = {}
    for info in files.get_file_info(fs.FileSelector(base, recursive=True, allow_not_found=True)):
        folder, _, name = info.path.rpartition("/")
        if name.endswith(".parquet") and folder.rpartition("/")[2].startswith("partition="):
            first, count = name.removesuffix(".parquet").split("-")
            out.setdefault(int(folder.rpartition("=")[2]), []).append((int(first), int(count), info.path))
    for partition, held in out.items():
        held.sort()
        for (first, count, _), (following, _, file) in zip(held, held[1:]):
            if first + count != following:
                raise ValueError(f"partition {partition} has no messages from {first + count} to before {following}: {file}")
    return out


def pieces(path: str, start: dict[str, int], end: dict[str, int], most: int) -> list[Piece]:
    """What lies between two offsets, one piece per segment and ``most`` messages; messages that are gone from the front are an error."""
    out = []
    for partition, held in sorted(listed(path).items()):
        low, high = start.get(str(partition), 0), end.get(str(partition), 0)
        if low < high and held[0][0] > low:
            raise ValueError(f"partition {partition} begins at {held[0][0]}, after {low}")
        for first, count, file in held:
            for at in range(max(low, first), min(high, first + count), most):
                out.append(Piece(file, partition, first, at, min(at + most, high, first + count)))
    return out


def read_piece(path: str, piece: Piece, names: list[str], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """The piece's messages; row groups outside it are not read, of the others only the columns asked for."""
    import pyarrow.parquet as pq

    files, _ = _files(path)
    with files.open_input_file(piece.file) as source:
        reader, at = pq.ParquetFile(source), piece.first
        own = [n for n in names if n not in (PARTITION, OFFSET)]
        for group in range(reader.num_row_groups):
            count = reader.metadata.row_group(group).num_rows
            low, high = max(piece.low, at), min(piece.high, at + count)
            if low < high:
                rows = reader.read_row_group(group, columns=own).slice(low - at, high - low)
                columns = {n: rows.column(n) for n in own}
                columns |= {PARTITION: pa.repeat(pa.scalar(piece.partition, pa.int32()), high - low), OFFSET: pa.array(range(low, high), pa.int64())}
                yield from pa.Table.from_arrays([columns[n] for n in names], names=names).cast(schema).to_batches(max_chunksize=10_000)
            at += count


class _Shared:
    def __init__(self, options: dict, schema: StructType) -> None:
        from pyspark.sql.pandas.types import to_arrow_schema

        self.path, self.most = options["path"], int(options.get("rowsPerTask", 1_000_000))
        self.names, self.arrow = schema.names, to_arrow_schema(schema)

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return read_piece(self.path, partition, self.names, self.arrow)

    def end(self) -> dict[str, int]:
        return {str(p): held[-1][0] + held[-1][1] for p, held in listed(self.path).items()}


class StreamReader(_Shared, DataSourceStreamReader):
    """Offsets are the next message of each partition, so that a stream goes on after the last one it stored; partitions that appear later begin at 0."""

    def initialOffset(self) -> dict:
        return {}

    def latestOffset(self) -> dict:
        return self.end()

    def partitions(self, start: dict, end: dict) -> list[Piece]:
        return pieces(self.path, start, end, self.most)

    def commit(self, end: dict) -> None:
        """Nothing to do: Spark's checkpoint holds the offsets, segments are deleted by whoever keeps the log."""


class TableReader(_Shared, DataSourceReader):
    def partitions(self) -> list[Piece]:
        found = listed(self.path)
        start = {str(p): held[0][0] for p, held in found.items()}
        return pieces(self.path, start, self.end(), self.most) or [Piece("", 0, 0, 0, 0)]

    def read(self, partition: Piece) -> Iterator[pa.RecordBatch]:
        return super().read(partition) if partition.file else iter(())


class Segments(DataSource):
    """Format ``segments``; options path and rowsPerTask (most messages that one task reads of a segment). Give the schema; partition int and offset bigint may be columns of it."""

    @classmethod
    def name(cls) -> str:
        return "segments"

    def schema(self) -> str:
        raise ValueError("give the schema of the messages")

    def reader(self, schema: StructType) -> DataSourceReader:
        return TableReader(self.options, schema)

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:
        return StreamReader(self.options, schema)


def append(df: DataFrame, path: str, partition: Column, order: tuple[str, ...], group_rows: int = 100_000) -> dict[int, int]:
    """Append df's rows to the log, each to its partition, in order; the number of rows of each partition that got some. One writer at a time.

    Each partition's rows pass one task as a sorted stream, as they get consecutive numbers; partitions are what the log's work is spread by. Files are written beside the log and moved
    in when all are complete, so a lost task leaves nothing; a lost driver may leave the segments of some partitions, which are whole. Rows without a partition go to 0.
    """
    files, base = _files(path)
    staged = f"{base}/_staged/{uuid.uuid4().hex}"
    files.create_dir(staged)
    names = df.columns
    rows = df.withColumn("_partition", F.coalesce(partition.cast("int"), F.lit(0)))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyarrow.compute as pc
        import pyarrow.parquet as pq

        target, _ = _files(path)
        at, writer, count, done, held = None, None, 0, [], []

        def flush() -> None:
            if held:
                writer.write_table(pa.Table.from_batches(held), row_group_size=group_rows)
                held.clear()

        def close() -> None:
            if writer is not None:
                flush()
                writer.close()
                done.append((at, count, name))

        name = ""
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index("_partition"))
            for p in pc.unique(keys).to_pylist():  # sorted by partition: each one's rows are together
                part = batch.filter(pc.equal(keys, p)).select(names)
                if p != at:
                    close()
                    at, count, name = p, 0, f"{staged}/{p}-{uuid.uuid4().hex}.parquet"
                    writer = pq.ParquetWriter(name, part.schema, filesystem=target, compression="zstd")
                held.append(part)
                count += part.num_rows
                if sum(b.num_rows for b in held) >= group_rows:
                    flush()
        close()
        yield pa.RecordBatch.from_pydict({"partition": [d[0] for d in done], "count": [d[1] for d in done], "file": [d[2] for d in done]}, pa.schema([("partition", pa.int32()), ("count", pa.int64()), ("file", pa.string())]))

    placed = rows.repartition("_partition").sortWithinPartitions("_partition", *order)
    written = placed.mapInArrow(write, "partition int, count bigint, file string").collect()  # one row for each partition of the log
    ends = {p: held[-1][0] + held[-1][1] for p, held in listed(path).items()}
    for r in written:
        first = ends.get(r["partition"], 0)
        files.create_dir(f"{base}/partition={r['partition']}")
        files.move(r["file"], f"{base}/partition={r['partition']}/{first:020d}-{r['count']}.parquet")
    return {r["partition"]: r["count"] for r in written}
