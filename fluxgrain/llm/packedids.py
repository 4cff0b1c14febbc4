"""Token ids of documents in files of fixed-width bits, as a Spark data source that is written and read in parallel.

Every id takes the fewest bits that hold the vocabulary (16 for 50,257 ids, 15 for 32,000). A shard is one file:

    "IDS1"
    blocks      ``block`` ids each (the last one fewer), every block from a byte of its own on; 8 ids fill ``bits`` bytes, the first id in the lowest bits
    footer      per document its id, whether it has one, and the number of its first id in the shard; per block its byte offset and its CRC-32
    56 bytes    bits, ids a block, numbers of documents, ids and blocks, footer's CRC-32, "IDS1END."

A block is unpacked by eight vectorised steps whatever its size, and as its offset is stored, any range of ids is read without what lies before it (ids_at()). The folder's
``manifest.json`` names the shards in order with their counts; it is written last, by renaming, and alone says what belongs to the folder. A task that is repeated, or
runs twice, writes under another name, and only the one that Spark commits gets into the manifest.

write() deals the documents by ranges of ids, sorts them (rows without an id last; rows that share an id, or have none, by a hash of their text, so that they are
dealt out too) and encodes them where they are written: what is shuffled is texts, and encoding runs once. Null and empty texts have the end id alone; texts of any length go whole; an
empty table gives a manifest without documents; columns but the id and the text are not read. The folder must be one that pyarrow's file systems reach (file, hdfs, s3, gs).
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, InputPartition, WriterCommitMessage

from fluxgrain.llm.packing import encoder
from fluxgrain.llm.rows import map_rows

MAGIC, END_MAGIC, TAIL = b"IDS1", b"IDS1END.", "<qqqqqq8s"
BLOCK, VOCABULARY, END_ID, BATCH = 65_536, 50_257, 2, 1 << 20


def width(vocabulary: int) -> int:
    return max(1, (vocabulary - 1).bit_length())


def pack(ids: np.ndarray, bits: int) -> bytes:
    """ids (below 2**bits) in bits each; 8 ids are ``bits`` bytes, so each of 8 lanes has the same place in all groups."""
    n = -(-len(ids) // 8)
    lanes = np.zeros(n * 8, dtype=np.uint64)
    lanes[: len(ids)] = ids
    lanes = lanes.reshape(n, 8)
    out = np.zeros((n, bits), dtype=np.uint8)
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        v = lanes[:, j] << np.uint64(shift)
        for k in range(-(-(shift + bits) // 8)):
            out[:, at + k] |= (v >> np.uint64(8 * k)).astype(np.uint8)
    return out.tobytes()[: -(-len(ids) * bits // 8)]


def unpack(data: bytes, n: int, bits: int) -> np.ndarray:
    groups = -(-n // 8)
    raw = np.zeros(groups * bits, dtype=np.uint8)
    raw[: len(data)] = np.frombuffer(data, dtype=np.uint8)
    raw = raw.reshape(groups, bits)
    out = np.empty((groups, 8), dtype="<u4")
    for j in range(8):
        at, shift = divmod(j * bits, 8)
        v = np.zeros(groups, dtype=np.uint64)
        for k in range(-(-(shift + bits) // 8)):
            v |= raw[:, at + k].astype(np.uint64) << np.uint64(8 * k)
        out[:, j] = (v >> np.uint64(shift)) & np.uint64((1 << bits) - 1)
    return out.reshape(-1)[:n]


def place(path: str):
    """(file system, path in it) of a folder or file."""
    from pyarrow import fs

    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else path.replace("file:", "", 1))


class Shard:
    """An open shard: its index in memory, its blocks read when asked for."""

    def __init__(self, path: str):
        files, name = place(path)
        self.file = files.open_input_file(name)
        size = self.file.size()
        self.bits, self.block, docs, self.n_ids, blocks, crc, magic = struct.unpack(TAIL, self.file.read_at(56, size - 56))
        length = docs * 17 + 8 + blocks * 12
        footer = self.file.read_at(length, size - 56 - length) if magic == END_MAGIC and 0 < length < size else b""
        if not footer or zlib.crc32(footer) != crc:
            raise ValueError(f"{path} is not a whole shard")
        self.doc_ids = np.frombuffer(footer, dtype="<i8", count=docs)
        self.known = np.frombuffer(footer, dtype="u1", count=docs, offset=docs * 8).astype(bool)
        self.starts = np.frombuffer(footer, dtype="<i8", count=docs + 1, offset=docs * 9)
        self.offsets = np.frombuffer(footer, dtype="<i8", count=blocks, offset=docs * 17 + 8)
        self.crcs = np.frombuffer(footer, dtype="<u4", count=blocks, offset=docs * 17 + 8 + blocks * 8)

    def ids(self, start: int, end: int) -> np.ndarray:
        """The ids with numbers start to end (exclusive) of the shard; only their blocks are read."""
        parts = []
        for k in range(start // self.block, -(-end // self.block) if end > start else start // self.block):
            n = min(self.block, self.n_ids - k * self.block)
            data = self.file.read_at(-(-n * self.bits // 8), int(self.offsets[k]))
            if zlib.crc32(data) != self.crcs[k]:
                raise ValueError(f"block {k} is damaged")
            first = k * self.block
            parts.append(unpack(data, n, self.bits)[max(0, start - first) : end - first])
        return np.concatenate(parts) if parts else np.empty(0, dtype="<u4")

    def close(self) -> None:
        self.file.close()


def manifest(path: str) -> dict:
    files, name = place(path)
    with files.open_input_file(f"{name}/manifest.json") as f:
        return json.loads(f.read())


def ids_at(path: str, start: int, end: int) -> np.ndarray:
    """The ids with numbers start to end (exclusive) of a written folder, from the blocks that hold them."""
    parts, base = [], 0
    for s in manifest(path)["shards"]:
        low, high = max(start, base), min(end, base + s["ids"])
        if low < high:
            shard = Shard(f"{path}/{s['file']}")
            parts.append(shard.ids(low - base, high - base))
            shard.close()
        base += s["ids"]
    return np.concatenate(parts) if parts else np.empty(0, dtype="<u4")


@dataclass
class Written(WriterCommitMessage):
    partition: int
    file: str
    docs: int
    ids: int


class Writer(DataSourceArrowWriter):
    """Rows (doc_id, ids as little-endian uint32) in the order in which they come, one shard a task."""

    def __init__(self, path: str, vocabulary: int, block: int, overwrite: bool):
        self.path, self.vocabulary, self.block, self.overwrite = path, vocabulary, block, overwrite

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        files, name = place(self.path)
        files.create_dir(name, recursive=True)
        number, bits = TaskContext.get().partitionId(), width(self.vocabulary)
        file = f"shard-{number:06d}-{uuid.uuid4().hex}.ids"
        docs, sizes, offsets, crcs, rest = [], [], [], [], np.empty(0, dtype="<u4")
        with files.open_output_stream(f"{name}/{file}") as out:
            out.write(MAGIC)
            at = len(MAGIC)

            def put(ids: np.ndarray) -> None:
                nonlocal at
                data = pack(ids, bits)
                offsets.append(at)
                crcs.append(zlib.crc32(data))
                out.write(data)
                at += len(data)

            for b in iterator:
                docs += b.column("doc_id").to_pylist()
                column = b.column("ids").cast(pa.binary())
                ends = np.frombuffer(column.buffers()[1], dtype=np.int32)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, dtype=np.int32)
                sizes.append(np.diff(ends) // 4)
                ids = np.frombuffer(column.buffers()[2], dtype=np.uint8)[ends[0] : ends[-1]].view("<u4") if ends[-1] > ends[0] else np.empty(0, dtype="<u4")
                if len(ids) and ids.max() >= self.vocabulary:
                    raise ValueError(f"an id is not below {self.vocabulary}")
                rest = np.concatenate([rest, ids])
                whole = len(rest) // self.block * self.block
                for k in range(0, whole, self.block):
                    put(rest[k : k + self.block])
                rest = rest[whole:].copy()
            total = len(offsets) * self.block + len(rest)
            if len(rest):
                put(rest)
            starts = np.r_[0, np.cumsum(np.concatenate([np.empty(0, dtype=np.int64), *sizes]))].astype("<i8")
            known = np.array([d is not None for d in docs], dtype="u1")
            parts = (np.array([d or 0 for d in docs], dtype="<i8"), known, starts, np.array(offsets, dtype="<i8"), np.array(crcs, dtype="<u4"))
            footer = b"".join(p.tobytes() for p in parts)
            out.write(footer + struct.pack(TAIL, bits, self.block, len(docs), total, len(offsets), zlib.crc32(footer), END_MAGIC))
        return Written(number, file, len(docs), total)

    def commit(self, messages: list[Written | None]) -> None:
        files, name = place(self.path)
        files.create_dir(name, recursive=True)
        from pyarrow import fs

        if not self.overwrite and files.get_file_info(f"{name}/manifest.json").type != fs.FileType.NotFound:
            raise ValueError(f"{self.path} is written already")
        shards = [{"file": m.file, "docs": m.docs, "ids": m.ids} for m in sorted((m for m in messages if m is not None and m.docs), key=lambda m: m.partition)]
        with files.open_output_stream(f"{name}/manifest.tmp") as f:
            f.write(json.dumps({"vocabulary": self.vocabulary, "bits": width(self.vocabulary), "block": self.block, "shards": shards}).encode())
        files.move(f"{name}/manifest.tmp", f"{name}/manifest.json")

    def abort(self, messages: list[Written | None]) -> None:
        files, name = place(self.path)
        for m in messages:
            if m is not None:
                files.delete_file(f"{name}/{m.file}")


@dataclass
class Part(InputPartition):
    file: str
    base: int


class Reader(DataSourceReader):
    """One task a shard; a batch holds about a million ids, or one longer document."""

    def __init__(self, path: str):
        self.path = path

    def partitions(self) -> list[Part]:
        shards = manifest(self.path)["shards"]
        bases = np.r_[0, np.cumsum([s["ids"] for s in shards])].tolist()
        return [Part(s["file"], b) for s, b in zip(shards, bases)]

    def read(self, partition: Part | None) -> Iterator[pa.RecordBatch]:
        if partition is None or not isinstance(partition, Part):  # a folder without shards
            return
        shard, first = Shard(f"{self.path}/{partition.file}"), 0
        while first < len(shard.doc_ids):
            last = max(first + 1, int(np.searchsorted(shard.starts, shard.starts[first] + BATCH, side="right")) - 1)
            starts = shard.starts[first : last + 1]
            data = shard.ids(int(starts[0]), int(starts[-1])).tobytes()
            ids = pa.Array.from_buffers(pa.binary(), last - first, [None, pa.py_buffer(((starts - starts[0]) * 4).astype(np.int32).tobytes()), pa.py_buffer(data)])
            doc_ids = pa.array(shard.doc_ids[first:last], mask=~shard.known[first:last])
            yield pa.RecordBatch.from_arrays([doc_ids, pa.array(starts[:-1] + partition.base), ids], names=["doc_id", "start", "ids"])
            first = last
        shard.close()


class PackedIds(DataSource):
    """spark.read / df.write .format("packed_ids"); options path, vocabulary (50257) and block (65536 ids)."""

    @classmethod
    def name(cls) -> str:
        return "packed_ids"

    def schema(self) -> str:
        return "doc_id bigint, start bigint, ids binary"

    def reader(self, schema) -> Reader:
        return Reader(self.options["path"])

    def writer(self, schema, overwrite: bool) -> Writer:
        return Writer(self.options["path"], int(self.options.get("vocabulary", VOCABULARY)), int(self.options.get("block", BLOCK)), overwrite)


def ordered(docs: DataFrame) -> DataFrame:
    """doc_id and text of docs, in ranges of ascending ids, each sorted."""
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    keys = [F.col("doc_id").asc_nulls_last(), F.xxhash64("text")]
    return rows.repartitionByRange(*keys).sortWithinPartitions(*keys)


def encoded(docs: DataFrame, end: int = END_ID, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """doc_id and ids (little-endian uint32, packed, with the end id) of docs, in their order."""

    def run(ids: list, texts: list) -> dict:
        encode, out = encoder(json_path, ranks_path), []
        for t in texts:
            one = encode(t or "")
            one[-1] = end  # in place of the encoder's own end id
            out.append(one.tobytes())
        return {"doc_id": ids, "ids": out}

    return map_rows(docs.select("doc_id", "text"), run, "doc_id bigint, ids binary")


def write(docs: DataFrame, path: str, vocabulary: int = VOCABULARY, block: int = BLOCK, end: int = END_ID, json_path: str | None = None, ranks_path: str | None = None) -> None:
    """The ids of every row of docs (doc_id, text) into the folder path, which must not be written yet."""
    docs.sparkSession.dataSource.register(PackedIds)
    encoded(ordered(docs), end, json_path, ranks_path).write.format("packed_ids").option("vocabulary", vocabulary).option("block", block).mode("append").save(path)


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (number of ids before the document's) and ids (little-endian uint32, packed) of every document of a folder."""
    spark.dataSource.register(PackedIds)
    return spark.read.format("packed_ids").load(path)
