"""Packing of token sequences by Karmarkar-Karp multiway differencing.

A document's ids are those of a byte-level BPE and an end id. Whole windows are cut off long documents. What is left is
gathered into blocks of about ``block_windows`` windows, cut into parts of at most ``part`` tokens, and a block's parts are
divided by k-way differencing: partial partitions (k sums each) are merged, largest spread first, the largest sums of one
to the smallest of the other, until one remains with near-equal windows. If a window exceeds the capacity, k rises by one
and the block is divided again. The last block of a partition sheds what exceeds whole windows as power-of-two windows,
which need no padding.

Each partition of the input is packed by itself as a stream: there is no shuffle, memory holds one Arrow batch and one
block, and a task that is repeated gives the same windows again. Sequence ids are unique as they begin with the
partition's number. Null texts count as empty (the end id alone); repeated rows and rows without an id are packed each for itself; an empty table
gives no rows; columns but the id and the text are not read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fluxgrain.llm.rows import map_rows

CAPACITY = 2048
END_ID = 1
#: Characters for which both tokenizer libraries are known to agree; any other text goes to the slower one.
PLAIN = re.compile("[\t\n\r\x20-\x7e¡-ɏ‘-‟…€]*")


@lru_cache(maxsize=2)
def encoder(json_path: str | None = None, ranks_path: str | None = None):
    """text -> little-endian uint32 ids. The vocabulary's rank file is the fast way for plain texts, with the same ids."""
    import base64

    import public_tokenizers
    import tiktoken
    from tokenizers import Tokenizer

    slow = Tokenizer.from_file(json_path or public_tokenizers.path("byte_bpe_50k.json"))
    slow.encode_special_tokens = True
    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(text: str) -> np.ndarray:
        ids = fast.encode_ordinary(text) if PLAIN.fullmatch(text) else slow.encode(text, add_special_tokens=False).ids
        return np.array([*ids, END_ID], dtype="<u4")

    return encode


def differencing(sizes: list[int], k: int) -> np.ndarray:
    """The window (0..k-1) of each item, by k-way Karmarkar-Karp differencing."""
    if k == 1 or not sizes:
        return np.zeros(len(sizes), dtype=np.int64)
    sums, merged = [], []  # sums of each partial partition, ascending; for merges: both parts and where their sums went
    heap = []
    for i, s in enumerate(sizes):
        v = np.zeros(k, dtype=np.int64)
        v[-1] = s
        sums.append(v)
        heap.append((-s, i))
    heapq.heapify(heap)
    while len(heap) > 1:
        (_, a), (_, b) = heapq.heappop(heap), heapq.heappop(heap)
        v = sums[a] + sums[b][::-1]
        order = np.argsort(v, kind="stable")
        v = v[order]
        sums[a] = sums[b] = None
        sums.append(v)
        merged.append((a, b, order))
        heapq.heappush(heap, (int(v[0] - v[-1]), len(sums) - 1))
    place = {len(sums) - 1: np.arange(k)}
    window = np.zeros(len(sizes), dtype=np.int64)
    for node in range(len(sums) - 1, -1, -1):
        at = place.pop(node)
        if node < len(sizes):
            window[node] = at[-1]
            continue
        a, b, order = merged[node - len(sizes)]
        back = np.empty(k, dtype=np.int64)
        back[order] = at  # the final window of each slot before it was sorted
        place[a], place[b] = back, back[::-1]
    return window


class Packer:
    """Packs the documents that add() gets; pieces() hands out what is settled: (doc_id, start, ids, doc_tokens, sequence, offset)."""

    def __init__(self, first_sequence: int = 0, capacity: int = CAPACITY, block_windows: int = 256, part: int = 512, slack: int = 4):
        self.next, self.capacity, self.windows, self.part, self.fill = first_sequence, capacity, block_windows, min(part, capacity), max(1, capacity - slack)
        self.block: list[tuple] = []
        self.tokens = 0
        self.out: list[tuple] = []
        self.rows = 0

    def sequence(self, parts: list[tuple]) -> None:
        offset = 0
        for (_, doc_id), start, ids, total in parts:
            self.out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes()), total, self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.rows += 1
        doc = (self.rows, doc_id)  # rows that share an id, or have none, are told apart
        whole = len(ids) // self.capacity * self.capacity
        for s in range(0, whole, self.capacity):
            self.sequence([(doc, s, ids[s : s + self.capacity], len(ids))])
        at = whole
        while at < len(ids):
            n = min(self.part, len(ids) - at, self.windows * self.fill - self.tokens)
            self.block.append((doc, at, ids[at : at + n], len(ids)))
            self.tokens += n
            at += n
            if self.tokens == self.windows * self.fill:
                self.divide()

    def divide(self) -> None:
        sizes = [len(p[2]) for p in self.block]
        k = -(-self.tokens // self.capacity)
        while True:
            window = differencing(sizes, k)
            if not sizes or np.bincount(window, weights=sizes, minlength=k).max() <= self.capacity:
                break
            k += 1
        parts: dict[int, list[tuple]] = {}
        for w, p in sorted(zip(window.tolist(), self.block), key=lambda x: (x[0], x[1][0][0], x[1][1])):
            own = parts.setdefault(w, [])
            if own and own[-1][0] == p[0] and own[-1][1] + len(own[-1][2]) == p[1]:  # neighbours of one document are one piece again
                own[-1] = (p[0], own[-1][1], np.concatenate([own[-1][2], p[2]]), p[3])
            else:
                own.append(p)
        for own in parts.values():
            self.sequence(own)
        self.block, self.tokens = [], 0

    def finish(self) -> None:
        rest = self.tokens % self.fill
        while rest:
            size = 1 << (rest.bit_length() - 1)
            rest -= size
            self.tokens -= size
            own = []
            while size:
                doc_id, start, ids, total = self.block.pop()
                n = min(size, len(ids))
                if n < len(ids):
                    self.block.append((doc_id, start, ids[:-n], total))
                own.append((doc_id, start + len(ids) - n, ids[len(ids) - n :], total))
                size -= n
            self.sequence(own[::-1])
        if self.tokens:
            self.divide()

    def pieces(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


def pack(docs: DataFrame, capacity: int = CAPACITY, block_windows: int = 256, part: int = 512, json_path: str | None = None, ranks_path: str | None = None) -> DataFrame:
    """One row per piece of a document; see the module's text. Sequences are gapless from offset 0 and hold at most ``capacity`` ids."""

    def run(batches: Iterator[tuple[list, list]]) -> Iterator[dict]:
        encode, packer = encoder(json_path, ranks_path), Packer(TaskContext.get().partitionId() << 36, capacity, block_windows, part)
        names = [x.split()[0] for x in PIECE.split(", ")]
        settled = lambda: dict(zip(names, map(list, zip(*rows)))) if (rows := packer.pieces()) else {k: [] for k in names}
        for ids, texts in batches:
            for doc_id, text in zip(ids, texts):
                packer.add(doc_id, encode(text or ""))
            yield settled()
        packer.finish()
        yield settled()

    return map_rows(docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text"), run, PIECE, streamed=True)
