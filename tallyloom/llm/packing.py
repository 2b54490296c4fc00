"""Packing documents into windows by Karmarkar-Karp multiway differencing.

Pieces of a group of WINDOWS windows are merged two partial partitions at a time: the two with
the largest imbalance, the fullest window of one with the emptiest of the other. The windows come
out near-equal. A group's pieces sum to just under its capacity, so near-equal windows are nearly
full; whenever one exceeds the capacity the window count rises and the group is merged again.
"""

from __future__ import annotations

import heapq
import zlib
from collections.abc import Iterable, Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tallyloom.llm.textblock import arrow_type, blocks, freeing
from tallyloom.llm.tokens import WordTokens
from tallyloom.shipping import ship

CAPACITY, END_ID = 4096, 2
#: Windows of a group, and tokens that each window of a group leaves free on average.
WINDOWS, SLACK = 32, 12
#: The longest pieces of a group are cut into this sand, so that the last merges can level the windows.
SAND = tuple(size for size in (256, 128, 64, 32, 16) for _ in range(16))
#: If the windows still exceed the capacity, the group is cut this many times finer before their number rises.
FINER = 3


def difference(sizes: list[int], m: int) -> list[list[int]]:
    """Item indexes of m near-equal parts of the sizes."""
    heap = [(-s, i, [s], [[i]]) for i, s in enumerate(sizes)]  # spread, tie, sums from the largest (zeros left out), items
    heapq.heapify(heap)
    tie = len(sizes)
    while len(heap) > 1:
        _, _, sa, ia = heapq.heappop(heap)
        _, _, sb, ib = heapq.heappop(heap)
        if len(sa) + len(sb) <= m:  # each has enough empty windows for the other
            sums, items = sa + sb, ia + ib
        else:
            a, b = sa + [0] * (m - len(sa)), sb + [0] * (m - len(sb))
            sums = [x + y for x, y in zip(a, reversed(b), strict=True)]
            items = [x + y for x, y in zip(ia + [[]] * (m - len(ia)), reversed(ib + [[]] * (m - len(ib))), strict=True)]
        order = sorted(range(len(sums)), key=sums.__getitem__, reverse=True)
        sums, items = [sums[k] for k in order], [items[k] for k in order]
        low = sums[-1] if len(sums) == m else 0
        tie += 1
        heapq.heappush(heap, (-(sums[0] - low), tie, sums, items))
    return heap[0][3] if heap else []


def windows(sizes: list[int], m: int, capacity: int) -> list[list[int]]:
    """Near-equal windows of at most `capacity`: m of them, or as many more as that takes."""
    while True:
        parts = difference(sizes, m)
        if all(sum(sizes[i] for i in p) <= capacity for p in parts):
            return [sorted(p) for p in parts if p]
        m += 1


class Packer:
    """Takes documents' ids in order; yields (document, start, length, crc, window, offset) columns.

    A document's ids beyond whole windows wait in a pool of at most one group. What a task has
    left at its end fills whole windows and then ones of a power of two, which need no padding.
    """

    def __init__(self, capacity: int = CAPACITY, windows_: int = WINDOWS):
        self.capacity, self.m = capacity, windows_
        self.pool: list[tuple[int, int, np.ndarray]] = []
        self.held, self.window, self.out = 0, 0, []

    def put(self, window: int, offset: int, piece: tuple[int, int, np.ndarray]) -> None:
        doc, start, ids = piece
        self.out.append((doc, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), window, offset))

    def fill(self, pieces: list[tuple[int, int, np.ndarray]]) -> None:
        offset = 0
        for p in pieces:
            self.put(self.window, offset, p)
            offset += len(p[2])
        self.window += 1

    def add(self, doc: int, ids: np.ndarray) -> None:
        start = 0
        while len(ids) - start >= self.capacity:
            self.fill([(doc, start, ids[start : start + self.capacity])])
            start += self.capacity
        room = self.m * (self.capacity - SLACK)
        while start < len(ids):
            n = min(len(ids) - start, room - self.held)
            self.pool.append((doc, start, ids[start : start + n].copy()))
            self.held, start = self.held + n, start + n
            if self.held == room:
                self.group(self.m)

    def group(self, m: int) -> None:
        """Pack the whole pool, which is just under m windows."""
        for grains in (SAND, tuple(s for s in SAND for _ in range(FINER))):
            pieces = self.cut(list(grains[: len(grains) * m // self.m]) if m > 1 else [])
            parts = windows([len(p[2]) for p in pieces], m, self.capacity)
            if len(parts) <= m:
                break
        for part in parts:
            self.fill([pieces[i] for i in part])
        self.pool, self.held = [], 0

    def cut(self, sand: list[int]) -> list[tuple[int, int, np.ndarray]]:
        """The pool with its longest pieces cut into the sand."""
        pieces, at = [], {}
        for i in sorted(range(len(self.pool)), key=lambda i: -len(self.pool[i][2])):
            room = len(self.pool[i][2])
            while sand and sand[0] < room:
                room -= sand[0]
                at.setdefault(i, []).append(sand.pop(0))
        for i, (doc, start, ids) in enumerate(self.pool):
            for n in [*at.get(i, []), len(ids) - sum(at.get(i, []))]:
                pieces.append((doc, start, ids[:n]))
                start, ids = start + n, ids[n:]
        return pieces

    def finish(self) -> None:
        """Whole windows first, then the rest in windows of falling powers of two."""
        rest, m = self.pool, self.held // self.capacity
        if m:
            room, self.pool, self.held = m * (self.capacity - SLACK), [], 0
            while rest and self.held < room:
                doc, start, ids = rest.pop(0)
                n = min(len(ids), room - self.held)
                self.pool.append((doc, start, ids[:n]))
                self.held += n
                if n < len(ids):
                    rest.insert(0, (doc, start + n, ids[n:]))
            self.group(m)
        left = sum(len(p[2]) for p in rest)
        while left:
            size, part = 1 << (min(left, self.capacity).bit_length() - 1), []
            left -= size
            while size:
                doc, start, ids = rest.pop(0)
                part.append((doc, start, ids[:size]))
                if len(ids) > size:
                    rest.insert(0, (doc, start + size, ids[size:]))
                size -= len(part[-1][2])
            self.fill(part)
        self.pool, self.held = [], 0

    def take(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


FIELDS = "start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint"


@freeing
def _pack(batches: Iterable[pa.RecordBatch], tokenizer: str, capacity: int, key: pa.DataType) -> Iterator[pa.RecordBatch]:
    encode, packer, base = WordTokens.of(tokenizer), Packer(capacity), TaskContext.get().partitionId() << 32
    ids_of: dict[int, tuple] = {}  # of documents with pieces still to come: id and tokens
    number = 0

    def rows() -> pa.RecordBatch:
        got = packer.take()
        cols = list(zip(*got, strict=True)) if got else [()] * 6
        docs = [ids_of[d] for d in cols[0]]
        held = {d for d, _, _ in packer.pool}
        for d in [d for d in ids_of if d not in held]:
            del ids_of[d]
        arrays = [pa.array([d for d, _ in docs], key), *(pa.array(np.array(c, np.int64)) for c in (cols[1], cols[2], cols[3], [n for _, n in docs], np.array(cols[4], np.int64) + base, cols[5]))]
        return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

    for batch in batches:
        for lo, hi, block in blocks(batch.column(1)):
            flat, first = encode(block)
            for i, doc in enumerate(batch.column(0).slice(lo, hi - lo).to_pylist()):
                ids = np.append(flat[first[i] : first[i + 1]], np.uint32(END_ID))
                ids_of[number] = (doc, len(ids))
                packer.add(number, ids)
                number += 1
            yield rows()
    packer.finish()
    yield rows()


def pack(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per piece: key, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    Every task packs its own rows as they come, so nothing is shuffled and no window crosses a
    partition; a rerun of a task gives the same rows. Null and empty texts are the end id alone.
    Repeated rows are packed each; null keys stay null. An empty table gives no rows.
    """
    ship(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        partial(_pack, tokenizer=tokenizer, capacity=capacity, key=arrow_type(kind)), f"doc_id {kind}, {FIELDS}"
    )

