"""Packing of token sequences by vector bin packing with the dot-product heuristic.

Every piece of a document is a vector of tokens, one segment, and loss-bearing tokens; a
sequence has a capacity in each. A piece goes to the open sequence whose remaining
capacity has the largest dot product with the piece, both in units of the capacity, among
those it fits. Where it fits none and the pool of open sequences is full, the sequence
with the fewest free tokens is filled up with a cut from the piece and closed. Each task
packs the rows it reads, so nothing is shuffled and at most ``pool`` sequences are held.

Token lists longer than a sequence are cut into full sequences first. At the end of a task
the open sequences are merged, cutting freely, so that a task leaves one sequence that is
not full; that one is parted at powers of two, which need no padding.

Defined cases: NULL or empty text is the end id alone; NULL doc_id is kept; repeated rows
are packed each for itself; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starlane.llm.files import lean, table
from starlane.llm.tokens import encoder, portions

VOCABULARY = "word_bpe_49k.json"
END_ID = 2
#: A task holds open sequences and rows besides; some 60 bytes a word, twice at most.
CACHED_PIECES = 400_000

PIECES = "doc_id long, start long, length long, doc_tokens long, loss_tokens long, sequence_id long, offset long, ids array<int>"
CHECKED = PIECES.replace("ids array<int>", "ids_crc32 long")


@dataclass
class Limits:
    """Capacities of a sequence. Every piece has at least one segment and one token."""

    tokens: int = 4096
    segments: int = 512
    loss: int = 4096


class Packer:
    """Packs (doc_id, ids, loss flags) given one after the other; ``add`` and ``finish`` give closed sequences.

    The free tokens, segments and loss-bearing tokens of the open sequences are the first
    rows of one array; a closed one is replaced by the last.
    """

    def __init__(self, limits: Limits, pool: int = 48):
        self.limits, self.pool = limits, pool
        self.capacity = np.array([limits.tokens, limits.segments, limits.loss], dtype=float)
        self.open: list[list] = []
        self.free = np.zeros((pool, 3))

    def add(self, doc_id, ids: np.ndarray, flags: np.ndarray) -> Iterator[list]:
        total, loss = len(ids), int(np.count_nonzero(flags))
        if total <= self.limits.tokens and loss <= self.limits.loss:
            return self._place([(doc_id, 0, ids, total, loss, flags)])
        counts = np.zeros(total + 1, dtype=np.int64)
        np.cumsum(flags, out=counts[1:])
        return self._place([(doc_id, a, ids[a:b], total, int(counts[b] - counts[a]), flags[a:b]) for a, b in self._cuts(counts)])

    def _cuts(self, counts: np.ndarray) -> Iterator[tuple[int, int]]:
        """Spans that fit an empty sequence, longest first from the front."""
        a, total = 0, len(counts) - 1
        while a < total:
            b = min(total, a + self.limits.tokens)
            b = min(b, max(a + 1, int(np.searchsorted(counts, counts[a] + self.limits.loss, side="right")) - 1))
            yield a, b
            a = b

    def _place(self, todo: list) -> Iterator[list]:
        todo = todo[::-1]
        while todo:
            p = todo.pop()
            k = self._best(len(p[2]), p[4])
            if k is None and len(self.open) < self.pool:
                k = len(self.open)
                self.open.append([])
                self.free[k] = self.capacity
            if k is not None:
                yield from self._put(k, p)
                continue
            k = int(self.free[:, 0].argmin())
            head, tail = self._split(p, self.free[k])
            if tail is not None:
                todo.append(tail)
            chosen = self.open[k]
            if head is not None:
                yield from self._put(k, head)
            if tail is not None and k < len(self.open) and self.open[k] is chosen:
                yield self._close(k)  # segments or loss are used up

    def _best(self, tokens: int, loss: int) -> int | None:
        """The open sequence that a piece fits with the largest dot product, the first of equal ones."""
        free = self.free[: len(self.open)]
        fits = ((free[:, 0] >= tokens) & (free[:, 1] >= 1) & (free[:, 2] >= loss)).nonzero()[0]
        if len(fits) < 2:
            return int(fits[0]) if len(fits) else None
        score = free[fits] @ (np.array([tokens, 1, loss]) / self.capacity / self.capacity)
        return int(fits[score.argmax()])

    def _split(self, p, free: np.ndarray):
        """The longest front of a piece that fits, and what is left."""
        if free[1] < 1:
            return None, p
        n = min(len(p[2]), int(free[0]))
        if p[4] > free[2]:
            n = min(n, int(np.searchsorted(np.cumsum(p[5]), free[2], side="right")))
        if n == 0:
            return None, p
        if n == len(p[2]):
            return p, None
        loss = int(p[5][:n].sum())
        return (*p[:2], p[2][:n], p[3], loss, p[5][:n]), (p[0], p[1] + n, p[2][n:], p[3], p[4] - loss, p[5][n:])

    def _put(self, k: int, p) -> Iterator[list]:
        self.open[k].append(p)
        free = self.free[k]
        free -= (len(p[2]), 1, p[4])
        if free[0] <= 0 or free[1] <= 0:
            yield self._close(k)

    def _close(self, k: int) -> list:
        pieces, last = self.open[k], len(self.open) - 1
        self.free[k] = self.free[last]
        self.open[k] = self.open[last]
        self.open.pop()
        return pieces

    def finish(self) -> Iterator[list]:
        """Merge the open sequences into as few as the limits allow."""
        rest = sorted(self.open, key=lambda pieces: sum(len(p[2]) for p in pieces), reverse=True)
        pieces = [p for s in rest for p in s]
        self.open, self.free, self.pool = [], np.zeros((1, 3)), 1
        yield from self._place(pieces)
        for left in self.open:
            yield from self._powers_of_two(left)
        self.open = []

    def _powers_of_two(self, pieces: list) -> Iterator[list]:
        left = sum(len(p[2]) for p in pieces)
        todo, out = pieces[::-1], []
        while left:
            room = size = 1 << (left.bit_length() - 1)
            while room:
                head, tail = self._split(todo.pop(), np.array([room, 1, np.inf]))
                out.append(head)
                room -= len(head[2])
                if tail is not None:
                    todo.append(tail)
            yield out
            out, left = [], left - size


def pack(
    docs: DataFrame, vocabulary: str, limits: Limits | None = None, end_id: int = END_ID, loss_from: int = 1, checksums: bool = False,
    cached_pieces: int = CACHED_PIECES,
) -> DataFrame:
    """One row per piece: its document and place there, its sequence and place there, its ids.

    ``loss_from`` is the number of tokens at a document's start that bear no loss: the first
    token of a document is predicted from nothing. With ``checksums`` each piece's ids are
    turned into the crc32 of their little-endian unsigned 32-bit form (ids_crc32) where they
    are packed, rather than moved. ``cached_pieces`` bounds what a worker holds; fewer cost time only.
    """
    limits = limits or Limits()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, packer, end = encoder(vocabulary, cached_pieces), Packer(limits), np.array([end_id], dtype="<u4")
        bearing = np.ones(limits.tokens, dtype=np.int8)
        bearing[:loss_from] = 0
        base, made = TaskContext.get().partitionId() << 33, 0

        def documents():
            for batch in batches:
                for some in portions(batch):
                    keys = some.column(0).to_pylist()
                    for key, ids in zip(keys, tokens.encode(some.column(1).to_pylist())):
                        yield key, np.concatenate((ids, end))

        def closed():
            nonlocal bearing
            for key, ids in documents():
                if len(ids) > len(bearing):
                    bearing = np.concatenate((bearing, np.ones(len(ids), dtype=np.int8)))
                yield from packer.add(key, ids, bearing[: len(ids)])
            yield from packer.finish()

        rows: list[tuple] = []
        size = 0
        for pieces in closed():
            offset = 0
            for key, start, ids, total, loss, _ in pieces:
                rows.append((key, start, len(ids), total, loss, base + made, offset, zlib.crc32(ids) if checksums else ids))
                offset += len(ids)
            size += offset
            made += 1
            if size >= 1_000_000:
                yield batch_of(rows, checksums)
                rows, size = [], 0
        if rows:
            yield batch_of(rows, checksums)

    return docs.select("doc_id", F.col("text")).mapInArrow(lean(run), CHECKED if checksums else PIECES)


def batch_of(rows: list[tuple], checksums: bool) -> pa.RecordBatch:
    *plain, ids = zip(*rows)
    if checksums:
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in (*plain, ids)], [c.split()[0] for c in CHECKED.split(", ")])
    ends = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
    values = pa.array(np.concatenate(ids).astype(np.int32))
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in plain] + [pa.ListArray.from_arrays(pa.array(ends), values)],
        ["doc_id", "start", "length", "doc_tokens", "loss_tokens", "sequence_id", "offset", "ids"],
    )


def packed_documents(docs: DataFrame, cached_pieces: int = CACHED_PIECES) -> DataFrame:
    return pack(docs, public_tokenizers.path(VOCABULARY), checksums=True, cached_pieces=cached_pieces)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_documents(table(spark, sf_dir, "documents"))
