"""Bounded-space online best-fit packing of tokenised documents into fixed-length sequences.

Every scan partition packs its own documents as they stream by, so there is no shuffle and a lost task is simply run
again. A fixed number of bins is open at a time. They hang in lists by free space, with a bitset of the spaces that occur:
the best bin is the lowest set bit at or above the piece's length. A piece that fits nowhere opens a bin; if all places
are taken, the fullest bin closes first.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from . import tokens
from .common import lean, list_column, texts

LENGTH, OPEN_BINS = 2048, 512
FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class OpenBins:
    def __init__(self, length: int = LENGTH, open_bins: int = OPEN_BINS):
        self.length, self.open_bins = length, open_bins
        self.by_free: list[list[int]] = [[] for _ in range(length + 1)]
        self.mask = self.count = self.made = 0

    def _take(self, free: int) -> int:
        bin_id = self.by_free[free].pop()
        if not self.by_free[free]:
            self.mask &= ~(1 << free)
        self.count -= 1
        return bin_id

    def place(self, size: int) -> tuple[int, int]:
        """The bin and offset of a piece of 1 to length tokens."""
        if fits := self.mask >> size:
            free = size + (fits & -fits).bit_length() - 1
            bin_id = self._take(free)
        else:
            bin_id, free = self.made, self.length
            self.made += 1
        left = free - size
        if left:
            if self.count >= self.open_bins:
                self._take((self.mask & -self.mask).bit_length() - 1)  # the fullest closes
            self.by_free[left].append(bin_id)
            self.mask |= 1 << left
            self.count += 1
        return bin_id, self.length - free


def pieces(size: int, length: int = LENGTH) -> list[tuple[int, int]]:
    """Start and length of each piece: full ones after a first that takes the remainder."""
    first = size % length or min(size, length)
    return [(0, first), *((at, length) for at in range(first, size, length))]


def _pack(path: str, end_id: int, length: int, open_bins: int, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, bins, high = tokens.encoder(path), OpenBins(length, open_bins), TaskContext.get().partitionId() << 36
        for batch in batches:
            rows, parts = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ids = np.append(enc.ids(text), np.uint32(end_id)).astype("<u4")
                for k, (at, n) in enumerate(pieces(len(ids), length)):
                    bin_id, offset = bins.place(n)
                    part = ids[at : at + n]
                    rows.append((doc, k, at, n, zlib.crc32(part.tobytes()), high | bin_id, offset))
                    parts.append(part)
            if not rows:
                continue
            kinds = (pa.int64(), pa.int32(), *[pa.int64()] * 5)
            columns = [pa.array(c, kind) for c, kind in zip(zip(*rows), kinds)]
            names = [f.split()[0] for f in FIELDS.split(", ")]
            yield pa.RecordBatch.from_arrays(columns + ([list_column(parts, pa.int32())] if with_ids else []), names + ["ids"] * with_ids)

    return run


def pack(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, length: int = LENGTH, open_bins: int = OPEN_BINS, with_ids: bool = True) -> DataFrame:
    """One row for each piece of each document: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids).

    A document's ids end with end_id, so an empty or null text is one piece of one token. Only documents of over length
    tokens are cut, however long. Rows with equal or null doc_id, and repeated rows, are packed like any others; of equally
    full bins any takes a piece. No rows give no pieces; other columns are not read.
    """
    return texts(docs).mapInArrow(lean(_pack(tokenizer or tokens.default_path(), end_id, length, open_bins, with_ids)), FIELDS + ", ids array<int>" * with_ids)
