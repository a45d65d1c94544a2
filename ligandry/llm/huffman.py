"""Token ids as canonical length-limited Huffman code, and back.

Encoding has two passes: tokenise into a scratch table, where each task leaves its counts of ids too, then write segments
in doc_id order. A segment
is one self-contained binary: header, tokens of each document, a bit offset for every block of BLOCK tokens, payload.
Blocks decode independently, so a reader steps through all blocks of a segment at once with one table look-up a step.
The code book is one byte of code length for each id; canonical codes follow from it.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import tokens
from .common import drop, lean, list_column, scratch, shuffle_partitions, texts, workdir

MAGIC, BLOCK, LIMIT, SEGMENT = b"LHF1", 512, 17, 1 << 20
#: Tokens coded at a time, a multiple of BLOCK, and documents counted at a time: what they need stays in the cache.
CHUNK, COUNTED = 64 * BLOCK, 64
_HEAD = struct.Struct("<4sIQIQ")  # magic, documents, tokens, blocks, bits


def code_lengths(counts: np.ndarray, limit: int = LIMIT) -> np.ndarray:
    """Optimal prefix-code lengths of at most limit bits for each id with a count (package-merge); 0 for the others."""
    lengths = np.zeros(len(counts), np.uint8)
    used = np.flatnonzero(counts)
    if len(used) <= 1:
        lengths[used] = 1
        return lengths
    limit = max(limit, int(np.ceil(np.log2(len(used)))))
    used = used[np.argsort(counts[used], kind="stable")]
    leaves = counts[used].astype(np.int64)
    packages, leaf_at = np.empty(0, np.int64), []
    for _ in range(limit):
        merged = np.concatenate([leaves, packages])
        order = np.argsort(merged, kind="stable")
        leaf_at.append(order < len(leaves))
        merged = merged[order]
        merged = merged[: len(merged) // 2 * 2]
        packages = merged[0::2] + merged[1::2]
    depth, take = np.zeros(len(used), np.int64), 2 * len(used) - 2
    for is_leaf in reversed(leaf_at):
        n = int(is_leaf[:take].sum())
        depth[:n] += 1
        take = 2 * (take - n)
    lengths[used] = depth
    return lengths


def canonical_codes(lengths: np.ndarray) -> np.ndarray:
    """Codes in order of (length, id): each the one before plus one, shifted to its length."""
    codes = np.zeros(len(lengths), np.uint64)
    code, before = 0, 0
    for i in np.lexsort((np.arange(len(lengths)), lengths)):
        if n := int(lengths[i]):
            code <<= n - before
            codes[i], before = code, n
            code += 1
    return codes


def code_book(lengths: np.ndarray) -> np.ndarray:
    return canonical_codes(lengths) << np.uint64(8) | lengths


def decode_table(lengths: np.ndarray) -> tuple[int, np.ndarray]:
    """Bits to look at, and for each value of them the id, shifted left by 5, and its code length."""
    width = int(lengths.max(initial=1))
    table = np.ones(1 << width, np.uint32)
    used = np.flatnonzero(lengths)
    used = used[np.lexsort((used, lengths[used]))]
    spans = (np.uint64(1) << (width - lengths[used].astype(np.uint64))).astype(np.int64)
    table[: spans.sum()] = np.repeat(used.astype(np.uint32) << 5 | lengths[used], spans)
    return width, table


def encode_segment(doc_sizes: np.ndarray, ids: np.ndarray, book: np.ndarray) -> bytes:
    """book: for each id its code, shifted left by 8, and the code's length (at most 32)."""
    words, offsets, bits = np.zeros(len(ids) + 2, np.uint32), [], 0
    for a in range(0, len(ids), CHUNK):
        code = book[ids[a : a + CHUNK]]
        size = (code & np.uint64(255)).astype(np.int64)
        code >>= np.uint64(8)
        ends = np.cumsum(size)
        ends += bits
        starts, bits = ends - size, int(ends[-1])
        word = starts >> 5
        code <<= (64 - (starts & 31) - size).astype(np.uint64)  # in place in the 64 bits from its first word on
        first = np.concatenate([[0], np.flatnonzero(np.diff(word)) + 1])
        joined, at = np.bitwise_or.reduceat(code, first), word[first]
        words[at] |= (joined >> np.uint64(32)).astype(np.uint32)
        words[at + 1] |= joined.astype(np.uint32)
        offsets.append(starts[::BLOCK])
    words = words[: (bits + 31) // 32 + 1]
    offsets = np.concatenate([np.empty(0, np.int64), *offsets]).astype("<u8")
    return _HEAD.pack(MAGIC, len(doc_sizes), len(ids), len(offsets), bits) + doc_sizes.astype("<u4").tobytes() + offsets.tobytes() + words.astype(">u4").tobytes()


def decode_segment(blob: bytes, table: tuple[int, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each document, and all ids, of one segment."""
    magic, n_docs, n, n_blocks, bits = _HEAD.unpack_from(blob)
    if magic != MAGIC:
        raise ValueError("not a segment of this format")
    at = _HEAD.size
    doc_sizes = np.frombuffer(blob, "<u4", n_docs, at).astype(np.int64)
    pos = np.frombuffer(blob, "<u8", n_blocks, at + 4 * n_docs).astype(np.int64)
    payload = np.frombuffer(blob, np.uint8, offset=at + 4 * n_docs + 8 * n_blocks)
    b = np.concatenate([payload, np.zeros(4, np.uint8)]).astype(np.uint32)
    window = (b[:-3] << 24) | (b[1:-2] << 16) | (b[2:-1] << 8) | b[3:]
    width, values = table
    out, full = np.zeros((BLOCK, n_blocks), np.uint32), n // BLOCK
    for step in range(min(BLOCK, n)):
        if full < n_blocks and step >= n - full * BLOCK:
            pos = pos[:full]
            full = n_blocks
        k = len(pos)
        got = values[(window[pos >> 3] << (pos & 7).astype(np.uint32)) >> np.uint32(32 - width)]
        out[step, :k] = got
        pos = pos + (got & 31)
    return doc_sizes, out.T.reshape(-1)[:n] >> 5


_TOKENISED = pa.schema([("doc_id", pa.int64()), ("ids", pa.binary()), ("n", pa.int32()), ("counts", pa.binary())])


def _tokenise(path: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = tokens.encoder(path)
        kind, total = "<u2" if enc.whole.get_vocab_size() <= 1 << 16 else "<u4", np.zeros(1, np.int64)
        end = np.array([end_id], "<u4")
        for batch in batches:
            ids = [np.concatenate([enc.ids(t), end]) for t in batch.column(1).to_pylist()]
            if not ids:
                continue
            for a in range(0, len(ids), COUNTED):
                got = np.bincount(np.concatenate(ids[a : a + COUNTED]))
                if len(got) > len(total):
                    total = np.pad(total, (0, len(got) - len(total)))
                total[: len(got)] += got
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.astype(kind).tobytes() for x in ids], pa.binary()), pa.array([len(x) for x in ids], pa.int32()), pa.nulls(len(ids), pa.binary())], schema=_TOKENISED)
        if total.any():
            yield pa.RecordBatch.from_pylist([{"counts": total.astype("<i8").tobytes()}], schema=_TOKENISED)

    return run


def _unpack(raw: bytes, n: int) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == 2 * n else "<u4").astype(np.uint32)


def tokenised(docs: DataFrame, tokenizer: str, end_id: int = 0) -> DataFrame:
    """doc_id, ids (little-endian binary, two bytes an id if the vocabulary allows, else four), n of every document.

    After its documents each task adds one row with counts only: how often each id occurs in them.
    """
    return texts(docs).mapInArrow(lean(_tokenise(tokenizer, end_id)), "doc_id long, ids binary, n int, counts binary")


def _add_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(1, np.int64)
    for batch in batches:
        for raw in batch.column(0).to_pylist():
            got = np.frombuffer(raw, "<i8")
            if len(got) > len(total):
                total = np.pad(total, (0, len(got) - len(total)))
            total[: len(got)] += got
    ids = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int32()), pa.array(total[ids], pa.int64())], ["id", "n"])


def _encode(lengths):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        book, part, seq, before = lengths.value, TaskContext.get().partitionId(), 0, 0

        def segment(docs, arrays):
            nonlocal seq, before
            sizes = np.array([len(x) for x in arrays], np.int64)
            blob = encode_segment(sizes, np.concatenate(arrays), book)
            row = pa.RecordBatch.from_pydict({"part": [part], "seq": [seq], "start": [before], "n_tokens": [int(sizes.sum())], "doc_ids": [docs], "segment": [blob]}, schema=_SEGMENTS)
            seq, before = seq + 1, before + int(sizes.sum())
            return row

        docs, arrays, held = [], [], 0
        for batch in batches:
            for doc, raw, n in zip(*(c.to_pylist() for c in batch.columns)):
                docs.append(doc)
                arrays.append(_unpack(raw, n))
                held += n
                if held >= SEGMENT:
                    yield segment(docs, arrays)
                    docs, arrays, held = [], [], 0
        if docs:
            yield segment(docs, arrays)

    return run


_SEGMENTS = pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("segment", pa.binary())])


def write_tokens(docs: DataFrame, path: str, tokenizer: str | None = None, end_id: int = 0, limit: int = LIMIT) -> None:
    """Write the token ids of all documents to path: `segments` in doc_id order, and `codebook`.

    Each document's ids end with end_id. Null texts count as empty; rows with equal doc_id stay apart, in the order of
    their ids; a null doc_id comes first. An empty table gives no segment. Ids with equal counts get codes in the order of
    ids; a very long text is one segment; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = workdir(spark, "ids")
    tokenised(docs, tokenizer or tokens.default_path(), end_id).write.option("compression", "zstd").parquet(scratch)
    ids = spark.read.parquet(scratch)
    counted = ids.where("counts IS NOT NULL").select("counts").mapInArrow(lean(_add_counts), "id int, n long").groupBy("id").agg(F.sum("n").alias("n")).collect()  # one row an id of the vocabulary at most
    counts = np.zeros(max((r.id for r in counted), default=0) + 1, np.int64)
    for r in counted:
        counts[r.id] = r.n
    lengths = code_lengths(counts, limit)
    shared = spark.sparkContext.broadcast(code_book(lengths))
    ordered = ids.where("n IS NOT NULL").select("doc_id", "ids", "n").repartitionByRange(shuffle_partitions(docs), "doc_id").sortWithinPartitions("doc_id", "ids")
    ordered.mapInArrow(lean(_encode(shared)), "part int, seq int, start long, n_tokens long, doc_ids array<long>, segment binary").write.option("compression", "uncompressed").parquet(f"{path}/segments")
    spark.createDataFrame([(bytearray(lengths.tobytes()),)], "lengths binary").coalesce(1).write.parquet(f"{path}/codebook")
    drop(ids)


def _decode(lengths, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        look_up = decode_table(lengths.value)
        for batch in batches:
            for start, docs, blob in zip(*(c.to_pylist() for c in batch.columns)):
                sizes, ids = decode_segment(blob, look_up)
                ends = np.cumsum(sizes)
                parts = [ids[a:b].astype("<u4") for a, b in zip(ends - sizes, ends)]
                columns = [pa.array(docs, pa.int64()), pa.array(start + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()), pa.array([zlib.crc32(x.tobytes()) for x in parts], pa.int64())]
                names = ["doc_id", "start", "n_tokens", "ids_crc32"]
                yield pa.RecordBatch.from_arrays(columns + ([list_column(parts, pa.int64())] if with_ids else []), names + ["ids"] * with_ids)

    return run


def read_tokens(spark, path: str, with_ids: bool = True) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 (and ids) of each document in the files at path."""
    book = spark.read.parquet(f"{path}/codebook").first()
    shared = spark.sparkContext.broadcast(np.frombuffer(bytes(book.lengths), np.uint8))
    segments = spark.read.parquet(f"{path}/segments")
    sizes = sorted(segments.groupBy("part").agg(F.sum("n_tokens").alias("n")).collect())  # a row for each partition written
    bases, at = [], 0
    for part, n in sizes:
        bases.append((part, at))
        at += n
    base = spark.createDataFrame(bases, "part int, base long")
    placed = segments.join(F.broadcast(base), "part").select((F.col("start") + F.col("base")).alias("start"), "doc_ids", "segment")  # as many rows as partitions
    return placed.mapInArrow(lean(_decode(shared, with_ids)), "doc_id long, start long, n_tokens long, ids_crc32 long" + ", ids array<long>" * with_ids)


def round_trip(docs: DataFrame, tokenizer: str | None = None, end_id: int = 0, with_ids: bool = True) -> DataFrame:
    """Write the ids of docs to a fresh shared folder and read them back."""
    path = workdir(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_tokens(docs.sparkSession, scratch(docs.sparkSession, path), with_ids)
