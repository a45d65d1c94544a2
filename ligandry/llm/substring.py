"""Exact removal of repeated passages: words covered by a window of WINDOW words that starts in an earlier document too.

Windows are dealt by minimiser. In each document the minimiser of a window is the smallest hash of its runs of M words;
consecutive windows with the same minimiser form a super-k-mer and travel as one packed string of words to the bucket of
that minimiser, where all windows of equal words meet. A bucket turns words into codes, sorts its windows by hash, checks
code by code that a run of equal hashes is one sequence, and reports the windows whose sequence has an earlier document.

Skew: a map task settles repeats among its own documents first, in chunks of CHUNK bytes. Of equal windows in a chunk only
the earliest document's go on, so a passage that a third of all rows share reaches its bucket once for each chunk, not
once for each row. A bucket holds at most HELD bytes of strings before it settles what it has; of equal windows it then
keeps the earliest only, so what a hot bucket holds is its distinct windows, however often they come. Settled windows travel
as runs, dealt by document.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import lean, mix, shingle_hashes, shuffle_partitions, word_hashes, written

WINDOW, M, CHUNK, HELD = 13, 4, 4 << 20, 24 << 20


def _codes(words: list[bytes]) -> np.ndarray:
    """Equal words, equal codes; nothing but equality counts."""
    return pa.array(words, pa.binary()).dictionary_encode().indices.to_numpy(zero_copy_only=False).astype(np.int32)


def repeated(codes: np.ndarray, hashes: np.ndarray, starts: np.ndarray, owner: np.ndarray, window: int) -> np.ndarray:
    """For each window (codes[start : start + window]), whether its sequence also has a smaller owner.

    hashes only bring equal windows together in the sort; runs of one hash are compared code by code, and split where
    they differ.
    """
    out = np.zeros(len(starts), bool)
    if not len(starts):
        return out
    order = np.lexsort((owner, hashes))
    h = hashes[order]
    new = np.empty(len(h), bool)
    new[0] = True
    np.not_equal(h[1:], h[:-1], out=new[1:])
    lead = np.flatnonzero(new)
    run = np.cumsum(new) - 1
    size = np.diff(np.append(lead, len(h)))
    keep = np.flatnonzero(size[run] > 1)
    a, b = starts[order[keep]], starts[order[lead[run[keep]]]]
    same = np.ones(len(keep), bool)
    for j in range(window):
        same &= codes[a + j] == codes[b + j]
    least = owner[order[lead[run[keep]]]]
    out[order[keep]] = same & (owner[order[keep]] > least)
    for r in np.unique(run[keep[~same]]):  # two sequences with one hash: compare them outright
        rows = order[lead[r] : lead[r] + size[r]]
        by: dict[bytes, int] = {}
        for i in rows:
            by.setdefault(codes[starts[i] : starts[i] + window].tobytes(), owner[i])
        for i in rows:
            out[i] = owner[i] > by[codes[starts[i] : starts[i] + window].tobytes()]
    return out


def _minimisers(h: np.ndarray, window: int, m: int) -> np.ndarray:
    runs = shingle_hashes(h, m)
    low = runs[: len(h) - window + 1].copy()
    for j in range(1, window - m + 1):
        np.minimum(low, runs[j : j + len(low)], out=low)
    return low


def _deal(window: int, m: int, buckets: int):
    """From (doc_id, tkey, text) to strings for the buckets, and windows already settled in this chunk."""

    def chunk(docs: list[int], keys: list[int], raws: list[bytes]) -> Iterator[pa.RecordBatch]:
        order = np.argsort(np.array(docs, np.int64), kind="stable")
        docs, keys, raws = [docs[i] for i in order], [keys[i] for i in order], [raws[i] for i in order]
        words = [r.split() for r in raws]
        n_of = np.array([len(w) for w in words])
        base = np.cumsum(n_of) - n_of
        flat = [x for w in words for x in w]
        codes, h = _codes(flat), np.concatenate([np.empty(0, np.uint64), *(word_hashes(r) for r in raws)])
        starts, mins, doc_at = [], [], []
        for d, n in enumerate(n_of):
            if n >= window:
                starts.append(np.arange(base[d], base[d] + n - window + 1))
                mins.append(_minimisers(h[base[d] : base[d] + n], window, m))
                doc_at.append(np.full(n - window + 1, d))
        if not starts:
            return
        starts, mins, doc_at = np.concatenate(starts), np.concatenate(mins), np.concatenate(doc_at)
        ids = np.array(docs, np.int64)
        _, rank = np.unique(ids, return_inverse=True)
        full = shingle_hashes(h, window)
        known = repeated(codes, full[starts], starts, rank[doc_at], window)
        new = np.ones(len(starts), bool)
        new[1:] = (mins[1:] != mins[:-1]) | (doc_at[1:] != doc_at[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(starts)) - 1
        unsettled = np.add.reduceat((~known).astype(np.int64), first) > 0
        first, last = first[unsettled], last[unsettled]
        bucket = (mins[first] % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        cuts = np.flatnonzero(np.diff(bucket[by])) + 1
        press = zstandard.ZstdCompressor(level=1)
        out_bucket, out_blob = [], []
        for part in np.split(by, cuts):
            if not len(part):
                continue
            a, z, d = starts[first[part]], starts[last[part]] + window, doc_at[first[part]]
            strings = [b" ".join(flat[i:j]) for i, j in zip(a.tolist(), z.tolist())]
            head = np.array([[docs[x] for x in d], [keys[x] for x in d], (a - base[d]).tolist()], np.int64)
            out_bucket.append(int(bucket[part[0]]))
            out_blob.append(press.compress(struct.pack("<I", len(part)) + head.tobytes() + b"\n".join(strings)))
        yield _rows(out_bucket, [None] * len(out_bucket), [None] * len(out_bucket), out_blob)
        hit = np.flatnonzero(known)
        if len(hit):
            yield _settled(np.array(docs)[doc_at[hit]], np.array(keys)[doc_at[hit]], starts[hit] - base[doc_at[hit]], buckets)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs, keys, raws, held, seen = [], [], [], 0, set()
        for batch in batches:
            for doc, key, text in zip(*(c.to_pylist() for c in batch.columns)):
                if (doc, key) in seen:  # the same row again: what is found for one holds for both
                    continue
                seen.add((doc, key))
                raw = text.encode("utf-8", "surrogatepass")
                docs.append(doc)
                keys.append(key)
                raws.append(raw)
                held += len(raw)
                if held >= CHUNK:
                    yield from chunk(docs, keys, raws)
                    docs, keys, raws, held, seen = [], [], [], 0, set()
        if docs:
            yield from chunk(docs, keys, raws)

    return run


_SCHEMA = pa.schema([("bucket", pa.int64()), ("doc_id", pa.int64()), ("tkey", pa.int64()), ("blob", pa.binary())])


def _rows(bucket, docs, keys, blobs) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip((bucket, docs, keys, blobs), _SCHEMA)], schema=_SCHEMA)


def _settled(docs: np.ndarray, keys: np.ndarray, at: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Window starts found repeated, as runs (start, windows), one row for each document."""
    order = np.lexsort((at, keys, docs))
    docs, keys, at = docs[order], keys[order], at[order]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(docs) != 0) | (np.diff(keys) != 0)
    breaks = new.copy()
    breaks[1:] |= np.diff(at) > 1
    run = np.flatnonzero(breaks)
    ends = np.append(run[1:], len(at)) - 1
    runs = np.stack([at[run], at[ends] - at[run] + 1], 1).astype("<i4")
    first = np.flatnonzero(new)
    dealt = (mix(docs[first].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
    return _rows(dealt.tolist(), docs[first].tolist(), keys[first].tolist(), [x.tobytes() for x in np.split(runs, np.searchsorted(run, first[1:]))])


class _Bucket:
    """Super-k-mers of one bucket."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.heads: list[np.ndarray] = []
        self.strings: list[bytes] = []
        self.held, self.limit = 0, HELD

    def add(self, blob: bytes) -> Iterator[pa.RecordBatch]:
        raw = zstandard.ZstdDecompressor().decompress(blob)
        n = struct.unpack_from("<I", raw)[0]
        self.heads.append(np.frombuffer(raw, np.int64, 3 * n, 4).reshape(3, n))
        self.strings += raw[4 + 24 * n :].split(b"\n")
        self.held += len(raw)
        if self.held >= self.limit:
            yield from self.settle(keep=True)
            self.limit = max(HELD, 2 * self.held)

    def settle(self, keep: bool = False) -> Iterator[pa.RecordBatch]:
        """Report windows with an earlier document; with keep, go on with the others."""
        if not self.strings:
            return
        docs, keys, at = np.concatenate(self.heads, axis=1)
        n_of = np.array([s.count(b" ") + 1 for s in self.strings])
        joined = b" ".join(self.strings)
        words = joined.split(b" ")
        codes, h = _codes(words), word_hashes(joined)
        base = np.cumsum(n_of) - n_of
        n_win = n_of - self.window + 1
        which = np.repeat(np.arange(len(n_of)), n_win)
        inner = np.arange(len(which)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
        starts = base[which] + inner
        known = repeated(codes, shingle_hashes(h, self.window)[starts], starts, docs[which], self.window)
        hit = np.flatnonzero(known)
        if len(hit):
            yield _settled(docs[which[hit]], keys[which[hit]], at[which[hit]] + inner[hit], self.buckets)
        self.heads, self.strings, self.held = [], [], 0
        left = np.flatnonzero(~known)
        if keep and len(left):
            new = np.ones(len(left), bool)
            new[1:] = (np.diff(left) != 1) | (np.diff(which[left]) != 0)
            first = left[np.flatnonzero(new)]
            last = left[np.append(np.flatnonzero(new)[1:], len(left)) - 1]
            self.heads = [np.stack([docs[which[first]], keys[which[first]], at[which[first]] + inner[first]])]
            self.strings = [b" ".join(words[i:j]) for i, j in zip(starts[first].tolist(), (starts[last] + self.window).tolist())]
            self.held = sum(map(len, self.strings)) + 24 * len(first)


def _match(window: int, buckets: int):
    """Windows of each bucket whose words have an earlier document. Rows come sorted by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, bucket = None, _Bucket(window, buckets)
        for batch in batches:
            passed = batch.filter(pc.is_valid(batch.column(1)))
            if passed.num_rows:
                yield passed
            for b, doc, blob in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(3).to_pylist()):
                if doc is not None:
                    continue
                if b != now:
                    yield from bucket.settle()
                    now, bucket = b, _Bucket(window, buckets)
                yield from bucket.add(blob)
        yield from bucket.settle()

    return run


def _cut(window: int):
    """Words kept, from (doc_id, text, runs of windows found)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, found in zip(batch.column("text").to_pylist(), batch.column("found").to_pylist()):
                words = text.encode("utf-8", "surrogatepass").split()
                gone = 0
                if found:
                    at, n = np.concatenate([np.frombuffer(x, "<i4").reshape(-1, 2) for x in found]).T
                    edge = np.zeros(len(words) + 1, np.int64)
                    np.add.at(edge, at, 1)
                    np.subtract.at(edge, at + n - 1 + window, 1)
                    covered = np.cumsum(edge[:-1]) > 0
                    gone = int(covered.sum())
                    words = [w for w, c in zip(words, covered.tolist()) if not c]
                n_words.append(len(words) + gone)
                n_removed.append(gone)
                kept.append(b" ".join(words).decode("utf-8", "surrogatepass"))
            rest = [batch.column(i) for i in range(batch.num_columns) if batch.schema.names[i] != "found"]
            names = [n for n in batch.schema.names if n != "found"]
            yield pa.RecordBatch.from_arrays(rest + [pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())], names + ["n_words", "n_removed", "kept_text"])

    return run


def remove_repeats(docs: DataFrame, window: int = WINDOW, m: int = M, bucket_factor: int = 16, carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, text, carried (the columns named in carry), n_words, n_removed, kept_text of every document.

    Words are runs of bytes other than ASCII white space, compared unchanged. A null text has none. A row without doc_id is
    neither earlier nor later than any other and is kept whole. Rows with equal doc_id count as one document: none removes
    words of another; where their texts are equal too, each gets the same result. A text shorter than a window loses
    nothing; very long texts are cut up like any others. Empty tables give no rows. Columns with names used here are safe in
    carry. Buckets: bucket_factor for each partition, whose number grows with the input.
    """
    parts = shuffle_partitions(docs)
    buckets = bucket_factor * parts
    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *([F.struct(*carry).alias("carried")] if carry else [])).withColumn("tkey", F.xxhash64("text"))
    dealt = keyed.where("doc_id is not null").select("doc_id", "tkey", "text").mapInArrow(lean(_deal(window, m, buckets)), "bucket long, doc_id long, tkey long, blob binary")
    met = dealt.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(lean(_match(window, buckets)), "bucket long, doc_id long, tkey long, blob binary")
    settled = written(met.select("doc_id", "tkey", "blob"), "windows")
    found = settled.groupBy("doc_id", "tkey").agg(F.collect_set("blob").alias("found"))  # repeated rows have the same runs
    joined = keyed.join(found, ["doc_id", "tkey"], "left").drop("tkey")
    kept = [f for f in joined.schema.fields if f.name != "found"]
    counted = [T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_text", T.StringType())]
    return joined.mapInArrow(lean(_cut(window)), T.StructType([*kept, *counted]))


def without_repeats(docs: DataFrame, **how) -> DataFrame:
    """The documents with repeated words gone from text; those that lose none keep their text as it was."""
    carry = [c for c in docs.columns if c not in ("doc_id", "text")]
    cut = remove_repeats(docs.withColumn("__null", F.col("text").isNull()), carry=[*carry, "__null"], **how)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).when(~F.col("carried.__null"), F.col("text"))
    new = {"doc_id": F.col("doc_id"), "text": text} | {c: F.col(f"carried.`{c}`") for c in carry}
    if "n_chars" in new:
        new["n_chars"] = F.length(text).cast("long")
    return cut.select(*[new[c].alias(c) for c in docs.columns])
