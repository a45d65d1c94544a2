"""Bottom-k sketches of word-shingle hashes: document fingerprints that merge and compare.

A sketch is the k smallest distinct 48-bit hashes, ascending. Sketches of parts merge into the sketch of the whole; two
of them estimate resemblance and containment; one estimates how many distinct shingles its text has. Below k shingles
all of this is exact.
"""

from __future__ import annotations

import base64
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import lean, lower_ascii, shingle_hashes, shuffle_partitions, texts, word_hashes

K, SHINGLE, BITS = 128, 5, 48
GROUP_ROWS = 2_000


def sketch(text: str | None, k: int = K, shingle: int = SHINGLE) -> np.ndarray:
    h = shingle_hashes(word_hashes(lower_ascii(text or "")), shingle) >> np.uint64(64 - BITS)
    if len(h) > 4 * k:  # the smallest few first: fewer to sort. Repeats may crowd them, so check before use
        low = np.unique(np.partition(h, 2 * k)[: 2 * k])
        if len(low) > k:
            return low[:k]
    return np.unique(h)[:k]


def merge(*sketches: np.ndarray, k: int = K) -> np.ndarray:
    return np.unique(np.concatenate([np.empty(0, np.uint64), *sketches]))[:k]


def resemblance(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Jaccard estimate; 1 for two empty sketches, 0 if only one is empty."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    union = merge(a, b, k=k)
    both = np.intersect1d(a, b, assume_unique=True)
    return float(np.isin(union, both, assume_unique=True).sum() / len(union))


def distinct(a: np.ndarray, k: int = K) -> float:
    """Distinct shingles of the text behind a sketch."""
    return float(len(a)) if len(a) < k else (k - 1) / ((float(a[k - 1]) + 1) / 2.0**BITS)


def containment(a: np.ndarray, b: np.ndarray, k: int = K) -> float:
    """Estimated part of a's shingles that b has too; 1 if a has none."""
    n = distinct(a, k)
    if not n:
        return 1.0
    if len(a) < k and len(b) < k:
        return len(np.intersect1d(a, b)) / len(a)
    return min(1.0, resemblance(a, b, k) * distinct(merge(a, b, k=k), k) / n)


def to_string(a: np.ndarray) -> str:
    return base64.b64encode(a.astype(">u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()).decode()


def from_string(s: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(s), np.uint8).reshape(-1, BITS // 8)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, 2:] = raw
    return out.view(">u8").reshape(-1).astype(np.uint64)


def fingerprints(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, fingerprint, n_shingles (estimate) of every document; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [sketch(t, k, shingle) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([to_string(x) for x in found], pa.string()), pa.array([distinct(x, k) for x in found], pa.float64())], ["doc_id", "fingerprint", "n_shingles"])

    return texts(docs).mapInArrow(run, "doc_id long, fingerprint string, n_shingles double")


def merged(parts: DataFrame, key: str, k: int = K) -> DataFrame:
    """One fingerprint for each key from those of its parts. Hashes are ranked within salted slices before the key's own
    sort, so that a key with most parts is not one task's work."""
    one = parts.select(key, F.explode(_hashes(F.col("fingerprint"))).alias("h")).distinct()
    slices = Window.partitionBy(key, F.pmod(F.xxhash64("h"), F.lit(64))).orderBy("h")
    few = one.withColumn("r", F.row_number().over(slices)).where(F.col("r") <= k)
    whole = few.groupBy(key).agg(F.slice(F.array_sort(F.collect_list("h")), 1, k).alias("h"))  # 64 k hashes a key at most
    return whole.select(key, F.concat_ws("", F.transform("h", lambda x: F.base64(F.unhex(x)))).alias("fingerprint"))


def _hashes(fingerprint: Column) -> Column:
    """The hashes of a fingerprint as hex strings; base64 of six bytes is eight characters."""
    n = F.length(fingerprint) / 8
    return F.when(n > 0, F.transform(F.sequence(F.lit(0), (n - 1).cast("int")), lambda i: F.hex(F.unbase64(fingerprint.substr(i * 8 + 1, F.lit(8)))))).otherwise(F.array().cast("array<string>"))


def _group_of(doc_id: Column, bounds: list[int]) -> Column:
    """How many of the ascending bounds are at or below doc_id, found in two steps of about the root of their number."""
    if not bounds:
        return F.lit(0).cast("long")
    width = math.isqrt(len(bounds)) + 1
    rows = [bounds[i : i + width] for i in range(0, len(bounds), width)]
    heads, table = F.lit([r[0] for r in rows]), F.array(*[F.lit(r) for r in rows])
    row = F.size(F.filter(heads, lambda b: b <= doc_id))
    inner = F.size(F.filter(F.get(table, row - 1), lambda b: b <= doc_id))
    return F.when(doc_id.isNull() | (row == 0), F.lit(0)).otherwise((row - 1) * width + inner).cast("long")


def compare_edited(docs: DataFrame, k: int = K, shingle: int = SHINGLE) -> DataFrame:
    """Fingerprint every document, an edited copy of it and its neighbour in descending doc_id order.

    The edited copy has its last half (rounded down, in code points) replaced by as many from the start of the next
    document; after the last comes the first. Groups of neighbouring ids are sorted in one task each, with the first
    document of the next group sent along. Null texts count as empty; a null doc_id comes last; equal ids are ordered by
    text; a table of one row is its own neighbour; no rows give none. Very long texts are sketched in whole; other columns are
    not read. n_shingles is the estimated count of distinct shingles, contained the share of them that the edited text has.
    """
    spark, rows = docs.sparkSession, texts(docs)
    n, n_ids = docs.agg(F.count("*"), F.count("doc_id")).first()
    if not n:
        return spark.createDataFrame([], _EDITED)
    m = max(1, min(n // GROUP_ROWS, 250_000))
    bounds = rows.agg(F.percentile_approx("doc_id", [i / m for i in range(1, m)], max(10_000, 10 * m))).first()[0] if m > 1 and n_ids else []
    bounds = sorted(set(bounds or []))
    grouped = rows.withColumn("g", _group_of(F.col("doc_id"), bounds))
    heads = {r.g: r.top for r in grouped.groupBy("g").agg(F.max("doc_id").alias("top")).collect()}  # a row for each of the m groups
    order = sorted(heads, reverse=True)
    follows = {order[i]: order[(i + 1) % len(order)] for i in range(len(order))}
    halo = spark.createDataFrame([(heads[b], a) for a, b in follows.items()], "top long, g long")
    first = grouped.drop("g").join(F.broadcast(halo), F.col("doc_id").eqNullSafe(F.col("top"))).groupBy("doc_id", "g").agg(F.min("text").alias("text"))
    own, sent = grouped.select("g", F.lit(0).alias("halo"), "doc_id", "text"), first.select("g", F.lit(1).alias("halo"), "doc_id", "text")
    dealt = own.union(sent).repartition(shuffle_partitions(docs), "g").sortWithinPartitions("g", "halo", F.desc_nulls_last("doc_id"), "text")
    return dealt.mapInArrow(lean(_edited(k, shingle)), _EDITED)


_EDITED = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, n_shingles double, contained double"


def _edited(k: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            out = []
            for g, halo, doc, text in zip(*(c.to_pylist() for c in batch.columns)):
                mine = sketch(text, k, shingle)
                if held is not None and held[0] == g:
                    _, before, old, theirs = held
                    half = len(old) // 2
                    edited = old[: len(old) - half] + text[:half]
                    its = sketch(edited, k, shingle)
                    out.append((before, len(old), hashlib.sha256(edited.encode("utf-8", "surrogatepass")).hexdigest(), to_string(theirs), to_string(its), resemblance(theirs, its, k), resemblance(theirs, mine, k), distinct(theirs, k), containment(theirs, its, k)))
                held = None if halo else (g, doc, text, mine)
            if out:
                kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), *[pa.float64()] * 4)
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*out), kinds)], [f.split()[0] for f in _EDITED.split(", ")])

    return run
