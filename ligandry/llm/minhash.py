"""Near-duplicate components by min-max hashing.

Each permutation gives two signature values, the minimum and the maximum, so half as many hashes are evaluated. Bands of
ROWS values bring candidates together. Documents with the same shingle set are one class from the start; only one member
of a class is banded, so a group of copies costs one row. In a bucket each member is first paired with the next in size
only, a chain instead of all pairs; pairs are confirmed on the full shingle sets and joined up. Pairs inside one component
then need no look at all. In buckets that still hold several components, pairs across them are compared: in small buckets
first each member with its likeliest partner, then all whose signatures don't rule out the threshold. A large bucket gets
the texts too, compares sets in place and passes on only links that join components; it is cut into tiles, so no task
holds more than two blocks of it, and members of its largest component aren't compared with each other. The chain of a very
large bucket is cut too: parts are chained alone, and every RUNG-th member of a part with those of the other parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import BROADCAST_IDS, lean, lower_ascii, mix, release, scratch_tables, shingle_hashes, shuffle_partitions, texts, word_hashes, written
from .components import components

SHINGLE, PERCENT = 5, 80
#: With bands of 6 a pair at the threshold of 0.8 is missed with probability (1 - 0.8^6)^36 = 2e-5; longer signatures are no cost to sets that differ.
ROWS, BANDS = 6, 36
HASHES = ROWS * BANDS // 2
#: Members from which a bucket compares sets in place; most members of it in a block of a tile.
LARGE, TILE = 256, 2_048
#: Members that a bucket's chain has in one task; one in RUNG of them meets those of the bucket's other parts.
PART, RUNG = 1 << 16, 1 << 12
_rng = np.random.default_rng(1009)
_A = _rng.integers(1, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A32 = _A.astype(np.uint32) | np.uint32(1)
_B32 = _rng.integers(0, 2**32, HASHES, dtype=np.uint32)
_WEIGHTS = _A[:ROWS] ^ np.uint64(0x5DEECE66)


def signature(shingles: np.ndarray) -> np.ndarray:
    """Minimum, then maximum, of the shingles under each permutation."""
    low, high = np.full(HASHES, 2**32 - 1, np.uint32), np.zeros(HASHES, np.uint32)
    values = (shingles >> np.uint64(32)).astype(np.uint32)
    for a in range(0, len(values), 1_024):
        h = values[a : a + 1_024, None] * _A32
        h += _B32
        h ^= h >> np.uint32(15)
        np.minimum(low, h.min(0), out=low)
        np.maximum(high, h.max(0), out=high)
    return np.concatenate([low, high])


def bands(sig: np.ndarray) -> np.ndarray:
    """One key for each band; a band holds either minima or maxima of different permutations."""
    rows = sig.reshape(BANDS, ROWS).astype(np.uint64)
    return mix((rows * _WEIGHTS).sum(1) + np.arange(1, BANDS + 1, dtype=np.uint64) * _A[0]).view(np.int64)


def shingle_set(raw: bytes, k: int) -> set:
    """Runs of k words; fewer words are one run; none, nothing."""
    words = raw.split()
    if len(words) < k:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(k))))


_SIGNED = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("skey", pa.binary()), ("sig", pa.binary()), ("bands", pa.list_(pa.int64()))])


def _sign(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            out = []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shingles = np.unique(shingle_hashes(word_hashes(lower_ascii(text)), k))
                key = hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()
                sig = keys = None
                if len(shingles) and key not in seen:  # copies within a task are signed once
                    if len(seen) > 100_000:
                        seen.clear()
                    seen.add(key)
                    values = signature(shingles)
                    sig, keys = (values & np.uint32(255)).astype(np.uint8).tobytes(), bands(values)
                out.append((doc, len(shingles), key, sig, keys))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _SIGNED)], schema=_SIGNED)

    return run


def _blob(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    press = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([press.compress(lower_ascii(t)) for t in batch.column(1).to_pylist()], pa.binary())], ["id", "blob"])


def _confirm(k: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpress, last, own = zstandard.ZstdDecompressor(), None, set()
        for batch in batches:
            good = []
            for a, b, left, right in zip(*(c.to_pylist() for c in batch.columns)):
                if (a, left) != last:
                    last, own = (a, left), shingle_set(unpress.decompress(left), k)
                other = shingle_set(unpress.decompress(right), k)
                both = len(own & other)
                if both and 100 * both >= percent * (len(own) + len(other) - both):
                    good.append((a, b))
            if good:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*good)], ["a", "b"])

    return run


def _across(k: int, percent: int, best_only: bool):
    """Candidate pairs of different components from tiles sorted by (bkey, tile)."""
    least = percent / 100 - 4 * np.sqrt(percent / 100 * (1 - percent / 100) / (2 * HASHES))  # four standard errors below the threshold

    def tile(rows: list[tuple]) -> Iterator[tuple[int, int]]:
        unpress = zstandard.ZstdDecompressor()
        ids, sizes, labels, rank = (np.array([r[i] for r in rows], np.int64) for i in (2, 3, 4, 6))
        sigs = np.frombuffer(b"".join(r[5] for r in rows), np.uint8).reshape(len(rows), -1)
        keys, own_key = np.array([r[7] for r in rows], np.int64), rows[0][0]
        low, high = rows[0][1] >> 20, rows[0][1] & (1 << 20) - 1
        large = rows[0][8] is not None
        sets = [np.unique(shingle_hashes(word_hashes(unpress.decompress(r[8])), k)) for r in rows] if large else []
        for i in range(len(rows)):
            if low != high and rank[i] != low:
                continue  # a tile of two blocks compares one with the other
            other = (labels != labels[i]) & (np.minimum(sizes, sizes[i]) * 100 >= percent * np.maximum(sizes, sizes[i]))
            other &= (rank == high) if low != high else (np.arange(len(rows)) > i) | (best_only and not large)
            at = np.flatnonzero(other)
            if not len(at):
                continue
            near = (sigs[at] == sigs[i]).mean(1)
            if best_only and not large:
                j = int(near.argmax())
                at = at[j : j + 1] if near[j] >= least else at[:0]
            else:
                at = at[near >= least]
                shared = np.where(keys[at] == keys[i], keys[at], np.iinfo(np.int64).max)
                at = at[shared.min(1) == own_key]  # once, in the first bucket that the two share
            if large and len(at):  # sets compared here; of the pairs that link, those that join components go on
                n_of = sizes[at]
                inside = np.isin(np.concatenate([sets[j] for j in at.tolist()]), sets[i], assume_unique=False)
                both = np.add.reduceat(inside.astype(np.int64), np.cumsum(n_of) - n_of)
                for j in at[100 * both >= percent * (n_of + sizes[i] - both)].tolist():
                    if labels[j] != labels[i]:
                        labels[labels == labels[j]] = labels[i]
                        yield int(ids[i]), int(ids[j])
                continue
            for j in ids[at].tolist():
                yield int(ids[i]), j

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows, out = None, [], []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if row[:2] != now:
                    if len(rows) > 1:
                        out += tile(rows)
                    now, rows = row[:2], []
                rows.append(row)
                if len(out) > 50_000:
                    yield _pairs(out)
                    out = []
        if len(rows) > 1:
            out += tile(rows)
        if out:
            yield _pairs(out)

    return run


def _pairs(out: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], ["a", "b"])


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id, kept of every document.

    Linked: 100 * intersection >= percent * union of the sets of shingle-word runs, A-Z lower-cased. component_id is the
    smallest doc_id reachable, kept whether it is the row's own. Null and empty texts have no shingles and link with nothing,
    not even each other. Rows with equal doc_id are each judged by their own text. A row without doc_id is linked with
    nothing, has no component and is kept. No rows give none. Very long texts are shingled in whole; other columns are not read.
    """
    spark, rows, before = docs.sparkSession, texts(docs), scratch_tables()
    parts = shuffle_partitions(docs)
    signed = written(rows.mapInArrow(lean(_sign(shingle)), "doc_id long, n_shingles long, skey binary, sig binary, bands array<long>"), "signed")
    usable = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    firsts = usable.groupBy("skey").agg(F.min("doc_id").alias("id"), F.max("n_shingles").alias("n"), F.max(F.struct("sig", "bands")).alias("s"))
    classes = written(firsts.select("skey", "id", "n", "s.sig", "s.bands"), "classes")
    dealt = classes.select(F.explode("bands").alias("bkey"), "id", "n")
    shared = dealt.groupBy("bkey").agg(F.count("*").alias("m")).where("m > 1")  # a member alone in its bucket meets nobody there
    met = dealt.join(shared, "bkey").withColumn("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("m") / PART)))
    order = Window.partitionBy("bkey", "part").orderBy("n", "id")
    before_it = F.lag(F.struct("id", "n")).over(order)
    bucketed = written(met.select("bkey", "id", "n", "m", before_it.alias("p"), F.row_number().over(order).alias("at")).select("bkey", "id", "n", "m", "at", F.col("p.id").alias("before"), F.col("p.n").alias("n_before")), "buckets")
    rungs = bucketed.where(F.col("m") > PART).where(F.col("at") % RUNG == 1).select("bkey", "id", "n")  # link the parts of a large bucket
    up = F.lag(F.struct("id", "n")).over(Window.partitionBy("bkey").orderBy("n", "id"))
    rungs = rungs.select("id", "n", up.alias("p")).select("id", "n", F.col("p.id").alias("before"), F.col("p.n").alias("n_before"))
    steps = bucketed.select("id", "n", "before", "n_before").union(rungs).where("before IS NOT NULL AND before <> id")
    chain = written(steps.select(F.least("id", "before").alias("a"), F.greatest("id", "before").alias("b"), (F.col("n_before") * 100 >= F.col("n") * percent).alias("near")).distinct(), "chain")
    members = written(chain.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "members")
    blob_fields = "id long, blob binary"
    if members.count() <= BROADCAST_IDS:  # then only members' texts and signatures are moved
        members = F.broadcast(members)
        held = rows.withColumnRenamed("doc_id", "id").join(members, "id", "left_semi").select("id", "text").mapInArrow(lean(_blob), blob_fields)
    else:
        held = rows.mapInArrow(lean(_blob), blob_fields).join(members, "id", "left_semi")
    blobs = written(held.dropDuplicates(), "texts")
    signatures = written(classes.join(members, "id", "left_semi").select("id", "sig", "bands"), "signatures")

    def confirmed(pairs: DataFrame) -> DataFrame:
        left, right = blobs.select(F.col("id").alias("a"), F.col("blob").alias("left")), blobs.select(F.col("id").alias("b"), F.col("blob").alias("right"))
        return pairs.select("a", "b").join(left, "a").join(right, "b").select("a", "b", "left", "right").mapInArrow(lean(_confirm(shingle, percent)), "a long, b long")

    links = written(confirmed(chain.where("near")), "links")
    labels = components(links)
    tried = chain.select("a", "b")
    for best_only in (True, False):
        open_ = bucketed.where("m > 2") if best_only else bucketed.where(F.col("m").between(3, LARGE - 1))  # large ones are settled in the first round
        marked = open_.select("bkey", "id", "n", "m").join(labels.withColumnRenamed("node", "id"), "id", "left").select("bkey", "id", "n", "m", F.coalesce("label", "id").alias("label"))
        shares = marked.groupBy("bkey", "label").agg(F.count("*").alias("of"))
        several = shares.groupBy("bkey").agg(F.count("*").alias("labels"), F.max(F.struct("of", "label")).alias("main")).where("labels > 1").select("bkey", "main")
        crowded = marked.join(several, "bkey")
        small = crowded.where(F.col("m") < LARGE).select("bkey", F.lit(0).cast("long").alias("tile"), "id", "n", "label", F.lit(0).cast("long").alias("r"), F.lit(None).cast("binary").alias("blob"))
        if best_only:
            # the main component's blocks come first and meet the others' blocks only
            large = crowded.where(F.col("m") >= LARGE).withColumn("is_main", F.col("label") == F.col("main.label"))
            large = large.withColumn("g", F.ceil(F.col("main.of") / TILE)).withColumn("others", F.ceil((F.col("m") - F.col("main.of")) / TILE))
            large = large.withColumn("r", F.when(F.col("is_main"), F.pmod(F.xxhash64("id"), F.col("g"))).otherwise(F.col("g") + F.pmod(F.xxhash64("id"), F.col("others"))))
            large = large.withColumn("c", F.explode(F.sequence(F.when(F.col("is_main"), F.col("g")).otherwise(F.lit(0).cast("long")), F.col("g") + F.col("others") - 1)))
            small = small.union(large.withColumn("tile", F.shiftleft(F.least("r", "c"), 20) + F.greatest("r", "c")).join(blobs, "id").select("bkey", "tile", "id", "n", "label", "r", "blob"))
        sent = small.join(signatures, "id").select("bkey", "tile", "id", "n", "label", "sig", "r", "bands", "blob")
        sent = sent.repartition(parts, "bkey", "tile").sortWithinPartitions("bkey", "tile", "n", "id")
        across = sent.mapInArrow(lean(_across(shingle, percent, best_only)), "a long, b long")
        pairs = written(across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
        links = links.union(written(confirmed(pairs), "links"))
        tried = tried.union(pairs)
        labels = components(links)
    named = written(classes.select("skey", F.col("id").alias("node")).join(labels, "node", "left").select("skey", F.coalesce("label", "node").alias("component")), "named")
    alone = F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("skey"))
    joined = signed.select("doc_id", "n_shingles", alone.alias("skey")).join(named, "skey", "left")
    component = F.coalesce("component", "doc_id")
    release(spark, before, keep=joined)  # all but the signatures and the names of classes
    return joined.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
