"""Shared pieces of the training-data operators: scratch tables, document views and vectorised word hashing."""

from __future__ import annotations

import atexit
import ctypes
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ASCII_SPACE = b"\x20\x09\x0a\x0b\x0c\x0d"
_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def workdir(spark: SparkSession, name: str) -> str:
    """A fresh folder name under spark.checkpoint.dir, the folder that driver and executors share.

    Only a local master may go without that setting; it then gets a temporary folder of this machine, gone at exit.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        if not _local:
            _local.append(tempfile.mkdtemp(prefix="ligandry-"))
            atexit.register(shutil.rmtree, _local[0], ignore_errors=True)
        base = _local[0]
    return f"{base.rstrip('/')}/ligandry/{name}-{uuid.uuid4().hex}"


_local: list[str] = []
_scratch: list[str] = []


def scratch(spark: SparkSession, path: str) -> str:
    """Mark a folder just written as scratch: release() deletes it, the end of the application at the latest."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)
    _scratch.append(path)
    return path


def release(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> None:
    """Delete scratch tables marked after the first since, but for those that keep reads. Nothing else may still read them."""
    kept = {f.rsplit("/", 1)[0].rsplit("/", 1)[-1] for f in keep.inputFiles()} if keep is not None else set()
    for path in [p for p in _scratch[since:] if p.rsplit("/", 1)[-1] not in kept]:
        _scratch.remove(path)
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def scratch_tables() -> int:
    return len(_scratch)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df, written once to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = workdir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(scratch(spark, path))


def drop(df: DataFrame) -> None:
    """Delete the files of a table that written() made and that nothing reads any more."""
    jvm, conf = df.sparkSession._jvm, df.sparkSession._jsc.hadoopConfiguration()
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """doc_id and whole text of documents; a null text counts as empty. Other columns are pruned from the scan."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), *more)


#: Ids that may be broadcast, after counting them (about 40 bytes each in memory); more of them are joined by shuffle.
BROADCAST_IDS = 1 << 22


ROW = "__row"


def with_rows(docs: DataFrame) -> DataFrame:
    """docs with ROW, a number for each row. Same files, same numbers: docs must be a table read from files."""
    return docs.withColumn(ROW, F.monotonically_increasing_id())


def row_texts(rows: DataFrame) -> DataFrame:
    """What operators take as documents, with the row's number for its id, so that rows with equal or no doc_id stay apart."""
    return rows.select(F.col(ROW).alias("doc_id"), "text")


def without(rows: DataFrame, gone: DataFrame) -> DataFrame:
    """Rows whose number is not in gone (one column, ROW), without the numbers."""
    gone = written(gone.distinct(), "gone")
    return rows.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, ROW, "left_anti").drop(ROW)


def one_of_each(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """Of each group (doc_id: a row's number, component_id) the row with the smallest doc_id stays, a null one last."""
    ids = rows.select(F.col(ROW).alias("row"), F.col("doc_id").cast("long").alias("id"))
    named = groups.select(F.col("doc_id").alias("row"), "component_id").join(ids, "row")
    first = named.groupBy("component_id").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row"))["row"].alias("row"))
    gone = groups.select(F.col("doc_id").alias("row")).join(first.select("row"), "row", "left_anti")
    return without(rows, gone.select(F.col("row").alias(ROW)))


def lean(kernel: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """kernel, and after its last row what it has freed goes back to the system, not to the worker's next task alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from kernel(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
            if trim:
                trim(0)

    return run


#: Bytes of stored input for which a shuffle gets another partition, beyond spark.sql.shuffle.partitions.
PART_BYTES = 16 << 20


def shuffle_partitions(df: DataFrame) -> int:
    """Partitions for a shuffle of df's texts: the session's number, or more if the files below df are large."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    size = sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    return least if size >= 1 << 60 else max(least, size // PART_BYTES)  # rows that aren't in files have no known size


def list_column(parts: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """An Arrow list column of the arrays, without a Python object for each value."""
    offsets = np.cumsum([0, *map(len, parts)])
    flat = np.concatenate([np.empty(0, kind.to_pandas_dtype()), *(p.astype(kind.to_pandas_dtype()) for p in parts)])
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, kind))


#: Bytes of text that kernels work on at a time; a single longer text is one chunk.
CHUNK = 4 << 20


def text_chunks(batch: pa.RecordBatch, at: int, size: int | None = None) -> Iterator[pa.RecordBatch]:
    """Slices of batch whose texts (column at) have about size bytes; every row is in one."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.binary_length(batch.column(at)).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        base = int(ends[first - 1]) if first else 0
        last = max(first + 1, int(np.searchsorted(ends, base + (size or CHUNK), "right")))
        yield batch.slice(first, last - first)
        first = last


def lower_ascii(text: str) -> bytes:
    """UTF-8 bytes with A-Z, and nothing else, lower-cased."""
    return text.encode("utf-8", "surrogatepass").translate(_LOWER)


def folded(text: str) -> bytes:
    """UTF-8 bytes with the letters of every script case folded, so that upper-cased text is found again."""
    return lower_ascii(text) if text.isascii() else text.casefold().encode("utf-8", "surrogatepass")


_rng = np.random.default_rng(20240229)
_VAL = _rng.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_P = int(_rng.integers(2**62, 2**63, dtype=np.uint64)) | 1
_PIECE = 1 << 19
_powers: dict[str, np.ndarray] = {}
SPACES = np.zeros(256, bool)
SPACES[list(ASCII_SPACE)] = True
#: Bytes that are no letter, digit or part of a non-ASCII character.
MARKS = np.array([not (48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers["p"]) < n + 1:
        size = max(n + 1, 1 << 16)
        for key, base in (("p", _P), ("q", pow(_P, -1, 2**64))):
            steps = np.full(size, base, np.uint64)
            steps[0] = 1
            _powers[key] = np.multiply.accumulate(steps)
    return _powers["p"], _powers["q"]


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser, so that every bit of the result depends on every bit of h."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(raw: bytes, separators: np.ndarray = SPACES) -> np.ndarray:
    """64-bit hash of every word of raw, in order; equal words have equal hashes wherever they stand.

    Prefix sums of a polynomial over the bytes; long texts go in pieces cut at a separator, so memory stays bounded
    by the longest word.
    """
    buf = np.frombuffer(raw, np.uint8)
    out, at = [], 0
    while at < len(buf):
        end = min(len(buf), at + _PIECE)
        while end < len(buf) and not separators[buf[end]]:
            end += 1
        piece = buf[at:end]
        at = end
        inside = np.empty(len(piece) + 2, np.int8)
        inside[0] = inside[-1] = 0
        inside[1:-1] = ~separators[piece]
        edge = np.diff(inside)
        first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
        if not len(first):
            continue
        p, q = _power_tables(len(piece))
        total = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum(_VAL[piece] * p[: len(piece)], out=total[1:])
        out.append(mix((total[last] - total[first]) * q[first] + (last - first).astype(np.uint64)))
    return np.concatenate(out) if out else np.empty(0, np.uint64)


_Q = _rng.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of the runs of k words, in order; fewer words are one run; no words, none."""
    n = len(words)
    if not n:
        return words
    k = min(k, n)
    total = np.full(n - k + 1, k, np.uint64)
    for j in range(k):
        total += words[j : n - k + 1 + j] * _Q[j]
    return mix(total)
