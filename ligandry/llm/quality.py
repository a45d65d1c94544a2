"""Quality by nearest neighbours among labelled documents in a latent-semantic space.

A document is a bag of terms: hashed words, and shapes of words (case, marks, digits, length, repetition of the word
before). Square roots of term shares, weighted by IDF, are projected on the leading singular vectors of a bounded
labelled sample, found by randomised subspace iteration. The sample's vectors are broadcast; every document is compared
with all of them in blocked matrix products. The NEIGHBOURS nearest ones, and all others as near as the last of them, vote
with their labels, each weighted by the POWER of its cosine.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import SPACES, lean, lower_ascii, text_chunks, texts, word_hashes

#: Rows of the labelled sample, latent dimensions, voting neighbours, least score of label 1. All bound what is broadcast.
FIT_ROWS, DIMENSIONS, NEIGHBOURS, THRESHOLD = 4_000, 48, 25, 0.3
#: Digits to which cosines are compared, so that equal ones tie; power of the cosine that weights a vote.
DIGITS, POWER = 5, 4
HASHED, SHAPES = 1 << 15, 512
TERMS = HASHED + SHAPES
SCORE = "_quality_score"


def shapes(raw: bytes, words: np.ndarray) -> np.ndarray:
    """A term below SHAPES for each word: first and last byte's kind, capitals, length and whether it repeats the last word."""
    buf = np.frombuffer(raw, np.uint8)
    edge = np.diff(np.concatenate([[0], (~SPACES[buf]).astype(np.int8), [0]]))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1) - 1
    if not len(first):
        return first
    capital = ((buf >= 65) & (buf <= 90)).astype(np.int64)
    capitals = np.add.reduceat(capital, first)
    digit = np.add.reduceat(((buf >= 48) & (buf <= 57)).astype(np.int64), first)
    mark = np.add.reduceat(((buf > 32) & (buf < 48) | (buf > 57) & (buf < 65) | (buf > 90) & (buf < 97) | (buf > 122) & (buf < 127)).astype(np.int64), first)
    size = last - first + 1
    case = np.minimum(capitals, 2)  # none, one, more
    marks = np.minimum(mark, 3)
    length = np.digitize(size, (2, 4, 8, 16, 32)) % 4
    again = np.zeros(len(first), np.int64)
    again[1:] = words[1:] == words[:-1]
    return ((((case * 4 + marks) * 4 + length) * 2 + (digit > 0)) * 2 + again) * 2 + (mark == size)


def bag(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Terms, ascending, and square roots of their shares; none for a text without words."""
    raw = text.encode("utf-8", "surrogatepass")
    words = word_hashes(lower_ascii(text))
    if not len(words):
        return np.empty(0, np.int64), np.empty(0, np.float32)
    terms, n = np.unique(np.concatenate([(words % np.uint64(HASHED)).astype(np.int64), HASHED + shapes(raw, words)]), return_counts=True)
    return terms, np.sqrt(n / len(words)).astype(np.float32)


class Bags:
    """Bags of some texts, end to end."""

    def __init__(self, bags: list[tuple[np.ndarray, np.ndarray]]):
        self.sizes = np.array([len(t) for t, _ in bags], np.int64)
        self.terms = np.concatenate([np.empty(0, np.int64), *(t for t, _ in bags)])
        self.values = np.concatenate([np.empty(0, np.float32), *(v for _, v in bags)])

    def __len__(self) -> int:
        return len(self.sizes)

    def times(self, matrix: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The weighted bags, as rows, times a matrix with a row for each term; block by block."""
        out = np.zeros((len(self), matrix.shape[1]), np.float32)
        full = np.flatnonzero(self.sizes)
        ends = np.cumsum(self.sizes)
        for block in np.array_split(full, len(self.terms) // 200_000 + 1):
            if len(block):
                a, z = ends[block[0]] - self.sizes[block[0]], ends[block[-1]]
                rows = matrix[self.terms[a:z]] * (self.values[a:z] * weights[self.terms[a:z]])[:, None]
                out[block] = np.add.reduceat(rows, ends[block] - self.sizes[block] - a)
        return out

    def transposed_times(self, matrix: np.ndarray, weights: np.ndarray) -> np.ndarray:
        """The transpose of the weighted bags times a matrix with a row for each text."""
        owner = np.repeat(np.arange(len(self)), self.sizes)
        order = np.argsort(self.terms, kind="stable")
        out = np.zeros((TERMS, matrix.shape[1]), np.float32)
        for part in np.array_split(order, len(order) // 200_000 + 1):
            if len(part):
                terms = self.terms[part]
                first = np.concatenate([[0], np.flatnonzero(np.diff(terms)) + 1])
                rows = matrix[owner[part]] * (self.values[part] * weights[terms])[:, None]
                out[terms[first]] += np.add.reduceat(rows, first)
        return out


class Voter:
    """Fitted on bags and labels of the sample; scores bags."""

    def __init__(self, bags: Bags, labels: np.ndarray, dimensions: int = DIMENSIONS, neighbours: int = NEIGHBOURS):
        n = max(len(bags), 1)
        self.idf = (np.log((1 + n) / (1 + np.bincount(bags.terms, minlength=TERMS))) + 1).astype(np.float32)
        basis = np.random.default_rng(11).standard_normal((TERMS, dimensions + 16)).astype(np.float32)
        for _ in range(4):  # subspace iteration
            across = np.linalg.qr(bags.times(basis, self.idf))[0]
            basis = np.linalg.qr(bags.transposed_times(across, self.idf))[0]
        found = bags.times(basis, self.idf).astype(np.float64)
        turn = np.linalg.eigh(found.T @ found)[1]
        self.axes = np.ascontiguousarray((basis @ turn[:, ::-1][:, :dimensions]).astype(np.float32))
        self.labels, self.neighbours = labels.astype(np.float64), min(neighbours, len(bags))
        self.prior = float(labels.mean()) if len(labels) else 0.5
        self.vectors = self.project(bags)

    def project(self, bags: Bags) -> np.ndarray:
        v = bags.times(self.axes, self.idf)
        return v / np.maximum(np.linalg.norm(v, axis=1, keepdims=True), 1e-12)

    def score(self, bags: Bags, block: int = 512) -> np.ndarray:
        out, points = np.full(len(bags), self.prior), self.project(bags)
        for a in range(0, len(bags) if self.neighbours else 0, block):
            near = np.round(points[a : a + block] @ self.vectors.T, DIGITS)
            last = np.partition(near, -self.neighbours, axis=1)[:, -self.neighbours, None]
            row, at = np.nonzero(near >= last)
            weight = np.maximum(near[row, at], 0).astype(np.float64) ** POWER
            total, votes = np.bincount(row, weight, len(near)), np.bincount(row, weight * self.labels[at], len(near))
            out[a : a + block] = np.where(total > 1e-9, votes / np.maximum(total, 1e-9), self.prior)
        return np.round(np.clip(out, 0.0, 1.0), 6)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = [bag(t) for t in batch.column(1).to_pylist()]
        packed = [zlib.compress(t.astype("<u2").tobytes() + v.astype("<f4").tobytes(), 1) for t, v in made]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(packed, pa.binary()), batch.column(2)], ["doc_id", "bag", "quality"])


def _unpacked(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = zlib.decompress(raw)
    n = len(raw) // 6
    return np.frombuffer(raw, "<u2", n).astype(np.int64), np.frombuffer(raw, "<f4", n, 2 * n)


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> Voter:
    """From at most rows labelled documents outside the held-out fold, chosen by a hash of their id.

    A document's label is the least of its labels, its text the least of its texts; the sample is put in the order of
    ids, so the model doesn't depend on how rows arrive.
    """
    usable = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    chosen = usable.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    sample = texts(docs).join(F.broadcast(chosen), "doc_id").groupBy("doc_id", "quality").agg(F.min("text").alias("text"))  # rows labels at most
    found = sample.select("doc_id", "text", "quality").mapInArrow(lean(_bags), "doc_id long, bag binary, quality int").collect()  # rows at most
    found.sort(key=lambda r: r.doc_id)
    return Voter(Bags([_unpacked(r.bag) for r in found]), np.array([r.quality for r in found], np.float64))


def _score(shared, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        voter = pickle.loads(shared.value)
        for batch in batches:
            for part in text_chunks(batch, text_at):
                scores = voter.score(Bags([bag(t or "") for t in part.column(text_at).to_pylist()]))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores, pa.float64())], [*part.schema.names, SCORE])

    return run


def scored(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS) -> DataFrame:
    """The rows of docs, all columns, with SCORE added."""
    shared = docs.sparkSession.sparkContext.broadcast(pickle.dumps(fit(docs, labels, rows)))
    schema = T.StructType([*docs.schema.fields, T.StructField(SCORE, T.DoubleType())])
    return docs.mapInArrow(lean(_score(shared, docs.columns.index("text"))), schema)


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = FIT_ROWS) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Null and empty texts have no terms and get the sample's share of label 1. Labels that are null or neither 0 nor 1 are
    not used; of a document's labels the lowest counts, of its texts the least; without any label, all scores are 0.5.
    Neighbours with equal cosines vote all or none, so scores depend on the data alone and equal texts get equal ones. A null
    doc_id is not held out and never trains. Repeated rows are scored alike, empty tables give no rows, very long texts are
    read in whole, other columns are not read.
    """
    found = scored(docs.select("doc_id", "text"), labels, rows)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), F.col(SCORE).alias("score"), (F.col(SCORE) >= threshold).cast("int").alias("predicted"))


def good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, rows: int = FIT_ROWS) -> DataFrame:
    """The documents that the classifier accepts, unchanged."""
    return scored(docs, labels, rows).where(F.col(SCORE) >= threshold).drop(SCORE)
