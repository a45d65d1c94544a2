"""Language-model scores: smoothed unigram counts of the whole corpus, and a log-bilinear neural model over them.

The model knows the frequent words, the end of a text and one symbol for all other words; how many words it knows grows
with the corpus. Symbols are sorted by count and cut into about as many classes as a class has symbols. A token's
probability is that of its class times that of the symbol within the class, both log-bilinear in the three symbols before
it, so normalising takes two matrix products with some hundred columns each instead of one with the whole vocabulary.

Training is noise-contrastive estimation, class against classes and symbol against symbols of its class. A warm start on
some documents in one task gives all trainers common ground; then every training token is used once, in a bounded number
of trainer tasks, whose changes are averaged row by row, weighted by how often a trainer met the row's symbol. A word
outside the model gets its smoothed share of the common symbol. Counts of all words stay in a table: the most frequent
HEAD of them are broadcast, the rest are joined.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import lean, text_chunks, texts, written

#: Words known to the model: SHARE * tokens ** GROWTH (1,200 at 0.3 million tokens, 60 thousand at 5 billion).
SHARE, GROWTH, LEAST = 8.0, 0.4, 2
WIDTH, ORDER, NOISE, BATCH, BLOCK, RATE, SEED = 24, 3, 3, 2_048, 1 << 17, 0.15, 7
#: Words whose counts are broadcast beside the model's; documents of the warm start and how often it passes over them.
HEAD, WARM_DOCS, WARM_PASSES = 1 << 16, 1_500, 2
#: Symbols in one message of a trainer; tokens in one matrix product, whose result should stay in the cache.
ROWS, CELLS = 4_096, 1_024
END, RARE = 0, 1


def train_fold(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 != 1, F.lit(True))


def split_words(column: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts, A-Z lower-cased, one after the other, and how many each text has."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(column))
    flat, offsets = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.binary_length(flat).to_numpy() > 0  # white space at an end leaves an empty word
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    return flat.cast(pa.binary()), np.diff(offsets)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in text_chunks(batch, 0):
            got = pc.value_counts(split_words(part.column(0))[0])
            yield pa.RecordBatch.from_arrays([got.field("values"), got.field("counts")], ["word", "n"])


def numbered(column: pa.Array, words: pa.Array, known: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """Symbols of all tokens (each text closed by END), tokens of each text, rank of each word (-1: not in words), words."""
    flat, sizes = split_words(column)
    rank = pc.index_in(flat, value_set=words).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    symbol = np.where((rank >= 0) & (rank < known), rank + 2, RARE)
    return np.insert(symbol, np.cumsum(sizes), END), sizes + 1, rank, flat


def contexts(symbol: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The ORDER symbols before each token, the nearest first; before a text's start they are all END."""
    first = np.cumsum(sizes) - sizes
    out = np.full((ORDER, len(symbol)), END, np.int64)
    for j in range(ORDER):
        out[j, j + 1 :] = symbol[: max(0, len(symbol) - j - 1)]
        for place in range(j + 1):
            out[j, (first + place)[sizes > place]] = END
    return out


class Model:
    """Class-factored log-bilinear model over symbols 0 .. n - 1, which are sorted by count but for END and RARE."""

    def __init__(self, counts: np.ndarray, width: int = WIDTH, seed: int = SEED):
        rng, n = np.random.default_rng(seed), len(counts)
        self.n, self.size = n, max(2, int(np.ceil(np.sqrt(n))))
        self.classes = -(-n // self.size)
        share = counts + 0.5
        self.of = np.arange(n) // self.size
        mass = np.bincount(self.of, share, self.classes)
        self.class_share, self.within = (mass / mass.sum()).astype(np.float32), (share / mass[self.of]).astype(np.float32)
        self.sizes = np.bincount(self.of, minlength=self.classes)
        self.small = np.uint16 if n <= 1 << 16 else np.int64  # short keys sort faster
        f = np.float32
        self.params = {
            "context": (0.1 * rng.standard_normal((n, width))).astype(f),
            "symbol": np.zeros((n, width), f),
            "bias": np.log(self.within),
            "mixing": np.stack([np.eye(width) / (j + 1) for j in range(ORDER)]).astype(f),
            "class": (0.02 * rng.standard_normal((self.classes, width))).astype(f),
            "class_bias": np.log(self.class_share),
        }
        self.squares = {k: np.full(p.shape[:1] if p.ndim == 2 else p.shape, 1e-2, f) for k, p in self.params.items()}

    def _climb(self, name: str, grad: np.ndarray, rows: np.ndarray | None = None) -> None:
        """AdaGrad; rows of a matrix share one sum of squares."""
        p, s = self.params[name], self.squares[name]
        square = np.einsum("nd,nd->n", grad, grad) / grad.shape[1] if p.ndim == 2 else grad * grad
        square += s if rows is None else s.take(rows)
        step = RATE / np.sqrt(square)
        grad = grad * (step[:, None] if p.ndim == 2 else step)
        if rows is None:
            s[:] = square
            p += grad
        else:
            s[rows] = square
            grad += p.take(rows, 0)
            p[rows] = grad

    def _sorted(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct ids, the order that brings equal ones together, and where each begins in it."""
        order = np.argsort(ids.astype(self.small), None, kind="stable")
        ids = ids.reshape(-1).take(order)
        first = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])
        return ids.take(first), order, first

    def learn(self, before: np.ndarray, target: np.ndarray, rng: np.random.Generator) -> None:
        """One step of noise-contrastive estimation; the noise of the class part is its exact expectation, that of the symbol
        part is drawn evenly from the class."""
        p, n = self.params, len(target)
        held = p["context"].take(before.T, 0).reshape(n, -1)  # [batch, ORDER * width]
        mixing = p["mixing"].reshape(held.shape[1], -1)
        h = held @ mixing
        own = self.of.take(target)
        weight = np.exp(p["class_bias"])
        tilt = weight / (NOISE * self.class_share)
        odds = h @ -p["class"].T
        np.clip(odds, -30, 30, out=odds)
        np.exp(odds, out=odds)
        odds += tilt
        at = np.arange(0, odds.size, self.classes) + own
        miss = 1 - tilt.take(own) / odds.take(at)
        np.divide(-weight, odds, out=odds)  # noise times probability, in two passes less than a sigmoid and a product
        odds.reshape(-1)[at] += miss
        d_h = odds @ p["class"]
        size = self.sizes.take(own)
        words = np.concatenate([target[None], own * self.size + (rng.random((NOISE, n), np.float32) * size).astype(np.int64)])
        np.minimum(words, own * self.size + size - 1, out=words)  # rounding up to the end
        q = p["symbol"].take(words, 0)
        error = -_sigmoid(np.einsum("bd,kbd->kb", h, q) + p["bias"].take(words) - np.log(NOISE / self.sizes).astype(np.float32).take(own))
        error[0] += 1
        d_h += np.einsum("kb,kbd->bd", error, q)
        ids, order, first = self._sorted(words)
        pull = error.reshape(-1).take(order)
        rows = h.take(order % n, 0)
        rows *= pull[:, None]
        self._climb("symbol", _totals(rows, first), ids)
        self._climb("bias", np.add.reduceat(pull, first), ids)
        self._climb("class", odds.T @ h)
        self._climb("class_bias", np.ones(n, np.float32) @ odds)
        d_held = (d_h @ mixing.T).reshape(before.size, -1)
        ids, order, first = self._sorted(before.T)
        self._climb("context", _totals(d_held.take(order, 0), first), ids)
        self._climb("mixing", (held.T @ d_h).reshape(p["mixing"].shape))

    def learn_all(self, before: np.ndarray, target: np.ndarray, rng: np.random.Generator) -> None:
        for a in range(0, len(target), BATCH):
            self.learn(before[:, a : a + BATCH], target[a : a + BATCH], rng)

    def log10(self, before: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Normalised log10 probabilities of target symbols after their contexts, in blocks of matrix products."""
        p, out = self.params, np.empty(len(target))
        mixed = [p["context"] @ p["mixing"][j] for j in range(ORDER)]
        for a in range(0, len(target), BLOCK):
            t, c = target[a : a + BLOCK], before[:, a : a + BLOCK]
            h = sum(mixed[j].take(c[j], 0) for j in range(ORDER))
            own = self.of.take(t)
            got = np.concatenate([_chosen(h[i : i + CELLS] @ p["class"].T, p["class_bias"], own[i : i + CELLS]) for i in range(0, len(t), CELLS)])
            order = np.argsort(own.astype(self.small), kind="stable")
            own = own.take(order)
            first = np.concatenate([[0], np.flatnonzero(np.diff(own)) + 1, [len(t)]]).tolist()
            h, t = h.take(order, 0), t.take(order)
            parts = []
            for i, z in zip(first[:-1], first[1:]):
                low = int(own[i]) * self.size
                q, bias = p["symbol"][low : low + self.size].T, p["bias"][low : low + self.size]
                parts += [_chosen(h[x : min(x + CELLS, z)] @ q, bias, t[x : min(x + CELLS, z)] - low) for x in range(i, z, CELLS)]
            got[order] += np.concatenate(parts)
            out[a : a + BLOCK] = got
        return out / np.log(10)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.clip(x, -30, 30, out=x)
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _totals(rows: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of the runs of rows that begin at first; numbers are added in pairs, as complex ones, for half the calls."""
    if rows.shape[1] % 2:
        return np.add.reduceat(rows, first)
    return np.add.reduceat(rows.view(np.complex64), first).view(np.float32)


def _chosen(logits: np.ndarray, bias: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Log of the soft maximum of each row of logits + bias at one place of it; logits are used up."""
    if max(logits.max(), -logits.min(), 3 * np.abs(bias).max()) > 60:  # else single precision holds the sums as they are
        logits += bias
        logits -= logits.max(1, keepdims=True)
        bias = np.zeros_like(bias)
    own = logits.take(np.arange(0, logits.size, logits.shape[1]) + at).astype(np.float64) + bias.take(at)
    np.exp(logits, out=logits)
    return own - np.log(logits @ np.exp(bias))


def _rows(model: Model) -> np.ndarray:
    """What belongs to single symbols, a row for each."""
    return np.concatenate([x.reshape(model.n, -1) for x in (model.params[k] if d else model.squares[k] for d in (True, False) for k in _BY_SYMBOL)], 1)


def _dense(model: Model) -> np.ndarray:
    return np.concatenate([x.reshape(-1) for x in (model.params[k] if d else model.squares[k] for d in (True, False) for k in _SHARED)])


def _move(model: Model, rows: np.ndarray, dense: np.ndarray) -> None:
    """Add changes of that layout to the model."""
    at = 0
    for x in (model.params[k] if d else model.squares[k] for d in (True, False) for k in _BY_SYMBOL):
        width = x.size // model.n
        x += rows[:, at : at + width].reshape(x.shape)
        at += width
    at = 0
    for x in (model.params[k] if d else model.squares[k] for d in (True, False) for k in _SHARED):
        x += dense[at : at + x.size].reshape(x.shape)
        at += x.size


_BY_SYMBOL, _SHARED = ("context", "symbol", "bias"), ("mixing", "class", "class_bias")


def _train(shared, passes: int):
    """Trains a copy of the model on a task's texts and yields what changed: blocks of rows, each weighted by its symbol's
    tokens here, and the small matrices, weighted by all tokens."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, words, known = pickle.loads(shared.value)
        rows, dense = _rows(model), _dense(model)
        seen, rng = np.zeros(model.n, np.float32), np.random.default_rng(SEED + TaskContext.get().partitionId())
        kept: list[tuple[np.ndarray, np.ndarray]] = []
        for batch in batches:
            for part in text_chunks(batch, 0):
                symbol, sizes, _, _ = numbered(part.column(0), words, known)
                seen += np.bincount(symbol, minlength=model.n).astype(np.float32)
                c = contexts(symbol, sizes)
                model.learn_all(c, symbol, rng)
                if passes > 1:
                    kept.append((c.astype(np.int32), symbol.astype(np.int32)))
        for _ in range(passes - 1):
            for c, symbol in kept:
                model.learn_all(c.astype(np.int64), symbol.astype(np.int64), rng)
        if not seen.any():
            return
        rows = (_rows(model) - rows) * seen[:, None]
        blocks = [-1, *range(-(-model.n // ROWS))]
        payload = [np.append((_dense(model) - dense) * seen.sum(), seen.sum()).astype(np.float32).tobytes()]
        payload += [np.concatenate([rows[a : a + ROWS], seen[a : a + ROWS, None]], 1).tobytes() for a in range(0, model.n, ROWS)]
        yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int64()), pa.array(payload, pa.binary())], ["block", "moved"])

    return run


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One sum for each block; rows come sorted by block."""
    now, total = None, None
    done: list[tuple[int, bytes]] = []
    for batch in batches:
        for block, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = np.frombuffer(raw, np.float32).astype(np.float64)
            if block != now:
                if now is not None:
                    done.append((now, total.tobytes()))
                now, total = block, np.zeros(len(values))
            total += values
    if now is not None:
        done.append((now, total.tobytes()))
    if done:
        yield pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.binary())], ["block", "moved"])


def _trained(docs: DataFrame, model: Model, words: pa.Array, known: int, passes: int = 1) -> Model:
    """The model after one round over docs (text): each partition trains by itself, then the changes are averaged."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(pickle.dumps((model, words, known)))
    fields = "block long, moved binary"
    moved = docs.mapInArrow(lean(_train(shared, passes)), fields)
    sums = moved.repartition("block").sortWithinPartitions("block").mapInArrow(lean(_add_up), fields).collect()  # the size of the model
    rows, dense = np.zeros_like(_rows(model)), np.zeros_like(_dense(model))
    for block, raw in sums:
        values = np.frombuffer(raw, np.float64)
        if block < 0:
            dense += (values[:-1] / values[-1]).astype(np.float32)
            continue
        table = values.reshape(-1, rows.shape[1] + 1)
        rows[block * ROWS : block * ROWS + len(table)] = table[:, :-1] / np.maximum(table[:, -1:], 1e-9)
    _move(model, rows, dense)
    shared.destroy()
    return model


def trained(training: DataFrame, model: Model, words: pa.Array, known: int, n_docs: int) -> Model:
    """Warm start on about WARM_DOCS documents, then one round over all; about four times the root of the scan's tasks train."""
    if not n_docs:
        return model
    some = training.sample(fraction=min(1.0, WARM_DOCS / n_docs), seed=SEED)
    model = _trained(some.repartition(1), model, words, known, WARM_PASSES)  # rows whose number is bounded
    tasks = training.rdd.getNumPartitions()
    return _trained(training.coalesce(max(1, min(tasks, int(4 * np.sqrt(tasks))))), model, words, known)


_FIELDS = "key long, doc_id long, held_out boolean, n_tokens long, n_known long, head_logs double, model_logs double, tail array<binary>, times array<int>"
_NAMES = [f.split()[0] for f in _FIELDS.split(", ")]


class Scorer:
    """What scoring needs of the counts: head words with their logs, totals, model."""

    def __init__(self, words: pa.Array, counts: np.ndarray, known: int, n: int, v: int, n_docs: int, model: Model):
        self.words, self.known, self.model, self.n_docs = words, known, model, n_docs
        self.end_log = float(np.log10(n_docs + 0.5))
        self.base_log = float(np.log10(n + 0.5 * (v + 1)))
        rare_n = n - n_docs - int(counts[:known].sum())
        rare_v = v - bool(n_docs) - known
        self.rare_log = float(np.log10(rare_n + 0.5 * (rare_v + 1)))
        self.log_count = np.append(np.log10(counts + 0.5), 0.0)  # the last for words outside the head


def _tails(rank: np.ndarray, flat: pa.Array, doc_at: np.ndarray, n: int) -> tuple[pa.Array, pa.Array]:
    """Distinct words outside the head of each of n texts, and how often it has them."""
    at = np.flatnonzero(rank < 0)
    coded = flat.take(pa.array(at)).dictionary_encode()
    width = max(len(coded.dictionary), 1)
    pair, times = np.unique(doc_at[at] * width + coded.indices.to_numpy().astype(np.int64), return_counts=True)
    offsets = pa.array(np.searchsorted(pair, np.arange(n + 1) * width), pa.int32())
    return pa.ListArray.from_arrays(offsets, coded.dictionary.take(pa.array(pair % width))), pa.ListArray.from_arrays(offsets, pa.array(times, pa.int32()))


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Scorer = pickle.loads(shared.value)
        key = TaskContext.get().partitionId() << 36
        for batch in batches:
            for part in text_chunks(batch, 2):
                symbol, sizes, rank, flat = numbered(part.column(2), m.words, m.known)
                n = len(sizes)
                first = np.cumsum(sizes) - sizes
                doc_at = np.repeat(np.arange(n), sizes - 1)
                model = np.add.reduceat(m.model.log10(contexts(symbol, sizes), symbol), first)
                logs, in_head, rare = m.log_count[rank], rank >= 0, (rank < 0) | (rank >= m.known)
                head_logs = np.bincount(doc_at, logs, n) + m.end_log
                model += np.bincount(doc_at, np.where(rare & in_head, logs, 0.0) - rare * m.rare_log, n)
                known = np.bincount(doc_at, in_head, n).astype(np.int64) + (m.n_docs > 0)
                tail, times = _tails(rank, flat, doc_at, n)
                made = [pa.array(key + np.arange(n)), part.column(0), part.column(1), pa.array(sizes), pa.array(known), pa.array(head_logs), pa.array(model), tail, times]
                key += n
                yield pa.RecordBatch.from_arrays(made, _NAMES)

    return run


def _most_frequent(sizes: list[tuple[int, int]], most: int, least: int = 1) -> int:
    """The smallest count such that no more than most words have it; sizes are (count, words with it), descending."""
    total, lowest = 0, 2**62
    for n, words in sizes:
        total += words
        if total > most or n < least:
            break
        lowest = n
    return lowest


def score(docs: DataFrame, head: int = HEAD, share: float = SHARE) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every document.

    Tokens: words with A-Z lower-cased, then one end. A null or empty text is one end. A row without doc_id trains and is
    not held out; repeated rows count each time, and equal texts get scores that are equal but for rounding. Of words
    with equal counts all or none belong to the model, and all or none to the broadcast head. With no training rows, every
    token is unknown; no rows give none. Very long texts are counted and scored in whole, a block of tokens at a time. Other columns
    are not read. The model depends slightly on how rows are dealt to tasks.
    """
    spark = docs.sparkSession
    rows = texts(docs).withColumn("trains", train_fold(F.col("doc_id")))
    training = rows.where("trains").select("text")
    counts = written(training.mapInArrow(lean(_count), "word binary, n long").groupBy("word").agg(F.sum("n").alias("n")), "word-counts")
    n_docs = training.count()
    sizes = [(r.n, r.words) for r in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).collect()]  # about the root of the tokens at most
    n, v = sum(a * b for a, b in sizes) + n_docs, sum(b for _, b in sizes) + bool(n_docs)
    target = int(share * n**GROWTH)
    model_least, head_least = _most_frequent(sizes, target, LEAST), _most_frequent(sizes, max(head, target))
    top = sorted(((bytes(r.word), r.n) for r in counts.where(F.col("n") >= head_least).collect()), key=lambda r: (-r[1], r[0]))  # head rows, or target if that is more
    words, of_words = pa.array([w for w, _ in top], pa.binary()), np.array([c for _, c in top], np.int64)
    known = int((of_words >= model_least).sum())
    rare_n = n - n_docs - int(of_words[:known].sum())
    model = trained(training, Model(np.array([n_docs, rare_n, *of_words[:known]], np.float64)), words, known, n_docs)
    scorer = Scorer(words, of_words, known, n, v, n_docs, model)
    shared = spark.sparkContext.broadcast(pickle.dumps(scorer))
    scored = written(rows.select("doc_id", ~F.col("trains"), "text").mapInArrow(lean(_score(shared)), _FIELDS), "scores")
    tail = scored.select("key", F.explode(F.arrays_zip("tail", "times")).alias("x")).select("key", F.col("x.tail").alias("word"), F.col("x.times").alias("times"))
    looked_up = tail.join(counts.where(F.col("n") < head_least), "word", "left").groupBy("key").agg(F.sum(F.col("times") * F.log10(F.coalesce("n", F.lit(0)) + 0.5)).alias("tail_logs"), F.sum(F.when(F.col("n") > 0, F.col("times")).otherwise(0)).alias("tail_known"))
    tail_logs = F.coalesce("tail_logs", F.lit(0.0))
    return scored.select("key", "doc_id", "held_out", "n_tokens", "n_known", "head_logs", "model_logs").join(looked_up, "key", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("tail_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("head_logs") + tail_logs - F.col("n_tokens") * F.lit(scorer.base_log)).alias("base_score"),
        (F.col("model_logs") + tail_logs).alias("score"),
    )
