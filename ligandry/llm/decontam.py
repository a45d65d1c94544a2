"""Benchmark decontamination by greedy string tiling.

Words (runs of letters and digits, case folded over all of Unicode) of every benchmark item are indexed by hashes of SEED
consecutive words. A document's distinct hashes are joined with the index and counted for each item; only items that
enough of their places are hit for can be covered, so an opening that thousands of items share costs one count each.
What the document has of such an item is tiled: the longest run of words that both have unmarked is found by Karp-Rabin
hashing and a search for its length, compared word by word and marked, and so on while one of SEED words is left. An item
is leaked if the tiles cover enough of its words, in whatever order they stand in the document.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import MARKS, folded, lean, mix, shingle_hashes, texts, word_hashes

SEED, COVERAGE = 4, 0.5
#: Characters of benchmark text that one pass over the documents broadcasts; more items go in more passes.
BLOCK_CHARS = 16_000_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BLANKS = bytes(32 if MARKS[b] else b for b in range(256))


def bare_words(text: str) -> list[bytes]:
    return folded(text).translate(_BLANKS).split(b" ") if text else []


def _powers(n: int) -> np.ndarray:
    steps = np.full(n + 1, _BASE)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def _rolling(codes: np.ndarray) -> np.ndarray:
    """Prefix hashes; _run() takes the hash of any run of words from them."""
    out, values = np.zeros(len(codes) + 1, np.uint64), mix(codes.astype(np.uint64) + np.uint64(1))
    np.cumsum(values * _powers(len(codes))[: len(codes)], out=out[1:])
    return out


def _runs(prefix: np.ndarray, powers: np.ndarray, starts: np.ndarray, n: int) -> np.ndarray:
    """Hashes of the runs of n words from starts, brought to one power so that equal runs are equal wherever they stand."""
    return (prefix[starts + n] - prefix[starts]) * powers[len(powers) - 1 - starts]


class _Side:
    """Words of one text as codes, hashed; unmarked stretches shrink as tiles are marked."""

    def __init__(self, codes: np.ndarray, size: int):
        self.codes, self.prefix, self.powers, self.free = codes, _rolling(codes), _powers(size), codes >= 0

    def starts(self, n: int) -> np.ndarray:
        """Where n unmarked words stand together."""
        taken = np.concatenate([[0], np.cumsum(~self.free)])
        return np.flatnonzero(taken[n:] == taken[: len(taken) - n]) if n <= len(self.codes) else np.empty(0, np.int64)

    def hashes(self, starts: np.ndarray, n: int) -> np.ndarray:
        return _runs(self.prefix, self.powers, starts, n)


def _common(doc: _Side, item: _Side, n: int) -> tuple[int, int] | None:
    """The first place in the document, and there the first in the item, where both have the same n unmarked words."""
    d, i = doc.starts(n), item.starts(n)
    if not len(d) or not len(i):
        return None
    hd, hi = doc.hashes(d, n), item.hashes(i, n)
    for a in np.flatnonzero(np.isin(hd, hi)):
        for b in i[hi == hd[a]]:
            if (doc.codes[d[a] : d[a] + n] == item.codes[b : b + n]).all():  # else two runs with one hash
                return int(d[a]), int(b)
    return None


def tiles(doc: np.ndarray, item: np.ndarray, seed: int) -> list[tuple[int, int, int]]:
    """Greedy tiling of two lists of word codes: (doc start, item start, length), longest first, then as they stand.

    Negative codes match nothing. Memory is proportional to the texts, whatever repeats in them.
    """
    size = max(len(doc), len(item))
    d, i, out = _Side(doc, size), _Side(item, size), []
    longest = len(item)
    while True:
        low, high, found = seed, longest, None
        while low <= high:  # a common run of n words holds one of n - 1
            n = (low + high + 1) // 2 if found else low  # most often nothing is left: look at the shortest first
            got = _common(d, i, n)
            if got:
                low, found = n + 1, (*got, n)
            else:
                high = n - 1
        if not found:
            return out
        a, b, longest = found
        out.append(found)
        d.free[a : a + longest] = False
        i.free[b : b + longest] = False


class Index:
    """Seeds of benchmark items, by seed length (items of fewer words are one seed)."""

    def __init__(self, items: list[tuple[int, str]], seed: int = SEED):
        self.seeds, self.names, self.texts = {}, [name for name, _ in items], [text for _, text in items]
        self.size = np.zeros(len(items), np.int64)
        found: dict[int, list] = {}
        for item, (_, text) in enumerate(items):
            words = word_hashes(folded(text or ""), MARKS)
            if len(words):
                k = min(seed, len(words))
                self.size[item] = len(words)
                h = shingle_hashes(words, k)
                found.setdefault(k, []).append((h, np.full(len(h), item, np.int64), np.arange(len(h))))
        for k, parts in found.items():
            h, item, at = (np.concatenate(x) for x in zip(*parts))
            order = np.argsort(h, kind="stable")
            self.seeds[k] = h[order], item[order], at[order]

    def leaks(self, text: str, coverage: float) -> Iterator[tuple[int, float, int, int, list[int]]]:
        words = word_hashes(folded(text), MARKS)
        coded: dict[bytes, int] = {}
        for k, (seeds, items, places) in self.seeds.items():
            if len(words) < k:
                continue
            h = shingle_hashes(words, k)
            low = np.searchsorted(seeds, h)
            hit = np.flatnonzero(seeds[np.minimum(low, len(seeds) - 1)] == h)
            if not len(hit):
                continue
            first = np.unique(low[hit])  # each distinct hash once
            n = np.searchsorted(seeds, seeds[first], "right") - first
            at = np.repeat(first, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            able = np.flatnonzero(k * np.bincount(items[at], minlength=len(self.size)) >= np.maximum(coverage * self.size, 1))
            if not len(able):
                continue
            near = np.zeros(len(words), bool)  # words in some hit; all else can't be in a tile
            for j in range(k):
                near[hit + j] = True
            spots = np.flatnonzero(near)
            spots = np.insert(spots, np.flatnonzero(np.diff(spots) > 1) + 1, -1)  # stretches stay apart
            bare = [w for w in bare_words(text) if w]
            codes = np.array([coded.setdefault(bare[s], len(coded)) if s >= 0 else -1 for s in spots.tolist()], np.int64)
            for it in able.tolist():
                own = np.array([coded.get(w, -2) for w in bare_words(self.texts[it]) if w], np.int64)
                found = tiles(codes, own, k)
                covered = sum(t[2] for t in found)
                if covered and covered >= coverage * self.size[it]:
                    yield self.names[it], covered / self.size[it], len(found), covered, [int(x) for a, _, n in sorted(found) for x in (spots[a], n)]


_FIELDS = "doc_id long, item_id long, coverage double, n_tiles int, n_covered int, spans array<int>"
_SCHEMA = pa.schema([("doc_id", pa.int64()), ("item_id", pa.int64()), ("coverage", pa.float64()), ("n_tiles", pa.int32()), ("n_covered", pa.int32()), ("spans", pa.list_(pa.int32()))])


def _find(shared, coverage: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = pickle.loads(shared.value)
        for batch in batches:
            rows = [(doc, *leak) for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for leak in index.leaks(text, coverage)]
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _SCHEMA)], schema=_SCHEMA)

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, seed: int = SEED) -> DataFrame:
    """One row for each document and benchmark item that it leaks: doc_id, item_id, coverage, n_tiles, n_covered, spans.

    spans are pairs (first word, words) in the document. Clean documents have no row. Null or empty texts and items leak
    nothing; equal items count once, different texts of one item_id apart; repeated documents each get their rows; items without id
    are left out. An item of fewer than seed words leaks where all its words stand together. Of equally long matches the
    first in the document is marked, and there the first in the item. Very long texts are tiled only where seeds hit. Empty
    tables give no rows; other columns are not read.
    """
    spark = docs.sparkSession
    items = benchmark.where("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    chars = items.agg(F.sum(F.length("text"))).first()[0] or 0
    blocks = -(-chars // BLOCK_CHARS) or 1
    found = None
    for b in range(blocks):
        block = [(r.item_id, r.text) for r in items.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b).orderBy("item_id", "text").collect()]  # about BLOCK_CHARS
        shared = spark.sparkContext.broadcast(pickle.dumps(Index(block, seed)))
        part = texts(docs).mapInArrow(lean(_find(shared, coverage)), _FIELDS)
        found = part if found is None else found.union(part)
    return found
