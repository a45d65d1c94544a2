"""Results against plain models of the same rules: neighbours, rules, licences, language model, tiling, packing, sketches."""

import collections
import copy
import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ligandry.llm import common, decontam, fingerprint, licenses, lm, packing, quality, substring, tokens, urls

from test_llm import SCHEMA, made


def test_neighbours_against_brute_force():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(50)]
    texts = [" ".join(rng.choices(words, k=rng.randint(1, 20))) for _ in range(150)]
    texts += texts[:40] + [""] * 3  # ties
    labels = np.array([rng.randrange(2) for _ in texts], float)
    voter = quality.Voter(quality.Bags([quality.bag(t) for t in texts]), labels, dimensions=16, neighbours=7)
    asked = texts[:30] + ["", "unknown words only"]
    points = voter.project(quality.Bags([quality.bag(t) for t in asked]))
    for point, got in zip(points, voter.score(quality.Bags([quality.bag(t) for t in asked]))):
        near = [round(float(c), quality.DIGITS) for c in voter.vectors @ point]
        last = sorted(near)[-7]
        voting = [(max(c, 0.0) ** quality.POWER, y) for c, y in zip(near, labels) if c >= last - 1e-9]
        total = sum(w for w, _ in voting)
        assert got == pytest.approx(sum(w * y for w, y in voting) / total if total > 1e-9 else labels.mean(), abs=1e-3)


def test_latent_axes_are_the_leading_ones():
    rng = np.random.default_rng(5)
    texts = [" ".join(f"w{x}" for x in rng.zipf(1.6, 40) % 300) for _ in range(200)]
    bags = quality.Bags([quality.bag(t) for t in texts])
    voter = quality.Voter(bags, np.ones(200), dimensions=8)
    dense = np.zeros((200, quality.TERMS), np.float32)
    dense[np.repeat(np.arange(200), bags.sizes), bags.terms] = bags.values * voter.idf[bags.terms]
    values = np.linalg.svd(dense, compute_uv=False)
    assert np.linalg.norm(dense @ voter.axes) ** 2 == pytest.approx((values[:8] ** 2).sum(), rel=1e-2)


def test_quality_is_the_same_in_any_row_order(spark):
    texts = ["the same text for all of them"] * 60 + [f"other {i} words {i % 7}" for i in range(60)]
    rows = [(i, t) for i, t in enumerate(texts)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(120)], "doc_id long, quality int, toxic int")
    found = []
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        table = spark.createDataFrame(rows + [(5, "a second text of one id")], "doc_id long, text string").repartition(seed + 1)
        found.append(sorted((r.doc_id, r.score) for r in quality.classify(table, labels).collect()))
    assert found[0] == found[1]
    assert len({s for i, s in found[0] if i < 60 and i != 5}) == 1


def url_tables(spark):
    rng = random.Random(7)
    pages, labels = [], []
    for i in range(400):
        host, folder, key = rng.choice(["spam", "fine", "Blog"]), rng.choice(["buy", "news", "x"]), rng.choice(["ref", "page", ""])
        bad = host == "spam" and folder == "buy" and key == "ref" or host == "Blog" and folder == "x" or rng.random() < 0.05
        pages.append((i, f"https://{host}.site.io/{folder}/{i}" + (f"?{key}=1" if key else "") + ("#top" if rng.random() < 0.1 else "")))
        if i % 10:
            labels.append((i, int(not bad), 0))
    pages += pages[:20] + [(900, None), (901, "no url"), (902, "http://a.net/de/7"), (None, "https://spam.site.io/buy/zz?ref=2")]
    return spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("broadcast", [50_000, 0])
def test_url_rules_against_sql(spark, broadcast, monkeypatch):
    """Planted rules of one to three tokens, with every token set counted by SQL; with and without broadcasts."""
    monkeypatch.setattr(urls, "BROADCAST_ROWS", broadcast)
    pages, labels = url_tables(spark)
    got = collections.Counter(map(tuple, urls.judge(pages, labels, min_count=8).select("page_id", "host", "path", "rule", "verdict", "confidence").collect()))
    c = duckdb.connect()
    c.register("pages", pa.Table.from_pandas(pages.toPandas().astype({"page_id": "Int64"})))
    c.register("labels", pa.Table.from_pandas(labels.toPandas()))
    want = collections.Counter(c.sql(urls.oracle_sql(min_count=8)).fetchall())
    assert got == want
    assert sum(n for r, n in got.items() if r[4] == "block" and r[3] is None) > 20


def test_long_equal_shaped_urls(spark):
    """Forty folders that always come together are one class, not 2^40 rules."""
    shape = "/".join(f"f{j}" for j in range(40))
    pages = spark.createDataFrame([(i, f"http://{'bad' if i % 2 else 'good'}.io/{shape}/{i}") for i in range(200)], "page_id long, url string")
    labels = spark.createDataFrame([(i, 1 - i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    judged = urls.judge(pages, labels).collect()
    assert len(judged) == 200 and all((r.verdict == "block") == bool(r.page_id % 2) for r in judged)


def test_licences_against_sql(spark):
    rng = random.Random(9)
    notices = [t for _, t, _ in licenses.TEMPLATES]
    texts = [t for _, t, *_ in made()] + notices + [f"{a} {b}".upper() for a, b in zip(notices, notices[3:])] + ["apache license version 2 " * 5_000, "cc by nc " * 3, None, ""]
    for t in notices * 2:
        words = t.split()
        for at in rng.sample(range(len(words)), len(words) // 4):
            words[at] = "other"
        texts.append(", ".join(words))
    docs = spark.createDataFrame([(i // 2, t, "clash") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = collections.Counter(map(tuple, licenses.scan(docs).collect()))
    c = duckdb.connect()
    c.register("documents", pa.table({"doc_id": [i // 2 for i in range(len(texts))], "text": pa.array(texts, pa.string())}))
    assert got == collections.Counter(c.sql(licenses.oracle_sql()).fetchall())
    assert licenses.scan(docs.where("false")).count() == 0


def test_words_as_python_splits_them():
    texts = ["", " a  b ", "A\x0bB\x0cC\rD\te\nF", "Ünï Q\x1cr", "\u00a0x y", "one"]
    flat, sizes = lm.split_words(pa.array(texts))
    want = [t.encode().translate(bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))).split() for t in texts]
    assert sizes.tolist() == [len(w) for w in want] and flat.to_pylist() == [w for ws in want for w in ws]


def test_model_is_normalised_and_learns():
    rng = np.random.default_rng(2)
    counts = np.array([40, 30, *range(60, 0, -1)], float)
    model = lm.Model(counts, width=8)
    symbol = np.tile([5, 9, 11, 40], 4_000)  # 9 always after 5
    c = lm.contexts(symbol, np.array([len(symbol)]))
    model.learn_all(c, symbol, rng)
    before = np.array([[5], [40], [11]])
    every = np.concatenate([model.log10(np.repeat(before, 62, 1), np.arange(62))])
    assert (10.0**every).sum() == pytest.approx(1, abs=1e-5) and every.argmax() == 9
    assert lm.contexts(np.array([5, 6, 0, 7, 0]), np.array([3, 2])).tolist() == [[0, 5, 6, 0, 7], [0, 0, 5, 0, 0], [0, 0, 0, 0, 0]]


def plain_step(model, before, target, rng):
    """Model.learn() as its definition reads, every sigmoid, sum and square by itself."""
    p, n = model.params, len(target)

    def climb(name, grad, rows=slice(None)):
        q, s = p[name], model.squares[name]
        s[rows] += (grad * grad).mean(1) if q.ndim == 2 else grad * grad
        q[rows] += lm.RATE * grad / (np.sqrt(s[rows])[:, None] if q.ndim == 2 else np.sqrt(s[rows]))

    def sums(ids, rows):
        order = np.argsort(ids.astype(model.small), None, kind="stable")
        ids = ids.reshape(-1).take(order)
        first = np.concatenate([[0], np.flatnonzero(np.diff(ids)) + 1])
        return np.add.reduceat(rows(order), first), ids.take(first)

    held = p["context"].take(before, 0)
    h = sum(held[j] @ p["mixing"][j] for j in range(lm.ORDER))
    own, at, noise = model.of.take(target), np.arange(n), lm.NOISE * model.class_share
    odds = lm._sigmoid(h @ p["class"].T + (p["class_bias"] - np.log(noise)))
    miss = 1 - odds[at, own]
    odds *= -noise
    odds[at, own] += miss
    d_h, size = odds @ p["class"], model.sizes.take(own)
    words = np.concatenate([target[None], own * model.size + np.minimum((rng.random((lm.NOISE, n), np.float32) * size).astype(np.int64), size - 1)])
    q = p["symbol"].take(words, 0)
    error = -lm._sigmoid(np.einsum("bd,kbd->kb", h, q) + p["bias"].take(words) - np.log(lm.NOISE / size).astype(np.float32))
    error[0] += 1
    d_h += np.einsum("kb,kbd->bd", error, q)
    climb("symbol", *sums(words, lambda o: h.take(o % n, 0) * error.reshape(-1).take(o)[:, None]))
    climb("bias", *sums(words, error.reshape(-1).take))
    climb("class", odds.T @ h)
    climb("class_bias", odds.sum(0))
    d_held = np.concatenate([d_h @ p["mixing"][j].T for j in range(lm.ORDER)])
    d_mixing = np.stack([held[j].T @ d_h for j in range(lm.ORDER)])
    climb("context", *sums(before, lambda o: d_held.take(o, 0)))
    climb("mixing", d_mixing)


def plain_log10(model, before, target):
    p = model.params
    h = sum((p["context"] @ p["mixing"][j]).take(before[j], 0) for j in range(lm.ORDER))

    def chosen(logits, at):
        logits -= logits.max(1, keepdims=True)
        own = logits[np.arange(len(at)), at].astype(float)
        return own - np.log(np.exp(logits, out=logits).sum(1))

    own = model.of.take(target)
    out = np.concatenate([chosen(h[i : i + lm.CELLS] @ p["class"].T + p["class_bias"], own[i : i + lm.CELLS]) for i in range(0, len(target), lm.CELLS)])
    order = np.argsort(own.astype(model.small), kind="stable")
    for at in np.split(order, np.flatnonzero(np.diff(own[order])) + 1):
        low = own[at[0]] * model.size
        for i in (at[j : j + lm.CELLS] for j in range(0, len(at), lm.CELLS)):
            out[i] += chosen(h[i] @ p["symbol"][low : low + model.size].T + p["bias"][low : low + model.size], target[i] - low)
    return out / np.log(10)


def zipf_model(n, tokens, width=lm.WIDTH):
    counts = tokens / np.arange(2.0, n + 2)
    return lm.Model(counts, width), np.random.default_rng(4).choice(n, tokens, p=counts / counts.sum())


@pytest.mark.parametrize(("n", "width"), [(2_000, 24), (150, 7)])
def test_training_and_scoring_are_the_plain_ones(n, width):
    model, symbol = zipf_model(n, 12_000, width)
    sizes = np.diff(np.append(np.unique(np.random.default_rng(5).choice(11_999, 400) + 1), 12_000), prepend=0)
    c = lm.contexts(symbol, sizes)
    place = np.concatenate([np.arange(k) for k in sizes])
    assert c.tolist() == [[symbol[i - j - 1] if place[i] > j else lm.END for i in range(12_000)] for j in range(lm.ORDER)]
    plain, rng, again = copy.deepcopy(model), np.random.default_rng(6), np.random.default_rng(6)
    for a in range(0, 12_000, lm.BATCH):
        model.learn(c[:, a : a + lm.BATCH], symbol[a : a + lm.BATCH], rng)
        plain_step(plain, c[:, a : a + lm.BATCH], symbol[a : a + lm.BATCH], again)
    for name, x in model.params.items():
        np.testing.assert_allclose(x, plain.params[name], rtol=0, atol=2e-4, err_msg=name)
        np.testing.assert_allclose(model.squares[name], plain.squares[name], rtol=1e-3, err_msg=name)
    np.testing.assert_allclose(model.log10(c, symbol), plain_log10(model, c, symbol), rtol=0, atol=1e-4)
    model.params["class"] *= 300  # sums that single precision can't hold unless logits are shifted
    model.params["bias"] *= 30
    got = model.log10(c, symbol)
    assert np.isfinite(got).all() and got.min() < -60
    np.testing.assert_allclose(got, plain_log10(model, c, symbol), rtol=1e-4, atol=1e-3)


TIMED = """
import sys, time
sys.path[:0] = {path!r}
import numpy as np
from ligandry.llm import lm
from test_exact import plain_log10, plain_step, zipf_model

model, symbol = zipf_model(13_000, 16 * lm.BATCH)
c, rng, times = lm.contexts(symbol, np.array([len(symbol)])), np.random.default_rng(1), [[], [], [], []]
scored = lm.contexts(np.tile(symbol, 4), np.array([4 * len(symbol)])), np.tile(symbol, 4)
steps = [(c[:, a : a + lm.BATCH], symbol[a : a + lm.BATCH]) for a in range(0, len(symbol), lm.BATCH)]
for _ in range(25):
    for k, f in enumerate((lambda: [model.learn(*s, rng) for s in steps], lambda: [plain_step(model, *s, rng) for s in steps], lambda: model.log10(*scored), lambda: plain_log10(model, *scored))):
        t = time.thread_time()
        f()
        times[k].append(time.thread_time() - t)
print(*(min(t) for t in times))
"""


def test_training_and_scoring_take_less_cpu_time_than_the_plain_ones():
    """The check's budget is CPU time: a step must stay well below its plain form. One thread, as in an executor."""
    path = [str(Path(__file__).parents[2]), str(Path(__file__).parent)]
    ran = subprocess.run([sys.executable, "-c", TIMED.format(path=path)], capture_output=True, text=True, env=os.environ | {"OMP_NUM_THREADS": "1", "OPENBLAS_NUM_THREADS": "1"}, check=True)
    learn, plain_learn, score, plain_score = map(float, ran.stdout.split()[-4:])
    assert learn < 0.9 * plain_learn and score < 0.75 * plain_score, (learn / plain_learn, score / plain_score)


def test_scores_against_brute_force(spark, monkeypatch):
    """score: the logs of the model's own probabilities, token by token, and shares of the common symbol for other words."""
    held = {}
    real = lm.Scorer.__init__

    def keep(self, *args):
        real(self, *args)
        held["m"] = self

    monkeypatch.setattr(lm.Scorer, "__init__", keep)
    rows = [(r[0], r[1]) for r in made()]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = lm.score(docs, head=30, share=0.5).collect()
    m, low = held["m"], bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    trains = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    split = [(i, (t or "").encode().translate(low).split()) for i, t in rows]
    count = collections.Counter(w for i, ws in split if trains(i) for w in ws)
    symbol_of = {w: i + 2 for i, w in enumerate(m.words.to_pylist()[: m.known])}
    tail = [n for w, n in count.items() if w not in symbol_of]
    p = m.model.params

    def log_softmax(x):
        x = x.astype(float)
        return x - x.max() - math.log(np.exp(x - x.max()).sum())

    def log_p(before, s):
        h = sum(p["context"][b] @ p["mixing"][j] for j, b in enumerate(before))
        k, size = s // m.model.size, m.model.size
        return log_softmax(p["class"] @ h + p["class_bias"])[k] + log_softmax(p["symbol"][k * size : (k + 1) * size] @ h + p["bias"][k * size : (k + 1) * size])[s - k * size]

    want = []
    for i, words in split:
        if len(words) > 200:
            continue
        total, before = 0.0, [lm.END] * lm.ORDER
        for w in [*words, None]:
            s = lm.END if w is None else symbol_of.get(w, lm.RARE)
            total += log_p(before, s) / math.log(10)
            if s == lm.RARE:
                total += math.log10((count[w] + 0.5) / (sum(tail) + 0.5 * (len(tail) + 1)))
            before = [s, *before[:-1]]
        want.append((str(i), len(words) + 1, total))
    small = sorted((str(r.doc_id), r.n_tokens, r.score) for r in got if r.n_tokens <= 201)
    assert m.known < len(count) and len(m.words) < len(count) and len(small) == len(want)
    for a, b in zip(small, sorted(want)):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], abs=2e-3)


def test_tiles_are_the_longest_first():
    def brute(a, b, seed):
        free_a, free_b, out = [True] * len(a), [True] * len(b), []
        while True:
            best = None
            for i in range(len(a)):
                for j in range(len(b)):
                    n = 0
                    while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and a[i + n] >= 0 and free_a[i + n] and free_b[j + n]:
                        n += 1
                    if n >= seed and (best is None or n > best[2]):
                        best = i, j, n
            if best is None:
                return out
            out.append(best)
            for k in range(best[2]):
                free_a[best[0] + k] = free_b[best[1] + k] = False

    rng = random.Random(3)
    for _ in range(400):
        a = [rng.randrange(rng.choice([2, 4])) - (rng.random() < 0.1) for _ in range(rng.randint(0, 20))]
        b = [rng.randrange(4) for _ in range(rng.randint(1, 14))]
        seed = rng.choice([1, 2, 3])
        assert decontam.tiles(np.array(a, np.int64), np.array(b, np.int64), seed) == brute(a, b, seed)


def test_items_with_a_common_opening():
    """Thousands of items that begin alike, and one word that fills a long text, are no more work than their words."""
    opening = "all of them begin thus "
    index = decontam.Index([(i, opening + " ".join(f"w{i}x{j}" for j in range(20))) for i in range(5_000)])
    other = opening + " ".join(f"z{j}" for j in range(95))
    assert list(index.leaks(other, 0.5)) == []
    assert [x[0] for x in index.leaks(f"{other} {index.texts[7]}", 0.5)] == [7]
    assert [x[:4] for x in decontam.Index([(1, "x " * 50)]).leaks("x " * 100_000, 0.5)] == [(1, 1.0, 1, 50)]


@pytest.mark.parametrize("open_bins", [3, 512])
def test_best_fit_against_a_plain_loop(open_bins):
    rng = random.Random(open_bins)
    sizes = [rng.randint(1, 100) for _ in range(3_000)]
    bins, free, made_ = packing.OpenBins(100, open_bins), {}, 0
    for n in sizes:
        got = bins.place(n)
        fits = [f for f in free.values() if f >= n]
        if fits:
            best = [b for b, f in free.items() if f == min(fits)]
            assert got[0] in best and got[1] == 100 - free[got[0]]
        else:
            assert got == (made_, 0)
            made_ += 1
        left = free.pop(got[0], 100) - n
        if left:
            if len(free) >= open_bins:
                least = min(free.values())
                gone = [b for b, f in free.items() if f == least]
                alive = {b for row in bins.by_free for b in row}
                closed = next(b for b in gone if b not in alive)
                del free[closed]
            free[got[0]] = left
        assert sorted(b for row in bins.by_free for b in row) == sorted(free)


def test_fingerprints_against_brute_force(spark):
    rows = sorted(((r[0], r[1] or "") for r in made() if r[0] is not None and r[0] != 3), key=lambda r: -r[0])

    def hashes(text):
        return sorted({int(h) >> (64 - fingerprint.BITS) for h in common.shingle_hashes(common.word_hashes(common.lower_ascii(text)), fingerprint.SHINGLE)})[: fingerprint.K]

    def likeness(a, b):
        if not a or not b:
            return float(len(a) == len(b))
        union = sorted({*a, *b})[: fingerprint.K]
        return sum(x in a and x in b for x in union) / len(union)

    got = {r.doc_id: r for r in fingerprint.compare_edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for (i, t), (_, nxt) in zip(rows, rows[1:] + rows[:1]):
        edited = t[: len(t) - len(t) // 2] + nxt[: len(t) // 2]
        assert got[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert got[i].fingerprint == fingerprint.to_string(np.array(hashes(t), np.uint64)) and got[i].edited_fingerprint == fingerprint.to_string(np.array(hashes(edited), np.uint64))
        assert got[i].near_edited == pytest.approx(likeness(hashes(t), hashes(edited))) and got[i].near_next == pytest.approx(likeness(hashes(t), hashes(nxt)))


def test_buckets_keep_the_earliest_window():
    """A bucket that settles again and again reports what one that settles once does."""
    rng = random.Random(4)
    passage = [f"p{i}" for i in range(20)]
    docs = [(i, [f"w{rng.randrange(30)}" for _ in range(rng.randint(0, 20))] + passage[rng.randrange(4) :]) for i in range(300)]
    rng.shuffle(docs)
    found = []
    for chunk, held in ((10**9, 10**9), (400, 600)):
        old = substring.CHUNK, substring.HELD
        substring.CHUNK, substring.HELD = chunk, held
        try:
            batch = pa.RecordBatch.from_arrays([pa.array([i for i, _ in docs]), pa.array([i for i, _ in docs]), pa.array([" ".join(w) for _, w in docs])], ["doc_id", "tkey", "text"])
            dealt = pa.Table.from_batches(list(substring._deal(13, 4, 3)(iter([batch])))).sort_by("bucket").combine_chunks()
            met = pa.Table.from_batches(list(substring._match(13, 3)(iter(dealt.to_batches()))))
        finally:
            substring.CHUNK, substring.HELD = old
        windows = {(d, s + k) for d, b in zip(met["doc_id"].to_pylist(), met["blob"].to_pylist()) for s, n in np.frombuffer(b, "<i4").reshape(-1, 2).tolist() for k in range(n)}
        found.append(windows)
    assert found[0] == found[1] and len(found[0]) > 1_000


def test_stages_judge_rows_not_ids(spark, tmp_path):
    """Repeated rows, shared and missing ids, clashing columns and empty tables in every stage."""
    rng = random.Random(1)
    word = lambda k: " ".join(f"w{rng.randrange(5_000)}" for _ in range(k))
    copy, bench, other = word(60), word(40), word(50)
    rows = [(1, copy), (2, copy), (2, other), (3, f"{bench} x"), (3, word(30)), (4, other + " y"), (4, other + " y"), (None, copy), (None, word(20)), (5, None), (6, ""), (None, None), (7, word(40_000))]
    extra = "doc_id long, text string, lang string, source string, n_chars long, __n long, component_id string, found string, carried string, quality int"
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or ""), n, "c", "f", "k", 1) for n, (i, t) in enumerate(rows)], extra)
    docs.repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    stages = dict(corpus_pipeline.STAGES)
    kept = lambda df: sorted(r["__n"] for r in df.collect())
    assert kept(stages["quality classifier"](spark, d, str(tmp_path))) == list(range(13))
    near = kept(stages["near-dedup"](spark, d, str(tmp_path)))
    assert [n for n in near if n in (0, 1, 7)] == [0] and [n for n in near if n in (2, 5, 6)] == [2] and {3, 4, 8, 9, 10, 11, 12} <= set(near)
    assert kept(stages["decontamination"](spark, d, str(tmp_path))) == [n for n in range(13) if n != 3]
    cut = {r["__n"]: r.text for r in stages["substring dedup"](spark, d, str(tmp_path)).collect()}
    assert cut[0] == copy and cut[1] == "" and cut[7] == copy and cut[9] is None and cut[5].split() == cut[6].split() == ["y"]
    for name, stage in corpus_pipeline.STAGES:
        none = stage(spark, d.where("false"), str(tmp_path))
        assert none.count() == 0 and (name == "packing" or none.columns == d.columns)
    assert corpus_pipeline.run(spark, str(tmp_path)).count() > 0


def test_whole_token_ids_in_pieces(spark):
    docs = spark.createDataFrame([(1, "word " * 9_000), (1, "word"), (None, None)], "doc_id long, text string")
    pieces = packing.pack(docs).orderBy("doc_id", "piece").collect()
    whole = tokens.encoder(tokens.default_path()).ids("word " * 9_000).tolist() + [0]
    long_ = [r for r in pieces if r.doc_id == 1 and r.piece > 0 or r.length > 100]
    assert sum((r.ids for r in sorted(long_, key=lambda r: r.start)), []) == whole


def test_partitions_follow_the_files(spark, tmp_path):
    spark.range(1000).write.parquet(str(tmp_path / "t"))
    assert common.shuffle_partitions(spark.read.parquet(str(tmp_path / "t"))) == int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert common.shuffle_partitions(spark.range(10).select(F.lit("x").alias("text"))) >= 1


def test_scratch_is_released(spark, tmp_path):
    before = common.scratch_tables()
    a = common.written(spark.createDataFrame([(1,)], SCHEMA.split(",")[0]), "a")
    b = common.written(a, "b")
    common.release(spark, before, keep=b)
    assert common.scratch_tables() == before + 1 and b.count() == 1
    common.release(spark, before)


def test_segments_across_coding_steps():
    import numpy as np

    from ligandry.llm import huffman

    ids = np.random.default_rng(3).geometric(0.01, 2 * huffman.CHUNK + 700).astype(np.uint32)
    lengths = huffman.code_lengths(np.bincount(ids))
    book, table = huffman.code_book(lengths), huffman.decode_table(lengths)
    for n in (0, 1, huffman.CHUNK - 1, huffman.CHUNK, huffman.CHUNK + 1, len(ids)):
        sizes, got = huffman.decode_segment(huffman.encode_segment(np.array([n]), ids[:n], book), table)
        assert sizes.tolist() == [n] and (got == ids[:n]).all()
