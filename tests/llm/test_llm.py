"""Operators of the training-data subpackage against brute force, on small tables with awkward rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ligandry.llm import components, decontam, fingerprint, huffman, licenses, lm, minhash, packing, quality, substring, tokens, urls

LOW = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n_words long"


def made(seed=5, n=60):
    rng = random.Random(seed)
    vocabulary = ["Alpha", "beta", "gamma.", "Ünï", "|", "delta,", "the", "of", "x1"] + [f"w{i}" for i in range(60)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 80))) for _ in range(n)]
    passage = " ".join(rng.choices(vocabulary, k=30))
    for i in range(0, n, 5):
        texts[i] += " " + passage
    texts[7] = texts[3]
    texts[9] = texts[3].replace("the", "THE")
    for i in range(20, 26):
        words = texts[4].split()
        words[rng.randrange(len(words))] = "zzz"
        texts[i] = " ".join(words)
    texts[11], texts[12], texts[13], texts[14] = "", None, "one", " \t\n"
    texts[15] = " ".join(rng.choices(vocabulary, k=30_000))
    texts[16] = "a b " * 3_000
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (None, texts[4]), (None, None)]
    return [(i, t, "en", "s", len(t or ""), 0.5, 1) for i, t in rows]


@pytest.fixture(scope="module")
def rows():
    return [(r[0], r[1]) for r in made()]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(made(), SCHEMA).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_quality(spark, docs, rows, empty):
    rng = random.Random(1)
    good = [" ".join(rng.choices(["the", "of", "word", "and", "Text."], k=40)) for _ in range(150)]
    bad = [" ".join(rng.choices(["$$$", "BUY!!", "###", "NOW%%"], k=40)) for _ in range(150)]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(good + bad)] + [(900, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 150), 0) for i in range(300)] + [(1, None, 0), (2, 7, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = quality.classify(table, labels).collect()
    assert len(got) == 302
    held = [r for r in got if r.held_out]
    assert held and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got if r.doc_id is not None)
    assert np.mean([(r.predicted == 1) == (r.doc_id < 150) for r in held if r.doc_id < 300]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)
    assert quality.classify(docs, labels.where("false")).select("score").distinct().collect()[0][0] == 0.5
    assert quality.classify(empty, labels).count() == 0
    assert quality.good(docs, labels).columns == docs.columns


def test_urls(spark):
    host_rules = [("https://A.Example.com/en/7x?q", "a.example.com", "/en/7x", "example.com/en/7", "allow"), ("http://b.example.net/de/81#f", "b.example.net", "/de/81", "example.net/de/8", "block"), ("http://c.net/de/1", "c.net", "/de/1", "net/de/", "allow"), ("http://x.com/en/1", "x.com", "/en/1", "com/en/", "block"), ("http://com/fr", "com", "/fr", None, "allow"), (None, "", "", None, "allow"), ("no url", "", "", None, "allow"), ("http://h?x", "h", "", None, "allow"), ("x://", "", "", None, "allow"), ("http://notexample.org/es/1", "notexample.org", "/es/1", "org/es/", "block")]
    pages = spark.createDataFrame([(i, r[0], "h") for i, r in enumerate(host_rules)], "page_id long, url string, html string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.judge(pages, none).collect()}
    assert got == {i: r[1:] for i, r in enumerate(host_rules)}
    mined = [(i, f"http://{'spam' if i % 3 == 0 else 'fine'}.site.io/{'x' if i % 2 else 'y'}/{i}") for i in range(300)]
    labels = spark.createDataFrame([(i, int(i % 3 != 0 or i % 7 == 0), 0) for i in range(300)] + [(None, 0, 0)], "doc_id long, quality int, toxic int")
    judged = urls.judge(spark.createDataFrame(mined * 2, "page_id long, url string"), labels).collect()
    assert len(judged) == 600 and all((r.verdict == "block") == r.host.startswith("spam") for r in judged)
    assert urls.judge(pages.where("false"), labels).count() == 0


def test_url_rules_of_three_tokens(spark):
    """Pages blocked by host, folder and query key together, none of whose pairs is confident enough, against brute force."""
    kinds = [(a, b, c) for a in "xy" for b in "xy" for c in "xy"]
    sets = [(["host=" + a, "path=" + b, "query=" + c], (a, b, c) == ("x", "x", "x")) for a, b, c in kinds for _ in range(25)]
    counts, blocked = collections.Counter(), collections.Counter()
    for tokens_, bad in sets:
        for k in (1, 2, 3):
            for held in itertools.combinations(sorted(tokens_), k):
                counts[held] += 1
                blocked[held] += bad
    share = sum(blocked[x,] for x in ("host=x",)) / len(sets)
    want = {t: (n, n / counts[t]) for t, n in blocked.items() if n >= urls.MIN_COUNT and n / counts[t] >= urls.MIN_LIFT * share}
    rules = urls.mine(spark.createDataFrame(sets, "tokens array<string>, bad boolean")).collect()
    assert {tuple(r.tokens): (r.n, r.confidence) for r in rules} == want
    assert {t for t, (_, c) in want.items() if c >= urls.MIN_CONFIDENCE} == {("host=x", "path=x", "query=x")}
    pages = [(i, f"http://{a}.io/{b}/{i}?{c}=1") for i, (a, b, c) in enumerate(kinds * 25)]
    labels = [(i, int((a, b, c) != ("x", "x", "x")), 0) for i, (a, b, c) in enumerate(kinds * 25)]
    judged = urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    assert [r.page_id for r in judged if r.verdict == "block"] and all((r.verdict == "block") == (r.page_id % 8 == 0) for r in judged)


def test_url_rules_need_as_many_pages_at_any_size(spark):
    """Twenty blocked pages of one host are a rule among many labelled URLs as among few; nineteen never are."""
    for n in (100, 50_000):
        host = F.when(F.col("id") < 20, "host=bad").when(F.col("id") < 39, "host=few").otherwise("host=fine")
        rules = urls.mine(spark.range(n).select(F.array(host).alias("tokens"), (F.col("id") < 39).alias("bad"))).collect()
        assert [(r.tokens, r.n, r.confidence) for r in rules] == [(["host=bad"], 20, 1.0)]


def test_fingerprints(spark, docs, rows, empty):
    got = fingerprint.compare_edited(docs).collect()
    order = sorted(((i, t or "") for i, t in rows), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = collections.Counter()
    for (i, t), (_, nxt) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        edited = t[: len(t) - half] + nxt[:half]
        want[i, len(t), hashlib.sha256(edited.encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert fingerprint.compare_edited(empty).count() == 0
    a, b = "one two three four five six seven", "two three four five six seven eight"
    assert fingerprint.resemblance(fingerprint.sketch(a), fingerprint.sketch(b)) == pytest.approx(2 / 4)
    assert fingerprint.containment(fingerprint.sketch(a), fingerprint.sketch(b)) == pytest.approx(2 / 3)
    s = fingerprint.sketch(rows[15][1])
    assert (fingerprint.from_string(fingerprint.to_string(s)) == s).all() and len(s) == fingerprint.K
    words = rows[15][1].translate({i: i + 32 for i in range(65, 91)}).split()
    assert fingerprint.distinct(s) == pytest.approx(len(set(zip(*(words[i:] for i in range(5))))), rel=0.3)
    parts = spark.createDataFrame([("k", fingerprint.to_string(fingerprint.sketch(a))), ("k", fingerprint.to_string(fingerprint.sketch(b))), ("e", "")], "key string, fingerprint string")
    merged = {r.key: r.fingerprint for r in fingerprint.merged(parts, "key").collect()}
    assert merged["k"] == fingerprint.to_string(fingerprint.merge(fingerprint.sketch(a), fingerprint.sketch(b)))


def brute_repeats(rows, window=13):
    first, out = {}, collections.Counter()
    for i, t in rows:
        w = (t or "").encode().split()
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                first[key] = min(first.get(key, i), i)
    for i, t in rows:
        w = (t or "").encode().split()
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and first[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[i, len(w), sum(gone), b" ".join(x for x, g in zip(w, gone) if not g).decode()] += 1
    return out


@pytest.mark.parametrize("chunk", [4 << 20, 500])
def test_substring(spark, docs, rows, empty, chunk, monkeypatch):
    monkeypatch.setattr(substring, "CHUNK", chunk)
    monkeypatch.setattr(substring, "HELD", 2_000 if chunk == 500 else substring.HELD)
    got = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in substring.remove_repeats(docs).collect())
    assert got == brute_repeats(rows)
    assert substring.remove_repeats(empty).count() == 0
    assert substring.without_repeats(docs).columns == docs.columns


def test_equal_hashes_are_compared():
    codes = np.array([1, 2, 1, 3, 1, 2, 1, 3], np.int32)
    found = substring.repeated(codes, np.zeros(4, np.uint64), np.array([0, 2, 4, 6]), np.array([0, 1, 2, 3]), 2)
    assert found.tolist() == [False, False, True, True]


def test_huffman(spark, docs, rows, empty):
    rng = np.random.default_rng(0)
    for counts in (np.array([5]), np.array([1, 1]), rng.integers(0, 50, 40), 2 ** np.arange(24)):
        for limit in (6, 20):
            n = huffman.code_lengths(counts, limit)
            used = n[n > 0].astype(float)
            assert (n > 0).tolist() == (counts > 0).tolist() and (2.0**-used).sum() <= 1 and used.max() <= max(limit, math.ceil(math.log2(len(used))) if len(used) > 1 else 1)
    ids = rng.integers(0, 300, 5_000).astype(np.uint32)
    counts = np.bincount(ids)
    n = huffman.code_lengths(counts)
    sizes = np.array([0, 10, 1_990, 3_000])
    blob = huffman.encode_segment(sizes, ids, huffman.code_book(n))
    got_sizes, back = huffman.decode_segment(blob, huffman.decode_table(n))
    assert (back == ids).all() and (got_sizes == sizes).all()
    encoder = tokens.encoder(tokens.default_path())
    got = sorted(huffman.round_trip(docs).collect(), key=lambda r: r.start)
    want = sorted(((i, encoder.whole.encode(t or "", add_special_tokens=False).ids + [0]) for i, t in rows), key=lambda r: (r[0] is not None, r[0] or 0, np.array(r[1], "<u2").tobytes()))
    at = 0
    for r, (i, x) in zip(got, want, strict=True):
        assert (r.doc_id, r.start, r.n_tokens, r.ids, r.ids_crc32) == (i, at, len(x), x, zlib.crc32(np.array(x, "<u4").tobytes()))
        at += len(x)
    assert huffman.round_trip(empty).count() == 0


@pytest.mark.parametrize("text", ["a  b", " a", "a\n\nb", "dog's, 'll <|endoftext|> x", "日本 語.\nabc", "a\tb", "a　b c", "12.5, 3.\n4 x.y, e.", "a.b., c,,", "½, ².", "word*** x.'s don't, é%%% !! a\nb.,", "Ԁa слово, λόγος."])
def test_units_encode_as_whole(text):
    e = tokens.encoder(tokens.default_path())
    assert e.ids(text).tolist() == e.whole.encode(text, add_special_tokens=False).ids


def test_packing(docs, rows, empty):
    got = packing.pack(docs).collect()
    used = collections.defaultdict(list)
    for r in got:
        used[r.sequence_id].append((r.offset, r.length))
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes()) and len(r.ids) == r.length
    for parts in used.values():
        at = 0
        for offset, n in sorted(parts):
            assert offset == at
            at += n
        assert at <= packing.LENGTH
    assert sum(r.length for r in got) == sum(len(tokens.encoder(tokens.default_path()).ids(t or "")) + 1 for _, t in rows)
    assert packing.pieces(5_000) == [(0, 904), (904, 2048), (2952, 2048)] and packing.pieces(2048) == [(0, 2048)]
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7, 4, 3, 8, 9, 2)] == [(0, 0), (1, 0), (0, 6), (1, 7), (2, 0), (3, 0), (2, 8)]
    assert packing.pack(empty).count() == 0


def words_of(text):
    return [w.decode() for w in re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(LOW))]


def test_licenses(spark, docs, rows):
    texts = ["Released under the MIT License.", "x CC BY-NC cc by nc y", "This work is licensed under the GNU General Public License, version 3.", "the gnu of general words", "Apache License, Version 2.0 " + "word " * 5_000, None, "", "Ünder the MIT license", "under the mit licenses"]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in licenses.scan(table.union(docs.select(F.col("doc_id") + 1000, "text"))).collect()}
    assert [got[i].labels for i in range(9)] == ["mit", "cc-by-nc", "gpl-3", "", "apache-2", "", "", "", ""]  # Ünder is another word
    assert (got[1].n_base, got[1].first_word, got[1].last_word) == (2, 1, 4) and got[2].n_base == 0 and got[2].score > 0.9
    assert got[5].n_words == 0 and got[5].first_word is None and got[6].score == 0
    for i, t in enumerate(texts):
        assert got[i].n_words == len(words_of(t))


def test_licenses_in_mixed_and_long_texts(spark):
    """Every template with a key phrase and enough words in place counts, whatever other template words a text holds."""
    rng = random.Random(8)
    notices = [t for _, t, _ in licenses.TEMPLATES]
    gpl = "this work is licensed under the gnu general public license version 3"
    texts = [f"{notices[0]} and {gpl}", f"{notices[9]} . {notices[0]} . {notices[2]}", f"any can charge copy files form {gpl}", " ".join(notices)]
    loose = sorted({w for t in notices for w in t.split()})
    for _ in range(40):
        parts = []
        for t in rng.sample(notices, 3):
            words = t.split()
            for at in rng.sample(range(len(words)), rng.randrange(len(words) // 3)):
                words[at] = rng.choice(loose)
            parts += rng.choices(loose, k=rng.randrange(12)) + words
        texts.append(" ".join(parts))
    texts += ["any can charge copy files form"] * 2 + ["license gnu general public"] * 30

    def want(text):
        words, found = text.split(), set()
        for label, notice, key in licenses.TEMPLATES:
            t = notice.split()
            shares = (sum(0 <= at + p < len(words) and words[at + p] == w for p, w in enumerate(t)) / len(t) for at in range(-len(t), len(words)))
            if f" {key} " in f" {' '.join(words)} " and max(shares) >= licenses.MIN_MATCH:
                found.add(label)
        return ",".join(sorted(found | {label for phrase, label in licenses.PHRASES.items() if f" {phrase} " in f" {' '.join(words)} "}))

    texts = [" ".join(words_of(t)) for t in texts]
    got = {r.doc_id: r.labels for r in licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert (got[0], got[1], got[2]) == ("gpl-3,mit", "apache-2,bsd-3,mit", "gpl-3")
    assert got == {i: want(t) for i, t in enumerate(texts)}


def test_lm(docs, rows, empty):
    trains = lambda i: i is None or zlib.crc32(str(i).encode()) % 5 != 1
    split = [(i, (t or "").encode().translate(LOW).split() + [None]) for i, t in rows]
    c = collections.Counter(w for i, ws in split if trains(i) for w in ws)
    n, v = sum(c.values()), len(c)
    want = sorted((str(i), not trains(i), len(ws), sum(c[w] > 0 for w in ws), n, round(sum(math.log10((c[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 4)) for i, ws in split)
    for head, share in ((1 << 17, 8.0), (20, 0.1)):
        got = lm.score(docs, head=head, share=share).collect()
        assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 4)) for r in got) == want
        assert all(r.score < 0 for r in got)
    assert lm.score(empty).count() == 0


def brute_links(rows, k, percent=80):
    sets = {}
    for i, t in rows:
        w = (t or "").encode().translate(LOW).split()
        sets[i] = set(zip(*(w[j:] for j in range(k)))) if len(w) >= k else ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(i for i in sets if i is not None and sets[i])
    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in sets}


@pytest.mark.parametrize(("k", "large"), [(2, 256), (5, 256), (2, 3)])
def test_minhash(docs, rows, empty, k, large, monkeypatch):
    monkeypatch.setattr(minhash, "LARGE", large)
    monkeypatch.setattr(minhash, "TILE", 4 if large == 3 else 2_048)
    if large == 3:  # parts of a bucket, and texts joined by shuffle, too
        for name, value in (("PART", 4), ("RUNG", 2), ("BROADCAST_IDS", 0)):
            monkeypatch.setattr(minhash, name, value)
    want = brute_links(rows, k)
    got = minhash.near_duplicates(docs, shingle=k).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert (r.n_shingles, r.component_id, r.kept) == (*want[r.doc_id], want[r.doc_id][1] == r.doc_id)
    assert minhash.near_duplicates(empty).count() == 0


@pytest.mark.parametrize(("large", "part"), [(256, 1 << 16), (4, 8)])
def test_buckets_of_several_components(spark, large, part, monkeypatch):
    """Families around one text share buckets within and across the threshold."""
    for name, value in (("LARGE", large), ("TILE", 8), ("PART", part), ("RUNG", 4)):
        monkeypatch.setattr(minhash, name, value)
    rng, base, rows = random.Random(8), [f"w{i}" for i in range(120)], []
    for i in range(160):
        words = list(base)
        for at in rng.sample(range(120), 2 if i % 2 else rng.randrange(4, 12)):
            words[at] = f"x{rng.randrange(10**6)}"
        rows.append((i, " ".join(words)))
    want = brute_links(rows, 2)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), shingle=2).collect()}
    assert got == want
    assert 1 < len({c for _, c in want.values()}) < 160


def test_components_beyond_one_task(spark):
    rng = random.Random(2)
    edges = [(i, i + 1) for i in range(40)] + [(rng.randrange(50, 90), rng.randrange(50, 90)) for _ in range(30)] + [(7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    small, large = ({r.node: r.label for r in components.components(df, bound=b).collect()} for b in (10**6, 5))
    assert small == large and small[40] == 0


def test_decontamination(spark, empty):
    item = "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    w = item.split()
    texts = [f"start {item.lower()}! end", " ".join(w[6:] + ["other"] + w[:6]), " ".join(w[:4]) + " and then nothing", "clean text of other words entirely", None, "", "tiny item", "x " * 20_000 + item]
    table = spark.createDataFrame([(i, t, "clash") for i, t in enumerate(texts)] + [(0, texts[0], "again")], "doc_id long, text string, coverage string")
    bench = spark.createDataFrame([(1, item), (1, item), (2, None), (3, ""), (4, "Tiny, item"), (None, "clean text of other")], "item_id long, text string")
    got = collections.Counter((r.doc_id, r.item_id) for r in decontam.leaks(table, bench).collect())
    assert got == {(0, 1): 2, (1, 1): 1, (6, 4): 1, (7, 1): 1}
    assert {r.n_tiles for r in decontam.leaks(table.where("doc_id = 1"), bench).collect()} == {2}
    assert decontam.leaks(empty, bench).count() == decontam.leaks(table, bench.where("false")).count() == 0


def test_decontamination_folds_every_letter(spark):
    passage = "mañana el niño español cruzó la frontera über die straße łódź οδός"
    bench = spark.createDataFrame([(1, passage), (2, passage.upper())], "item_id long, text string")
    table = spark.createDataFrame([(1, f"x {passage.upper()} y"), (2, passage), (3, "manana el nino espanol")], "doc_id long, text string")
    got = {(r.doc_id, r.item_id): r.coverage for r in decontam.leaks(table, bench).collect()}
    assert got == {(d, i): 1.0 for d in (1, 2) for i in (1, 2)}


def test_tiles_against_greedy():
    rng = random.Random(4)
    for _ in range(200):
        a, b = ([rng.randrange(4) for _ in range(rng.randint(2, 14))] for _ in range(2))
        pairs = [(i, j) for i in range(len(a) - 1) for j in range(len(b) - 1) if a[i : i + 2] == b[j : j + 2]]
        if not pairs:
            continue
        found = decontam.tiles(np.array(a), np.array(b), 2)
        used_a = [i + k for i, _, n in found for k in range(n)]
        used_b = [j + k for _, j, n in found for k in range(n)]
        assert len(set(used_a)) == len(used_a) and len(set(used_b)) == len(used_b)
        assert all(a[i : i + n] == b[j : j + n] and n >= 2 for i, j, n in found)
        free_a, free_b = set(range(len(a))) - set(used_a), set(range(len(b))) - set(used_b)
        assert not [1 for i, j in pairs if {i, i + 1} <= free_a and {j, j + 1} <= free_b]


def test_pipeline(spark, docs, tmp_path):
    bench = "Alpha beta unique benchmark words that stand in one place only here"
    extra = [(500, bench + " more words", "en", "s", 10, 0.1, 1), (501, "$$$ BUY!! ### NOW%% " * 10, "en", "s", 10, 0.1, 1)]
    table = docs.drop("score", "n_words").union(spark.createDataFrame(extra, SCHEMA).drop("score", "n_words"))
    rng = random.Random(1)
    bad = [(600 + i, " ".join(rng.choices(["$$$", "BUY!!", "###", "NOW%%"], k=40)), "en", "s", 1) for i in range(60)]
    table = table.union(spark.createDataFrame(bad, "doc_id long, text string, lang string, source string, n_chars long"))
    table.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(i, 1, 0) for i in range(60)] + [(600 + i, 0, 0) for i in range(60)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, bench)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    d = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        d = stage(spark, d, str(tmp_path))
        assert d.columns == table.columns
    kept = {r.doc_id for r in d.collect()}
    assert 500 not in kept and 501 not in kept and not kept & set(range(600, 660)) and 7 not in kept and {3, 15, 16} <= kept
    packed = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in packed.select("doc_id").collect()} == kept
