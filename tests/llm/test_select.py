"""Quality rules and importance resampling against plain Python, on odd rows and on labelled rows held out."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import xxhash

from auric.llm import intern, quality, resample
from tests.llm.cases import LONG, ROWS, documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_spans_are_interned_by_their_bytes():
    rng = random.Random(1)
    raw = np.frombuffer(bytes(rng.randrange(97, 99) for _ in range(3000)), np.uint8)
    buf = intern.padded(raw)
    start = np.array([rng.randrange(2400) for _ in range(2000)])
    size = np.array([rng.choice([0, 1, 3, 7, 8, 12, 31, 32, 40, 300, 500]) for _ in range(2000)])
    texts = [raw[a:a + n].tobytes() for a, n in zip(start, size)]
    for seed in (0, 42):
        assert intern.xxhash64(buf, start, size, seed).tolist() == [xxhash.xxh64_intdigest(t, seed) for t in texts]
    for key in (intern.xxhash64(buf, start, size), np.zeros(2000, np.uint64)):  # all under one key: only the bytes tell
        slot, holder = intern.intern(buf, start, size, key)
        assert len({*zip(texts, slot.tolist())}) == len({*texts}) == len({*slot.tolist()}) == (holder >= 0).sum()
        slot, _ = intern.intern(buf, start, size, key, np.arange(2000) % 3)
        assert len({*slot.tolist()}) == len({(t, k % 3) for k, t in enumerate(texts)})
    assert intern.strings(buf, start[:9], size[:9]).to_pylist() == [t.decode() for t in texts[:9]]


def brute_counts(text):
    words = WORD.findall(text or "")
    windows = [tuple(words[k:k + 5]) for k in range(len(words) - 4)]
    seen, cover, lines, dup = collections.Counter(windows), set(), set(), 0
    for k, w in enumerate(windows):
        if seen[w] > 1:
            cover.update(range(k, k + 5))
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in lines
            lines.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(cover)


ODD = ["a b c d e a b c d e", "same line\nother\nsame line\n\n \nsame line", "x\r\nx\ny\nx\r", "é ü|é ü|é ü # 中文 中文", "w " * 40, "\n\n", "<<>> **", LONG]


def test_statistics_match_plain_python(spark):
    texts = ODD + [t for _, t, _ in ROWS]
    got = quality.statistics(spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")).collect()
    assert len(got) == len(texts)
    for r in got:
        n = brute_counts(texts[r.id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == n
        assert r.base_failed == (n[0] < 10 or 100 * n[4] > 20 * n[0])


def test_quality_of_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (7, 0), (None, 1), (9, None)], "doc_id long, quality int")
    got = quality.quality(documents(spark), labels).collect()
    assert len(got) == len(ROWS) and all(r.kept is not None and not (r.kept and r.base_failed) for r in got)
    alone = quality.quality(documents(spark), labels.limit(0)).collect()
    assert all(r.kept == (not r.base_failed) for r in alone)
    assert quality.quality(documents(spark).limit(0), labels).count() == 0


def test_quality_on_labels_held_out(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9)))
    rows, labels = [], []
    for k in range(1500):
        words = [word() for _ in range(rng.randrange(15, 120))]
        bad = k % 5 == 0
        text = " | ".join(words) if bad and k % 2 else "$$ ".join(words) if bad else " ".join(words)
        rows.append((k, text))
        labels.append((k, int(not bad)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels[:700], "doc_id long, quality int")
    kept = {r.doc_id: r.kept for r in quality.quality(df, known).collect()}
    held = [(kept[k], good) for k, good in labels[700:]]
    assert sum(k for k, good in held if good) >= 0.97 * sum(good for _, good in held)
    assert sum(k for k, good in held if not good) <= 0.03 * sum(not good for _, good in held)


def test_forest_tells_isolated_points():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(2000, 2))
    forest = quality.Forest(x)
    assert forest.scores(np.array([[9.0, 9.0]])) > np.quantile(forest.scores(x), 0.999)
    one = quality.Forest(x[:, :1])
    points, one.points = one.points, None
    assert len(points) and np.array_equal(quality.Forest(x[:, :1]).scores(x[:, :1]), one.scores(x[:, :1]))
    assert quality.Forest(x[:0]).scores(x).tolist() == [0.0] * 2000


def features(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), words + [f"{a} {b}" for a, b in zip(words, words[1:])]


def brute_resample(rows, targets, percent, seed, buckets, least):
    bucket = lambda f: zlib.crc32(f.encode()) % buckets
    made = [(i, *features(t)) for i, t in rows]
    s, t = (collections.Counter(bucket(f) for fs in side for f in fs) for side in ([m[2] for m in made], [features(x)[1] for x in targets]))
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
    out, able = [], []
    for i, n, fs in made:
        weight = sum(gain(bucket(f)) for f in fs) // len(fs) if fs else 0
        h = None if i is None else int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
        score = None if h is None else weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append((i, len(fs), weight, score))
        if n >= least and i is not None:
            able.append((-score, i))
    able.sort()
    return out, [(i, -s) for s, i in able[:len(able) * percent // 100]]


def same_draw(got, rows, drawn):
    assert sorted(map(str, ((r.doc_id, r.n_features, r.weight, r.score) for r in got))) == sorted(map(str, rows))
    first = sorted((r["rank"], r.doc_id, r.score) for r in got if r["rank"] is not None)
    assert [x[0] for x in first] == list(range(1, len(drawn) + 1)) and [x[1:] for x in first] == drawn


def test_resampling_matches_plain_python(spark, monkeypatch):
    monkeypatch.setattr(resample, "BLOCK_WORDS", 50)  # texts are counted in several parts
    rng = random.Random(2)
    words = ["alpha", "Beta", "gamma", "δέλτα", "e1", "f"]
    rows = [(k, " ".join(rng.choice(words) for _ in range(rng.randrange(70)))) for k in range(400)]
    rows += [(5, rows[5][1])] * 150 + [(None, "alpha beta " * 30)]
    targets = ["gamma gamma e1", None, "", "beta, beta: f"]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(t,) for t in targets], "text string")
    got = resample.resample(docs, target, percent=40, buckets=64).collect()
    same_draw(got, *brute_resample(rows, targets, 40, 7, 64, 20))


def test_resampling_of_odd_rows(spark):
    target = spark.createDataFrame([("the quick brown fox",)], "text string")
    got = resample.resample(documents(spark), target, percent=50, min_words=5).collect()
    same_draw(got, *brute_resample([(i, t) for i, t, _ in ROWS], ["the quick brown fox"], 50, 7, 10_000, 5))
    assert resample.resample(documents(spark).limit(0), target).count() == 0
    assert resample.resample(documents(spark), target.limit(0)).count() == len(ROWS)


def test_resample_bounds_batches(spark):
    """The operator's tasks get small Arrow batches, as each of a batch's texts is in memory several times over."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    try:
        spark.conf.set(name, "10000")
        docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
        resample.resample(docs, docs.select("text")).collect()
        assert int(spark.conf.get(name)) < 10000
    finally:
        spark.conf.set(name, before)
