"""Decontamination, token counts, BPE, language, toxicity and language-model scores."""

import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from auric.llm import bpe, decontaminate, language, lm_score, token_count, toxicity
from auric.llm.arrowtext import SpanHasher, flat, slices
from auric.llm.queries import tokenizer
from tests.llm.cases import LONG, ROWS, documents

FILE = tokenizer("byte_bpe_50k.json")
BITS = ["'", " ", "  ", "\n", "\t", "s", "t", "re", "ve", "ll", "l", "r", "v", "e", "d", "m", "a", "Z", "9", "1", "!", "''", "é", "ß", " ",
        "　", "中", "文", "🙂", "<|endoftext|>", "<|endof", "́", "²", "\x00", "don't", "aaaaaaaa", "-----", "\r\n", "\x85"]


def noise(seed, n, longest=40):
    rng = random.Random(seed)
    return ["".join(rng.choice(BITS) for _ in range(rng.randrange(longest))) for _ in range(n)] + ["", "a" * 3000, " " * 700, "x" * 901 + " ", LONG]


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def plain_hits(text, items, window=10):
    w, hit, found = words(text), set(), set()
    for item, t in items:
        b = words(t)
        n = min(window, len(b))
        pats = {tuple(b[k: k + n]) for k in range(len(b) - n + 1)} if n else set()
        for k in range(len(w) - n + 1):
            if n and tuple(w[k: k + n]) in pats:
                hit |= set(range(k, k + n))
                if item is not None:
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


@pytest.mark.parametrize("blocks", [1, 3])
def test_decontamination_matches_plain_search(spark, blocks):
    rng = random.Random(blocks)
    vocab = [f"w{k}" for k in range(40)] + ["Été", "ÀB", "x1"]
    items = [(k, " ".join(rng.choice(vocab) for _ in range(rng.choice([1, 4, 10, 14, 25])))) for k in range(12)] + [(3, "w1 w2"), (None, "w5 w6 w7"), (20, None), (21, "..")]
    items = [x for x in items if len(words(x[1] or "")) != 1]
    texts = []
    for _ in range(60):
        t = [rng.choice(vocab) for _ in range(rng.randrange(60))]
        for _, item in rng.sample(items, 2):
            at = rng.randrange(len(t) + 1)
            cut = (item or "").split()
            t[at:at] = cut[rng.randrange(3):]
        texts.append(rng.choice([" ", ", ", "\n"]).join(t).replace("w1", "W1"))
    rows = list(enumerate(texts)) + [(None, None), (99, ""), (99, "")]
    size = sum(len((t or "").encode()) for _, t in items)
    found = decontaminate.find_passages(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string"),
                                        block_bytes=-(-size // blocks))
    got = sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.digest(found).collect())
    want = []
    for d, t in rows:
        n, hit, ids = plain_hits(t, items)
        ids.sort(key=lambda x: x.encode())
        want.append((str(d), n, hit, len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), hit > 0))
    assert got == sorted(want)


def test_decontamination_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog near the old")], "item_id int, text string")
    got = decontaminate.digest(decontaminate.find_passages(documents(spark), bench)).collect()
    assert len(got) == len(ROWS) and sum(r.n_hit for r in got) == 33
    none = decontaminate.digest(decontaminate.find_passages(documents(spark), bench.limit(0))).collect()
    assert len(none) == len(ROWS) and not any(r.contaminated for r in none)
    assert decontaminate.find_passages(documents(spark).limit(0), bench).count() == 0


def test_token_counts_match_library():
    library, counter = Tokenizer.from_file(FILE), token_count.Counter(open(FILE).read())
    texts = noise(1, 3000)
    got = []
    for batch in slices(pa.RecordBatch.from_arrays([pa.array(texts)], names=["t"]), "t", 20_000):
        got += counter.counts(*flat(batch.column("t"))).tolist()
    assert got == [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]


def test_token_counts_survive_full_tables(monkeypatch):
    monkeypatch.setattr(token_count, "MAX_PIECES", 10)
    monkeypatch.setattr(token_count, "MAX_STATES", 20)
    library, counter = Tokenizer.from_file(FILE), token_count.Counter(open(FILE).read())
    for t in noise(4, 100):
        assert counter.counts(*flat(pa.array([t])))[0] == len(library.encode(t, add_special_tokens=False).ids)


def test_token_counter_is_compiled_once_a_worker():
    definition = open(FILE).read()
    assert token_count.counter(definition) is token_count.counter(definition)


def test_token_count_rows(spark):
    library = Tokenizer.from_file(FILE)
    got = token_count.count_tokens(documents(spark), FILE).collect()
    want = [(str(d), len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 512) for d, t, _ in ROWS]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(want)
    assert token_count.count_tokens(documents(spark).limit(0), FILE).count() == 0


@pytest.mark.parametrize("window,chunk", [(16, 512), (2, 3)])
def test_bpe_matches_library(monkeypatch, window, chunk):
    monkeypatch.setattr(bpe, "WINDOW_BYTES", window)
    monkeypatch.setattr(bpe, "CHUNK_BYTES", chunk)
    library, encoder = Tokenizer.from_file(FILE), bpe.Encoder(open(FILE).read())
    texts = noise(2, 600, 80)[:-1]
    got = encoder.encode(*flat(pa.array(texts)))
    for text, ids in zip(texts, got):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert encoder.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_bpe_rows(spark):
    library = Tokenizer.from_file(FILE)
    got = bpe.digest(bpe.encode(documents(spark), FILE)).collect()
    want = []
    for d, t, _ in ROWS:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want.append((str(d), len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(library.decode(ids, skip_special_tokens=False).encode()).hexdigest()))
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == sorted(want)
    assert bpe.encode(documents(spark).limit(0), FILE).count() == 0


SF = "/root/testdata/sf0.01"


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs.where(~language.held_out()))
    got = language.identify(docs.where(language.held_out()), model, keep=["lang"]).collect()
    assert len(got) > 100 and sum(r.lang == r.lang_pred for r in got) >= 0.98 * len(got)
    odd = language.identify(documents(spark), model).collect()
    assert len(odd) == len(ROWS) and {r.lang_pred for r in odd if r.doc_id in (3, 4, 5, 6)} == {"und"}
    assert all(0 <= r.score <= 1 for r in odd)


def test_language_without_labels(spark):
    docs = documents(spark)
    assert language.fit(docs.where("lang = 'xx'")) is None
    assert {r.lang_pred for r in language.identify(docs, None).collect()} == {"und"}
    one = language.fit(docs.where("lang = 'de'"))
    assert {r.lang_pred for r in language.identify(docs, one).collect()} == {"und", "de"}


def test_language_is_fitted_by_a_task(spark, monkeypatch):
    """What is learnt from does not pass through the driver, which gets the machines alone."""
    def whole(*_):
        raise AssertionError("rows were fetched")

    for name in ("toArrow", "toPandas"):
        monkeypatch.setattr(type(spark.range(1)), name, whole)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = language.fit(docs)
    assert isinstance(model, language.Model) and model.weights.shape[0] == language.BUCKETS and len(model.langs) > 1
    assert "x" not in vars(model) and sum(v.nbytes for v in vars(model).values() if hasattr(v, "nbytes")) < 1 << 20


def test_families():
    assert language.family("EN-us") == "germanic" and language.family("fr") == "romance" and language.family("xx") == "other:xx"


def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    machine = toxicity.fit(docs, labels.where(~toxicity.held_out()))
    got = toxicity.score(docs.join(labels.where(toxicity.held_out()), "doc_id"), machine, keep=["doc_id", "toxic"]).collect()
    toxic, clean = [r for r in got if r.toxic], [r for r in got if not r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic) and sum(r.predicted for r in clean) <= 0.01 * len(clean)


def test_toxicity_pairs():
    """Only the pair of terms is toxic: a linear model cannot tell, the factors can."""
    a, b = np.uint32(11), np.uint32(22)
    rows, labels = [], []
    rng = np.random.default_rng(1)
    for k in range(2000):
        x = [t for t in (a, b) if rng.random() < 0.5] + [np.uint32(100 + rng.integers(5))]
        rows.append(np.unique(np.array(x, np.uint32)))
        labels.append(a in x and b in x)
    machine = toxicity.Machine(rows, np.array(labels, np.float32))
    number = {int(t): k for k, t in enumerate(machine.terms)}
    value = lambda *t: machine.value(np.zeros(len(t), np.int64), np.array([number[x] for x in t]), 1)[0][0]
    assert value(11, 22) > 0 > max(value(11), value(22))


@pytest.mark.parametrize("case", ["both or neither", "neutral beside an insult"])
def test_toxicity_of_terms_that_tell_nothing_alone(case):
    rng = np.random.default_rng(1)
    rows, labels = [], []
    for k in range(4000):
        noise = [100 + t for t in rng.integers(0, 400, 12)]
        if case == "both or neither":
            a, b = rng.random() < 0.5, rng.random() < 0.5
            x, toxic = [11] * a + [22] * b, a == b
        else:  # a group's name is as often toxic as any text, but always beside an insult
            insult, group = rng.random() < 0.3, rng.random() < 0.2
            other = not group and rng.random() < 0.3
            x, toxic = [11] * insult + [22] * group + [33] * other, (insult and group) or other
        rows.append(np.unique(np.array(x + noise, np.uint32)))
        labels.append(toxic)
    machine = toxicity.Machine(rows, np.array(labels, np.float32))
    number = {int(t): k for k, t in enumerate(machine.terms)}

    def value(*terms):
        at = np.array([number[t] for t in terms if t in number], np.int64)
        return machine.value(np.zeros(len(at), np.int64), at, 1)[0][0]

    assert value(11, 22) > 1 and value(11) < -1 and value(22) < -1
    assert value() > 0 if case == "both or neither" else value(33) > 0 > value()


def test_toxicity_learns_from_long_texts(spark):
    """The class that is found in long texts only, more than 64 KB each, is learnt."""
    filler = "the old river and the bank by the town are green in early may when all of it was new"
    rows = [(k, " ".join([filler] * (700 if k % 4 == 0 else 1)) + (" nastiest" if k % 4 == 0 else "")) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    machine = toxicity.fit(docs, spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)], "doc_id long, toxic int"))
    got = toxicity.score(spark.createDataFrame([(0, "so nastiest it is"), (1, "so it is")], "doc_id long, text string"), machine).collect()
    assert {r.doc_id: r.predicted for r in got} == {0: 1, 1: 0}


def test_language_of_long_texts(spark, monkeypatch):
    """A language found in long texts only is learnt, and n-grams count alike in chunks and at once."""
    data, offsets = flat(pa.array(["Über den Fluß", "", None, "the river bank " * 50, "é"]))
    whole = language.frequencies(data, offsets)
    monkeypatch.setattr(language, "CHUNK", 7)
    assert np.allclose(language.frequencies(data, offsets), whole)
    monkeypatch.undo()
    rows = [(k, "der Fluss und die Stadt am alten Ufer " * 30_000, "de") for k in range(3)] + [(k, f"the old river and bank {k} today", "en") for k in range(10, 40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(3)
    model = language.fit(docs)
    assert model.langs == ["de", "en"]
    assert {r.lang_pred for r in language.identify(docs.where("doc_id < 3"), model).collect()} == {"de"}


def test_toxicity_of_odd_rows(spark):
    docs = documents(spark)
    none = toxicity.fit(docs, spark.createDataFrame([(1, None), (None, 1)], "doc_id long, toxic int"))
    got = toxicity.score(docs, none).collect()
    assert len(got) == len(ROWS) and {r.score for r in got} == {0.0}


def test_language_model(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = lm_score.fit(docs.unionByName(documents(spark), allowMissingColumns=True))
    got = lm_score.score(documents(spark), model).collect()
    assert len(got) == len(ROWS)
    assert all(r.mean_log_likelihood is None and r.log_likelihood == 0 for r in got if r.doc_id in (3, 4))
    # the sum over a text is what the network gives token by token
    counts, net = model
    text = ROWS[0][1]
    token, first = lm_score.tokens(*flat(pa.array([text])), SpanHasher())
    klass = counts.klass[token]
    want = 0.0
    for k in range(len(token)):
        near = [klass[j] if 0 <= j < len(token) else lm_score.CLASSES for j in (k - 2, k - 1, k + 1, k + 2)]
        z = np.tanh(net.shift + sum(net.embed[p][c] for p, c in enumerate(near))) @ net.out + net.base
        want += z[klass[k]] - np.log(np.exp(z).sum()) + counts.share[token[k]]
    assert abs(next(r.log_likelihood for r in got if r.doc_id == 1) - want) < 1e-2
    # shares of a class add up to one
    assert np.allclose(np.bincount(counts.klass, np.exp(counts.share.astype(float)), lm_score.CLASSES), 1, atol=1e-3)
    shuffled = [(0, " ".join(random.Random(k).sample(t.split(), len(t.split())))) for k, t in enumerate(r.text for r in docs.limit(300).collect())]
    before = lm_score.score(docs.limit(300), model).agg({"mean_log_likelihood": "avg"}).first()[0]
    after = lm_score.score(spark.createDataFrame(shuffled, "doc_id long, text string"), model).agg({"mean_log_likelihood": "avg"}).first()[0]
    assert before > after
    assert lm_score.score(documents(spark).limit(0), lm_score.fit(documents(spark).limit(0))).count() == 0


def test_language_model_counts_whole_words(spark, monkeypatch):
    """Each word keeps its own count, however many there are; rare words' counts come by the join."""
    from pyspark.sql import functions as F

    monkeypatch.setattr(lm_score, "COMMON", 200)
    rows = [(k, " ".join(f"w{j}x" for j in range(k, 300_000, 300) for _ in range(2 if j % 7 == 0 else 1)) + " the" * 50) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    counts, net = model = lm_score.fit(docs)
    assert counts.table.count() == 300_001 and len(counts.token) <= 200
    assert counts.classes > lm_score.CLASSES + 1 - lm_score.OWN and lm_score.fit(docs.limit(1))[0].table.count() == 1001
    token, first = lm_score.tokens(*flat(pa.array(["the w7x w8x never-seen"])), SpanHasher())
    klass, share = counts.klass[token], counts.share[token]
    assert klass[0] < lm_score.OWN and share[0] == 0
    assert np.isclose(share[1] - share[2], np.log(2) if klass[1] == klass[2] else share[1] - share[2])
    for k, n in ((1, 2), (2, 1), (3, 1)):
        assert np.isclose(share[k], np.log(n / counts.mass[klass[k] - lm_score.OWN]))
    got = lm_score.score(docs.where(F.col("doc_id") == 7), model).first()
    text = rows[7][1]
    token, first = lm_score.tokens(*flat(pa.array([text])), SpanHasher())
    klass = counts.klass[token]
    logs = net.logs(net.hidden(lm_score.contexts(klass, first)))[np.arange(len(token)), klass]
    assert abs(got.log_likelihood - float((logs + counts.share[token]).sum())) < 0.1
    assert got.n_tokens == len(token)


def test_own_classes_grow_with_the_vocabulary(spark):
    token, n = np.arange(2000) * 32, np.arange(2000, 0, -1)
    few, more, most = (lm_score.Counts(None, token, n, np.full(32, 1e9), v) for v in (1000, 500_000, 10 ** 9))
    assert [len(c.own) for c in (few, more, most)] == [lm_score.OWN, 122, lm_score.MOST_OWN]
    assert most.classes == lm_score.CLASSES + 1 + lm_score.MOST_OWN - lm_score.OWN
    assert lm_score.CLASSES not in set(most.class_of(token).tolist())
