"""Phrase collocations against plain Python: several searches, small blocks and crowded maps, odd rows."""

import collections
import random
import re

import pytest

from auric.llm import phrases
from tests.llm.cases import ROWS, documents


def brute(rows, top, least, within=50):
    f, n = collections.defaultdict(collections.Counter), collections.Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in (1, 2, 3):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = []
    for lang, count in f.items():
        cand = {p: a for p, a in count.items() if len(p) > 1 and a >= least}
        gone = {p[i:i + 2] for p, a in cand.items() if len(p) == 3 for i in (0, 1) if 100 * a >= within * count[p[i:i + 2]]}
        found = []
        for p, a in cand.items():
            if p not in gone:
                s, k = min((1_000_000 * a * a // (count[p[:k]] * count[p[k:]]), k) for k in range(1, len(p)))
                found.append((-s, -a, " ".join(p).encode(), count[p[:k]], count[p[k:]]))
        out += [(lang, r, p.decode(), -a, x, y, n[lang], -s) for r, (s, a, p, x, y) in enumerate(sorted(found)[:top], 1)]
    return sorted(out)


def rows_of(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


@pytest.mark.parametrize("top,widen,bits", [(15, (1, 3), 25), (40, (1,), 8), (5, (2, 4), 12), (2000, (4, 32), 25)])
def test_phrases_match_plain_python(spark, monkeypatch, top, widen, bits):
    monkeypatch.setattr(phrases, "WIDEN", widen)
    monkeypatch.setattr(phrases, "MAP_BITS", bits)
    monkeypatch.setattr(phrases, "BLOCK_WORDS", 37)
    rng = random.Random(top)
    words = [f"w{k}" for k in range(40)] + ["été", "中文", "Über", "a-b", "x" * 40]
    rows = []
    for k in range(300):
        lang = rng.choice(["en", "en", "de", None])
        text = " ".join(rng.choice(words[:9] if rng.random() < 0.6 else words) + rng.choice(["", "", "", "", ",", ".", "\t", "\n"]) for _ in range(rng.randrange(60)))
        rows.append((lang, text + rng.choice([" New York City", " once in a while; ", " new york", ""])))
    rows += [("en", "only ever together here")] * 120 + [("fr", "trop peu de mots")] * 9
    got = rows_of(phrases.mine(spark.createDataFrame(rows, "lang string, text string"), top=top))
    assert got == brute(rows, top, 10)
    assert any(x[0] == "und" for x in got) and not any(x[0] == "fr" for x in got)


def test_phrases_of_odd_rows(spark):
    want = brute([(lang, t) for _, t, lang in ROWS], 2000, 2)
    assert rows_of(phrases.mine(documents(spark), least=2)) == want and want
    assert phrases.mine(documents(spark).limit(0)).count() == 0
    assert phrases.mine(documents(spark).where("doc_id in (3, 4, 5)")).count() == 0


def test_scores_beyond_64_bits(spark):
    big = 3_000_000_000_000
    df = spark.createDataFrame([(big, big + 1, big + 2)], "a long, l long, r long")
    assert df.select(phrases.score(df.a, df.l, df.r).alias("s")).first().s == 1_000_000 * big * big // ((big + 1) * (big + 2))


def test_batches_are_bounded(spark):
    """The operator's tasks get small Arrow batches, as each of a batch's texts is in memory several times over."""
    names = {"spark.sql.execution.arrow.maxRecordsPerBatch": "10000", "spark.sql.execution.arrow.maxBytesPerBatch": "268435456"}
    before = {c: spark.conf.get(c) for c in names}
    try:
        for c, v in names.items():
            spark.conf.set(c, v)
        docs = spark.createDataFrame([("a b", "en")], "text string, lang string")
        phrases.mine(docs).collect()
        assert all(int(spark.conf.get(c)) < int(v) for c, v in names.items())
    finally:
        for c, v in before.items():
            spark.conf.set(c, v)
