import random

import pytest

from auric.llm import near_dup
from tests.llm.cases import documents


def shingle_set(text, n=4):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        low = low.replace(c, " ")
    w = [x for x in low.split(" ") if x]
    return frozenset(tuple(w[k: k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def brute_force(rows, n=4):
    sets = [(d, shingle_set(t, n)) for d, t in rows]
    comp = {d: d for d, _ in sets}

    def root(x):
        while comp[x] != x:
            x = comp[x]
        return x

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if x and y and 100 * len(x & y) >= 80 * len(x | y):
                lo, hi = sorted((root(a), root(b)))
                comp[hi] = lo
    return {d: (len(s), root(d)) for d, s in sets}


def edited(words, rng, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"w{rng.randrange(10**6)}"
    return out


@pytest.mark.parametrize("seed,words", [(1, 4), (2, 4), (3, near_dup.WORDS)])
def test_components_match_brute_force(spark, seed, words):
    rng = random.Random(seed)
    rows = []
    for g in range(30):
        base = [f"g{g}t{rng.randrange(10**6)}" for _ in range(rng.choice([3, 30, 120]))]
        for _ in range(rng.choice([1, 2, 3, 25, 60])):
            base = edited(base, rng, rng.randrange(3)) if rng.random() < 0.4 else base
            rows.append(" ".join(edited(base, rng, rng.randrange(4))))
    rng.shuffle(rows)
    rows = list(enumerate(rows))
    want = brute_force(rows, words)
    got = near_dup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), words=words).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_odd_rows(spark):
    got = near_dup.near_duplicates(documents(spark)).collect()
    assert len(got) == 14
    by = {}
    for r in got:
        by.setdefault(r.doc_id, []).append(r)
    assert [r.component_id for r in by[2]] == [1, 1] and not any(r.kept for r in by[2])
    assert all(r.n_shingles == 0 and r.kept for d in (3, 4, 5) for r in by[d])
    assert all(r.component_id is None and r.kept for r in by[None])
    assert sorted(r.component_id for r in by[8]) == [8, 8]


def test_empty_table(spark):
    assert near_dup.near_duplicates(documents(spark).limit(0)).count() == 0


def test_tables_share_values():
    import numpy as np

    least = np.arange(near_dup.VALUES * 2, dtype=np.uint32).reshape(2, -1)
    least[1, :2], least[1, -2:] = least[0, :2], least[0, -2:]
    keys = near_dup.table_keys(least)
    assert keys.shape == (2, near_dup.HALVES ** 2) and (keys[0] == keys[1]).sum() == 1


def test_stages_take_five_words():
    assert near_dup.WORDS == 5 and near_dup.PERCENT == 80


def test_large_group_gives_few_pairs(spark):
    """A group of n components that share a shingle is joined by fewer than two pairs a row, not by all pairs."""
    n = 60
    rows = [(x, s, 10, 1) for x in range(n) for s in (7, 8)]
    prefix = spark.createDataFrame(rows, "node long, shingle long, size long, k long").selectExpr("*", "node as comp")
    assert near_dup.prefix_pairs(prefix, 80).count() == n * (n - 1) // 2
    for turn in range(near_dup.TURNS):
        found = near_dup.drawn_pairs(prefix, 80, turn).collect()
        assert len(found) < 2 * len(rows) and all(r["a"] < r["b"] and r["ca"] != r["cb"] for r in found)
        reached = {0}
        while more := {x for r in found for x in (r["a"], r["b"]) if {r["a"], r["b"]} & reached} - reached:
            reached |= more
        assert len(reached) == n
