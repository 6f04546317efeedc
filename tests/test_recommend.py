"""Score and class formulas (boundaries from the reference's tests)."""

from pyspark.sql import functions as F

from auric.operators import recommend as RC


def test_score(spark):
    rows = [(1.0, 1.0, 1), (0.5, 0.3, 1), (1.0, 1.0, 0), (0.0, 0.0, 1)]
    df = spark.createDataFrame(rows, "ivis double, icur double, iconc int")
    out = [r["s"] for r in df.select(RC.score(F.col("ivis"), F.col("icur"), F.col("iconc")).alias("s")).collect()]
    assert out == [100.0, 40.0, 0.0, 0.0]


def test_class_boundaries(spark):
    rows = [(70.0, 1), (69.9, 1), (40.1, 1), (40.0, 1), (100.0, 0)]
    df = spark.createDataFrame(rows, "s double, c int")
    out = [r["k"] for r in df.select(RC.classify(F.col("s"), F.col("c")).alias("k")).collect()]
    assert out == ["positivo", "estavel", "estavel", "negativo", "negativo"]


def brute_top(indices, contents, done, vectors, profiles, k):
    import math

    def cosine(a, b):
        na, nb = (math.sqrt(sum(x * x for x in v)) if v else 0 for v in (a, b))
        return sum(x * y for x, y in zip(a, b)) / (na * nb) if na and nb else 0.0

    per = {}
    for u, cat, ivis, icur in indices:
        s = round((ivis + icur) / 2 * 100, 2)
        if s > 40:
            per.setdefault(u, []).extend((-s, -round(cosine(vectors.get(c), profiles.get(u)), 4), c) for c, kind in contents if kind == cat and (u, c) not in done)
    return sorted((u, n, c, -s) for u, rows in per.items() for n, (s, _, c) in enumerate(sorted(rows)[:k], 1))


def test_top_contents_without_pairs(spark, monkeypatch):
    import random

    rng = random.Random(1)
    monkeypatch.setattr(RC, "USER_BLOCK", 7)
    monkeypatch.setattr(RC, "CONTENT_BLOCK", 5)
    monkeypatch.setattr(RC, "SLICE", 3)
    contents = [(c, "a" if c < 40 else rng.choice("bcd")) for c in range(60)]
    indices = []
    for u in range(50):
        x, y = rng.choice([(0.9, 0.1), (0.5, 0.5), (0.6, 0.41), (0.45, 0.45), (0.1, 0.2)])
        one, two = rng.sample("abcd", 2)
        indices += [(u, one, x, x), (u, two, y, y)]
    done = {(u, c) for u in range(50) for c, kind in contents if rng.random() < (0.95 if u % 4 == 0 else 0.2)}
    vectors = {c: [rng.choice([-1.0, 0.0, 0.5, 1.0]) for _ in range(3)] for c in range(55)}
    profiles = {u: [rng.choice([-1.0, 0.5, 1.0]) for _ in range(3)] for u in range(45)}
    got = RC.recommend_top(
        spark.createDataFrame(indices, "usuario_id long, categoria string, ivis double, icur double"), spark.createDataFrame(contents, "conteudo_id long, categoria string"),
        spark.createDataFrame(list(done), "usuario_id long, conteudo_id long"), spark.createDataFrame(list(vectors.items()), "conteudo_id long, embedding array<float>"),
        spark.createDataFrame(list(profiles.items()), "usuario_id long, perfil array<double>"), 4)
    rows = sorted((r.usuario_id, r.posicao, r.conteudo_id, r.pontuacao) for r in got.collect())
    assert rows == brute_top(indices, contents, done, vectors, profiles, 4)
