"""Connected components against a brute-force BFS, including a long chain
(needs pointer jumping) and a hot key shared by a third of the rows (star
edges, never all pairs)."""

from pyspark.sql import functions as F

from auric.operators import identity


def brute(edges, nodes):
    adj = {n: set() for n in nodes}
    for a, b in edges:
        adj[a].add(b)
        adj[b].add(a)
    comp = {}
    for n in nodes:
        if n in comp:
            continue
        stack, seen = [n], {n}
        while stack:
            x = stack.pop()
            for y in adj[x]:
                if y not in seen:
                    seen.add(y)
                    stack.append(y)
        m = min(seen)
        for x in seen:
            comp[x] = m
    return comp


def test_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(100, 160)]
    star = [(200 + i, 200) for i in range(1, 30)]
    pairs = [(7, 3), (3, 9)]
    edges = chain + star + pairs
    df = spark.createDataFrame(edges, "src long, dst long")
    got = {r["node"]: r["component"] for r in identity.connected_components(spark, df).collect()}
    nodes = {x for e in edges for x in e}
    assert got == brute(edges, nodes)


def test_resolve_hot_key(spark):
    rows = [(i, "HOT" if i % 3 == 0 else f"k{i // 2}", f"e{i % 5}" if i > 80 else None) for i in range(1, 121)]
    df = spark.createDataFrame(rows, "id long, a string, b string")
    edges = identity.star_edges(df, "id", "a", "a")
    # one edge per member of a group, never all pairs
    assert edges.count() <= len(rows)
    got = {r["id"]: r["component"] for r in identity.resolve(spark, df, "id", {"a": "a", "b": "b"}).collect()}
    e = []
    for col in (1, 2):
        groups = {}
        for r in rows:
            if r[col] is not None:
                groups.setdefault(r[col], []).append(r[0])
        for members in groups.values():
            e += [(members[0], m) for m in members[1:]]
    assert got == brute(e, [r[0] for r in rows])


def test_blank_keys_do_not_link(spark):
    df = spark.createDataFrame([(1, ""), (2, ""), (3, None)], "id long, k string")
    got = {r["id"]: r["component"] for r in
           identity.resolve(spark, df, "id", {"k": "k"}).select("id", F.col("component")).collect()}
    assert got == {1: 1, 2: 2, 3: 3}
