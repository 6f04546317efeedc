"""Components kept delivery by delivery, against a search over all links delivered so far."""

import random

import pytest

from auric.operators import identity, identity_state
from auric.operators.identity_state import IdentityState
from auric.sources.store import PublishRefused
from tests.test_identity import brute

SCHEMA = "id long, cpf string, email string, node string, component long"
KEYS = {"cpf": "cpf", "email": "email"}


def delivered(spark, rows):
    """Rows of (id, cpf, email), beside columns named as the operator names its own."""
    return spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)


def wanted(rows):
    edges, groups = [], {}
    for i, *keys in rows:
        for via, key in enumerate(keys):
            if i is not None and key is not None and key.strip():
                groups.setdefault((via, key), []).append(i)
    for members in groups.values():
        edges += [(members[0], x) for x in members[1:]]
    return brute(edges, {r[0] for r in rows if r[0] is not None})


def found(state):
    rows = state.labels().collect()
    assert len(rows) == len({r["node"] for r in rows})
    return {r["node"]: r["component"] for r in rows}


def test_three_deliveries_equal_a_full_run(spark, tmp_dir):
    rnd = random.Random(5)
    state, seen = IdentityState(spark, tmp_dir), []
    for n in range(3):
        rows = [(rnd.randrange(1, 150), f"c{rnd.randrange(90)}", rnd.choice([None, "", " ", f"e{rnd.randrange(80)}"])) for _ in range(45)]
        rows += [(1000 * (3 - n) + i, "hot", None) for i in range(25)]  # a key with a third of the rows; ids fall
        rows += [rows[0], (None, "c1", "e1")]
        state.deliver(f"r{n}", delivered(spark, rows), "id", KEYS)
        seen += rows
        assert found(state) == wanted(seen), n
    full = identity.resolve(spark, delivered(spark, [r for r in seen if r[0] is not None]), "id", KEYS)
    assert found(state) == {r["id"]: r["component"] for r in full.collect()}


def test_only_edges_of_the_delivery_are_walked(spark, tmp_dir, monkeypatch):
    walked = []
    real = identity.connected_components
    monkeypatch.setattr(identity_state.identity, "connected_components", lambda s, e: walked.append(e.count()) or real(s, e))
    state = IdentityState(spark, tmp_dir)
    state.deliver("a", delivered(spark, [(i, f"c{i // 2}", None) for i in range(10, 50)]), "id", KEYS)
    state.deliver("b", delivered(spark, [(100 + i, None, f"e{i}") for i in range(20)]), "id", KEYS)
    done = state.deliver("c", delivered(spark, [(10, None, "e3"), (48, "c7", None)]), "id", KEYS)
    assert walked == [20, 0, 2]
    assert (done["novos"], done["fundidas"]) == (0, 2)
    got = found(state)
    assert got[103] == got[10] == got[11] == 10 and got[48] == got[49] == got[14] == 14 and got[104] == 104


def test_empty_delivery_and_one_that_dies(spark, tmp_dir, monkeypatch):
    state = IdentityState(spark, tmp_dir)
    state.deliver("a", delivered(spark, []), "id", KEYS)
    assert found(state) == {}
    rows = [(7, "c", None), (3, None, "e"), (9, "c", "e")]
    state.deliver("b", delivered(spark, rows), "id", KEYS)
    state.deliver("c", delivered(spark, []), "id", KEYS)
    assert found(state) == {7: 3, 3: 3, 9: 3}
    with monkeypatch.context() as broken:
        broken.setattr(state.store, "publish", lambda draft, **facts: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            state.deliver("d", delivered(spark, [(1, "c", None)]), "id", KEYS)
    assert found(state) == {7: 3, 3: 3, 9: 3}
    state.deliver("d", delivered(spark, [(1, "c", None)]), "id", KEYS)
    assert found(state) == {1: 1, 7: 1, 3: 1, 9: 1}


def test_a_delivery_beside_another_is_refused(spark, tmp_dir, monkeypatch):
    state, other = IdentityState(spark, tmp_dir), IdentityState(spark, tmp_dir)
    state.deliver("a", delivered(spark, [(1, "c", None)]), "id", KEYS)
    real = identity.connected_components

    def meanwhile(s, e):
        monkeypatch.setattr(identity_state.identity, "connected_components", real)
        other.deliver("b", delivered(spark, [(2, "c", None)]), "id", KEYS)
        return real(s, e)

    monkeypatch.setattr(identity_state.identity, "connected_components", meanwhile)
    with pytest.raises(PublishRefused):
        state.deliver("c", delivered(spark, [(5, "c", None)]), "id", KEYS)
    assert found(state) == {1: 1, 2: 1}
