"""Two-phase publish, run log, surrogate ids, bucketed upsert and the forward as-of match."""

import bisect
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from auric.operators import asof, ids
from auric.sources import store as S
from auric.sources import upsert as U
from auric.sources.runlog import RunLog, utc_label


def rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_publish_swaps_all_tables_at_once(spark, tmp_dir):
    st = S.TableStore(spark, tmp_dir)
    assert st.current() is None
    with pytest.raises(KeyError):
        st.read("a")
    d = st.draft("r1")
    d.add("a", spark.range(5))
    d.add("b", spark.range(0))
    assert st.current() is None  # written, not published
    first = st.publish(d, origem="x")
    assert first["numero"] == 1 and first["tabelas"]["b"]["linhas"] == 0 and first["origem"] == "x"
    d2 = st.draft("r2")
    d2.add("a", spark.range(7))
    assert st.read("a").count() == 5
    st.publish(d2)
    assert st.read("a").count() == 7 and [c["execucao_id"] for c in st.commits()] == ["r1", "r2"]
    assert st.read("a", first).count() == 5
    with pytest.raises(KeyError):
        st.read("b")


def test_publish_refuses_failed_checks_and_lost_races(spark, tmp_dir):
    st = S.TableStore(spark, tmp_dir)
    ok = st.draft("r1")
    ok.add("a", spark.range(3))
    ok.check("key", lambda d: S.duplicates(d.read("a"), "id"))
    late = st.draft("late")
    late.add("a", spark.range(9))
    st.publish(ok)
    with pytest.raises(S.PublishRefused, match="meanwhile"):
        st.publish(late)
    bad = st.draft("r2")
    bad.add("a", spark.range(3).unionByName(spark.range(1)))
    with pytest.raises(S.PublishRefused, match="key"):
        bad.check("key", lambda d: S.duplicates(d.read("a"), "id"))
    child = st.draft("r3")
    child.add("p", spark.range(3))
    child.add("c", spark.range(5))
    with pytest.raises(S.PublishRefused):
        child.check("ref", lambda d: S.orphans(d.read("c"), d.read("p"), "id"))
    assert st.read("a").count() == 3


def test_crash_between_steps_leaves_the_old_version(spark, tmp_dir):
    st = S.TableStore(spark, tmp_dir)
    d = st.draft("r1")
    d.add("a", spark.range(3))
    st.publish(d)
    lost = st.draft("r2")  # dies after writing
    lost.add("a", spark.range(4))
    assert st.read("a").count() == 3
    S.create_file(spark, f"{tmp_dir}/commits/000000002.json", b'{"numero": 2, "tabe')  # dies while it commits
    assert st.read("a").count() == 3 and st.current()["numero"] == 1
    again = st.draft("r2")
    again.add("a", spark.range(6))
    assert st.publish(again)["numero"] == 3 and st.read("a").count() == 6
    gone = st.expire(keep=1)
    assert lost.version in gone and d.version in gone and st.read("a").count() == 6


def test_run_log_counts_what_passes(spark, tmp_dir):
    log = RunLog(spark, tmp_dir)
    assert log.events().count() == 0 and log.runs().count() == 0
    run = log.open_run("r1")

    def work(lose):
        def go(s):
            src = s.counting(spark.range(100), lidos=F.lit(True), descartados=F.col("id") % 10 == 0).where("id % 10 <> 0")
            out = src.where("id <> 55") if lose else src
            out = s.counting(out, gravados=F.col("id") % 3 == 0, quarentena=F.col("id") % 3 == 1, superados=F.col("id") % 3 == 2)
            out.write.mode("overwrite").parquet(f"{tmp_dir}/out")
        return go

    log.run_stage(run, "silver", work(lose=True))
    bad = log.stages().first()
    assert bad.fecha is False and bad.lidos == 100 and bad.descartados == 10
    assert bad.gravados + bad.quarentena + bad.superados == 89
    log.run_stage(run, "silver", work(lose=False))
    good = log.stages().first()
    assert good.fecha is True and good.tentativa == 2 and good.status == "sucesso_com_ressalvas"
    with pytest.raises(ValueError):
        log.run_stage(run, "gold", lambda s: (_ for _ in ()).throw(ValueError("no gold")))
    log.skip_stage(run, "metadados", "service down")
    got = {(r.etapa, r.tentativa): (r.status, r.mensagem) for r in log.attempts().collect()}
    assert got[("gold", 1)] == ("falha", "no gold") and got[("metadados", 1)] == ("ignorada", "service down")
    assert log.close_run(run) == "falha"
    log.run_stage(run, "gold", lambda s: None)
    assert log.close_run(run) == "sucesso_com_ressalvas"
    other = log.open_run("  ")
    assert len(other) == 36 and log.close_run(other) == "falha"  # a run without stages did nothing
    with pytest.raises(KeyError):
        log.close_run("unknown")


def test_interrupted_stage_counts_as_failed(spark, tmp_dir):
    log = RunLog(spark, tmp_dir)
    run = log.open_run("r")
    log._append(run, "iniciada", "silver")
    assert log.stages().first().status == "em_andamento" and log.close_run(run) == "falha"


def test_utc_label():
    assert utc_label(dt.datetime(2024, 1, 31, 22, 30, tzinfo=dt.timezone(dt.timedelta(hours=-3)))) == "2024-02-01T01:30:00Z"
    with pytest.raises(ValueError):
        utc_label(dt.datetime(2024, 1, 1))


def test_rows_are_numbered_without_gaps(spark):
    rng = random.Random(1)
    vals = [rng.randrange(50) for _ in range(500)] + [7] * 400
    df = spark.createDataFrame([(v,) for v in vals], "v int").repartition(8)
    got = ids.number_rows(df, ["v"], "n", 10).collect()
    assert sorted(r.n for r in got) == list(range(10, 910))
    assert [r.v for r in sorted(got, key=lambda r: r.n)] == sorted(vals)
    assert ids.number_rows(df.limit(0), ["v"], "n").count() == 0


def test_second_load_keeps_ids_and_touches_few_buckets(spark, tmp_dir):
    path = f"{tmp_dir}/t"
    load = lambda keys, city: spark.createDataFrame([(k, city) for k in keys], "k long, cidade string")
    assert U.upsert_buckets(spark, path, load([], "x"), ["k"], "id", "l0") == []
    U.upsert_buckets(spark, path, load(range(0, 60, 2), "A"), ["k"], "id", "l1", buckets=8)
    first = {r.k: r.id for r in spark.read.parquet(path).collect()}
    assert sorted(first.values()) == list(range(1, 31))
    files = {b: sorted(os.listdir(f"{path}/{b}")) for b in os.listdir(path) if b.startswith("bucket=")}
    touched = U.upsert_buckets(spark, path, load([4, 4, 5], "B").unionByName(spark.createDataFrame([(None, "C")], "k long, cidade string")), ["k"], "id", "l2", buckets=8)
    assert 1 <= len(touched) <= 2
    now = {r.k: r for r in spark.read.parquet(path).collect()}
    assert {k: now[k].id for k in first} == first and now[5].id == 31 and now[4].cidade == "B" and now[4]._carga == "l2" and len(now) == 31
    for b, names in files.items():
        if int(b.split("=")[1]) not in touched:
            assert sorted(os.listdir(f"{path}/{b}")) == names
    assert U.delete_stale(spark, path, "l2") == 29 and rows(spark.read.parquet(path).select("k")) == [(4,), (5,)]
    U.upsert_buckets(spark, path, load([100], "D"), ["k"], "id", "l3", buckets=8)
    assert {r.k: r.id for r in spark.read.parquet(path).collect()}[100] == 32


@pytest.mark.parametrize("seed", [1, 2])
def test_next_event_matches_a_search(spark, seed):
    rng = random.Random(seed)
    key = lambda: (1, 1) if rng.random() < 0.5 else (rng.randrange(20), rng.randrange(3))  # noqa: E731  one key has half of all
    events = [(*key(), rng.randrange(400)) for _ in range(3000)] + [(None, 1, 5), (3, 1, None)]
    asks = [(*key(), rng.randrange(420), k) for k in range(2000)] + [(None, 1, 3, -1), (3, 1, None, -2), (1, 1, 5, -3), (1, 1, 5, -3)]
    by = {}
    for u, c, t in events:
        if None not in (u, c, t):
            by.setdefault((u, c), []).append(t)
    for v in by.values():
        v.sort()

    def want(u, c, t):
        ts = by.get((u, c), []) if None not in (u, c, t) else []
        at = bisect.bisect_right(ts, t) if ts else 0
        return ts[at] if at < len(ts) else None

    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # many ranges
    try:
        m = spark.createDataFrame(asks, "u int, c int, t int, tag int")
        e = spark.createDataFrame(events, "u int, c int, at int")
        got = asof.next_event(m, e, ["u", "c"], "t", "at", "nxt").collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    key_of = lambda r: tuple(str(x) for x in r)
    assert sorted(map(key_of, got)) == sorted(key_of((u, c, t, tag, want(u, c, t))) for u, c, t, tag in asks)
    assert asof.next_event(m.limit(0), e, ["u", "c"], "t", "at", "nxt").count() == 0
    assert asof.next_event(m, e.limit(0), ["u", "c"], "t", "at", "nxt").where("nxt is not null").count() == 0


def test_duplicates_move_keys_only_where_a_hash_stands_twice(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1), (None, 1), (None, 1), ("b", 1), ("b", 1)], "k string, n long")
    assert sorted((r.k or "", r.n, r["count"]) for r in S.duplicates(rows, "k", "n").collect()) == [("", 1, 2), ("b", 1, 3)]
    none = S.duplicates(rows.dropDuplicates(), "k", "n")
    assert none.dtypes == [("k", "string"), ("n", "bigint"), ("count", "bigint")] and none.count() == 0
    assert "Exchange" not in none._jdf.queryExecution().executedPlan().toString()
