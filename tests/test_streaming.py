"""Bronze file pickup: every file exactly once across scheduled runs."""

import json
import os

from auric.streaming.bronze_stream import ingest_available

COLS = ["usuario_id", "conteudo_id"]


def drop(dirpath, name, recs):
    with open(os.path.join(dirpath, name), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs))


def test_available_now_pickup(spark, tmp_dir):
    landing, bronze, ckpt = (os.path.join(tmp_dir, d) for d in ("landing", "bronze", "ckpt"))
    os.makedirs(landing)
    drop(landing, "a.json", [{"usuario_id": "1", "conteudo_id": "2"}, {"usuario_id": "3"}])
    assert ingest_available(spark, landing, COLS, bronze, "r1", ckpt) == 2
    assert ingest_available(spark, landing, COLS, bronze, "r2", ckpt) == 0   # nothing new
    drop(landing, "b.json", [{"usuario_id": "5", "conteudo_id": "6"}])
    assert ingest_available(spark, landing, COLS, bronze, "r3", ckpt) == 1
    df = spark.read.parquet(bronze)
    assert df.count() == 3
    assert sorted(r["_origem"] for r in df.select("_origem").distinct().collect()) == ["a.json", "b.json"]
