"""Readers and sinks, including the reference's failure drills: truncated
JSON, a JSON object where a list is expected, a CSV missing a column."""

import json
import os

import pytest

from auric.sources import export, files

COLS = ["usuario_id", "conteudo_id", "tags"]


def write(path, text, bom=False):
    with open(path, "w", encoding="utf-8-sig" if bom else "utf-8") as f:
        f.write(text)
    return path


def test_json_array_positions(spark, tmp_dir):
    recs = [{"usuario_id": "1", "conteudo_id": 7, "tags": ["a", "b"]}, {"usuario_id": "2"}]
    p = write(os.path.join(tmp_dir, "a.json"), json.dumps(recs))
    rows = files.read_json_array(spark, p, COLS).orderBy("_linha").collect()
    assert [r["_linha"] for r in rows] == [1, 2]
    assert rows[0]["conteudo_id"] == "7"            # numbers arrive as text
    assert json.loads(rows[0]["tags"]) == ["a", "b"]  # nested list kept as JSON text
    assert rows[1]["conteudo_id"] is None             # missing leaf → NULL


def test_json_truncated_fails(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "t.json"), '[{"usuario_id": "1"}, {"usuario_id": ')
    with pytest.raises(Exception):
        files.read_json_array(spark, p, COLS).collect()


def test_json_object_top_level_fails(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "o.json"), '{"usuario_id": "1"}')
    with pytest.raises(Exception):
        files.read_json_array(spark, p, COLS).collect()


def test_csv_by_header_with_bom(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "c.csv"), "conteudo_id,titulo\n1,Curso A\n", bom=True)
    rows = files.read_csv_by_header(spark, p, ["conteudo_id", "titulo"]).collect()
    assert rows[0]["conteudo_id"] == "1" and rows[0]["titulo"] == "Curso A"


def test_csv_missing_column_fails_by_header(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "m.csv"), "conteudo_id,categoria\n1,X\n")
    with pytest.raises(Exception):
        files.read_csv_by_header(spark, p, ["conteudo_id", "titulo"]).collect()


def test_csv_positional_shifts(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "s.csv"), "conteudo_id,nivel\n1,Basico\n")
    r = files.read_csv_positional(spark, p, ["conteudo_id", "titulo", "nivel"]).first()
    assert r["titulo"] == "Basico" and r["nivel"] is None


def test_audit_and_append(spark, tmp_dir):
    p = write(os.path.join(tmp_dir, "a.json"), json.dumps([{"usuario_id": "1"}]))
    df = files.with_audit(files.read_json_array(spark, p, COLS), "run-1", tmp_dir)
    assert df.first()["_origem"] == "a.json"
    out = os.path.join(tmp_dir, "bronze")
    files.append_bronze(df, out)
    files.append_bronze(df.withColumn("_execucao_id", df["_execucao_id"].substr(1, 3)), out)
    assert spark.read.parquet(out).count() == 2


def test_presence_check(spark, tmp_dir):
    from auric.sources.tables import require_sources

    require_sources(spark, [tmp_dir])
    with pytest.raises(FileNotFoundError):
        require_sources(spark, [os.path.join(tmp_dir, "nao-existe.csv")])


def test_publish_pointer(spark, tmp_dir):
    t1 = spark.range(3).withColumnRenamed("id", "x")
    export.publish(spark, tmp_dir, "r1", {"t": t1})
    assert export.read_current(spark, tmp_dir, "t").count() == 3
    bad = spark.range(2).withColumnRenamed("id", "x")
    with pytest.raises(RuntimeError):
        export.publish(spark, tmp_dir, "r2", {"t": bad}, checks={"nao_vazio": bad.where("x >= 0")})
    assert export.read_current(spark, tmp_dir, "t").count() == 3  # pointer unchanged
    export.publish(spark, tmp_dir, "r3", {"t": bad})
    assert export.read_current(spark, tmp_dir, "t").count() == 2


def test_upsert_and_counts(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k int, v string")
    new = spark.createDataFrame([(2, "B"), (3, "c"), (4, "d")], "k int, v string")
    assert sorted(tuple(r) for r in export.upsert(old, new, ["k"]).collect()) == [(1, "a"), (2, "B"), (3, "c"), (4, "d")]
    c = export.upsert_counts(old, new, ["k"], ["v"]).first()
    assert (c["inseridos"], c["atualizados"], c["removidos"], c["inalterados"]) == (1, 1, 1, 1)
    assert [r["k"] for r in export.removed_keys(old, new, ["k"]).collect()] == [1]
