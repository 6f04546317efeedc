"""JSON arrays and CSV files in many small blocks against the plain readers of Python."""

import csv
import json
import random

import pytest

from auric.sources import positions as P


@pytest.fixture()
def blocks(spark):
    """Files are cut into blocks of a few bytes."""
    spark.conf.set("spark.sql.files.maxPartitionBytes", "307")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    spark.conf.unset("spark.sql.files.openCostInBytes")


def texts(rng):
    alphabet = ['a', 'é', '"', "\\", "{", "}", "[", "]", ",", "\n", " ", "中", ":"]
    return "".join(rng.choice(alphabet) for _ in range(rng.randrange(14)))


@pytest.mark.parametrize("indent,lead", [(None, ""), (1, "﻿ \n")])
def test_json_array_in_many_blocks(spark, tmp_dir, blocks, indent, lead):
    rng = random.Random(indent)
    for f in range(2):
        rows = [{"id": k, "t": texts(rng), "n": {"x": [texts(rng), {"y": 1}]}} if k % 7 else {"id": None} for k in range(60)]
        rows[5] = {"id": 5, "t": "long " * 100, "n": {}}
        rows[6] = {}
        with open(f"{tmp_dir}/f{f}.json", "w", encoding="utf-8") as out:
            out.write(lead + json.dumps(rows, indent=indent, ensure_ascii=f == 0) + ("\n" if f else ""))
    with open(f"{tmp_dir}/empty.json", "w") as out:
        out.write(" [ ] ")
    assert P.text_pieces(spark, tmp_dir, "}").rdd.getNumPartitions() > 10
    got = {(r._arquivo.split("/")[-1], r._linha): r for r in P.read_json_array(spark, tmp_dir, ["id", "t", "n", "missing"]).collect()}
    assert len(got) == 120
    for f in range(2):
        for n, row in enumerate(json.load(open(f"{tmp_dir}/f{f}.json", encoding="utf-8-sig")), 1):
            r = got[f"f{f}.json", n]
            assert (r.id, r.t, r.missing) == (None if row.get("id") is None else str(row["id"]), row.get("t"), None)
            assert (json.loads(r.n) if r.n is not None else None) == row.get("n")


@pytest.mark.parametrize("text,error", [('{"id": 1}', "not an array"), ('[{"id": 1}, {"id": 2', "truncated"), ('[{"id": 1}', "truncated"), ('[{"a": "x}', "truncated"),
                                        ('[[{"id": 1}]', "truncated")])
def test_json_files_that_are_no_arrays(spark, tmp_dir, blocks, text, error):
    with open(f"{tmp_dir}/f.json", "w") as out:
        out.write(text)
    with pytest.raises(ValueError, match=error):
        P.read_json_array(spark, tmp_dir, ["id"])


def test_json_elements_must_be_objects(spark, tmp_dir, blocks):
    with open(f"{tmp_dir}/f.json", "w") as out:
        out.write('[{"id": 1}, 7, {"id": 2}]')
    with pytest.raises(Exception, match="not an object"):
        P.read_json_array(spark, tmp_dir, ["id"]).collect()


def test_csv_positions_in_many_blocks(spark, tmp_dir, blocks):
    rng = random.Random(3)
    alphabet = ["a", "é", '"', ",", "\n", " ", "中"]
    columns = ["id", "t", "u"]
    for f, order in enumerate((columns, ["u", "extra", "id", "t"])):
        with open(f"{tmp_dir}/f{f}.csv", "w", encoding="utf-8", newline="") as out:
            w = csv.writer(out, lineterminator="\n")
            w.writerow(order)
            for k in range(150):
                row = {"id": str(k), "t": "x" + "".join(rng.choice(alphabet) for _ in range(rng.randrange(12))) + "x", "u": "v" if k % 3 else "long " * 60, "extra": "e"}
                w.writerow([row[c] for c in order])
                if k % 11 == 0:
                    out.write("\n")
    got = {(r._arquivo.split("/")[-1], r._linha): r for r in P.read_csv_positions(spark, tmp_dir, columns).collect()}
    assert len(got) == 300
    for f in range(2):
        rows = [r for r in csv.DictReader(open(f"{tmp_dir}/f{f}.csv", encoding="utf-8", newline=""))]
        for n, row in enumerate(rows, 1):
            r = got[f"f{f}.csv", n]
            assert (r.id, r.t, r.u) == (row["id"], row["t"], row["u"])
    report = {r._arquivo.split("/")[-1]: (r.ausentes, r.a_mais, r.ordem) for r in P.header_report(spark, tmp_dir, ["id", "t", "u", "w"]).collect()}
    assert report == {"f0.csv": (["w"], [], True), "f1.csv": (["w"], ["extra"], False)}
    with pytest.raises(ValueError, match="lacks"):
        P.read_csv_positions(spark, tmp_dir, [*columns, "w"])
    by_place = P.read_csv_positions(spark, f"{tmp_dir}/f1.csv", columns, positional=True)
    assert by_place.where("_linha = 2").first().t == "e"


def test_csv_with_an_open_quote(spark, tmp_dir, blocks):
    with open(f"{tmp_dir}/f.csv", "w") as out:
        out.write('a,b\n1,"x\n2,y\n')
    with pytest.raises(ValueError, match="not closed"):
        P.csv_records(spark, tmp_dir)
