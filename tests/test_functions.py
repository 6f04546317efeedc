"""Scalar functions: the reference's unit cases (converters, key, masks,
pseudonyms) on inline rows."""

import datetime as dt
import hashlib
import hmac

from pyspark.sql import functions as F

from auric.functions import domain, parse, privacy, text


def one(spark, expr, value, typ="string"):
    return spark.createDataFrame([(value,)], f"v {typ}").select(expr(F.col("v")).alias("r")).first()["r"]


def test_strict_int(spark):
    for raw, want in [("7", 7), (" 7 ", 7), ("7.0", 7), ("-45", -45), ("7.9", None), ("abc", None),
                      ("1e3", None), ("", None), (None, None), ("1234567890", None)]:
        assert one(spark, parse.strict_int, raw) == want, raw


def test_number(spark):
    assert one(spark, parse.number_double, " 12.5 ") == 12.5
    assert one(spark, parse.number_double, "nan") is None
    assert one(spark, parse.number_double, "1e3") is None


def test_parse_date(spark):
    assert one(spark, parse.parse_date, "01/02/2025") == dt.date(2025, 2, 1)
    assert one(spark, parse.parse_date, " 2025-02-01 ") == dt.date(2025, 2, 1)
    assert one(spark, parse.parse_date, "2026/08/02") == dt.date(2026, 8, 2)
    for bad in ["2025-13-01", "31/09/2024", "31/02/2026", "ontem", None]:
        assert one(spark, parse.parse_date, bad) is None, bad


def test_parse_ts(spark):
    assert one(spark, parse.parse_ts, "2024-01-02T03:04:05") == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, parse.parse_ts, "2024-01-02 03:04:05") == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert one(spark, parse.parse_ts, "2024-01-02") is None


def test_key_and_clean(spark):
    assert one(spark, text.comparison_key, "  Vídeo ") == "video"
    assert one(spark, text.comparison_key, "BANCO   de Dados") == "banco de dados"
    assert one(spark, text.clean_text, "\t a  b \n") == "a b"
    assert one(spark, text.clean_text, "   ") is None


def test_domain_maps(spark):
    assert one(spark, domain.content_type, "  video ") == "Vídeo"
    assert one(spark, domain.level, "AVANCADO") == "Avançado"
    assert one(spark, domain.level, "expert") is None
    assert one(spark, domain.interaction_type, "VISUALIZACAO") == "visualização"
    assert one(spark, domain.state_code, " sp ") == "SP"
    assert one(spark, domain.state_code, "XX") is None


def test_json_list_and_tags(spark):
    df = spark.createDataFrame([('["Python"," lgpd ", ""]',), ("python",), ('{"a": 1}',)], "v string")
    out = [r["t"] for r in df.select(text.normalize_tags(parse.json_list(F.col("v"))).alias("t")).collect()]
    assert out == [["python", "lgpd"], None, None]


def test_missing_fields(spark):
    df = spark.createDataFrame([("1", " ", None), ("1", "x", "y")], "a string, b string, c string")
    out = [r["m"] for r in df.select(text.missing_fields(["a", "b", "c"]).alias("m")).collect()]
    assert out == ["b, c", None]


def test_pseudonym_equals_python_hmac(spark):
    key = "chave-de-teste-pseudonimo-0001"
    want = hmac.new(key.encode(), b"42", hashlib.sha256).hexdigest()
    assert one(spark, lambda c: privacy.pseudonym(c, key), "42") == want
    assert one(spark, lambda c: privacy.pseudonym(c, key), None) is None


def test_salted_hash(spark):
    want = hashlib.sha256(b"salt" + b"abc").hexdigest()
    assert one(spark, lambda c: privacy.salted_hash(c, "salt"), "abc") == want


def test_masks(spark):
    assert one(spark, privacy.mask_email, "ana.souza@plataforma.example") == "a***@plataforma.example"
    assert one(spark, privacy.mask_email, "sem-arroba") is None
    assert one(spark, privacy.mask_name, "Ana Paula Souza") == "Ana S***"
    assert one(spark, privacy.mask_name, "Ana") == "A***"


def test_anonymize_text(spark):
    s = "fale com ana@x.example ou (11) 98765-4321 hoje"
    assert one(spark, privacy.anonymize_text, s) == "fale com [email] ou [telefone] hoje"


def test_age_band(spark):
    df = spark.createDataFrame([(dt.date(2010, 1, 1),), (dt.date(2000, 2, 2),), (dt.date(1950, 1, 1),)], "b date")
    out = [r["f"] for r in df.select(domain.age_band(F.col("b"), F.lit(dt.date(2024, 2, 1))).alias("f")).collect()]
    assert out == ["0-17", "18-24", "60+"]


def test_secret_guard():
    import pytest

    with pytest.raises(ValueError):
        domain.check_secret("curta", "x")
    with pytest.raises(ValueError):
        domain.check_secret("troque-por-um-valor-aleatorio", "x")
    assert domain.check_secret("a" * 16, "x") == "a" * 16


def test_leak_scan_patterns(spark):
    from auric.functions.privacy import has_pii
    from pyspark.sql import functions as F

    rows = [("a1234567890b", False), ("3f71234567890ab", False), ("123.456.789-09", True), ("tel (11) 98765-4321.", True),
            ("x@y.example", True), ("2024-01-15 10:00:00", False), ("12345678901", False)]
    df = spark.createDataFrame(rows, "t string, want boolean")
    assert df.where(has_pii(F.col("t")) != F.col("want")).count() == 0


def test_policy_denies_unknown_columns():
    from auric.operators.policy import allowed

    assert not allowed("usuario_mestre_id", "gold") and not allowed("new_column", "gold") and allowed("uf", "gold")


def test_values_that_take_the_short_way(spark):
    from auric.functions.parse import parse_ts, strict_int
    from auric.functions.text import clean_text, missing_fields

    texts = [None, "", " ", "\t", "a", " a ", "a b", "a  b", "a\tb", "\x0b\ra\n", "\u00a0", "a \f"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    want = F.nullif(F.trim(F.regexp_replace("t", r"\s+", " ")), F.lit(""))
    assert df.where(~clean_text("t").eqNullSafe(want)).count() == 0
    got = [r[0] for r in df.select(missing_fields(["t"])).collect()]
    assert got == ["t" if v is None else None for v in (r[0] for r in df.select(want).collect())]
    plan = df.select(clean_text("t"))._jdf.queryExecution().optimizedPlan().toString()
    assert "CASE WHEN" in plan  # nothing is replaced in a text that is clean
    ints = spark.createDataFrame([(v,) for v in ("7", " 7 ", "7.0", "-45", "7.9", "007", "1234567890", "1e3", None)], "v string")
    assert [r[0] for r in ints.select(strict_int("v")).collect()] == [7, 7, 7, -45, None, 7, None, None, None]
    times = spark.createDataFrame([(v,) for v in ("2024-02-29T10:00:59", "2024-02-29 10:00:59", "2023-02-29 10:00:00", "2024-01-01 24:00:00", "0000-01-01 00:00:00", "ontem", None)], "v string")
    assert [str(r[0]) for r in times.select(parse_ts(F.col("v"))).collect()] == ["2024-02-29 10:00:59"] * 2 + ["None"] * 5
