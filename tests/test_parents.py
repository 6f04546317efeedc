"""Accepted keys of the logged runs and the sizes that decisions are made by."""

from pyspark.sql import functions as F

from auric.operators import classify, dedupe
from auric.plans import chain, raw
from auric.plans.model import Model

SF = "/root/testdata/sf0.001"


def test_partitions_do_not_follow_what_is_joined_to_the_rows(spark):
    rows, other = spark.range(1000), spark.range(10_000_000).withColumn("v", F.lit(1))
    assert dedupe.partitions_for(rows) == 0
    assert dedupe.partitions_for(rows.join(other, "id", "left")) == 0


def test_accepted_keys_are_judged_by_files_of_keys_alone(spark, monkeypatch):
    seen = {}

    def recommendations(df, users_ok, contents_ok, real=classify.recommendations):
        seen.update(users=users_ok, contents=contents_ok)
        return real(df, users_ok, contents_ok)

    monkeypatch.setattr(classify, "recommendations", recommendations)
    m = Model(spark, SF)
    chain.Chain(m)._classify("execucao-x", {f: m.bronze(f) for f in raw.SOURCES})
    for df, columns in ((seen["users"], ["usuario_id"]), (seen["contents"], ["conteudo_id", "data_publicacao"])):
        assert spark.read.parquet(*df.inputFiles()).columns == columns
        assert df.count() == df.distinct().count() > 0
