"""The corpus pipeline: documents to clean, deduplicated, tokenized training data.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and read again as the next
one's docs. All stages but the last return the columns of documents. Each
works on every row that its predecessor kept, whatever other columns it has.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from auric.llm import bpe, decontaminate, language, near_dup, pii
from auric.llm.queries import QUERY_KEY, table, tokenizer
from auric.session import stage


def only(docs: DataFrame, marked: DataFrame, verdict) -> DataFrame:
    """The columns of ``docs`` from ``marked``, which carries a row as the struct ``row``, where ``verdict`` holds."""
    return marked.where(verdict).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def as_rows(docs: DataFrame) -> DataFrame:
    """(row, text, lang, doc_id): each row whole in a struct beside the columns that operators read."""
    return docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), "doc_id", "text", "lang")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; those that are null, empty or without letters (``und``) go. ``lang`` stays
    as it was given."""
    model = language.fit(docs.where(~language.held_out()))
    return only(docs, language.identify(as_rows(docs), model, keep=["row"]), F.col("lang_pred") != "und")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8), that with the smallest id; rows repeated with the
    same id and text are one document, of which one row stays. Rows with a null id stay, as do null and empty texts."""
    key = ["doc_id", "text_hash"]
    found = stage(near_dup.near_duplicates(docs.select("doc_id", "text")).where("doc_id is not null"), "near")
    leave = found.groupBy(*key).agg(F.min("kept").alias("kept"), F.count("*").alias("n")).where("not kept or n > 1")
    leave = stage(leave, "leave")
    if leave.count() <= near_dup.BROADCAST_ROWS:  # else both sides are shuffled
        leave = F.broadcast(leave)
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.struct(*[F.col(c) for c in docs.columns]).alias("row"))
    once = rows.join(leave, key, "left_anti").select("row")
    again = rows.join(leave.where("kept"), key).groupBy(*key).agg(F.min_by("row", F.to_json("row")).alias("row")).select("row")
    return once.unionByName(again).select(*[F.col("row")[c].alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any passage of the benchmark. Null and empty texts have none and stay, each repeated row is
    judged on its own, null ids do no harm."""
    found = decontaminate.find_passages(as_rows(docs), table(spark, sf_dir, "benchmark"), keep=["row"])
    return only(docs, found, F.size("spans") == 0)


def replace_pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by surrogates; ``n_chars`` follows the text. A null text stays null (as does
    its ``n_chars``), an empty one empty; repeated rows get equal texts, null ids do no harm."""
    new = pii.replace_pii(as_rows(docs), QUERY_KEY).select("row", "text")
    chars = {"text": F.col("text"), "n_chars": F.length("text").cast("long")}
    return new.select(*[chars.get(c, F.col("row")[c]).alias(c) for c in docs.columns])


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, their number, and digests of ids and decoded text. A null or empty text has no
    tokens; every row is answered on its own, repeated and null ids keep their rows."""
    return bpe.encode(docs, tokenizer("byte_bpe_50k.json")).select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"), "token_ids")


STAGES = [
    ("language", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("pii", replace_pii),
    ("bpe", encode),
]

#: Surrogates, byte pairs and the fitted language model are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written to the shared folder and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), f"pipeline-{name}-{uuid.uuid4().hex[:6]}")
    return docs
