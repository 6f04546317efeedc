"""Rows with everything that documents can hold: nulls, empty and very long texts, ties, repeats, clashing columns."""

from pyspark.sql import functions as F

LONG = " ".join(f"word{k % 997} and{k % 89}" for k in range(30_000))
EXTRA = ["id", "txt", "row", "text_", "n_words", "n_tokens", "size", "score", "part", "h", "c0", "kind", "node", "key", "k"]
ROWS = [
    (1, "The quick brown fox jumps over the lazy dog near the old river bank today", "en"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today", "en"),
    (2, "The quick brown fox jumps over the lazy dog near the old river bank today", "en"),
    (3, None, None), (4, "", "de"), (5, "   \t\n", "fr"), (6, "1234 567 !!", "en"), (None, "A text without an id, é ü 中文", None),
    (None, "A text without an id, é ü 中文", "en"), (7, LONG, "en"), (8, "one", "en"), (8, "another text under the same id", "de"),
    (9, "Mail me: jo.doe@mail.example.com or +1 (017) 555-7713, don't!", "en"), (10, "\x00 <|endoftext|> 🙂 'll", "en"),
]


def documents(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    df = df.withColumn("source", F.lit(None).cast("string")).withColumn("n_chars", F.length("text").cast("long"))
    for c in EXTRA:
        df = df.withColumn(c, F.lit("extra"))
    return df


def key(row):
    return tuple(str(v) for v in row)
