"""Phrase collocations of two and three words by best-first branch and bound.

Phrases grow from prefixes whose counts bound every score below them: a
phrase's score is at most a/f for the count a of its first (last) two words
and the count f of its first (last) word, and its count at most that of any
part. All words are counted first, then the pairs of words that are frequent
enough. Then a frontier of pairs is expanded, best bounds first: those whose
bound reaches a threshold key (score, count), and those whose own fate hangs
on a longer phrase. A language is settled when as many phrases as asked for
survive at or above its threshold, as nothing unexpanded can reach that;
else its threshold is lowered and its texts are searched again.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.arrowtext import bounded_batches, flat, lower_az, shared, slices, word_spans
from auric.llm.intern import intern, joined, strings, xxhash64
from auric.session import stage

TOP = 2000
LEAST = 10
#: A phrase goes if a longer one around it has this many hundredths of its count.
WITHIN = 50
SCALE = 1_000_000
#: Pairs at or above a language's threshold in the first searches, in units of TOP; the last search has no threshold.
WIDEN = (4, 32)
#: Bits of each frontier map, a bound on what tasks are sent; a fuller map lets more phrases be counted, none fewer.
MAP_BITS = 25
BLOCK_WORDS = 1 << 17
SLICE = 2 << 20
SEED = 42  # of Spark's xxhash64
SMALL_ROWS = 100_000


def tables() -> tuple[np.ndarray, np.ndarray]:
    """(bytes of words, bytes that end a piece)."""
    ends = np.zeros(256, bool)
    ends[list(b".,;:!?\n\x0b\x0c\r")] = True
    word = ~ends
    word[[9, 32]] = False
    return word, ends


def word_blocks(batch):
    """For blocks of words (with two more words ahead): joined buffer, starts, ends, language code, number of words of
    the block itself, and whether the word is followed by another of its piece."""
    data, offsets = flat(batch.column("txt"))
    data = lower_az(data)
    word, ends = tables()
    start, end, first = word_spans(data, offsets, word)
    words = np.diff(first)
    text = np.repeat(np.arange(len(words)), words)
    piece = np.concatenate([[0], np.cumsum(ends[data], dtype=np.int32)])[start]
    code = np.asarray(batch.column("code"))[text]
    for a in range(0, len(start), BLOCK_WORDS):
        b, c = min(a + BLOCK_WORDS, len(start)), min(a + BLOCK_WORDS + 2, len(start))
        buf, s, e = joined(data, start[a:c], end[a:c])
        follows = np.zeros(c - a, bool)
        follows[:-1] = (piece[a:c - 1] == piece[a + 1:c]) & (text[a:c - 1] == text[a + 1:c])
        yield buf, s, e, code[a:c], b - a, follows


def counted(names, buf, start, size, code) -> pa.RecordBatch:
    """(lang, phrase, n): each distinct span of a language with the number of its occurrences."""
    slot, holder = intern(buf, start, size, xxhash64(buf, start, size), code)
    used = np.flatnonzero(holder >= 0)
    n = np.bincount(slot, minlength=len(holder))[used]
    at = holder[used]
    return pa.RecordBatch.from_arrays([names.take(pa.array(code[at])), strings(buf, start[at], size[at]).cast(pa.string()), pa.array(n, pa.int64())], names=["lang", "phrase", "n"])


def coded(batch):
    """(names of the languages, the batch with a column of their codes)."""
    lang = batch.column("lang").dictionary_encode()
    return lang.dictionary, batch.append_column("code", pa.array(np.asarray(lang.indices)))


def words(docs: DataFrame) -> DataFrame:
    """(lang, phrase, n) of all words; the empty phrase has the number of words of the language."""

    def scan(batches):
        for whole in batches:
            for part in slices(whole, "txt", SLICE):
                names, batch = coded(part)
                total = np.zeros(len(names), np.int64)
                for buf, s, e, code, own, _ in word_blocks(batch):
                    total += np.bincount(code[:own], minlength=len(names))
                    yield counted(names, buf, s[:own], (e - s)[:own], code[:own])
                yield pa.RecordBatch.from_arrays([names, pa.array([""] * len(names), pa.string()), pa.array(total)], names=["lang", "phrase", "n"])

    return docs.mapInArrow(scan, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def holds(bits: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether the map has the bits of the hashes."""
    at = key & np.uint64(64 * len(bits) - 1)
    return (bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) > 0


def frequent_pairs(docs: DataFrame, frequent: np.ndarray) -> DataFrame:
    """(lang, phrase, n) of the pairs of words that are both in the map ``frequent``."""
    known = shared(docs.sparkSession, frequent)

    def scan(batches):
        frequent = known()
        for whole in batches:
            for part in slices(whole, "txt", SLICE):
                names, batch = coded(part)
                for buf, s, e, code, own, follows in word_blocks(batch):
                    often = holds(frequent, xxhash64(buf, s, e - s, SEED))
                    pair = np.flatnonzero(follows[:own] & often[:own] & np.append(often[1:], False)[:own])
                    yield counted(names, buf, s[pair], e[np.minimum(pair + 1, len(e) - 1)] - s[pair], code[pair])

    return docs.mapInArrow(scan, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def triples(docs: DataFrame, maps: dict[str, np.ndarray]) -> DataFrame:
    """(lang, phrase, n) of the phrases of three words that the frontier maps ask for, each with all its occurrences."""
    known = shared(docs.sparkSession, maps)

    def scan(batches):
        maps = known()
        for whole in batches:
            for part in slices(whole, "txt", SLICE):
                names, batch = coded(part)
                for buf, s, e, code, own, follows in word_blocks(batch):
                    pair = np.flatnonzero(follows)
                    key = xxhash64(buf, s[pair], e[np.minimum(pair + 1, len(e) - 1)] - s[pair], SEED)
                    is_in = {}
                    for kind, bits in maps.items():
                        is_in[kind] = np.zeros(len(s) + 1, bool)
                        is_in[kind][pair] = holds(bits, key)
                    first, then = slice(0, own), slice(1, own + 1)
                    want = is_in["head"][first] & is_in["tail"][then] | is_in["check"][first] & is_in["any"][then] | is_in["any"][first] & is_in["check"][then]
                    k = np.flatnonzero(want)
                    yield counted(names, buf, s[k], e[np.minimum(k + 2, len(e) - 1)] - s[k], code[k])

    return docs.mapInArrow(scan, "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("n"))


def score(a, l, r):
    """floor(SCALE * a * a / (l * r)) in decimals, as products may pass 64 bits."""
    wide = lambda c: c.cast("decimal(15,0)")
    return F.call_function("div", F.lit(SCALE).cast("decimal(7,0)") * (wide(a) * wide(a)), wide(l) * wide(r))


def scored_pairs(words: DataFrame, pairs: DataFrame) -> DataFrame:
    """Pairs with the counts of their words, score, and the bounds of phrases that begin (``head``) or end (``tail``)
    with them."""
    word = lambda name, n: words.select("lang", F.col("phrase").alias(name), F.col("n").alias(n))
    pairs = pairs.select("lang", "phrase", F.substring_index("phrase", " ", 1).alias("w1"), F.substring_index("phrase", " ", -1).alias("w2"), F.col("n").alias("a"))
    pairs = pairs.join(word("w1", "l"), ["lang", "w1"]).join(word("w2", "r"), ["lang", "w2"])
    return pairs.select("lang", "phrase", "a", "l", "r", score(F.col("a"), F.col("l"), F.col("r")).alias("score"),
                        F.expr(f"a * {SCALE} div l").alias("head"), F.expr(f"a * {SCALE} div r").alias("tail"))


def levels(rows: DataFrame, langs: DataFrame, wanted: int) -> DataFrame:
    """(lang, t_score, t_a): for each language a key that at least ``wanted`` of its rows reach, (0, 0) where there are
    fewer. Rows are counted in some 1300 levels a language: of the score's root, at the full score of the count."""
    full = F.col("score") >= SCALE
    level = rows.select("lang", F.when(full, F.lit(SCALE)).otherwise(F.pow(F.floor(F.sqrt("score")), 2)).cast("long").alias("t_score"),
                        F.when(full, F.floor(F.pow(F.lit(2.0), F.floor(F.log2("a") * 8) / 8))).otherwise(F.lit(0)).cast("long").alias("t_a"))
    level = level.groupBy("lang", "t_score", "t_a").agg(F.count("*").alias("n"))
    before = Window.partitionBy("lang").orderBy(F.col("t_score").desc(), F.col("t_a").desc()).rowsBetween(Window.unboundedPreceding, -1)
    level = level.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    reached = level.where((F.col("before") < wanted) & (F.col("before") + F.col("n") >= wanted)).select("lang", "t_score", "t_a")
    return langs.join(reached, "lang", "left").select("lang", F.coalesce("t_score", F.lit(0)).alias("t_score"), F.coalesce("t_a", F.lit(0)).alias("t_a"))


def small(rows: DataFrame) -> DataFrame:
    """A broadcast of a table of languages, if they are as few as usual."""
    return F.broadcast(rows) if rows.count() <= SMALL_ROWS else rows


def reaches(by: str):
    return F.struct(F.col(by), F.col("a")) >= F.struct(F.col("t_score"), F.col("t_a"))


def maps_of(phrases: DataFrame, kinds: dict) -> dict[str, np.ndarray]:
    """For each kind a bit map of the hashes of the phrases that fulfil its condition: at most 2 ** MAP_BITS bits."""
    h = F.xxhash64("phrase").bitwiseAND(F.lit((1 << MAP_BITS) - 1))
    rows = phrases.select(h.alias("h"), F.explode(F.array_compact(F.array(*[F.when(c, F.lit(k)) for k, c in enumerate(kinds.values())]))).alias("kind"))
    rows = rows.groupBy("kind", F.shiftright("h", 6).alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, cast(h & 63 as int))")).alias("bits"))
    found = rows.toArrow()
    kind, word, bits = (found.column(c).to_numpy() for c in ("kind", "word", "bits"))
    maps = {}
    for k, name in enumerate(kinds):
        maps[name] = np.zeros(1 << (MAP_BITS - 6), np.uint64)
        maps[name][word[kind == k]] = bits[kind == k].view(np.uint64)
    return maps


def frontier(pairs: DataFrame) -> dict[str, np.ndarray]:
    """Maps of pairs: that may begin (head) or end (tail) a phrase at or above the threshold, that are themselves at or
    above it (check), and all (any)."""
    return maps_of(pairs, {"any": F.lit(True), "head": reaches("head"), "tail": reaches("tail"), "check": reaches("score")})


def scored_triples(found: DataFrame, pairs: DataFrame) -> DataFrame:
    """Phrases of three words with their lowest-scoring cut, of equal ones the first."""
    w = F.split("phrase", " ")
    rows = found.select("lang", "phrase", F.col("n").alias("a"), F.concat_ws(" ", w[0], w[1]).alias("p1"), F.concat_ws(" ", w[1], w[2]).alias("p2"))
    one = pairs.select("lang", F.col("phrase").alias("p1"), F.col("a").alias("a1"), F.col("l").alias("l1"))
    two = pairs.select("lang", F.col("phrase").alias("p2"), F.col("a").alias("a2"), F.col("r").alias("r2"))
    rows = rows.join(one, ["lang", "p1"]).join(two, ["lang", "p2"])
    rows = rows.withColumn("s1", score(F.col("a"), F.col("l1"), F.col("a2"))).withColumn("s2", score(F.col("a"), F.col("a1"), F.col("r2")))
    cut = F.col("s1") <= F.col("s2")
    pick = lambda x, y: F.when(cut, F.col(x)).otherwise(F.col(y))
    return rows.select("lang", "phrase", "p1", "p2", "a", pick("l1", "a1").alias("l"), pick("a2", "r2").alias("r"), pick("s1", "s2").alias("score"))


def survivors(pairs: DataFrame, longer: DataFrame, within: int) -> DataFrame:
    """Pairs and triples at or above the threshold that no longer phrase takes up."""
    cover = longer.select("lang", F.explode(F.array("p1", "p2")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    top = pairs.where(reaches("score")).join(cover, ["lang", "phrase"], "left")
    columns = ["lang", "phrase", "a", "l", "r", "score"]
    free = F.col("most").isNull() | (100 * F.col("most") < within * F.col("a"))
    return top.where(free).select(*columns).unionByName(longer.where(reaches("score")).select(*columns))


def mine(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", top: int = TOP, least: int = LEAST, within: int = WITHIN) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the first ``top`` phrases of each language by score, count and phrase.

    A null language is ``und``; null and empty texts have no words. Repeated rows count as often as they stand there,
    ties are told apart by the phrase's bytes, an empty table or a language without phrases gives no rows, and other
    columns do not matter. Texts are read three times, and again for the languages that are not settled then."""
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"), F.col(text_col).alias("txt"))
    grams = stage(words(texts).where((F.col("n") >= least) | (F.col("phrase") == "")), "words")
    totals, often = grams.where("phrase = ''").select("lang", "n"), grams.where("phrase <> ''")
    found = frequent_pairs(texts, maps_of(often, {"word": F.lit(True)})["word"]).where(F.col("n") >= least)
    pairs = stage(scored_pairs(often, stage(found, "counted")), "pairs")
    open_langs, done = stage(pairs.select("lang").distinct(), "langs"), None
    for widen in (*WIDEN, None):
        if open_langs.isEmpty():
            break
        limit = levels(pairs, open_langs, widen * top) if widen else open_langs.selectExpr("lang", "0L as t_score", "0L as t_a")
        limit = stage(limit, "limits")
        few = small(limit)
        of = pairs.join(few, "lang")
        part = texts.join(small(limit.select("lang")), "lang", "left_semi")
        found = triples(part, frontier(of)).where(F.col("n") >= least)
        longer = stage(scored_triples(found, pairs), "triples").join(few, "lang")
        left = stage(survivors(of, longer, within), "survivors")
        counts = left.groupBy("lang").agg(F.count("*").alias("left"))
        state = stage(limit.join(counts, "lang", "left").selectExpr("lang", "coalesce(left, 0) >= %d or t_score = 0 and t_a = 0 as settled" % top), "state")
        settled = state.where("settled").select("lang")
        out = left.join(small(settled), "lang")
        out = out.join(small(levels(out, settled, top)), "lang").where(reaches("score")).drop("t_score", "t_a")
        done = out if done is None else done.unionByName(out)
        open_langs = state.where("not settled").select("lang")
    if done is None:
        done = pairs.select("lang", "phrase", "a", "l", "r", "score")
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    done = done.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
    return done.join(small(totals), "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda w: w <> '') AS w FROM pieces),
grams AS (
  SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM worded, range(1, 4) t(k)),
f AS (SELECT lang, k, phrase, count(*)::HUGEINT AS n FROM grams GROUP BY ALL),
total AS (SELECT lang, sum(n)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
cuts AS (
  SELECT lang, f.k, phrase, f.n AS a, c AS cut, array_to_string(string_split(phrase, ' ')[1:c], ' ') AS p, array_to_string(string_split(phrase, ' ')[c + 1:], ' ') AS q
  FROM f, range(1, 3) t(c) WHERE f.k > c AND f.n >= 10),
valued AS (
  SELECT x.lang, x.k, x.phrase, x.a, cut, y.n AS l, z.n AS r, (1000000 * x.a * x.a) // (y.n * z.n) AS score
  FROM cuts x JOIN f y ON y.lang = x.lang AND y.phrase = x.p JOIN f z ON z.lang = x.lang AND z.phrase = x.q),
best AS (SELECT * FROM valued QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
inner_pairs AS (
  SELECT lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) AS phrase, a AS longer
  FROM best WHERE k = 3),
cover AS (SELECT lang, phrase, max(longer) AS longer FROM inner_pairs GROUP BY ALL),
ranked AS (
  SELECT best.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank
  FROM best LEFT JOIN cover USING (lang, phrase) WHERE coalesce(100 * longer < 50 * a, true))
SELECT lang, rank::BIGINT AS rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, total.n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
