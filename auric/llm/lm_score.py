"""Language-model scores by masked pseudo-likelihood.

A small network predicts every token of a text from the tokens on both sides
of it; a document's score is the sum of the logarithms of the probabilities
that it gives to the document's own tokens. Tokens are whole words, known by
64-bit hashes. The network predicts the class of the token in the middle (a
class of its own for each of the most frequent tokens, classes by ending for
the others); within a class a token has its share of the counts over the whole
corpus.

Counts come from all documents, one for each word, in a Spark table that grows
with the corpus; words are joined to it by key, but for the most frequent ones,
which the tasks have at hand. The network is trained in numpy by the tasks,
each on its own documents, and every document is used once: the documents are
dealt into rounds, and the networks of a round are averaged by their numbers
of tokens and passed on to the next.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.arrowtext import SpanHasher, flat, lower_az, shared, slices, word_spans
from auric.session import stage

#: Token numbers: 59 bits of the word's hash and 5 of its ending's.
ENDINGS = 32
#: Words with a class of their own: at least OWN, and one for every WORDS_A_CLASS words of the corpus up to MOST_OWN, which
#: bounds the network's weights and nothing else.
OWN, MOST_OWN, WORDS_A_CLASS = 64, 256, 4096
#: Classes are numbered: OWN words, the endings, then the edge of a text (CLASSES), then the further words.
CLASSES, SIDE, HIDDEN = OWN + ENDINGS, 2, 16
#: The most frequent words, whose counts the tasks have at hand; the others' are joined.
COMMON = 1 << 16
#: Tokens that a task counts before it hands the counts on.
COUNT_TOKENS = 1 << 21
ROUNDS, BATCH, RATE, SEED = 2, 4096, 0.1, 5
#: Rows of a batch whose probabilities are held at a time, so that they stay in a processor's cache.
BLOCK = 512
#: Networks averaged by one task at a time.
FAN = 32


def word_bytes() -> np.ndarray:
    table = np.ones(256, bool)
    table[:33] = False
    return table


def tokens(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(token numbers, position of each text's first) of the words between white space and control characters."""
    data = lower_az(data)
    start, end, first = word_spans(data, offsets, word_bytes())
    sums = hasher.sums(data)
    word = hasher.spans(sums, start, end)
    ending = hasher.spans(sums, np.maximum(start, end - 2), end)
    return ((word >> np.uint64(5)) << np.uint64(5) | ending >> np.uint64(59)).view(np.int64), first


class Counts:
    """Corpus counts by word. ``table`` (token, n) holds all words and stays in Spark; ``token`` and ``n`` are the common
    ones in order of token, ``own`` those with a class of their own and ``own_class`` their classes, ``mass`` the count of each
    ending's other words and one more, which is the count of any word that the corpus does not have."""

    def __init__(self, table: DataFrame, token: np.ndarray, n: np.ndarray, mass: np.ndarray, words: int):
        self.table = table
        number = min(max(OWN, words // WORDS_A_CLASS), MOST_OWN)
        top = np.lexsort((token, -n))[:number]
        klass = np.concatenate([np.arange(OWN), np.arange(CLASSES + 1, CLASSES + 1 + MOST_OWN)])[: len(top)]
        by = np.argsort(token[top])
        self.own, self.own_class = token[top][by], klass[by].astype(np.int16)
        self.classes = CLASSES + 1 + max(0, len(top) - OWN)
        by = np.argsort(token)
        self.token, self.n = token[by], n[by]
        self.mass = mass + 1.0 - np.bincount(token[top] & (ENDINGS - 1), n[top], ENDINGS)

    def __getstate__(self):
        return self.__dict__ | {"table": None}  # tasks have no Spark session

    def class_of(self, token: np.ndarray) -> np.ndarray:
        at, hit = found(self.own, token)
        out = (OWN + (token & (ENDINGS - 1))).astype(np.int16)
        out[hit] = self.own_class[at[hit]]
        return out

    def common_share(self, token: np.ndarray, klass: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(logarithm of the share in the class, rare) for each token; of a rare one, the share of a count of 1."""
        at, hit = found(self.token, token)
        several = (klass >= OWN) & (klass < CLASSES)
        share = np.zeros(len(token))
        share[several] = -np.log(self.mass)[klass[several] - OWN]
        some = several & hit
        share[some] += np.log(self.n[at[some]])
        return share, several & ~hit

    @property
    def klass(self) -> Looked:
        return Looked(self, "klass")

    @property
    def share(self) -> Looked:
        return Looked(self, "share")


class Looked:
    """Classes or shares for the driver's eyes: by token, or as an array of those of all words and the edge."""

    def __init__(self, counts: Counts, name: str):
        self.counts, self.name = counts, name

    def of(self, token: np.ndarray, rows) -> np.ndarray:
        klass = self.counts.class_of(token)
        if self.name == "klass":
            return klass
        share, rare = self.counts.common_share(token, klass)
        held = dict(zip(rows["token"].to_pylist(), rows["n"].to_pylist()))
        share[rare] += np.log([held.get(int(t), 1) for t in token[rare]])
        return share

    def __getitem__(self, token: np.ndarray) -> np.ndarray:
        wanted = [int(t) for t in np.unique(token)]
        out = self.of(np.atleast_1d(token), self.counts.table.where(F.col("token").isin(wanted)).toArrow())
        return out if np.ndim(token) else out[0]

    def __array__(self, dtype=None, copy=None) -> np.ndarray:
        rows = self.counts.table.orderBy("token").toArrow()
        edge = np.int16(CLASSES) if self.name == "klass" else 0.0
        return np.append(self.of(rows["token"].to_numpy(), rows), edge).astype(dtype or (np.int64 if self.name == "klass" else np.float64))

    def astype(self, dtype) -> np.ndarray:
        return np.asarray(self).astype(dtype)


def found(known: np.ndarray, token: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place among the known, whether it is there) of each token."""
    at = np.minimum(np.searchsorted(known, token), max(len(known) - 1, 0))
    return at, known[at] == token if len(known) else np.zeros(len(token), bool)


def contexts(klass: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For every token the classes of its SIDE neighbours on either side; CLASSES where the text has none."""
    text = np.repeat(np.arange(len(first) - 1), np.diff(first))
    out = np.full((len(klass), 2 * SIDE), CLASSES, np.int16)
    for k, step in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        at = np.arange(len(klass)) + step
        near = (at >= 0) & (at < len(klass))
        near[near] = text[at[near]] == text[near]
        out[near, k] = klass[at[near]]
    return out


class Network:
    """Embeddings of the neighbours' classes by place, a hidden layer, and a softmax over classes."""

    def __init__(self, classes: int, flat_: np.ndarray | None = None):
        shapes = [(2 * SIDE, classes, HIDDEN), (HIDDEN,), (HIDDEN, classes), (classes,)]
        ends = np.cumsum([0, *[math.prod(s) for s in shapes]])
        if flat_ is None:
            flat_ = np.random.default_rng(SEED).normal(0, 0.1, ends[-1]).astype(np.float32)
            flat_[ends[-2] + CLASSES] = -30  # no token is of the edge's class
        self.flat = flat_.copy()
        self.embed, self.shift, self.out, self.base = (self.flat[a:b].reshape(s) for a, b, s in zip(ends[:-1], ends[1:], shapes))
        self.ends, self.shapes = ends, shapes

    def hidden(self, near: np.ndarray) -> np.ndarray:
        h = self.shift + self.embed[0][near[:, 0]]
        for k in range(1, 2 * SIDE):
            h += self.embed[k][near[:, k]]
        return np.tanh(h)

    def logs(self, h: np.ndarray) -> np.ndarray:
        """Logarithms of the class probabilities."""
        z = h @ self.out + self.base
        z -= z.max(1, keepdims=True)
        return z - np.log(np.exp(z).sum(1, keepdims=True))

    def raised(self, near: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hidden layer with a column of ones, exponentials of its products with ``weights`` less each row's largest,
        these largest)."""
        h = np.ones((len(near), HIDDEN + 1), np.float32)
        h[:, :HIDDEN] = self.hidden(near)
        z = h @ weights
        top = z.max(1)
        z -= top[:, None]
        return h, np.exp(z, out=z), top

    def logs_of(self, near: np.ndarray, target: np.ndarray) -> np.ndarray:
        """Logarithms of the probabilities of the target classes alone."""
        out, weights = np.empty(len(target), np.float32), np.vstack([self.out, self.base])
        for a in range(0, len(target), BLOCK):
            own = target[a: a + BLOCK]
            h, z, top = self.raised(near[a: a + BLOCK], weights)
            out[a: a + BLOCK] = (h * weights[:, own].T).sum(1) - top - np.log(z.sum(1))
        return out

    def train(self, near: np.ndarray, target: np.ndarray, power: np.ndarray) -> None:
        """One step on a batch; ``power`` holds the sums of squared gradients that scale the steps."""
        n = len(target)
        grad = np.zeros_like(self.flat)
        embed, shift, out, base = (grad[a:b].reshape(s) for a, b, s in zip(self.ends[:-1], self.ends[1:], self.shapes))
        back, weights = np.empty((n, HIDDEN), np.float32), np.vstack([self.out, self.base])
        both = np.zeros_like(weights)
        for a in range(0, n, BLOCK):
            own = target[a: a + BLOCK]
            h, z, _ = self.raised(near[a: a + BLOCK], weights)
            scale = 1 / z.sum(1, keepdims=True)  # the probabilities are z * scale, which need not be written down
            both += (h * scale).T @ z
            both -= np.stack([np.bincount(own, h[:, k], both.shape[1]) for k in range(HIDDEN + 1)])
            back[a: a + BLOCK] = ((z @ self.out.T) * scale - self.out[:, own].T) * (1 - h[:, :HIDDEN] ** 2)
        both /= n
        back /= n
        out += both[:HIDDEN]
        base += both[HIDDEN]
        shift += back.sum(0)
        for k in range(2 * SIDE):
            place = near[:, k, None].astype(np.int64) * HIDDEN + np.arange(HIDDEN)
            embed[k] += np.bincount(place.ravel(), back.ravel(), embed[k].size).reshape(embed[k].shape)
        power += grad * grad
        self.flat -= RATE * grad / np.sqrt(power)


def count_tokens(texts: DataFrame) -> Counts:
    """The words of all texts and their counts; at most COMMON of them reach the driver."""

    def counted(kept: list[np.ndarray]) -> pa.RecordBatch:
        token, n = np.unique(np.concatenate(kept), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(token), pa.array(n)], names=["token", "n"])

    def scan(batches):
        hasher, kept = SpanHasher(), []
        for whole in batches:
            for batch in slices(whole, "txt"):
                kept.append(tokens(*flat(batch.column("txt")), hasher)[0])
                if sum(map(len, kept)) > COUNT_TOKENS:
                    yield counted(kept)
                    kept = []
        if kept:
            yield counted(kept)

    table = stage(texts.mapInArrow(scan, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")), "words")
    # words by steps of their count, to tell where the common ones begin
    step = F.floor(F.log2("n") * 16)
    steps = sorted(((r["step"], r["words"]) for r in table.groupBy(step.alias("step")).agg(F.count("*").alias("words")).collect()), reverse=True)
    room, least = COMMON, None
    for s, words in steps:
        room -= words
        if room < 0:
            break
        least = s
    common = table.where(step >= least if least is not None else F.lit(False)).toArrow()
    mass = np.zeros(ENDINGS)
    for r in table.groupBy(F.expr(f"token & {ENDINGS - 1}").alias("e")).agg(F.sum("n").alias("n")).collect():
        mass[r["e"]] = r["n"]
    return Counts(table, common["token"].to_numpy(), common["n"].to_numpy(), mass, sum(words for _, words in steps))


def averaged(nets: DataFrame) -> tuple[np.ndarray, np.ndarray] | None:
    """(network, sums of squares) averaged by weight over all rows (part, weight, net, power), FAN rows to a task."""
    schema = "part long, weight double, net binary, power binary"

    def mean(pdf: pd.DataFrame) -> pd.DataFrame:
        w = pdf["weight"].to_numpy()
        both = []
        for c in ("net", "power"):
            total = sum(np.frombuffer(x, np.float32).astype(np.float64) * v for x, v in zip(pdf[c], w))
            both.append((total / w.sum()).astype(np.float32).tobytes())
        return pd.DataFrame({"part": [int(pdf["part"].min())], "weight": [w.sum()], "net": [both[0]], "power": [both[1]]})

    n = nets.count()
    while n > FAN:
        groups = -(-n // FAN)
        nets = stage(nets.groupBy(F.pmod(F.xxhash64("part"), F.lit(groups)).alias("g")).applyInPandas(mean, schema), "networks")
        n = nets.count()
    rows = nets.orderBy("part").toPandas()
    if not len(rows):
        return None
    last = mean(rows).iloc[0]
    return np.frombuffer(last["net"], np.float32), np.frombuffer(last["power"], np.float32)


def fit(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> tuple[Counts, Network]:
    """Counts and network from all of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).alias("txt"))
    counts = count_tokens(texts)
    known, classes = shared(spark, counts), counts.classes
    net = Network(classes)
    power = np.full(len(net.flat), 1e-6, np.float32)
    for r in range(rounds):
        sent = shared(spark, (net.flat, power))

        def train(batches, sent=sent):
            hasher, table = SpanHasher(), known()
            start, squares = sent()
            own, squares, seen = Network(classes, start), squares.copy(), 0
            for whole in batches:
                for batch in slices(whole, "txt"):
                    token, first = tokens(*flat(batch.column("txt")), hasher)
                    target = table.class_of(token)
                    near = contexts(target, first)
                    for k in range(0, len(token), BATCH):
                        own.train(near[k: k + BATCH], target[k: k + BATCH], squares)
                    seen += len(token)
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([TaskContext.get().partitionId()], pa.int64()), pa.array([float(seen)]),
                     pa.array([own.flat.tobytes()], pa.binary()), pa.array([squares.tobytes()], pa.binary())], names=["part", "weight", "net", "power"])

        turn = texts.where(F.pmod(F.coalesce(F.xxhash64("txt"), F.lit(0)), F.lit(rounds)) == r)
        got = averaged(stage(turn.mapInArrow(train, "part long, weight double, net binary, power binary"), "networks"))
        if got:
            net, power = Network(classes, got[0]), got[1]
    return counts, net


def score(docs: DataFrame, model: tuple[Counts, Network], text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(columns ``keep``, by default doc_id; n_tokens, log_likelihood, mean_log_likelihood) for each row of ``docs``.

    ``log_likelihood`` is the sum over all tokens of the whole text of the logarithm of the token's probability given
    the two tokens on either side. A text that is null, empty or without words has no tokens, a sum of 0 and a null
    mean. Each row is answered on its own: null or repeated ids keep their rows; an empty table gives none; other
    columns do not matter. Scores vary in their last digits with the dealing of the rows to tasks, in whose order the
    network is trained.

    A pass over the texts gives each row its sum without the counts of rare words, and these words; their counts are
    then joined by word and added up by row."""
    keep = keep or ["doc_id"]
    names = [f"c{k}" for k in range(len(keep))]
    known = shared(docs.sparkSession, model)

    def scan(batches):
        hasher, (table, net) = SpanHasher(), known()
        for whole in batches:
            for batch in slices(whole, "txt"):
                token, first = tokens(*flat(batch.column("txt")), hasher)
                target = table.class_of(token)
                near = contexts(target, first)
                share, rare = table.common_share(token, target)
                each = np.zeros(len(token) + 1)
                each[1:] = net.logs_of(near, target)
                each[1:] += share
                np.cumsum(each, out=each)
                n = np.diff(first)
                total = np.where(n > 0, each[first[1:]] - each[first[:-1]], 0.0)
                ends = np.concatenate([[0], np.cumsum(rare)])[first]
                words = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(token[rare]))
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(c) for c in names], batch.column("rid"), pa.array(n, pa.int64()), pa.array(total), words],
                    names=[*names, "rid", "n_tokens", "total", "words"])

    cur = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.monotonically_increasing_id().alias("rid"), F.col(text_col).alias("txt"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cur.schema.fields[:-1])
    rows = stage(cur.mapInArrow(scan, f"{kinds}n_tokens long, total double, words array<long>"), "rows")
    # a word that stands once in the corpus, or not at all, adds nothing
    several = model[0].table.where("n > 1")
    more = rows.select("rid", F.explode("words").alias("token")).join(several, "token").groupBy("rid").agg(F.sum(F.log("n")).alias("more"))
    total = F.col("total") + F.coalesce("more", F.lit(0.0))
    return rows.drop("words").join(more, "rid", "left").select(
        *[F.col(n).alias(c) for n, c in zip(names, keep)], "n_tokens", total.alias("log_likelihood"),
        F.when(F.col("n_tokens") > 0, total / F.col("n_tokens")).alias("mean_log_likelihood"))
