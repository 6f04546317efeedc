"""Toxicity scores by a factorization machine over hashed terms.

Terms are the words of a text and their beginnings, each present or not. A
linear weight per term and an inner product of factors per pair of terms are
learnt together, so a harmless-looking pair, such as an insult with the
mention of a group, can count for more than its parts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.arrowtext import SpanHasher, flat, lower_az, shared, slices, word_spans
from auric.session import stage

#: Labelled documents that are fitted on, of each class, and the terms that they have in all; a class whose documents
#: have more terms is fitted on fewer documents.
MAX_DOCS, MAX_TERMS = 5000, 4_000_000
#: Terms are learnt that stand in so many documents of the sample and whose chi-squared statistic against the label is
#: so large, alone or beside another term; of more than MOST_TERMS the most telling.
LEAST_DOCS, LEAST_CHI, MOST_TERMS = 4, 10.0, 4000
#: For terms that tell something only beside another: the statistic that they need there, the most telling terms beside
#: which all others are tried, and the most frequent terms that are tried in pairs.
PAIR_CHI, BESIDE, FREQUENT = 30.0, 32, 512
PREFIXES = (4, 5, 6)
FACTORS, EPOCHS, BATCH, RATE, SPARSE, SEED = 4, 12, 500, 0.15, 2e-4, 13


def word_bytes() -> np.ndarray:
    table = np.zeros(256, bool)
    table[48:58] = table[65:91] = table[97:123] = table[128:] = True
    return table


def terms(data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(text number, 32-bit term) of the words and their beginnings in order of kind; repeats are kept."""
    data = lower_az(data)
    start, end, first = word_spans(data, offsets, word_bytes())
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
    sums = hasher.sums(data)
    found = [(text, hasher.spans(sums, start, end))]
    for k in PREFIXES:
        longer = end - start > k
        found.append((text[longer], hasher.spans(sums, start[longer], start[longer] + k) ^ np.uint64(k << 32)))
    return np.concatenate([t for t, _ in found]), (np.concatenate([h for _, h in found]) >> np.uint64(32)).astype(np.uint32)


def distinct(text: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The pairs once each, by text and term."""
    both = np.unique(text.astype(np.uint64) << np.uint64(32) | term.astype(np.uint64))
    return (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32)


def chi_squared(count: np.ndarray, toxic: np.ndarray, n: float, p: float) -> np.ndarray:
    """The statistic of being in ``count`` of ``n`` documents, ``toxic`` of them with the label, whose share is ``p``; 0
    for terms in too few documents."""
    chi = (toxic - count * p) ** 2 / np.maximum(count * p * (1 - p) * (1 - count / max(n, 1)), 1e-9)
    return np.where((count < LEAST_DOCS) | (p <= 0) | (p >= 1), 0, chi)


def telling(rows: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """The terms worth learning, in order. A term's worth is its chi-squared statistic against the label; that among the
    documents with one of the most telling terms, if it is larger, as a group's name tells nothing alone but beside an
    insult; and that of its pairs with other frequent terms, as neither of two may tell anything alone."""
    known, number, count = np.unique(np.concatenate(rows), return_inverse=True, return_counts=True)
    size = np.array([len(r) for r in rows])
    n, p, m = len(labels), float(labels.mean()), len(known)
    doc = np.repeat(np.arange(n, dtype=np.int32), size)
    alone = chi_squared(count, np.bincount(number, labels[doc], m), n, p)
    worth = np.where(alone >= LEAST_CHI, alone, 0)
    for term in np.argsort(-alone, kind="stable")[:BESIDE]:
        has = np.zeros(n, bool)
        has[doc[number == term]] = True
        some = has[doc]
        beside = chi_squared(np.bincount(number[some], minlength=m), np.bincount(number[some], labels[doc[some]], m), float(has.sum()), float(labels[has].mean()))
        worth = np.maximum(worth, np.where(beside >= PAIR_CHI, beside, 0))
    often = np.argsort(-np.minimum(count, n - count), kind="stable")[:FREQUENT]
    place = np.full(m, -1)
    place[often] = np.arange(len(often))
    held = np.zeros((n, len(often)), np.float32)
    some = place[number] >= 0
    held[doc[some], place[number[some]]] = 1
    both, toxic = held.T @ held, held.T @ (held * labels[:, None])
    pair = chi_squared(both, toxic, n, p)
    pair[pair < np.maximum(PAIR_CHI, 2 * np.maximum(alone[often][:, None], alone[often][None])) ] = 0  # more than its parts tell
    np.fill_diagonal(pair, 0)
    worth[often] = np.maximum(worth[often], pair.max(1, initial=0))
    best = np.argsort(-worth, kind="stable")[:MOST_TERMS]
    return np.sort(known[best[worth[best] > 0]])


class Machine:
    """A fitted factorization machine; ``terms`` are the known terms in order."""

    def __init__(self, rows: list[np.ndarray], labels: np.ndarray):
        self.constant = not (0 < labels.sum() < len(labels))
        self.terms = np.zeros(0, np.uint32) if self.constant else telling(rows, labels)
        n = len(self.terms)
        self.bias, self.weight, self.factor = 0.0, np.zeros(n, np.float32), np.zeros((n, FACTORS), np.float32)
        if self.constant or not n:
            return
        rng = np.random.default_rng(SEED)
        self.factor = rng.normal(0, 0.01, (n, FACTORS)).astype(np.float32)
        rows = [np.searchsorted(self.terms, r[np.isin(r, self.terms)]) for r in rows]
        gw, gf, gb = np.full(n, 1e-4, np.float32), np.full((n, FACTORS), 1e-4, np.float32), 1e-4
        weigh = np.where(labels > 0, 0.5 / labels.mean(), 0.5 / (1 - labels.mean())).astype(np.float32)
        for _ in range(EPOCHS):
            order = rng.permutation(len(rows))
            for k in range(0, len(order), BATCH):
                some = order[k: k + BATCH]
                term = np.concatenate([rows[i] for i in some])
                text = np.repeat(np.arange(len(some)), [len(rows[i]) for i in some])
                value, sums = self.value(text, term, len(some))
                miss = (1 / (1 + np.exp(-value)) - labels[some]) * weigh[some] / len(some)
                per = miss[text].astype(np.float32)
                dw = np.bincount(term, per, n).astype(np.float32)
                gw += dw * dw
                step = RATE / np.sqrt(gw)
                self.weight -= step * dw
                self.weight = np.sign(self.weight) * np.maximum(np.abs(self.weight) - step * SPARSE, 0)
                df = per[:, None] * (sums[text] - self.factor[term])
                for f in range(FACTORS):
                    d = np.bincount(term, df[:, f], n).astype(np.float32)
                    gf[:, f] += d * d
                    step = RATE / np.sqrt(gf[:, f])
                    v = self.factor[:, f] - step * d
                    self.factor[:, f] = np.sign(v) * np.maximum(np.abs(v) - step * SPARSE, 0)
                gb += float(miss.sum()) ** 2
                self.bias -= RATE / np.sqrt(gb) * float(miss.sum())
        used = (self.weight != 0) | (self.factor != 0).any(1)
        self.terms, self.weight, self.factor = self.terms[used], self.weight[used], self.factor[used]

    def value(self, text: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The machine's value for each text, and its sums of factors; terms by number, distinct in a text."""
        linear = np.bincount(text, self.weight[term], n)
        sums = np.stack([np.bincount(text, self.factor[term, f], n) for f in range(FACTORS)], 1)
        squares = np.bincount(text, (self.factor[term] ** 2).sum(1), n)
        return np.clip(self.bias + linear + 0.5 * ((sums * sums).sum(1) - squares), -30, 30), sums.astype(np.float32)

    def prepare(self) -> None:
        """A table over the terms' upper bits, with which most other terms are told without a search."""
        self.near = np.zeros(1 << 20, bool)
        self.near[self.terms >> np.uint32(12)] = True

    def scores(self, data: np.ndarray, offsets: np.ndarray, hasher: SpanHasher) -> np.ndarray:
        n = len(offsets) - 1
        if self.constant:
            return np.zeros(n)
        text, term = terms(data, offsets, hasher)
        some = self.near[term >> np.uint32(12)]
        text, term = distinct(text[some], term[some])
        at = np.minimum(np.searchsorted(self.terms, term), max(len(self.terms) - 1, 0))
        hit = self.terms[at] == term if len(self.terms) else np.zeros(len(term), bool)
        return 1 / (1 + np.exp(-self.value(text[hit], at[hit], n)[0]))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_docs: int = MAX_DOCS) -> Machine:
    """Fit on documents with a label among the rows of ``labels``: of each class those with the smallest hash of the id,
    at most ``max_docs`` and with at most ``MAX_TERMS`` terms in all (but one at least). Terms of whole texts are made
    by the tasks. Null ids and labels are left out; ids labelled twice take the higher label, and an id that stands
    twice in ``docs`` counts once."""
    marks = (labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null")
             .groupBy("id").agg(F.max("y").alias("y")))
    ids = None
    for y in (0, 1):
        part = marks.where((F.col("y") > 0) == bool(y)).orderBy(F.xxhash64("id"), "id").limit(max_docs).select("id", F.lit(y).alias("y"))
        ids = part if ids is None else ids.unionByName(part)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    rows = rows.join(F.broadcast(ids), "id")  # at most 2 * max_docs ids

    def scan(batches):
        hasher = SpanHasher()
        for whole in batches:
            for batch in slices(whole, "txt"):
                text, term = distinct(*terms(*flat(batch.column("txt")), hasher))
                cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
                found = [term[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(found, pa.binary())], names=["id", "y", "x"])

    kind = rows.schema["id"].dataType.simpleString()
    found = stage(rows.mapInArrow(scan, f"id {kind}, y int, x binary").groupBy("id").agg(F.max("y").alias("y"), F.min("x").alias("x")), "terms")
    w = Window.partitionBy("y").orderBy(F.xxhash64("id"), "id")  # at most max_docs rows a class
    size = found.select("id", "y", (F.octet_length("x") / 4).alias("n"))
    some = size.withColumn("upto", F.sum("n").over(w)).withColumn("k", F.row_number().over(w)).where((F.col("upto") <= MAX_TERMS) | (F.col("k") == 1))
    read = found.join(F.broadcast(some.select("id")), "id").orderBy("id").select("y", "x").toArrow()
    return Machine([np.frombuffer(x.as_buffer(), np.uint32) for x in read.column("x")], read.column("y").to_numpy().astype(np.float32))


def score(docs: DataFrame, machine: Machine, text_col: str = "text", keep: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """(columns ``keep``, by default doc_id; score, predicted) for each row of ``docs``: whole texts, score 0 to 1,
    predicted 1 from ``threshold`` on. A null or empty text has no terms and gets the score of that; without both
    classes to learn from all scores are 0. Each row is answered on its own: null or repeated ids keep their rows,
    an empty table gives none, other columns do not matter."""
    keep = keep or ["doc_id"]
    names = [f"c{k}" for k in range(len(keep))]
    known = shared(docs.sparkSession, machine)

    def scan(batches):
        hasher, model = SpanHasher(), known()
        model.prepare()
        for whole in batches:
            for batch in slices(whole, "txt"):
                s = model.scores(*flat(batch.column("txt")), hasher)
                yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(s, pa.float64()), pa.array((s >= threshold).astype(np.int32))], names=[*names, "score", "predicted"])

    cur = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("txt"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cur.schema.fields[:-1])
    out = cur.mapInArrow(scan, f"{kinds}score double, predicted int")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "score", "predicted")


def held_out(id_col: str = "doc_id"):
    """Rows that no label is learnt from: crc32 of the id as text leaves 1 by 3; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))
