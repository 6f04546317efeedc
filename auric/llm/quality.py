"""Quality rules: an isolation forest over rule statistics of documents.

Every text is measured once (words, symbols, repeated lines and windows, and
a few shares of characters). Trees of random splits isolate rows that lie
apart after few steps; the mean path length gives the anomaly score. One
forest sees all statistics and one each sees a single statistic; the score
of each forest from which a document goes is calibrated over all labelled rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.arrowtext import SpanHasher, flat, shared, slices, word_spans
from auric.llm.intern import intern, joined, padded
from auric.session import stage

MIN_WORDS = 10
WINDOW = 5
MAX_REPEAT = 20
TREES = 128
TREE_ROWS = 256
#: Bound of the labelled documents that the forest is fitted on; thresholds use all labelled rows.
MAX_ROWS = 8192
#: The largest share of good labelled documents that one forest's threshold may lose.
MAX_LOST = 0.002
STEPS = 2000
SYMBOLS = b"#*$%&|<>"
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_upper", "n_marks", "n_digits"]
SHARES = ["chars a word", "symbols a word", "repeated lines a line", "repeated words a word", "capitals a character", "marks a word", "digits a character"]


def byte_table(*spans) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in spans:
        out[a:b + 1] = True
    return out


WORD = ~byte_table((9, 13), (32, 32))
UPPER, DIGIT = byte_table((65, 90)), byte_table((48, 57))
SYMBOL, MARK = (byte_table(*[(c, c) for c in chars]) for chars in (SYMBOLS, b"!?.,;:"))
HEAD = ~byte_table((128, 191))  # all bytes but those that continue a character


def measure(texts, hasher: SpanHasher) -> list[np.ndarray]:
    """The columns ``COUNTS`` for a string array, over whole texts; a null text is empty."""
    data, offsets = flat(texts)
    n = len(offsets) - 1
    start, end, first = word_spans(data, offsets, WORD)
    words = np.diff(first)

    def per_text(flags):
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    inside = WORD[data]
    line_start, line_end, line_first = word_spans(data, offsets, ~byte_table((10, 10)))
    filled = np.concatenate([[0], np.cumsum(inside)])
    line_text = np.repeat(np.arange(n), np.diff(line_first))
    some = filled[line_end] > filled[line_start]
    line_start, line_end, line_text = line_start[some], line_end[some], line_text[some]
    size = line_end - line_start
    _, holder = intern(padded(data), line_start, size, hasher.spans(hasher.sums(data), line_start, line_end), line_text)
    n_lines = np.bincount(line_text, minlength=n)
    distinct_lines = np.bincount(line_text[holder[holder >= 0]], minlength=n)

    buf, s, e = joined(data, start, end)
    text = np.repeat(np.arange(n), words)
    at = np.arange(max(len(s) - WINDOW + 1, 0))
    at = at[text[at] == text[at + WINDOW - 1]]
    a, b = s[at], e[at + WINDOW - 1]
    slot, holder = intern(buf, a, b - a, hasher.spans(hasher.sums(buf), a, b), text[at])
    twice = at[np.bincount(slot, minlength=len(holder))[slot] > 1]
    cover = np.zeros(len(s) + 1, np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    repeated = np.bincount(text[np.cumsum(cover[:-1]) > 0], minlength=n)
    return [words, per_text(inside & HEAD[data]), per_text(SYMBOL[data]), n_lines - distinct_lines, repeated, n_lines,
            per_text(UPPER[data]), per_text(MARK[data]), per_text(DIGIT[data])]


def shares(counts: list[np.ndarray]) -> np.ndarray:
    """A row of ``SHARES`` for each document."""
    words, chars, symbols, dup, repeat, lines, upper, marks, digits = (np.asarray(c, np.float64) for c in counts)
    w, c = np.maximum(words, 1), np.maximum(chars, 1)
    return np.stack([chars / w, symbols / w, dup / np.maximum(lines, 1), repeat / w, upper / c, marks / w, digits / c], 1)


def mean_path(n) -> np.ndarray:
    """The mean path length of an unsuccessful search among ``n`` rows."""
    n = np.asarray(n, np.float64)
    deep = 2 * (np.log(np.maximum(n - 1, 1)) + np.euler_gamma) - 2 * (n - 1) / np.maximum(n, 1)
    return np.where(n > 2, deep, np.where(n == 2, 1.0, 0.0))


class Forest:
    """Trees as arrays: feature (-1: leaf), split, children, and a leaf's path length."""

    def __init__(self, x: np.ndarray, seed: int = 12):
        rng = np.random.default_rng(seed)
        self.rows = min(TREE_ROWS, len(x))
        self.limit = int(np.ceil(np.log2(max(self.rows, 2))))
        self.trees = [self.tree(x[rng.choice(len(x), self.rows, replace=False)], rng) for _ in range(TREES)] if len(x) else []
        self.points = None
        if x.shape[1] == 1 and self.trees:  # the score is constant between two splits
            points = np.unique(np.concatenate([split[feature == 0] for feature, split, *_ in self.trees]))
            self.values = self.scores(np.append(points, np.inf)[:, None])
            self.points = points

    def tree(self, x: np.ndarray, rng) -> tuple[np.ndarray, ...]:
        feature, split, left, right, path, queue = [], [], [], [], [], [(x, 0)]
        for rows, depth in queue:  # grows while it is read
            low, high = rows.min(0), rows.max(0)
            wide = np.flatnonzero(high > low)
            if depth == self.limit or len(rows) < 2 or not len(wide):
                for column, value in ((feature, -1), (split, 0.0), (left, 0), (right, 0), (path, depth + float(mean_path(len(rows))))):
                    column.append(value)
                continue
            f = int(rng.choice(wide))
            cut = rng.uniform(low[f], high[f])
            below = rows[:, f] <= cut
            for column, value in ((feature, f), (split, cut), (left, len(queue)), (right, len(queue) + 1), (path, 0.0)):
                column.append(value)
            queue += [(rows[below], depth + 1), (rows[~below], depth + 1)]
        return np.array(feature), np.array(split), np.array(left), np.array(right), np.array(path)

    def scores(self, x: np.ndarray) -> np.ndarray:
        """0 to 1, the higher the more apart; 0 from an empty forest."""
        if not self.trees or not len(x):
            return np.zeros(len(x))
        if self.points is not None:
            return self.values[np.searchsorted(self.points, x[:, 0])]
        total, every = np.zeros(len(x)), np.arange(len(x))
        for feature, split, left, right, path in self.trees:
            node = np.zeros(len(x), np.int64)
            for _ in range(self.limit):
                f = feature[node]
                node = np.where(f < 0, node, np.where(x[every, f] <= split[node], left[node], right[node]))
            total += path[node]
        return 2.0 ** (-total / len(self.trees) / max(float(mean_path(self.rows)), 1.0))


def statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the columns ``COUNTS``, base_failed) of each row."""

    def scan(batches):
        hasher = SpanHasher()
        for whole in batches:
            for batch in slices(whole, "txt"):
                yield pa.RecordBatch.from_arrays([batch.column("id"), *[pa.array(c, pa.int64()) for c in measure(batch.column("txt"), hasher)]], names=["id", *COUNTS])

    cur = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
    kind = cur.schema["id"].dataType.simpleString()
    out = cur.mapInArrow(scan, f"id {kind}, " + ", ".join(f"{c} long" for c in COUNTS))
    return out.withColumn("base_failed", (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT * F.col("n_words")))


class Forests:
    """A forest over all statistics and one over each, by name; ``scores`` has a row for each document."""

    def __init__(self, x: np.ndarray):
        self.names = ["all statistics", *SHARES]
        self.columns = [list(range(len(SHARES))), *([k] for k in range(len(SHARES)))]
        self.forests = [Forest(x[:, c], 12 + k) for k, c in enumerate(self.columns)]

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.stack([f.scores(x[:, c]) for f, c in zip(self.forests, self.columns)], 1)


def with_scores(rows: DataFrame, forests: Forests) -> DataFrame:
    """``rows`` with ``scores``, an anomaly score from each forest."""
    known = shared(rows.sparkSession, forests)

    def scan(batches):
        forests = known()
        for batch in batches:
            s = forests.scores(shares([batch.column(c).to_numpy() for c in COUNTS]))
            lists = pa.ListArray.from_arrays(np.arange(0, s.size + 1, s.shape[1], dtype=np.int32), s.ravel())
            yield pa.RecordBatch.from_arrays([*batch.columns, lists], names=[*batch.schema.names, "scores"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(scan, f"{kinds}, scores array<double>")


def thresholds(scored: DataFrame, forests: Forests, max_lost: float = MAX_LOST) -> list[float]:
    """For each forest the score from which rows go: that which parts good from bad labelled rows best (the largest
    share of bad rows above it less the share of good ones) while at most ``max_lost`` of the good ones are above it.

    All labelled rows are counted, in ``STEPS`` steps of the score; without both classes nothing goes."""
    each = scored.select("good", F.posexplode("scores").alias("forest", "score"))
    step = F.least(F.floor(F.col("score") * STEPS), F.lit(STEPS - 1)).alias("step")
    found = each.groupBy("forest", "good", step).agg(F.count("*").alias("n")).collect()  # at most 2 * STEPS rows a forest
    above = np.zeros((len(forests.names), 2, STEPS + 1))
    for r in found:
        above[r["forest"], int(r["good"]), r["step"]] = r["n"]
    if not found or not above[0].sum(1).all():
        return [2.0] * len(forests.names)
    above = above[:, :, ::-1].cumsum(2)[:, :, ::-1] / above.sum(2, keepdims=True)
    gain = np.where(above[:, 1] <= max_lost, above[:, 0] - above[:, 1], -1)
    return [int(g.argmax()) / STEPS if g.max() > 0 else 2.0 for g in gain]


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_rows: int = MAX_ROWS, max_lost: float = MAX_LOST) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, rejected_by, kept) of each row.

    The forests are fitted on at most ``max_rows`` labelled documents that pass the base rules, those with the smallest
    hash of the id; everything else covers all rows. A document is kept if no base rule fails and no forest's score
    reaches its threshold; ``rejected_by`` names the forests whose score does. Null and empty texts have no words and
    fail. Null ids and labels are not learnt from but answered; an id labelled twice takes the higher label; repeated
    rows are answered alike; an empty table gives no rows and without labels of both classes the base rules alone
    decide. Other columns do not matter."""
    rows = stage(statistics(docs, id_col, text_col), "statistics")
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y")).where("id is not null and y is not null")
    marks = marks.groupBy("id").agg((F.max("y") > 0).alias("good"))
    known = stage(rows.where(~F.col("base_failed")).join(marks, "id"), "labelled")
    sample = known.orderBy(F.xxhash64("id"), "id").limit(max_rows).select(*COUNTS).toArrow()
    forests = Forests(shares([sample.column(c).to_numpy() for c in COUNTS]))
    limits = thresholds(with_scores(known, forests), forests, max_lost)
    over = F.array_compact(F.array(*[F.when(F.col("scores")[k] >= limit, F.lit(name)) for k, (name, limit) in enumerate(zip(forests.names, limits))]))
    out = with_scores(rows, forests).withColumn("rejected_by", over)
    kept = ~F.col("base_failed") & (F.size("rejected_by") == 0)
    return out.select(F.col("id").alias(id_col), *COUNTS[:5], "base_failed", "rejected_by", kept.alias("kept"))
