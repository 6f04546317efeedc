"""Language identification by hierarchical discrimination.

The family of a text's language is predicted first (one linear support vector
machine per family against the rest), then the languages of that family are
told apart by one machine per pair, which vote. Features are the relative
frequencies of hashed byte n-grams of the whole text.
"""

from __future__ import annotations

import pickle
import unicodedata
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.arrowtext import bounded_batches, flat, shared, slices

#: Documents that the machines are fitted on, over all languages.
MAX_DOCS = 4000
BUCKETS, ORDERS, ROWS = 4096, 3, 512
#: Bytes of text that n-grams are counted of at a time.
CHUNK = 1 << 20
#: Features reach the task that fits the machines as 16-bit numbers, multiplied by this.
WIDE = 256.0
#: Parts that a language's documents are ranked in first.
PARTS = 64
STEPS, PENALTY = 200, 1e-3

# fixed values: language codes by family
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk be pl cs sk bg mk sr hr bs sl",
    "baltic": "lt lv",
    "uralic": "fi et hu",
    "turkic": "tr az kk uz ky tk",
    "celtic": "ga gd cy br",
    "indic": "hi bn mr ne gu pa ur si",
    "iranian": "fa ps ku tg",
    "semitic": "ar he am mt",
    "sinitic": "zh yue wuu",
    "dravidian": "ta te kn ml",
    "austronesian": "id ms tl jv",
}


def family(lang: str) -> str:
    """The family of a language value; a value not listed is a family of its own."""
    code = lang.lower().replace("_", "-").split("-")[0]
    return next((f for f, codes in FAMILIES.items() if code in codes.split()), f"other:{lang}")


def letters_table() -> np.ndarray:
    """Bytes with letters in lower case, all other ASCII a blank, non-ASCII as it is."""
    table = np.full(256, 32, np.uint8)
    table[97:123] = table[65:91] = np.arange(97, 123)
    table[128:] = np.arange(128, 256)
    return table


def frequencies(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A row per text: relative frequencies of its byte n-grams by bucket, for each order of n-gram alike."""
    n = len(offsets) - 1
    counts = np.zeros(n * BUCKETS, np.float32)
    table = letters_table()
    for a in range(0, len(data), CHUNK):  # the n-grams that begin in the chunk
        seen = table[data[a: a + CHUNK + ORDERS - 1]].astype(np.uint32)
        text = np.searchsorted(offsets, np.arange(a, a + len(seen)), "right") - 1
        code, own = np.zeros(len(seen), np.uint32), min(CHUNK, len(data) - a)
        for order in range(1, ORDERS + 1):
            last = min(own, len(seen) - order + 1)
            code = code[:last] * np.uint32(0x01000193) + seen[order - 1: order - 1 + last] + np.uint32(order)
            inside = text[order - 1: order - 1 + last] == text[:last]
            bucket = (code * np.uint32(0x9E3779B1)) >> np.uint32(20)
            counts += np.bincount((text[:last] * BUCKETS + bucket)[inside], minlength=n * BUCKETS).astype(np.float32)
    out = counts.reshape(n, BUCKETS)
    return out / np.maximum(out.sum(1, keepdims=True), 1)


def has_letters(data: bytes) -> bool:
    """Whether the UTF-8 text has a character of a letter category."""
    if any(65 <= b <= 90 or 97 <= b <= 122 for b in data[:64]):
        return True
    return any(unicodedata.category(c)[0] == "L" for c in data.decode("utf-8"))


def fit_machine(blocks: list[np.ndarray], labels: list[np.ndarray]) -> tuple[np.ndarray, float]:
    """Weights and offset of a linear support vector machine (squared hinge loss, classes weighted alike) by
    accelerated gradient steps. The rows stand in blocks, which are views; labels are +1 or -1."""
    up, down = (max(sum(int((y * sign > 0).sum()) for y in labels), 1) for sign in (1, -1))
    weights = [np.where(y > 0, 0.5 / up, 0.5 / down).astype(np.float32) for y in labels]
    width = blocks[0].shape[1]
    w, b = np.zeros(width, np.float32), 0.0
    u, c = w.copy(), b
    bound = 2 * sum(float(np.sum(v * (np.einsum("ij,ij->i", x, x) + 1))) for x, v in zip(blocks, weights)) + PENALTY
    for k in range(STEPS):
        slack = [np.maximum(0, 1 - y * (x @ u + c)) * v * y for x, y, v in zip(blocks, labels, weights)]
        grad = sum(x.T @ s for x, s in zip(blocks, slack))
        nw, nb = u - (PENALTY * u - 2 * grad) / bound, c + 2 * sum(float(s.sum()) for s in slack) / bound
        m = k / (k + 3)
        u, c = nw + m * (nw - w), nb + m * (nb - b)
        w, b = nw, nb
    return w, b


class Model:
    """Machines of the two levels; all are columns of one matrix."""

    def __init__(self, x: np.ndarray, langs: list[str]):
        self.langs = sorted(set(langs))
        self.families: dict = {}
        for lang in self.langs:
            self.families.setdefault(family(lang), []).append(lang)
        self.names = sorted(self.families)
        order = sorted(range(len(langs)), key=lambda k: langs[k])  # a language's rows stand together
        z = x[order].astype(np.float32)
        self.mean = z.mean(0) if len(z) else np.zeros(BUCKETS, np.float32)
        self.scale = np.maximum(z.std(0), 1e-4 * WIDE) if len(z) else np.ones(BUCKETS, np.float32)
        z -= self.mean
        z /= self.scale * np.float32(np.sqrt(BUCKETS))
        first, block = 0, {}
        for lang in self.langs:
            n = langs.count(lang)
            block[lang] = z[first: first + n]
            first += n

        def machine(up, down):
            rows = [*((block[v], 1) for v in up), *((block[v], -1) for v in down)]
            return fit_machine([r for r, _ in rows], [np.full(len(r), sign, np.float32) for r, sign in rows])

        machines = []
        if len(self.names) > 1:
            machines = [machine(self.families[f], [v for v in self.langs if v not in self.families[f]]) for f in self.names]
        self.pairs = [p for f in self.names for p in combinations(self.families[f], 2)]
        machines += [machine([a], [b]) for a, b in self.pairs]
        self.weights = np.stack([w for w, _ in machines], 1) if machines else np.zeros((BUCKETS, 0), np.float32)
        self.offset = np.array([b for _, b in machines], np.float32)

    @classmethod
    def restored(cls, fields: dict) -> Model:
        """A model from the ``vars`` of one that was fitted elsewhere."""
        out = cls.__new__(cls)
        vars(out).update(fields)
        return out

    def predict(self, x: np.ndarray) -> tuple[list, np.ndarray]:
        """(language, score from 0 to 1) of each row."""
        margins = ((x * np.float32(WIDE) - self.mean) / (self.scale * np.float32(np.sqrt(BUCKETS)))) @ self.weights + self.offset
        sure = 1 / (1 + np.exp(-2 * np.clip(margins.astype(np.float64), -30, 30)))
        levels = len(self.names) if len(self.names) > 1 else 0
        out, score = [], np.ones(len(x))
        for k in range(len(x)):
            f = self.names[int(np.argmax(margins[k, :levels]))] if levels else self.names[0]
            if levels:
                score[k] = sure[k, self.names.index(f)]
            votes = dict.fromkeys(self.families[f], 0.0)
            for j, (a, b) in enumerate(self.pairs):
                if a in votes:
                    votes[a if margins[k, levels + j] >= 0 else b] += 1 + 1e-3 * abs(sure[k, levels + j] - 0.5)
            best = max(sorted(votes), key=votes.get)
            own = [sure[k, levels + j] if a == best else 1 - sure[k, levels + j] for j, (a, b) in enumerate(self.pairs) if best in (a, b)]
            score[k] *= min(own, default=1.0)
            out.append(best)
        return out, score


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", max_docs: int = MAX_DOCS) -> Model | None:
    """Fit on ``docs``, whose rows are those to learn from: a sample of at most ``max_docs`` documents, shared evenly
    among the languages (those with the smallest hash of the id). Features of whole texts are made by the tasks,
    the machines are fitted by one task; rows with a null id, language or text are not learnt from; None without a labelled row."""
    bounded_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("txt")).dropna()
    langs = rows.select("lang").distinct().count()
    if not langs:
        return None
    # the first of each part of a language, then of the parts together, so that no task gets all of one language
    ids = rows.select("id", "lang", F.xxhash64("id").alias("h")).withColumn("part", F.pmod("h", F.lit(PARTS)))
    most = max(1, max_docs // langs)
    for by in (("lang", "part"), ("lang",)):
        w = Window.partitionBy(*by).orderBy("h", "id")
        ids = ids.withColumn("k", F.row_number().over(w)).where(F.col("k") <= most).drop("k")
    ids = ids.select("id", "lang").distinct()

    def scan(batches):
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                for batch in slices(whole.slice(k, ROWS), "txt"):
                    x = frequencies(*flat(batch.column("txt")))
                    yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("lang"), pa.array([r.tobytes() for r in (x * WIDE).astype(np.float16)], pa.binary())], names=["id", "lang", "x"])

    def learn(found):
        found = found.sort_by([("id", "ascending"), ("lang", "ascending")])
        x = np.frombuffer(b"".join(v.as_buffer() for v in found.column("x")), np.float16).reshape(-1, BUCKETS)
        return pa.table({"model": pa.array([pickle.dumps(vars(Model(x, found.column("lang").to_pylist())))], pa.binary())})

    kind = rows.schema["id"].dataType.simpleString()
    found = (rows.join(F.broadcast(ids), ["id", "lang"]).mapInArrow(scan, f"id {kind}, lang string, x binary")
             .groupBy("id", "lang").agg(F.min("x").alias("x")))
    # 8 KB a document go to one task; the driver gets the machines alone
    got = found.withColumn("all", F.lit(1)).groupBy("all").applyInArrow(learn, "model binary").first()
    return Model.restored(pickle.loads(got["model"])) if got else None


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """(columns ``keep``, by default doc_id; lang_pred, score) for each row of ``docs``.

    ``und`` with score 0 if the text is null or has no letters, or if there is no model; texts are read whole. Each
    row is answered on its own, so null or repeated ids keep their rows; an empty table gives none; other columns do
    not matter."""
    keep = keep or ["doc_id"]
    names = [f"c{k}" for k in range(len(keep))]
    bounded_batches(docs.sparkSession)
    known = shared(docs.sparkSession, model)

    def scan(batches):
        fitted = known()
        for whole in batches:
            for k in range(0, whole.num_rows, ROWS):
                for batch in slices(whole.slice(k, ROWS), "txt"):
                    data, offsets = flat(batch.column("txt"))
                    raw = data.tobytes()
                    lettered = [has_letters(raw[a:b]) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
                    langs, score = ["und"] * len(lettered), np.zeros(len(lettered))
                    if fitted is not None and any(lettered):
                        got, sure = fitted.predict(frequencies(data, offsets))
                        langs = [v if on else "und" for v, on in zip(got, lettered)]
                        score = np.where(lettered, sure, 0.0)
                    yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in names], pa.array(langs, pa.string()), pa.array(score, pa.float64())], names=[*names, "lang_pred", "score"])

    cur = docs.select(*[F.col(c).alias(n) for c, n in zip(keep, names)], F.col(text_col).alias("txt"))
    kinds = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in cur.schema.fields[:-1])
    out = cur.mapInArrow(scan, f"{kinds}lang_pred string, score double")
    return out.select(*[F.col(n).alias(c) for n, c in zip(names, keep)], "lang_pred", "score")


def held_out(id_col: str = "doc_id"):
    """Rows that nothing is learnt from: crc32 of the id as text leaves 2 by 4; a null id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))
