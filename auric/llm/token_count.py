"""Token counts by compiled finite-state transducers.

Two deterministic transducers replace the tokenizer:

* The splitter reads character classes and marks where a piece (a word, a
  number, a run of signs or spaces) begins. It has eleven states, so the
  effect of a chunk of text on every state is a small map; chunks are mapped
  independently, the maps are composed by a prefix scan, and a last pass from
  the known entry states sets the marks.
* The merger reads the bytes of a piece; each transition is annotated with
  the change in the number of tokens. A state holds what later merges can
  still depend on: the longest suffix that begins some token, and for each
  position in it the last token of the encoding up to there. States and
  transitions are compiled when first taken.

The merger rests on a property of merges by rank: a sequence of tokens is the
encoding of its bytes if and only if each pair of neighbours is the encoding
of its own bytes.
"""

from __future__ import annotations

import functools
import json

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auric.llm.arrowtext import flat, slices

# character classes of the splitter
QUOTE, BLANK, SPACE, LETTER, DIGIT, SIGN, ENDS, OPENS, ELL, EE, STOP = range(11)
UNKNOWN = 255
# states: nothing open; one blank; one other space; a longer run ending in a blank or in another space;
# a run of letters, digits or signs; a quote that may begin a contraction, alone or with r/v or l read
FRESH, ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE, LETTERS, DIGITS, SIGNS, MARK, MARK_OPENS, MARK_ELL = range(11)
STATES = 11
HERE, BEFORE = 1, 2  # marks: a piece begins at this character, at the one before
CHUNK = 128
#: Entries kept by a worker's tables before they are compiled anew.
MAX_PIECES, MAX_STATES = 200_000, 250_000


def splitter() -> tuple[np.ndarray, np.ndarray]:
    """Next state and marks by state * 11 + class."""
    nxt, marks = np.zeros((STATES, 11), np.uint8), np.zeros((STATES, 11), np.uint8)
    letters = (LETTER, ENDS, OPENS, ELL, EE)

    def begin(c):
        return {QUOTE: MARK, BLANK: ONE_BLANK, SPACE: ONE_SPACE, DIGIT: DIGITS, SIGN: SIGNS}.get(c, LETTERS)

    def run(c):  # the state of a run that has already begun, with a character of class c
        return SIGNS if c == QUOTE else begin(c)

    for s in range(STATES):
        for c in range(11):
            if c == STOP:  # end of a text
                nxt[s, c], marks[s, c] = FRESH, BEFORE if s in (MARK_OPENS, MARK_ELL) else 0
                continue
            spaces = c in (BLANK, SPACE)
            state, mark = begin(c), HERE
            if spaces and s in (ONE_BLANK, ONE_SPACE, RUN_BLANK, RUN_SPACE):
                state, mark = (RUN_BLANK if c == BLANK else RUN_SPACE), 0
            elif s == ONE_BLANK:
                state, mark = run(c), 0
            elif s == RUN_BLANK:
                state, mark = run(c), BEFORE
            elif s == RUN_SPACE:
                mark = HERE | BEFORE
            elif s == LETTERS and c in letters or s == DIGITS and c == DIGIT:
                mark = 0
            elif s in (SIGNS, MARK) and c in (QUOTE, SIGN):
                state, mark = SIGNS, 0
            elif s == MARK and c in (ENDS, OPENS, ELL):
                state, mark = {ENDS: FRESH, OPENS: MARK_OPENS, ELL: MARK_ELL}[c], 0
            elif s in (MARK_OPENS, MARK_ELL):
                if c == (EE if s == MARK_OPENS else ELL):
                    state, mark = FRESH, 0
                else:  # no contraction: the letter read before begins a run
                    state, mark = (LETTERS, BEFORE) if c in letters else (begin(c), BEFORE | HERE)
            nxt[s, c], marks[s, c] = state, mark
    return nxt.ravel(), marks.ravel()


class Classes:
    """Classes of characters; those beyond ASCII are taken from the library's own splitter when first seen."""

    def __init__(self):
        from tokenizers import pre_tokenizers

        self.split = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True).pre_tokenize_str
        self.table = np.full(0x110000, UNKNOWN, np.uint8)
        for c in range(128):
            self.table[c] = self.probe(chr(c))
        for text, kind in (("'", QUOTE), (" ", BLANK), ("stmd", ENDS), ("rv", OPENS), ("l", ELL), ("e", EE)):
            for c in text:
                self.table[ord(c)] = kind

    def probe(self, c: str) -> int:
        for kind, near in ((LETTER, "a"), (DIGIT, "1"), (SIGN, "!")):
            if len(self.split(near + c + near)) == 1:
                return kind
        return SPACE

    def of(self, points: np.ndarray) -> np.ndarray:
        out = self.table[points]
        if (out == UNKNOWN).any():
            for p in np.unique(points[out == UNKNOWN]).tolist():
                self.table[p] = self.probe(chr(p))
            out = self.table[points]
        return out


class Splitter:
    """Marks the beginnings of pieces in a stream of classes."""

    def __init__(self):
        self.next, self.marks = splitter()

    def begins(self, classes: np.ndarray) -> np.ndarray:
        """Flags of the positions where a piece begins; texts in ``classes`` end with STOP."""
        chunks = -(-len(classes) // CHUNK)
        grid = np.full(chunks * CHUNK, STOP, np.uint8)
        grid[: len(classes)] = classes
        grid = np.ascontiguousarray(grid.reshape(chunks, CHUNK).T)
        state = self.entries(grid)
        hits = np.zeros((CHUNK, chunks), np.uint8)
        for t in range(CHUNK):
            at = state.astype(np.int16) * 11 + grid[t]
            hits[t], state = self.marks[at], self.next[at]
        hits = hits.T.ravel()[: len(classes)]
        out = (hits & HERE) > 0
        out[:-1] |= (hits[1:] & BEFORE) > 0
        return out

    def entries(self, grid: np.ndarray) -> np.ndarray:
        """The state at the start of each chunk: maps of all states, composed by a prefix scan."""
        maps = np.repeat(np.arange(STATES, dtype=np.uint8)[None], grid.shape[1], 0)
        rows = np.arange(grid.shape[1])
        for t in range(CHUNK):
            if t % 8 == 0 and t:  # chunks where all states have met go on as one
                met = (maps[rows] == maps[rows, :1]).all(1)
                one = rows[met]
                state = maps[one, 0]
                for u in range(t, CHUNK):
                    state = self.next[state.astype(np.int16) * 11 + grid[u, one]]
                maps[one] = state[:, None]
                rows = rows[~met]
                if not len(rows):
                    break
            maps[rows] = self.next[maps[rows].astype(np.int16) * 11 + grid[t, rows, None]]
        step = 1
        while step < len(maps):
            later = maps[step:]
            maps = np.concatenate([maps[:step], np.take_along_axis(later, maps[:-step].astype(np.int64), 1)])
            step *= 2
        return np.concatenate([[FRESH], maps[:-1, FRESH]]).astype(np.uint8)


def byte_letters() -> dict[str, int]:
    """The printable stand-ins of the 256 bytes in a byte-level vocabulary file."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Merger:
    """Transducer from the bytes of a piece to its number of tokens, compiled as it is used."""

    def __init__(self, vocab: dict[str, int], merges: list):
        back = byte_letters()
        raw = {text: bytes(back[c] for c in text) for text in vocab if all(c in back for c in text)}
        self.token = {b: vocab[text] for text, b in raw.items()}
        self.bytes = {i: b for b, i in self.token.items()}
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rank = {(vocab[a], vocab[b]): (k, vocab[a + b]) for k, (a, b) in enumerate(pairs)}
        self.made = {new: (k, pair) for pair, (k, new) in self.rank.items()}
        self.spines: dict = {}
        self.sound: dict = {}
        self.starts = {b[:k] for b in self.token for k in range(1, len(b) + 1)}
        self.reset()

    def reset(self) -> None:
        self.names: dict = {}
        self.states: list = []
        self.arcs: list = []
        self.fits: dict = {}
        self.root = self.state(b"", ((-1, 0),))

    def state(self, suffix: bytes, past: tuple) -> int:
        """The number of the state; past: (last token, tokens so far less those now) at the positions of suffix, from its beginning."""
        if (suffix, past) not in self.names:
            self.names[suffix, past] = len(self.states)
            self.states.append((suffix, past))
            self.arcs.append({})
        return self.names[suffix, past]

    def encode(self, data: bytes) -> list[int]:
        """Tokens of a piece by applying the merges in order of rank."""
        ids = [self.token[data[k: k + 1]] for k in range(len(data))]
        while len(ids) > 1:
            best = min((self.rank[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.rank) if any(p in self.rank for p in zip(ids, ids[1:])) else None
            if best is None:
                break
            a, b = ids[best[1]], ids[best[1] + 1]
            out, k = [], 0
            while k < len(ids):
                if k + 1 < len(ids) and ids[k] == a and ids[k + 1] == b:
                    out.append(self.rank[a, b][1])
                    k += 2
                else:
                    out.append(ids[k])
                    k += 1
            ids = out
        return ids

    def spine(self, token: int, side: int) -> list[tuple[int, float]]:
        """(token, rank of the merge that takes it in) along the left (0) or right (1) edge of a token's merges, outermost first."""
        if (token, side) not in self.spines:
            out, t, until = [], token, float("inf")
            while t in self.made:
                out.append((t, until))
                until, pair = self.made[t]
                t = pair[side]
            self.spines[token, side] = [*out, (t, until)]
        return self.spines[token, side]

    def fit(self, a: int, b: int) -> bool:
        """Whether b can follow a in an encoding (a < 0: b begins the piece): b alone is its own encoding, and no
        merge across the border comes before the merges that take in its two sides; of equal ones the left is first."""
        if (a, b) not in self.fits:
            if b not in self.sound:
                self.sound[b] = self.encode(self.bytes[b]) == [b]
            far = (float("inf"), -1)
            self.fits[a, b] = self.sound[b] and (a < 0 or not any(
                (r := self.rank.get((x, y), far)[0]) < dx and r <= dy for x, dx in self.spine(a, 1) for y, dy in self.spine(b, 0)))
        return self.fits[a, b]

    def arc(self, state: int, byte: int) -> tuple[int, int]:
        """Compile the transition: (next state, tokens added)."""
        suffix, past = self.states[state]
        grown = suffix + bytes([byte])
        for length in range(len(grown), 0, -1):
            tail = grown[-length:]
            before, count = past[len(past) - length]
            if tail in self.token and self.fit(before, self.token[tail]):
                last, total = self.token[tail], count + 1
                break
        keep = next(k for k in range(len(grown) + 1) if grown[k:] in self.starts or k == len(grown))
        moved = tuple((t, n - total) for t, n in past[len(past) - (len(grown) - keep):]) if keep < len(grown) else ()
        got = self.state(grown[keep:], (*moved, (last, 0))), total
        self.arcs[state][byte] = got
        return got

    def count(self, piece: bytes) -> int:
        state, total = self.root, 0
        for byte in piece:
            state, added = self.arcs[state].get(byte) or self.arc(state, byte)
            total += added
        return total


class Counter:
    """Counts tokens of texts as a byte-level tokenizer file defines them."""

    def __init__(self, definition: str):
        spec = json.loads(definition)
        pre = spec["pre_tokenizer"]
        if spec["model"]["type"] != "BPE" or spec["normalizer"] or pre["type"] != "ByteLevel" or pre["add_prefix_space"] or not pre["use_regex"]:
            raise ValueError("a byte-level BPE file without normalizer and prefix space is needed")
        self.special = [t["content"].encode() for t in spec["added_tokens"] if t["content"]]
        self.merger = Merger(spec["model"]["vocab"], spec["model"]["merges"])
        self.classes, self.split, self.known = Classes(), Splitter(), {}

    def segments(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ends of the stretches between special strings (in bytes), and special strings by text."""
        raw, found = data.tobytes(), np.zeros(len(offsets) - 1, np.int64)
        cuts = []
        for special in self.special:
            at = raw.find(special)
            while at >= 0:
                text = np.searchsorted(offsets, at, "right") - 1
                if at + len(special) <= offsets[text + 1]:
                    found[text] += 1
                    cuts.append((at, at + len(special)))
                at = raw.find(special, at + len(special))
        return np.array(cuts, np.int64).reshape(-1, 2), found

    def pieces(self, data: np.ndarray, offsets: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Byte positions where pieces begin and end, special strings left out."""
        points = np.frombuffer(data.tobytes().decode("utf-8").encode("utf-32-le"), np.uint32)
        place = np.flatnonzero((data & 0xC0) != 0x80)  # byte position of each character
        classes = self.classes.of(points)
        bounds = np.unique(np.concatenate([offsets[1:], cuts.ravel()]))
        ends = np.searchsorted(place, bounds)
        stream = np.insert(classes, ends, STOP)
        begins = self.split.begins(stream)[stream != STOP]
        inner = np.zeros(len(data) + 1, bool)
        for a, b in cuts.tolist():
            inner[a:b] = True
        start = place[begins]
        stops = np.zeros(len(data) + 1, bool)
        stops[start] = stops[bounds] = True
        stop = np.flatnonzero(stops)
        end = stop[np.cumsum(stops)[start]]
        kept = ~inner[start]
        return start[kept], end[kept]

    def counts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        if not len(data):
            return np.zeros(len(offsets) - 1, np.int64)
        cuts, total = self.segments(data, offsets)
        start, end = self.pieces(data, offsets, cuts)
        raw, known = data.tobytes(), self.known
        if len(known) > MAX_PIECES:
            known.clear()
        if len(self.merger.states) > MAX_STATES:
            self.merger.reset()
        parts = [raw[a:b] for a, b in zip(start.tolist(), end.tolist())]
        for part in set(parts).difference(known):
            known[part] = self.merger.count(part)
        sums = np.zeros(len(start) + 1, np.int64)
        np.cumsum(np.fromiter(map(known.__getitem__, parts), np.int64, len(parts)), out=sums[1:])
        first = np.searchsorted(start, offsets)
        return total + sums[first[1:]] - sums[first[:-1]]


@functools.lru_cache(maxsize=1)
def counter(definition: str) -> Counter:
    """The counter of a worker process: its tables are compiled once and not by every task."""
    return Counter(definition)


def count_tokens(docs: DataFrame, tokenizer_file: str, id_col: str = "doc_id", text_col: str = "text", limit: int = 512) -> DataFrame:
    """(id_col, n_bytes, n_tokens, over_limit) for each row: whole texts, special strings inside them as one token each.

    A null text counts as empty (0 bytes, 0 tokens). Every row is answered on its own, so null or repeated ids keep
    their rows; an empty table gives none; other columns do not matter. The tokenizer file is read on the driver and
    broadcast (its size does not depend on the data). Over the limit means more than ``limit`` tokens."""
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())

    def scan(batches):
        tokens = counter(definition.value)
        for whole in batches:
            for batch in slices(whole, "txt"):
                data, offsets = flat(batch.column("txt"))
                n = tokens.counts(data, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(np.diff(offsets), pa.int64()), pa.array(n, pa.int64()), pa.array(n > limit)],
                    names=["id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema[id_col].dataType.simpleString()
    return (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"))
            .mapInArrow(scan, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean")
            .withColumnRenamed("id", id_col))
