"""Near-duplicate documents by MinHash with tensored banding.

Table keys are pairs of small hash collections: HALVES collections of two
MinHash values on either side give HALVES * HALVES tables from 4 * HALVES
values, where independent tables would need as many values as tables times
their width. Pairs found in a table are confirmed on the full shingle sets.

Every step works on links of classes of equal sets. A bucket gives links from
each member to two of its members, not all pairs; members of buckets that
these links leave in several components are compared exactly by prefixes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from auric.llm.arrowtext import SpanHasher, bounded_batches, flat, lower_az, mix, slices, word_spans
from auric.operators.identity import connected_components
from auric.session import ensure_checkpoint_dir, stage

WORDS, PERCENT = 5, 80
#: Collections on either side; at a similarity of 0.8 a pair shares no table with probability 2e-4 at 9.
HALVES = 9
VALUES = 4 * HALVES
#: A pair goes on to the full sets if so many of its MinHash values agree; at 0.8 fewer do with probability 3e-6.
LEAST_AGREE = 17
#: Links of which so many agree are confirmed in the first round, besides the best of each class.
LIKELY = 26
#: Turns of a few pairs before all pairs of members of mixed buckets are compared that still lie across components; they
#: spare comparisons, and lose none.
TURNS = 2
SALT = np.uint64(0xA0761D6478BD642F)
#: Rows (24 bytes each) of a table that may be broadcast.
BROADCAST_ROWS = 400_000


def word_bytes() -> np.ndarray:
    table = np.ones(256, bool)
    table[32] = False
    table[9:14] = False
    return table


def shingles(data: np.ndarray, offsets: np.ndarray, words: int, hasher: SpanHasher) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of the distinct shingles, by text; a text with fewer words is one shingle, without words none."""
    data = lower_az(data)
    start, end, first = word_spans(data, offsets, word_bytes())
    word = hasher.spans(hasher.sums(data), start, end)
    count = np.diff(first)
    text = np.repeat(np.arange(len(count)), count)
    value = np.zeros(len(word), np.uint64)
    whole = np.zeros(len(word), bool)
    for k in range(words):
        at = np.arange(len(word)) + k
        inside = at < first[1:][text]
        value[inside] = mix(value[inside] * SALT + word[at[inside]] + np.uint64(k))
        whole = inside
    head = np.zeros(len(word), bool)
    head[first[:-1][(count > 0) & (count < words)]] = True  # a short text's first word has taken in the rest
    keep = whole | head
    text, value = text[keep], value[keep]
    order = np.lexsort((value, text))
    text, value = text[order], value[order]
    new = np.ones(len(value), bool)
    new[1:] = (value[1:] != value[:-1]) | (text[1:] != text[:-1])
    return text[new], value[new]


def sketches(text: np.ndarray, value: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: size of its set, two sums that tell sets apart, and VALUES 32-bit MinHash values (of non-empty sets)."""
    size = np.bincount(text, minlength=n)
    full = np.flatnonzero(size)
    cut = np.searchsorted(text, full)
    prints = np.zeros((n, 2), np.uint64)
    least = np.zeros((n, VALUES), np.uint32)
    if len(full):
        for k in range(2):
            prints[full, k] = np.add.reduceat(mix((value ^ SALT) + np.uint64(k + 1)), cut)
        low, high = (value & np.uint64(0xFFFFFFFF)).astype(np.uint32), (value >> np.uint64(32)).astype(np.uint32)
        for k in range(VALUES):
            own = mix(np.arange(3 * k, 3 * k + 3, dtype=np.uint64) + SALT).astype(np.uint32)
            x = low * (own[0] | np.uint32(1)) + high * (own[1] | np.uint32(1)) + own[2]
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            x ^= x >> np.uint32(13)
            least[full, k] = np.minimum.reduceat(x, cut)
    return size, prints, least


def table_keys(least: np.ndarray) -> np.ndarray:
    """HALVES * HALVES keys for each row of MinHash values: a pair of values from one side with a pair from the other."""
    pair = mix(least[:, 0::2].astype(np.uint64) << np.uint64(32) | least[:, 1::2])
    left, right = pair[:, :HALVES], pair[:, HALVES:]
    number = np.arange(HALVES * HALVES, dtype=np.uint64).reshape(HALVES, HALVES)
    return mix(left[:, :, None] * SALT + right[:, None, :] + number).reshape(len(least), -1)


def sketch(docs: DataFrame, id_col: str, text_col: str, words: int) -> DataFrame:
    """(id, text_hash, size, f0, f1, least) for each row."""
    kind = docs.schema[id_col].dataType.simpleString()

    def scan(batches):
        hasher = SpanHasher()
        for whole in batches:
            for batch in slices(whole, "txt"):
                size, prints, least = sketches(*shingles(*flat(batch.column("txt")), words, hasher), batch.num_rows)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), batch.column("text_hash"), pa.array(size, pa.int64()), *[pa.array(prints[:, k].view(np.int64)) for k in range(2)],
                     pa.array([r.tobytes() for r in least], pa.binary())], names=["id", "text_hash", "size", "f0", "f1", "least"])

    return docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("txt"), F.xxhash64(text_col).alias("text_hash")).mapInArrow(
        scan, f"id {kind}, text_hash long, size long, f0 long, f1 long, least binary")


def with_keys(classes: DataFrame) -> DataFrame:
    """(node, key) for every table of every class."""

    def scan(batches):
        for batch in batches:
            for k in range(0, batch.num_rows, 4096):
                part = batch.slice(k, 4096)
                least = np.frombuffer(b"".join(part.column("least").to_pylist()), np.uint32).reshape(-1, VALUES)
                node = np.repeat(part.column("node").to_numpy(), HALVES * HALVES)
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(table_keys(least).view(np.int64).ravel())], names=["node", "key"])

    return classes.select("node", "least").mapInArrow(scan, "node long, key long")


def with_agreement(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(a, b, agree) of the pairs whose sizes allow the similarity and of whose MinHash values enough agree."""
    side = classes.select("node", "size", "least")
    left = side.select(F.col("node").alias("a"), F.col("size").alias("sa"), F.col("least").alias("la"))
    right = side.select(F.col("node").alias("b"), F.col("size").alias("sb"), F.col("least").alias("lb"))
    both = pairs.join(left, "a").join(right, "b").where(
        F.expr(f"100 * least(sa, sb) >= {percent} * greatest(sa, sb)")).select("a", "b", "la", "lb")

    def scan(batches):
        for batch in batches:
            if batch.num_rows:
                la, lb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, VALUES) for c in ("la", "lb"))
                agree = (la == lb).sum(1)
                some = pa.array(agree >= LEAST_AGREE)
                yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(agree, pa.int64())], names=["a", "b", "agree"]).filter(some)

    return both.mapInArrow(scan, "a long, b long, agree long")


def full_sets(nodes: DataFrame, classes: DataFrame, docs: DataFrame, words: int) -> DataFrame:
    """(node, set) of the classes in ``nodes``, from the text of the row that stands for each. The texts stay where they
    are while the table of rows to find is of checked size; else both sides are shuffled."""
    wanted = stage(classes.join(nodes, "node", "left_semi").select("node", "id", "text_hash"), "wanted")
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted
    texts = docs.select(F.col("__id").alias("id"), F.xxhash64("__txt").alias("text_hash"), F.col("__txt").alias("txt")).join(wanted, ["id", "text_hash"])

    def scan(batches):
        hasher = SpanHasher()
        for whole in batches:
            for batch in slices(whole, "txt"):
                text, value = shingles(*flat(batch.column("txt")), words, hasher)
                cut = np.searchsorted(text, np.arange(batch.num_rows + 1))
                sets = [value[a:b].tobytes() for a, b in zip(cut[:-1], cut[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "set"])

    return stage(texts.select("node", "txt").mapInArrow(scan, "node long, set binary").groupBy("node").agg(F.min("set").alias("set")), "sets")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows (a, b, ca, cb) of ``pairs``, nodes and their components, that hold on the full shingle sets."""
    both = pairs.select("a", "b", "ca", "cb").join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a").join(
        sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")

    def compare(batches):
        for batch in batches:
            good = []
            for x, y in zip(batch.column("x"), batch.column("y")):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                common = len(np.intersect1d(x, y, assume_unique=True))
                good.append(100 * common >= percent * (len(x) + len(y) - common))
            yield batch.select(["a", "b", "ca", "cb"]).filter(pa.array(good, pa.bool_()))

    return both.mapInArrow(compare, "a long, b long, ca long, cb long")


def components(spark, links: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, comp) of every node, comp the smallest node reachable over the links (a, b)."""
    found = connected_components(spark, links.select(F.col("a").alias("src"), F.col("b").alias("dst")))
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("comp"))


def across(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs (a, b) whose ends lie in two components, with these (ca, cb)."""
    one = comp.select(F.col("node").alias("a"), F.col("comp").alias("ca"))
    two = comp.select(F.col("node").alias("b"), F.col("comp").alias("cb"))
    return pairs.join(one, "a").join(two, "b").where("ca != cb").select("a", "b", "ca", "cb")


def prefixes(nodes: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, shingle, size, k) of the rarest shingles of each of ``nodes``, k its place among the set's: of a pair at the
    similarity, each set's size - ceil(percent / 100 * size) + 1 rarest must share one (shingles ordered alike for all by
    their number of nodes)."""

    def scan(batches):
        for batch in batches:
            for node, one in zip(batch.column("node").to_pylist(), batch.column("set")):
                value = np.frombuffer(one.as_buffer(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(value), node)), pa.array(value), pa.array(np.full(len(value), len(value)))], names=["node", "shingle", "size"])

    sets = sets.join(nodes, "node", "left_semi").mapInArrow(scan, "node long, shingle long, size long")
    count = sets.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    rank = F.row_number().over(Window.partitionBy("node").orderBy("n", "shingle"))
    # a shingle of one node cannot be shared, but takes its place among the rarest
    ranked = sets.join(count, "shingle", "left").withColumn("n", F.coalesce("n", F.lit(1))).withColumn("k", rank)
    return ranked.where(F.expr(f"k <= size - ceil({percent} * size / 100) + 1 and n > 1")).select("node", "shingle", "size", "k")


def may_hold(p: str, q: str, percent: int):
    """Whether two rows of ``prefixes`` that share a shingle may belong to a pair at the similarity that lies across components."""
    return (F.col(f"{p}.comp") != F.col(f"{q}.comp")) & F.expr(f"100 * least({p}.size, {q}.size) >= {percent} * greatest({p}.size, {q}.size)") & F.expr(
        # after the first shingle that they share, at most these many can follow in both
        f"(100 + {percent}) * (1 + least({p}.size - {p}.k, {q}.size - {q}.k)) >= {percent} * ({p}.size + {q}.size)")


def pair_of(p: str, q: str) -> list:
    first = F.col(f"{p}.node") < F.col(f"{q}.node")
    either = lambda c, name: F.when(first, F.col(f"{p}.{c}")).otherwise(F.col(f"{q}.{c}")).alias(name)
    other = lambda c, name: F.when(first, F.col(f"{q}.{c}")).otherwise(F.col(f"{p}.{c}")).alias(name)
    return [either("node", "a"), other("node", "b"), either("comp", "ca"), other("comp", "cb")]


def drawn_pairs(prefix: DataFrame, percent: int, turn: int) -> DataFrame:
    """Some of the pairs of ``prefix_pairs``, fewer than two for each row of ``prefix``: of the nodes that share one of their
    rarest shingles, one for each component, each paired with the first and the next of these; other ones each turn."""
    early = F.expr("k div 8") if turn else F.col("k")
    one = F.struct(early.alias("early"), F.xxhash64("node", F.lit(turn)).alias("h"), "node", "comp", "size", "k")
    one = prefix.groupBy("shingle", "comp").agg(F.min(one).alias("p"))
    line = Window.partitionBy("shingle").orderBy("p")
    ends = one.select("p", F.lead("p").over(line).alias("next"), F.first("p").over(line).alias("first"))
    ends = ends.select("p", F.explode(F.array("next", "first")).alias("q")).where(F.col("q").isNotNull())
    return ends.where(may_hold("p", "q", percent)).select(*pair_of("p", "q")).distinct()


def prefix_pairs(prefix: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b, ca, cb) of nodes in two components that share one of their rarest shingles, the first of them early
    enough in both (``prefix``: rows of ``prefixes`` with the node's comp). This misses no link, and what edits have made
    unique rules a document out."""
    p, q = prefix.alias("p"), prefix.alias("q")
    return p.join(q, (F.col("p.shingle") == F.col("q.shingle")) & (F.col("p.node") < F.col("q.node")) & may_hold("p", "q", percent)).select(
        *pair_of("p", "q")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """(id_col, n_shingles, component_id, kept, text_hash) for each row of ``docs``; ``text_hash`` is xxhash64 of the
    text, which tells rows of one id apart.

    Documents are linked if their sets of distinct ``words``-word shingles (words between ASCII white space, A-Z in
    lower case; the whole sequence if a text has fewer words) have a Jaccard similarity of ``percent`` / 100 or more.
    ``component_id`` is the smallest id reachable over links, the own one included; ``kept`` marks that document.
    A text that is null, empty or without words has an empty set and is linked with nothing. Rows with one id and
    equal sets are one document; rows of one id with different texts are documents of their own, each in its own component.
    A row with a null id has no component (null) and is kept. Empty tables give no rows; other columns do not matter.
    Ids are integers.

    The steps: (1) a sketch per row; (2) classes of rows with equal sets; (3) the table
    keys of each class; (4) in each bucket links of all members to its smallest and largest; (5) the likely
    links and the best of each class are confirmed on full sets and joined to components; (6) the other links between
    components are confirmed, and then members of buckets that still hold several components are compared by their rarest
    shingles, which loses no link among them. All tables live in the shared checkpoint folder."""
    spark = docs.sparkSession
    ensure_checkpoint_dir(spark)
    bounded_batches(spark)
    docs = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__txt"))
    rows = stage(sketch(docs, "__id", "__txt", words).withColumn("rid", F.monotonically_increasing_id()), "sketch")
    full = rows.where("size > 0 and id is not null")
    stands = F.min(F.struct("id", "rid", "text_hash")).alias("r")
    classes = full.groupBy("size", "f0", "f1").agg(stands, F.min("least").alias("least"))
    classes = stage(classes.select("size", "f0", "f1", "least", F.col("r.rid").alias("node"), F.col("r.id").alias("id"), F.col("r.text_hash").alias("text_hash")), "classes")
    nodes = classes.select("node")
    keys = with_keys(classes)
    buckets = keys.groupBy("key").agg(F.min("node").alias("one"), F.max("node").alias("two")).where("one < two")
    members = stage(keys.join(buckets, "key"), "buckets")
    links = members.select(F.col("node").alias("a"), F.explode(F.array("one", "two")).alias("b")).where("a != b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    near = stage(with_agreement(links, classes, percent), "near")
    ends = near.select("a", "b", "agree").unionByName(near.select(F.col("b").alias("a"), F.col("a").alias("b"), "agree"))
    best = ends.groupBy("a").agg(F.max(F.struct("agree", "b"))["b"].alias("b")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    first = stage(near.where(F.col("agree") >= LIKELY).select("a", "b").unionByName(best).distinct(), "tried")
    crowded = members.groupBy("key").agg(F.count("*").alias("n")).where("n > 3").select("key")
    crowd = members.select("key", "node").join(crowded, "key")
    concerned = near.select(F.explode(F.array("a", "b")).alias("node")).unionByName(crowd.select("node")).distinct()
    sets = full_sets(concerned, classes, docs, words)
    comp = stage(components(spark, stage(confirm(first.withColumns({"ca": F.col("a"), "cb": F.col("b")}), sets, percent), "links"), nodes), "components")

    def merged(comp, pairs):
        """The components after confirming the pairs, which lie across them."""
        good = stage(confirm(pairs, sets, percent).select("ca", "cb").distinct(), "joined")
        if good.isEmpty():
            return comp
        top = connected_components(spark, good.select(F.col("ca").alias("src"), F.col("cb").alias("dst")))
        top = top.select(F.col("node").alias("comp"), "component")
        return stage(comp.join(top, "comp", "left").select("node", F.coalesce("component", "comp").alias("comp")), "components")

    rest = stage(across(near.select("a", "b").join(first, ["a", "b"], "left_anti"), comp), "rest")
    comp = merged(comp, rest)
    # buckets of more than three members may hold links between others than the two drawn
    where = crowd.join(comp, "node")
    mixed = where.groupBy("key").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo != hi").select("key")
    inside = stage(where.join(mixed, "key").select("node", "comp").distinct(), "mixed")
    tried = first.unionByName(rest.select("a", "b"))
    # a large group is first joined by few pairs a node; only what then still lies across components is compared in all pairs
    prefix = stage(prefixes(inside, sets, percent), "prefixes")
    for turn in range(TURNS):
        some = stage(drawn_pairs(prefix.join(comp, "node"), percent, turn).join(tried, ["a", "b"], "left_anti"), "next")
        if some.isEmpty():
            break
        comp, tried = merged(comp, some), tried.unionByName(some.select("a", "b"))
    comp = merged(comp, stage(prefix_pairs(prefix.join(comp, "node"), percent).join(tried, ["a", "b"], "left_anti"), "more"))
    named = classes.drop("least").join(comp, "node")
    names = named.groupBy("comp").agg(F.min("id").alias("component"))
    ids = named.join(names, "comp").select("size", "f0", "f1", F.col("component").alias("comp"))
    found = rows.drop("least", "rid").join(ids, ["size", "f0", "f1"], "left")
    own = F.when(F.col("id").isNotNull(), F.coalesce("comp", "id"))
    kind = rows.schema["id"].dataType
    return found.select(F.col("id").alias(id_col), F.col("size").alias("n_shingles"), own.cast(kind).alias("component_id"),
                        F.coalesce(F.col("id") == own, F.lit(True)).alias("kept"), "text_hash")


SQL = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[p:p + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 3))) AS p FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (SELECT x.doc_id AS a, y.doc_id AS b FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id JOIN n na ON na.doc_id = x.doc_id JOIN n nb ON nb.doc_id = y.doc_id
          GROUP BY x.doc_id, y.doc_id HAVING 100 * count(*) >= 80 * (any_value(na.n) + any_value(nb.n) - count(*))),
reach AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(reach.b) AS component_id, d.doc_id = min(reach.b) AS kept
FROM d JOIN reach ON reach.a = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
