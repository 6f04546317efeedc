"""Surrogates for personal data, in DataFrame functions only.

Entities are found by pattern in whole texts. Each distinct entity gets one
surrogate of its kind, derived from a keyed hash: the same entity has the same
surrogate everywhere, different entities have different ones (collisions among
surrogates, and with entities that really occur, are looked for over the whole
table and resolved), and gender, script, length and punctuation are kept. A
name is replaced part by part, so that shorter mentions of a person agree, and
a surname that a title introduces is replaced where it stands alone in the
same text. Patterns are possessive or bounded, and all work on an entity is
linear in its length.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from auric.session import stage

# fixed values: titles that precede a name, by gender
MALE = "Mr|Herr|Monsieur|Señor|господин|г-н"
FEMALE = "Mrs|Ms|Miss|Frau|Madame|Señora|госпожа|г-жа"
# fixed values: words that name a secret, and words inside names that keep their small letter
SECRETS = "password|passwd|pwd|token|secret|api[_-]?key|access[_-]?key"
PARTICLES = "von|van|de|der|den|da|di|la|le|del"

OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"
PART = r"\p{Lu}\p{L}*+(?:['’]\p{Lu}\p{L}*+)*+"
NAME = rf"(?:(?:{PARTICLES}) ){{0,3}}{PART}(?:[ -](?:(?:{PARTICLES}) ){{0,3}}{PART}){{0,5}}"
#: A value after a secret's name runs to white space or a quote: eight characters with a digit, in quotes or right after
#: an equals sign, else twelve.
SECRET = r"(?:(?=[^\s\"'<>]{0,63}[0-9])[^\s\"'<>]{8,}+|(?<=[=\"'])(?=[^\s\"'<>]{0,63}\p{L})[^\s\"'<>]{8,}+|(?=[^\s\"'<>]{0,63}\p{L})[^\s\"'<>]{12,}+)"
#: Kind and pattern, in the order in which they are tried at a place. An address has at most 127 labels of 63 characters.
PATTERNS = {
    "email": r"(?<![\p{L}\p{N}._%+-])[\p{L}\p{N}._%+-]++@[\p{L}\p{N}][\p{L}\p{N}-]{0,62}+(?:\.[\p{L}\p{N}-]{1,63}+){0,125}\.\p{L}{2,63}",
    "secret": rf"(?<![A-Za-z0-9])(?i:{SECRETS})\s{{0,3}}[=:]\s{{0,3}}[\"']?{SECRET}",
    "ip": rf"(?<![0-9A-Za-z.]){OCTET}(?:\.{OCTET}){{3}}(?![0-9A-Za-z]|\.[0-9])",
    "ssn": r"(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z]|-[0-9])",
    "phone": r"(?<![0-9A-Za-z+])(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9A-Za-z])"
             r"|(?<![0-9A-Za-z+])\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9A-Za-z])"
             r"|(?<![0-9A-Za-z+.-])(?:1[ .-])?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z]|[.-][0-9])"
             r"|(?<![0-9A-Za-z+.,/-])0[1-9][0-9]{1,3}[ /-][0-9]{5,8}(?![0-9A-Za-z]|[.,/-][0-9])",
    "card": r"(?<![0-9A-Za-z.-])[0-9](?:[ -]?[0-9]){12,18}(?![0-9A-Za-z]|[.-][0-9])",
    "iban": r"(?<![0-9A-Za-z])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![0-9A-Za-z])",
    "key": r"(?<![0-9A-Za-z])(?:(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,}+)(?![0-9A-Za-z])",
    "name_m": rf"(?<!\p{{L}})(?:{MALE})\.? {NAME}",
    "name_f": rf"(?<!\p{{L}})(?:{FEMALE})\.? {NAME}",
}
#: All of them; no entity begins inside a word, which rules most places out at once.
ANY = "(?<![0-9A-Za-z])(?:" + "|".join(f"(?:{p})" for p in PATTERNS.values()) + ")"

# fixed values: syllables of surrogate names by script
LATIN = "ba be bo da de do fa ga ka la le li lo ma me mi mo na ne no ra re ri ro sa se ta te ti va ve vo"
CYRILLIC = "ба бе бо да де до фа га ка ла ле ли ло ма ме ми мо на не но ра ре ри ро са се та те ти ва ве во"
#: Rounds after which a format counts as full: too many entities for its surrogates.
MOST_ROUNDS = 24
#: Letters that a surname needs to be looked for without a title.
LEAST_SURNAME = 3


def let(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once and not at every place where the body has it."""
    return F.transform(F.array(value), body)[0]


def literal(values: str) -> Column:
    return F.array(*[F.lit(v) for v in values.split(" ")])


def may_hold(text: Column) -> Column:
    """Whether a text has what every entity needs: a digit, an at sign, a secret's name, or a title. Cheaper than the
    patterns."""
    out = text.contains("@") | text.rlike("[0-9]") | text.rlike(rf"(?i:{SECRETS})\s{{0,3}}[=:]")
    for title in f"{MALE}|{FEMALE}".split("|"):
        out = out | text.contains(title + " ") | text.contains(title + ". ")
    return F.coalesce(out & text.rlike(ANY), F.lit(False))


def kind_of(entity: Column) -> Column:
    """The kind of a match of the patterns, by what only that kind has."""
    digits = F.length(F.regexp_replace(entity, "[^0-9]", ""))
    return (F.when(entity.rlike(rf"\A(?i:{SECRETS})\s*[=:]"), "secret").when(entity.contains("@"), "email").when(entity.rlike(rf"\A(?:{MALE})\.? "), "name_m").when(entity.rlike(rf"\A(?:{FEMALE})\.? "), "name_f")
            .when(entity.rlike(r"\A(?:AKIA|ASIA|gh[pousr]_|sk-)"), "key")
            .when(entity.rlike(r"\A[A-Z]{2}[0-9]{2}"), "iban").when(entity.rlike(r"\A[0-9]{1,3}(?:\.[0-9]{1,3}){3}\z"), "ip")
            .when(entity.rlike(r"\A[0-9]{3}-[0-9]{2}-[0-9]{4}\z"), "ssn")
            .when(entity.startswith("+") | entity.contains("(") | (digits < 13), "phone").otherwise("card"))


def lead_of(entity: Column, kind: Column) -> Column:
    """What stands before the sensitive part: the name of a secret, the title of a person."""
    return (F.when(kind == "secret", F.regexp_extract(entity, r"\A[A-Za-z_-]+\s*[=:]\s*[\"']?", 0))
            .when(kind.startswith("name"), F.regexp_extract(entity, r"\A[^ ]+ ", 0)).otherwise(""))


def core_of(part: Column, kind: Column) -> Column:
    """The identity of an entity: spelling that does not matter is left out."""
    return (F.when(kind.isin("phone", "card", "ssn"), F.regexp_replace(part, "[^0-9]", ""))
            .when(kind == "iban", F.regexp_replace(part, " ", ""))
            .when(kind.isin("email", "given_m", "given_f", "surname"), F.lower(part)).otherwise(part))


def pieces_of(part: Column, kind: Column) -> Column:
    """The parts of an entity that get surrogates of their own, as structs of what stands before a part, its kind and
    its text: of a name its given names and surnames (those after the last blank, or the only one); a particle is
    text that stays, with a null kind. Any other entity is one part."""
    words = F.regexp_extract_all(part, F.lit("[ -]?[^ -]+"), F.lit(0))
    given = F.when(kind == "name_f", "given_f").otherwise("given_m")
    return F.when(kind.startswith("name"), let(F.struct(words.alias("w"), F.size(F.split(F.substring_index(part, " ", -1), "-")).alias("last")), lambda x: F.transform(
        x["w"], lambda w, i: F.struct(F.regexp_extract(w, r"\A[ -]?", 0).alias("before"),
                                      F.when(w.rlike(r"\A[ -]?\p{Ll}"), F.lit(None).cast("string")).when(i >= F.size(x["w"]) - x["last"], "surname").otherwise(given).alias("kind"),
                                      F.regexp_replace(w, r"\A[ -]", "").alias("text"))))).otherwise(
        F.array(F.struct(F.lit("").alias("before"), kind.alias("kind"), part.alias("text"))))


def stream(key: Column, kind: Column, core: Column, attempt: Column) -> Column:
    """Keyed hash bytes of an entity as an array of numbers, at least 16 more than it has characters."""
    seed = F.concat_ws("\x1f", kind, core, attempt.cast("string"))
    blocks = let(F.sha2(seed, 256), lambda s: F.transform(F.sequence(F.lit(0), F.floor((F.length(core) + 16) / 32).cast("int")), lambda k: F.sha2(
        F.concat(key, F.lit("\x1e"), F.sha2(F.concat(key, F.lit("\x1d"), k.cast("string"), F.lit("\x1c"), s), 256)), 256)))
    return F.flatten(F.transform(blocks, lambda b: F.transform(F.sequence(F.lit(0), F.lit(31)), lambda i: F.conv(F.substring(b, i * 2 + 1, 2), 16, 10).cast("int"))))


def same_class(kind: Column, core: Column, bytes_: Column, keep: Column) -> Column:
    """The core with every letter and digit after the first ``keep`` characters replaced by one of its class."""
    pick = lambda alphabet, b: F.substring(F.lit(alphabet), b % len(alphabet) + 1, 1)
    domain = F.when(kind == "email", F.length(F.substring_index(core, ".", -1))).otherwise(0)  # the last label of an address stays
    known = F.struct(F.split(core, "").alias("chars"), bytes_.alias("bytes"), keep.cast("int").alias("keep"), (F.length(core) - domain).alias("end"),
                     core.rlike(r"\A(?=[0-9a-f]*[0-9])(?=[0-9a-f]*[a-f])[0-9a-f]+\z").alias("hex"))
    return let(known, lambda x: F.array_join(F.transform(x["chars"], lambda c, i: F.when((i < x["keep"]) | (i >= x["end"]), c)
                                             .when(c.rlike("[0-9a-f]") & x["hex"], pick("0123456789abcdef", x["bytes"][i]))
                                             .when(c.between("0", "9"), pick("0123456789", x["bytes"][i]))
                                             .when(c.between("A", "Z"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ", x["bytes"][i]))
                                             .when(c.rlike(r"\p{IsCyrillic}"), pick("абвгдежзиклмнопрстуфхцчшэюя", x["bytes"][i]))
                                             .when(c.rlike(r"\p{L}"), pick("abcdefghijklmnopqrstuvwxyz", x["bytes"][i])).otherwise(c)), ""))


def luhn(digits: Column) -> Column:
    """The Luhn sum of a digit string modulo 10 (null for other strings)."""
    digit = lambda c: c.try_cast("int")
    return F.aggregate(F.transform(F.split(F.reverse(digits), ""), lambda c, i: F.when(i % 2 == 0, digit(c))
                                   .otherwise(digit(c) * 2 - F.when(digit(c) > 4, 9).otherwise(0))), F.lit(0), lambda s, x: s + x) % 10


def surrogate(kind: Column, core: Column, bytes_: Column, mapped: Column) -> Column:
    """The surrogate core that the hash bytes give for an entity."""
    syllable = lambda values, k: literal(values)[bytes_[k] % 32]
    word = lambda values, k: F.concat(*[syllable(values, k + j) for j in range(4)])
    female = kind == "given_f"

    def person(values, a, o, n):
        given = F.concat(word(values, 0), F.when(female, syllable(values, 4)).otherwise(""), F.when(female, a).otherwise(o))
        return F.when(kind == "surname", F.concat(word(values, 8), n)).otherwise(given)

    private = F.regexp_extract(core, r"\A(?:10\.|127\.|192\.168\.|172\.(?:1[6-9]|2[0-9]|3[01])\.)", 0)
    octets = F.transform(F.sequence(F.lit(1), 4 - F.length(F.regexp_replace(private, r"[^.]", ""))), lambda i: (
        F.when((private == "") & (i == 1), bytes_[i] % 88 + 11).otherwise(bytes_[i] % 254 + 1)).cast("string"))
    check = (10 - luhn(F.concat(F.substring(mapped, F.lit(1), F.length(mapped) - 1), F.lit("0")))) % 10
    return (F.when(kind == "ip", F.concat(private, F.array_join(octets, ".")))
            .when(kind.isin("given_m", "given_f", "surname"), F.when(core.rlike(r"\p{IsCyrillic}"), person(CYRILLIC, F.lit("я"), F.lit("й"), F.lit("н")))
                  .otherwise(person(LATIN, F.lit("a"), F.lit("o"), F.lit("n"))))
            .when((kind == "card") & (luhn(core) == 0), F.concat(F.substring(mapped, F.lit(1), F.length(mapped) - 1), check.cast("string")))
            .otherwise(mapped))


def kept_of(kind: Column, core: Column) -> Column:
    """How many of a core's first characters stay: a card's network digit, a number's country, a key's form."""
    return (F.when(kind == "card", 1).when((kind == "phone") & (F.length(core) > 10), F.length(core) - 10)
            .when(kind == "iban", 2).when((kind == "key") & core.startswith("sk-"), 3).when(kind == "key", 4).otherwise(0))


def with_fresh(state: DataFrame, key: Column) -> DataFrame:
    """``state`` (kind, core, attempt) with the surrogate of that attempt. The hash and the mapped core are columns of
    their own, as they are used for every character."""
    kind, core = F.col("kind"), F.col("core")
    hashed = state.withColumn("bytes", stream(key, kind, core, F.col("attempt")))
    hashed = hashed.withColumn("mapped", same_class(kind, core, F.col("bytes"), kept_of(kind, core)))
    return hashed.withColumn("fresh", surrogate(kind, core, F.col("bytes"), F.col("mapped"))).drop("bytes", "mapped")


def rendered(part: Column, kind: Column, fresh: Column) -> Column:
    """The surrogate in the spelling of one occurrence: its punctuation, its capitals."""
    place = F.aggregate(F.split(part, ""), F.struct(F.lit("").alias("t"), F.lit(0).alias("n")), lambda s, c: F.when(
        c.rlike("[0-9A-Za-z]"), F.struct(F.concat(s["t"], F.substring(fresh, s["n"] + 1, 1)).alias("t"), (s["n"] + 1).alias("n"))).otherwise(
        F.struct(F.concat(s["t"], c).alias("t"), s["n"].alias("n"))))["t"]
    capital = F.array_join(F.zip_with(F.split(part, ""), F.split(fresh, ""), lambda o, c: F.when(o.rlike(r"\p{Lu}"), F.upper(c)).otherwise(c)), "")
    return (F.when(kind.isin("phone", "card", "ssn", "iban"), place).when(kind == "email", capital)
            .when(kind.isin("given_m", "given_f", "surname"), capitalised(part, fresh)).otherwise(fresh))


def capitalised(part: Column, fresh: Column) -> Column:
    """A name's surrogate with a capital, or all in capitals as its part."""
    return F.when((F.length(part) > 1) & (part == F.upper(part)), F.upper(fresh)).otherwise(F.concat(F.upper(F.substring(fresh, 1, 1)), F.substring(fresh, 2, 99)))


def shuffle_partitions(df: DataFrame) -> int:
    """The session's number of shuffle partitions, for small rows that take much work: AQE would join them to few."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def assign(entities: DataFrame, key: Column) -> DataFrame:
    """(kind, core, fresh) of distinct (kind, core): surrogates that differ from each other and from all real cores.

    An entity that shares its surrogate with one that has it by right of an earlier attempt (or a smaller hash), or
    whose surrogate is an entity of the table, tries the next; rounds go on until nobody does. Formats in which some
    still do after MOST_ROUNDS have too few surrogates for their entities: there the real values change places in a
    keyed order, so that each has another's."""
    real = stage(entities.select("kind", "core").distinct(), "entities")
    parts = shuffle_partitions(entities)
    state = real.withColumn("attempt", F.lit(0))
    for _ in range(MOST_ROUNDS):
        now = stage(with_fresh(state.repartition(parts, "kind", "core"), key), "surrogates")
        holder = now.groupBy("kind", "fresh").agg(F.count("*").alias("n"), F.min(F.struct("attempt", F.xxhash64("core").alias("h"), "core"))["core"].alias("holder"))
        shared = now.join(holder.where("n > 1"), ["kind", "fresh"]).where("core != holder").select("kind", "core")
        taken = now.join(real.select("kind", F.col("core").alias("fresh")), ["kind", "fresh"], "left_semi").select("kind", "core")
        moves = stage(shared.unionByName(taken).distinct(), "collisions")
        if moves.isEmpty():
            return now.select("kind", "core", "fresh")
        state = now.join(moves.withColumn("moves", F.lit(1)), ["kind", "core"], "left").select(
            "kind", "core", (F.col("attempt") + F.coalesce("moves", F.lit(0))).alias("attempt"))
    return permuted(now, moves, key)


def format_of(kind: Column, core: Column) -> Column:
    """What the surrogates of an entity have in common with it."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(core, r"\p{Lu}", "A"), r"\p{Ll}", "a"), "[0-9]", "9")
    return F.concat_ws("\x1f", kind, F.when(kind == "ip", F.regexp_extract(core, r"\A(?:10\.|127\.|192\.168\.|172\.[0-9]+\.)", 0))
                       .when(kind.isin("given_m", "given_f", "surname"), "").otherwise(F.concat(F.substring(core, F.lit(1), kept_of(kind, core)), shape)))


def permuted(now: DataFrame, stuck: DataFrame, key: Column) -> DataFrame:
    """``now`` (kind, core, fresh) with the entities of every format that ``stuck`` ones have in a ring by keyed hash,
    each with the next one's core. As many entities as a format has surrogates, at most twice, share a task."""
    full = stuck.select(format_of(F.col("kind"), F.col("core")).alias("f")).distinct()
    marked = now.withColumn("f", format_of(F.col("kind"), F.col("core")))
    ring = Window.partitionBy("f").orderBy(F.sha2(F.concat(key, F.col("core")), 256), "core")
    whole = ring.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    moved = marked.join(full, "f", "left_semi").withColumn("fresh", F.coalesce(F.lead("core").over(ring), F.first("core").over(whole)))
    return stage(marked.join(full, "f", "left_anti").unionByName(moved).select("kind", "core", "fresh"), "permuted")


def replace_pii(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with all their columns, the text with surrogates, and then ``pii_kinds`` (the kinds of the
    entities replaced, in order of their places) in place of any column of that name.

    ``key`` must not be empty; another key gives other surrogates. A null text stays null and an empty one empty, both
    without entities; texts are read whole; a text without entities is unchanged. Rows are answered one by one:
    repeated rows keep their number and get equal results; ids are not used, so null and repeated ones do no harm.
    An empty table gives no rows.

    A name is known by a title before it; its surname is then replaced in the same text wherever it stands as a word of
    its own with a capital. Only texts with entities are shuffled: their entities are looked up by a digest of the text, so copies of a text
    are looked up once."""
    if not key:
        raise ValueError("a key is needed")
    secret = F.sha2(F.lit(key), 256)
    names = [c for c in docs.columns if c != "pii_kinds"]
    cur = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("row"), F.col(text_col).alias("txt"))
    some = may_hold(F.col("txt"))
    held = cur.where(some).withColumn("k", F.md5("txt"))
    found = held.select("k", F.regexp_extract_all("txt", F.lit(ANY), F.lit(0)).alias("all")).groupBy("k").agg(F.min("all").alias("all"))
    parts = found.select("k", F.posexplode("all").alias("n", "entity")).repartition(shuffle_partitions(docs), "k", "n")
    parts = parts.withColumn("kind", kind_of(F.col("entity")))
    parts = parts.withColumn("lead", lead_of(F.col("entity"), F.col("kind")))
    parts = parts.withColumn("part", F.substring("entity", F.length("lead") + 1, F.length("entity")))
    parts = parts.select("k", "n", F.col("kind").alias("entity"), "lead", F.posexplode(pieces_of(F.col("part"), F.col("kind"))).alias("m", "p"))
    parts = parts.select("k", "n", "m", "entity", F.when(F.col("m") == 0, F.col("lead")).otherwise("").alias("lead"), "p.before", "p.kind", F.col("p.text").alias("part"))
    parts = stage(parts.withColumn("core", core_of(F.col("part"), F.col("kind"))), "parts")
    fresh = assign(parts.where("kind is not null"), secret)
    new = F.coalesce(rendered(F.col("part"), F.col("kind"), F.col("fresh")), F.col("part"))  # a particle stays
    surname = F.when((F.col("kind") == "surname") & (F.length("core") >= LEAST_SURNAME), F.struct("core", F.col("fresh").alias("fresh")))
    told = parts.join(fresh, ["kind", "core"], "left").select("k", "n", "entity", surname.alias("s"), F.struct("m", F.concat("lead", "before", new).alias("t")).alias("x"))
    each = told.groupBy("k", "n").agg(F.first("entity").alias("kind"), F.array_join(F.sort_array(F.collect_list("x"))["t"], "").alias("new"), F.collect_set("s").alias("s"))
    lists = each.groupBy("k").agg(F.sort_array(F.collect_list(F.struct("n", "kind", "new"))).alias("x"), F.map_from_entries(F.array_distinct(F.flatten(F.collect_list("s")))).alias("surnames"))
    # the surnames of a text where they stand alone: its words, looked up
    names_of = lambda p: F.when(F.size("surnames") > 0, F.array_join(F.transform(F.split(p, r"(?<=\P{L})(?=\p{Lu})|(?<=\p{L})(?=\P{L})"), lambda w: F.when(
        w.rlike(r"\A\p{Lu}"), F.coalesce(capitalised(w, F.try_element_at(F.col("surnames"), F.lower(w))), w)).otherwise(w)), "")).otherwise(p)
    pieces = F.split(F.col("txt"), ANY, -1)
    new = F.array_join(F.transform(pieces, lambda p, i: F.concat(names_of(p), F.coalesce(F.get(F.col("x")["new"], i), F.lit("")))), "")
    changed = held.join(lists, "k", "left").select("row", new.alias("txt"), F.col("x")["kind"].alias("kinds"))
    clean = cur.where(~some).select("row", "txt", F.expr("cast(array() as array<string>)").alias("kinds"))
    return changed.unionByName(clean).select(
        *[F.col("txt").alias(c) if c == text_col else F.col("row")[c].alias(c) for c in names], F.col("kinds").alias("pii_kinds"))
