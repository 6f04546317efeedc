"""Text normalisation: every function maps ``Column -> Column`` and stays
inside whole-stage codegen (no UDF)."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accented letters and their plain forms, position by position.
ACCENTED = "áàâãäéèêëíìîïóòôõöúùûüçñÁÀÂÃÄÉÈÊËÍÌÎÏÓÒÔÕÖÚÙÛÜÇÑ"
PLAIN = "aaaaaeeeeiiiiooooouuuucnAAAAAEEEEIIIIOOOOOUUUUCN"
# Fixed value: whitespace other than single spaces, the characters of ``\\s``.
WHITESPACE_RUN = r"\s\s|[\t\n\x0B\f\r]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_text(c) -> Column:
    """Collapse every whitespace run to one space, trim, empty → NULL.

    The regexp runs first so a leading tab or newline is removed too, but not
    over texts that it would leave as they are."""
    c = _c(c)
    return F.nullif(F.trim(F.when(c.rlike(WHITESPACE_RUN), F.regexp_replace(c, r"\s+", " ")).otherwise(c)), F.lit(""))


def is_blank(c) -> Column:
    """Whether ``clean_text`` gives NULL: absent, or nothing but whitespace."""
    return _c(c).isNull() | ~_c(c).rlike(r"\S")


def unaccent(c) -> Column:
    return F.translate(_c(c), ACCENTED, PLAIN)


def comparison_key(c) -> Column:
    """Clean, strip accents, lower-case: the key domain spellings are compared on."""
    return F.lower(unaccent(clean_text(c)))


def text_concat(title, description) -> Column:
    """Searchable text ``"title. description"``; the title alone when there
    is no description."""
    t, d = _c(title), _c(description)
    return F.when(d.isNotNull() & (d != ""), F.concat_ws(". ", t, d)).otherwise(t)


def normalize_tags(arr) -> Column:
    """lower + trim every element, drop empties and NULLs, keep order."""
    trimmed = F.transform(_c(arr), lambda x: F.lower(F.trim(x)))
    return F.filter(trimmed, lambda x: x.isNotNull() & (x != ""))


def missing_fields(record_cols: dict[str, Column] | list[str]) -> Column:
    """Comma-separated names of required fields that are absent or blank,
    in declared order; NULL when all are present."""
    if isinstance(record_cols, list):
        record_cols = {n: F.col(n) for n in record_cols}
    if not record_cols:
        return F.lit(None).cast("string")
    blank = {n: is_blank(c) for n, c in record_cols.items()}
    names = F.array_compact(F.array(*[F.when(b, F.lit(n)) for n, b in blank.items()]))
    return F.when(reduce(or_, blank.values()), F.array_join(names, ", "))  # names are put together for few records


def was_corrected(pairs: list[tuple[Column, Column]]) -> Column:
    """True when any raw value was present and its trimmed text differs from
    the final typed value."""
    conds = [
        raw.isNotNull() & ~F.trim(raw).eqNullSafe(final.cast("string"))
        for raw, final in pairs
    ]
    out = conds[0]
    for c in conds[1:]:
        out = out | c
    return out
