"""Strict parsers: return NULL rather than raise (ANSI mode stays on)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auric.functions.text import _c

INT_PATTERN = r"^-?[0-9]{1,9}(\.0+)?$"
NUMBER_PATTERN = r"^-?[0-9]{1,12}(\.[0-9]+)?$"
ISO_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
SLASH_YMD = r"^[0-9]{4}/[0-9]{2}/[0-9]{2}$"
SLASH_DMY = r"^[0-9]{2}/[0-9]{2}/[0-9]{4}$"
ISO_TS = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[T ][0-9]{2}:[0-9]{2}:[0-9]{2}$"


def strict_int(c) -> Column:
    """'7', ' 7 ', '7.0', '-45' convert; '7.9', 'abc', '1e3' do not."""
    t = F.trim(_c(c).cast("string"))
    # most have no decimal point, and are not split
    return F.when(t.rlike(INT_PATTERN), F.coalesce(t.try_cast("int"), F.split_part(t, F.lit("."), F.lit(1)).cast("int")))


def number(c) -> Column:
    """Plain decimal literal → double; anything else NULL (no nan/inf)."""
    t = F.trim(_c(c).cast("string"))
    return F.when(t.rlike(NUMBER_PATTERN), F.try_to_number(t, F.lit("9" * 12 + "." + "9" * 12)))


def number_double(c) -> Column:
    t = F.trim(_c(c).cast("string"))
    return F.when(t.rlike(NUMBER_PATTERN), t.try_cast("double"))


def parse_date(c) -> Column:
    """Dates written ``yyyy-MM-dd``, ``dd/MM/yyyy`` or ``yyyy/MM/dd``;
    a day that does not exist (31/09) gives NULL."""
    t = F.trim(_c(c))
    return (
        F.when(t.rlike(ISO_DATE), F.try_to_date(t, "yyyy-MM-dd"))
        .when(t.rlike(SLASH_YMD), F.try_to_date(t, "yyyy/MM/dd"))
        .when(t.rlike(SLASH_DMY), F.try_to_date(t, "dd/MM/yyyy"))
    )


def parse_ts(c) -> Column:
    """ISO timestamp with seconds, ``T`` or space separator → timestamp_ntz."""
    t = F.trim(_c(c))
    return F.when(t.rlike(ISO_TS) & ~t.startswith("0000"), t.try_cast("timestamp_ntz"))  # there is no year 0


def json_list(c) -> Column:
    """A JSON array of strings, or NULL for anything else (object, scalar,
    broken text)."""
    v = F.try_parse_json(_c(c))
    is_array = F.schema_of_variant(v).startswith("ARRAY")
    return F.when(is_array, F.from_json(_c(c), "array<string>"))
