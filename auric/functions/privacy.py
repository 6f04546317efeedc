"""Privacy operators as pure Column expressions (JVM side, no UDF).

HMAC-SHA256 is composed from ``sha2`` over binary concatenation: the key
pads are computed once on the driver (a 64-byte constant each) and enter the
plan as literals.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from auric.functions.text import _c

BLOCK = 64  # SHA-256 block size in bytes

# Fixed patterns: e-mail and Brazilian phone numbers in free text (ASCII
# classes, so every engine reads them the same way).
EMAIL_IN_TEXT = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_IN_TEXT = r"\(?[0-9]{2}\)?\s?9?[0-9]{4}-?[0-9]{4}"
# For the leak scan: a number that stands alone (not inside a hash or an id), and CPF as written in documents.
PHONE_ALONE = r"(?:^|[^0-9A-Za-z])\(?[0-9]{2}\)?[ ]?9?[0-9]{4}-[0-9]{4}(?:[^0-9A-Za-z]|$)"
CPF_IN_TEXT = r"(?:^|[^0-9])[0-9]{3}\.[0-9]{3}\.[0-9]{3}-[0-9]{2}(?:[^0-9]|$)"
EMAIL_FORMAT = r"^[^@\s]+@[^@\s]+\.[^@\s]+$"
CPF_FORMAT = r"^[0-9]{11}$"


def hmac_pads(key: str) -> tuple[str, str]:
    k = key.encode("utf-8")
    if len(k) > BLOCK:
        import hashlib

        k = hashlib.sha256(k).digest()
    k = k.ljust(BLOCK, b"\0")
    ipad = bytes(b ^ 0x36 for b in k).hex()
    opad = bytes(b ^ 0x5C for b in k).hex()
    return ipad, opad


def pseudonym(c, key: str) -> Column:
    """hex(HMAC-SHA256(value, key)); NULL in → NULL out."""
    ipad, opad = hmac_pads(key)
    v = _c(c).cast("string")
    inner = F.unhex(F.sha2(F.concat(F.unhex(F.lit(ipad)), F.encode(v, "UTF-8")), 256))
    return F.sha2(F.concat(F.unhex(F.lit(opad)), inner), 256)


def salted_hash(c, salt: str) -> Column:
    """hex(SHA-256(salt ‖ value)); NULL-strict."""
    return F.sha2(F.concat(F.lit(salt), _c(c).cast("string")), 256)


def mask_email(c) -> Column:
    """'ana.souza@x.example' → 'a***@x.example'; NULL when there is no '@'."""
    e = _c(c)
    domain = F.nullif(F.regexp_extract(e, "@.*$", 0), F.lit(""))
    return F.concat(F.left(e, F.lit(1)), F.lit("***"), domain)


def mask_name(c) -> Column:
    """'Ana Paula Souza' → 'Ana S***'; a single name 'Ana' → 'A***'."""
    n = F.trim(_c(c))
    first = F.split_part(n, F.lit(" "), F.lit(1))
    last = F.regexp_extract(n, r"(\S+)$", 1)
    return (
        F.when(n.rlike(r"\s"), F.concat(first, F.lit(" "), F.left(last, F.lit(1)), F.lit("***")))
        .otherwise(F.concat(F.left(n, F.lit(1)), F.lit("***")))
    )


def anonymize_text(c) -> Column:
    """E-mails → '[email]', then phone numbers → '[telefone]'."""
    return F.regexp_replace(F.regexp_replace(_c(c), EMAIL_IN_TEXT, "[email]"), PHONE_IN_TEXT, "[telefone]")


def digits_only(c) -> Column:
    return F.regexp_replace(_c(c), "[^0-9]", "")


def has_pii(c) -> Column:
    """Row text still holding an e-mail address, a phone number or a CPF; each pattern is tried only where a character
    stands that it needs."""
    t = _c(c)
    return ((t.contains("@") & t.rlike(r"(?<![A-Za-z0-9._%+-])" + EMAIL_IN_TEXT.replace("]+@", "]++@", 1)))
            | (t.contains("-") & (t.rlike(PHONE_ALONE) | (t.contains(".") & t.rlike(CPF_IN_TEXT)))))
