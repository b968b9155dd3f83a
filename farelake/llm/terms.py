"""Lower-cased terms of letters, digits and characters beyond ASCII, in tasks and as expressions."""

from __future__ import annotations

import hashlib
import string

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What no term holds, once A-Z are lower-cased.
TERM_BREAK = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_TERM_BYTES = {*string.digits.encode(), *string.ascii_lowercase.encode(), *range(0x80, 0x100)}
_LOWERED = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: A byte of a term to itself, lower-cased, and any other to a space. Bytes beyond ASCII stay together.
_SPACED = bytes(b if b in _TERM_BYTES else 0x20 for b in _LOWERED)


def term_list(text: str | None) -> list[bytes]:
    """Terms of a text in order; none for null."""
    return (text or "").encode("utf-8").translate(_SPACED).split()


#: Bytes of a term that is kept as it is; a longer one goes by its hash where terms are many.
LONGEST = 64


def bounded(found: list[bytes]) -> list[bytes]:
    """The terms, those of more than `LONGEST` bytes by their hash, after a byte that no term holds."""
    if max(map(len, found), default=0) <= LONGEST:
        return found
    return [b"\x01" + hashlib.sha256(t).hexdigest().encode() if len(t) > LONGEST else t for t in found]


def bounded_terms(found: Column) -> Column:
    """The same as an expression."""

    def kept(term: Column) -> Column:
        return F.when(F.octet_length(term) > LONGEST, F.concat(F.lit("\x01"), F.sha2(term, 256))).otherwise(term)

    return F.transform(found, kept)


def terms(text: Column) -> Column:
    """The same as an expression: an array of strings."""
    lowered = F.translate(F.coalesce(text, F.lit("")), string.ascii_uppercase, string.ascii_lowercase)
    return F.filter(F.split(lowered, TERM_BREAK, -1), lambda t: t != "")
