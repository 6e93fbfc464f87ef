"""String helpers that keep parsing inside Catalyst expressions (no UDFs).

The text inputs follow JVM conventions: ``String.trim`` strips every char
<= U+0020, ``Integer.parseInt`` rejects blanks and decimals, and
``Double.parseDouble`` trims first.  Spark's own ``trim`` and casts are
looser or stricter in places, so these wrappers pin the behaviour.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# every char <= U+0020, the set the JVM's String.trim removes
_JVM_BLANKS = "".join(chr(code) for code in range(0x21))
# \z, not $: a final line end is not part of a number
_INT_TEXT = r"^[+-]?[0-9]+\z"
_DOUBLE_TEXT = r"^[+-]?(NaN|Infinity|([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?[fFdD]?)\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def jvm_trim(c: Column | str) -> Column:
    """Trim all control characters and blanks from both ends (JVM ``trim``)."""
    return F.trim(_col(c), F.lit(_JVM_BLANKS))


def strict_int(c: Column | str) -> Column:
    """Digits only (optional sign), within int range; anything else is null."""
    c = _col(c)
    return F.when(c.rlike(_INT_TEXT), c.try_cast("int"))


def strict_long(c: Column | str) -> Column:
    c = _col(c)
    return F.when(c.rlike(_INT_TEXT), c.try_cast("bigint"))


def jvm_double(c: Column | str) -> Column:
    """Decimal text after a JVM trim; a bad number is null instead of an error."""
    s = jvm_trim(c)
    return F.when(s.rlike(_DOUBLE_TEXT), s.try_cast("double"))


def field(parts: Column, index: int) -> Column:
    """0-based element of a ``split`` result, null when missing."""
    return F.get(parts, index)


def split_literal(c: Column | str, sep: str) -> Column:
    """Split on a literal separator (the separator is regex-quoted)."""
    return F.split(_col(c), quote_literal(sep))


def quote_literal(sep: str) -> str:
    special = set(r"\^$.|?*+()[]{}")
    return "".join("\\" + ch if ch in special else ch for ch in sep)


def payload_after(c: Column | str, marker: str) -> Column:
    """Text between the first and the second occurrence of ``marker``.

    Matches taking element 1 of a split on the marker: a second marker
    ends the payload.  Null when the marker is absent.
    """
    c = _col(c)
    return F.when(
        F.instr(c, marker) > 0,
        F.split_part(c, F.lit(marker), F.lit(2)),
    )
