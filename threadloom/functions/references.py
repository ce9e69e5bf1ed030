"""Character references of HTML, each decoded once.

The names come from the standard's table, as Python's library carries it
(``html.entities.html5``): 2,231 names, of which some hundred also count
without their semicolon. A text is split at its references once; every piece
is looked up by its longest name, so what a reference yields is never read again.
"""

from __future__ import annotations

import functools
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

_SLOTS = 256
# the '=' tells an attribute's "&copy=1" from a reference
PIECES = r"&#[xX][0-9a-fA-F]+;?|&#[0-9]+;?|&[A-Za-z][A-Za-z0-9]*[;=]?|[^&]+|&"


def bare_names() -> list[str]:
    """Names that count without a semicolon, longest first."""
    return sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


# no name or value has these signs: a slot's entries begin with the first, their values with the second, slots end with the third
_ENTRY, _VALUE, _SLOT = "\x01", "\x02", "\x03"


@functools.cache
def _table() -> str:
    """Names and values in slots by the names' CRC-32, so that a look-up searches one slot only."""
    slots = [_ENTRY] * _SLOTS
    for name, value in html5.items():
        slots[zlib.crc32(name.encode()) % _SLOTS] += f"{name}{_VALUE}{value}{_ENTRY}"
    return _SLOT.join(slots)


def _named(name: Column) -> Column:
    slots = F.split(F.lit(_table()), _SLOT)  # folded into one constant
    slot = F.get(slots, (F.crc32(F.encode(name, "UTF-8")) % _SLOTS).cast("int"))
    key = F.concat(F.lit(_ENTRY), name, F.lit(_VALUE))
    found = F.split_part(F.split_part(slot, key, F.lit(2)), F.lit(_ENTRY), F.lit(1))
    return F.nullif(found, F.lit(""))


def _numeric(piece: Column) -> Column:
    """Decimal and hexadecimal references: impossible code points become U+FFFD, C1 codes what Windows-1252 has there."""
    is_hex = piece.rlike("^&#[xX]")
    digits = F.regexp_extract(piece, "^&#[xX]?0*([0-9a-fA-F]*);?$", 1)
    hexadecimal = F.when(F.length(digits) > 7, F.lit("110000")).when(is_hex, digits).otherwise(F.conv(digits, 10, 16))
    code = F.conv(hexadecimal, 16, 10).try_cast("long")
    ok = (F.length(digits) > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    # Windows-1252 in the places of the C1 controls (five stay controls)
    windows = F.array(*[F.lit(bytes([b]).decode("cp1252", "ignore") or chr(b)) for b in range(0x80, 0xA0)])
    char = F.decode(F.unhex(F.lpad(hexadecimal, 8, "0")), "UTF-32")
    return F.when(~ok, F.lit("�")).when(code.between(0x80, 0x9F), F.get(windows, (code - 0x80).cast("int"))).otherwise(char)


def decode_references(text: Column, attribute: bool = False) -> Column:
    """``text`` with its character references decoded, each once; what is no reference stays as written.

    A name without its semicolon counts by its longest known beginning; in an
    ``attribute`` value only if no letter, digit or ``=`` follows it. Null stays null.
    """
    bare = "^(" + "|".join(bare_names()) + ")"

    def one(piece: Column) -> Column:
        name = F.substr(piece, F.lit(2))
        known = F.regexp_extract(name, bare, 1)
        rest = F.substr(name, F.length(known) + 1)
        begins = (known != "") & (rest == "") if attribute else known != ""
        named = F.coalesce(_named(name), F.when(begins, F.concat(_named(known), rest)), piece)
        return (F.when(~piece.startswith("&") | (F.length(piece) == 1), piece).when(piece.startswith("&#"), _numeric(piece)).otherwise(named))

    parts = F.regexp_extract_all(text, F.lit(PIECES), F.lit(0))
    return F.when(F.instr(text, "&") > 0, F.array_join(F.transform(parts, one), "")).otherwise(text)
