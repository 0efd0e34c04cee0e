"""HTML character references, decoded with built-in functions only.

A text is split at its ampersands; each part but the first may begin with a reference. Names are looked
up in a constant table (the one of the HTML standard, as Python's library has it), dealt over small maps
by the name's checksum, since a map is searched from its beginning. Numbers become characters by way
of their UTF-32 bytes.
"""

from __future__ import annotations

import json
import zlib
from html.entities import html5

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let

_MAPS = 512
#: What may be a name: up to 32 characters and a semicolon.
_NAME = r"\A[^\t\n\f <&#;]{1,32};?"
#: Names that count without a semicolon too, and before other characters; the longest first.
_BARE = rf"\A(?:{'|'.join(sorted((n for n in html5 if n[-1] != ';'), key=lambda n: (-len(n), n)))})"
_NUMBER = r"\A#(?:[0-9]+|[xX][0-9a-fA-F]+);?"
#: What the numbers 128 to 159 stand for, which is taken as Windows-1252; five of them have no character there.
_WINDOWS = "".join(chr(n) if n in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else bytes([n]).decode("cp1252") for n in range(0x80, 0xA0))


def _tables() -> str:
    maps: list[dict[str, str]] = [{} for _ in range(_MAPS)]
    for name, plain in html5.items():
        maps[zlib.crc32(name.encode()) % _MAPS][name] = plain
    return json.dumps(maps)


_JSON = _tables()


def _named(name: Column) -> Column:
    """What a name stands for, or null."""
    at = (F.crc32(name.cast("binary")) % _MAPS + 1).cast("int")
    return F.try_element_at(F.element_at(F.from_json(F.lit(_JSON), "array<map<string,string>>"), at), name)


def _character(code: Column) -> Column:
    """The character with this number; empty for those that HTML forbids, U+FFFD for what is no character."""
    windows = code.between(0x80, 0x9F)
    plain = F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), 0xFFFD).otherwise(code)
    forbidden = code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF) | (code.bitwiseAND(0xFFFE) == 0xFFFE) & (code <= 0x10FFFF)
    return F.when(windows, F.substr(F.lit(_WINDOWS), (code - 0x7F).cast("int"), F.lit(1))).when(forbidden, "").otherwise(F.decode(F.unhex(F.lpad(F.hex(plain.cast("long")), 8, "0")), "UTF-32"))


def _numbered(reference: Column) -> Column:
    """The character of `#123;` or `#x1F;`."""
    hexed = F.lower(F.substr(reference, F.lit(2), F.lit(1))) == "x"
    digits = F.regexp_extract(reference, r"\A#[xX]?0*([0-9a-fA-F]*)", 1)
    code = F.when(F.length(digits) > 8, 0x110000).when(digits == "", 0).otherwise(F.conv(F.when(hexed, digits).otherwise(F.conv(digits, 10, 16)), 16, 10).cast("long"))
    return let(code.cast("long"), _character)


def _part(part: Column) -> Column:
    """What stands after an ampersand, with that and its reference replaced."""
    number, name = F.regexp_extract(part, _NUMBER, 0), F.regexp_extract(part, _NAME, 0)

    def from_name(n: Column) -> Column:
        bare = F.regexp_extract(n, _BARE, 0)
        return F.coalesce(F.concat(_named(n), F.substr(part, F.length(n) + 1)), let(bare, lambda b: F.when(b != "", F.concat(_named(b), F.substr(part, F.length(b) + 1)))), F.concat(F.lit("&"), part))

    return F.when(number != "", F.concat(_numbered(number), F.substr(part, F.length(number) + 1))).otherwise(let(name, from_name))


def decode_entities(text: Column) -> Column:
    """All HTML character references, as a browser reads them in text. Null stays null; texts without an ampersand are left alone."""

    def parts(found: Column) -> Column:
        return F.concat(F.get(found, F.lit(0)), F.array_join(F.transform(F.slice(found, F.lit(2), F.greatest(F.size(found) - 1, F.lit(0))), _part), ""))

    return F.when(F.contains(text, F.lit("&")), let(F.split(text, "&", -1), parts)).otherwise(text)
