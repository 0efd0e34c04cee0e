"""Full Unicode case folding with built-in functions only.

The table is Python's own (`str.casefold`), asked for every code point once. `lower` (with ß as ss) agrees
with it for most text; a row is folded by the table only if it has a character for which the two may differ,
so that other rows pay for one look at their characters outside ASCII.
"""

from __future__ import annotations

import sys

from pyspark.sql import Column
from pyspark.sql import functions as F

_FOLDED = {c: s for c in map(chr, range(sys.maxunicode + 1)) if (s := c.casefold()) != c}
#: Where the scripts end whose small letters have not changed for long: below it `lower` is known to fold alike, but for what it turns into other characters or by the place in a word.
_SETTLED, _SIGMA, _SHARP_S = 0x530, "Σ", "ß"
_ODD = [ord(c) for c in map(chr, range(0x80, sys.maxunicode + 1)) if c != _SHARP_S and (c == _SIGMA or c.casefold() != c.lower() or len(c.lower()) > 1 or (ord(c) >= _SETTLED and c.lower() != c))]


def _class(codes: list[int]) -> str:
    """A character class of the codes. Beyond the settled scripts small gaps are filled, and beyond the basic plane, where
    the JVM may know letters that Python doesn't know yet, all gaps: a few more rows go by the table."""
    ranges: list[list[int]] = []
    for code in codes:
        gap = 1 if code < _SETTLED else 0x80 if code <= 0xFFFF or ranges[-1][1] <= 0xFFFF else 0x10000
        if ranges and code - ranges[-1][1] <= gap:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "".join(rf"\x{{{a:X}}}-\x{{{b:X}}}" for a, b in ranges)


#: Characters outside ASCII are looked at first, since most characters are within it.
ODD = rf"(?=[^\x00-\x7F])[{_class(_ODD)}]"
_ONE = [(c, s) for c, s in _FOLDED.items() if len(s) == 1]
_FROM, _TO = "".join(c for c, _ in _ONE), "".join(s for _, s in _ONE)
_MANY = "\n".join(c + s for c, s in _FOLDED.items() if len(s) > 1)


def _by_table(text: Column) -> Column:
    """One-to-one characters by `translate`, the hundred others by replacements in turn; what a replacement makes is folded already."""
    return F.aggregate(F.split(F.lit(_MANY), "\n"), F.translate(text, _FROM, _TO), lambda made, x: F.replace(made, F.left(x, F.lit(1)), F.substr(x, F.lit(2))))


def fold(text: Column) -> Column:
    """Full case folding of the Unicode that Python knows. Null stays null."""
    odd = (F.octet_length(text) > F.length(text)) & text.rlike(ODD)
    return F.when(F.coalesce(odd, F.lit(False)), _by_table(text)).otherwise(F.replace(F.lower(text), F.lit(_SHARP_S), F.lit(_FOLDED[_SHARP_S])))
