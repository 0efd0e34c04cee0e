"""SQL for what the oracles expect of text, written from Python's own tables and apart from `tidemark.functions`."""

from __future__ import annotations

import sys
from html.entities import html5

from .fixtures import literal

FOLDING = [c for c in map(chr, range(sys.maxunicode + 1)) if c.casefold() != c]


def folded(x: str) -> str:
    """Case folding: every character by the table, one after another where it becomes several."""
    one = [c for c in FOLDING if len(c.casefold()) == 1]
    several = x
    for c in FOLDING:
        if c not in one:
            several = f"replace({several}, '{c}', '{c.casefold()}')"
    whole = f"translate({several}, '{''.join(one)}', '{''.join(c.casefold() for c in one)}')"
    return f"CASE WHEN regexp_full_match({x}, '[\\x00-\\x7F]*') THEN lower({x}) ELSE {whole} END"


def unescaped(x: str) -> str:
    """HTML character references by name, with or without a semicolon, and by number."""
    names = "MAP {" + ", ".join(f"{literal(k)}: {literal(v)}" for k, v in html5.items()) + "}"
    bare = "^(" + "|".join(sorted((k for k in html5 if not k.endswith(";")), key=len, reverse=True)) + ")"
    codes = [ord(bytes([n]).decode("cp1252", "replace")) for n in range(128, 160)]
    code = f"CASE WHEN n BETWEEN 128 AND 159 THEN {codes}[n - 127] ELSE n END"
    number = lambda digits, rest: f"list_transform([{digits}], lambda n: chr(({code})::INTEGER))[1] || regexp_replace(p, '{rest}', '')"
    part = f"""CASE WHEN regexp_matches(p, '^#[0-9]') THEN {number("regexp_extract(p, '^#([0-9]+)', 1)::BIGINT", '^#[0-9]+;?')}
      WHEN regexp_matches(p, '^#[xX][0-9a-fA-F]') THEN {number("('0x' || regexp_extract(p, '^#[xX]([0-9a-fA-F]+)', 1))::BIGINT", '^#[xX][0-9a-fA-F]+;?')}
      WHEN names[regexp_extract(p, '^[^ <&#;]+;')] IS NOT NULL THEN names[regexp_extract(p, '^[^ <&#;]+;')] || regexp_replace(p, '^[^ <&#;]+;', '')
      WHEN regexp_matches(p, '{bare}') THEN names[regexp_extract(p, '{bare}')] || regexp_replace(p, '{bare}', '') ELSE '&' || p END"""
    return f"CASE WHEN contains({x}, '&') THEN (SELECT array_to_string(list_concat([s[1]], list_transform(s[2:], lambda p: {part})), '') FROM (SELECT string_split({x}, '&') AS s, {names} AS names)) ELSE {x} END"
