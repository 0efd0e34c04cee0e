"""Scalar text functions as Column expressions.

Character classes are spelled out because the regular-expression shorthands differ between engines:
WS is the set that Python's str.strip and split use, WORD the set of letters, numbers and underscore.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .binding import let
from .entities import decode_entities
from .folding import fold

WS = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same characters one by one.
BLANKS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
NOT_WORD = r"[^\p{L}\p{N}_]+"
#: What stands in most words and lines is looked at first, spelled out: Java finds a single character of a class in a
#: table, but goes through its ranges one by one.
_PLAIN = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789_ "
NOT_IN_WORDS = rf"(?![{_PLAIN}])[^\p{{L}}\p{{N}}_ ]+"
#: What may be white space other than a plain blank.
_ODD_SPACE = "[^" + "".join(rf"\x{c:02X}" for c in (*range(0x20, 0x7F), *range(0xA1, 0x100))) + r"\x{100}-\x{24F}]"
#: Markers of a refused access.
ACCESS_MARKERS = ("sign in to confirm", "confirm you're not a bot", "confirm you are not a bot", "http error 403", "http error 429", "too many requests")

def strip(text: Column) -> Column:
    return F.btrim(text, F.lit(BLANKS))


def rstrip(text: Column) -> Column:
    return F.rtrim(text, F.lit(BLANKS))


def without_tags(text: Column) -> Column:
    """The patterns of inline timestamps, line breaks and tags."""
    found = F.regexp_replace(text, r"<\p{Nd}{1,2}:\p{Nd}{2}:\p{Nd}{2}[.]\p{Nd}{3}>", "")
    found = F.regexp_replace(found, rf"(?i)<br{WS}*/?>", "\n")
    return F.when(F.contains(text, F.lit("<")), F.regexp_replace(found, r"<[^>]+>", "")).otherwise(text)


def squeeze(text: Column) -> Column:
    """Which spaces become one, and what goes with a line's end."""
    text = F.replace(F.replace(text, F.lit(" "), F.lit(" ")), F.lit("​"), F.lit(""))
    blanks = lambda x: F.when(F.contains(x, F.lit("  ")) | F.contains(x, F.lit("\t")), F.regexp_replace(x, r"[ \t]+", " ")).otherwise(x)
    ends = lambda x: F.when(F.contains(x, F.lit("\n")), F.regexp_replace(x, rf"{WS}*\n{WS}*", " ")).otherwise(x)
    return strip(let(let(text, blanks), ends))


def clean_caption_text(text: Column) -> Column:
    """Inline timestamps and tags out, line breaks and all HTML character references decoded, white space squeezed. Null stays null."""
    return squeeze(let(let(text, without_tags), decode_entities))


def tokens(text: Column) -> Column:
    return F.filter(F.split(text, f"{WS}+", -1), lambda t: t != "")


def token_keys(line: Column) -> Column:
    """The keys of all tokens of a line: what each has of letters, numbers and underscores, case-folded. A token without any has an empty key.

    One pass over the line, not one for each token; what parts the tokens stays.
    """
    keys = lambda x: F.split(let(F.regexp_replace(x, NOT_IN_WORDS, ""), fold), " ", -1)
    odd = F.contains(line, F.lit("  ")) | line.rlike(_ODD_SPACE)
    return let(F.trim(F.when(odd, F.regexp_replace(line, f"{WS}+", " ")).otherwise(line)), lambda x: F.when(x == "", F.array().cast("array<string>")).otherwise(keys(x)))


def classify_failure(message: Column) -> Column:
    found = let(fold(F.coalesce(message, F.lit(""))), lambda folded: F.exists(F.array(*map(F.lit, ACCESS_MARKERS)), lambda m: F.contains(folded, m)))
    return F.when(found, "access_blocked").otherwise("error")


def split_error(raw: Column) -> Column:
    """struct(status, error) of `status::detail`; any other text is an error as a whole. The last 2000 characters stay."""
    at = F.instr(raw, "::")
    head = F.when(at > 0, F.substr(raw, F.lit(1), at - 1)).otherwise(raw)
    known = head.isin("access_blocked", "error")
    detail = F.when(known, F.when(at > 0, F.substr(raw, at + 2)).otherwise("")).otherwise(raw)
    return F.struct(F.when(known, head).otherwise("error").alias("status"), F.right(detail, F.lit(2000)).alias("error"))


def normalized_transcript(text: Column) -> Column:
    return F.concat(rstrip(text), F.lit("\n"))


def sha256_text(text: Column) -> Column:
    return F.sha2(text, 256)


def tool_version(code: Column, stdout: Column, name: str | None = None) -> Column:
    """The version that a tool printed: all of it, or the word after `name` on the first line; else `unknown`."""
    if name is None:
        return F.when(code == 0, strip(stdout)).otherwise("unknown")
    words = tokens(F.get(F.split(stdout, "\r\n|\r|\n", -1), F.lit(0)))
    return F.coalesce(F.when((code == 0) & (F.size(words) >= 2) & (fold(F.get(words, F.lit(0))) == name), F.get(words, F.lit(1))), F.lit("unknown"))
