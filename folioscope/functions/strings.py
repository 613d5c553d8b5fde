"""Whitespace, line and token rules, written once so that all operators agree on them.

Spark's ``trim`` removes blanks only and Java's ``\\s`` is ASCII, so both sets are spelled out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The Unicode whitespace characters.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
# The characters that end a line ("\r\n" counts as one end).
LINE_ENDS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often ``body`` names it.

    Inside array functions nothing else shares a computation.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def char_class(chars: str) -> str:
    """The body of a regex character class in the syntax shared by Java and RE2."""
    return "".join(f"\\x{{{ord(c):x}}}" for c in chars)


WS = f"[{char_class(WHITESPACE)}]"
NON_WS = f"[^{char_class(WHITESPACE)}]"
LINE_WS = f"[{char_class(''.join(c for c in WHITESPACE if c not in LINE_ENDS))}]"
FOREIGN_BREAK = f"\\r\\n|[{char_class(LINE_ENDS.replace(chr(10), ''))}]"


def strip(col: Column) -> Column:
    """Remove all Unicode whitespace at both ends.

    Trimming a set of characters at the right visits the whole text: one that ends in a visible ASCII character, as its
    last byte tells, is trimmed at the left alone.
    """
    def bare(text: Column) -> Column:
        last = F.substring(text.cast("binary"), -1, 1)
        return F.when((last > F.lit(b" ")) & (last < F.lit(b"\x7f")), F.ltrim(text, F.lit(WHITESPACE))).otherwise(F.btrim(text, F.lit(WHITESPACE)))

    return let(col, bare)


def unix_lines(col: Column) -> Column:
    """Every kind of line end becomes ``\n``. Few texts have other kinds: a search for each is cheaper than the pattern."""
    foreign = reduce(Column.__or__, [F.contains(col, F.lit(c)) for c in LINE_ENDS if c != "\n"])
    return F.when(foreign, F.regexp_replace(col, FOREIGN_BREAK, "\n")).otherwise(col)


def split_lines(col: Column) -> Column:
    """Lines as an array; a line end closing the text adds no empty last line."""
    parts = F.split(unix_lines(col), "\n")
    return F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)).otherwise(parts)


def split_paragraphs(col: Column) -> Column:
    """Stripped, non-empty blocks between two or more newlines; a text without any stays whole."""
    # Most bodies have no such gap, which a search for two newlines tells without the pattern.
    parts = F.when(F.contains(col, F.lit("\n\n")), F.split(col, "\n{2,}")).otherwise(F.array(col))
    blocks = F.filter(F.transform(parts, strip), lambda p: p != "")
    return let(blocks, lambda b: F.when(F.size(b) > 0, b).otherwise(F.array(col)))


# The upper-case letters of the sentence and heading rules (there is no letter O with tilde).
UPPER = "A-ZÁÉÍÓÚÀÂÃÊÔÜÇ"
# What can't be a visible ASCII character is looked at first, then what precedes it: looking behind everywhere takes longer.
SENTENCE_GAP = f"[^!-~](?<=[.!?]{WS}){WS}*+(?=[{UPPER}\"'(])"


def split_sentences(col: Column) -> Column:
    """Stripped, non-empty pieces between a full stop and a following capital, quote or bracket.

    A gap takes all blanks between two pieces, so that only the ends of the whole text are stripped.
    """
    return F.filter(F.split(strip(col), SENTENCE_GAP), lambda s: s != "")


def fallback_tokens(col: Column) -> Column:
    """About four characters per token, one token at least."""
    return F.greatest(F.lit(1), F.floor(F.char_length(col) / 4)).cast("int")


def basename(col: Column) -> Column:
    return F.substring_index(col, "/", -1)


def extension(name: Column) -> Column:
    """Lower-cased last suffix with its dot; names of leading dots only have none."""
    return F.regexp_extract(F.lower(name), r"[^/.][^/]*?(\.[^./]*)$", 1)
