"""Decoding of bytes, HTML and flat JSON text with built-in functions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from .strings import let, strip, unix_lines

# Elements whose whole content is invisible.
DROPPED_ELEMENTS = ("script", "style", "head", "noscript")

# A control character HTML text cannot hold stands for "a tag was here".
_MARK = "\x01"
# An open comment, script or style runs to the end; an open head ends where the body or its first element begins.
_IN_HEAD = "base|link|meta|title|style|script|noscript|template|head"
_BODY = f"<(?!(?:{_IN_HEAD})\\b)[a-z]"
_ENDS = {"head": f"(?:</head\\s*>|(?={_BODY})|\\z)", "script": "(?:</script\\s*>|\\z)", "style": "(?:</style\\s*>|\\z)",
         "noscript": "(?:</noscript\\s*>|\\z)"}
_INVISIBLE = "|".join(
    ["<!--(?s:.*?)(?:-->|\\z)"]
    + [f"<{tag}\\b[^>]*>(?s:.*?){_ENDS[tag]}" for tag in DROPPED_ELEMENTS]
    + ["<[!?][^>]*>",
       "</?[a-z](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>",
       "</?[a-z][^>]*>"]
)
# Names are those of HTML 4 and need their semicolon; numbers end where their digits end.
_ENTITY = "&(?:#[0-9]{1,7}(?![0-9])|#[xX][0-9a-fA-F]{1,6}(?![0-9a-fA-F])|[a-zA-Z][a-zA-Z0-9]*(?=;));?"


def decode_text(content: Column) -> Column:
    """UTF-8 if the bytes are valid, else Latin-1, which always is."""
    return F.coalesce(F.try_validate_utf8(content.cast("string")), F.decode(content, "ISO-8859-1"))


def _code_point(number: Column) -> Column:
    utf32 = F.unhex(F.lpad(F.hex(number), 8, "0"))
    ok = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(ok, F.decode(utf32, "UTF-32")).otherwise("\ufffd")


def _decode_entity(entity: Column) -> Column:
    body = F.substring(entity, 2, 9)
    body = F.substring_index(body, ";", 1)
    common = (F.when(entity == "&amp;", "&").when(entity == "&lt;", "<").when(entity == "&gt;", ">")
              .when(entity == "&quot;", '"').when(entity == "&nbsp;", "\xa0"))
    numeric = F.when(body.rlike("^#[xX]"), F.conv(F.substring(body, 3, 7), 16, 10)).otherwise(F.substring(body, 2, 8))
    table = F.create_map(*[F.lit(x) for name, code in {**name2codepoint, "apos": 39}.items() for x in (name, chr(code))])
    return (common.when(body.startswith("#"), _code_point(numeric.cast("bigint")))
            .otherwise(F.coalesce(F.try_element_at(table, body), entity)))


def decode_entities(text: Column) -> Column:
    """Character references become characters, each exactly once."""
    def decoded(t: Column) -> Column:
        refs = F.regexp_extract_all(t, F.lit(_ENTITY), F.lit(0))
        return F.array_join(F.zip_with(F.split(t, _ENTITY), F.transform(refs, _decode_entity),
                                       lambda gap, ref: F.concat(gap, F.coalesce(ref, F.lit("")))), "")

    return let(text, lambda t: F.when(F.contains(t, F.lit("&")), decoded(t)).otherwise(t))


def html_text(markup: Column) -> Column:
    """Visible text: one line break where tags part two texts, lines stripped, one blank line at most."""
    marked = F.regexp_replace(markup, f"(?i){_INVISIBLE}", _MARK)
    text = decode_entities(F.regexp_replace(marked, f"{_MARK}+", "\n"))
    lines = F.array_join(F.transform(F.split(let(text, unix_lines), "\n"), strip), "\n")
    return strip(F.regexp_replace(lines, "\n{3,}", "\n\n"))
