"""Bytes to text by media type, and the tagging of the parsed documents."""

from __future__ import annotations

import io
import json
import zipfile
from collections.abc import Iterator, Mapping, Sequence
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.markup import decode_text, html_text
from ..functions.metadata import (
    DOC_TYPE_KEYWORDS, DOCX, HTML, JSON, PDF, best_type, document_id, type_scores, type_text,
)
from .language import Profiles, detect_language

_W = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"


class _Pairs(list):
    """A parsed JSON object as its (name, value) pairs; of a repeated name the last value counts, at the first place."""

    @classmethod
    def read(cls, pairs):
        return cls(dict(pairs).items())


def _layout(root) -> str:
    """One line per scalar, indented by two blanks for each object it lies in; arrays don't indent.

    A named object or array opens with a line of its name; empty ones leave an empty line. The parts still to be written
    wait on a stack, so that nesting costs no recursion.
    """
    lines: list[str] = []
    waiting = [(0, None, root)]
    while waiting:
        depth, label, value = waiting.pop()
        inside = isinstance(value, list)
        if label is not None or not inside:
            lines.append("  " * depth + (f"{label}:" if inside else f"{label}: {value}" if label is not None else str(value)))
        if inside:
            below = depth + (label is not None)
            named = isinstance(value, _Pairs)
            if value:
                waiting.extend((below, x[0] if named else None, x[1] if named else x) for x in reversed(value))
            else:
                lines.append("")
    return "\n".join(lines)


def _json_lines(content: bytes) -> str:
    return _layout(json.loads(bytes(content).decode("utf-8", "replace"), object_pairs_hook=_Pairs.read))


def _docx_paragraphs(content: bytes) -> str:
    with zipfile.ZipFile(io.BytesIO(bytes(content))) as archive:
        body = ElementTree.fromstring(archive.read("word/document.xml")).find(f"{_W}body")
    signs = {f"{_W}tab": "\t", f"{_W}br": "\n", f"{_W}cr": "\n", f"{_W}noBreakHyphen": "-"}

    def text(paragraph) -> str:
        # Runs directly in the paragraph or in its hyperlinks; tables and boxes are not text.
        runs = [r for part in paragraph for r in ([part] if part.tag == f"{_W}r" else
                                                  part.findall(f"{_W}r") if part.tag == f"{_W}hyperlink" else [])]
        return "".join((n.text or "") if n.tag == f"{_W}t" else signs.get(n.tag, "") for r in runs for n in r).strip()

    return "\n\n".join(p for p in map(text, body.findall(f"{_W}p")) if p)


_PYTHON_PARSERS = {JSON: _json_lines, DOCX: _docx_paragraphs}


def _attempt(mime_type: str, content) -> tuple[str | None, str | None]:
    if content is None:
        return None, None
    try:
        return _PYTHON_PARSERS[mime_type](content), None
    except Exception as exc:
        return "", f"{type(exc).__name__}: {exc}"


# So many contents are parsed at once: of a whole Arrow batch, contents and texts would fill a worker's memory.
PARSED_ROWS = 128


@F.arrow_udf(T.StructType().add("text", "string").add("error", "string"))
def _python_text(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for kinds, contents in batches:
        # An empty batch gives an empty one.
        for lo in range(0, max(1, len(kinds)), PARSED_ROWS):
            part = slice(lo, lo + PARSED_ROWS)
            found = [_attempt(k, c) for k, c in zip(kinds[part].to_pylist(), contents[part].to_pylist())]
            yield pa.StructArray.from_arrays([pa.array([x[i] for x in found], pa.string()) for i in (0, 1)], names=["text", "error"])


def json_text(content: Column) -> Column:
    """JSON as ``key: value`` lines in source order: struct(text, error)."""
    return _python_text(F.lit(JSON), content)


def docx_text(content: Column) -> Column:
    """Body paragraphs of a word-processing file: struct(text, error)."""
    return _python_text(F.lit(DOCX), content)


def extract_text(raw: DataFrame, content: str = "content", mime: str = "mime_type") -> DataFrame:
    """Replace ``content`` by ``text`` and ``parse_error``.

    The rows are read once: HTML and text stay in the JVM, of the contents only those of the two formats that need Python
    go there. A failed or unsupported document keeps an empty text and carries its reason.
    """
    body, kind = F.col(content), F.col(mime)
    keep = [c for c in raw.columns if c != content]
    python_only = F.coalesce(kind.isin(*_PYTHON_PARSERS), F.lit(False))
    # Decoding and the pattern rules accept any bytes, so a native document has no error.
    text = F.when(kind == PDF, "").when(kind == HTML, html_text(decode_text(body))).otherwise(decode_text(body))
    visited = raw.withColumn("_p", _python_text(kind, F.when(python_only, body)))
    return visited.select(*keep, F.when(python_only, F.col("_p.text")).otherwise(text).alias("text"),
                          F.when(python_only, F.col("_p.error")).when(kind == PDF, "unsupported_format").alias("parse_error"))


def infer_doc_type(df: DataFrame, keywords: Mapping[str, Sequence[str]] = DOC_TYPE_KEYWORDS,
                   text: str = "text", filename: str | None = "filename", scores: bool = False) -> DataFrame:
    """Add ``doc_type``; with ``scores`` also one count column per type."""
    lowered = type_text(F.col(text), F.col(filename) if filename else None)
    scored = df.withColumn("_low", lowered).withColumn("_score", type_scores(F.col("_low"), keywords))
    out = scored.withColumn("doc_type", best_type(F.col("_score"), tuple(keywords)))
    if scores:
        out = out.withColumns({f"{name}_hits": F.col("_score")[name] for name in keywords})
    return out.drop("_low", "_score")


def parse_documents(raw: DataFrame, profiles: Profiles | None = None,
                    keywords: Mapping[str, Sequence[str]] = DOC_TYPE_KEYWORDS,
                    ingest_timestamp: str | None = None) -> DataFrame:
    """The parse stage: raw documents to tagged text, one row in, one row out.

    Adds doc_id, doc_type, language, char_count and ingest_timestamp (UTC; pass a literal to
    make reruns reproduce it). Without profiles every language is ``unknown``.
    """
    stamp = F.lit(ingest_timestamp).cast("timestamp") if ingest_timestamp else F.current_timestamp()
    parsed = extract_text(raw).withColumn("doc_id", document_id(F.col("uri")))
    typed = infer_doc_type(parsed, keywords)
    spoken = (detect_language(typed, profiles) if profiles is not None
              else typed.withColumn("language", F.lit("unknown")))
    return spoken.select("doc_id", "uri", "filename", "mime_type", "doc_type", "language", "text",
                         F.char_length("text").alias("char_count"), stamp.alias("ingest_timestamp"), "parse_error")


def parse_rejects(parsed: DataFrame) -> DataFrame:
    """Parse failures and unsupported formats as reject rows."""
    return parsed.where(F.col("parse_error").isNotNull()).select(
        "uri", F.lit("parse").alias("stage"), F.col("parse_error").alias("reason"))
