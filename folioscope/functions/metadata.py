"""Per-document metadata: media type, document type, headings and keys."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .strings import LINE_WS, UPPER, WS, extension, strip

# Media types by extension.
EXTENSION_MIME = {
    ".pdf": "application/pdf",
    ".docx": "application/vnd.openxmlformats-officedocument.wordprocessingml.document",
    ".txt": "text/plain",
    ".md": "text/markdown",
    ".html": "text/html",
    ".htm": "text/html",
    ".json": "application/json",
}
PDF, DOCX, PLAIN, MARKDOWN, HTML, _, JSON = EXTENSION_MIME.values()

# Keywords per document type; a tie goes to the type named first.
DOC_TYPE_KEYWORDS = {
    "cv": [
        "curriculum", "vitae", "cv", "resumo profissional", "experiência profissional",
        "habilitações", "competências", "skills", "education", "work experience",
        "professional experience",
    ],
    "proposta": [
        "proposta", "proposal", "orçamento", "budget", "solução proposta",
        "proposta técnica", "escopo", "scope of work", "deliverables",
    ],
    "contrato": [
        "contrato", "contract", "acordo", "agreement", "cláusula", "clause",
        "partes contratantes", "contraente", "rescisão", "termination",
    ],
    "relatorio": [
        "relatório", "report", "sumário executivo", "executive summary",
        "conclusões", "conclusions", "análise", "analysis", "resultados",
        "findings",
    ],
}
TYPE_WINDOW = 4000


def detect_mime(filename: Column, hint: Column | None = None) -> Column:
    """The hint if it is exactly a supported type, else by extension, else plain text."""
    ext = extension(filename)
    by_ext = reduce(lambda acc, kv: acc.when(ext == kv[0], kv[1]),
                    EXTENSION_MIME.items(), F.when(ext.isNull(), PLAIN)).otherwise(PLAIN)
    if hint is None:
        return by_ext
    return F.when(hint.isin(*set(EXTENSION_MIME.values())), hint).otherwise(by_ext)


# So many texts are scored at once: those of a whole Arrow batch would wait in a worker.
SCORED_ROWS = 128


def type_scores(text: Column, keywords: Mapping[str, Sequence[str]] = DOC_TYPE_KEYWORDS) -> Column:
    """Struct with one count per document type: of the non-overlapping occurrences of each of its keywords.

    Counted in Python, whose search skips through a text; built-in functions compare a keyword at every byte.
    """
    words = {name: [kw.lower() for kw in listed] for name, listed in keywords.items()}

    @F.arrow_udf(T.StructType([T.StructField(name, T.IntegerType()) for name in words]))
    def scores(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            # An empty batch gives an empty one.
            for lo in range(0, max(1, len(batch)), SCORED_ROWS):
                texts = batch[lo:lo + SCORED_ROWS].to_pylist()
                hits = [pa.array([None if t is None else sum(map(t.count, listed)) for t in texts], pa.int32()) for listed in words.values()]
                yield pa.StructArray.from_arrays(hits, names=list(words))

    return scores(text)


def type_text(text: Column, filename: Column | None = None) -> Column:
    """The lower-cased text that keywords are counted in."""
    head = F.substring(text, 1, TYPE_WINDOW)
    return F.lower(F.concat(F.lit("") if filename is None else filename, F.lit(" "), head))


def best_type(scores: Column, names: Sequence[str] = tuple(DOC_TYPE_KEYWORDS)) -> Column:
    """Highest score wins, the earlier name on a tie, ``unknown`` without any hit."""
    top = F.greatest(*[scores[n] for n in names]) if len(names) > 1 else scores[names[0]]
    pick = F.when(top == 0, "unknown")
    for name in names:
        pick = pick.when(scores[name] == top, name)
    return pick


# One line is a heading if it is a hash heading, a numbered title or a capitals-only title.
# The line may carry outer blanks; lengths are those of the stripped line.
_HASH = f"#{{1,6}}+{LINE_WS}++[^\\n]++"
_NUMBERED = (f"\\p{{Nd}}++(?:\\.\\p{{Nd}}++)*+\\.?+{LINE_WS}++"
             f"[{UPPER}][^\\n]{{2,79}}(?!{LINE_WS})[^\\n]{LINE_WS}*+")
_CAPITALS = (f"(?=[{UPPER}]++{LINE_WS}++[{UPPER}])"
             f"[{UPPER}](?:[{UPPER}]|{LINE_WS}){{1,78}}[{UPPER}]{LINE_WS}*+")
HEADING_LINE = f"(?md)^{LINE_WS}*+(?:{_HASH}|{_NUMBERED}|{_CAPITALS})$"


def heading_title(line: Column) -> Column:
    """Title of a line already known to be a heading."""
    return F.regexp_replace(strip(line), f"^#{{1,6}}{WS}+", "")


def heading_of(line: Column) -> Column:
    """Title if the line is a heading, else NULL."""
    bare = strip(line)
    return F.when(bare.rlike(HEADING_LINE), heading_title(bare))


def document_id(uri: Column) -> Column:
    return F.sha2(uri, 256)


def chunk_id(doc_id: Column, chunk_index: Column) -> Column:
    return F.sha2(F.concat_ws(":", doc_id.cast("string"), chunk_index.cast("string")), 256)
