"""Structure-aware, token-bounded chunking, one document per row.

A document is cut inside its own row with array functions: nothing is shuffled, so the work
spreads exactly as the scan does and no document, however often copied, meets another in a task.
Every chunk is a contiguous range of paragraphs or sentences, hence both packing steps turn
token counts into ``(start, end)`` ranges, in time linear in their number, and texts are joined only afterwards.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.metadata import HEADING_LINE, chunk_id, heading_of, heading_title
from ..functions.strings import (
    fallback_tokens, let, split_lines, split_paragraphs, split_sentences, strip, unix_lines,
)

MAX_TOKENS, OVERLAP_TOKENS = 512, 64
Counter = Callable[[Column], Column]


def token_counter(tokenizer: Callable[[str], int] | None = None) -> Counter:
    """Counts for an array of texts: native by default, or by a Python tokenizer per Arrow batch.

    A tokenizer failing on a text falls back to the native rule for that text.
    """
    if tokenizer is None:
        return lambda texts: F.transform(texts, fallback_tokens)

    def size(text: str) -> int:
        try:
            return tokenizer(text)
        except Exception:
            return max(1, len(text) // 4)

    @F.pandas_udf("array<int>")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda texts: [size(t) for t in texts])

    # Kept in a projection of its own: array functions cannot call Python.
    apart = count.asNondeterministic()
    return lambda texts: apart(texts)


def count_tokens(text: Column, tokenizer: Callable[[str], int] | None = None) -> Column:
    if tokenizer is None:
        return fallback_tokens(text)
    return token_counter(tokenizer)(F.array(text))[0]


def sections(text: Column) -> Column:
    """Array of (heading, body): a heading closes a body, empty bodies vanish with their heading.

    If nothing is left the whole stripped text is one section without heading.
    """
    def split_at_headings(unix: Column) -> Column:
        def pair(parts: Column) -> Column:
            # Titles are looked for only where the text was cut.
            titles = F.when(F.size(parts) > 1, F.transform(
                F.regexp_extract_all(unix, F.lit(HEADING_LINE), F.lit(0)), heading_title)).otherwise(F.array().cast("array<string>"))
            return F.zip_with(parts, F.concat(F.array(F.lit(None).cast("string")), titles),
                              lambda body, title: F.struct(title.alias("heading"), strip(body).alias("body")))
        return F.filter(let(F.split(unix, HEADING_LINE), pair), lambda s: s["body"] != "")

    whole = F.array(F.struct(F.lit(None).cast("string").alias("heading"), strip(text).alias("body")))
    return let(let(unix_lines(text), split_at_headings),
                lambda found: F.when(F.size(found) > 0, found).otherwise(whole))


# Packing -----------------------------------------------------------------------------------------

LAST, SUFFIX = "last", "suffix"


def _ranges(groups, counts, limit: int, overlap: int, carry: str) -> list[int]:
    """Greedy packing of units into ranges, as group, start, end of each one after the other.

    No range and no carry crosses groups. A full range is followed by one that starts with its last unit, if that alone
    fits the overlap (``LAST``), or with the longest run of its last units that does (``SUFFIX``).
    """
    out: list[int] = []
    start, total, grp = 0, 0, 0
    for pos, (g, n) in enumerate(zip(groups, counts)):
        if pos and (g != grp or total + n > limit):
            out += (grp, start, pos)
            first, start, total, same = start, pos, 0, g == grp
            while same and start > first and total + counts[start - 1] <= overlap:
                start -= 1
                total += counts[start]
                same = carry == SUFFIX
        total, grp = total + n, g
    if len(counts):
        out += (grp, start, len(counts))
    return out


def pack(groups: Column, counts: Column, limit: int, overlap: int, carry: str) -> Column:
    """Array of three numbers per range: group, start, end. Only the numbers visit Python; texts stay in the JVM.

    The column is not repeated where it is used, so keep it in a projection of its own.
    """
    @F.pandas_udf("array<int>")
    def ranges(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for g, n in batches:
            yield pd.Series([_ranges(a.tolist(), b.tolist(), limit, overlap, carry) for a, b in zip(g, n)], dtype=object)

    return ranges.asNondeterministic()(groups, counts)


def _each_range(ranges: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of every range as struct (grp, start, end)."""
    def one(i: Column) -> Column:
        return body(F.struct(*[F.get(ranges, 3 * i + k).alias(n) for k, n in enumerate(("grp", "start", "end"))]))

    return F.when(F.size(ranges) > 0, F.transform(F.sequence(F.lit(0), F.floor(F.size(ranges) / 3).cast("int") - 1), one))


def _join_range(texts: Column, r: Column, sep: str) -> Column:
    return F.array_join(F.slice(texts, r["start"] + 1, r["end"] - r["start"]), sep)


def _check(max_tokens: int, overlap_tokens: int) -> None:
    if not 0 <= overlap_tokens < max_tokens:
        raise ValueError("need 0 <= overlap_tokens < max_tokens")


# Rows per structural unit -------------------------------------------------------------------------

def explode_lines(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per line: ``pos``, ``line``."""
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.posexplode(split_lines(F.col(text))).alias("pos", "line"))


def explode_headings(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per line that is a heading: ``pos``, ``line``, ``heading``."""
    lines = explode_lines(df, text)
    return lines.withColumn("heading", heading_of(F.col("line"))).where(F.col("heading").isNotNull())


def explode_sections(df: DataFrame, text: str = "text") -> DataFrame:
    """One row per section: ``section_no``, ``section_heading``, ``body``."""
    keep = [c for c in df.columns if c != text]
    return (df.select(*keep, F.posexplode(sections(F.col(text))).alias("section_no", "s"))
            .select(*keep, "section_no", F.col("s.heading").alias("section_heading"), F.col("s.body").alias("body")))


def explode_paragraphs(df: DataFrame, text: str = "body") -> DataFrame:
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.posexplode(split_paragraphs(F.col(text))).alias("pos", "paragraph"))


def explode_sentences(df: DataFrame, text: str = "text") -> DataFrame:
    keep = [c for c in df.columns if c != text]
    return df.select(*keep, F.posexplode(split_sentences(F.col(text))).alias("pos", "sentence"))


def _packed_rows(df: DataFrame, units: Column, text: str, limit: int, overlap: int, carry: str, sep: str, tokenizer,
                 names: tuple[str, str] = ("pos", "packed")) -> DataFrame:
    keep = [c for c in df.columns if c != text]
    count = token_counter(tokenizer)
    staged = df.select(*keep, units.alias("_units")).select("*", count(F.col("_units")).alias("_n"))
    ranges = pack(F.transform(F.col("_units"), lambda _: F.lit(0)), F.col("_n"), limit, overlap, carry)
    return (staged.select(*keep, "_units", ranges.alias("_ranges"))
            .select(*keep, "_units", F.posexplode(_each_range(F.col("_ranges"), lambda r: r)).alias(names[0], "_r"))
            .select(*keep, names[0], _join_range(F.col("_units"), F.col("_r"), sep).alias(names[1]),
                    (F.col("_r.end") - F.col("_r.start")).alias("n_units")))


def pack_paragraphs(df: DataFrame, text: str = "body", max_tokens: int = MAX_TOKENS,
                    overlap_tokens: int = OVERLAP_TOKENS, tokenizer=None) -> DataFrame:
    """Paragraph groups of one section body: ``pos``, ``packed``, ``n_units``."""
    _check(max_tokens, overlap_tokens)
    return _packed_rows(df, split_paragraphs(F.col(text)), text, max_tokens,
                        overlap_tokens, LAST, "\n\n", tokenizer)


def pack_sentences(df: DataFrame, text: str = "text", max_tokens: int = MAX_TOKENS,
                   overlap_tokens: int = OVERLAP_TOKENS, tokenizer=None) -> DataFrame:
    """Sentence chunks of one text: ``pos``, ``packed``, ``n_units``; a single sentence is never split."""
    _check(max_tokens, overlap_tokens)
    return _packed_rows(df, split_sentences(F.col(text)), text, max_tokens,
                        overlap_tokens, SUFFIX, " ", tokenizer)


def resplit_groups(df: DataFrame, text: str = "packed", max_tokens: int = MAX_TOKENS,
                   overlap_tokens: int = OVERLAP_TOKENS, tokenizer=None) -> DataFrame:
    """A text within the limit stays one piece, a longer one is packed by sentences."""
    _check(max_tokens, overlap_tokens)
    count = token_counter(tokenizer)
    sized = df.withColumn("_size", count(F.array(text))[0])
    sentences = split_sentences(F.col(text))
    units = F.when(F.col("_size") <= max_tokens, F.array(text)).otherwise(
        let(sentences, lambda s: F.when(F.size(s) > 0, s).otherwise(F.array(text))))
    keep = [c for c in df.columns if c != text]
    out = _packed_rows(sized, units, text, max_tokens, overlap_tokens, SUFFIX, " ", tokenizer,
                       ("piece_no", "piece"))
    return out.select(*keep, "piece_no", "piece")


# Whole documents ----------------------------------------------------------------------------------

def chunk_documents(df: DataFrame, max_tokens: int = MAX_TOKENS, overlap_tokens: int = OVERLAP_TOKENS,
                    doc_id: str = "doc_id", text: str = "text", tokenizer=None) -> DataFrame:
    """Chunks of every document; blank documents give none.

    Returns chunk_id, doc_id, chunk_index (dense from 0), section_heading, chunk_text, token_count.
    """
    _check(max_tokens, overlap_tokens)
    count = token_counter(tokenizer)
    col = F.col

    paragraphs = F.flatten(F.transform(sections(col(text)), lambda sec, i: F.transform(
        split_paragraphs(sec["body"]),
        lambda p: F.struct(i.alias("grp"), sec["heading"].alias("heading"), p.alias("text")))))
    docs = (df.where(strip(col(text)) != "")
            .select(col(doc_id).alias("doc_id"), paragraphs.alias("para"))
            .select("*", count(col("para.text")).alias("n")))

    # Headings and texts become arrays of their own before ranges are cut out of them: a field of an array of structs
    # named inside an array function would be gathered anew for every range.
    groups = docs.select("doc_id", col("para.heading").alias("headings"), col("para.text").alias("texts"),
                         pack(col("para.grp"), col("n"), max_tokens, overlap_tokens, LAST).alias("ranges"))
    groups = groups.select("doc_id", _each_range(col("ranges"), lambda r: F.struct(
        F.get(col("headings"), r["start"]).alias("heading"),
        _join_range(col("texts"), r, "\n\n").alias("text"))).alias("grp"))
    groups = groups.select("*", count(col("grp.text")).alias("n"))

    def units_of(group: Column, i: Column, size: Column) -> Column:
        def unit(text_: Column) -> Column:
            return F.struct(i.alias("grp"), group["heading"].alias("heading"), text_.alias("text"))
        return F.when(size <= max_tokens, F.array(unit(group["text"]))).otherwise(
            F.transform(split_sentences(group["text"]), unit))

    sized = F.zip_with("grp", "n", lambda g, n: F.struct(g.alias("g"), n.alias("n")))
    units = groups.select("doc_id", F.flatten(F.transform(
        sized, lambda s, i: units_of(s["g"], i, s["n"]))).alias("unit"))
    units = units.select("*", count(col("unit.text")).alias("n"))
    units = units.select("doc_id", col("unit.heading").alias("headings"), col("unit.text").alias("texts"),
                         pack(col("unit.grp"), col("n"), max_tokens, overlap_tokens, SUFFIX).alias("ranges"))
    chunks = units.select("doc_id", _each_range(col("ranges"), lambda r: F.struct(
        F.get(col("headings"), r["start"]).alias("heading"),
        _join_range(col("texts"), r, " ").alias("text"))).alias("chunk"))
    chunks = chunks.select("*", count(col("chunk.text")).alias("n"))
    final = F.filter(F.zip_with("chunk", "n", lambda c, n: F.struct(
        c["heading"].alias("heading"), strip(c["text"]).alias("text"), n.alias("n"))),
        lambda c: c["text"] != "")
    rows = chunks.select("doc_id", F.posexplode(final).alias("chunk_index", "c"))
    return rows.select(chunk_id(col("doc_id"), col("chunk_index")).alias("chunk_id"), "doc_id", "chunk_index",
                       col("c.heading").alias("section_heading"), col("c.text").alias("chunk_text"),
                       col("c.n").alias("token_count"))
