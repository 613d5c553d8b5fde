"""Personal data in texts: one automaton finds anchors, local parsers widen each to a span and validate it."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_process, texts_of

BASE_KINDS = ("email", "ip", "card", "phone")
# Added by this method: addresses with credentials, bank accounts (check digits), accounts and secrets after a cue.
MORE_KINDS = ("url", "iban", "account", "secret")
KINDS = BASE_KINDS + MORE_KINDS

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_SCHEME = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+.-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = re.compile(r"[0-9]+")
_IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_USERINFO = re.compile(r"[^\s/@<>\"']+@[A-Za-z0-9.-]+(?::[0-9]+)?(?:/[^\s<>\"']*)?")
_IBAN = re.compile(r"[:\x20]{0,3}([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30})(?![A-Za-z0-9])")
_ACCOUNT = re.compile(r"(?:\x20(?:number|no\.?|nr\.?))?\x20?[:=#]\x20?([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])")
_SECRET = re.compile(r"\x20?[:=]\x20?[\"']?([A-Za-z0-9_/+=.-]{8,})")

# Cues in the cases in which they are written.
_CUES = {"iban": ("iban", "IBAN", "Iban"), "account": ("account", "Account", "ACCOUNT", "acct", "Acct", "konto", "Konto", "cuenta", "Cuenta", "compte", "Compte"),
         "secret": ("password", "Password", "PASSWORD", "passwd", "token", "Token", "TOKEN", "secret", "Secret", "SECRET", "api_key", "API_KEY", "apikey")}


def _automaton():
    import ahocorasick

    a = ahocorasick.Automaton()
    for d in "0123456789":
        a.add_word(d, ("digit", 1))
    a.add_word("@", ("at", 1))
    a.add_word("+", ("plus", 1))
    a.add_word("://", ("url", 3))
    for kind, cues in _CUES.items():
        for cue in cues:
            a.add_word(cue, (kind, len(cue)))
    a.make_automaton()
    return a


def _luhn(digits: str) -> bool:
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(sum(divmod(2 * int(d), 10)) for d in even)) % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 4 and int(part or 0) <= 255


def _iban_ok(found: str) -> bool:
    s = found.replace(" ", "")
    return 15 <= len(s) <= 34 and int("".join(str(int(c, 36)) for c in s[4:] + s[:4])) % 97 == 1


def find_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Spans (start, end exclusive, in code points) per kind, leftmost first and without overlap within a kind."""
    out: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if not text:
        return out
    at = dict.fromkeys(KINDS, 0)  # where each kind's next span may begin
    for last, (kind, n) in per_process("pii-anchors", _automaton).iter(text):
        i = last - n + 1
        if kind == "digit":
            if i >= at["ip"]:
                m = _IP.match(text, i)
                at["ip"] = (m or _DIGITS.match(text, i)).end()
                if m and all(map(_small, m[0].split("."))):
                    out["ip"].append(m.span())
            if i >= at["card"]:
                m = _CARD.match(text, i)
                at["card"] = m.end() if m else i + 1
                if m:
                    digits = m[0].replace(" ", "").replace("-", "")
                    if 13 <= len(digits) <= 19 and _luhn(digits):
                        out["card"].append(m.span())
        elif kind == "at":
            lo, low = i, at["email"]
            while lo > low and text[lo - 1] in _LOCAL:
                lo -= 1
            m = _DOMAIN.match(text, i + 1) if lo < i else None
            if m:
                out["email"].append((lo, m.end()))
                at["email"] = m.end()
        elif kind == "plus":
            m = _PHONE.match(text, i)
            if m and 9 <= sum(map(str.isdigit, m[0])) <= 15:
                out["phone"].append(m.span())
        elif i >= at[kind]:
            if kind == "url":
                lo, low = i, max(at["url"], i - 16)
                while lo > low and text[lo - 1] in _SCHEME:
                    lo -= 1
                m = _USERINFO.match(text, last + 1) if lo < i and text[lo].isalpha() else None
                span = (lo, m.end()) if m else None
            else:
                m = {"iban": _IBAN, "account": _ACCOUNT, "secret": _SECRET}[kind].match(text, last + 1)
                good = m and (kind == "account" or (_iban_ok(m[1]) if kind == "iban" else any(map(str.isdigit, m[1]))))
                span = m.span(1) if good else None
            if span:
                out[kind].append(span)
                at[kind] = span[1]
    return out


def _written(spans: dict[str, list[tuple[int, int]]], kinds: tuple[str, ...]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k in kinds for s, e in spans[k])


def redact(text: str, spans: dict[str, list[tuple[int, int]]]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans become the first one's."""
    parts, at = [], 0
    for s, e, k in sorted((s, e, k) for k in KINDS for s, e in spans[k]):
        if s >= at:
            parts += [text[at:s], f"[{k.upper()}]"]
        at = max(at, e)
    return "".join(parts) + text[at:]


def find_pii(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, counts of the base kinds, base_sha256, spans, and counts of the further kinds. Nothing is shuffled.

    NULL texts count as empty: no spans, and the hash of an empty string. NULL keys stay NULL, repeated rows are
    searched each, an empty table gives an empty result, other columns are not read, texts are searched whole.
    """
    counts = [f"n_{k}" for k in BASE_KINDS]
    more = [f"n_{k}" for k in MORE_KINDS]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [find_spans(t) for t in texts_of(batch.column(1))]
            n = [pa.array([len(f[k]) for f in found], pa.int64()) for k in KINDS]
            base = pa.array([hashlib.sha256(_written(f, BASE_KINDS).encode()).hexdigest() for f in found], pa.string())
            spans = pa.array([_written(f, KINDS) for f in found], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column(0), *n[:4], base, spans, *n[4:]], names=[key, *counts, "base_sha256", "spans", *more])

    rows = docs.select(F.col(key), F.col(text).cast("string").alias("text"))
    schema = ", ".join([f"`{key}` {docs.schema[key].dataType.simpleString()}", *[f"{c} long" for c in counts], "base_sha256 string, spans string", *[f"{c} long" for c in more]])
    return rows.mapInArrow(run, schema)


def redact_pii(docs: DataFrame, text: str = "text", length: str | None = "n_chars") -> DataFrame:
    """The rows with every span in ``text`` replaced by its kind; ``length``, if there is such a column, follows the text.

    NULL texts stay NULL, and so does their length; empty ones stay empty; repeated rows stay repeated, NULL keys matter
    nowhere; an empty table gives an empty result; all other columns pass unchanged, whatever their names.
    """
    @F.pandas_udf("string")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield batch.map(lambda t: None if t is None else redact(t, find_spans(t)))

    out = docs.withColumn(text, clean(F.col(text).cast("string")))
    if length in docs.columns:
        out = out.withColumn(length, F.char_length(text).cast(docs.schema[length].dataType))
    return out
