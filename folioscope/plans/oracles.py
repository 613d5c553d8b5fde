"""The SQL that each registered query has to agree with, written for DuckDB.

It is built differently on purpose: structure by windows and recursion where Spark folds arrays.
"""

from __future__ import annotations

from functools import reduce

from ..functions.metadata import DOC_TYPE_KEYWORDS, EXTENSION_MIME

# Written out again, so that a wrong constant in the package shows.
WHITESPACE = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
LINE_ENDS = "\n\x0b\x0c\r\x1c\x1d\x1e\x85\u2028\u2029"
UPPER = "A-ZÁÉÍÓÚÀÂÃÊÔÜÇ"
_CLASS = lambda chars: "".join(f"\\x{{{ord(c):x}}}" for c in chars)
WS, FOREIGN_BREAK = f"[{_CLASS(WHITESPACE)}]", f"\\r\\n|[{_CLASS(LINE_ENDS[1:])}]"
_RULES = {"email": r"([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)", "date": r"([0-9]{4}-[0-9]{2}-[0-9]{2})",
          "amount": r"((?:€|EUR|USD|\$) ?[0-9]+(?:[.,][0-9]+)*)", "url": r"(https?://[^\s\"'<>]+)"}

_STAMP = "TIMESTAMP '2024-01-01 00:00:00'"


def _q(text: str) -> str:
    """A string literal; control and non-ASCII blanks by code, so that the SQL stays printable."""
    parts, plain = [], ""
    for c in text:
        if c.isprintable():
            plain += c
            continue
        if plain:
            parts.append("'" + plain.replace("'", "''") + "'")
            plain = ""
        parts.append(f"chr({ord(c)})")
    if plain or not parts:
        parts.append("'" + plain.replace("'", "''") + "'")
    return parts[0] if len(parts) == 1 else "(" + " || ".join(parts) + ")"


def _strip(x: str) -> str:
    return f"trim({x}, {_q(WHITESPACE)})"


_NL, _TAB = "chr(10)", "chr(9)"
_TOKENS = "greatest(1, length({0}) // 4)::INTEGER"
_CHUNK_KEY = "sha256({0}::VARCHAR || ':' || {1}::VARCHAR)"

# Inputs -------------------------------------------------------------------------------------------

_DOCS = "SELECT doc_id, text FROM documents"
_SECTIONED = f"""SELECT doc_id, array_to_string(list_transform(string_split(text, {_NL}), lambda x:
    CASE WHEN NOT length(x) BETWEEN 4 AND 60 THEN x WHEN length(x) % 3 = 0 THEN '## ' || x
         WHEN length(x) % 3 = 1 THEN '2.1 ' || x ELSE upper(replace(replace(replace(x, '.', ''), ',', ''), 'ß', '')) END), {_NL} || {_NL}) AS text
  FROM documents"""
_TURNS = f"SELECT conv_id, turn, '## ' || role || {_NL} || text AS text FROM conversations"
_DOCUMENT_TABLE = f"""SELECT doc_id::VARCHAR AS doc_id, 'mem://' || source || '/' || doc_id || '.txt' AS uri, doc_id || '.txt' AS filename,
    'text/plain' AS mime_type, CASE doc_id % 5 WHEN 0 THEN 'cv' WHEN 1 THEN 'contrato' ELSE 'unknown' END AS doc_type,
    lang AS language, n_chars::INTEGER AS char_count, {_STAMP} AS ingest_timestamp FROM documents"""
_LINES = f"""SELECT doc_id, source, (unnest(range(len(l))))::INTEGER AS pos, unnest(l) AS line
  FROM (SELECT doc_id, source, string_split(text, {_NL}) AS l FROM documents)"""
_LINE_CHUNKS = f"""SELECT doc_id || ':' || pos AS chunk_id, doc_id::VARCHAR AS doc_id, pos AS chunk_index,
    CASE WHEN pos % 2 = 0 THEN source END AS section_heading, line AS chunk_text, {_TOKENS.format('line')} AS token_count FROM ({_LINES})"""
_MIXED_LINES = f"array_to_string(list_transform(string_split({{0}}, {_NL}), lambda x: {_strip('x')}), {_NL})"
_MIXED = f"""SELECT 'mem://' || doc_id AS uri, doc_id::VARCHAR AS filename, doc_id,
    CASE WHEN doc_id % 40 = 39 THEN 'application/pdf' WHEN doc_id % 4 = 0 THEN 'text/plain' WHEN doc_id % 4 = 1 THEN 'text/markdown' WHEN doc_id % 4 = 2 THEN 'application/json' ELSE 'text/html' END AS mime_type,
    CASE WHEN doc_id % 40 IN (2, 39) THEN '' WHEN doc_id % 4 = 2 THEN 'text: ' || text
      WHEN doc_id % 4 = 3 THEN {_strip("regexp_replace(" + _MIXED_LINES.format('text') + f", '{chr(92)}n{{3,}}', {_NL} || {_NL}, 'g')")} ELSE text END AS text,
    CASE WHEN doc_id % 40 = 39 THEN 'unsupported_format' WHEN doc_id % 40 = 2 THEN 'JSONDecodeError: Expecting property name enclosed in double quotes: line 1 column 2 (char 1)' END AS parse_error FROM documents"""
_PAGE_PATHS = """SELECT page_id, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') AS ns,
    regexp_replace(regexp_replace('/' || regexp_replace(path, '([0-9])([0-9])([0-9])', '\\1/\\2/\\3', 'g'), '/+', '/', 'g'), '/$', '') AS path
  FROM (SELECT page_id, regexp_extract(url, '^[a-z]+://([^/?#]*)', 1) AS host, regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path FROM pages)"""
_STEPS = f"""SELECT page_id, ns, array_to_string(list_slice(parts, 1, depth + 1), '/') AS path, depth,
    CASE WHEN depth = len(parts) - 1 THEN 'f' ELSE 'd' END AS node_type
  FROM (SELECT page_id, ns, parts, unnest(range(1, len(parts))) AS depth
        FROM (SELECT page_id, ns, string_split(path, '/') AS parts FROM ({_PAGE_PATHS}) WHERE path <> ''))"""
_NODES = f"SELECT ns, path, min(node_type) AS node_type FROM ({_STEPS}) GROUP BY ns, path"
_PARENT = "regexp_replace({0}, '/[^/]*$', '')"
_NAME = "regexp_extract({0}, '[^/]*$')"
_CENTROIDS = """SELECT label AS query_id, list(x ORDER BY pos) AS v FROM (SELECT label, pos, avg(x) AS x FROM (
    SELECT label, unnest(range(64)) AS pos, unnest(embedding)::DOUBLE AS x FROM embeddings) GROUP BY label, pos) GROUP BY label"""

# Structure ----------------------------------------------------------------------------------------


def _heading(x: str) -> str:
    s = _strip(x)
    md, up = f"^#{{1,6}}{WS}+", f"[{UPPER}]"
    capitals = f"^(?:{up}|{WS}){{3,80}}$"
    return f"""CASE WHEN regexp_matches({s}, {_q(md + '[^' + chr(92) + 'n]+$')}) THEN {_strip(f"regexp_replace({s}, {_q(md)}, '')")}
      WHEN regexp_matches({s}, {_q('^' + chr(92) + 'p{Nd}+(?:' + chr(92) + '.' + chr(92) + 'p{Nd}+)*' + chr(92) + '.?' + WS + '+' + up + '[^' + chr(92) + 'n]{3,80}$')}) THEN {s}
      WHEN regexp_matches({s}, {_q(capitals)}) AND len(regexp_split_to_array({s}, {_q(WS + '+')})) >= 2 AND {s} = upper({s}) THEN {s} END"""


def _unix(x: str) -> str:
    return f"regexp_replace({x}, {_q(FOREIGN_BREAK)}, {_NL}, 'g')"


def _sections(source: str, keys: str = "doc_id") -> str:
    """CTEs up to ``sections(keys, section_no, heading, body)``."""
    return f"""src AS ({source}),
    ln AS (SELECT {keys}, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT {keys}, string_split({_unix('text')}, {_NL}) AS l FROM src)),
    hd AS (SELECT *, {_heading('line')} AS h FROM ln),
    grp AS (SELECT *, count(h) OVER (PARTITION BY {keys} ORDER BY pos ROWS UNBOUNDED PRECEDING) AS g FROM hd),
    raw AS (SELECT {keys}, g, max(h) AS heading, {_strip(f"string_agg(line, {_NL} ORDER BY pos) FILTER (WHERE h IS NULL)")} AS body FROM grp GROUP BY {keys}, g),
    good AS (SELECT * FROM raw WHERE body <> ''),
    sections AS (SELECT {keys}, (row_number() OVER (PARTITION BY {keys} ORDER BY g) - 1)::INTEGER AS section_no, heading, body FROM good
      UNION ALL SELECT {keys}, 0, NULL, {_strip('text')} FROM src WHERE ({keys}) NOT IN (SELECT ({keys}) FROM good))"""


def _blocks(x: str) -> str:
    found = f"list_filter(list_transform(regexp_split_to_array({x}, '\\n{{2,}}'), lambda p: {_strip('p')}), lambda p: p <> '')"
    return f"CASE WHEN len({found}) > 0 THEN {found} ELSE [{x}] END"


def _sentences(x: str) -> str:
    marked = f"regexp_replace({x}, {_q('([.!?])' + WS + '+([' + UPPER + chr(34) + chr(39) + '(])')}, '\\1' || chr(1) || '\\2', 'g')"
    return f"list_filter(list_transform(string_split({marked}, chr(1)), lambda s: {_strip('s')}), lambda s: s <> '')"


def _fold(name: str, units: str, keys: str, limit: int, overlap: int, suffix: bool) -> str:
    """CTEs packing ``units(keys, i, grp, txt)`` into ``name(keys, grp, s, e)``; lists end up in ``name_l``."""
    key_list = [k.strip() for k in keys.split(",")]
    same = " AND ".join(f"f.{k} = l.{k}" for k in key_list)
    fkeys = ", ".join(f"f.{k}" for k in key_list)
    size = "(l.p[f.i + 2] - l.p[f.i + 1])"
    if suffix:
        carry = f"f.s + len(list_filter(l.p[f.s + 1 : f.i + 1], lambda q: l.p[f.i + 2] - q > {overlap}))"
    else:
        carry = f"CASE WHEN {size} <= {overlap} THEN f.i ELSE f.i + 1 END"
    brk = "l.g[f.i + 2] <> l.g[f.i + 1]"
    over = f"l.p[f.i + 3] - l.p[f.s + 1] > {limit}"
    return f"""{name}_u AS ({units}),
    {name}_l AS (SELECT {keys}, list(grp ORDER BY i) AS g, list(txt ORDER BY i) AS t, count(*) AS n,
        list_concat([0], list(cum ORDER BY i)) AS p FROM (SELECT *, (sum({_TOKENS.format('txt')}) OVER (PARTITION BY {keys} ORDER BY i ROWS UNBOUNDED PRECEDING))::BIGINT AS cum FROM {name}_u) GROUP BY {keys}),
    {name}_f AS (SELECT {keys}, 0::BIGINT AS i, 0::BIGINT AS s, -1::BIGINT AS es, -1::BIGINT AS ee FROM {name}_l
      UNION ALL SELECT {fkeys}, f.i + 1,
        (CASE WHEN {brk} THEN f.i + 1 WHEN {over} THEN {carry} ELSE f.s END)::BIGINT,
        CASE WHEN {brk} OR {over} THEN f.s ELSE -1 END, CASE WHEN {brk} OR {over} THEN f.i + 1 ELSE -1 END
      FROM {name}_f f JOIN {name}_l l ON {same} WHERE f.i + 1 < l.n),
    {name} AS (SELECT {keys}, es AS s, ee AS e FROM {name}_f WHERE es >= 0
      UNION ALL SELECT {fkeys}, f.s, l.n FROM {name}_f f JOIN {name}_l l ON {same} WHERE f.i + 1 = l.n)"""


def _joined(name: str, keys: str, sep: str) -> str:
    same = " AND ".join(f"r.{k.strip()} = l.{k.strip()}" for k in keys.split(","))
    rkeys = ", ".join(f"r.{k.strip()}" for k in keys.split(","))
    return f"SELECT {rkeys}, r.s, r.e, l.g[r.s + 1] AS grp, array_to_string(l.t[r.s + 1 : r.e], {sep}) AS txt FROM {name} r JOIN {name}_l l ON {same}"


def _listed(table: str, keys: str, array: str, extra: str = "0 AS grp") -> str:
    """Rows (keys, i, grp, txt) of one array per row."""
    return f"SELECT {keys}, unnest(range(len(a))) AS i, {extra}, unnest(a) AS txt FROM (SELECT *, {array} AS a FROM {table})"


def _chunks(source: str, limit: int = 512, overlap: int = 64) -> str:
    """CTEs up to ``chunks(doc_id, chunk_index, section_heading, chunk_text, token_count)``."""
    nonblank = f"SELECT * FROM ({source}) WHERE {_strip('text')} <> ''"
    para = f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY section_no, j) - 1 AS i, section_no AS grp, txt FROM (
        SELECT doc_id, section_no, unnest(range(len(a))) AS j, unnest(a) AS txt FROM (SELECT doc_id, section_no, {_blocks('body')} AS a FROM sections))"""
    units = f"""SELECT doc_id, row_number() OVER (PARTITION BY doc_id ORDER BY grp_no, j) - 1 AS i, grp_no AS grp, txt FROM (
        SELECT doc_id, grp_no, unnest(range(len(a))) AS j, unnest(a) AS txt FROM (
          SELECT doc_id, grp_no, CASE WHEN {_TOKENS.format('txt')} <= {limit} THEN [txt] ELSE {_sentences('txt')} END AS a FROM groups))"""
    return f"""{_sections(nonblank)}, {_fold('pf', para, 'doc_id', limit, overlap, False)},
    groups AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY e) - 1 AS grp_no FROM ({_joined('pf', 'doc_id', _NL + ' || ' + _NL)})),
    {_fold('sf', units, 'doc_id', limit, overlap, True)},
    pieces AS (SELECT c.doc_id, c.e, c.txt, s.heading FROM ({_joined('sf', 'doc_id', "' '")}) c
      JOIN groups g ON g.doc_id = c.doc_id AND g.grp_no = c.grp JOIN sections s ON s.doc_id = g.doc_id AND s.section_no = g.grp WHERE {_strip('c.txt')} <> ''),
    chunks AS (SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY e) - 1)::INTEGER AS chunk_index, heading AS section_heading,
      {_strip('txt')} AS chunk_text, {_TOKENS.format('txt')} AS token_count FROM pieces)"""


_CHUNK_COLUMNS = f"SELECT {_CHUNK_KEY.format('doc_id', 'chunk_index')} AS chunk_id, doc_id, chunk_index, section_heading, chunk_text, token_count FROM chunks"
_PACK_KEYS = "doc_id, section_no"
_PACKED = f"{_sections(_SECTIONED)}, {_fold('pf', _listed('sections', _PACK_KEYS, _blocks('body')), _PACK_KEYS, 200, 40, False)}"
_PACKED_ROWS = f"SELECT *, (row_number() OVER (PARTITION BY {_PACK_KEYS} ORDER BY e) - 1)::INTEGER AS pos FROM ({_joined('pf', _PACK_KEYS, _NL + ' || ' + _NL)})"
_RESPLIT_KEYS = "doc_id, section_no, pos"
_RESPLIT_UNITS = _listed("packed", _RESPLIT_KEYS, f"CASE WHEN {_TOKENS.format('txt')} <= 120 THEN [txt] ELSE {_sentences('txt')} END")

# Text ---------------------------------------------------------------------------------------------

_SRC_HTML = r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<head\b[^>]*>.*?</head\s*>|<noscript\b[^>]*>.*?</noscript\s*>|<[!?][^>]*>|</?[a-z](?:[^>\"']|\"[^\"]*\"|'[^']*')*>"
_HTML_TAGS = f"regexp_replace(regexp_replace(html, {_q(_SRC_HTML)}, chr(1), 'g'), '[\\x01]+', {_NL}, 'g')"
_HTML_CHARS = reduce(lambda x, kv: f"replace({x}, '{kv[0]}', '{kv[1]}')", [("&quot;", '"'), ("&copy;", "©"), ("&middot;", "·"), ("&amp;", "&")], _HTML_TAGS)
_HTML_LINES = f"array_to_string(list_transform(string_split({_unix(_HTML_CHARS)}, {_NL}), lambda x: {_strip('x')}), {_NL})"
_HTML_TEXT = _strip(f"regexp_replace({_HTML_LINES}, '\\n{{3,}}', {_NL} || {_NL}, 'g')")

_EXT = "regexp_extract(lower(filename), '[^/.][^/]*?(\\.[^./]*)$', 1)"
_MIME = f"CASE WHEN hint IN ({', '.join(_q(m) for m in sorted(set(EXTENSION_MIME.values())))}) THEN hint " + " ".join(
    f"WHEN {_EXT} = '{e}' THEN '{m}'" for e, m in EXTENSION_MIME.items()) + " ELSE 'text/plain' END"

_TYPED = """SELECT doc_id, CASE doc_id % 6 WHEN 0 THEN 'Contrato cláusula ' WHEN 1 THEN 'proposta ' WHEN 2 THEN 'relatório '
    WHEN 3 THEN 'Curriculum vitae ' WHEN 4 THEN 'contrato proposta ' ELSE '' END || text AS text, 'report_' || doc_id AS filename FROM documents"""


def _hits(words: list[str]) -> str:
    return "(" + " + ".join(f"(length(s) - length(replace(s, {_q(w)}, ''))) // {len(w)}" for w in words) + ")::INTEGER"


_TYPE_SCORES = f"""SELECT *, CASE WHEN greatest({', '.join(f'{t}_hits' for t in DOC_TYPE_KEYWORDS)}) = 0 THEN 'unknown' {' '.join(
    f"WHEN {t}_hits = greatest({', '.join(f'{u}_hits' for u in DOC_TYPE_KEYWORDS)}) THEN '{t}'" for t in DOC_TYPE_KEYWORDS)} END AS doc_type
  FROM (SELECT uri, {', '.join(f'{_hits(w)} AS {t}_hits' for t, w in DOC_TYPE_KEYWORDS.items())} FROM (
    SELECT uri, lower(filename || ' ' || substring(text, 1, 4000)) AS s FROM {{0}}))"""

_GRAMS = "list_transform(range(1, length(h) - 1), lambda i: substring(h, i, 3))"
def _language(train: str, judged: str, key: str = "doc_id") -> str:
    """CTEs up to ``found(key, language)``: trained on ``train(lang, text)``, judging ``judged(key, text)``."""
    heads = lambda t, cols: f"SELECT {cols}, unnest({_GRAMS}) AS g FROM (SELECT *, lower(substring(text, 1, 500)) AS h FROM {t})"
    return f"""cnt AS (SELECT lang, g, count(*) AS n FROM ({heads(train, 'lang')}) GROUP BY lang, g),
    tot AS (SELECT lang, sum(n) + (SELECT count(DISTINCT g) FROM cnt) AS total FROM cnt GROUP BY lang),
    unseen AS (SELECT lang, round(ln(1 / total::DOUBLE) * 1000000)::BIGINT AS w FROM tot),
    weight AS (SELECT k.lang, k.g, round(ln((k.n + 1) / t.total::DOUBLE) * 1000000)::BIGINT AS w FROM cnt k JOIN tot t USING (lang)),
    score AS (SELECT d.{key}, u.lang, sum(coalesce(w.w, u.w)) AS s FROM ({heads(f"(SELECT * FROM {judged} WHERE length({_strip('text')}) >= 20)", key)}) d
      CROSS JOIN unseen u LEFT JOIN weight w ON w.lang = u.lang AND w.g = d.g GROUP BY d.{key}, u.lang),
    found AS (SELECT {key}, lang AS language FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY s DESC, lang) AS r FROM score) WHERE r = 1)"""


_LANGUAGE, _HELD = _language("documents", "documents"), "(SELECT * FROM documents WHERE doc_id % 5 = 0)"
_LANGUAGE_ROWS = "SELECT d.doc_id, d.lang, coalesce(f.language, 'unknown') AS language FROM documents d LEFT JOIN found f USING (doc_id)"

# Retrieval ----------------------------------------------------------------------------------------

_SIM = "list_cosine_similarity({0}::DOUBLE[], {1}::DOUBLE[])"
_QV = "(SELECT embedding FROM embeddings WHERE vec_id = 0)"
_KNN = f"""SELECT query_id, vec_id, sim, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id) AS r
  FROM (SELECT q.query_id, e.vec_id, {_SIM.format('e.embedding', 'q.v')} AS sim FROM embeddings e CROSS JOIN ({_CENTROIDS}) q)"""
_ASKED = f"""SELECT query_id, vec_id, round(sim, 6) AS similarity, rank FROM (SELECT query_id, vec_id, sim, (row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, vec_id))::INTEGER AS rank
  FROM (SELECT q.vec_id AS query_id, e.vec_id, {_SIM.format('e.embedding', 'q.embedding')} AS sim FROM embeddings q JOIN {{}} e ON q.vec_id % 20 = 0 AND {{}})) WHERE rank <= 10"""
_KNN_10 = f"SELECT query_id, vec_id, round(sim, 6) AS similarity, r::INTEGER AS rank FROM ({_KNN}) WHERE r <= 10"

# Path changes, level by level; the derived trees are at most four deep ------------------------------


def _create(requests: str, stored: str) -> str:
    """CTEs ``req(ns, seq, path, node_type, parent, depth)`` and ``made(ns, path, seq, node_type)``."""
    out = [f"old AS ({stored})", f"""req AS (SELECT *, {_PARENT.format('path')} AS parent, length(path) - length(replace(path, '/', '')) AS depth FROM ({requests}))"""]
    for d in range(1, 6):
        if d == 1:
            timely = "SELECT r.* FROM req r WHERE depth = 1"
        else:
            timely = f"""SELECT r.* FROM req r JOIN (SELECT ns, path, -1 AS since FROM old WHERE node_type = 'd'
              UNION ALL SELECT ns, path, seq FROM made{d - 1} WHERE node_type = 'd') p ON p.ns = r.ns AND p.path = r.parent AND r.seq > p.since WHERE r.depth = {d}"""
        out.append(f"""made{d} AS (SELECT ns, path, min(seq) AS seq, arg_min(node_type, seq) AS node_type FROM ({timely}) t
          WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.ns = t.ns AND o.path = t.path) GROUP BY ns, path)""")
    out.append("made AS (" + " UNION ALL ".join(f"SELECT * FROM made{d}" for d in range(1, 6)) + ")")
    return ", ".join(out)


def _delete(requests: str, stored: str) -> str:
    out = [f"old AS (SELECT *, {_PARENT.format('path')} AS parent, length(path) - length(replace(path, '/', '')) AS depth FROM ({stored}))",
           f"req AS ({requests})", "gone6 AS (SELECT ns, path, 0 AS seq FROM old WHERE false)"]
    for d in range(5, 0, -1):
        out.append(f"""gone{d} AS (SELECT r.ns, r.path, min(r.seq) AS seq FROM req r JOIN old o ON o.ns = r.ns AND o.path = r.path AND o.depth = {d}
          WHERE r.seq > coalesce((SELECT max(CASE WHEN g.seq IS NULL THEN 9000000000000 ELSE g.seq END) FROM old c LEFT JOIN gone{d + 1} g ON g.ns = c.ns AND g.path = c.path
            WHERE c.ns = o.ns AND c.parent = o.path), -1) GROUP BY r.ns, r.path)""")
    out.append("gone AS (" + " UNION ALL ".join(f"SELECT * FROM gone{d}" for d in range(1, 6)) + ")")
    return ", ".join(out)


_CREATES = f"SELECT ns, page_id * 10 + CASE WHEN page_id % 2 = 0 THEN depth ELSE 9 - depth END AS seq, path, node_type FROM ({_STEPS})"
_CREATE_BASE = f"SELECT * FROM ({_NODES}) WHERE path = '/en'"
_DELETES = f"SELECT ns, page_id * 10 + 9 - depth AS seq, path FROM ({_STEPS}) WHERE NOT (node_type = 'f' AND path LIKE '%/5')"
_RACE = f"SELECT ns, page_id AS seq, '/race' AS path, 'f' AS node_type FROM ({_PAGE_PATHS})"
_MOVES = f"""SELECT ns, page_id AS seq, source, CASE WHEN page_id % 5 = 0 THEN source || '/below' WHEN page_id % 5 = 1 THEN '/absent/x'
    ELSE '/moved-' || {_NAME.format('source')} END AS target FROM (SELECT *, array_to_string(list_slice(string_split(path, '/'), 1, 3), '/') AS source
    FROM ({_PAGE_PATHS}) WHERE path <> '')"""
_RELATED = "({0} = {1} OR starts_with({0}, {1} || '/') OR starts_with({1}, {0} || '/'))"
_MOVE = f"""tree AS ({_NODES}), req AS (SELECT *, source <> '' AND target <> '' AND NOT starts_with(target, source || '/') AS sane FROM ({_MOVES})),
    late AS (SELECT DISTINCT b.ns, b.seq FROM req a JOIN req b ON a.ns = b.ns AND a.seq < b.seq AND a.sane AND b.sane AND ({' OR '.join(
        _RELATED.format('a.' + x, 'b.' + y) for x in ('source', 'target') for y in ('source', 'target'))})),
    verdict AS (SELECT r.ns, r.seq, r.source, r.target, CASE WHEN EXISTS (SELECT 1 FROM late l WHERE l.ns = r.ns AND l.seq = r.seq) THEN 'deferred'
        WHEN r.sane AND EXISTS (SELECT 1 FROM tree t WHERE t.ns = r.ns AND t.path = r.source) AND NOT EXISTS (SELECT 1 FROM tree t WHERE t.ns = r.ns AND t.path = r.target)
          AND ({_PARENT.format('r.target')} = '' OR EXISTS (SELECT 1 FROM tree t WHERE t.ns = r.ns AND t.path = {_PARENT.format('r.target')} AND t.node_type = 'd'))
        THEN 'ok' ELSE 'failed' END AS outcome FROM req r)"""

_SEQ_OK = "SELECT r.ns, r.seq, r.path{0}, EXISTS (SELECT 1 FROM {1} m WHERE m.ns = r.ns AND m.path = r.path AND m.seq = r.seq) AS ok FROM req r"


def _update_rows() -> str:
    return f"""SELECT *, 1 AS batch_no, 'proposta' AS new_type FROM docs UNION ALL
      SELECT *, 2, 'relatorio' FROM docs WHERE char_count % 2 = 0"""


_FILES = "SELECT page_id, 'text/plain' AS mime_type, length(html) + 1 AS char_count, html || chr(10) AS text FROM pages"
_WORDS = "list_distinct(list_filter(regexp_split_to_array(lower({0}), '[^\\p{{L}}\\p{{N}}]+'), lambda w: w <> ''))"
_JSON_PROPS = "(props ->> 'k')::BIGINT"

ORACLES = {
    "mime_detection": f"""SELECT page_id, filename, {_MIME} AS mime_type FROM (SELECT page_id,
        CASE page_id % 6 WHEN 0 THEN name || '.PDF' WHEN 1 THEN name || '.tar.md' ELSE name END AS filename,
        CASE page_id % 6 WHEN 2 THEN 'text/html; charset=utf-8' WHEN 3 THEN 'application/json' WHEN 4 THEN 'text/html' END AS hint
        FROM (SELECT page_id, CASE WHEN n = '' THEN '.md' ELSE n END AS name FROM (
          SELECT page_id, regexp_extract(regexp_replace(url, '[?#].*$', ''), '[^/]*$') AS n FROM pages)))""",
    "file_listing": "SELECT page_id, mime_type, octet_length(encode(text))::BIGINT AS length FROM (" + _FILES + ")",
    "file_reading": "SELECT page_id, mime_type, char_count::INTEGER AS char_count, sha256(text) AS text_sha256 FROM (" + _FILES + ")",
    "command_log": f"""SELECT ns, page_id AS seq,
        CASE page_id % 9 WHEN 0 THEN 'c' WHEN 1 THEN 'c' WHEN 2 THEN 'l' WHEN 3 THEN 'm' WHEN 6 THEN 'd' WHEN 7 THEN 'c' ELSE 'q' END AS op,
        path AS arg1, CASE page_id % 9 WHEN 0 THEN 'f' WHEN 1 THEN 'd' WHEN 3 THEN '/moved' || path WHEN 6 THEN 'now' WHEN 7 THEN 'x' END AS arg2,
        CASE page_id % 9 WHEN 6 THEN 'wrong_arguments' WHEN 7 THEN 'invalid_node_type' WHEN 8 THEN 'unknown_command' END AS error
        FROM ({_PAGE_PATHS}) WHERE page_id % 9 NOT IN (4, 5)""",
    "text_decoding": _DOCS,
    "html_to_text": f"SELECT page_id, {_HTML_TEXT} AS text FROM pages",
    "json_to_text": "SELECT event_id, 'k: ' || (props ->> 'k') AS text FROM events",
    "nested_json_to_text": f"""SELECT event_id, array_to_string(['type: ' || event_type, 'value: ' || value::VARCHAR, 'props:', '  k: ' || (props ->> 'k'),
        'tags:', '  x', '  True', '  None', '  deep:', '    1', '    2', 'none:', ''], {_NL}) AS text FROM events""",
    "docx_to_text": f"SELECT doc_id, array_to_string(list_filter(list_transform(string_split(text, {_NL}), lambda x: {_strip('x')}), lambda x: x <> ''), {_NL} || {_NL}) AS text FROM documents",
    "mixed_extraction": f"SELECT uri, mime_type, text, parse_error FROM ({_MIXED})",
    "doc_type_scores": f"""WITH t AS (SELECT doc_id AS uri, filename, text FROM ({_TYPED}))
        SELECT uri AS doc_id, doc_type, {', '.join(f'{t}_hits' for t in DOC_TYPE_KEYWORDS)} FROM ({_TYPE_SCORES.format('t')})""",
    "language_detection": f"WITH {_LANGUAGE} {_LANGUAGE_ROWS}",
    "language_accuracy": f"""WITH {_language('(SELECT * FROM documents WHERE doc_id % 5 <> 0)', _HELD)} SELECT lang, count(*) AS n, (count(*) FILTER (WHERE lang = language))::BIGINT AS correct
        FROM ({_LANGUAGE_ROWS.replace('FROM documents d', f'FROM {_HELD} d')}) GROUP BY lang""",
    "text_measures": f"""SELECT doc_id, length(text)::INTEGER AS char_count, n_chars, {_TOKENS.format('text')} AS token_count,
        sha256('mem://' || doc_id) AS document_key, {_CHUNK_KEY.format('doc_id', '0')} AS first_chunk_key FROM documents""",
    "parse_stage": f"""WITH m AS ({_MIXED}), {_language('documents', 'm', 'uri')} SELECT sha256(m.uri) AS doc_id, m.uri, m.filename, m.mime_type, t.doc_type, coalesce(l.language, 'unknown') AS language,
        length(m.text)::INTEGER AS char_count, {_STAMP} AS ingest_timestamp, m.parse_error FROM m JOIN ({_TYPE_SCORES.format('m')}) t USING (uri) LEFT JOIN found l USING (uri)""",
    "line_headings": f"""SELECT * FROM (SELECT doc_id, pos::INTEGER AS pos, {_heading('line')} AS heading FROM (
        SELECT doc_id, unnest(range(len(l))) AS pos, unnest(l) AS line FROM (SELECT doc_id, string_split(text, {_NL}) AS l FROM ({_SECTIONED})))) WHERE heading IS NOT NULL""",
    "lines": f"""SELECT doc_id, pos, line FROM ({_LINES}) x WHERE NOT (line = '' AND pos = (SELECT max(pos) FROM ({_LINES}) y WHERE y.doc_id = x.doc_id))""",
    "line_counts": f"SELECT doc_id, len(regexp_split_to_array(replace(replace(text, '.', chr(11)), ',', chr(8232)), {_q('[' + ''.join(f'{chr(92)}x{{{ord(c):x}}}' for c in LINE_ENDS) + ']')}))::INTEGER AS n_lines FROM documents",
    "sections": f"WITH {_sections(_SECTIONED)} SELECT doc_id, section_no, heading AS section_heading, body FROM sections",
    "turn_sections": f"WITH {_sections(_TURNS, 'conv_id, turn')} SELECT conv_id, turn, section_no, heading AS section_heading, body FROM sections",
    "paragraphs": f"""WITH {_sections(_SECTIONED)} SELECT doc_id, section_no, heading AS section_heading, unnest(range(len(a)))::INTEGER AS pos, unnest(a) AS paragraph
        FROM (SELECT *, {_blocks('body')} AS a FROM sections)""",
    "sentences": f"SELECT doc_id, unnest(range(len(a)))::INTEGER AS pos, unnest(a) AS sentence FROM (SELECT doc_id, {_sentences('text')} AS a FROM documents)",
    "packed_paragraphs": f"WITH RECURSIVE {_PACKED} SELECT doc_id, section_no, pos, txt AS packed, (e - s)::INTEGER AS n_units FROM ({_PACKED_ROWS})",
    "resplit_paragraphs": f"""WITH RECURSIVE {_PACKED}, packed AS ({_PACKED_ROWS}), {_fold('rf', _RESPLIT_UNITS, _RESPLIT_KEYS, 120, 30, True)}
        SELECT doc_id, section_no, pos, (row_number() OVER (PARTITION BY {_RESPLIT_KEYS} ORDER BY e) - 1)::INTEGER AS piece_no, txt AS piece FROM ({_joined('rf', _RESPLIT_KEYS, "' '")})""",
    "packed_sentences": f"""WITH RECURSIVE {_fold('sf', _listed('documents', 'doc_id', _sentences('text')), 'doc_id', 512, 64, True)}
        SELECT doc_id, (row_number() OVER (PARTITION BY doc_id ORDER BY e) - 1)::INTEGER AS pos, txt AS packed, (e - s)::INTEGER AS n_units FROM ({_joined('sf', 'doc_id', "' '")})""",
    "chunk_documents": f"WITH RECURSIVE {_chunks(_DOCS)} {_CHUNK_COLUMNS}",
    "chunk_sectioned": f"WITH RECURSIVE {_chunks(_SECTIONED)} {_CHUNK_COLUMNS}",
    "chunk_small": f"WITH RECURSIVE {_chunks(_SECTIONED, 60, 20)} {_CHUNK_COLUMNS}",
    "chunk_pages": f"WITH RECURSIVE {_chunks(f'SELECT page_id AS doc_id, {_HTML_TEXT} AS text FROM pages', 128, 32)} {_CHUNK_COLUMNS}",
    "documents_without_chunks": f"SELECT doc_id, CASE WHEN doc_id % 7 = 0 OR {_strip('text')} = '' THEN 'no_chunks' ELSE 'kept' END AS status FROM documents",
    "embedded_lines": f"""SELECT chunk_id, 4 AS dim, length(chunk_text)::DOUBLE AS v0, {', '.join(
        f"(length(chunk_text) - length(replace(chunk_text, '{c}', '')))::DOUBLE AS v{i}" for i, c in enumerate(' .e', 1))} FROM ({_LINE_CHUNKS})""",
    "embedding_retries": f"""SELECT chunk_id, 4 AS dim, length(chunk_text)::DOUBLE AS v0, {', '.join(
        f"(length(chunk_text) - length(replace(chunk_text, '{c}', '')))::DOUBLE AS v{i}" for i, c in enumerate(' .e', 1))}, true AS good FROM ({_LINE_CHUNKS})""",
    "embedding_rejects": f"""SELECT doc_id, CASE WHEN bad THEN 0 ELSE n END AS n_embedded, CASE WHEN bad THEN 'ValueError: digits' ELSE 'ok' END AS reason
        FROM (SELECT doc_id, count(*) AS n, bool_or(regexp_matches(chunk_text, '[0-9]')) AS bad FROM ({_LINE_CHUNKS}) GROUP BY doc_id)""",
    "hashed_embedding": """SELECT doc_id, CASE WHEN w THEN 256 END AS dim, CASE WHEN w THEN 1.0::DOUBLE END AS length, CASE WHEN w THEN 1.0::DOUBLE END AS backwards,
        CASE WHEN w THEN 1.0::DOUBLE END AS twice, CASE WHEN w THEN true END AS differs FROM (SELECT doc_id, regexp_matches(text, '[\\p{L}\\p{N}]') AS w FROM documents)""",
    "question_answering": f"""WITH RECURSIVE {_chunks(_DOCS)}, keyed AS (SELECT {_CHUNK_KEY.format('doc_id', 'chunk_index')} AS chunk_id, doc_id, chunk_text FROM chunks),
        once AS (SELECT min(chunk_id) AS chunk_id, arg_min(doc_id, chunk_id) AS doc_id, chunk_text FROM keyed GROUP BY chunk_text),
        item AS (SELECT 'c' AS side, chunk_id AS id, chunk_text AS txt FROM once UNION ALL SELECT 'q', conv_id || ':' || turn, text FROM conversations),
        word AS (SELECT side, id, unnest(list_filter(string_split(txt, ' '), lambda w: w <> '')) AS w FROM item),
        part AS (SELECT side, id, (('0x' || substring(md5(w), 1, 4))::INTEGER % 64) AS b, count(*)::DOUBLE AS n FROM word GROUP BY ALL),
        size AS (SELECT side, id, sqrt(sum(n * n)) AS s FROM part GROUP BY side, id),
        sim AS (SELECT q.id AS query_id, c.id AS chunk_id, sum(q.n * c.n) AS dot FROM part q JOIN part c ON q.side = 'q' AND c.side = 'c' AND q.b = c.b GROUP BY ALL),
        every AS (SELECT q.id AS query_id, c.id AS chunk_id, coalesce(dot, 0) / q.s / c.s AS sim FROM size q JOIN size c ON q.side = 'q' AND c.side = 'c' LEFT JOIN sim ON sim.query_id = q.id AND sim.chunk_id = c.id),
        best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY sim DESC, chunk_id) AS r FROM every)
        SELECT query_id, r::INTEGER AS rank, chunk_id, o.doc_id, d.source, d.lang, round(sim, 5) AS similarity FROM best JOIN once o USING (chunk_id) JOIN documents d ON d.doc_id = o.doc_id WHERE r <= 3""",
    "inverted_lists_recall": "SELECT vec_id AS query_id, 1.0::DOUBLE AS recall FROM embeddings WHERE vec_id % 20 = 0",
    "bounded_lists_top_k": _ASKED.format("embeddings", "true"),
    "coded_top_k": _ASKED.format("embeddings", "true"),
    "filtered_lists_top_k": _ASKED.format("(SELECT vec_id, embedding, lang FROM embeddings JOIN documents ON doc_id = vec_id)",
                                          "e.lang = (['fr', 'de', 'es', 'en'])[(q.vec_id // 20) % 4 + 1]"),
    "stored_rejects": f"""SELECT uri, 'parse' AS stage, parse_error AS reason FROM ({_MIXED}) WHERE parse_error IS NOT NULL AND doc_id % 80 <> 2
        UNION ALL SELECT uri, 'chunk', 'no_chunks' FROM ({_MIXED}) WHERE {_strip('text')} = '' AND doc_id % 80 <> 2""",
    "read_rejects": f"SELECT page_id, 'read' AS stage, CASE WHEN octet_length(encode(text)) <= 3000 THEN 'ok' ELSE 'too_large' END AS reason FROM ({_FILES})",
    "upsert_ties": f"SELECT doc_id, CASE WHEN char_count % 2 = 0 THEN 'relatorio' ELSE 'proposta' END AS doc_type, language, char_count FROM ({_DOCUMENT_TABLE})",
    "upsert_documents": f"""WITH docs AS ({_DOCUMENT_TABLE}), upd AS (SELECT doc_id, arg_max(new_type, batch_no) AS t FROM ({_update_rows()}) WHERE language <> 'en' GROUP BY doc_id)
        SELECT doc_id, uri, coalesce(t, doc_type) AS doc_type, language, char_count, ingest_timestamp FROM docs LEFT JOIN upd USING (doc_id)""",
    "upsert_chunks_merge": f"SELECT chunk_id, doc_id, chunk_index, section_heading, CASE WHEN chunk_index < 3 THEN 'new ' ELSE '' END || chunk_text AS chunk_text, token_count FROM ({_LINE_CHUNKS})",
    "upsert_chunks_replace": f"""SELECT chunk_id, doc_id, chunk_index, section_heading, CASE WHEN source LIKE 'src1%' THEN 'new ' ELSE '' END || chunk_text AS chunk_text, token_count
        FROM ({_LINE_CHUNKS}) JOIN (SELECT doc_id::VARCHAR AS doc_id, source FROM documents) USING (doc_id) WHERE chunk_index < 3 OR source NOT LIKE 'src1%'""",
    "cascade_delete": f"""SELECT d.doc_id, count(c.chunk_id) AS n_chunks FROM ({_DOCUMENT_TABLE}) d LEFT JOIN ({_LINE_CHUNKS}) c USING (doc_id)
        WHERE d.doc_id NOT IN (SELECT doc_id::VARCHAR FROM labels WHERE toxic = 1) GROUP BY d.doc_id""",
    "constraint_violations": f"""WITH d AS ({_DOCUMENT_TABLE}), c AS ({_LINE_CHUNKS})
        SELECT 'documents_key' AS "constraint", doc_id AS key, 2::BIGINT AS n FROM d WHERE language = 'es'
        UNION ALL SELECT 'chunks_document', chunk_id, 1 FROM c WHERE doc_id IN (SELECT doc_id FROM d WHERE language = 'de')
        UNION ALL SELECT 'chunks_dimension', chunk_id, 1 FROM c WHERE chunk_index = 2
        UNION ALL SELECT 'documents_not_null_filename', doc_id, CASE WHEN language = 'es' THEN 2 ELSE 1 END FROM d WHERE doc_type = 'cv' AND language <> 'de'""",
    "column_defaults": f"""SELECT doc_id, CASE WHEN doc_type = 'cv' THEN 'cv' ELSE 'unknown' END AS doc_type, language, 0 AS char_count, '{{}}' AS extra_metadata, true AS has_timestamp FROM ({_DOCUMENT_TABLE})""",
    "created_tables": f"SELECT doc_id, doc_type, language, char_count, doc_id || ':0' AS chunk_id FROM ({_DOCUMENT_TABLE}) WHERE doc_type IN ('cv', 'contrato')",
    "published_tables": f"""SELECT d.doc_id, d.doc_type, d.language, count(*) AS n_chunks, sum(token_count)::BIGINT AS n_tokens
        FROM ({_DOCUMENT_TABLE}) d JOIN ({_LINE_CHUNKS}) c USING (doc_id) GROUP BY ALL""",
    "cosine_top_k": f"""SELECT e.vec_id, d.lang, d.source, d.n_chars, round({_SIM.format('e.embedding', _QV)}, 6) AS similarity
        FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id ORDER BY {_SIM.format('e.embedding', _QV)} DESC, e.vec_id LIMIT 5""",
    "cosine_top_k_referenced": f"""SELECT vec_id, label, round({_SIM.format('embedding', _QV)}, 6) AS similarity FROM embeddings ORDER BY {_SIM.format('embedding', _QV)} DESC, vec_id LIMIT 5""",
    "filtered_top_k": f"""SELECT e.vec_id, d.lang, d.source, d.n_chars, round({_SIM.format('e.embedding', _QV)}, 6) AS similarity
        FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id WHERE d.lang = 'fr' ORDER BY {_SIM.format('e.embedding', _QV)} DESC, e.vec_id LIMIT 10""",
    "batch_top_k": _KNN_10,
    "batch_top_k_shuffled": _KNN_10,
    "inverted_lists_all": _KNN_10,
    "inverted_lists_shuffled": _KNN_10,
    "uri_lookup": f"SELECT uri, doc_id, doc_type, language, char_count FROM ({_DOCUMENT_TABLE}) WHERE uri = 'mem://src7/7.txt'",
    "type_language_filter": f"SELECT doc_id, doc_type, language, char_count FROM ({_DOCUMENT_TABLE}) WHERE doc_type = 'contrato' AND language = 'de'",
    "json_containment": f"SELECT event_id, event_type = 'click' AND {_JSON_PROPS} = 69 AS click_69, false AS text_69, true AS has_object, true AS has_props, false AS has_k FROM events",
    "document_chunks": f"SELECT * FROM ({_LINE_CHUNKS}) WHERE doc_id = '0'",
    "ordered_chunks": f"SELECT doc_id, chunk_index, token_count FROM ({_LINE_CHUNKS}) ORDER BY doc_id, chunk_index",
    "heading_filter": f"SELECT chunk_id, section_heading FROM ({_LINE_CHUNKS}) WHERE section_heading LIKE 'src1%'",
    "ingestion": f"""WITH RECURSIVE m AS ({_MIXED}), {_language('documents', 'm', 'uri')}, {_chunks('SELECT uri AS doc_id, text FROM m')}
        SELECT m.uri, m.mime_type, t.doc_type, coalesce(l.language, 'unknown') AS language, length(m.text)::INTEGER AS char_count, c.n_chunks, c.n_tokens
        FROM m JOIN ({_TYPE_SCORES.format('m')}) t USING (uri) LEFT JOIN found l USING (uri)
        JOIN (SELECT doc_id AS uri, count(*) AS n_chunks, sum(token_count)::BIGINT AS n_tokens FROM chunks GROUP BY doc_id) c USING (uri)""",
    "ingestion_rejects": f"""SELECT * FROM (SELECT 'parse' AS stage, parse_error AS reason, count(*) AS n FROM ({_MIXED}) WHERE parse_error IS NOT NULL GROUP BY parse_error
        UNION ALL SELECT 'chunk', 'no_chunks', count(*) FROM ({_MIXED}) WHERE {_strip('text')} = '') WHERE n > 0""",
    "split_paths": f"SELECT page_id, {_PARENT.format('path')} AS parent, {_NAME.format('path')} AS name FROM ({_PAGE_PATHS})",
    "path_lookup": f"""WITH t AS ({_NODES}), r AS (SELECT page_id, ns, CASE page_id % 4 WHEN 0 THEN '/' || path || '//' WHEN 1 THEN path || '/x'
          WHEN 2 THEN {_PARENT.format('path')} ELSE '/' END AS path,
          CASE page_id % 4 WHEN 0 THEN path WHEN 1 THEN path || '/x' WHEN 2 THEN {_PARENT.format('path')} ELSE '' END AS clean FROM ({_PAGE_PATHS}))
        SELECT r.page_id, r.ns, r.path, r.clean = '' OR t.path IS NOT NULL AS found, CASE WHEN r.clean = '' THEN 'd' ELSE t.node_type END AS node_type
        FROM r LEFT JOIN t ON t.ns = r.ns AND t.path = r.clean""",
    "subtree_listing": f"SELECT ns, path FROM ({_NODES}) WHERE path = '/en/7' OR path LIKE '/en/7/%'",
    "tree_listing": f"SELECT ns, path FROM ({_NODES}) UNION ALL SELECT DISTINCT ns, '' FROM ({_NODES})",
    "empty_directories": f"""WITH t AS (SELECT * FROM ({_NODES}) WHERE NOT (node_type = 'f' AND {_NAME.format('path')} IN ('5', '7', '8')))
        SELECT ns, path, NOT EXISTS (SELECT 1 FROM t c WHERE c.ns = t.ns AND {_PARENT.format('c.path')} = t.path) AS is_empty FROM t WHERE node_type = 'd'""",
    "tree_violations": f"""WITH t AS (SELECT * FROM ({_NODES}) WHERE path NOT LIKE '/_%/5')
        SELECT ns, path, 'no_parent_directory' AS reason FROM t WHERE {_PARENT.format('path')} <> '' AND NOT EXISTS (
          SELECT 1 FROM t p WHERE p.ns = t.ns AND p.path = {_PARENT.format('t.path')} AND p.node_type = 'd')
        UNION ALL SELECT ns, path, 'duplicate' FROM t WHERE path = '/en'""",
    "capacity_report": f"""WITH t AS ({_NODES}) SELECT ns, 'entries' AS kind, {_PARENT.format('path')} AS path, count(*) AS size FROM t GROUP BY ALL HAVING count(*) > 5
        UNION ALL SELECT ns, 'nodes', '', count(*) + 1 FROM t GROUP BY ns HAVING count(*) + 1 > 30
        UNION ALL SELECT ns, 'name', path, length({_NAME.format('path')}) FROM t WHERE length({_NAME.format('path')}) > 6""",
    "bulk_create": f"WITH {_create(_CREATES, _CREATE_BASE)} {_SEQ_OK.format(', r.node_type', 'made')}",
    "created_nodes": f"WITH {_create(_CREATES, _CREATE_BASE)} SELECT ns, path, node_type FROM made",
    "contested_create": f"WITH {_create(_RACE, _NODES)} {_SEQ_OK.format(', r.node_type', 'made')}",
    "bulk_delete": f"WITH {_delete(_DELETES, _NODES)} {_SEQ_OK.format('', 'gone')}",
    "remaining_nodes": f"WITH {_delete(_DELETES, _NODES)} SELECT ns, path, node_type FROM old o WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.ns = o.ns AND g.path = o.path)",
    "bulk_move": f"WITH {_MOVE} SELECT * FROM verdict",
    "moved_nodes": f"""WITH {_MOVE} SELECT t.ns, CASE WHEN v.source IS NULL THEN t.path ELSE v.target || substring(t.path, length(v.source) + 1) END AS path, t.node_type
        FROM tree t LEFT JOIN (SELECT * FROM verdict WHERE outcome = 'ok') v ON v.ns = t.ns AND (t.path = v.source OR starts_with(t.path, v.source || '/'))""",
    "skip_ingested": """SELECT min('mem://' || lpad(doc_id::VARCHAR, 12, '0')) AS uri, sha256(text) AS content_sha256 FROM documents
        WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE source = 'src0') GROUP BY sha256(text)""",
    "arrival_ingest": f"WITH f AS (SELECT page_id AS uri, * FROM ({_FILES})), {_language('documents', 'f', 'uri')} SELECT page_id, mime_type, doc_type, coalesce(language, 'unknown') AS language, char_count::INTEGER AS char_count FROM f LEFT JOIN found USING (uri) JOIN ({_TYPE_SCORES.format('(SELECT page_id AS uri, ' + chr(39) * 2 + ' AS filename, text FROM (' + _FILES + '))')}) t USING (uri)",
    "rerank_lexical": f"""WITH asked AS (SELECT e.label AS query_id, min(d.text) AS query_text FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id GROUP BY e.label),
        near AS (SELECT * FROM ({_KNN}) WHERE r <= 20),
        scored AS (SELECT n.query_id, n.vec_id, n.sim, len(list_intersect({_WORDS.format('d.text')}, {_WORDS.format('a.query_text')}))::INTEGER AS overlap
          FROM near n JOIN documents d ON d.doc_id = n.vec_id JOIN asked a ON a.query_id = n.query_id)
        SELECT query_id, vec_id, overlap, r::INTEGER AS rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY overlap DESC, sim DESC, vec_id) AS r FROM scored) WHERE r <= 5""",
    "extra_metadata": "SELECT doc_id, " + ", ".join(
        f"CASE WHEN len(m_{n}) > 0 THEN array_to_string(m_{n}, ' ; ') END AS all_{n}" for n in _RULES) + " FROM (SELECT doc_id, " + ", ".join(
        f"list_transform(list_filter(list_zip(m, range(len(m))), lambda z: list_position(m, z[1]) = z[2] + 1), lambda z: z[1]) AS m_{n}".replace("m,", f"regexp_extract_all(text, {_q(p)}, 1),").replace("(m)", f"(regexp_extract_all(text, {_q(p)}, 1))") for n, p in _RULES.items()) + " FROM documents)",
    "uri_batch_lookup": f"SELECT uri, doc_type, language, char_count FROM ({_DOCUMENT_TABLE}) WHERE doc_id::BIGINT % 3 = 0",
    "containment_postings": f"""WITH e AS (SELECT event_id, event_type, value, props, {_JSON_PROPS} AS k FROM events),
        kinds AS (SELECT DISTINCT event_type FROM events)
        SELECT '{{"props": ' || p.props || ', "type": "' || p.event_type || '", "none": {{}}}}' AS pattern, e.event_id FROM (SELECT DISTINCT event_type, props, k FROM e) p JOIN e ON e.k = p.k AND e.event_type = p.event_type
        UNION ALL SELECT '{{"type": "' || event_type || '", "props": {{}}, "value": 10.0}}', event_id FROM e WHERE value = 10""",
    "subtree_sizes": f"""WITH t AS (SELECT ns, path, node_type FROM ({_NODES}) UNION ALL SELECT DISTINCT ns, '', 'd' FROM ({_NODES})),
        placed AS (SELECT *, row_number() OVER (ORDER BY ns, string_split(path, '/')) - 1 AS first FROM t)
        SELECT ns, path, first, (SELECT count(*) FROM t b WHERE b.ns = a.ns AND starts_with(b.path, a.path || '/')) AS n_below FROM placed a WHERE node_type = 'd'""",
    "many_subtrees": f"""WITH t AS ({_NODES}) SELECT a.ns, a.path AS top, b.path, b.node_type, row_number() OVER (PARTITION BY a.ns, a.path ORDER BY string_split(b.path, '/')) - 1 AS place
        FROM t a JOIN t b ON a.ns = b.ns AND a.node_type = 'd' AND (b.path = a.path OR starts_with(b.path, a.path || '/'))""",
    "arrival_of_copies": f"""WITH f AS (SELECT false AS is_copy, page_id, 'page_id=' || page_id || '/' AS uri, html AS h FROM pages),
        g AS (SELECT true AS is_copy, page_id, 'copy_id=' || page_id || '/' AS uri, CASE WHEN page_id % 10 = 0 THEN html || '<p>again</p>' ELSE html END AS h FROM pages),
        one AS (SELECT arg_min(is_copy, uri) AS is_copy, arg_min(page_id, uri) AS page_id, h FROM f GROUP BY h),
        two AS (SELECT arg_min(is_copy, uri) AS is_copy, arg_min(page_id, uri) AS page_id, h FROM g WHERE h NOT IN (SELECT h FROM f) GROUP BY h)
        SELECT is_copy, page_id, length(h)::INTEGER + 1 AS char_count FROM (FROM one UNION ALL FROM two)""",
    "repeated_ingestion": f"""WITH f AS (SELECT false AS is_copy, page_id, 'page_id=' || page_id || '/' AS uri, html || chr(10) AS text FROM pages),
        g AS (SELECT true AS is_copy, page_id, 'copy_id=' || page_id || '/' AS uri, html || '<!-- more -->' || chr(10) AS text FROM pages WHERE page_id % 3 = 0),
        one AS (SELECT arg_min(is_copy, uri) AS is_copy, arg_min(page_id, uri) AS page_id, text FROM f GROUP BY text),
        two AS (SELECT arg_min(is_copy, uri) AS is_copy, arg_min(page_id, uri) AS page_id, text FROM g WHERE text NOT IN (SELECT text FROM f) GROUP BY text),
        kept AS (SELECT is_copy || ':' || page_id AS uri, '' AS filename, * FROM (FROM one UNION ALL FROM two)),
        found AS (SELECT kept.*, t.doc_type, regexp_extract_all(text, '<title>([^<]*)</title>', 1) AS a, CASE WHEN t.doc_type = 'unknown' THEN regexp_extract_all(text, 'href="([^"]*)"', 1) ELSE [] END AS b FROM kept JOIN ({_TYPE_SCORES.format('kept')}) t USING (uri))
        SELECT is_copy, page_id, doc_type, length(text)::INTEGER AS char_count,
          CASE WHEN len(a) > 0 THEN array_to_string(list_filter(a, lambda v, i: list_position(a, v) = i), ' ; ') END AS title, CASE WHEN len(b) > 0 THEN array_to_string(list_filter(b, lambda v, i: list_position(b, v) = i), ' ; ') END AS links FROM found""",
    "health_windows": """WITH e AS (SELECT event_id, ts, event_type, value, least(4, (day(ts) - 1) // 6 + (event_id % 37 = 0)::INTEGER) AS part FROM events),
        mark AS (SELECT p AS part, (SELECT max(ts) - INTERVAL 12 HOUR FROM e WHERE part < p) AS watermark FROM (SELECT unnest(range(5)) AS p)),
        kept AS (SELECT time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') AS window_start, event_type, value FROM e JOIN mark USING (part)
          WHERE watermark IS NULL OR time_bucket(INTERVAL 6 HOUR, ts, TIMESTAMP '2024-01-01') + INTERVAL 6 HOUR > watermark)
        SELECT window_start::VARCHAR AS window_start, event_type, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_failed, round(avg(value), 6) AS mean_latency, max(value) AS max_latency FROM kept GROUP BY ALL""",
    "health_alerts": """WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts, TIMESTAMP '2024-01-01') AS window_start, count(*) AS n, count(*) FILTER (WHERE event_type = 'error') AS n_failed, max(value) AS max_latency FROM events GROUP BY ALL)
        SELECT window_start::VARCHAR AS window_start, n, n_failed, max_latency, CASE WHEN n_failed / n > 0.25 AND max_latency > 250 THEN 'errors and latency' WHEN n_failed / n > 0.25 THEN 'errors' ELSE 'latency' END AS reason
        FROM w WHERE n >= 3 AND (n_failed / n > 0.25 OR max_latency > 250)""",
    "fused_search": """WITH docs AS (SELECT min(doc_id) AS key, text FROM documents GROUP BY text),
        asked AS (SELECT conv_id || ':' || turn AS query_id, text FROM conversations),
        tok AS (SELECT key, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')) AS term FROM docs),
        cnt AS (SELECT key, term, count(*) AS tf FROM tok GROUP BY ALL), len AS (SELECT key, sum(tf) AS n FROM cnt GROUP BY key), spread AS (SELECT term, count(*) AS df FROM cnt GROUP BY term),
        total AS (SELECT count(*)::DOUBLE AS docs, sum(n)::DOUBLE AS words FROM len),
        weight AS (SELECT term, key, floor(1000000.0::DOUBLE * ln(1 + (docs - df + 0.5::DOUBLE) / (df + 0.5::DOUBLE)) * tf * 2.2::DOUBLE / (tf + 1.2::DOUBLE * (0.25::DOUBLE + 0.75::DOUBLE * n::DOUBLE * docs / words)))::BIGINT AS w
          FROM cnt JOIN len USING (key) JOIN spread USING (term), total),
        term AS (SELECT DISTINCT query_id, unnest(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda w: w <> '')) AS term FROM asked),
        lex AS (SELECT query_id, key, row_number() OVER (PARTITION BY query_id ORDER BY sum(w) DESC, key) AS r FROM term JOIN weight USING (term) GROUP BY query_id, key),
        item AS (SELECT 'd' AS side, key::VARCHAR AS id, text AS txt FROM docs UNION ALL SELECT 'q', query_id, text FROM asked),
        word AS (SELECT side, id, unnest(list_filter(string_split(txt, ' '), lambda w: w <> '')) AS w FROM item),
        part AS (SELECT side, id, (('0x' || substring(md5(w), 1, 4))::INTEGER % 64) AS b, count(*)::DOUBLE AS n FROM word GROUP BY ALL),
        size AS (SELECT side, id, sqrt(sum(n * n)) AS s FROM part GROUP BY side, id),
        dot AS (SELECT q.id AS query_id, d.id AS key, sum(q.n * d.n) AS dot FROM part q JOIN part d ON q.side = 'q' AND d.side = 'd' AND q.b = d.b GROUP BY ALL),
        near AS (SELECT q.id AS query_id, d.id::BIGINT AS key, row_number() OVER (PARTITION BY q.id ORDER BY coalesce(dot, 0) / q.s / d.s DESC, d.id::BIGINT) AS r
          FROM size q JOIN size d ON q.side = 'q' AND d.side = 'd' LEFT JOIN dot ON dot.query_id = q.id AND dot.key = d.id),
        fused AS (SELECT query_id, key, sum(floor(1000000000 / (60 + r)))::BIGINT AS score FROM (SELECT * FROM lex WHERE r <= 20 UNION ALL SELECT * FROM near WHERE r <= 20) GROUP BY ALL)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, key))::INTEGER AS rank, key AS doc_id, score FROM fused QUALIFY rank <= 10""",
    "type_metadata": "SELECT doc_id, doc_type, " + ", ".join(
        f"nullif(array_to_string(list_filter({x}, lambda v, i: list_position({x}, v) = i), ' ; '), '') AS all_{n}" for n, x in (
            ("amount", r"(CASE WHEN doc_type = 'contrato' THEN regexp_extract_all(text, '([0-9]+(?:[.,][0-9]+)+)', 1) ELSE [] END)"),
            ("word", r"(CASE WHEN doc_type = 'contrato' THEN regexp_extract_all(text, '([A-Z][a-z]{9,})', 1) WHEN doc_type = 'cv' THEN list_concat(regexp_extract_all(text, '([A-Z][a-z]{9,})', 1), regexp_extract_all(text, '([a-z]{14,})', 1)) ELSE [] END)"),
            ("email", r"(CASE WHEN doc_type = 'cv' THEN regexp_extract_all(text, '([A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)', 1) ELSE [] END)"),
            ("url", "regexp_extract_all(text, '(https?://[^\\s\"''<>]+)', 1)"))) + f" FROM documents JOIN (SELECT doc_id::BIGINT AS doc_id, doc_type FROM ({_DOCUMENT_TABLE})) USING (doc_id)",
}
