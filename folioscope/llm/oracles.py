"""The SQL that checks the queries DuckDB can express, with its constants written out."""

from __future__ import annotations

_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
_FLOORS = (0.15, 0.35, 0.6, 0.6, 0.35)
_N = len(_FLOORS)
_PAIRS = [(i, j) for i in range(_N) for j in range(i + 1)]


def _stat(x: str) -> str:
    return f"round(log2({x}) * 1024)::BIGINT"


_BASE = f"""read AS (SELECT doc_id, coalesce(text, '') AS t, coalesce('=' || lang, '') AS gl, coalesce('=' || source, '') AS gs, {_WORDS} AS w,
      list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS l FROM documents),
    win AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM (
      SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM read))),
    rep AS (SELECT doc_id, sum(least(5, coalesce(nx - i, 5)))::BIGINT AS n FROM (
      SELECT doc_id, i, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS nx FROM win WHERE c > 1) GROUP BY doc_id),
    cnt AS (SELECT doc_id, gl, gs, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
        coalesce(rep.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines, length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')) AS n_capitals
      FROM read LEFT JOIN rep USING (doc_id)),
    m AS MATERIALIZED (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
        {_stat('(word_chars + 1)::DOUBLE / greatest(n_words, 1)')} AS x0, {_stat('1 + 16 * n_symbols::DOUBLE / greatest(n_words, 1)')} AS x1,
        {_stat('1 + 16 * n_dup_lines::DOUBLE / greatest(n_lines, 1)')} AS x2, {_stat('1 + 16 * n_repeat_words::DOUBLE / greatest(n_words, 1)')} AS x3,
        {_stat('1 + 16 * n_capitals::DOUBLE / greatest(word_chars, 1)')} AS x4 FROM cnt)"""


def _distance() -> str:
    """Squared Mahalanobis distance: columns y0 to y4 level by level, then their squares."""
    inner = "{0}"
    for i in range(_N):
        left = f"(x{i} / 1024.0::DOUBLE - m{i}" + "".join(f" - l{i}{j} * y{j}" for j in range(i)) + f") / l{i}{i}"
        inner = f"(SELECT *, {left} AS y{i} FROM {inner})"
    return f"(SELECT *, {' + '.join(f'y{i} * y{i}' for i in range(_N))} AS d2 FROM {inner})"


def _factor(source: str, keys: str, consistency: str) -> str:
    """Means, Cholesky factors and the logarithm of the determinant from sums."""
    inner = f"(SELECT {keys}, {', '.join(f's{i} / n::DOUBLE / 1024 AS m{i}' for i in range(_N))}, {', '.join(f'p{i}{j} / n::DOUBLE / (1024 * 1024) AS q{i}{j}' for i, j in _PAIRS)} FROM {source})"
    for i, j in _PAIRS:
        rest = f"(q{i}{j} - m{i} * m{j})"
        rest = f"(greatest({rest}, 0) * {consistency}::DOUBLE + {_FLOORS[i] ** 2!r}::DOUBLE)" if i == j else f"({rest} * {consistency}::DOUBLE)"
        rest += "".join(f" - l{i}{k} * l{j}{k}" for k in range(j))
        value = f"sqrt(greatest({rest}, {_FLOORS[i] ** 2 / 4!r}::DOUBLE))" if i == j else f"({rest}) / l{j}{j}"
        inner = f"(SELECT *, {value} AS l{i}{j} FROM {inner})"
    return f"(SELECT {keys}, {', '.join(_FIELDS)}, 2 * ({' + '.join(f'ln(l{i}{i})' for i in range(_N))}) AS log_det FROM {inner})"


_FIELDS = [f"m{i}" for i in range(_N)] + [f"l{i}{j}" for i, j in _PAIRS]
_KEYS = [f"s{i}" for i in range(_N)] + [f"p{i}{j}" for i, j in _PAIRS]
_SUMS = ", ".join([f"sum(x{i}) AS s{i}" for i in range(_N)] + [f"sum(x{i} * x{j}) AS p{i}{j}" for i, j in _PAIRS])


def _starts() -> str:
    """Rows of large groups, their quartiles, and the three starts: medians with least or quartile deviations, all rows."""
    quarter = {"a": 1, "v": 2, "b": 3}
    around = lambda l: ", ".join([f"v{i} * 16 / 1024.0::DOUBLE AS m{i}" for i in range(_N)] + [f"{l(i) if i == j else '0.0'}::DOUBLE AS l{i}{j}" for i, j in _PAIRS])
    spread = lambda i: f"sqrt(power((b{i} - a{i}) * 16 / 1024.0::DOUBLE / 1.349::DOUBLE, 2) + {_FLOORS[i] * _FLOORS[i]!r}::DOUBLE)"
    return f"""r AS MATERIALIZED (SELECT gl, gs, x0, x1, x2, x3, x4 FROM m WHERE NOT base_failed AND (gl, gs) IN (SELECT (gl, gs) FROM m WHERE NOT base_failed GROUP BY gl, gs HAVING count(*) >= 20)),
        v AS (SELECT gl, gs, i, v, sum(count(*)) OVER (PARTITION BY gl, gs, i ORDER BY v) AS below, sum(count(*)) OVER (PARTITION BY gl, gs, i) AS n
          FROM ({' UNION ALL '.join(f'SELECT gl, gs, {i} AS i, x{i} // 16 AS v FROM r' for i in range(_N))}) GROUP BY gl, gs, i, v),
        q AS MATERIALIZED (SELECT gl, gs, {', '.join(f'min(v) FILTER (WHERE i = {i} AND 4 * below >= {q} * n) AS {c}{i}' for i in range(_N) for c, q in quarter.items())} FROM v GROUP BY gl, gs),
        e0 AS MATERIALIZED (SELECT *, 'inf'::DOUBLE AS log_det, true AS falling FROM (SELECT gl, gs, 0 AS start, {around(lambda i: repr(_FLOORS[i]))} FROM q
          UNION ALL SELECT gl, gs, 1, {around(spread)} FROM q
          UNION ALL SELECT gl, gs, 2, {', '.join(_FIELDS)} FROM {_factor(f'(SELECT gl, gs, count(*) AS n, {_SUMS} FROM r GROUP BY gl, gs)', 'gl, gs', '1.0')}))"""


def _steps(steps: int) -> str:
    """Steps from all starts; one whose determinant has stopped falling stays as it is."""
    out = []
    for k in range(1, steps + 1):
        joined = f"(SELECT r.*, start, {', '.join(_FIELDS)} FROM r JOIN e{k - 1} USING (gl, gs) WHERE falling)"
        nearest = f"(SELECT * FROM c{k} WHERE n >= 0.5 * everything QUALIFY row_number() OVER (PARTITION BY gl, gs, start ORDER BY bin) = 1)"
        fell = "coalesce(f.log_det < e.log_det - 1e-6::DOUBLE, false)"
        out += [f"b{k} AS (SELECT gl, gs, start, bin, count(*) AS n, {_SUMS} FROM (SELECT *, floor(log2(1 + d2) * 64)::INTEGER AS bin FROM {_distance().format(joined)}) GROUP BY gl, gs, start, bin)",
                f"c{k} AS (SELECT gl, gs, start, bin, sum(n) OVER (PARTITION BY gl, gs, start) AS everything, " + ", ".join(f"sum({x}) OVER (PARTITION BY gl, gs, start ORDER BY bin) AS {x}" for x in ["n", *_KEYS]) + f" FROM b{k})",
                f"f{k} AS MATERIALIZED {_factor(nearest, 'gl, gs, start', _CONSISTENCY)}",
                f"e{k} AS MATERIALIZED (SELECT gl, gs, start, {', '.join(f'if({fell}, f.{x}, e.{x}) AS {x}' for x in [*_FIELDS, 'log_det'])}, {fell} AS falling FROM e{k - 1} AS e LEFT JOIN f{k} AS f USING (gl, gs, start))"]
    return ", ".join(out)


# Half of the rows, widened to all of a normal group; the squared distance that one in a million of its rows passes.
_CONSISTENCY, _CUTOFF = "1.912208058512948", "35.88818687953741"
# More than the given tables need; steps without a falling determinant change nothing.
_ROUNDS = 16
_LAST = f"(SELECT m.*, {', '.join(_FIELDS)} FROM m LEFT JOIN (SELECT * FROM e{_ROUNDS} QUALIFY row_number() OVER (PARTITION BY gl, gs ORDER BY log_det, start) = 1) USING (gl, gs))"

ORACLES = {
    "op5_quality_rules": f"""WITH {_BASE}, {_starts()}, {_steps(_ROUNDS)}
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND coalesce(d2, 0) <= {_CUTOFF}::DOUBLE AS kept FROM {_distance().format(_LAST)}""",
    "op8_substring_dedup": f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
        win AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS s FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
        least AS (SELECT s, min(doc_id) AS k FROM win GROUP BY s),
        gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM win JOIN least USING (s) WHERE k < doc_id),
        word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i FROM d),
        kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS t, count(*) AS n FROM word ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)""",
    "op11_lexical_search": """WITH seen AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t FROM documents),
        held AS (SELECT doc_id, len(t) AS n, t FROM seen WHERE len(t) > 0), total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM held),
        tfs AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, n, unnest(t) AS term FROM held) GROUP BY ALL),
        asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark),
        weight AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM tfs, total GROUP BY term, docs),
        scored AS (SELECT item_id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // length))))::BIGINT AS score
          FROM asked JOIN tfs USING (term) JOIN weight USING (term), total GROUP BY item_id, doc_id)
        SELECT item_id, (row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id))::INTEGER AS rank, doc_id, score FROM scored WHERE score > 0
        QUALIFY rank <= 10""",
    "op12_turn_trie": """WITH own AS (SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS p, [coalesce(role, ''), coalesce(text, '')] AS said FROM conversations),
        conv AS (SELECT DISTINCT c, c - c % 20 AS base, xor(4294967295::UBIGINT, list_reduce(list_concat([4294967295::UBIGINT], list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::UBIGINT)),
            lambda a, b: list_reduce(list_concat([xor(a, b)], list_transform(range(8), lambda i: i::UBIGINT)), lambda s, i: if(s & 1 = 1, xor(s >> 1, 3988292384::UBIGINT), s >> 1)))) % 4 AS h FROM own),
        turns AS (SELECT conv.c, 0 AS part, p, said FROM conv JOIN own ON own.c = base AND p <= h UNION ALL SELECT c, 1, p, said FROM conv JOIN own USING (c) WHERE p > h),
        built AS (SELECT conv.c, coalesce(seq, []) AS seq FROM conv LEFT JOIN (SELECT c, list(said ORDER BY part, p) AS seq FROM turns GROUP BY c) USING (c)),
        node AS (SELECT seq[:d] AS path, d, min(c) AS conv_id, count(*) AS n, list(c ORDER BY c) FILTER (WHERE len(seq) = d) AS ends FROM (SELECT c, seq, unnest(range(len(seq) + 1)) AS d FROM built) GROUP BY ALL),
        size AS (SELECT *, if(d = 0, 0, len(list_filter(regexp_split_to_array(path[d][2], '[\\x20\\x09-\\x0D]+'), lambda x: x <> ''))) AS words,
            (SELECT count(*) FROM node AS k WHERE k.d = node.d + 1 AND k.path[:node.d] = node.path) AS children FROM node)
        SELECT a.conv_id::BIGINT AS conv_id, a.d::BIGINT AS depth, (SELECT up.conv_id FROM node AS up WHERE up.d = a.d - 1 AND up.path = a.path[:a.d - 1])::BIGINT AS parent_conv_id, a.n::BIGINT AS n_convs, a.children::BIGINT AS n_children,
          sum((b.children = 0)::INTEGER)::BIGINT AS n_leaves, sum((b.n - 1) * b.words)::BIGINT AS saved_tokens, sha256(coalesce(array_to_string(a.ends, ','), '')) AS ends_sha256
        FROM size AS a JOIN size AS b ON b.path[:a.d] = a.path AND b.d >= a.d GROUP BY ALL""",
    "op13_vector_top_k": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS e FROM embeddings
          WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (SELECT q.vec_id AS query_id, v.vec_id, list_dot_product(q.e, v.e)::BIGINT AS score FROM v AS q JOIN v ON q.vec_id % 20 = 0 AND q.vec_id <> v.vec_id)
        SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM scored QUALIFY rank <= 20""",
}
